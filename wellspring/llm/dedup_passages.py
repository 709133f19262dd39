"""Removal of passages that occur more than once, by short and then full windows.

A window can only repeat if its parts do, so what occurs once at a quarter of the
length (9 words of 35) is dropped there, and only the rest is extended, at once to
full windows: the level of 18 words of the doubling method is not counted.

* Short windows are sampled by content: each full window is represented by the
  short window with the smallest hash inside it, its *seed*, so equal windows
  name the same seed. Neighbouring windows mostly share it; they form a *run*.
* Seeds that occur once end there, with all runs they stand for.
* Other runs are extended to both sides of the seed, to all
  the words of their full windows. A run that occurs elsewhere as a whole repeats
  in every window. Only runs with a repeated seed but other surroundings are
  opened and compared window by window, next to one copy of each repeated run
  with the same seed.

All counting is a partial aggregate by hash before the shuffle, so a passage
that occurs in a third of the documents is one row per task. No pairs are made.
A window is identified by the 64-bit hashes of its seed and of itself together.

Defined results: a null text has no words; texts shorter than the window lose
nothing; repeats inside one text count as repeats; windows are judged on the
input, not on what is left; an empty table gives no rows. Ids must be unique
and not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.stages import discard, saved
from wellspring.llm.words import (
    Slice,
    Stretches,
    mixed,
    packed_texts,
    signed,
    slices,
    unpacked,
    window_starts,
    words,
)

WINDOW = 35


def smallest_within(h: np.ndarray, width: int) -> np.ndarray:
    """For each i the leftmost position of the least value in h[i : i + width]."""
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    best, reach = np.arange(len(h)), 1
    while reach < width:
        step = min(reach, width - reach)
        left, right = best[:-step], best[step:]
        best = np.where(h[right] < h[left], right, left)
        reach += step
    return best[:n]


def _runs(part: Slice, window: int, length: int):
    """Runs of a slice: row, first window, windows, hash of the seed, hash of the run."""
    w = words(part)
    if len(w.hashes) < window:
        return None
    stretch = Stretches(w.hashes)
    starts, rows = window_starts(w.first, window)
    if not len(starts):
        return None
    seeds = stretch(np.arange(len(w.hashes) - length + 1), length)
    named = smallest_within(seeds, window - length + 1)[starts]
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (named[1:] != named[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    whole = stretch(begin, count + window - 1)
    # two runs are equal if their words are and the seed stands at the same place
    place = (named[first] - begin).astype(np.uint64) * np.uint64(1 << 20)
    whole = mixed(whole ^ mixed(place + count.astype(np.uint64)))
    own = rows[first]
    return own, begin - w.first[own], count, seeds[named[first]], whole


def runs(docs: DataFrame, key: str, text: str, window: int) -> DataFrame:
    length = -(-window // 4)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for part in slices(batch.column(1)):
                got = _runs(part, window, length)
                if got is None:
                    continue
                row, begin, count, seed, whole = got
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row + part.first)),
                        pa.array(begin * window + count),
                        pa.array(signed(seed)),
                        pa.array(signed(whole)),
                    ],
                    names=["id", "at", "seed", "run"],
                )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        found, f"id {kind}, at long, seed long, run long"
    )


def judged(all_runs: DataFrame) -> DataFrame:
    """Runs whose seed repeats, each with whether it is repeated and to be opened."""
    seeds = all_runs.groupBy("seed").agg(F.count("*").alias("times")).where("times > 1")
    alive = saved(all_runs.join(seeds.select("seed"), "seed", "left_semi"), "passages-alive")
    discard(all_runs)
    kinds = alive.groupBy("seed", "run").agg(
        F.count("*").alias("times"), F.min("id").alias("sample")
    )
    several = kinds.groupBy("seed").agg(F.count("*").alias("kinds")).where("kinds > 1")
    known = kinds.join(several, "seed", "left").select(
        "seed", "run", (F.col("times") > 1).alias("repeated"), "sample",
        F.col("kinds").isNotNull().alias("mixed"),
    )
    marked = saved(
        alive.join(known, ["seed", "run"]).select(
            "id", "at", "seed", "repeated",
            (F.col("mixed") & (~F.col("repeated") | (F.col("id") == F.col("sample")))).alias("open"),
        ),
        "passages-judged",
    )
    discard(alive)
    return marked


def opened(docs: DataFrame, marked: DataFrame, key: str, text: str, window: int) -> DataFrame:
    """Windows of the runs to be opened, with their hash."""
    kind = docs.schema[key].dataType.simpleString()
    wanted = marked.where("open").groupBy("id").agg(
        F.collect_list(F.struct("at", "seed", "repeated")).alias("runs")
    )  # bounded by the words of one text
    rows = packed_texts(docs, key, text).join(wanted, "id")

    def parts(bodies: pa.Array) -> Iterator[tuple[int, Slice]]:
        for begin, texts in unpacked(bodies):
            for part in slices(texts):
                yield begin + part.first, part

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, listed = batch.column(0), batch.column(2)
            for base, part in parts(batch.column(1)):
                w = words(part)
                stretch = Stretches(w.hashes)
                own = listed.slice(base, part.rows)
                flat = own.flatten()
                row = np.repeat(np.arange(part.rows), np.diff(own.offsets.to_numpy()))
                both, seed, repeated = (
                    f.to_numpy(zero_copy_only=False) for f in flat.flatten()
                )
                begin, n = both // window, both % window
                steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                at = np.repeat(begin, n) + steps
                row = np.repeat(row, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(row + base)),
                        pa.array(at.astype(np.int32)),
                        pa.array(np.repeat(seed, n)),
                        pa.array(signed(stretch(w.first[row] + at, window))),
                        pa.array(np.repeat(repeated, n)),
                    ],
                    names=["id", "begin", "seed", "full", "repeated"],
                )

    return rows.select("id", "body", "runs").mapInArrow(
        windows, f"id {kind}, begin int, seed long, full long, repeated boolean"
    )


def repeated_spans(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """Word ranges (key, begin, length) made of windows that also start elsewhere."""
    marked = judged(saved(runs(docs, key, text, window), "passages-runs"))
    single = saved(opened(docs, marked, key, text, window), "passages-windows")
    again = (
        single.groupBy("seed", "full")
        .agg(F.sum(F.when(F.col("repeated"), 2).otherwise(1)).alias("times"))
        .where("times > 1")
        .drop("times")
    )
    whole = marked.where("repeated").select(
        "id",
        F.floor(F.col("at") / window).cast("int").alias("begin"),
        (F.col("at") % window + (window - 1)).cast("int").alias("length"),
    )
    parts = single.where("not repeated").join(again, ["seed", "full"], "left_semi")
    return whole.unionByName(parts.select("id", "begin", F.lit(window).alias("length"))).select(
        F.col("id").alias(key), "begin", "length"
    )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """key, n_words, n_removed and the kept words of every row, joined by one blank."""
    kind = docs.schema[key].dataType.simpleString()
    spans = repeated_spans(docs, key, text, window).groupBy(key).agg(
        F.collect_list(F.struct("begin", "length")).alias("spans")
    )  # bounded by the words of one text
    rows = packed_texts(docs, key, text).join(spans.withColumnRenamed(key, "id"), "id", "left")

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            listed = batch.column(2)
            for first, texts in unpacked(batch.column(1)):
                done = [
                    _without(texts[k].as_buffer(), listed[first + k]) for k in range(len(texts))
                ]
                total, removed, kept = zip(*done)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(done)),
                        pa.array(total, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()).cast(pa.string()),
                    ],
                    names=[key, "n_words", "n_removed", "kept"],
                )

    return rows.select("id", "body", "spans").mapInArrow(
        cleaned, f"{key} {kind}, n_words long, n_removed long, kept string"
    )


def _without(text: pa.Buffer, spans: pa.ListScalar) -> tuple[int, int, bytes]:
    """Number of words, number removed, and the words outside the spans."""
    own = text.to_pybytes().split()
    if not spans.is_valid or not len(spans):
        return len(own), 0, b" ".join(own)
    begin, length = (f.to_numpy(zero_copy_only=False) for f in spans.values.flatten())
    change = np.bincount(begin, minlength=len(own) + 1).astype(np.int64)
    change -= np.bincount(begin + length, minlength=len(own) + 1)
    keep = np.cumsum(change[:-1]) == 0
    kept = int(keep.sum())
    return len(own), len(own) - kept, b" ".join(compress(own, keep.tolist()))


def digests(cleaned: DataFrame) -> DataFrame:
    """The kept words as their SHA-256."""
    return cleaned.select(
        *[c for c in cleaned.columns if c != "kept"], F.sha2("kept", 256).alias("kept_sha256")
    )
