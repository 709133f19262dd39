"""Packing of tokenised documents into sequences by cutting-stock patterns.

Each document is its token ids and one end id. Whole sequences are cut off its
front; what is left (the remainder, shorter than a sequence) is packed:

1. Remainders are counted by length class: a histogram with a fixed number of
   classes, the only thing the driver sees.
2. A linear program chooses how often each pattern (a multiset of classes that
   fits a sequence) is used. Columns are generated: a knapsack over the prices
   of the classes finds the next pattern until none improves.
3. Uses are rounded down, then single uses are added while remainders last.
   Patterns that leave more than ``MAX_WASTE`` of a sequence empty are not used.
4. Documents are ranked inside their class, and the rank picks pattern, sequence
   and place. Ranks come from cell totals, so a class that holds most rows is
   spread over many tasks.
5. Remainders that no pattern takes stand in one stream that is cut every
   ``capacity`` ids, so nothing but its last sequence is padded.

Defined results: a null or empty text is the end id alone; a table without rows
gives no rows; equal lengths are ranked by a hash of the id and then by id. Ids
must be unique and not null.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.stages import saved

CAPACITY = 1024
#: Length classes of the histogram per sequence.
CLASSES = 128
#: The linear program ends within this share of its lower bound.
GAP = 0.003
#: Share of a sequence that a pattern may leave empty.
MAX_WASTE = 0.02
#: Rows of a cell, the unit of ranking.
CELL_ROWS = 50_000
END_ID = 0
#: A run of this many characters of one kind goes to the slower tokenizer.
LONG_RUN = re.compile(r"\S{100000}|\s{100000}")


@lru_cache(maxsize=4)
def encoder(vocabulary: str):
    """text -> ids of the tokenizers file, which has its ranks beside it.

    The rank file holds the same vocabulary (tests compare the ids), and its
    library takes a fifth of the time. Texts that it can't take, because of very
    long runs without a break, go to the tokenizers library.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(vocabulary)
    slow.encode_special_tokens = True
    ranks = _ranks(vocabulary)
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def ids(text: str) -> np.ndarray:
        if len(text) >= 100_000 and LONG_RUN.search(text):
            return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return np.array(fast.encode_ordinary(text), dtype="<u4")

    return ids


@lru_cache(maxsize=2)
def _ranks(vocabulary: str) -> dict[bytes, int]:
    with open(vocabulary.removesuffix(".json") + ".tiktoken", "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def token_bytes(vocabulary: str) -> np.ndarray:
    """How many bytes each id stands for."""
    ranks = _ranks(vocabulary)
    out = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    out[list(ranks.values())] = [len(token) for token in ranks]
    return out


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenised(docs: DataFrame, key: str, text: str, vocabulary: str, capacity: int) -> DataFrame:
    """id, tokens and the checksum of each whole sequence and of the remainder."""
    kind = docs.schema[key].dataType.simpleString()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            counts, sums = [], []
            for value in batch.column(1):
                ids = np.append(encode(value.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                counts.append(len(ids))
                sums.append(
                    [zlib.crc32(ids[a : a + capacity]) for a in range(0, len(ids), capacity)]
                )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(sums, pa.list_(pa.int64()))],
                names=["id", "tokens", "sums"],
            )

    return docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(
        measured, f"id {kind}, tokens long, sums array<long>"
    )


def cut_sums(rows: DataFrame, vocabulary: str) -> DataFrame:
    """Checksums on both sides of a cut: rows of id, text, begin, cut -> id, left, right."""
    kind = dict(rows.dtypes)["id"]

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            left, right = [], []
            for value, begin, cut in zip(batch.column(1), batch.column(2), batch.column(3)):
                ids = np.append(encode(value.as_py() or ""), np.uint32(END_ID)).astype("<u4")
                begin, cut = begin.as_py(), cut.as_py()
                left.append(zlib.crc32(ids[begin : begin + cut].copy()))
                right.append(zlib.crc32(ids[begin + cut :].copy()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(left, pa.int64()), pa.array(right, pa.int64())],
                names=["id", "left", "right"],
            )

    return rows.select("id", "text", "begin", "cut").mapInArrow(
        measured, f"id {kind}, left long, right long"
    )


def best_pattern(prices: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The pattern of greatest total price: a knapsack with any number of each class."""
    best = np.zeros(room + 1)
    choice = np.full(room + 1, -1)
    for c in range(1, room + 1):
        best[c] = best[c - 1]
        fit = int(np.searchsorted(sizes, c, side="right"))
        if fit:
            value = prices[:fit] + best[c - sizes[:fit]]
            k = int(value.argmax())
            if value[k] > best[c] + 1e-12:
                best[c], choice[c] = value[k], k
    pattern, c = np.zeros(len(sizes), dtype=np.int64), room
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            pattern[choice[c]] += 1
            c -= sizes[choice[c]]
    return float(best[room]), pattern


def cutting_stock(sizes: np.ndarray, counts: np.ndarray, room: int) -> list[tuple[np.ndarray, float]]:
    """Patterns with their uses in the linear program: fewest sequences for all counts."""
    m = len(sizes)
    basis = np.diag((room // sizes).astype(np.float64))
    inverse = np.diag(1.0 / np.diag(basis))
    least = float((sizes * counts).sum()) / room
    for _ in range(20 * m + 1):
        uses = inverse @ counts
        prices = inverse.sum(axis=0)
        value, pattern = best_pattern(prices, sizes, room)
        total = float(uses.sum())
        least = max(least, total / value) if value > 1 else total
        if value <= 1 + 1e-9 or total <= least * (1 + GAP):
            break
        column = inverse @ pattern
        able = column > 1e-9
        if not able.any():
            break
        ratios = np.where(able, np.maximum(uses, 0) / np.where(able, column, 1), np.inf)
        out = int(ratios.argmin())
        basis[:, out] = pattern
        row = inverse[out] / column[out]
        inverse -= np.outer(column, row)
        inverse[out] = row
    uses = np.maximum(inverse @ counts, 0)
    return [(basis[:, k].astype(np.int64), float(u)) for k, u in enumerate(uses) if u > 1e-9]


def rounded(
    patterns: list[tuple[np.ndarray, float]], sizes: np.ndarray, counts: np.ndarray, room: int
) -> list[tuple[np.ndarray, int]]:
    """Whole uses of the well filled patterns that the counts allow."""
    left = counts.astype(np.int64).copy()
    chosen = []
    good = [(p, u) for p, u in patterns if p @ sizes >= (1 - MAX_WASTE) * room]
    for pattern, uses in sorted(good, key=lambda x: -x[1]):
        n = min(int(uses + 1e-6), int((left[pattern > 0] // pattern[pattern > 0]).min()))
        left -= n * pattern
        chosen.append([pattern, n])
    for use in sorted(chosen, key=lambda x: -int(x[0] @ sizes)):
        pattern = use[0]
        n = int((left[pattern > 0] // pattern[pattern > 0]).min())
        n = min(n, 1)
        left -= n * pattern
        use[1] += n
    return [(p, n) for p, n in chosen if n]


def before(df: DataFrame, groups: list[str], value: Column, name: str) -> DataFrame:
    """Sum of value over the earlier rows of a group, ordered by cell and id."""
    totals = df.groupBy(*groups, "cell").agg(F.sum(value).alias("_total"))
    over = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = over.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select(
        *groups, "cell", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_begin")
    )
    within = Window.partitionBy(*groups, "cell").orderBy("id")
    own = F.coalesce(F.sum(value).over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return (
        df.withColumn("_own", own)
        .join(begins, [*groups, "cell"])
        .withColumn(name, F.col("_begin") + F.col("_own"))
        .drop("_begin", "_own")
    )


def plan_rows(patterns: list[tuple[np.ndarray, int]], classes: np.ndarray) -> list[tuple]:
    """(class, first rank, end rank, first sequence, copies per sequence)."""
    taken = np.zeros(len(classes), dtype=np.int64)
    rows, sequence = [], 0
    for pattern, n in patterns:
        for k in np.flatnonzero(pattern):
            size = int(n * pattern[k])
            rows.append((int(classes[k]), int(taken[k]), int(taken[k]) + size, sequence, int(pattern[k])))
            taken[k] += size
        sequence += n
    return rows


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    vocabulary: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    unit = -(-capacity // CLASSES)
    room = capacity // unit
    rows = tokenised(docs, key, text, vocabulary, capacity)
    rows = saved(
        rows.withColumn("rest", F.col("tokens") % capacity)
        .withColumn("whole", F.floor(F.col("tokens") / capacity))
        .withColumn("class", F.ceil(F.col("rest") / unit).cast("int")),
        "packing-tokens",
    )
    histogram = rows.groupBy("class").agg(
        F.count("*").alias("n"), F.sum("whole").alias("whole")
    ).collect()  # at most CLASSES + 1 rows
    n_rows = sum(h["n"] for h in histogram)
    n_whole = sum(h["whole"] for h in histogram)
    cells = n_rows // CELL_ROWS * 4 + 16
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("id"), F.lit(cells)))

    items = sorted((h["class"], h["n"]) for h in histogram if h["class"])
    # a remainder of the last class may be longer than the units left by rounding
    fitting = [(c, n) for c, n in items if c <= room]
    sizes = np.array([c for c, _ in fitting], dtype=np.int64)
    counts = np.array([n for _, n in fitting], dtype=np.float64)
    patterns = rounded(cutting_stock(sizes, counts, room), sizes, counts, room) if fitting else []
    n_packed = sum(n for _, n in patterns)
    plan = spark.createDataFrame(
        plan_rows(patterns, sizes),
        "class int, first long, end long, sequence long, copies int",
    )

    whole = before(rows.where("whole > 0"), [], F.col("whole"), "_at")
    whole = whole.select(
        "id", "tokens", F.col("_at"), F.posexplode(F.slice("sums", 1, F.col("whole").cast("int"))).alias("k", "crc")
    ).select(
        "id",
        (F.col("k").cast("long") * capacity).alias("start"),
        F.lit(capacity).cast("long").alias("length"),
        "crc",
        "tokens",
        (F.col("_at") + F.col("k") + n_packed).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )

    rests = before(rows.where("rest > 0"), ["class"], F.lit(1), "rank").withColumn(
        "crc", F.element_at("sums", -1)
    )
    rests = rests.select(
        "id", "tokens", "rest", "class", "rank", "cell", "crc",
        (F.col("tokens") - F.col("rest")).alias("start"),
    )
    # the plan has no more rows than the patterns have classes, whatever the input
    ranked = saved(
        rests.alias("r").join(
            F.broadcast(plan).alias("p"),
            (F.col("r.class") == F.col("p.class")) & F.col("rank").between(F.col("first"), F.col("end") - 1),
            "left",
        ).select(
            "r.*", (F.col("sequence") + F.floor((F.col("rank") - F.col("first")) / F.col("copies"))).alias("sequence_id"),
        ),
        "packing-ranked",
    )
    inside = Window.partitionBy("sequence_id").orderBy(F.desc("rest"), "id")
    placed = ranked.where("sequence_id is not null").select(
        "id", "start", F.col("rest").alias("length"), "crc", "tokens", "sequence_id",
        F.coalesce(F.sum("rest").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )

    stream = saved(
        before(ranked.where("sequence_id is null"), [], F.col("rest"), "at")
        .drop("sequence_id")
        .withColumn("room", capacity - F.col("at") % capacity),
        "packing-stream",
    )
    base = n_packed + n_whole
    sequence = base + F.floor(F.col("at") / capacity)
    uncut = stream.where("rest <= room").select(
        "id", "start", F.col("rest").alias("length"), "crc", "tokens",
        sequence.alias("sequence_id"), (F.col("at") % capacity).alias("offset"),
    )
    crossing = saved(stream.where("rest > room"), "packing-cuts")
    texts = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(
        crossing.select("id", F.col("start").alias("begin"), F.col("room").alias("cut")), "id"
    )
    cut = crossing.join(cut_sums(texts, vocabulary), "id")
    head = cut.select(
        "id", "start", F.col("room").alias("length"), F.col("left").alias("crc"), "tokens",
        sequence.alias("sequence_id"), (F.col("at") % capacity).alias("offset"),
    )
    tail = cut.select(
        "id", (F.col("start") + F.col("room")).alias("start"), (F.col("rest") - F.col("room")).alias("length"),
        F.col("right").alias("crc"), "tokens", (sequence + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
    )
    pieces = whole
    for more in (placed, uncut, head, tail):
        pieces = pieces.unionByName(more)
    return pieces.select(
        F.col("id").alias(key), "start", "length", F.col("crc").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"), "sequence_id", "offset",
    )
