"""Ranked lexical search over a length-stratified index.

Scoring (all integers but the term weight):

* terms: maximal runs of letters, digits and non-ASCII characters, A-Z
  lower-cased; N documents with a term, L terms of all of them;
* w(term) = floor(1000 * ln((2N + 2) / (2 df + 1))), never negative;
* m(doc) = 75 + (25 n N) div L, the document's length normaliser;
* score = sum over the item's terms (repeats included) of
  w * ((10**9 tf) div (1000 tf + 12 m)).

Postings are counted inside each task (Arrow) and stay with their document: the
index has one row per document, its terms of the items with their tf, so neither
the corpus nor a pair of item and document is ever shuffled. The index is
stratified by m: documents of equal m form a stratum, and a posting (term, m, tf)
has the impact w(term) * g(tf, m), g = (10**9 tf) div (1000 tf + 12 m). A stratum's
bound for an item is the sum of its terms' largest impacts there. Strata are visited
in order of their bound in two rounds, for ``ITEMS`` items at once:

1. the best strata of each item until they hold ``TOP`` documents for sure
   (the largest posting list of one of its terms counts); their exact scores
   give the item's threshold, the ``TOP``-th best score (0 if fewer);
2. the other strata whose bound reaches the threshold.

A task scores its documents and keeps the ``TOP`` best of each item, which is all
that leaves it.

Strata below the threshold cannot hold a document of the result, so the result
is exact. Terms of weight 0 add nothing and are left out of the index.

Defined results: a null text has no terms; rows of one doc_id or item_id are
one document or item made of all their terms; rows with a null id take no
part; documents without terms are not counted in N and never returned; an
item without terms gives no rows; equal scores are ordered by doc_id; extra
columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.stages import discard, saved

TOP = 20
# Fixed values of the contract: the term pattern and the constants of the score.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What stands between terms: the complement of TERM (ASCII but letters and digits).
SEPARATORS = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
G = "(1000000000L * tf) div (1000L * tf + 12L * m)"
#: Text bytes handed to Arrow at once: bounds a task's memory whatever the batch.
SLICE_BYTES = 4 << 20
#: A table of ids is broadcast only up to so many rows (counted first).
BROADCAST_ROWS = 2_000_000
#: Items of one pass over the documents, about; their terms and strata reach the driver.
ITEMS = 500
#: Cells (document, item) and pairs (posting, item) that a task handles at once, about.
CELLS, PAIRS = 1 << 20, 1 << 20


def terms(text) -> F.Column:
    """All terms of a text, in order, A-Z lower-cased; null has none."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def _slices(batch: pa.RecordBatch, limit: int):
    """Consecutive rows of a batch with at most ``limit`` bytes of text (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    start, used = 0, 0
    for k, size in enumerate(sizes):
        if k > start and used + size > limit:
            yield batch.slice(start, k - start)
            start, used = k, 0
        used += size
    if start < len(sizes):
        yield batch.slice(start, len(sizes) - start)


def _bounded(small: DataFrame, most: int) -> DataFrame:
    """small, broadcast if it has at most ``most`` rows (counted), else as it is (shuffled)."""
    return F.broadcast(small) if small.count() <= most else small


def postings(docs: DataFrame, wanted: pa.Array, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n, codes, tfs) of every document with a term; codes are places in ``wanted``.

    Counted within each task. A doc_id of several rows is summed afterwards, so it is
    one document; only such ids are shuffled, and none when there are none.
    """
    size = max(1, len(wanted))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _slices(whole, SLICE_BYTES):
                parts = pc.split_pattern_regex(pc.ascii_lower(batch.column("text")), SEPARATORS)
                flat = pc.list_flatten(parts)
                rows = pc.list_parent_indices(parts).to_numpy(zero_copy_only=False).astype(np.int64)
                there = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
                n = np.bincount(rows[there], minlength=batch.num_rows)
                code = pc.fill_null(pc.index_in(flat, value_set=wanted), -1).to_numpy(zero_copy_only=False)
                some = there & (code >= 0)
                cells, tf = np.unique(rows[some] * size + code[some], return_counts=True)
                ends = np.searchsorted(cells, np.arange(batch.num_rows + 1) * size).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(x))
                    for x in ((cells % size).astype(np.int32), tf.astype(np.int64))
                ]
                found = pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(n.astype(np.int64)), *lists],
                    names=["doc_id", "n", "codes", "tfs"],
                )
                yield found.filter(pa.array(n > 0))

    rows = docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    index = saved(
        rows.mapInArrow(counted, "doc_id long, n long, codes array<int>, tfs array<long>"), "lexical-index"
    )
    repeated = saved(index.groupBy("doc_id").count().where(F.col("count") > 1).select("doc_id"), "lexical-repeated")
    if repeated.isEmpty():
        return index
    repeated = _bounded(repeated, BROADCAST_ROWS)
    several = index.join(repeated, "doc_id", "left_semi")
    lists = (
        several.select("doc_id", F.explode(F.arrays_zip("codes", "tfs")).alias("p"))
        .groupBy("doc_id", F.col("p.codes").alias("code"))
        .agg(F.sum("p.tfs").alias("tf"))
        .groupBy("doc_id")
        .agg(F.collect_list(F.struct("code", "tf")).alias("p"))
    )
    summed = (
        several.groupBy("doc_id")
        .agg(F.sum("n").alias("n"))
        .join(lists, "doc_id", "left")
        .select(
            "doc_id", "n",
            F.coalesce("p.code", F.array().cast("array<int>")).alias("codes"),
            F.coalesce("p.tf", F.array().cast("array<long>")).alias("tfs"),
        )
    )
    return saved(index.join(repeated, "doc_id", "left_anti").unionByName(summed), "lexical-index")


def item_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, q): each term of an item with its number of repeats."""
    return (
        items.where(F.col("item_id").isNotNull())
        .select("item_id", F.explode(terms(F.col("text"))).alias("term"))
        .groupBy("item_id", "term")
        .agg(F.count("*").alias("q"))
    )


def _best(
    index: DataFrame, asked: tuple[np.ndarray, ...], strata: pa.Table, least: np.ndarray
) -> DataFrame:
    """(slot, doc_id, score): in each task, the TOP best documents of each item in its strata.

    ``asked`` has (slot, code, qw) sorted by code, qw = q * w; ``strata`` the slots that
    visit each m; ``least`` the score that a document of each slot must reach.
    """
    slots, codes, qw = asked
    items = len(least)
    width = max(1, items)
    first = np.searchsorted(codes, np.arange(int(codes.max(initial=0)) + 2))
    ms = strata["m"].to_numpy()
    order = np.argsort(ms)
    ms = ms[order]
    visits = np.zeros((len(ms), width), dtype=bool)
    for k, at in enumerate(order):
        visits[k, strata["slots"][int(at)].as_py()] = True
    # sums of integers below 2**53 are exact in doubles
    doubles = int(np.bincount(slots, qw.astype(np.float64), width).max(initial=0)) < 2**53 // 10**6

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        floor = np.maximum(least, 1)
        held = [np.zeros(0, dtype=np.int64) for _ in range(3)]
        for batch in batches:
            if not batch.num_rows:
                continue
            doc, m = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            stratum = np.searchsorted(ms, m)
            ends = np.concatenate(([0], np.cumsum(pc.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False))))
            code = pc.list_flatten(batch.column(2)).to_numpy(zero_copy_only=False)
            tf = pc.list_flatten(batch.column(3)).to_numpy(zero_copy_only=False)
            fits = code < len(first) - 1
            begin = np.where(fits, first[np.minimum(code, len(first) - 2)], 0)
            times = np.where(fits, first[np.minimum(code, len(first) - 2) + 1] - begin, 0)
            pairs = np.concatenate(([0], np.cumsum(times)))[ends]
            a = 0
            while a < len(doc):
                b = int(np.searchsorted(pairs, pairs[a] + PAIRS, side="right")) - 1
                b = min(max(b, a + 1), a + max(1, CELLS // width), len(doc))
                own = slice(ends[a], ends[b])
                row = np.repeat(np.arange(b - a), np.diff(ends[a : b + 1]))
                g = (1_000_000_000 * tf[own]) // (1000 * tf[own] + 12 * m[a:b][row])
                n = times[own]
                at = np.arange(n.sum()) + np.repeat(begin[own] - (np.cumsum(n) - n), n)
                row, to = np.repeat(row, n), slots[at]
                some = visits[stratum[a:b][row], to]
                cell, value = (row * width + to)[some], (qw[at] * np.repeat(g, n))[some]
                if doubles:
                    total = np.bincount(cell, value, (b - a) * width).astype(np.int64)
                else:
                    total = np.zeros((b - a) * width, dtype=np.int64)
                    np.add.at(total, cell, value)
                found = np.flatnonzero(total >= np.tile(floor, b - a))
                held = [
                    np.concatenate(x)
                    for x in zip(held, (found % width, doc[a:b][found // width], total[found]))
                ]
                if len(found):
                    order = np.lexsort((held[1], -held[2], held[0]))
                    held = [x[order] for x in held]
                    start = np.searchsorted(held[0], np.arange(width))
                    rank = np.arange(len(order)) - start[held[0]]
                    last = rank == TOP - 1
                    floor[held[0][last]] = np.maximum(floor[held[0][last]], held[2][last])
                    held = [x[rank < TOP] for x in held]
                a = b
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held], names=["slot", "doc_id", "score"])

    visited = index.where(F.col("m").isin(ms.tolist())) if len(ms) <= 100 else index
    if len(ms):
        visited = visited.where(F.col("m").between(int(ms[0]), int(ms[-1])))
    return visited.select("doc_id", "m", "codes", "tfs").mapInArrow(scored, "slot long, doc_id long, score long")


def _top(scores: DataFrame) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "doc_id")
    return scores.where(F.col("score") > 0).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= TOP)


def _searched(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """The result for some items, given as (item_id, term, q)."""
    spark = docs.sparkSession
    own = asked.select("item_id", "term", "q").toArrow()
    ids, wanted = (pc.unique(own[c].combine_chunks()) for c in ("item_id", "term"))
    place = lambda c, of: pc.index_in(own[c], value_set=of).to_numpy().astype(np.int64)
    slots, codes, q = place("item_id", ids), place("term", wanted), own["q"].to_numpy()

    post = postings(docs, wanted)
    totals = post.agg(F.count("*").alias("big_n"), F.sum("n").alias("big_l")).first()
    big_n, big_l = int(totals["big_n"] or 0), int(totals["big_l"] or 0)
    index = post.withColumn("m", F.expr(f"75 + (25 * n * {big_n}L) div {max(big_l, 1)}L"))
    # Per (term, stratum): the largest tf and the number of documents.
    lists = saved(
        index.select("m", F.explode(F.arrays_zip("codes", "tfs")).alias("p"))
        .groupBy(F.col("p.codes").alias("code"), "m")
        .agg(F.max("p.tfs").alias("tf"), F.count("*").alias("docs")),
        "lexical-lists",
    )
    weights = lists.groupBy("code").agg(F.sum("docs").alias("df")).select(
        "code",
        F.floor(1000 * F.log(F.lit(2.0 * big_n + 2) / (2 * F.col("df").cast("double") + 1))).cast("long").alias("w"),
    ).toArrow()
    w = np.zeros(len(wanted), dtype=np.int64)
    w[weights["code"].to_numpy()] = weights["w"].to_numpy()
    # Terms of weight 0 add nothing.
    qw = q * w[codes]
    order = np.argsort(codes, kind="stable")
    order = order[qw[order] > 0]
    known = (slots[order], codes[order], qw[order])
    if not len(order):
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")

    table = pa.table({"slot": known[0], "code": known[1].astype(np.int32), "qw": known[2]})
    per_stratum = saved(
        lists.withColumn("top", F.expr(G))
        .join(F.broadcast(spark.createDataFrame(table)), "code")
        .groupBy("slot", "m")
        .agg(F.sum(F.col("qw") * F.col("top")).alias("bound"), F.max("docs").alias("surely")),
        "lexical-strata",
    )
    by_stratum = lambda df: df.groupBy("m").agg(F.collect_list("slot").alias("slots")).toArrow()
    best_first = Window.partitionBy("slot").orderBy(F.desc("bound"), "m").rowsBetween(Window.unboundedPreceding, -1)
    ordered = per_stratum.withColumn("before", F.coalesce(F.sum("surely").over(best_first), F.lit(0)))
    least = np.zeros(len(ids), dtype=np.int64)
    round1 = saved(_best(index, known, by_stratum(ordered.where(F.col("before") < TOP)), least), "lexical-round1")
    reached = _top(round1).where(F.col("rank") == TOP).select("slot", "score").toArrow()
    least[reached["slot"].to_numpy()] = reached["score"].to_numpy()
    limits = spark.createDataFrame(pa.table({"slot": np.arange(len(ids)), "least": least}))
    rest = (
        ordered.where(F.col("before") >= TOP)
        .join(F.broadcast(limits), "slot")
        .where(F.col("bound") >= F.col("least"))
    )
    round2 = _best(index, known, by_stratum(rest), least)
    names = spark.createDataFrame(pa.table({"slot": np.arange(len(ids)), "item_id": ids}))
    result = saved(
        _top(round1.unionByName(round2)).join(F.broadcast(names), "slot").select(
            F.col("item_id").cast("long").alias("item_id"), F.col("rank").cast("int").alias("rank"),
            F.col("doc_id").cast("long").alias("doc_id"), F.col("score").cast("long").alias("score"),
        ),
        "lexical-result",
    )
    for done in (post, lists, per_stratum, round1):
        discard(done)
    return result


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(item_id, rank, doc_id, score): the TOP best documents of every item."""
    asked = saved(item_terms(items), "lexical-items")
    blocks = max(1, -(-asked.select("item_id").distinct().count() // ITEMS))
    result = None
    for k in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        found = _searched(docs, some)
        result = found if result is None else result.unionByName(found)
    discard(asked)
    return result
