"""Hard negatives mined by exact integer scores from a residue-number-system product.

Every component x becomes the integer floor(256 * x). A score is the integer
inner product of a row with an anchor. The scores of a block of anchors against
a chunk of rows are one matrix product, done modulo several small primes p in
float32: residues are below p and a sum of d products stays below 2**24, so
each product is exact. The signed scores are rebuilt by Chinese remaindering
(Garner's mixed radix) from as many primes as the largest possible score needs.

Work is dealt as (anchor block, row chunk) pairs: anchors are a stated query
set (vec_id divisible by ``ANCHOR_EVERY``), every valid row is scored against
every anchor of the same length, in blocks. Two passes:

1. positives: per pair of block and chunk, the best ``TOP`` rows of the
   anchor's label; a window over all chunks keeps the best ``TOP``;
2. negatives: anchors carry their positives' scores; per pair, the best ``TOP``
   rows of another label within [0.8, 1] times each positive score; a window
   keeps the best ``TOP`` per anchor and positive.

"Best" is the higher score, ties by smaller vec_id, in both passes.

Defined results: rows with a null label, a null vector, or a null or
non-finite component take no part; the label of a row whose vec_id is divisible
by 7 is first shifted to (label + 1) % 10; a row is only scored against anchors
of its own vector length (an empty vector scores 0); an anchor is never its own
positive (a row of equal vec_id is skipped); fewer than ``TOP`` candidates give
all of them; an anchor without positives gives no rows; repeated vec_ids take
part as separate rows and anchors with a repeated vec_id share one list;
extra columns are ignored; an empty table gives no rows. Scores outside the
64-bit range raise an error; where the primes' product would pass 2**63, the
scores are summed as Python integers instead.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.stages import discard, saved

ANCHOR_EVERY = 100
TOP = 5
#: Anchors in one block and rows in one chunk: one task holds one of each.
ANCHOR_BLOCK = 512
ROW_CHUNK = 20_000
#: Exact float32 sums: d * (p - 1)**2 must stay below this.
EXACT = 2**24

POSITIVE = "anchor_id long, positive_id long, positive_score long"
NEGATIVE = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


@lru_cache(maxsize=64)
def primes_for(dims: int) -> tuple[int, ...]:
    """Primes p, largest first, with dims * (p - 1)**2 < 2**24."""
    limit = int(math.isqrt((EXACT - 1) // max(dims, 1))) + 1
    sieve = np.ones(limit + 1, dtype=bool)
    sieve[:2] = False
    for k in range(2, math.isqrt(limit) + 1):
        if sieve[k]:
            sieve[k * k :: k] = False
    return tuple(int(p) for p in np.flatnonzero(sieve)[::-1])


def exact_scores(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """a @ x.T for integer-valued float64 matrices, exactly, as int64.

    Products modulo primes in float32, then Garner's mixed radix; signed by the
    half of the modulus.
    """
    dims = a.shape[1]
    bound = dims * max(float(np.abs(a).max(initial=0)), 1.0) * max(float(np.abs(x).max(initial=0)), 1.0)
    if bound >= 2**62:
        raise ValueError("scores outside the 64-bit range")
    chosen, modulus = [], 1
    for p in primes_for(dims):
        if modulus > 2 * bound:
            break
        chosen.append(p)
        modulus *= p
    if modulus <= 2 * bound or modulus >= 2**63:
        # The residues would not fit 64 bits: exact integers, slowly (huge components only).
        return (a.astype(np.int64).astype(object) @ x.astype(np.int64).astype(object).T).astype(np.int64)
    value, radix = None, 1
    for p in chosen:
        r = (np.mod(a, p).astype(np.float32) @ np.mod(x, p).astype(np.float32).T).astype(np.int64) % p
        if value is None:
            value = r
        else:
            t = ((r - value % p) % p) * pow(radix % p, -1, p) % p
            value = value + np.int64(radix) * t
        radix *= p
    return np.where(value > modulus // 2, value - np.int64(modulus), value)


def _matrix(vectors: pd.Series) -> np.ndarray:
    if len(vectors) == 0:
        return np.zeros((0, 0))
    return np.floor(256.0 * np.stack([np.asarray(v, dtype=np.float64) for v in vectors]))


def _best(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Indices of the TOP best allowed entries: higher score, then smaller id."""
    where = np.flatnonzero(allowed)
    if len(where) > TOP:
        s = scores[where]
        kth = np.partition(s, len(s) - TOP)[len(s) - TOP]
        where = where[s >= kth]
    order = np.lexsort((ids[where], -scores[where]))
    return where[order[:TOP]]


def _positives(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    if rows.empty or anchors.empty:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in ["anchor_id", "positive_id", "positive_score"]})
    scores = exact_scores(_matrix(anchors["embedding"]), _matrix(rows["embedding"]))
    ids, labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
    out = []
    for k, (aid, alabel) in enumerate(zip(anchors["vec_id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64))):
        pick = _best(scores[k], ids, (labels == alabel) & (ids != aid))
        out.append(pd.DataFrame({"anchor_id": aid, "positive_id": ids[pick], "positive_score": scores[k][pick]}))
    return pd.concat(out, ignore_index=True)


def _negatives(rows: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
    names = ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"]
    if rows.empty or anchors.empty:
        return pd.DataFrame({c: pd.Series(dtype="int64") for c in names})
    scores = exact_scores(_matrix(anchors["embedding"]), _matrix(rows["embedding"]))
    ids, labels = rows["vec_id"].to_numpy(np.int64), rows["label"].to_numpy(np.int64)
    out = []
    for k, (aid, alabel, positives) in enumerate(
        zip(anchors["vec_id"].to_numpy(np.int64), anchors["label"].to_numpy(np.int64), anchors["positives"])
    ):
        other = labels != alabel
        s = scores[k]
        for positive in positives:
            pid, ps = int(positive["positive_id"]), int(positive["positive_score"])
            # 80 * ps <= 100 * s without a product that could pass 64 bits
            pick = _best(s, ids, other & (s >= -(-80 * ps // 100)) & (s <= ps))
            out.append(
                pd.DataFrame(
                    {"anchor_id": aid, "positive_id": pid, "negative_id": ids[pick],
                     "positive_score": ps, "negative_score": s[pick]}
                )
            )
    return pd.concat(out, ignore_index=True) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in names})


def valid_rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding, dims) of the rows that take part, labels shifted."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return embeddings.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite
    ).select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"), F.size("embedding").alias("dims"),
    )


def _dealt(rows: DataFrame, anchors: DataFrame, shape: DataFrame):
    """Rows copied to every anchor block, anchors to every row chunk, of their length.

    The keys have equal types on both sides: a cogroup deals each side by the hash of
    its own type, so an int and a long of equal value would not meet.
    """
    # Fresh columns: both sides come from one table.
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])
    anchors = anchors.select(*[F.col(c).alias(c) for c in anchors.columns])
    r = rows.join(F.broadcast(shape), "dims").select(
        "*", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int").alias("chunk"),
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
    )
    a = anchors.join(F.broadcast(shape), "dims").select(
        "*", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"),
    )
    keys = ["dims", "block", "chunk"]
    return r.drop("blocks", "chunks").groupBy(*keys), a.drop("blocks", "chunks").groupBy(*keys)


def hard_negatives(embeddings: DataFrame) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) as the module says."""
    rows = saved(valid_rows(embeddings), "negatives-rows")
    anchors = rows.where(F.col("vec_id") % ANCHOR_EVERY == 0)
    # One row per vector length: its number of row chunks and anchor blocks.
    shape = (
        rows.groupBy("dims")
        .agg(F.count("*").alias("n"), F.sum((F.col("vec_id") % ANCHOR_EVERY == 0).cast("long")).alias("a"))
        .select(
            "dims", F.greatest(F.lit(1), F.ceil(F.col("n") / ROW_CHUNK)).cast("int").alias("chunks"),
            F.greatest(F.lit(1), F.ceil(F.col("a") / ANCHOR_BLOCK)).cast("int").alias("blocks"),
        )
    )
    shape = saved(shape, "negatives-shape")
    r, a = _dealt(rows, anchors, shape)
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = (
        r.cogroup(a)
        .applyInPandas(_positives, POSITIVE)
        .withColumn("_r", F.row_number().over(best))
        .where(F.col("_r") <= TOP)
        .groupBy("anchor_id")
        .agg(F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    )
    positives = saved(positives, "negatives-positives")
    carried = anchors.join(positives.withColumnRenamed("anchor_id", "vec_id"), "vec_id")
    r, a = _dealt(rows, carried, shape)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    result = saved(
        r.cogroup(a)
        .applyInPandas(_negatives, NEGATIVE)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= TOP)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
        "negatives-result",
    )
    for done in (rows, positives, shape):
        discard(done)
    return result
