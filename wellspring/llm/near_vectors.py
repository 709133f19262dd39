"""Near-duplicate embeddings by a subspace pigeonhole join.

Unit vectors with cosine c are sqrt(2 - 2c) apart. The rotated vectors are split
into blocks of ``BLOCK_DIMS`` dimensions and each block gets a share of the
squared distance in proportion to its dimensions. A pair within the whole
distance is within the share in at least one block, so it is enough to join
every block by range and to check the union of the candidates.

* Each block is joined on a grid over its first dimensions, as wide as its
  share: a vector is at home in one cell and visits half of the neighbours.
* Cells with many vectors are cut into chunks, and pairs of chunks are the units
  of work, so no task holds more than two chunks.
* A pair is counted by the first block in which it is within the share; the
  cosine is then computed in double precision from the given values. Tasks
  return counts and the roots of what is linked locally, never the pairs.
* Equal vectors of one label are one class with a count.

The exact number of links of n different vectors that are all close together
needs n * n / 2 comparisons, however they are found; these are dealt to tasks in
pairs of chunks.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null label, have no links and are kept; vectors of
different length are never linked; an empty table gives no rows. Ids must be
unique and not null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.graph import components
from wellspring.llm.stages import saved

BLOCK_DIMS = 8
GRID_DIMS = 2
CHUNK = 2_000
#: Allowance for rounding when distances are compared with their budget.
SLACK = 1e-9
CELL = ["label", "dims", "block", "x", "y"]


@lru_cache(maxsize=16)
def rotation(dims: int) -> np.ndarray:
    """A fixed random rotation."""
    q, r = np.linalg.qr(np.random.default_rng(dims).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def blocks(dims: int) -> list[np.ndarray]:
    return np.array_split(np.arange(dims), max(1, dims // BLOCK_DIMS))


def budgets(dims: int, cosine: float) -> list[float]:
    return [(2 - 2 * cosine) * len(b) / dims for b in blocks(dims)]


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of one list length as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _rotated(v: np.ndarray) -> np.ndarray:
    # scaled first, so that squares neither overflow nor vanish
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return (v / np.linalg.norm(v, axis=1, keepdims=True)) @ rotation(v.shape[1])


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    lengths = np.diff(batch.column(column).offsets.to_numpy())
    for dims in np.unique(lengths):
        yield np.flatnonzero(lengths == dims), dims


def placed(classes: DataFrame, cosine: float) -> DataFrame:
    """Cells of every class: at home (own) or visiting."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, dims in _by_length(batch, 3):
                rotated = _rotated(_matrix(batch.column(3).take(pa.array(at))))
                own = batch.take(pa.array(at))
                for k, (axes, budget) in enumerate(zip(blocks(dims), budgets(dims, cosine))):
                    width = np.sqrt(budget) * (1 + 1e-6) + 1e-6
                    grid = np.floor(rotated[:, axes[:GRID_DIMS]] / width).astype(np.int32)
                    x, y = grid[:, 0], grid[:, 1] if grid.shape[1] > 1 else np.zeros_like(grid[:, 0])
                    for dx, dy in ((0, 0), (1, -1), (1, 0), (1, 1), (0, 1)):
                        n = len(at)
                        yield pa.RecordBatch.from_arrays(
                            [
                                own.column(1),
                                pa.array(np.full(n, dims, np.int32)),
                                pa.array(np.full(n, k, np.int32)),
                                pa.array(x + np.int32(dx)),
                                pa.array(y + np.int32(dy)),
                                pa.array(np.full(n, not (dx or dy))),
                                own.column(0),
                                own.column(2),
                                own.column(3),
                            ],
                            names=[*CELL, "own", "id", "copies", "v"],
                        )

    kinds = dict(classes.dtypes)
    return classes.select("id", "label", "copies", "v").mapInArrow(
        cells,
        f"label {kinds['label']}, dims int, block int, x int, y int, own boolean, "
        f"id {kinds['id']}, copies long, v {kinds['v']}",
    )


def dealt(cells: DataFrame) -> DataFrame:
    """Rows for each pair of chunks (i, j) of a cell: side 0 is compared with side 1."""
    sizes = (
        cells.groupBy(*CELL)
        .agg(F.count("*").alias("n"), F.max("own").alias("inhabited"))
        .where("inhabited and n > 1")
        .select(*CELL, F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks"))
    )
    rows = cells.join(sizes, CELL).withColumn(
        "chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    )
    every = F.sequence(F.lit(0), F.col("chunks") - 1)
    earlier = F.sequence(F.lit(0), F.col("chunk") - 1)
    left = rows.where("own").withColumn("j", F.explode(every)).withColumn("i", F.col("chunk"))
    right = (
        rows.where("own and chunk > 0").withColumn("i", F.explode(earlier)).withColumn("j", F.col("chunk"))
    )
    visiting = rows.where("not own").withColumn("i", F.explode(every)).withColumn("j", F.col("chunk"))
    keep = [*CELL, "i", "j", "side", "id", "copies", "v"]
    return (
        left.withColumn("side", F.lit(0)).select(keep)
        .unionByName(right.withColumn("side", F.lit(1)).select(keep))
        .unionByName(visiting.withColumn("side", F.lit(1)).select(keep))
    )


def _linked(table: pa.Table, cosine: float) -> pa.Table:
    """Links of one pair of chunks: per vector their number and its local root."""
    ids = table["id"].to_numpy()
    copies = table["copies"].to_numpy()
    v = _matrix(table["v"].combine_chunks())
    k, i, j = (table[c][0].as_py() for c in ("block", "i", "j"))
    dims = v.shape[1]
    axes, budget = blocks(dims), budgets(dims, cosine)
    rotated = _rotated(v)
    side = table["side"].to_numpy()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if i == j:
        right = np.concatenate((left, right))
    found = []
    near = rotated[:, axes[k]]
    squares = (near * near).sum(axis=1)
    for begin in range(0, len(left), 512):
        part = left[begin : begin + 512]
        distance = squares[part][:, None] + squares[right][None, :] - 2 * near[part] @ near[right].T
        a, b = np.nonzero(distance <= budget[k] + 1e-7)
        a, b = part[a], right[b]
        if i == j:  # home vectors meet each other once
            once = (side[b] == 1) | (ids[a] < ids[b])
            a, b = a[once], b[once]
        for at in range(0, len(a), 100_000):
            found.append(_confirmed(v, rotated, a[at : at + 100_000], b[at : at + 100_000], k, axes, budget, cosine))
    a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    n = len(ids)
    links = np.bincount(a, copies[b], n) + np.bincount(b, copies[a], n)
    root = ids.copy()
    while True:
        lower = root.copy()
        np.minimum.at(lower, a, root[b])
        np.minimum.at(lower, b, root[a])
        if (lower == root).all():
            break
        root = lower
    touched = np.flatnonzero(links)
    return pa.table(
        {
            "id": pa.array(ids[touched]),
            "links": pa.array(links[touched].astype(np.int64)),
            "root": pa.array(root[touched]),
        }
    )


def _confirmed(v, rotated, a, b, k, axes, budget, cosine):
    """Pairs that this block is the first to admit and whose cosine is high enough."""
    gap = (rotated[a] - rotated[b]) ** 2
    admit = gap[:, axes[k]].sum(axis=1) <= budget[k] + SLACK
    for earlier in range(k):
        admit &= gap[:, axes[earlier]].sum(axis=1) > budget[earlier] + SLACK
    a, b = a[admit], b[admit]
    dot = np.einsum("ij,ij->i", v[a], v[b])
    size = np.sqrt(np.einsum("ij,ij->i", v[a], v[a])) * np.sqrt(np.einsum("ij,ij->i", v[b], v[b]))
    good = dot / size >= cosine
    return a[good], b[good]


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    cosine: float = 0.93,
) -> DataFrame:
    """key, n_links, component_id and kept for every vector."""
    v = F.col("v")
    rows = saved(
        vectors.select(
            F.col(key).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("v")
        ),
        "vectors",
    )
    bad = F.exists(
        v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    usable = (
        F.col("label").isNotNull()
        & v.isNotNull()
        & ~F.coalesce(bad, F.lit(True))
        & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))
    )
    good = rows.where(usable)
    classes = saved(
        good.groupBy("label", "v").agg(F.min("id").alias("id"), F.count("*").alias("copies")),
        "vector-classes",
    )
    id_kind = dict(rows.dtypes)["id"]
    found = saved(
        dealt(placed(classes, cosine))
        .groupBy(*CELL, "i", "j")
        .applyInArrow(lambda t: _linked(t, cosine), f"id {id_kind}, links long, root {id_kind}"),
        "vector-links",
    )
    labels = components(found.select("id", "root"))
    summed = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = (
        classes.join(summed, "id", "left")
        .join(labels.withColumnRenamed("node", "id"), "id", "left")
        .select(
            "label",
            "v",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("component_id"),
        )
    )
    linked = good.join(known, ["label", "v"]).select("id", "n_links", "component_id")
    alone = rows.where(~usable).select("id", F.lit(0).cast("long"), F.col("id")).toDF(*linked.columns)
    return linked.unionByName(alone).select(
        F.col("id").alias(key),
        "n_links",
        "component_id",
        (F.col("id") == F.col("component_id")).alias("kept"),
    )
