"""Shards of near equal bytes: the minimax contiguous partition of text groups.

Rows with equal texts form a group that stays in one shard. Groups are ordered
by the digest of their text and cut into consecutive runs, one run per shard,
so that the largest run is as small as any such cut allows. The smallest
feasible capacity is searched between its bounds; a capacity is feasible if
filling shard after shard greedily uses no more shards than there are.

A run ends at a digest, so the shard of a row is a comparison of its digest
with at most ``shards - 1`` constants: rows are never joined to groups, and a
group that holds a third of the rows is one row of the group table.

Defined results: a null text is the empty text (size 1, crc of no bytes); rows
with null ids are kept and placed like others; an empty table gives no rows;
with fewer groups than shards the last shards stay empty. A single group larger
than a fair share sets the capacity, as it cannot be cut.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspring.llm.stages import saved

#: Hexadecimal digits of the digest that name a block of groups. The sums of
#: the 16**4 blocks are the only thing the driver holds.
BLOCK_DIGITS = 4
#: Capacities tried in one pass over the looked-up blocks.
CANDIDATES = 128
#: Rows numbered together when slots are given out.
CELL_ROWS = 50_000

DIGEST, SIZE, CRC = "_digest", "_size", "_crc"


def measured(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Id, size, checksum and digest of each row; the text itself goes no further."""
    content = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key),
        (F.octet_length(content).cast("long") + 1).alias(SIZE),
        F.crc32(content.cast("binary")).alias(CRC),
        F.sha2(content, 256).alias(DIGEST),
    )


def group_sizes(rows: DataFrame) -> DataFrame:
    """One row per group: digest, size, block, and bytes up to its end within the block."""
    groups = rows.groupBy(DIGEST).agg(F.sum(SIZE).alias("bytes"))
    groups = groups.withColumn("block", F.substring(DIGEST, 1, BLOCK_DIGITS))
    within = Window.partitionBy("block").orderBy(DIGEST)
    return groups.withColumn(
        "upto", F.sum("bytes").over(within.rowsBetween(Window.unboundedPreceding, 0))
    )


class Layout:
    """Prefix sums of the ordered groups, looked up block by block."""

    def __init__(self, groups: DataFrame):
        self.groups = groups
        blocks = (
            groups.groupBy("block")
            .agg(F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"))
            .orderBy("block")
            .collect()  # at most 16 ** BLOCK_DIGITS rows
        )
        self.names = [b["block"] for b in blocks]
        self.starts = [0]
        for b in blocks:
            self.starts.append(self.starts[-1] + b["bytes"])
        self.total = self.starts[-1]
        self.largest = max((b["largest"] for b in blocks), default=0)

    def ends_before(self, limits: list[int]) -> dict[int, tuple[int, str | None]]:
        """For each limit the last group end not beyond it, with that group's digest."""
        inside: dict[int, tuple[str, int]] = {}
        found: dict[int, tuple[int, str | None]] = {}
        for limit in set(limits):
            if limit >= self.total:
                found[limit] = (self.total, None)
                continue
            k = bisect_right(self.starts, limit) - 1
            inside[limit] = (self.names[k], self.starts[k])
        if inside:
            spark = self.groups.sparkSession
            asked = spark.createDataFrame(
                [(limit, name, limit - start, start) for limit, (name, start) in inside.items()],
                "limit long, block string, room long, start long",
            )
            blocks = sorted({name for name, _ in inside.values()})
            own = self.groups.where(F.col("block").isin(blocks)).select("block", DIGEST, "upto")
            best = (
                own.join(F.broadcast(asked), "block")  # at most CANDIDATES rows
                .where("upto <= room")
                .groupBy("limit", "start")
                .agg(F.max("upto").alias("upto"), F.max(DIGEST).alias("digest"))
                .collect()
            )
            for limit, (name, start) in inside.items():
                found[limit] = (start, None)
            for b in best:
                found[b["limit"]] = (b["start"] + b["upto"], b["digest"])
        return found

    def feasible(self, capacities: list[int], shards: int) -> list[bool]:
        """Whether filling greedily up to each capacity needs no more than so many shards."""
        at = dict.fromkeys(capacities, 0)
        for _ in range(shards - 1):
            limits = {c: at[c] + c for c in capacities if at[c] < self.total}
            if not limits:
                break
            ends = self.ends_before(list(limits.values()))
            for c, limit in limits.items():
                at[c] = ends[limit][0]
        return [self.total - at[c] <= c for c in capacities]

    def capacity(self, shards: int) -> int:
        """The smallest feasible capacity."""
        fair = -(-self.total // shards)
        low = max(fair, self.largest)  # nothing below can do
        high = fair + self.largest  # always enough
        while low < high:
            step = max(1, (high - low) // CANDIDATES)
            tried = list(range(low, high, step))[:CANDIDATES]
            good = self.feasible(tried, shards)
            if True in good:
                k = good.index(True)
                high = tried[k]
                low = tried[k - 1] + 1 if k else tried[k]
            else:
                low = tried[-1] + 1
        return high

    def cuts(self, shards: int) -> list[tuple[int, str]]:
        """Bytes before and first possible digest after each cut, as (end, last digest)."""
        capacity, at, cuts = self.capacity(shards), 0, []
        while self.total - at > capacity:
            end, digest = self.ends_before([at + capacity])[at + capacity]
            if digest is None:  # the limit falls on the first group of a block
                k = self.starts.index(end)
                digest = self.names[k - 1] + "g"  # above every digest of the block before
            cuts.append((end, digest))
            at = end
        return cuts


def shard_of(digest: Column, cuts: list[str]) -> Column:
    """Number of cuts below the digest."""
    shard = F.lit(0)
    for last in cuts:
        shard = shard + (digest > F.lit(last)).cast("int")
    return shard


def slots(rows: DataFrame, key: str, cells: int) -> DataFrame:
    """Number the rows of each shard from 0 without gaps.

    Rows are numbered inside cells picked by the hash of their id, which spreads
    a shard that holds most rows; cell totals give where each cell begins.
    """
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(F.col(key), F.col(DIGEST)), F.lit(cells)))
    totals = rows.groupBy("shard", "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("shard").orderBy("_cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    begins = totals.withColumn("_begin", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    place = F.row_number().over(Window.partitionBy("shard", "_cell").orderBy(key, DIGEST))
    return (
        rows.withColumn("_place", place.cast("long") - 1)
        .join(begins, ["shard", "_cell"])
        .withColumn("slot", F.col("_begin") + F.col("_place"))
        .drop("_cell", "_begin", "_place")
    )


def shard(docs: DataFrame, shards: int = 8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard and slot of every row: key, size, text_crc32, shard, slot."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    rows = saved(measured(docs, key, text), "sharding-rows")
    groups = saved(group_sizes(rows), "sharding-groups")
    cuts = [digest for _, digest in Layout(groups).cuts(shards)]
    placed = rows.withColumn("shard", shard_of(F.col(DIGEST), cuts).cast("int"))
    cells = max(1, rows.count() // (shards * CELL_ROWS) + 1) * 16
    return slots(placed, key, cells).select(
        key, F.col(SIZE).alias("size"), F.col(CRC).alias("text_crc32"), "shard", "slot"
    )
