"""Enrichment joins.

No join carries a broadcast hint: the smaller side is chosen from its measured
size (the session's broadcast threshold at plan time, adaptive execution at
run time), and beyond the threshold the same plan sort-merges with skew
splitting. Each right side is reduced to one row per key first, so a join
never multiplies rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.functions.identifiers import legal_key
from wellspring.operators.keyed import latest_by


HEADER_ROWS = 50_000
BLOCK_ROWS = 1_000_000


def broadcast_up_to(df: DataFrame, rows: int | None, limit: int) -> DataFrame:
    """Broadcast a table whose row count is known and small; else leave it be.

    For lookups that are derived from the big side itself, which the planner
    takes to be as big as that side.
    """
    return F.broadcast(df) if rows is not None and rows <= limit else df


def enrich_geo(df: DataFrame, geo: DataFrame) -> DataFrame:
    """Facility coordinates by facility_id."""
    one_each = geo.groupBy("facility_id").agg(
        F.min_by("centroid_lat", F.struct("centroid_lat", "centroid_lon")).alias("centroid_lat"),
        F.min_by("centroid_lon", F.struct("centroid_lat", "centroid_lon")).alias("centroid_lon"),
    )
    return df.join(one_each, "facility_id", "left")


def enrich_confidential(wells: DataFrame, confidential: DataFrame) -> DataFrame:
    """Confidentiality flags per well; wells never listed are not confidential."""
    flags = ["was_ever_confidential", "is_currently_confidential"]
    extra = [c for c in ["release_date"] if c in confidential.columns]
    joined = wells.join(confidential.select("uwi", *flags, *extra), "uwi", "left")
    return joined.withColumns({f: F.coalesce(F.col(f), F.lit(False)) for f in flags})


def enrich_status(wells: DataFrame, events: DataFrame) -> DataFrame:
    """Date of the newest status event; the list's own date fills the gaps."""
    newest = events.groupBy("uwi").agg(F.max("event_date").alias("_event_date"))
    own = F.col("stat_date") if "stat_date" in wells.columns else F.lit(None).cast("date")
    return (
        wells.join(newest, "uwi", "left")
        .withColumn("stat_date", F.coalesce("_event_date", own))
        .drop("_event_date")
    )


WELL_COLUMNS = {
    "centroid_lat": "centroid_lat",
    "centroid_lon": "centroid_lon",
    "licensee": "well_licensee",
    "name": "well_name",
}


def enrich_wells(events: DataFrame, wells: DataFrame) -> DataFrame:
    """Coordinates, licensee and name of the well an event is about."""
    have = {c: n for c, n in WELL_COLUMNS.items() if c in wells.columns}
    one_each = latest_by(wells, ["uwi"], [F.col("province"), *sorted(have)]).select(
        "uwi", *[F.col(c).alias(n) for c, n in have.items()]
    )
    taken = [n for n in have.values() if n in events.columns]
    return events.drop(*taken).join(one_each, "uwi", "left")


def fact_dim(production: DataFrame, wells: DataFrame) -> DataFrame:
    """Production rows with their well (inner, on uwi)."""
    return production.join(wells.drop("province"), "uwi")


def totals_with_wells(
    production: DataFrame, wells: DataFrame, keys: list[str], **totals: Column
) -> DataFrame:
    """Aggregate production per well and ``keys`` first, then join the wells.

    Sums and counts over the join equal those over the pre-aggregated rows, and
    only one row per well and key reaches the join.
    """
    reduced = production.groupBy("uwi", *keys).agg(*[c.alias(n) for n, c in totals.items()])
    return reduced.join(wells, "uwi")


def same_legal(licences: DataFrame, wells: DataFrame) -> DataFrame:
    """Licences with the other wells on their legal location, summarised.

    A location may hold many wells and many licences, so the pairs are never
    listed: wells are counted per location and the licence's own well is taken
    off. Returns the licences that have at least one other well.
    """
    own = wells.groupBy("uwi").agg(F.count(F.lit(1)).alias("_own"))
    on_legal = (
        wells.withColumn("legal", legal_key(F.col("uwi")))
        .groupBy("legal")
        .agg(F.count(F.lit(1)).alias("_all"))
    )
    return (
        licences.withColumn("legal", legal_key(F.col("uwi")))
        .join(on_legal, "legal")
        .join(own, "uwi", "left")
        .withColumn("other_wells", F.col("_all") - F.coalesce("_own", F.lit(0)))
        .where("other_wells > 0")
        .drop("_all", "_own")
    )


def apply_aliases(operators: DataFrame, aliases: DataFrame, name: str) -> DataFrame:
    """Override an operator name where the code has an alias."""
    lookup = aliases.select(F.trim("ba_code").alias("ba_code"), "canonical_name")
    return (
        operators.join(lookup, "ba_code", "left")
        .withColumn(name, F.coalesce("canonical_name", name))
        .drop("canonical_name")
    )


def not_in(df: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """SQL ``NOT IN``: an anti join that also honours nulls.

    One null among the keys empties the result; a null on the left is never
    "not in" a non-empty list. Unlike the built-in null-aware anti join, this
    one does not need the keys to fit a broadcast.
    """
    null_keys = keys.where(F.col(column).isNull()).select(F.count(F.lit(1))).scalar()
    all_keys = keys.select(F.count(F.lit(1))).scalar()
    return df.join(keys.select(column), column, "left_anti").where(
        (null_keys == 0) & (F.col(column).isNotNull() | (all_keys == 0))
    )
