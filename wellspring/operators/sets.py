"""Unions, top-k and schema differences."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def union_all(*tables: DataFrame) -> DataFrame:
    """Rows of all tables, matched by column name; absent columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def top_k(
    df: DataFrame, by: Sequence[Column | str], k: int, tiebreak: Sequence[Column | str]
) -> DataFrame:
    """The first k rows; each task keeps k rows, so nothing is fully sorted."""
    return df.orderBy(*by, *tiebreak).limit(k)


def activity_feed(licences: DataFrame, spuds: DataFrame, changes: DataFrame) -> DataFrame:
    """Licences, spuds and status changes as one list of dated events."""

    def events(df: DataFrame, kind: str, *dates: str) -> DataFrame:
        present = [F.col(d).cast("date") for d in dates if d in df.columns]
        return df.select(
            "uwi", F.lit(kind).alias("event_type"), F.coalesce(*present).alias("event_date")
        ).where("event_date is not null")

    return union_all(
        events(licences, "licence", "issue_date", "issued_date"),
        events(spuds, "spud", "spud_date"),
        events(changes, "status_change", "event_date"),
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of every table, in one job."""
    return union_all(
        *[
            df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
            for name, df in tables.items()
        ]
    )


def missing_and_extra(
    columns: Iterable[str], expected: Iterable[str], ignored: Iterable[str] = ()
) -> tuple[list[str], list[str]]:
    """Columns that are missing and columns nobody expected, both sorted."""
    have, want = set(columns), set(expected)
    return sorted(want - have), sorted(have - want - set(ignored))
