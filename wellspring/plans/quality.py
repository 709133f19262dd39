"""Data-quality checks, all of them in one pass over the data.

A check names the measures it needs and turns them into a verdict. The
measures of all requested checks are computed together: rows are first
aggregated per primary key (which finds duplicates and pre-reduces hot keys),
then over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import (
    EARLIEST_DATE,
    FUTURE_DAYS_ALLOWED,
    MAX_NULL_SHARE,
    MIN_UWI_SHARE,
    STALE_AFTER_DAYS,
    UWI_DISPLAY,
)
from wellspring.contracts import Contract
from wellspring.functions.values import DATE_FORMATS, coerce_date
from wellspring.operators.keyed import Window
from wellspring.operators.sets import missing_and_extra

COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}
DATE_FORMATS_WITH_MONTH = (*DATE_FORMATS, "yyyy-MM")


@dataclass(frozen=True)
class Subject:
    """What is checked: a table, its contract and the date of the check."""

    df: DataFrame
    contract: Contract
    as_of: Column
    previous: DataFrame | None = None

    @property
    def date_columns(self) -> list[str]:
        return [c for c in self.df.columns if "date" in c.lower() or "month" in c.lower()]

    def as_date(self, column: str) -> Column:
        if dict(self.df.dtypes)[column] == "string":
            return coerce_date(F.col(column), DATE_FORMATS_WITH_MONTH)
        return F.col(column).cast("date")

    @property
    def required_present(self) -> list[str]:
        return [c for c in self.contract.required if c in self.df.columns]


# measure name -> (how to combine, value per row)
Measures = dict[str, tuple[str, Column]]


@dataclass(frozen=True)
class Check:
    name: str
    measures: Callable[[Subject], Measures]
    # passed, measure, detail
    verdict: Callable[[Subject], tuple[Column, Column, Column]]


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0).cast("bigint")


def _count_of(n: int) -> Column:
    return F.lit(n).cast("bigint")


def _required(s: Subject):
    missing, _ = missing_and_extra(s.df.columns, s.contract.required)
    return F.lit(not missing), _count_of(len(missing)), F.lit(",".join(missing))


def _drift(s: Subject):
    missing, extra = missing_and_extra(s.df.columns, s.contract.expected, s.contract.added)
    detail = f"missing {','.join(missing)}; extra {','.join(extra)}"
    return F.lit(not missing), _count_of(len(missing)), F.lit(detail if missing else "")


def _unique(s: Subject):
    if any(k not in s.df.columns for k in s.contract.keys):
        return F.lit(False), F.lit(None), F.lit("key columns not found")
    n = F.col("duplicate_rows")
    return n == 0, n, F.lit(",".join(s.contract.keys))


def _min_rows(s: Subject):
    return F.col("rows") >= s.contract.min_rows, F.col("rows"), F.lit(str(s.contract.min_rows))


def _range_measures(s: Subject) -> Measures:
    if not s.date_columns:
        return {}
    date = s.as_date(s.date_columns[0])
    return {"first_date": ("min", date), "last_date": ("max", date)}


def _range(s: Subject):
    if not s.date_columns:
        return F.lit(True), F.lit(None), F.lit("no date column")
    days = F.datediff("last_date", "first_date")
    text = F.concat_ws(" to ", F.col("first_date").cast("string"), F.col("last_date").cast("string"))
    return F.lit(True), days, text


def _null_measures(s: Subject) -> Measures:
    return {f"null_{c}": ("sum", _flag(F.col(c).isNull())) for c in s.required_present}


def _nulls(s: Subject):
    names = s.required_present
    if not names:
        return F.lit(True), F.lit(0.0), F.lit("")
    shares = [F.col(f"null_{c}") / F.nullif(F.col("rows"), F.lit(0)) for c in names]
    worst = F.greatest(*shares, F.lit(0.0))
    high = [F.when(share > MAX_NULL_SHARE, F.lit(c)) for c, share in zip(names, shares)]
    return worst <= MAX_NULL_SHARE, worst, F.concat_ws(",", *high)


def _rows_drift(s: Subject):
    if s.previous is None:
        return F.lit(True), F.lit(None), F.lit("no previous snapshot")
    before = s.previous.select(F.count(F.lit(1))).scalar()
    pct = F.abs(F.col("rows") - before) / F.nullif(before, F.lit(0).cast("bigint")) * 100
    return F.coalesce(pct <= s.contract.max_row_delta_pct, F.lit(True)), pct, F.lit("")


def _uwi_measures(s: Subject) -> Measures:
    if "uwi" not in s.df.columns:
        return {}
    uwi = F.col("uwi")
    return {
        "uwis": ("sum", _flag(uwi.isNotNull())),
        "valid_uwis": ("sum", _flag(F.coalesce(uwi.rlike(UWI_DISPLAY), F.lit(False)))),
    }


def _uwi(s: Subject):
    if "uwi" not in s.df.columns:
        return F.lit(True), F.lit(None), F.lit("no uwi column")
    share = F.col("valid_uwis") / F.nullif(F.col("uwis"), F.lit(0))
    return F.coalesce(share >= MIN_UWI_SHARE, F.lit(True)), share, F.lit("")


def _sanity_measures(s: Subject) -> Measures:
    out: Measures = {}
    for c in s.date_columns:
        date = s.as_date(c)
        out[f"future_{c}"] = ("sum", _flag(date > F.date_add(s.as_of, FUTURE_DAYS_ALLOWED)))
        out[f"ancient_{c}"] = ("sum", _flag(date < F.lit(EARLIEST_DATE).cast("date")))
    return out


def _sanity(s: Subject):
    names = list(_sanity_measures(s))
    if not names:
        return F.lit(True), _count_of(0), F.lit("no date column")
    total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    found = [F.when(F.col(n) > 0, F.lit(n)) for n in names]
    return total == 0, total, F.concat_ws(",", *found)


def _stale_measures(s: Subject) -> Measures:
    if "snapshot_date" not in s.df.columns:
        return {}
    return {"newest_snapshot": ("max", F.col("snapshot_date").cast("date"))}


def _stale(s: Subject):
    if "snapshot_date" not in s.df.columns:
        return F.lit(True), F.lit(None), F.lit("no snapshot date")
    age = F.datediff(s.as_of, F.col("newest_snapshot"))
    return F.coalesce(age <= STALE_AFTER_DAYS, F.lit(True)), age, F.lit("")


def _coverage_measures(s: Subject) -> Measures:
    if "centroid_lat" not in s.df.columns:
        return {}
    return {"located": ("sum", _flag(F.col("centroid_lat").isNotNull()))}


def _coverage(s: Subject):
    if "centroid_lat" not in s.df.columns:
        return F.lit(True), F.lit(None), F.lit("no coordinates")
    return F.lit(True), F.col("located") / F.nullif(F.col("rows"), F.lit(0)), F.lit("")


def _nothing(_: Subject) -> Measures:
    return {}


CHECKS = {
    c.name: c
    for c in [
        Check("required_columns", _nothing, _required),
        Check("schema_drift", _nothing, _drift),
        Check("primary_key_uniqueness", _nothing, _unique),
        Check("min_rows", _nothing, _min_rows),
        Check("date_range", _range_measures, _range),
        Check("null_rates", _null_measures, _nulls),
        Check("row_count_drift", _nothing, _rows_drift),
        Check("uwi_format", _uwi_measures, _uwi),
        Check("date_sanity", _sanity_measures, _sanity),
        Check("stale_snapshot", _stale_measures, _stale),
        Check("coordinate_coverage", _coverage_measures, _coverage),
    ]
}


def run_checks(subject: Subject, names: Sequence[str] = tuple(CHECKS)) -> DataFrame:
    """One row per check: dataset, check, passed, measure, detail."""
    checks = [CHECKS[n] for n in names]
    measures: Measures = {"rows": ("sum", F.lit(1).cast("bigint"))}
    for check in checks:
        measures |= check.measures(subject)
    per_row = [COMBINE[how](value).alias(n) for n, (how, value) in measures.items()]
    totals = [COMBINE[how](n).alias(n) for n, (how, _) in measures.items()]
    keys = subject.contract.keys
    by_key = "primary_key_uniqueness" in names and all(k in subject.df.columns for k in keys)
    if by_key and keys:
        duplicated = F.sum(F.when(F.col("rows") > 1, F.col("rows")).otherwise(0))
        stats = subject.df.groupBy(*[F.col(k).alias(f"_key_{k}") for k in keys]).agg(*per_row)
        stats = stats.agg(*totals, duplicated.alias("duplicate_rows"))
    else:
        stats = subject.df.agg(*per_row).withColumn("duplicate_rows", F.lit(0))
    counts = [n for n, (how, _) in measures.items() if how == "sum"]
    stats = stats.withColumns(
        {n: F.coalesce(n, F.lit(0)) for n in [*counts, "duplicate_rows"]}
    )
    rows = []
    for check in checks:
        passed, measure, detail = check.verdict(subject)
        rows.append(
            F.struct(
                F.lit(subject.contract.id).alias("dataset"),
                F.lit(check.name).alias("check"),
                passed.alias("passed"),
                measure.cast("double").alias("measure"),
                detail.alias("detail"),
            )
        )
    return stats.select(F.inline(F.array(*rows)))


def check(
    df: DataFrame, contract: Contract, name: str, as_of: Column, previous: DataFrame | None = None
) -> DataFrame:
    """A single check as a one-row table."""
    return run_checks(Subject(df, contract, as_of, previous), [name])


def report(
    df: DataFrame, contract: Contract, as_of: Column, previous: DataFrame | None = None
) -> DataFrame:
    """Every check, each row also telling whether all of them passed."""
    rows = run_checks(Subject(df, contract, as_of, previous))
    return rows.withColumn(
        "all_passed", F.bool_and("passed").over(Window.partitionBy("dataset"))
    )


def snapshot_drift(df: DataFrame, max_delta_pct: float, snapshot: str = "snapshot_date") -> DataFrame:
    """Row count of every snapshot against the one before."""
    counts = df.groupBy(snapshot).agg(F.count(F.lit(1)).alias("n"))
    before = F.lag("n").over(Window.orderBy(snapshot))
    pct = F.abs(F.col("n") - F.col("previous")) / F.nullif(F.col("previous"), F.lit(0)) * 100
    return (
        counts.withColumn("previous", before)
        .withColumn("measure", pct)
        .withColumn("passed", F.coalesce(F.col("measure") <= max_delta_pct, F.lit(True)))
    )


def write_report(rows: DataFrame, path: str) -> None:
    """Append the report as JSON, one directory per dataset."""
    rows.withColumn("checked_at", F.current_timestamp()).write.mode("append").partitionBy(
        "dataset"
    ).json(path)
