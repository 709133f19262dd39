"""Queries over the data-quality checks."""

from pyspark.sql import functions as F

from wellspring.contracts import Contract
from wellspring.operators.filters import max_of
from wellspring.plans import quality
from wellspring.registry import query

PRODUCTION = Contract(
    "production", "AB", "monthly", ("from_to_id", "productionmonth", "activityid", "productid"),
    ("productionmonth", "activityid", "productid", "volume"),
    ("productionmonth", "activityid", "productid", "volume", "hours_on"), min_rows=1000,
)
FACILITIES = Contract(
    "facilities", "AB", "monthly", ("facility_id", "snapshot_date"),
    ("facility_id", "operator_name", "sub_type"), min_rows=10**12,
)
WELLS = Contract("wells", "AB", "monthly", ("uwi",), ("uwi", "snapshot_date", "well_name"))


def verdict(dataset: str, name: str, passed: str, measure: str, detail: str, source: str) -> str:
    return (
        f"select '{dataset}' as dataset, '{name}' as \"check\", {passed} as passed,"
        f" cast({measure} as double) as measure, {detail} as detail from {source}"
    )


def volumes(t):
    df = t("volumetric")
    return df, max_of(df, "snapshot_date")


Q1 = verdict("production", "required_columns", "true", "0", "''", "(select 1)")
Q2 = verdict(
    "production", "schema_drift", "false", "1",
    "'missing hours_on; extra from_to_id,l_linenumber,l_orderkey,uwi'", "(select 1)",
)
Q3 = verdict(
    "production", "primary_key_uniqueness", "sum(n) = 0", "sum(n)",
    "'from_to_id,productionmonth,activityid,productid'",
    """(select if(count(*) > 1, count(*), 0) as n from {volumetric}
       group by from_to_id, productionmonth, activityid, productid)""",
)
Q4 = verdict("production", "min_rows", "count(*) >= 1000", "count(*)", "'1000'", "{volumetric}")
Q5 = verdict(
    "production", "date_range", "true",
    "max(substr(productionmonth, 1, 7) || '-01')::date - min(productionmonth || '-01')::date",
    "min(productionmonth) || '-01 to ' || max(productionmonth) || '-01'", "{volumetric}",
)
Q6 = verdict(
    "facilities", "null_rates", "avg(if(operator_name is null, 1, 0)) <= 0.5",
    "sum(if(operator_name is null, 1, 0))::double / count(*)::double", "''", "{facility_snapshots}",
)
UWI_SHARE = """avg(cast(regexp_full_match(uwi,
  '[0-9]{2}/[0-9]{2}-[0-9]{2}-[0-9]{3}-[0-9]{2}W[0-9]/[0-9]+') as int))"""
Q8 = verdict(
    "production", "uwi_format", f"{UWI_SHARE} >= 0.5", UWI_SHARE, "''", "{volumetric}"
)
Q9 = verdict(
    "production", "date_sanity",
    "count(*) filter (where snapshot_date > date '1998-06-01' + 60) = 0",
    """count(*) filter (where snapshot_date > date '1998-06-01' + 60)
      + count(*) filter (where cast(productionmonth || '-01' as date) > date '1998-06-01' + 60)""",
    "'future_productionmonth,future_snapshot_date'", "{volumetric}",
)
Q11 = verdict(
    "wells", "stale_snapshot", "false", "date '2024-12-01' - max(snapshot_date)::date", "''",
    "{well_snapshots}",
)
Q12 = verdict(
    "facilities", "coordinate_coverage", "true",
    "sum(if(facility_id in (select facility_id from {facility_geo}), 1, 0))::double"
    " / count(*)::double",
    "''", "{facility_snapshots}",
)


@query("q1_required_columns", Q1)
def q1(t):
    df, as_of = volumes(t)
    return quality.check(df, PRODUCTION, "required_columns", as_of)


@query("q2_schema_drift", Q2)
def q2(t):
    df, as_of = volumes(t)
    return quality.check(df, PRODUCTION, "schema_drift", as_of)


@query("q3_primary_key", Q3)
def q3(t):
    df, as_of = volumes(t)
    return quality.check(df, PRODUCTION, "primary_key_uniqueness", as_of)


@query("q4_min_rows", Q4)
def q4(t):
    df, as_of = volumes(t)
    return quality.check(df, PRODUCTION, "min_rows", as_of)


@query("q5_date_range", Q5)
def q5(t):
    df, as_of = volumes(t)
    return quality.check(df, PRODUCTION, "date_range", as_of)


@query("q6_null_rates", Q6)
def q6(t):
    df = t("facility_snapshots")
    return quality.check(df, FACILITIES, "null_rates", max_of(df, "snapshot_date"))


@query(
    "q7_row_count_drift",
    """with n as (select snapshot_date, count(*) as n from {well_snapshots} group by 1),
      p as (select *, lag(n) over (order by snapshot_date) as previous from n)
    select snapshot_date, n, cast(previous as double) as previous,
      abs(n - previous)::double / previous::double * 100 as measure, coalesce(abs(n - previous)::double / previous::double * 100 <= 0.1, true) as passed from p""",
)
def q7(t):
    drift = quality.snapshot_drift(t("well_snapshots"), 0.1)
    return drift.withColumn("previous", F.col("previous").cast("double"))


@query("q8_uwi_format", Q8)
def q8(t):
    df, as_of = volumes(t)
    return quality.check(df, PRODUCTION, "uwi_format", as_of)


@query("q9_date_sanity", Q9)
def q9(t):
    return quality.check(
        t("volumetric"), PRODUCTION, "date_sanity", F.lit("1998-06-01").cast("date")
    )


REPORT = " union all ".join([Q1, Q2, Q3, Q4, Q5]) + " union all " + " union all ".join(
    [
        verdict("production", "null_rates", "true", "0", "''", "(select 1)"),
        verdict(
            "production", "row_count_drift", "true", "0",
            "''", "(select 1)",
        ),
        Q8, Q9,
        verdict(
            "production", "stale_snapshot", "true",
            "date '1998-06-01' - max(snapshot_date)", "''", "{volumetric}",
        ),
        verdict(
            "production", "coordinate_coverage", "true", "null", "'no coordinates'", "(select 1)"
        ),
    ]
)


@query("q10_report", f"select *, false as all_passed from ({REPORT})")
def q10(t):
    df = t("volumetric")
    return quality.report(df, PRODUCTION, F.lit("1998-06-01").cast("date"), previous=df)


@query("q11_stale_snapshot", Q11)
def q11(t):
    return quality.check(
        t("well_snapshots"), WELLS, "stale_snapshot", F.lit("2024-12-01").cast("date")
    )


@query("q12_coordinate_coverage", Q12)
def q12(t):
    from wellspring.operators.joins import enrich_geo

    df = t("facility_snapshots")
    located = enrich_geo(df, t("facility_geo"))
    return quality.check(
        located, FACILITIES, "coordinate_coverage", max_of(df, "snapshot_date")
    )
