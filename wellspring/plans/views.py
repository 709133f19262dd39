"""Views over the silver tables, for DataFrame users and for SQL."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wellspring.functions.identifiers import normalized_uwi
from wellspring.operators import aggregates
from wellspring.operators.filters import latest_month, producing
from wellspring.operators.sets import activity_feed

Tables = Mapping[str, DataFrame]

ALIAS_SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("ba_code", "raw_name", "canonical_name", "notes")]
)


def production_with_keys(production: DataFrame) -> DataFrame:
    """Production with the key that Saskatchewan wells join on."""
    return production.withColumn(
        "normalized_uwi", normalized_uwi(F.col("province"), F.col("uwi"))
    )


def latest_production(production: DataFrame) -> DataFrame:
    return latest_month(production)


def well_summary(wells: DataFrame, production: DataFrame) -> DataFrame:
    """One row per well with its status and cumulative production."""
    totals = aggregates.cumulative(producing(production))
    nothing = F.lit(0)
    return wells.join(totals, "uwi", "left").select(
        "uwi",
        F.col("name").alias("well_name"),
        "licensee",
        "fluid",
        "mode",
        "province",
        F.col("stat_code").alias("status_code"),
        F.coalesce("total_oil", nothing).alias("cumulative_oil_m3"),
        F.coalesce("total_gas", nothing).alias("cumulative_gas_e3m3"),
        F.coalesce("total_water", nothing).alias("cumulative_water_m3"),
        "first_prod_month",
        "last_prod_month",
        "producing_months",
    )


def operator_scorecard(wells: DataFrame) -> DataFrame:
    return aggregates.scorecard(wells)


def monthly_provincial(production: DataFrame) -> DataFrame:
    """Producing wells and volumes by province and month."""
    return (
        producing(production)
        .groupBy("province", "productionmonth")
        .agg(
            F.countDistinct("uwi").alias("producing_wells"),
            F.sum("oil_prod_vol").cast(aggregates.TOTAL).alias("total_oil_m3"),
            F.sum("gas_prod_vol").cast(aggregates.TOTAL).alias("total_gas_e3m3"),
            F.sum("water_prod_vol").cast(aggregates.TOTAL).alias("total_water_m3"),
        )
    )


def new_activity(licences: DataFrame, spuds: DataFrame, changes: DataFrame) -> DataFrame:
    return activity_feed(licences, spuds, changes)


def operator_groups(wells: DataFrame, aliases: DataFrame) -> DataFrame:
    return aggregates.operator_groups(wells, aliases)


def facilities_by_operator(facilities: DataFrame) -> DataFrame:
    """Facility counts per operator, active and inactive."""
    return (
        facilities.where("operator_name is not null")
        .groupBy("operator_name")
        .agg(
            F.count(F.lit(1)).alias("facility_count"),
            F.count_if(F.col("is_active")).alias("active_count"),
            F.count_if(~F.col("is_active")).alias("inactive_count"),
        )
    )


def alias_tables(tables: Tables) -> dict[str, DataFrame]:
    """``wells`` falls back on ``well_attributes``; licences have two names."""
    out = dict(tables)
    if "wells" not in out and "well_attributes" in out:
        out["wells"] = out["well_attributes"]
    if "well_licences" in out:
        out["licence_activity"] = out["well_licences"]
    return out


def all_views(tables: Tables, spark: SparkSession) -> dict[str, DataFrame]:
    """Every table and every view the given tables allow, by published name."""
    out = alias_tables(tables)
    out.setdefault("operator_aliases", spark.createDataFrame([], ALIAS_SCHEMA))
    if "production" in out:
        out["production"] = production_with_keys(out["production"])
    views = {
        "v_latest_production": (latest_production, ["production"]),
        "v_well_summary": (well_summary, ["wells", "production"]),
        "v_operator_scorecard": (operator_scorecard, ["wells"]),
        "v_monthly_provincial": (monthly_provincial, ["production"]),
        "v_new_activity": (new_activity, ["well_licences", "spud_activity", "status_changes"]),
        "operator_groups": (operator_groups, ["wells", "operator_aliases"]),
        "facilities_by_operator": (facilities_by_operator, ["facilities"]),
    }
    for name, (build, needs) in views.items():
        if all(n in out for n in needs):
            out[name] = build(*[out[n] for n in needs])
    return out
