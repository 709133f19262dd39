"""Aggregations behind the silver tables and the views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import PRODUCTS
from wellspring.functions.text import first_token, normalize_operator
from wellspring.functions.values import coerce_num
from wellspring.operators.joins import apply_aliases

TOTAL = "decimal(28,3)"


def pivot_products(df: DataFrame, keys=("productionmonth", "uwi", "province")) -> DataFrame:
    """One row per well and month with a column per product, 0 when missing.

    Products other than oil, gas and water add no column but keep the row. A
    conditional sum per product needs one shuffle, where ``pivot`` would
    aggregate twice.
    """
    volume = coerce_num(F.col("volume"))
    return df.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("productid") == product, volume)), F.lit(0))
            .cast(TOTAL)
            .alias(column)
            for product, column in PRODUCTS.items()
        ]
    )


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def scorecard(wells: DataFrame) -> DataFrame:
    """Well counts per operator code by status and fluid."""
    mode, fluid = F.col("mode"), F.col("fluid")
    return (
        wells.where(F.trim("licensee") != "")
        .groupBy(F.trim("licensee").alias("operator_code"))
        .agg(
            F.count(F.lit(1)).alias("total_wells"),
            count_where(mode != "ABD").alias("active_wells"),
            count_where(mode == "ABD").alias("abandoned_wells"),
            count_where(fluid.like("CR%")).alias("crude_wells"),
            count_where(fluid == "GAS").alias("gas_wells"),
        )
    )


def cumulative(production: DataFrame, keys=("uwi",)) -> DataFrame:
    """Totals and first/last producing month per key, over all time."""
    return production.groupBy(*keys).agg(
        F.sum("oil_prod_vol").cast(TOTAL).alias("total_oil"),
        F.sum("gas_prod_vol").cast(TOTAL).alias("total_gas"),
        F.sum("water_prod_vol").cast(TOTAL).alias("total_water"),
        F.min("productionmonth").alias("first_prod_month"),
        F.max("productionmonth").alias("last_prod_month"),
        F.countDistinct("productionmonth").alias("producing_months"),
    )


def most_common(name: str, count: str) -> Column:
    """Aggregate: the name with the largest count, the first in order on a tie."""
    return F.min_by(F.col(name), F.struct((-F.col(count)).alias("n"), F.col(name)))


def mode_name(wells: DataFrame) -> DataFrame:
    """Most common first word of the well names per operator code."""
    counted = (
        wells.where((F.trim("licensee") != "") & (F.trim("name") != ""))
        .groupBy(
            F.trim("licensee").alias("ba_code"), first_token(F.col("name")).alias("operator_name")
        )
        .agg(F.count(F.lit(1)).alias("well_count"))
        .where(F.length("operator_name") > 1)
    )
    return counted.groupBy("ba_code").agg(
        most_common("operator_name", "well_count").alias("primary_name"),
        F.sum("well_count").alias("total_wells"),
    )


def operator_groups(wells: DataFrame, aliases: DataFrame) -> DataFrame:
    """Operators under one normalised name, with their codes and well counts.

    Both levels work on pre-aggregated rows: one per (code, name), then one per
    code. The code list of an operator holds each registered code once.
    """
    primary = mode_name(wells).withColumn(
        "normalized_name", normalize_operator(F.col("primary_name"))
    )
    named = apply_aliases(primary, aliases, "normalized_name").where(
        F.col("normalized_name") != ""
    )
    return named.groupBy("normalized_name").agg(
        most_common("primary_name", "total_wells").alias("display_name"),
        F.sum("total_wells").alias("total_wells"),
        F.array_join(F.array_sort(F.collect_set("ba_code")), ",").alias("ba_codes"),
        F.count(F.lit(1)).alias("ba_code_count"),
    )


def distinct_keys(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()
