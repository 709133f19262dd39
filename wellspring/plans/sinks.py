"""Writing bronze and silver tables, publishing views, exporting.

Partitioned writes ask for a rebalance on their partition columns: adaptive
execution merges small partitions and splits those that hold a large share of
the rows, so a huge month becomes several files of even size.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.constants import OPERATOR_SPELLINGS
from wellspring.contracts import Contract
from wellspring.functions.values import coerce_dates
from wellspring.plans.views import all_views

SILVER_TABLES = [
    "facilities", "facility_history", "facility_status_changes", "production", "pipelines",
    "pipeline_installations", "sk_pipelines", "confidential_wells", "spud_activity",
    "well_licences", "well_attributes", "wells", "status_changes", "drilling_activity",
    "ownership_changes",
]


def write_partitioned(df: DataFrame, path: str, *partitions: str) -> None:
    """Replace exactly the partitions that the rows fall into."""
    (
        df.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partitions)
        .parquet(path)
    )


def bronze_path(root: str, contract: Contract) -> str:
    return f"{root.rstrip('/')}/bronze/{contract.id}"


def as_bronze(df: DataFrame, contract: Contract, snapshot_date: Column | None = None) -> DataFrame:
    """Parsed records with their load columns; contract dates become dates."""
    dated = coerce_dates(df, contract.dates)
    added = {"source_id": F.lit(contract.id)}
    if snapshot_date is not None:
        added["snapshot_date"] = snapshot_date
    known = F.col("province") if "province" in df.columns else F.lit(None).cast("string")
    added["province"] = F.coalesce(known, F.lit(contract.province))
    return dated.withColumns(added)


def write_bronze(
    df: DataFrame, contract: Contract, root: str, snapshot_date: str | Column | None = None
) -> str:
    """Write one or many snapshots; a re-run replaces those snapshots only."""
    if isinstance(snapshot_date, str):
        snapshot_date = F.lit(snapshot_date)
    path = bronze_path(root, contract)
    write_partitioned(as_bronze(df, contract, snapshot_date), path, "snapshot_date")
    return path


def silver_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/silver/{name}"


def stamped(df: DataFrame) -> DataFrame:
    return df.withColumn("_silver_version", F.current_timestamp())


def write_silver(df: DataFrame, name: str, root: str) -> str:
    """Replace a whole silver table."""
    path = silver_path(root, name)
    stamped(df).write.mode("overwrite").option("compression", "snappy").parquet(path)
    return path


def write_production(df: DataFrame, root: str) -> str:
    """Replace the months and provinces present in the rows."""
    path = silver_path(root, "production")
    write_partitioned(stamped(df), path, "province", "productionmonth")
    return path


def write_bucketed(df: DataFrame, table: str, key: str = "uwi", buckets: int = 512) -> None:
    """Save a managed table bucketed and sorted by its join key.

    Two tables bucketed alike join on the key without moving either of them.
    """
    (
        df.repartition(buckets, key)
        .write.mode("overwrite")
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )


def read_silver(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """A silver table, None if it was not built."""
    try:
        df = spark.read.option("mergeSchema", True).parquet(silver_path(root, name))
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    if name == "production":
        # partition values are read back as dates or integers when they look like it
        df = df.withColumn("productionmonth", F.col("productionmonth").cast("string"))
    return df


def register_functions(spark: SparkSession) -> None:
    """SQL functions that published queries use."""
    body = "coalesce(name, '')"
    for pattern, replacement in OPERATOR_SPELLINGS:
        body = f"regexp_replace({body}, r'{pattern}', '{replacement}')"
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION normalize_operator_name(name STRING)"
        f" RETURNS STRING RETURN upper(trim({body}))"
    )
    # Spark's own datediff(MONTH, ...) counts whole months
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION months_crossed(start DATE, finish DATE)"
        " RETURNS INT RETURN (year(finish) - year(start)) * 12 + month(finish) - month(start)"
    )


def register_views(
    spark: SparkSession, root: str, names: Iterable[str] = tuple(SILVER_TABLES)
) -> list[str]:
    """Publish the silver tables that exist and the views they allow."""
    read = {n: read_silver(spark, root, n) for n in names}
    shown = all_views({n: df for n, df in read.items() if df is not None}, spark)
    for name, df in shown.items():
        df.createOrReplaceTempView(name)
    register_functions(spark)
    return sorted(shown)


def export(spark: SparkSession, names: Iterable[str], fmt: str, out: str) -> list[str]:
    """Write published tables as Parquet or as CSV with a header."""
    written = []
    for name in names:
        path = f"{out.rstrip('/')}/{name}.{fmt}"
        writer = spark.table(name).write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(path)
        elif fmt == "parquet":
            writer.parquet(path)
        else:
            raise ValueError(f"unknown format {fmt}")
        written.append(path)
    return written
