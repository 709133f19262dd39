"""Reading bronze and silver tables: latest snapshot, all snapshots, months."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.functions.names import normalize_columns
from wellspring.functions.text import file_date
from wellspring.operators.filters import max_of


def latest_snapshot(df: DataFrame, by: str = "snapshot_date") -> DataFrame:
    """Rows of the newest snapshot; a table without snapshots is one snapshot.

    The newest date is a scalar subquery, so on a table partitioned by the
    snapshot only that partition is read.
    """
    if by not in df.columns:
        return df
    return df.where(F.col(by) == max_of(df, by))


def all_snapshots(spark: SparkSession, path: str) -> DataFrame:
    """Every snapshot, dated by its own column or by the file it came in."""
    df = spark.read.option("mergeSchema", True).parquet(path)
    if "snapshot_date" in df.columns:
        return df.withColumn("snapshot_date", F.col("snapshot_date").cast("string").cast("date"))
    return df.withColumn("snapshot_date", file_date(F.col("_metadata.file_name")))


def read_months(spark: SparkSession, path: str) -> DataFrame:
    """Month files whose columns may differ, united by name."""
    return spark.read.option("mergeSchema", True).parquet(path)


def load_lookup(spark: SparkSession, path: str) -> DataFrame:
    """A code list (fields, field pools, facility codes) from CSV or Parquet."""
    if path.rstrip("/").endswith(".parquet"):
        return normalize_columns(spark.read.parquet(path))
    return normalize_columns(spark.read.csv(path, header=True, enforceSchema=False))
