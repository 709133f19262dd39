"""Text files as rows of (file, member, line_no, value)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wellspring.functions.text import best_encoding, decode_text, has_undefined_cp1252
from wellspring.operators.joins import BLOCK_ROWS, broadcast_up_to
from wellspring.session import shared_folder

LINE_SCHEMA = "file string, member string, line_no bigint, value string"


def staged(df: DataFrame) -> DataFrame:
    """A reliable checkpoint in the shared folder.

    Used where two reads of the same rows must agree on a per-task numbering;
    the rows are stored outside the executors, so losing one loses nothing.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def file_encoding() -> Column:
    """Aggregate: the first encoding in which every line of a file is valid."""
    valid = F.is_valid_utf8(F.col("value"))
    return best_encoding(
        F.bool_and(valid),
        F.bool_and(F.when(~valid, ~has_undefined_cp1252(F.col("value")))),
    ).alias("encoding")


def read_lines(
    spark: SparkSession, path: str | Sequence[str], encoding: str | None = None
) -> DataFrame:
    """Numbered lines of plain text files, big files split into many tasks."""
    return numbered_text(with_source(spark.read.text(path)), encoding)


def with_source(raw: DataFrame) -> DataFrame:
    """Text rows with the file and the file block they come from."""
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        "value",
    )


def numbered_text(raw: DataFrame, encoding: str | None = None) -> DataFrame:
    """Line numbers and decoded text for rows of ``with_source``.

    Lines are counted per file block and the blocks of a file are added up, so
    numbering needs no shuffle of the lines. Without ``encoding`` every file is
    read as the first of UTF-8, cp1252 and latin-1 that fits all its lines.
    """
    raw = staged(raw.withColumn("id", F.monotonically_increasing_id()))
    blocks = raw.groupBy("file", "block").agg(
        F.min("id").alias("first_id"),
        F.count(F.lit(1)).alias("lines"),
        *([] if encoding else [file_encoding()]),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    whole = Window.partitionBy("file")
    chosen = F.lit(encoding) if encoding else _widest(F.collect_set("encoding").over(whole))
    starts = blocks.select(
        "file",
        "block",
        (F.coalesce(F.sum("lines").over(before), F.lit(0)) - F.col("first_id")).alias("shift"),
        chosen.alias("encoding"),
    )
    # one row per file block; the staged rows make counting them cheap
    starts = broadcast_up_to(starts, blocks.count(), BLOCK_ROWS)
    return raw.join(starts, ["file", "block"]).select(
        "file",
        F.lit("").alias("member"),
        (F.col("id") + F.col("shift")).alias("line_no"),
        F.regexp_replace(decode_text(F.col("value"), F.col("encoding")), "\r$", "").alias("value"),
    )


def _widest(encodings: Column) -> Column:
    return (
        F.when(F.array_contains(encodings, "latin-1"), "latin-1")
        .when(F.array_contains(encodings, "cp1252"), "cp1252")
        .otherwise("utf-8")
    )


def file_count(spark: SparkSession, path: str | Sequence[str]) -> int:
    """How many files a path lists; the driver holds that list anyway."""
    return len(spark.read.text(path).inputFiles())


def number_lines(
    df: DataFrame, keys: Sequence[str], order: str, bucket: Column
) -> DataFrame:
    """Dense line numbers from 0 per key, for rows that carry only an order.

    Rows are numbered inside ordered buckets and shifted by the row counts of
    the buckets before, so a huge file is numbered by many tasks.
    """
    marked = df.withColumn("_bucket", bucket)
    parts = [*keys, "_bucket"]
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    sizes = marked.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"))
    shifts = sizes.select(*parts, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*parts).orderBy(order)
    return (
        marked.withColumn("_at", F.row_number().over(inside) - 1)
        .join(shifts, parts)
        .withColumn("line_no", (F.col("_at") + F.col("_shift")).cast("bigint"))
        .drop("_bucket", "_at", "_shift")
    )
