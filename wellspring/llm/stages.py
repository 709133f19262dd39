"""Tables between two steps of an operator, kept where every executor can read them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wellspring.session import shared_folder

#: Rows of an Arrow batch in jobs that pass whole documents through several Python steps.
BATCH_ROWS = 1000
#: Ids that leave a table are broadcast only up to so many rows (counted first).
BROADCAST_ROWS = 2_000_000


def saved(df: DataFrame, name: str) -> DataFrame:
    """df written as Parquet in the shared folder and read back.

    A lost executor then costs a reread, not a recomputation, and two readers
    see the same rows even where the first computation was not deterministic.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the files of a table made by saved() that nothing reads any more."""
    spark = df.sparkSession
    root = shared_folder(spark).rstrip("/") + "/"
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        if path.toUri().getPath().startswith(
            spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath() + "/"
        ):
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def bounded(ids: DataFrame) -> DataFrame:
    """Written ids, broadcast if they are at most BROADCAST_ROWS, else as they are (shuffled)."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids


def without(docs: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """docs without the rows whose key is in gone.key; a null key is in no table.

    ``gone`` is written first, so few ids go to the texts; only where there are more
    than BROADCAST_ROWS of them do the texts meet them by a shuffle.
    """
    gone = bounded(saved(gone.select(key).distinct(), "gone"))
    return docs.join(gone, key, "left_anti").select(docs.columns)


def small_batches(spark: SparkSession) -> None:
    """Rows pass to and from Python workers in batches of BATCH_ROWS from now on.

    A batch of texts stands several times in an executor outside the heap, once or
    more in each process; Spark's 10,000 rows make that hundreds of megabytes.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
