"""File streams: only new files are read, and every batch can be replayed.

Batches are written under their batch number, so a batch that is replayed
after a failure replaces its own output and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from wellspring.contracts import Contract
from wellspring.functions.text import file_date, file_period, status_label
from wellspring.operators.keyed import latest_by, transitions
from wellspring.plans.silver import build_production
from wellspring.plans.sinks import (
    as_bronze,
    bronze_path,
    write_bronze,
    write_partitioned,
    write_production,
)
from wellspring.sources.archives import archive_lines
from wellspring.sources.lines import numbered_text, with_source

Parser = Callable[[DataFrame], DataFrame]


def _started(
    stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def log_path(root: str) -> str:
    return f"{root.rstrip('/')}/ingestion_log"


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def record(rows: DataFrame, contract: Contract, root: str, load: int) -> None:
    """Log a load: one row per file with its row count, under the load number."""
    entries = rows.groupBy(F.col("file").alias("source")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    logged = entries.withColumns(
        {
            "dataset": F.lit(contract.id),
            "load": F.lit(load).cast("bigint"),
            "status": F.lit("success"),
            "logged_at": F.current_timestamp(),
        }
    )
    write_partitioned(logged, log_path(root), "dataset", "load")


def start_ingest(
    spark: SparkSession,
    source: str,
    root: str,
    checkpoint: str,
    contract: Contract,
    parse: Parser,
    encoding: str | None = None,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Parse files that were not ingested before into the bronze table.

    Each file is dated by its name. A second start on the same checkpoint reads
    only files that arrived since.
    """
    stream = with_source(
        spark.readStream.option("maxFilesPerTrigger", files_per_batch).format("text").load(source)
    )

    def load(batch: DataFrame, number: int) -> None:
        parsed = parse(numbered_text(batch, encoding))
        dated = as_bronze(parsed, contract, file_date(F.col("file"))).withColumn(
            "load", F.lit(number).cast("bigint")
        )
        path = bronze_path(root, contract)
        write_partitioned(dated, path, "snapshot_date", "load")
        written = spark.read.parquet(path).where(F.col("load") == number)
        record(written, contract, root, number)

    return _started(stream, load, checkpoint)


# --- what changed -----------------------------------------------------------


def files_with_hash(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Files with the signature that change detection compares."""
    return (
        spark.read.format("binaryFile")
        .load(path)
        .select(
            F.col("path").alias("source"),
            F.col("length").alias("byte_size"),
            F.sha2("content", 256).alias("sha256"),
        )
    )


SIGNALS = ("etag", "last_modified", "sha256")


def changed(current: DataFrame, log: DataFrame) -> DataFrame:
    """Sources whose content is new against their latest successful load.

    The strongest signal both sides have decides: entity tag, then modification
    time, then content hash. Without any common signal a source counts as
    changed.
    """
    known = latest_by(log.where("status = 'success'"), ["source"], [F.desc("logged_at")])
    have = [s for s in SIGNALS if s in current.columns and s in known.columns]
    joined = current.join(
        known.select("source", *[F.col(s).alias(f"_was_{s}") for s in have]), "source", "left"
    )
    differs = [
        F.when(F.col(s).isNotNull() & F.col(f"_was_{s}").isNotNull(), F.col(s) != F.col(f"_was_{s}"))
        for s in have
    ]
    return joined.where(F.coalesce(*differs, F.lit(True))).select(*current.columns)


# --- archives and months ----------------------------------------------------


def backfill_archives(
    spark: SparkSession, path: str | Sequence[str], root: str, contract: Contract, parse: Parser
) -> str:
    """Every archive of a dataset in one job, dated by the archive's name."""
    parsed = parse(archive_lines(spark, path))
    name = F.regexp_extract("file", r"([^/]+)$", 1)
    return write_bronze(parsed, contract, root, file_period(name))


def missing_months(newest: DataFrame, existing: DataFrame, months: int) -> DataFrame:
    """Months to ingest: the newest ones counted back, minus those present.

    ``newest`` is one row with a date ``as_of``; the month before it is the
    first that can be complete.
    """
    last = F.add_months(F.trunc("as_of", "month"), -1)
    wanted = newest.select(
        F.explode(
            F.sequence(F.add_months(last, 1 - months), last, F.expr("interval 1 month"))
        ).alias("month")
    ).select(F.date_format("month", "yyyy-MM").alias("productionmonth"))
    return wanted.join(existing.select("productionmonth").distinct(), "productionmonth", "left_anti")


# --- production amendments --------------------------------------------------


def start_amendments(
    spark: SparkSession, submissions: DataFrame, root: str, checkpoint: str
) -> StreamingQuery:
    """Keep monthly production current as submissions and amendments arrive.

    Submissions are kept, partitioned by month; each batch rebuilds the months
    it touches from all their submissions, so replays and late amendments give
    the same table as one batch over everything.
    """
    kept = f"{root.rstrip('/')}/bronze/submissions"

    def upsert(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("load", F.lit(number).cast("bigint")).withColumnRenamed(
            "productionmonth", "month"
        )
        write_partitioned(rows, kept, "month", "load")
        everything = spark.read.parquet(kept).withColumn("month", F.col("month").cast("string"))
        touched = everything.where(F.col("load") == number).select("month").distinct()
        months = everything.join(touched, "month", "left_semi").withColumnRenamed(
            "month", "productionmonth"
        )
        write_production(build_production({"ab": months.drop("load")}), root)

    return _started(submissions, upsert, checkpoint)


# --- events -----------------------------------------------------------------


def dedupe_events(events: DataFrame, keys: Sequence[str], time: str, late: str) -> DataFrame:
    """First event of each key; repeats may arrive up to ``late`` afterwards.

    Works on streams and, without the bound, on tables. On a stream every
    source task drops its own repeats before the keys meet, so a key that holds
    much of a batch reaches its final task as a few rows.
    """
    stamped = events.withColumn(time, F.col(time).cast("timestamp"))
    if not events.isStreaming:
        return latest_by(stamped, list(keys), [time, *sorted(set(events.columns) - {time, *keys})])
    return (
        stamped.withWatermark(time, late)
        .withColumn("_task", F.spark_partition_id())
        .dropDuplicatesWithinWatermark([*keys, "_task"])
        .drop("_task")
        .dropDuplicatesWithinWatermark(list(keys))
    )


def activity_counts(
    events: DataFrame, time: str, kind: str, window: str = "1 day", late: str | None = None
) -> DataFrame:
    """Events per tumbling window and type, for streams and tables alike."""
    stamped = events.withColumn(time, F.col(time).cast("timestamp"))
    if late:
        stamped = stamped.withWatermark(time, late)
    counted = stamped.groupBy(F.window(time, window), kind).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), kind, "n")


#: Kind of the event that closes the last windows of a finished stream.
MARKER = "__end_of_stream__"


def marker_event(events: DataFrame, time: str, kind: str, window: str, late: str) -> DataFrame:
    """One event past the newest window by the lateness allowed: appended to a
    stream's source, it moves the watermark beyond every window, which closes them."""
    newest = F.max(F.col(time).cast("timestamp"))
    at = newest + F.expr(f"interval {window}") + F.expr(f"interval {late}") + F.expr("interval 1 second")
    others = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema if f.name not in (time, kind)]
    return events.agg(at.alias(time)).select(
        F.col(time).cast(events.schema[time].dataType).alias(time), F.lit(MARKER).alias(kind), *others
    ).where(F.col(time).isNotNull()).select(*events.columns)


def start_closed_windows(
    events: DataFrame, time: str, kind: str, path: str, checkpoint: str,
    window: str = "1 day", late: str = "40 days",
) -> StreamingQuery:
    """Counts per window and kind, appended once the watermark closes the window.

    A window is written once and never again; rows behind the watermark are
    dropped and counted (``late_rows``). The marker event's own window stays
    open and is not written while no later event comes. (A filter on the
    marker here would be pushed below the aggregate and hide it from the
    watermark; readers of a stream that goes on drop the kind ``MARKER``.)
    """
    return start_to_table(activity_counts(events, time, kind, window, late), path, checkpoint, "append")


def late_rows(query: StreamingQuery) -> int:
    """Rows a finished stream dropped as later than its watermark."""
    return sum(
        op.get("numRowsDroppedByWatermark", 0) for p in query.recentProgress for op in p.get("stateOperators", [])
    )


def start_to_table(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Append finished rows of a stream to a Parquet table."""
    return (
        df.writeStream.format("parquet")
        .outputMode(mode)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# --- status transitions -----------------------------------------------------

STATUS = ["facility_id", "snapshot_date", "is_active"]


def status_transitions(rows: DataFrame) -> DataFrame:
    """Batch twin: every change of a facility's status."""
    return transitions(rows, "facility_id", "snapshot_date", "is_active").select(
        "facility_id",
        F.col("snapshot_date").alias("event_date"),
        status_label(F.col("prev_is_active")).alias("old_status"),
        status_label(F.col("is_active")).alias("new_status"),
    )


#: The state store that transformWithState needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
TRANSITION = "facility_id string, event_date date, old_status string, new_status string"


def _label(active):
    return None if active is None else ("Active" if active else "Inactive")


class StatusTracker(StatefulProcessor):
    """Per facility, the last status seen (a value state); a row for every change.

    Snapshots of a batch are taken by date, and on equal dates the active one
    first (inactive last). Defined results:

    * a snapshot that sorts before the facility's last one (late, or equal date
      and active after inactive) changes nothing and gives no row: history
      that was emitted stays as it is;
    * a snapshot without a date is skipped; a null status is remembered and
      gives no row, and neither does the snapshot after it (as the batch twin);
    * with ``ttl_ms``, a facility silent for that long (processing time) is
      forgotten and its next snapshot starts afresh.

    The state holds one row per facility whatever the number of batches.
    """

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "snapshot_date date, is_active boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues):
        known = self.last.get() if self.last.exists() else None

        def order(date, active):
            return (date, active is not True, active is None)

        for row in sorted(
            (r for r in rows if r["snapshot_date"] is not None),
            key=lambda r: order(r["snapshot_date"], r["is_active"]),
        ):
            if known is not None and order(row["snapshot_date"], row["is_active"]) < order(known[0], known[1]):
                continue
            before = None if known is None else known[1]
            if before is not None and row["is_active"] is not None and before != row["is_active"]:
                yield Row(
                    facility_id=key[0], event_date=row["snapshot_date"],
                    old_status=_label(before), new_status=_label(row["is_active"]),
                )
            known = (row["snapshot_date"], row["is_active"])
        if known is not None:
            self.last.update(known)

    def close(self) -> None:
        pass


def status_changes(snapshots: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """A stream of status changes from a stream of snapshots, state kept per facility."""
    spark = snapshots.sparkSession
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return (
        snapshots.select(*STATUS)
        .groupBy("facility_id")
        .transformWithState(
            StatusTracker(ttl_ms), TRANSITION, "Append", "ProcessingTime" if ttl_ms else "None"
        )
    )


def start_transitions(
    spark: SparkSession, snapshots: DataFrame, root: str, checkpoint: str, ttl_ms: int | None = None
) -> StreamingQuery:
    """Status changes across batches, appended to ``silver/facility_events``.

    The last status of each facility lives in the stream's state store
    (RocksDB, under the checkpoint), so a batch reads only its own snapshots
    and a replayed batch finds the state of the batch before it.
    """
    events = f"{root.rstrip('/')}/silver/facility_events"
    return start_to_table(status_changes(snapshots, ttl_ms), events, checkpoint)


def as_of_table(spark: SparkSession, as_of: Column) -> DataFrame:
    """One row with the date ``missing_months`` counts back from."""
    return spark.range(1).select(as_of.cast("date").alias("as_of"))
