"""Round trips through storage and real streams, in the shared folder.

Each query writes what it needs below a new folder, so that runs never meet.
"""

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from wellspring.contracts import CONTRACTS
from wellspring.operators.filters import max_of
from wellspring.plans import sinks
from wellspring.registry import query
from wellspring.registry.operators import TRANSITIONS_CHECK
from wellspring.session import shared_folder
from wellspring.sources import archives, reports, snapshots
from wellspring.streaming import ingest


def new_folder(t) -> str:
    return f"{shared_folder(t('region').sparkSession)}/stored-{uuid.uuid4().hex}"


def finished(stream_query) -> None:
    """Wait for an available-now stream; its failure is this query's failure."""
    stream_query.awaitTermination()


@query(
    "k01_bronze_write",
    """select uwi, trim(licensee) as licensee, province, 'ab_well_list' as source_id,
    '2024-02-01' as snapshot_date from {wells}""",
)
def k01(t):
    """Two snapshots, one of them written twice; the newest is read."""
    root, contract = new_folder(t), CONTRACTS["ab_well_list"]
    wells = t("wells").withColumn("licensee", F.trim("licensee"))
    for day in ("2024-01-01", "2024-02-01", "2024-02-01"):
        path = sinks.write_bronze(wells, contract, root, day)
    every = snapshots.all_snapshots(wells.sparkSession, path)
    return snapshots.latest_snapshot(every).select(
        "uwi", "licensee", "province", "source_id", "snapshot_date"
    )


@query(
    "k02_silver_write",
    "select uwi, name, fluid, true as stamped from {wells}",
)
def k02(t):
    root = new_folder(t)
    spark = t("wells").sparkSession
    sinks.write_silver(t("wells"), "wells", root)
    sinks.write_silver(t("wells"), "wells", root)
    return sinks.read_silver(spark, root, "wells").select(
        "uwi", "name", "fluid", F.col("_silver_version").isNotNull().alias("stamped")
    )


@query(
    "k03_production_write",
    """select uwi, productionmonth, province, cast(oil_prod_vol as double)
      + if(productionmonth = (select max(productionmonth) from {production}), 1, 0)
      as oil_prod_vol from {production}""",
)
def k03(t):
    """The newest month is corrected and written again; other months stay."""
    root, production = new_folder(t), t("production")
    sinks.write_production(production, root)
    newest = production.where(
        F.col("productionmonth") == max_of(production, "productionmonth")
    ).withColumn("oil_prod_vol", F.col("oil_prod_vol") + 1)
    sinks.write_production(newest, root)
    stored = sinks.read_silver(production.sparkSession, root, "production")
    return stored.select("uwi", "productionmonth", "province", "oil_prod_vol")


@query(
    "k05_export_csv",
    "select uwi, name, trim(licensee) as licensee, mode from {wells}",
)
def k05(t):
    wells = t("wells").withColumn("licensee", F.trim("licensee"))
    wells.createOrReplaceTempView("wells_to_export")
    spark = wells.sparkSession
    (path,) = sinks.export(spark, ["wells_to_export"], "csv", new_folder(t))
    return spark.read.csv(path, header=True).select("uwi", "name", "licensee", "mode")


@query(
    "s16_archive_lines",
    """select doc_id, i - 1 as line_no, rtrim(lines[i], chr(13)) as value from (
      select doc_id, lines, unnest(generate_series(1, len(lines))) as i from (
        select doc_id, string_split(if(text like '%' || chr(10), left(text, len(text) - 1), text),
          chr(10)) as lines from {documents}))""",
)
def s16(t):
    """Every document as a zip inside a zip."""

    @F.pandas_udf("binary")
    def zipped(texts: pd.Series) -> pd.Series:
        def pack(name: str, data: bytes) -> bytes:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr(name, data)
            return out.getvalue()

        return texts.map(lambda x: pack("inner.zip", pack("list.txt", x.encode())))

    files = t("documents").select(
        F.col("doc_id").cast("string").alias("path"), zipped("text").alias("content")
    )
    found = archives.expand_archives(files, encodings=archives.FALLBACKS)
    return found.select(F.col("file").cast("bigint").alias("doc_id"), "line_no", "value")


@query(
    "s18_month_files",
    """select uwi, productionmonth, cast(oil_prod_vol as double) as oil_prod_vol,
    if(province = 'SK', cast(water_prod_vol as double), null) as water_prod_vol from {production}""",
)
def s18(t):
    """Alberta's files lack a column that Saskatchewan's have."""
    folder, production = new_folder(t), t("production")
    production.where("province = 'AB'").drop("water_prod_vol").write.parquet(f"{folder}/part=ab")
    production.where("province = 'SK'").write.parquet(f"{folder}/part=sk")
    return snapshots.read_months(production.sparkSession, folder).select(
        "uwi", "productionmonth", "oil_prod_vol", "water_prod_vol"
    )


@query(
    "t01_stream_ingest",
    """select uwi, lpad(cast(o_orderkey as varchar), 7, '0') as licence_number,
    cast(date_trunc('year', spud_date)::date as varchar) as snapshot_date from {spuds}""",
)
def t01(t):
    """Spud reports as text files, one per year, ingested by a stream.

    The stream is started twice; the second start finds nothing new.
    """
    root, spark = new_folder(t), t("spuds").sparkSession
    line = F.concat(
        F.lit(" "), F.col("uwi"), F.lit("  "), F.rpad(F.lit("WELL"), 30, " "),
        F.lpad(F.col("o_orderkey").cast("string"), 7, "0"),
    )
    report = t("spuds").select(
        F.trunc("spud_date", "year").cast("string").alias("day"), line.alias("value")
    )
    report.hint("rebalance", "day").write.partitionBy("day").text(f"{root}/raw")
    contract = CONTRACTS["ab_spuds_daily"]
    for _ in range(2):
        finished(
            ingest.start_ingest(
                spark, f"{root}/raw", root, f"{root}/checkpoint", contract,
                reports.parse_spud_lines, "latin-1",
            )
        )
    stored = spark.read.parquet(sinks.bronze_path(root, contract))
    return stored.select(
        "uwi", "licence_number", F.col("snapshot_date").cast("string").alias("snapshot_date")
    )


def as_stream(t, df, column: str):
    """A table as a stream of files: written in parts, read two files at a time."""
    folder = new_folder(t)
    df.hint("rebalance", column).write.parquet(folder)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(folder)


@query(
    "t04_stream_amendments",
    """with d as (select * from {volumetric} where activityid = 'PROD' qualify row_number() over (
        partition by from_to_id, productionmonth, productid
        order by snapshot_date desc, volume desc) = 1)
    select productionmonth, uwi, province,
      cast(coalesce(sum(volume) filter (where productid = 'OIL'), 0) as double) as oil_prod_vol,
      cast(coalesce(sum(volume) filter (where productid = 'GAS'), 0) as double) as gas_prod_vol
    from d group by 1, 2, 3""",
)
def t04(t):
    """Submissions arrive in three loads, their order mixed.

    A load is many files written by many tasks; the stream is started after each
    load and takes its files as one batch.
    """
    root, raw = new_folder(t), t("volumetric").drop("uwi")
    spark = raw.sparkSession
    for load in range(3):
        raw.where(F.pmod(F.xxhash64("l_orderkey"), F.lit(3)) == load).write.parquet(
            f"{root}/raw/load={load}"
        )
        stream = (
            spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 1_000_000)
            .parquet(f"{root}/raw/load=*")
        )
        finished(ingest.start_amendments(spark, stream, root, f"{root}/checkpoint"))
    return sinks.read_silver(spark, root, "production").select(
        "productionmonth", "uwi", "province", "oil_prod_vol", "gas_prod_vol"
    )


@query(
    "t05_stream_dedupe",
    "select uwi, new_status from {status_changes} group by all",
)
def t05(t):
    events = t("status_changes").select("uwi", "new_status", "event_date")
    kept = ingest.dedupe_events(
        as_stream(t, events, "uwi"), ["uwi", "new_status"], "event_date", "60 days"
    )
    root = new_folder(t)
    finished(ingest.start_to_table(kept, f"{root}/out", f"{root}/checkpoint"))
    return events.sparkSession.read.parquet(f"{root}/out").select("uwi", "new_status")


@query(
    "t06_stream_windows",
    """select cast(cast(ts as date) as varchar) as day, event_type, count(*) as n from {events}
    group by all""",
)
def t06(t):
    """Events arrive in three loads in time order; a marker closes the last windows."""
    events = t("events").select("ts", "event_type")
    spark, root = events.sparkSession, new_folder(t)
    ts = F.col("ts").cast("timestamp")
    low, high = events.agg(F.min(ts), F.max(ts)).first()
    cuts = [low + (high - low) * k / 3 for k in range(1, 3)] if low is not None else []
    loads = [
        events.where(ts < cuts[0]) if cuts else events,
        *([events.where((ts >= cuts[0]) & (ts < cuts[1])), events.where((ts >= cuts[1]) | ts.isNull())] if cuts else []),
        ingest.marker_event(events, "ts", "event_type", "1 day", "40 days"),
    ]
    for load, part in enumerate(loads):
        part.write.parquet(f"{root}/raw/load={load}")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/raw/load=*")
        finished(ingest.start_closed_windows(stream, "ts", "event_type", f"{root}/out", f"{root}/checkpoint"))
    stored = spark.read.schema("window_start timestamp, event_type string, n long").parquet(f"{root}/out")
    closed = stored.where(~F.col("event_type").eqNullSafe(ingest.MARKER))
    return closed.select(F.col("window_start").cast("date").cast("string").alias("day"), "event_type", "n")


@query("t07_stream_transitions", TRANSITIONS_CHECK)
def t07(t):
    """Snapshots arrive in three loads, in date order."""
    root, df = new_folder(t), t("facility_snapshots").select(*ingest.STATUS)
    spark = df.sparkSession
    for load, days in enumerate(("1 and 7", "8 and 20", "21 and 31")):
        df.where(f"day(snapshot_date) between {days}").coalesce(1).write.parquet(
            f"{root}/raw/load={load}"
        )
        stream = spark.readStream.schema(df.schema).parquet(f"{root}/raw/load=*")
        finished(ingest.start_transitions(spark, stream, root, f"{root}/checkpoint"))
    return spark.read.parquet(f"{root}/silver/facility_events").drop("load")
