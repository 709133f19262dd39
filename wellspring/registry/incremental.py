"""Batch twins of the incremental and streaming operators, and SQL functions."""

from pyspark.sql import functions as F

from wellspring.plans.sinks import register_functions
from wellspring.registry import query
from wellspring.registry.operators import TRANSITIONS_CHECK
from wellspring.streaming import ingest


@query(
    "t02_changed_sources",
    """select doc_id::varchar as source from {documents} where lang <> 'en' or doc_id % 3 = 0
      or doc_id % 3 = 1 and sha256(text) <> sha256(text || case when n_chars % 2 = 0 then ''
        else ' amended' end)""",
)
def t02(t):
    """Texts against a log of earlier loads.

    English texts were loaded before; of those a third failed, and of another
    third the odd-sized ones were amended since.
    """
    docs = t("documents")
    current = docs.select(
        F.col("doc_id").cast("string").alias("source"), F.sha2("text", 256).alias("sha256")
    )
    before = F.when(
        (F.col("doc_id") % 3 == 1) & (F.col("n_chars") % 2 == 1),
        F.concat("text", F.lit(" amended")),
    ).otherwise(F.col("text"))
    log = docs.where("lang = 'en'").select(
        F.col("doc_id").cast("string").alias("source"),
        F.sha2(before, 256).alias("sha256"),
        F.when(F.col("doc_id") % 3 == 0, "failed").otherwise("success").alias("status"),
        F.col("doc_id").alias("logged_at"),
    )
    return ingest.changed(current, log).select("source")


@query(
    "t03_load_log",
    """select cast(snapshot_date as varchar) || '.csv' as source, count(*) as row_count
    from {facility_snapshots} group by all""",
)
def t03(t):
    rows = t("facility_snapshots").withColumn(
        "file", F.concat(F.col("snapshot_date").cast("string"), F.lit(".csv"))
    )
    return rows.groupBy(F.col("file").alias("source")).agg(F.count(F.lit(1)).alias("row_count"))


@query(
    "t05_dedupe_events",
    """select uwi, new_status, cast(min(event_date) as varchar) as first_date
    from {status_changes} group by uwi, new_status""",
)
def t05(t):
    events = t("status_changes").select("uwi", "new_status", "event_date")
    kept = ingest.dedupe_events(events, ["uwi", "new_status"], "event_date", "30 days")
    return kept.select("uwi", "new_status", F.col("event_date").cast("date").alias("first_date"))


@query(
    "t06_activity_windows",
    """select cast(cast(ts as date) as varchar) as day, event_type, count(*) as n from {events}
    group by all""",
)
def t06(t):
    counted = ingest.activity_counts(t("events"), "ts", "event_type")
    return counted.select(F.col("window_start").cast("date").alias("day"), "event_type", "n")


@query("t07_status_transitions", TRANSITIONS_CHECK)
def t07(t):
    return ingest.status_transitions(t("facility_snapshots"))


@query(
    "t10_missing_months",
    """select strftime(m, '%Y-%m') as productionmonth from (
      select unnest(generate_series(date_trunc('month', max(l_shipdate)) - interval 120 month,
        date_trunc('month', max(l_shipdate)) - interval 1 month, interval 1 month)) as m
      from {lineitem})
    where strftime(m, '%Y-%m') not in (select productionmonth from {production})""",
)
def t10(t):
    as_of = t("lineitem").agg(F.max("l_shipdate").cast("date").alias("as_of"))
    return ingest.missing_months(as_of, t("production"), 120)


@query(
    "x01_sql_function",
    """select c_custkey, upper(regexp_replace(c_name, '\\bcorporation\\b', 'CORP', 'gi')) as operator
    from (select c_custkey, c_name || if(c_custkey % 2 = 0, ' Corporation', ' inc') as c_name
      from {customer})""",
)
def x01(t):
    """The published SQL function, called from SQL."""
    spark = t("customer").sparkSession
    register_functions(spark)
    named = t("customer").select(
        "c_custkey",
        F.concat(
            "c_name", F.when(F.col("c_custkey") % 2 == 0, "  Corporation").otherwise(" inc ")
        ).alias("c_name"),
    )
    return spark.sql(
        "select c_custkey, normalize_operator_name(c_name) as operator from {named}", named=named
    )
