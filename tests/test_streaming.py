"""Streams with available-now triggers over temporary folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wellspring.contracts import CONTRACTS
from wellspring.plans.silver import build_production
from wellspring.sources import reports
from wellspring.streaming import ingest


def run(query):
    query.awaitTermination(300)
    assert query.exception() is None


def spud_file(day, *uwis):
    return "\n".join(f" {u}  {'WELL ' + u:<30}0123456\n RIG {day}" for u in uwis)


def test_ingest_reads_only_new_files(spark, tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    contract = CONTRACTS["ab_spuds_daily"]
    root, checkpoint = str(tmp_path / "lake"), str(tmp_path / "cp")

    def ingest_now():
        run(
            ingest.start_ingest(
                spark, str(source), root, checkpoint, contract, reports.parse_spud_lines, "latin-1"
            )
        )
        rows = spark.read.parquet(f"{root}/bronze/{contract.id}")
        return sorted((r["uwi"], str(r["snapshot_date"]), r["load"]) for r in rows.collect())

    (source / "2024-01-01_SPUD.txt").write_text(spud_file(1, "00/01-01-001-01W4/0", "00/01-01-001-02W4/0"))
    first = ingest_now()
    assert [r[:2] for r in first] == [
        ("00/01-01-001-01W4/0", "2024-01-01"), ("00/01-01-001-02W4/0", "2024-01-01"),
    ]
    assert ingest_now() == first
    (source / "2024-01-02_SPUD.txt").write_text(spud_file(2, "00/01-01-001-03W4/0"))
    # a second file of the same day must not replace the first one
    (source / "2024-01-01_SPUD_B.txt").write_text(spud_file(2, "00/01-01-001-04W4/0"))
    assert [r[:2] for r in ingest_now()] == [
        ("00/01-01-001-01W4/0", "2024-01-01"), ("00/01-01-001-02W4/0", "2024-01-01"),
        ("00/01-01-001-03W4/0", "2024-01-02"), ("00/01-01-001-04W4/0", "2024-01-01"),
    ]
    log = spark.read.parquet(ingest.log_path(root))
    assert sorted((r["source"].rsplit("/", 1)[1], r["row_count"]) for r in log.collect()) == [
        ("2024-01-01_SPUD.txt", 2), ("2024-01-01_SPUD_B.txt", 1), ("2024-01-02_SPUD.txt", 1),
    ]


def test_changed_sources_by_strongest_signal(spark):
    current = spark.createDataFrame(
        [
            ("same_etag", "e1", "m2", "h2"), ("new_etag", "e2", "m1", "h1"),
            ("no_etag", None, "m1", "h2"), ("hash", None, None, "h2"),
            ("same_hash", None, None, "h1"), ("unknown", None, None, None), ("new", "e", "m", "h"),
            ("failed_since", None, None, "h1"),
        ],
        "source string, etag string, last_modified string, sha256 string",
    )
    seen = ["same_etag", "new_etag", "no_etag", "hash", "same_hash", "unknown", "failed_since"]
    log = spark.createDataFrame(
        [(s, "e1", "m1", "h1", "success", 1) for s in seen]
        + [("failed_since", "e9", "m9", "h9", "failed", 2), ("new", "e", "m", "h", "quarantined", 1)],
        "source string, etag string, last_modified string, sha256 string, status string, logged_at int",
    )
    got = {r["source"] for r in ingest.changed(current, log).collect()}
    assert got == {"new_etag", "hash", "unknown", "new"}


def test_files_with_hash(spark, tmp_path):
    import hashlib

    (tmp_path / "a.bin").write_bytes(b"abc")
    row = ingest.files_with_hash(spark, str(tmp_path)).first()
    assert (row["byte_size"], row["sha256"]) == (3, hashlib.sha256(b"abc").hexdigest())


def split(df, tmp_path, column, parts):
    """One Parquet file per part, in order, with increasing file times."""
    folder = tmp_path / "stream"
    folder.mkdir()
    schema = df.schema
    import os

    for i, part in enumerate(parts):
        path = folder / f"{i:03}.parquet"
        df.where(F.col(column).isin(part)).toPandas().to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder), schema


def test_amendments_equal_one_batch(spark, table, tmp_path):
    raw = table("volumetric").drop("uwi").withColumns(
        {
            "volume": F.col("volume").cast("string"),
            "snapshot_date": F.col("snapshot_date").cast("string"),
            "batch": F.pmod(F.xxhash64("l_orderkey"), F.lit(3)),
        }
    )
    # one submission per key and date, so that no tie decides
    raw = raw.dropDuplicates(["from_to_id", "productionmonth", "activityid", "productid", "snapshot_date"])
    raw.write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    folder, _ = split(raw, tmp_path, "batch", [[0], [1], [2]])
    stream = (
        spark.readStream.schema(spark.read.parquet(folder).schema)
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
        .drop("batch")
    )
    root = str(tmp_path / "lake")
    run(ingest.start_amendments(spark, stream, root, str(tmp_path / "cp")))
    got = spark.read.parquet(f"{root}/silver/production").drop("_silver_version")
    want = build_production({"ab": raw.drop("batch")})
    columns = want.columns
    shown = [F.col(c).cast("string") for c in columns]
    a, b = got.select(*shown), want.select(*shown)
    assert a.count() == b.count() > 100
    assert a.exceptAll(b).count() == 0


def test_transitions_equal_one_batch(spark, table, tmp_path):
    df = table("facility_snapshots").select("facility_id", "snapshot_date", "is_active")
    days = [r[0] for r in df.select("snapshot_date").distinct().orderBy("snapshot_date").collect()]
    thirds = [days[:7], days[7:20], days[20:]]
    folder, schema = split(df, tmp_path, "snapshot_date", thirds)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    root = str(tmp_path / "lake")
    query = ingest.start_transitions(spark, stream, root, str(tmp_path / "cp"))
    run(query)
    got = spark.read.parquet(f"{root}/silver/facility_events")
    want = ingest.status_transitions(df)
    assert got.count() == want.count() > 10
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    # One state row per facility after every batch, however many batches ran.
    facilities = df.select("facility_id").distinct().count()
    totals = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert len(totals) >= 3 and totals[-1] == facilities and max(totals) <= facilities


def test_transitions_with_late_and_tied_snapshots(spark, tmp_path):
    d = dt.date
    loads = [
        [("f1", d(2024, 1, 1), True), ("f1", d(2024, 1, 5), False), ("f2", d(2024, 1, 1), None),
         ("f2", d(2024, 1, 2), True), ("f3", d(2024, 1, 3), False), ("f3", d(2024, 1, 3), True)],
        [("f1", d(2024, 1, 3), True), ("f1", d(2024, 1, 6), True), ("f2", d(2024, 1, 4), False),
         ("f3", d(2024, 1, 3), True), ("f3", d(2024, 1, 4), False), ("f4", None, True)],
        [("f1", d(2024, 1, 6), False), ("f3", d(2024, 1, 2), True), ("f1", d(2024, 1, 7), False)],
    ]
    schema = "facility_id string, snapshot_date date, is_active boolean"
    for k, rows in enumerate(loads):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "raw" / f"load={k}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "raw"))
    root = str(tmp_path / "lake")
    run(ingest.start_transitions(spark, stream, root, str(tmp_path / "cp")))
    got = sorted((r[0], str(r[1]), r[2], r[3]) for r in spark.read.parquet(f"{root}/silver/facility_events").collect())
    assert got == [
        ("f1", "2024-01-05", "Active", "Inactive"),
        ("f1", "2024-01-06", "Active", "Inactive"),  # load 2: equal date, inactive after active
        ("f1", "2024-01-06", "Inactive", "Active"),  # load 1: 01-03 is late and skipped
        ("f2", "2024-01-04", "Active", "Inactive"),  # the row after the null status gave none
        ("f3", "2024-01-03", "Active", "Inactive"),  # tie in one load: active first
    ]  # f3's tied active in load 1 and 01-02 in load 2 are late; f4 has no date


def test_stream_dedupe_within_bound(spark, table, tmp_path):
    events = table("status_changes").select("uwi", "new_status", "event_date")
    days = [r[0] for r in events.select("event_date").distinct().orderBy("event_date").collect()]
    folder, schema = split(events, tmp_path, "event_date", [days[:10], days[10:]])
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)
    kept = ingest.dedupe_events(stream, ["uwi", "new_status"], "event_date", "60 days")
    out = str(tmp_path / "out")
    run(ingest.start_to_table(kept, out, str(tmp_path / "cp")))
    got = spark.read.parquet(out).select("uwi", "new_status")
    assert got.count() == events.select("uwi", "new_status").distinct().count()


def test_stream_windows_equal_batch(spark, table, tmp_path):
    events = table("events").select("ts", "event_type")
    folder = str(tmp_path / "stream")
    events.coalesce(1).write.parquet(folder)
    stream = spark.readStream.schema(events.schema).parquet(folder)
    counted = ingest.activity_counts(stream, "ts", "event_type", late="1 hour")
    query = (
        counted.writeStream.format("memory").queryName("windows").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run(query)
    want = ingest.activity_counts(events, "ts", "event_type")
    got = spark.table("windows")
    assert got.count() == want.count() == 150
    assert got.exceptAll(want).count() == 0


def test_closed_windows_with_late_rows_and_marker(spark, tmp_path):
    at = dt.datetime
    schema = "ts timestamp, event_type string"
    loads = [
        [(at(2024, 1, 1, 5), "a"), (at(2024, 1, 1, 6), "a"), (at(2024, 1, 2, 1), "b")],
        [(at(2024, 1, 10, 1), "a")],
        [(at(2024, 1, 9, 23), "b"), (at(2024, 1, 10, 2), "a"), (at(2024, 1, 1, 7), "a")],  # behind 01-08
    ]
    frames = [spark.createDataFrame(rows, schema) for rows in loads]
    everything = frames[0].unionByName(frames[1]).unionByName(frames[2])
    frames.append(ingest.marker_event(everything, "ts", "event_type", "1 day", "2 days"))
    root = tmp_path / "raw"
    queries = []
    for k, frame in enumerate(frames):
        frame.coalesce(1).write.parquet(str(root / f"load={k}"))
        stream = spark.readStream.schema(schema).parquet(str(root / "load=*"))
        queries.append(ingest.start_closed_windows(
            stream, "ts", "event_type", str(tmp_path / "out"), str(tmp_path / "cp"), "1 day", "2 days"
        ))
        run(queries[-1])
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    got = sorted((str(r.window_start.date()), r.event_type, r.n) for r in got)
    # The late 01-01 row is dropped; every window, the newest too, is written once.
    assert got == [("2024-01-01", "a", 2), ("2024-01-02", "b", 1), ("2024-01-09", "b", 1), ("2024-01-10", "a", 2)]
    assert sum(ingest.late_rows(q) for q in queries) == 1


def test_backfill_archives(spark, tmp_path):
    from tests.test_sources import zipped

    folder = tmp_path / "zips"
    folder.mkdir()
    inner = zipped(a__txt=spud_file(1, "00/01-01-001-01W4/0"))
    (folder / "spud2023.zip").write_bytes(zipped(jan__zip=inner))
    (folder / "spud2024-02.zip").write_bytes(zipped(b__txt=spud_file(1, "00/01-01-001-02W4/0")))
    path = ingest.backfill_archives(
        spark, str(folder), str(tmp_path), CONTRACTS["ab_spuds_archive"], reports.parse_spud_lines
    )
    rows = spark.read.option("spark.sql.sources.partitionColumnTypeInference.enabled", False).parquet(path)
    assert {r["uwi"] for r in rows.collect()} == {"00/01-01-001-01W4/0", "00/01-01-001-02W4/0"}
    import os

    assert {d for d in os.listdir(path) if d.startswith("snap")} == {
        "snapshot_date=2023", "snapshot_date=2024-02",
    }


@pytest.mark.parametrize(
    "months, want", [(3, ["2023-11", "2024-01"]), (1, ["2024-01"]), (4, ["2023-10", "2023-11", "2024-01"])]
)
def test_missing_months(spark, months, want):
    existing = spark.createDataFrame([("2023-12",), ("2023-12",), ("2020-01",)], "productionmonth string")
    newest = ingest.as_of_table(spark, F.lit(dt.date(2024, 2, 29)))
    got = ingest.missing_months(newest, existing, months)
    assert sorted(r[0] for r in got.collect()) == want


def test_amendment_loads_are_written_by_many_tasks(spark, table, tmp_path, monkeypatch, rows):
    from wellspring.registry import stored

    def many(name):
        return table(name).repartition(4)

    roots = iter([str(tmp_path / "many")])
    with monkeypatch.context() as patched:
        patched.setattr(stored, "new_folder", lambda t: next(roots))
        got = rows(stored.t04(many))
    for load in range(3):
        assert len(list((tmp_path / "many" / "raw" / f"load={load}").glob("*.parquet"))) == 4
    batches = [p for p in (tmp_path / "many" / "checkpoint" / "commits").iterdir() if p.name.isdigit()]
    assert len(batches) == 3
    want = build_production({"ab": table("volumetric").drop("uwi")})
    assert got == rows(want, "productionmonth", "uwi", "province", "oil_prod_vol", "gas_prod_vol")
