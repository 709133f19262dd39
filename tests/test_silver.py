"""Silver tables on small hand-written inputs, and the whole pipeline."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from wellspring.contracts import CONTRACTS
from wellspring.plans import silver, sinks
from wellspring.plans.pipeline import build_all


@pytest.fixture
def frame(spark):
    return lambda rows, schema: spark.createDataFrame(rows, schema)


def one(df, **key):
    rows = [r.asDict() for r in df.collect()]
    found = [r for r in rows if all(r[k] == v for k, v in key.items())]
    assert len(found) == 1, rows
    return found[0]


def test_facilities_use_latest_snapshot_and_trimmed_keys(frame):
    active = frame(
        [
            (" F1 ", "Gas Plant", "A", "2024-01-01"),
            (" F1 ", "Gas Plant", "B", "2024-02-01"),
            ("F2", None, "C", "2024-02-01"),
        ],
        "facility_id string, sub_type string, operator_name string, snapshot_date string",
    )
    geo = frame(
        [("F1", 50.0, -110.0), ("F1", 51.0, -111.0)],
        "facility_id string, centroid_lat double, centroid_lon double",
    )
    sk = frame([("S1", "Crude Oil Battery")], "facility_id string, facility_type string")
    got = silver.build_facilities({"active": active, "sk": sk, "geo": geo})
    assert got.count() == 3
    first = one(got, facility_id="F1")
    assert (first["operator_name"], first["centroid_lat"], first["facility_class"]) == ("B", 50.0, "gas_plant")
    assert one(got, facility_id="S1")["province"] == "SK"
    assert "snapshot_date" not in got.columns


HISTORY = "facility_id string, operator_name string, sub_type string, snapshot_date string"


def test_facility_history_and_changes(frame):
    active = frame(
        [
            ("F", "OLD", "Battery", "2024-01-01"), ("F", "NEW", None, "2024-03-01"),
            ("G", "G1", "Meter", "2024-02-01"),
        ],
        HISTORY,
    )
    inactive = frame(
        [("F", None, "Battery", "2024-02-01"), ("F", None, None, "2024-04-01"), ("G", None, None, "2024-02-01")],
        HISTORY,
    )
    lists = {"active": active, "inactive": inactive}
    f = one(silver.build_facility_history(lists), facility_id="F")
    assert (f["operator_name"], f["sub_type"], f["is_active"]) == ("NEW", "Battery", False)
    assert (f["first_seen"], f["last_seen"]) == ("2024-01-01", "2024-04-01")
    assert (f["first_active_date"], f["last_active_date"]) == ("2024-01-01", "2024-03-01")
    assert (f["was_ever_active"], f["is_currently_active"]) == (True, False)
    # both lists in one snapshot: the inactive row is the later one
    assert one(silver.build_facility_history(lists), facility_id="G")["is_active"] is False
    events = silver.build_facility_status_changes(lists)
    got = sorted(
        (r["facility_id"], r["event_date"], r["old_status"] or "", r["new_status"])
        for r in events.collect()
    )
    assert got == [
        ("F", "2024-01-01", "", "Active"),
        ("F", "2024-02-01", "Active", "Inactive"),
        ("F", "2024-03-01", "Inactive", "Active"),
        ("F", "2024-04-01", "Active", "Inactive"),
        ("G", "2024-02-01", "", "Active"),
        ("G", "2024-02-01", "Active", "Inactive"),
    ]


def test_production(frame):
    ab = frame(
        [
            ("ABWI100010100308W402", "2024-01", "PROD", "OIL", "10", "2024-02-01"),
            ("ABWI100010100308W402", "2024-01", "PROD", "OIL", "12", "2024-03-01"),
            ("ABWI100010100308W402", "2024-01", "PROD", "GAS", "***", "2024-02-01"),
            ("ABWI100010100308W402", "2024-01", "DISP", "OIL", "99", "2024-02-01"),
            ("ABWI100010100308W4XX", "2024-01", "PROD", "COND", "5", "2024-02-01"),
        ],
        "fromtoid string, production_month string, activity_id string, product_id string,"
        " volume string, snapshot_date string",
    )
    sk = frame(
        [("SKWI100010100308W202", "2024-01", "PROD", "WATER", "1.234", "2024-02-01")],
        "from_to_ididentifier string, productionmonth string, activityid string, productid string,"
        " volume string, snapshot_date string",
    )
    got = silver.build_production({"ab": ab, "sk": sk})
    assert got.columns == [
        "productionmonth", "uwi", "province", "oil_prod_vol", "gas_prod_vol", "water_prod_vol",
    ]
    rows = sorted((r[1], r[2], float(r[3]), float(r[4]), float(r[5])) for r in got.collect())
    assert rows == [
        ("00/01-01-003-08W2/2", "SK", 0.0, 0.0, 1.234),
        ("00/01-01-003-08W4/2", "AB", 12.0, 0.0, 0.0),
        ("00/01-01-003-08W4/XX", "AB", 0.0, 0.0, 0.0),
    ]


def test_wells_merge_sources(frame):
    ab = frame(
        [
            (" 00/01-01-001-01W4/0", "ALFA 1", "A1", "20240131", "S", "2024-02-01"),
            ("00/01-01-001-02W4/0", "ALFA 2", " A1 ", "nan", "S", "2024-02-01"),
            ("00/09-09-001-09W4/0", "GONE", "A1", "nan", "S", "2024-01-01"),
        ],
        "uwi string, well_name string, licensee_code string, well_stat_date string,"
        " well_stat_code string, snapshot_date string",
    )
    bulletin = frame([("00/01-01-001-01W2/0", "SK OIL", "SK1")], "uwi string, licensee string, cwi string")
    confidential = silver.build_confidential_wells(
        {
            "confidential": frame(
                [
                    ("00/01-01-001-01W4/0", "OP", "2024-01-01"), ("00/01-01-001-02W4/0", "OP", "2024-01-01"),
                    ("00/01-01-001-02W4/0", None, "2024-01-02"),
                ],
                "uwi string, op_name string, snapshot_date string",
            )
        }
    )
    status = frame(
        [("00/01-01-001-02W4/0 ", dt.date(2024, 3, 1))], "uwi string, event_date date"
    )
    got = silver.build_wells(
        {"ab": ab, "sk_bulletin": bulletin, "confidential": confidential, "status": status}
    )
    assert got.count() == 3
    first = one(got, name="ALFA 1")
    assert first["uwi"] == "00/01-01-001-01W4/0" and first["stat_date"] == dt.date(2024, 1, 31)
    assert (first["was_ever_confidential"], first["is_currently_confidential"]) == (True, False)
    assert first["centroid_lat"] == pytest.approx(49.009062, abs=2e-6)
    second = one(got, name="ALFA 2")
    assert (second["licensee"], second["stat_date"]) == ("A1", dt.date(2024, 3, 1))
    assert second["is_currently_confidential"] is True
    sk = one(got, cwi="SK1")
    assert (sk["province"], sk["licensee"], sk["was_ever_confidential"]) == ("SK", "SK OIL", False)


def test_licences_take_issued_date(frame):
    daily = frame([("1", "A", dt.date(2024, 1, 1))], "licence_number string, licensee string, issue_date date")
    sk = frame([("1", "B", dt.date(2024, 1, 2))], "licence_number string, licensee string, issued_date date")
    got = silver.build_well_licences({"daily": daily, "sk": sk})
    assert sorted((r["province"], str(r["issue_date"])) for r in got.collect()) == [
        ("AB", "2024-01-01"), ("SK", "2024-01-02"),
    ]


def test_drilling_prefers_archive(frame):
    schema = "uwi string, spud_date date, name string"
    day = dt.date(2024, 1, 1)
    got = silver.build_drilling_activity(
        {
            "weekly": frame([("u", day, "W")], "uwi string, event_date date, name string"),
            "daily": frame([("u", day, "D"), ("v", day, "D")], schema),
            "archive": frame([("u", day, "A")], schema),
            "wells": frame([("u", "AB", "WELL U", 1.0)], "uwi string, province string, name string, centroid_lat double"),
        }
    )
    assert sorted((r["uwi"], r["source"], r["name"], r["well_name"] or "") for r in got.collect()) == [
        ("u", "st49_spud_archive", "A", "WELL U"), ("v", "st49_spud", "D", ""),
    ]


# aliases in GROUP BY and HAVING, scalar subqueries, NOT IN, windows, functions
ANALYST_SQL = [
    """SELECT trim(licensee) AS operator, count(*) AS total,
         sum(CASE WHEN mode = 'ABD' THEN 1 ELSE 0 END) AS abandoned
       FROM wells GROUP BY operator HAVING total >= 5 ORDER BY total DESC LIMIT 20""",
    """SELECT p.province, w.fluid, round(sum(p.oil_prod_vol)) AS oil_m3
       FROM production p JOIN wells w ON p.uwi = w.uwi
       WHERE p.productionmonth >= (SELECT min(productionmonth) FROM production)::STRING
       GROUP BY p.province, w.fluid HAVING oil_m3 > 0""",
    """SELECT uwi, name FROM wells
       WHERE uwi NOT IN (SELECT DISTINCT uwi FROM v_latest_production)""",
    """SELECT s.uwi, months_crossed(s.spud_date, CAST(min(p.productionmonth) || '-01' AS DATE)) AS m
       FROM spud_activity s JOIN production p ON s.uwi = p.uwi AND p.oil_prod_vol > 0
       GROUP BY s.uwi, s.spud_date ORDER BY m LIMIT 50""",
    """SELECT uwi, productionmonth, lag(oil_prod_vol) OVER (PARTITION BY uwi
         ORDER BY productionmonth) AS prev FROM production""",
    """SELECT * FROM well_licences WHERE issue_date >=
         (SELECT max(issue_date) FROM well_licences) - INTERVAL '90' DAY""",
    "SELECT normalize_operator_name(display_name) FROM operator_groups",
    "SELECT event_type, count(*) FROM v_new_activity GROUP BY ALL",
]


def test_bucketed_tables_join_without_a_shuffle(spark, table):
    wells = table("wells")
    counts = table("production").groupBy("uwi").agg(F.count(F.lit(1)).alias("months"))
    sinks.write_bucketed(wells, "wells_by_uwi", buckets=4)
    sinks.write_bucketed(counts, "months_by_uwi", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("wells_by_uwi").join(spark.table("months_by_uwi"), "uwi")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == counts.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_pipeline_end_to_end(spark, table, tmp_path):
    """Bronze, silver, views and export; a re-run of one month replaces it only."""
    root = str(tmp_path)
    volumes = table("volumetric").drop("uwi")
    wells = table("wells").withColumnsRenamed({"name": "well_name", "licensee": "licensee_code", "stat_code": "well_stat_code"})
    written = sinks.write_bronze(wells, CONTRACTS["ab_well_list"], root, "2024-02-01")
    sinks.write_bronze(wells.limit(5), CONTRACTS["ab_well_list"], root, "2024-01-01")
    bronze = {
        "ab_production": volumes,
        "ab_well_list": spark.read.parquet(written),
        "ab_confidential_wells": table("confidential_snapshots"),
        "ab_status_changes": table("status_changes"),
        "ab_licences_daily": table("licences"),
        "ab_spuds_daily": table("spuds"),
        "ab_facilities_active": table("facility_snapshots").where("is_active"),
        "ab_facilities_inactive": table("facility_snapshots").where("not is_active"),
    }
    results = build_all(spark, bronze, root)
    assert not [r for r in results.values() if r.startswith("error")], results
    assert set(results) == set(sinks.SILVER_TABLES) - {"pipelines", "pipeline_installations", "sk_pipelines"}
    names = sinks.register_views(spark, root)
    views = {
        "v_latest_production", "v_well_summary", "v_operator_scorecard", "v_monthly_provincial",
        "v_new_activity", "operator_groups", "facilities_by_operator", "licence_activity",
        "operator_aliases",
    }
    assert views <= set(names)
    assert spark.table("wells").count() == table("part").count()
    assert spark.table("v_well_summary").count() == table("part").count()
    total = "select sum(oil_prod_vol) from production"
    before = spark.sql(total).first()[0]

    months = spark.table("production").select("productionmonth", "province").distinct()
    assert dict(months.dtypes)["productionmonth"] == "string"
    month = months.where("province = 'AB'").agg(F.max("productionmonth")).first()[0]
    again = spark.table("production").where(
        (F.col("productionmonth") == month) & (F.col("province") == "AB")
    )
    kept = [tuple(r) for r in again.drop("_silver_version", "normalized_uwi").collect()]
    schema = again.drop("_silver_version", "normalized_uwi").schema
    redone = spark.createDataFrame(kept, schema).withColumn("oil_prod_vol", F.col("oil_prod_vol") + 1)
    sinks.write_production(redone, root)
    sinks.register_views(spark, root)
    assert spark.sql(total).first()[0] == before + len(kept)

    for sql in ANALYST_SQL:
        assert spark.sql(sql).count() > 0, sql

    paths = sinks.export(spark, ["wells"], "csv", str(tmp_path / "out"))
    paths += sinks.export(spark, ["v_operator_scorecard"], "parquet", str(tmp_path / "out"))
    assert spark.read.csv(paths[0], header=True).count() == table("part").count()
    assert spark.read.parquet(paths[1]).count() == spark.table("v_operator_scorecard").count()
    with pytest.raises(ValueError):
        sinks.export(spark, ["wells"], "xlsx", str(tmp_path / "out"))


def test_one_failing_table_does_not_stop_the_others(spark, frame, tmp_path):
    bad = frame([("x",)], "other string")
    results = build_all(
        spark, {"ab_spuds_daily": bad, "ab_licences_daily": frame([("1", "u")], "licence_number string, uwi string")},
        str(tmp_path),
    )
    assert results["spud_activity"].startswith("error")
    assert results["well_licences"].endswith("silver/well_licences")


def test_production_keeps_every_well_whatever_column_names_it(spark):
    from wellspring.plans import silver

    rows = [
        ("w1", None, "2024-01", "PROD", "OIL", "9", "2024-02-01"),
        ("w2", None, "2024-01", "PROD", "OIL", "100", "2024-02-01"),
        (" w2 ", None, "2024-01", "PROD", "OIL", "7", "2024-03-01"),
        (None, None, "2024-01", "PROD", "OIL", "1", "2024-02-01"),
        (None, " ", "2024-01", "PROD", "OIL", "2", "2024-02-01"),
    ]
    names = "uwi string, from_to_id string, productionmonth string, activityid string, productid string, volume string, snapshot_date string"
    made = silver.build_production({"ab": spark.createDataFrame(rows, names)}).collect()
    assert {r.uwi: float(r.oil_prod_vol) for r in made} == {"w1": 9.0, "w2": 7.0, None: 3.0}


def test_production_reads_each_input_once(spark):
    columns = "productionmonth string, activityid string, productid string, volume string, from_to_id string, snapshot_date string"
    rows = [
        ("2024-01", "PROD", "OIL", "1", "ABWI100010100308W402", "2024-02-01"),
        ("2024-01", "PROD", "OIL", "2", "ABWI100010100308W402", "2024-03-01"),
        ("2024-01", "PROD", "OIL", "4", None, "2024-02-01"),
        ("2024-01", "PROD", "OIL", "8", " ", "2024-02-01"),
    ]
    made = silver.build_production({"ab": spark.sparkContext.parallelize(rows, 2).toDF(columns)})
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1
    assert sorted((r.uwi, float(r.oil_prod_vol)) for r in made.collect() if r.uwi) == [("00/01-01-003-08W4/2", 2.0)]
    assert [float(r.oil_prod_vol) for r in made.collect() if r.uwi is None] == [12.0]
