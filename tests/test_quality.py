import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from wellspring.contracts import CONTRACTS, DAILY, WEEKLY, Contract, contract_table, due, spatial
from wellspring.plans import quality

AS_OF = dt.date(2024, 6, 1)
CONTRACT = Contract(
    "wells", "AB", "monthly", ("uwi",), ("uwi", "name"), ("uwi", "name"), min_rows=2,
    max_row_delta_pct=20.0,
)


@pytest.fixture
def verdicts(spark):
    """Check name -> (passed, measure) of the full report."""

    def run(rows, schema, contract=CONTRACT, previous=None):
        df = spark.createDataFrame(rows, schema)
        got = quality.report(df, contract, F.lit(AS_OF), previous)
        return {r["check"]: (r["passed"], r["measure"]) for r in got.collect()}

    return run


GOOD = "00/01-01-001-01W4/0"


def test_clean_table_passes(verdicts):
    got = verdicts([(GOOD, "a"), ("00/01-01-001-02W4/0", "b")], "uwi string, name string")
    assert all(passed for passed, _ in got.values())
    assert set(got) == set(quality.CHECKS)


def test_three_of_four_null_fails(verdicts):
    rows = [("a", None), ("b", None), ("c", None), ("d", "x")]
    assert verdicts(rows, "uwi string, name string")["null_rates"] == (False, 0.75)
    rows[0] = ("a", "y")
    assert verdicts(rows, "uwi string, name string")["null_rates"] == (True, 0.5)


def test_missing_required_column(verdicts):
    got = verdicts([(GOOD,)], "uwi string")
    assert got["required_columns"] == (False, 1.0)
    assert got["schema_drift"] == (False, 1.0)


def test_duplicates_count_every_row_and_null_keys(verdicts):
    rows = [("a", "x"), ("a", "y"), ("a", "z"), (None, "p"), (None, "q"), ("b", "r")]
    assert verdicts(rows, "uwi string, name string")["primary_key_uniqueness"] == (False, 5.0)


def test_missing_key_column_fails(verdicts):
    got = verdicts([("x",)], "name string")
    assert got["primary_key_uniqueness"] == (False, None)
    assert got["uwi_format"] == (True, None)


def test_min_rows_and_empty_table(verdicts):
    got = verdicts([], "uwi string, name string, event_date date")
    assert got["min_rows"] == (False, 0.0)
    assert got["null_rates"][0] and got["uwi_format"][0] and got["date_sanity"][0]


def test_dates(verdicts):
    rows = [
        (GOOD, "a", "2024-01-01", "1899-12-31"),
        ("u2", "b", "2024-07-31", "20240101"),
        ("u3", "c", "2024-08-01", "nan"),
    ]
    got = verdicts(rows, "uwi string, name string, spud_date string, stat_date string")
    # 60 days ahead is still fine
    assert got["date_sanity"] == (False, 2.0)
    assert got["date_range"] == (True, 213.0)


def test_uwi_share(verdicts):
    rows = [(GOOD, "a"), ("x", "b"), (None, "c")]
    assert verdicts(rows, "uwi string, name string")["uwi_format"] == (True, 0.5)
    rows.append(("y", "d"))
    assert verdicts(rows, "uwi string, name string")["uwi_format"][0] is False


@pytest.mark.parametrize("before, passed", [(2, True), (3, False), (0, True)])
def test_drift_against_previous(spark, verdicts, before, passed):
    previous = spark.range(before)
    rows = [(GOOD, "a"), ("u", "b")]
    assert verdicts(rows, "uwi string, name string", previous=previous)["row_count_drift"][0] is passed


def test_stale_and_coverage(verdicts):
    rows = [(GOOD, "a", "2024-03-02", 1.0), ("u", "b", "2024-03-03", None)]
    schema = "uwi string, name string, snapshot_date string, centroid_lat double"
    got = verdicts(rows, schema)
    assert got["stale_snapshot"] == (True, 90.0)
    assert got["coordinate_coverage"] == (True, 0.5)
    rows[1] = ("u", "b", "2024-03-02", None)
    assert verdicts(rows, schema)["stale_snapshot"] == (False, 91.0)


def test_report_is_one_pass(spark):
    df = spark.range(10).withColumns({"uwi": F.col("id").cast("string"), "name": F.lit("x")})
    plan = quality.report(df, CONTRACT, F.lit(AS_OF))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 10") == 1


def test_write_report(spark, tmp_path):
    df = spark.createDataFrame([(GOOD, "a")], "uwi string, name string")
    out = str(tmp_path / "reports")
    for _ in range(2):
        quality.write_report(quality.report(df, CONTRACT, F.lit(AS_OF)), out)
    files = list((tmp_path / "reports" / "dataset=wells").glob("*.json"))
    lines = [json.loads(x) for f in files for x in f.read_text().splitlines()]
    assert len(lines) == 2 * len(quality.CHECKS)
    assert {x["all_passed"] for x in lines} == {False}


def test_snapshot_drift(spark):
    rows = [("2024-01", 10), ("2024-02", 8), ("2024-03", 13)]
    df = spark.createDataFrame([(m, i) for m, n in rows for i in range(n)], "snapshot_date string, i int")
    got = {r["snapshot_date"]: (r["passed"], r["measure"]) for r in quality.snapshot_drift(df, 50).collect()}
    assert got == {"2024-01": (True, None), "2024-02": (True, 20.0), "2024-03": (False, 62.5)}


def test_contracts(spark):
    assert len(CONTRACTS) == 32
    assert {c.cadence for c in CONTRACTS.values()} == {DAILY, WEEKLY, "monthly"}
    assert [c.id for c in due(WEEKLY)] == ["ab_status_changes", "ab_weekly_drilling"]
    assert len(spatial()) == 5
    table = contract_table(spark)
    assert table.where("cadence = 'weekly' and province = 'AB'").count() == 2
