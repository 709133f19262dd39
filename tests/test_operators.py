"""Operators against brute force, with hot keys, gaps, ties and nulls."""

import random

import pytest
from pyspark.sql import functions as F

from wellspring.operators import joins, keyed
from wellspring.operators.filters import drop_html
from wellspring.operators.sets import activity_feed, missing_and_extra
from wellspring.plans.cookbook import licences_on_same_legal
from wellspring.sources.lines import number_lines


@pytest.fixture
def history(spark):
    """A third of the rows under one key; states repeat and are sometimes null."""
    rng = random.Random(7)
    rows = []
    for key, n in [("hot", 300)] + [(f"k{i}", rng.randint(1, 40)) for i in range(30)]:
        for day in sorted(rng.sample(range(1000), n)):
            rows.append((key, day, rng.choice(["A", "B", None])))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, "k string, d int, s string").repartition(5)


@pytest.mark.parametrize("hot_rows", [0, 30, 100, 10**6])
def test_previous_by_equals_a_plain_lag(history, hot_rows):
    rows, df = history
    got = keyed.previous_by(df, ["k"], ["d"], ["d", "s"], F.floor(F.col("d") / 50), hot_rows)
    want = {}
    last = {}
    for k, d, s in sorted(rows, key=lambda r: (r[0], r[1])):
        want[(k, d)] = last.get(k)
        last[k] = (d, s)
    assert len(want) == got.count() == len(rows)
    for r in got.collect():
        before = (r["prev_d"], r["prev_s"]) if r["has_prev"] else None
        assert before == want[(r["k"], r["d"])]


def test_null_keys_have_no_previous_row(spark):
    df = spark.createDataFrame([(None, i) for i in range(9)] + [("a", 1), ("a", 2)], "k string, d int")
    for hot_rows in (0, 100):
        got = keyed.previous_by(df, ["k"], ["d"], ["d"], F.col("d"), hot_rows)
        assert [r["prev_d"] for r in got.where("has_prev").collect()] == [1]
        assert got.count() == 11


@pytest.mark.parametrize("hot_rows", [0, 30, 10**6])
def test_carry_forward(history, hot_rows):
    rows, df = history
    got = keyed.carry_forward(df, ["k"], "d", "s", F.floor(F.col("d") / 50), hot_rows)
    last, want = {}, {}
    for k, d, s in sorted(rows, key=lambda r: (r[0], r[1])):
        last[k] = s or last.get(k)
        want[(k, d)] = last[k]
    assert {(r["k"], r["d"]): r["s"] for r in got.collect()} == want


def test_latest_by_treats_null_as_one_key(spark, rows):
    df = spark.createDataFrame(
        [("a", 1), ("a", 3), (None, 2), (None, 9)], "k string, v int"
    )
    assert rows(keyed.latest_by(df, ["k"], [F.desc("v")])) == [("a", 3), (None, 9)]


def test_latest_by_limits_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = keyed.latest_by(df, ["k"], [F.desc("id")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_last_nonnull_is_per_column(spark):
    df = spark.createDataFrame(
        [("f", 1, "x", "p"), ("f", 2, None, "q"), ("f", 3, None, None)],
        "k string, d int, a string, b string",
    )
    got = df.groupBy("k").agg(
        *[keyed.last_nonnull(c, F.col("d")) for c in "ab"],
    ).first()
    assert tuple(got) == ("f", "x", "q")


def test_snapshot_changes_skip_gaps(spark, rows):
    df = spark.createDataFrame(
        [
            ("w1", "2024-01-01", "OLD A"), ("w1", "2024-02-01", "NEW A"),
            ("w2", "2024-01-01", "OLD B"), ("w2", "2024-03-01", "NEW B"),
            ("w3", "2024-02-01", "SAME"), ("w3", "2024-03-01", "SAME"),
        ],
        "uwi string, snapshot_date string, well_name string",
    )
    want = [("w1", "OLD A", "NEW A", "2024-02-01")]
    assert rows(keyed.snapshot_changes(df, "uwi", "snapshot_date", "well_name")) == want
    assert rows(keyed.snapshot_pairs(df, "uwi", "snapshot_date", "well_name")) == want


@pytest.mark.parametrize("block", [1, 3, 7, 1000])
def test_look_ahead_across_blocks(spark, block):
    lines = spark.createDataFrame(
        [(f, "", i, f"{f}{i}") for f, n in (("a", 23), ("b", 4)) for i in range(n)],
        "file string, member string, line_no bigint, value string",
    )
    if block < 4:
        # a block must hold the look-ahead; smaller ones are rejected
        with pytest.raises(ValueError):
            keyed.look_ahead(lines, {"n4": (F.col("value"), 4)}, block=block)
        return
    got = keyed.look_ahead(
        lines, {"n1": (F.col("value"), 1), "n4": (F.col("value"), 4)}, block=block
    ).collect()
    assert len(got) == 27
    size = {"a": 23, "b": 4}
    for r in got:
        for k in (1, 4):
            i = r["line_no"] + k
            assert r[f"n{k}"] == (f"{r['file']}{i}" if i < size[r["file"]] else None)


def test_number_lines(spark):
    df = spark.createDataFrame([("f", i * 7) for i in range(50)], "file string, at int")
    got = number_lines(df, ["file"], "at", F.floor(F.col("at") / 30))
    assert sorted((r["at"], r["line_no"]) for r in got.collect()) == [
        (i * 7, i) for i in range(50)
    ]


def test_not_in_follows_sql(spark, rows):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    some = spark.createDataFrame([("a",)], "k string")
    with_null = spark.createDataFrame([("a",), (None,)], "k string")
    assert rows(joins.not_in(left, some, "k")) == [("b",)]
    assert rows(joins.not_in(left, with_null, "k")) == []
    assert len(rows(joins.not_in(left, some.where("false"), "k"))) == 3


UWI = "{}/01-01-001-{}W4/0"


def legal_tables(spark):
    wells = [(UWI.format("00", f"{i:02}"), "CR-OIL", "PMP") for i in range(1, 13)]
    wells += [(UWI.format("02", "01"), "GAS", "SUS"), ("00/09-09-009-09W4/0", "GAS", "SUS")]
    licences = [
        (f"{i:07}", UWI.format("03" if i % 2 else "00", "01"), f"L{i % 3}", f"2024-01-{i + 1:02}")
        for i in range(20)
    ] + [("9", "00/09-09-009-09W4/0", "L9", "2024-01-31")]
    w = spark.createDataFrame(wells, "uwi string, fluid string, mode string")
    columns = "licence_number string, uwi string, licensee string, issue_date string"
    lic = spark.createDataFrame(licences, columns).withColumn(
        "issue_date", F.col("issue_date").cast("date")
    )
    return wells, licences, w, lic


def test_same_legal_counts_pairs_without_listing_them(spark):
    wells, licences, w, lic = legal_tables(spark)
    got = {r["licence_number"]: r["other_wells"] for r in joins.same_legal(lic, w).collect()}
    want = {}
    for number, uwi, *_ in licences:
        n = sum(x[0][3:14] == uwi[3:14] and x[0] != uwi for x in wells)
        if n:
            want[number] = n
    assert got == want


@pytest.mark.parametrize("k", [1, 7, 500])
def test_licences_on_same_legal_is_exact(spark, k):
    wells, licences, w, lic = legal_tables(spark)
    as_of = F.lit("2024-01-31").cast("date")
    got = [tuple(r) for r in licences_on_same_legal(lic, w, as_of, k=k).collect()]
    pairs = [
        (d, number, uwi, who, x[0], x[1], x[2])
        for number, uwi, who, d in licences
        for x in wells
        if x[0][3:14] == uwi[3:14] and x[0] != uwi
    ]
    pairs.sort(key=lambda p: p[1:5])
    pairs.sort(key=lambda p: p[0], reverse=True)
    assert [(str(g[3]), g[0], g[1], g[2], g[4], g[5], g[6]) for g in got] == pairs[:k]


def test_activity_feed_takes_either_licence_date(spark, rows):
    licences = spark.sql("select 'u' uwi, cast(null as date) issue_date, date'2024-01-02' issued_date")
    spuds = spark.sql("select 'v' uwi, date'2024-01-03' spud_date")
    changes = spark.sql("select 'w' uwi, cast(null as date) event_date")
    got = rows(activity_feed(licences, spuds, changes), "uwi", "event_type")
    assert got == [("u", "licence"), ("v", "spud")]


def test_drop_html(spark):
    df = spark.createDataFrame([("x", 1), ("<HTML>", 2)], "a string, b int").withColumn(
        "<!doctype html>", F.lit(1)
    )
    assert [tuple(r) for r in drop_html(df).collect()] == [("x", 1)]


def test_missing_and_extra():
    assert missing_and_extra(["a", "x", "province"], ["a", "b"], ["province"]) == (["b"], ["x"])


def test_previous_row_does_not_depend_on_what_counts_as_hot(spark):
    from pyspark.sql import functions as F

    from wellspring.operators import keyed

    rows = [("a", None, 0), ("a", "2024-01-05", 1), ("a", "2024-02-01", 2), ("b", None, 3), (None, None, 4)]
    df = spark.createDataFrame(rows, "k string, d string, v int")
    got = [
        sorted(
            map(tuple, keyed.previous_by(df, ["k"], ["d"], ["v"], F.substring("d", 1, 7), hot_rows=n).collect()),
            key=str,
        )
        for n in (1, 5_000_000)
    ]
    assert got[0] == got[1] and ("a", "2024-01-05", 1, 0, True) in got[0]
