"""Readers over small files in the published shapes."""

import datetime as dt
import io
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from wellspring.sources import archives, features, lines, reports, snapshots, tables


@pytest.fixture
def put(tmp_path):
    """Write a file and return its path."""

    def write(name, content, encoding="utf-8"):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        data = content if isinstance(content, bytes) else content.encode(encoding)
        path.write_bytes(data)
        return str(path)

    return write


def zipped(**members):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, data in members.items():
            z.writestr(name.replace("__", "."), data)
    return out.getvalue()


def pairs(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


# --- lines ------------------------------------------------------------------


def test_read_lines_numbers_split_files(spark, put, tmp_path):
    """Files are cut into many blocks, the numbers still follow the file."""
    for name, n in (("a.txt", 400), ("b.txt", 3)):
        put(f"in/{name}", "\n".join(f"{name} {i} {'x' * 40}" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = lines.read_lines(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 403
    for r in got:
        assert r["value"].split()[:2] == [r["file"].rsplit("/", 1)[1], str(r["line_no"])]


def test_read_lines_picks_one_encoding_per_file(spark, put, tmp_path):
    put("in/utf.txt", "é\r\nplain")
    put("in/win.txt", "“é”\nplain", "cp1252")
    put("in/bom.txt", "﻿é")
    got = {
        (r["file"].rsplit("/", 1)[1], r["line_no"]): r["value"]
        for r in lines.read_lines(spark, str(tmp_path / "in")).collect()
    }
    assert got == {
        ("utf.txt", 0): "é", ("utf.txt", 1): "plain",
        ("win.txt", 0): "“é”", ("win.txt", 1): "plain", ("bom.txt", 0): "é",
    }


# --- archives ---------------------------------------------------------------


def test_archives(spark, put, tmp_path):
    put("z/one.zip", zipped(readme__md=b"no", list__TXT="é\nb".encode("latin-1")))
    inner = {"m1__zip": zipped(a__txt=b"a1\na2"), "m2__zip": zipped(b__txt=b"b1"), "m3__zip": b"PK broken"}
    put("z/year.zip", zipped(**inner))
    put("z/page.zip", b"<!DOCTYPE html><html>gone</html>")
    put("z/plain.txt", b"p1")
    got = {
        (r["file"].rsplit("/", 1)[1], r["member"], r["line_no"]): r["value"]
        for r in archives.archive_lines(spark, str(tmp_path / "z")).collect()
    }
    assert got == {
        ("one.zip", "list.TXT", 0): "é", ("one.zip", "list.TXT", 1): "b",
        ("year.zip", "m1.zip/a.txt", 0): "a1", ("year.zip", "m1.zip/a.txt", 1): "a2",
        ("year.zip", "m2.zip/b.txt", 0): "b1", ("plain.txt", "", 0): "p1",
    }


def test_archive_prefers_named_member(spark, put):
    path = put("l.zip", zipped(notes__txt=b"n", WellList__txt=b"w"))
    got = archives.archive_lines(spark, path, prefer="welllist").collect()
    assert [r["value"] for r in got] == ["w"]


def test_archive_csv_with_encoding_fallback(spark, put):
    text = "ProductionMonth,ActivityID,ProductID,Volume,FromToIDIdentifier\n2024-01,PROD,OIL,1.5,é"
    path = put("v.zip", zipped(v__zip=zipped(v__csv=text.encode("cp1252"))))
    found = archives.archive_lines(spark, path, ".csv", encodings=archives.FALLBACKS)
    got = tables.table_from_lines(found, tables.VOLUMETRIC_ALIASES)
    assert pairs(got, "productionmonth", "volume", "from_to_id") == [("2024-01", "1.5", "é")]


def test_archive_lines_span_batches(spark, put, monkeypatch):
    n = archives.BATCH + 5
    path = put("big.zip", zipped(b__txt="\n".join(map(str, range(n)))))
    got = archives.archive_lines(spark, path)
    assert got.where(F.col("line_no").cast("string") == F.col("value")).count() == n


# --- reports ----------------------------------------------------------------

TABBED = """ST LIST
printed 2024

Facility ID\tFacility Name\tOperator Name\tSub-Type\tStatus
ABBT0001\tALFA 1\tALFA OIL\tCrude Oil Battery\tActive
ABBT0002\tALFA 2\t\tGas Plant
ABBT0003\ta\tb\tc\td\te\ttoo wide
Total Rows: 2
"""
SPACED = """LIST
Facility ID   Facility Name   Operator Name
ABBT0009      BRAVO 1         BRAVO OIL CORP
"""


def test_facility_report(spark, put, tmp_path):
    put("f/2024-01-01_active.txt", TABBED)
    put("f/2024-02-01_active.txt", SPACED)
    put("f/2024-03-01_active.txt", "facility_id|operator_name\nABBT0010|C")
    got = reports.read_facility_report(spark, str(tmp_path / "f"))
    assert pairs(got.where("facility_id <> 'ABBT0010'"), "facility_id", "facility_name", "sub_type") == [
        ("ABBT0001", "ALFA 1", "Crude Oil Battery"),
        ("ABBT0002", "ALFA 2", "Gas Plant"),
        ("ABBT0009", "BRAVO 1", None),
    ]
    assert pairs(got.where("operator_name is null"), "facility_id") == [("ABBT0002",)]
    assert pairs(got.where("facility_id = 'ABBT0010'"), "operator_name") == [("C",)]


def licence_block(number, name="WELL", company="ALFA OIL LTD.", rights="FREEHOLD"):
    return [
        f" {name} {number}   {number:07}   {rights}   600.1M",
        " 100/04-14-090-14W4/02   N 10 E 20    1500M",
        " NEW   FIELD   ZONE",
        " DRILL   PRODUCTION   OIL",
        f" {company}      04-14-090-14W4",
    ]


def parse_blocks(spark, text_lines, file="2024-05-06_WELLS.TXT"):
    df = spark.createDataFrame(
        [(file, "", i, v) for i, v in enumerate(text_lines)], lines.LINE_SCHEMA
    )
    return reports.parse_licence_blocks(df)


def test_licence_blocks(spark):
    page = ["DAILY LIST", ""] + licence_block(1) + [""] + licence_block(2, company="-----")
    page += licence_block(3, company="UWI: X") + licence_block(4, company="AB", rights="CROWN")
    page += licence_block(5, rights="ALBERTA CROWN") + licence_block(1, name="AGAIN")
    page += ["  NAME 0000099  FREEHOLD"]
    got = parse_blocks(spark, page)
    assert pairs(got, "licence_number", "well_name", "licensee", "uwi") == [
        ("0000001", "WELL 1", "ALFA OIL LTD.", "100/04-14-090-14W4/02"),
        ("0000002", "WELL 2", None, "100/04-14-090-14W4/02"),
        ("0000003", "WELL 3", None, "100/04-14-090-14W4/02"),
        ("0000004", "WELL 4", None, "100/04-14-090-14W4/02"),
        ("0000005", "WELL 5", "ALFA OIL LTD.", "100/04-14-090-14W4/02"),
        ("0000099", "NAME", None, None),
    ]
    assert got.select("issue_date").distinct().first()[0] == dt.date(2024, 5, 6)


@pytest.mark.parametrize("page", [5, 8, 1000])
def test_overlapping_blocks_by_brute_force(spark, page):
    """Start lines anywhere: a kept block hides the starts in its five lines."""
    rng = random.Random(page)
    starts = sorted(rng.sample(range(300), 120))
    kept, free = [], -1
    for n in starts:
        if n >= free:
            kept.append(n)
            free = n + 5
    df = spark.createDataFrame([("f", "", n, "") for n in starts], lines.LINE_SCHEMA)
    got = reports.without_overlaps(df, 5, page)
    assert sorted(r["line_no"] for r in got.collect()) == kept


def test_spud_lines(spark, put):
    name = "ALFA 1 HZ"
    body = [
        f" 00/01-02-003-04W5/0  {name:<30}0123456  NEW",
        "   BIG RIG 7   ",
        f" 00/01-02-003-05W5/0  {name}",
        " CONTRACTOR LIST",
        " 00/01-02-003-06W5/0  LAST",
    ]
    path = put("2024-03-04_SPUD.txt", "\n".join(body), "latin-1")
    got = reports.read_spuds(spark, path)
    columns = ("uwi", "well_name", "licence_number", "drilling_contractor")
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == [
        ("00/01-02-003-04W5/0", name, "0123456", "BIG RIG 7"),
        ("00/01-02-003-05W5/0", name, None, ""),
        ("00/01-02-003-06W5/0", "LAST", None, ""),
    ]
    assert got.select("spud_date").distinct().first()[0] == dt.date(2024, 3, 4)


def test_confidential(spark, put):
    def row(*cells):
        widths = (21, 10, 7, 36, 36, 20)
        return "".join(f"{c:<{w}}" for c, w in zip(cells, widths))

    body = [
        "Confidential Well List", "=" * 40, row("UWI", "LICENCE", "OP", "NAME", "TYPE", "DATE"),
        row("00/01-02-003-04w5/0", "0123456", "A5D4", "ALFA OIL", "CONF", "12/31/2024"),
        row("00/01-02-003-05W5/0", "0123457", "A5D4", "ALFA OIL", "CONF", "no date avail"),
        row("short", "1", "A", "B", "C", ""), "",
    ]
    got = reports.read_confidential(spark, put("2024-01-01.txt", "\n".join(body)))
    rows = sorted(got.select("uwi", "op_name", "release_date_parsed").collect())
    assert [tuple(r) for r in rows] == [
        ("00/01-02-003-04W5/0", "ALFA OIL", dt.date(2024, 12, 31)),
        ("00/01-02-003-05W5/0", "ALFA OIL", None),
    ]


# --- tables -----------------------------------------------------------------


def test_well_list_positional_and_with_header(spark, put, tmp_path):
    wide = ["00/01-01-001-01W4/0", "1", "", "É WELL"] + [""] * 17 + ["HZ"]
    short = ["00/01-01-001-02W4/0", "2"]
    long = wide + ["extra", "cells"]
    body = "\n".join("\t".join(r) for r in (wide, short, long))
    put("w/a.txt", body, "latin-1")
    put("w/b.txt", "UWI\tMode\tWell Name\n00/01-01-001-03W4/0\tABD\tX")
    got = tables.read_well_list(spark, str(tmp_path / "w"))
    rows = sorted((tuple(r) for r in got.select("uwi", "well_name", "mode", "structure").collect()), key=repr)
    assert rows == [
        ("00/01-01-001-01W4/0", "É WELL", None, "HZ"),
        ("00/01-01-001-02W4/0", None, None, None),
        ("00/01-01-001-03W4/0", "X", "ABD", None),
    ]


def test_well_list_keeps_extra_columns(spark, put):
    cells = [f"c{i}" for i in range(24)]
    got = tables.read_well_list(spark, put("x.txt", "\t".join(cells))).first()
    assert got["uwi"] == "c0" and got["structure"] == "c21" and got["extra"] == ["c22", "c23"]


def test_volumetric_headers_may_differ_between_files(spark, put, tmp_path):
    put("v/2024-01.csv", "﻿ProductionMonth,ActivityID,ProductID,Volume,Hours,FromToIDIdentifier\n2024-01,PROD,OIL,1.5,700,ABWI1\n")
    put("v/2024-02.csv", "Volume,Production Month,Activity ID,Product ID,Well\r\n2.5,2024-02,PROD,GAS,00/W\r\n9,9,9,9,9,9\r\n")
    put("v/2024-03.csv", "Facility ID,ProductionMonth,Volume\n00/01-01-001-01W4/0,2024-03,3\nABBT01,2024-03,4\n")
    got = tables.read_volumetric(spark, str(tmp_path / "v"))
    columns = ("productionmonth", "productid", "volume", "hours_on", "from_to_id", "uwi", "province")
    assert sorted((tuple(r) for r in got.select(*columns).collect()), key=repr) == [
        ("2024-01", "OIL", "1.5", "700", "ABWI1", None, "AB"),
        ("2024-02", "GAS", "2.5", None, None, "00/W", "AB"),
        ("2024-03", None, "3", None, None, "00/01-01-001-01W4/0", "AB"),
        ("2024-03", None, "4", None, None, None, "AB"),
    ]


def test_table_rows_of_split_files(spark, put):
    n = 300
    path = put("big.csv", "BA ID,Name\n" + "\n".join(f'{i},"n, ""{i}"""' for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = tables.read_reference_csv(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((int(r["ba_id"]), r["name"], r["province"]) for r in got) == [
        (i, f'n, "{i}"', "SK") for i in range(n)
    ]


def test_uniform_table_is_one_scan(spark, put, tmp_path):
    header = "ProductionMonth,ActivityID,ProductID,Volume,FromToID\n"
    put("u/a.csv", header + '2024-01,PROD,OIL,"1.5",A\n2024-01,PROD\n')
    put("u/b.csv", header + "2024-02,PROD,GAS,2.5,B,too,wide\n2024-02,PROD,GAS,3.5,C\n")
    got = tables.read_volumetric(spark, str(tmp_path / "u"), uniform=True)
    rows = [tuple(r) for r in got.select("productionmonth", "volume", "from_to_id").collect()]
    assert sorted(rows, key=repr) == [
        ("2024-01", "1.5", "A"), ("2024-01", None, None), ("2024-02", "3.5", "C"),
    ]
    both = tables.read_volumetric(spark, str(tmp_path / "u"))
    again = both.select("productionmonth", "volume", "from_to_id").collect()
    assert sorted(map(tuple, again), key=repr) == sorted(rows, key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_uniform_table_refuses_another_header(spark, put, tmp_path):
    put("u/a.csv", "UWI,Operator\nU1,A\n")
    put("u/b.csv", "Operator,UWI\nB,U2\n")
    aliases = {"uwi": ["uwi"], "operator": ["operator"]}
    with pytest.raises(Exception, match="(?i)header"):
        tables.read_uniform_table(spark, str(tmp_path / "u"), aliases).collect()
    got = tables.read_table(spark, str(tmp_path / "u"), aliases)
    assert pairs(got, "uwi", "operator") == [("U1", "A"), ("U2", "B")]


def test_status_changes(spark, put):
    path = put(
        "2026-02-21_WeeklyStatusChangesReport.csv",
        "﻿00.UnFormatted UWI,01.Formatted UWI,02.Well Name,03.Lic No,08.StatCurrDesc,10.StatPrevDesc\n"
        "1,00/01-01-001-01W4/0,X,123,Abandoned,\"Pumping, oil\"\n",
    )
    got = tables.read_status_changes(spark, path).first()
    assert (got["uwi"], got["licence"], got["new_status"], got["old_status"]) == (
        "00/01-01-001-01W4/0", "123", "Abandoned", "Pumping, oil",
    )
    assert (got["event_type"], got["event_date"]) == ("status_change", dt.date(2026, 2, 21))


def test_weekly_drilling(spark, put):
    path = put("2026-02-21_Drilling.csv", "01.Formatted UWI,08.Lic#,13.FDD,15.SpudDate\nU,7,x,2026-02-01\n")
    got = tables.read_drilling(spark, path).first()
    assert (got["uwi"], got["licence"], got["drill_date"], got["spud_date"]) == (
        "U", "7", None, dt.date(2026, 2, 1),
    )


def test_well_facility_link(spark, put):
    path = put(
        "l.csv",
        "WellID,WellLegalSubdivision,WellSection,WellTownship,WellRange,WellMeridian,LinkedStartDate\n"
        "W1,1,2,3,4,5,2024-01-02\nW2,1,2,3,4,,bad\n",
    )
    rows = {r["well_id"]: r for r in tables.read_well_facility_link(spark, path).collect()}
    assert rows["W1"]["well_dls"] == "01-02-003-04W5"
    assert rows["W1"]["link_start_date"] == dt.date(2024, 1, 2)
    assert rows["W2"]["well_dls"] is None and rows["W2"]["link_start_date"] is None


def test_catalogue_links_and_disposal(spark, put):
    link = put("c.csv", "Well Identifier,Linked Facility ID,Effective Date\nU,F,20240102\n")
    got = tables.read_catalogue_links(spark, link).first()
    assert (got["uwi"], got["facility_id"], got["effective_date"]) == ("U", "F", dt.date(2024, 1, 2))
    disposal = put("d.csv", "Well ID,Approval No,Operator,Status\nU,7,ALFA,Active\n")
    got = tables.read_disposal(spark, disposal).first()
    assert (got["uwi"], got["approval_number"], got["approval_holder"], got["scheme_status"]) == (
        "U", "7", "ALFA", "Active",
    )


def test_sk_tables(spark, put):
    drilling = put(
        "d.csv",
        "Canadian Well Identifier,Drilling Start Date,Contractor Name,Surface Legal Subdivision,"
        "Surface Section,Surface Township,Surface Range,Surface Meridian\n"
        "SK1,2024-01-02,RIG,1,2,3,4,W2\nSK2,bad,RIG,,2,3,4,W2\n",
    )
    rows = {r["cwi"]: r for r in tables.read_sk_drilling(spark, drilling).collect()}
    assert (rows["SK1"]["uwi"], rows["SK1"]["spud_date"]) == (
        "00/01-02-003-04W2/0", dt.date(2024, 1, 2),
    )
    assert rows["SK2"]["uwi"] is None and rows["SK2"]["spud_date"] is None
    bulletin = put("b.csv", "CWI,UWI,Licence Number,Issued Date,Target Pool Name\nSK1,U,7,2024-01-02,P\n")
    got = tables.read_sk_bulletin(spark, bulletin).first()
    assert (got["cwi"], got["issued_date"], got["pool_name"]) == ("SK1", dt.date(2024, 1, 2), "P")


def test_pipe_table(spark, put):
    got = tables.read_pipe_table(spark, put("m.txt", "UWI|Well Name\nU1|A\nU2\nU3|B|C\n"))
    assert sorted(tuple(r) for r in got.select("uwi", "well_name").collect() if r["uwi"] != "U2") == [
        ("U1", "A")
    ]
    assert got.where("uwi = 'U2' and well_name is null").count() == 1


def test_provincial_stats(spark, put, tmp_path):
    put("s/ST3_Oil_2024.csv", "Alberta supply\n,\nMonth,Production (m3)\nJanuary,10\n,\nFebruary,12\n")
    put("s/Gas_prices_2023.csv", "Year,Price\n2023,2.5\n")
    got = tables.shape_provincial_stats(lines.read_lines(spark, str(tmp_path / "s")))
    rows = sorted(
        (r["product_type"], r["source_year"], tuple(sorted(r["values"].items())))
        for r in got.collect()
    )
    assert rows == [
        ("gas_prices", "2023", (("price", "2.5"), ("year", "2023"))),
        ("oil", "2024", (("month", "February"), ("production_m3", "12"))),
        ("oil", "2024", (("month", "January"), ("production_m3", "10"))),
    ]


# --- features, snapshots ----------------------------------------------------


def test_line_features(spark, put):
    page = """{"type": "FeatureCollection", "features": [
      {"properties": {"LICENCENUMBER": "PL-1", "SHAPE.LEN": 12.5},
       "geometry": {"type": "LineString", "coordinates": [[-106, 50], [-105, 51, 7]]}},
      {"properties": {"LICENCENUMBER": "PL-2", "SHAPE.LEN": "bad"},
       "geometry": {"type": "LineString", "coordinates": [[-104, 52]]}},
      {"properties": {"LICENCENUMBER": "PL-3"}, "geometry": {"coordinates": []}},
      {"properties": {"LICENCENUMBER": "PL-4"}, "geometry": null}]}"""
    got = features.read_line_features(spark, put("p.json", page))
    assert pairs(got.where("length_m is not null"), "licence_number", "length_m", "from_lat", "to_lon", "substance") == [
        ("PL-1", 12.5, 50.0, -105.0, "")
    ]
    assert pairs(got.where("length_m is null"), "licence_number", "from_lat", "to_lat") == [
        ("PL-2", 52.0, 52.0)
    ]


def test_snapshots_by_file_name_and_schema_drift(spark, tmp_path):
    one = spark.createDataFrame([("a", 1)], "uwi string, n int").toPandas()
    two = spark.createDataFrame([("b", "x")], "uwi string, extra string").toPandas()
    folder = tmp_path / "bronze"
    folder.mkdir()
    one.to_parquet(folder / "2024-01-01.parquet")
    two.to_parquet(folder / "2024-02-01.parquet")
    every = snapshots.all_snapshots(spark, str(folder))
    assert every.count() == 2 and {"n", "extra"} <= set(every.columns)
    assert [r["uwi"] for r in snapshots.latest_snapshot(every).collect()] == ["b"]
    months = snapshots.read_months(spark, str(folder))
    assert set(months.columns) == {"uwi", "n", "extra"}


def test_latest_snapshot_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.sql("select * from values ('a','2024-01-01'),('b','2024-02-01') t(uwi, snapshot_date)").write.partitionBy(
        "snapshot_date"
    ).parquet(path)
    df = snapshots.latest_snapshot(spark.read.parquet(path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*snapshot_date", plan)
    assert [r["uwi"] for r in df.collect()] == ["b"]


def test_lookup(spark, put):
    got = snapshots.load_lookup(spark, put("fields.csv", "Field Code,Field Name\n01,ALFA\n"))
    assert got.columns == ["field_code", "field_name"]


def test_every_member_of_an_archive_is_read(spark, tmp_path):
    import io
    import zipfile

    from wellspring.sources import archives

    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("c.txt", "three")
    with zipfile.ZipFile(tmp_path / "all.zip", "w") as z:
        z.writestr("a.txt", "one")
        z.writestr("b.txt", "two")
        z.writestr("inner.zip", inner.getvalue())
    lines = archives.archive_lines(spark, str(tmp_path / "all.zip")).collect()
    assert {"one", "two", "three"} == {v for r in lines for v in r if v in ("one", "two", "three")}
