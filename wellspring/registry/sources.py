"""Round trips: a table is rendered in a published file shape and parsed back.

The rendered lines are derived from the whole table by Spark; the check is the
plain table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspring.constants import (
    CONFIDENTIAL_FIELDS,
    DRILLING_ALIASES,
    SK_BULLETIN_ALIASES,
    SK_DRILLING_ALIASES,
    STATUS_CHANGE_ALIASES,
    VOLUMETRIC_ALIASES,
    WELL_FACILITY_LINK_COLUMNS,
    WELL_LIST_COLUMNS,
)
from wellspring.fixtures import uwi_of
from wellspring.functions.text import decode_text, file_date
from wellspring.registry import query
from wellspring.sources import features, reports, snapshots, tables
from wellspring.sources.lines import number_lines


def text(column: str | Column) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit(""))


def numbered(df: DataFrame, per_record: int, *values: Column, first: int) -> DataFrame:
    """Lines of records: record ``_n`` (from 0) of a file takes ``per_record`` lines."""
    lines = F.posexplode(F.array(*values)).alias("_i", "value")
    return df.select("file", F.lit("").alias("member"), "_n", lines).select(
        "file",
        "member",
        (F.col("_n") * per_record + F.col("_i") + first).cast("bigint").alias("line_no"),
        "value",
    )


def with_header(df: DataFrame, body: DataFrame, *header: str) -> DataFrame:
    """The same header lines on top of every file."""
    top = df.select("file").distinct().select(
        "file",
        F.lit("").alias("member"),
        F.posexplode(F.array(*[F.lit(h) for h in header])).alias("line_no", "value"),
    )
    return body.unionByName(top.withColumn("line_no", F.col("line_no").cast("bigint")))


def placed_in_file(df: DataFrame, bucket: Column | None = None) -> DataFrame:
    """Record numbers (``_n``) inside each file, in the order of ``_order``."""
    bucket = F.floor(F.col("_order") / 1000) if bucket is None else bucket
    return number_lines(df, ["file"], "_order", bucket).withColumnRenamed("line_no", "_n")


def sheet(
    df: DataFrame, columns: dict[str, Column], sep: str = ",", bucket: Column | None = None
) -> DataFrame:
    """A delimited table per file; ``_order`` sorts the rows of a file."""
    placed = placed_in_file(df, bucket)

    def cell(c: Column) -> Column:
        if sep != ",":
            return text(c)
        quoted = F.concat(F.lit('"'), F.replace(text(c), F.lit('"'), F.lit('""')), F.lit('"'))
        return F.when(text(c).contains(",") | text(c).contains('"'), quoted).otherwise(text(c))

    row = F.concat_ws(sep, *[cell(c) for c in columns.values()])
    return with_header(df, numbered(placed, 1, row, first=1), sep.join(columns))


# --- reports ----------------------------------------------------------------


@query(
    "s01_facility_report",
    """select facility_id, snap as snapshot_date, operator_name, sub_type, status from (
      select lpad(facility_id, 7, '0') as facility_id, cast(snapshot_date as varchar) as snap,
        operator_name, sub_type, if(is_active, 'Active', 'Inactive') as status
      from {facility_snapshots})""",
)
def s01(t):
    """Half of the daily files are tab separated, half by wide gaps."""
    df = t("facility_snapshots").withColumns(
        {
            "file": F.concat(F.col("snapshot_date").cast("string"), F.lit("_facilities.txt")),
            "_order": F.col("facility_id").cast("bigint"),
        }
    )
    placed = placed_in_file(df)
    tabbed = F.dayofmonth("snapshot_date") % 2 == 0
    cells = [
        F.lpad("facility_id", 7, "0"),
        F.col("sub_type"),
        F.coalesce("operator_name", F.lit("")),
        F.when(F.col("is_active"), "Active").otherwise("Inactive"),
    ]
    # a wide-gap report cannot show an empty cell, so these files print a dash
    gap = [F.when(c == "", F.lit("-")).otherwise(c) for c in cells]
    row = F.when(tabbed, F.concat_ws("\t", *cells)).otherwise(F.concat_ws("   ", *gap))
    names = ["Facility ID", "Sub-Type", "Operator Name", "Status"]
    head = F.when(tabbed, F.lit("\t".join(names))).otherwise(F.lit("   ".join(names)))
    tops = (
        df.select("file", "snapshot_date").distinct()
        .select("file", F.posexplode(F.array(F.lit("Public list"), F.lit(""), head)).alias("p", "value"))
        .select("file", F.lit("").alias("member"), F.col("p").cast("bigint").alias("line_no"), "value")
    )
    feet = df.groupBy("file").agg(F.count(F.lit(1)).alias("n")).select(
        "file", F.lit("").alias("member"), (F.col("n") + 3).alias("line_no"),
        F.concat(F.lit("Total: "), F.col("n")).alias("value"),
    )
    lines = numbered(placed, 1, row, first=3).unionByName(tops).unionByName(feet)
    parsed = reports.parse_facility_report(lines)
    return parsed.select(
        "facility_id",
        F.substring("file", 1, 10).alias("snapshot_date"),
        F.nullif("operator_name", F.lit("-")).alias("operator_name"),
        "sub_type",
        "status",
    )


@query(
    "s02_well_list",
    """select uwi, cast(p_partkey as varchar) as uwi_id, p_name as well_name, p_brand as
    licensee_code, nullif(repeat('x', p_size % 3), '') as structure
    from (select row_number() over () as r, uwi, cast(substr(uwi, 4, 2) as int) - 1
        + 16 * (cast(substr(uwi, 7, 2) as int) - 1)
        + 576 * (cast(substr(uwi, 10, 3) as int) - 1) as k from {wells}) w
    join {part} on p_partkey = k""",
)
def s02(t):
    wells = t("wells").withColumn("licensee", F.trim("licensee"))
    part = t("part").withColumn(
        "uwi", F.expr(uwi_of("p_partkey"))
    )
    df = part.join(wells.select("uwi", "licensee"), "uwi").withColumns(
        {"file": F.concat(F.lit("list_"), F.col("p_size") % 7), "_order": F.col("p_partkey")}
    )
    placed = placed_in_file(df)
    known = {
        "uwi": F.col("uwi"),
        "uwi_id": F.col("p_partkey").cast("string"),
        "well_name": F.col("p_name"),
        "licensee_code": F.col("licensee"),
        "structure": F.expr("repeat('x', p_size % 3)"),
    }
    row = F.concat_ws("\t", *[known.get(c, F.lit("")) for c in WELL_LIST_COLUMNS])
    lines = numbered(placed, 1, row, first=0)
    return tables.parse_well_list(lines).select(*known)


@query(
    "s04_licence_blocks",
    """select lpad(cast(o_orderkey as varchar), 7, '0') as licence_number,
    '100/' || substr(u, 4, 14) || '/02' as uwi, 'WELL ' || o_orderkey as well_name,
    'COMPANY ' || (o_custkey % 40) || ' LTD.' as licensee,
    cast(cast(o_orderdate as date) as varchar) as issue_date
    from (select *, {U} as u from {orders})""".replace(
        "{U}", uwi_of("o_custkey")
    ),
)
def s04(t):
    """One report per day, six lines per licence."""
    day = F.col("o_orderdate").cast("date").cast("string")
    df = t("orders").withColumns(
        {
            "file": F.concat(day, F.lit("_WELLS.TXT")),
            "_order": F.col("o_orderkey"),
            "uwi": F.expr(uwi_of("o_custkey")),
        }
    )
    placed = placed_in_file(df)
    legal = F.substring("uwi", 4, 14)
    lines = numbered(
        placed,
        6,
        F.concat(
            F.lit(" WELL "), F.col("o_orderkey"), F.lit("   "),
            F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), F.lit("   ALBERTA CROWN   612.4M"),
        ),
        F.concat(F.lit(" 100/"), legal, F.lit("/02   N 100 E 200   1500.0M")),
        F.lit(" NEW POOL WILDCAT   FIELD   ZONE"),
        F.lit(" DRILL   PRODUCTION   CRUDE OIL"),
        F.concat(
            F.lit(" COMPANY "), F.col("o_custkey") % 40, F.lit(" LTD.    "), legal,
        ),
        F.lit(""),
        first=3,
    )
    lines = with_header(df, lines, "DAILY LIST", "", "-----")
    return reports.parse_licence_blocks(lines).select(
        "licence_number", "uwi", "well_name", "licensee", "issue_date"
    )


@query(
    "s05_spud_lines",
    """select uwi, lpad(cast(o_orderkey as varchar), 7, '0') as licence_number,
    'WELL NO ' || o_orderkey as well_name, drilling_contractor,
    cast(spud_date as varchar) as spud_date from {spuds}""",
)
def s05(t):
    df = t("spuds").withColumns(
        {
            "file": F.concat(F.col("spud_date").cast("string"), F.lit("_SPUD.TXT")),
            "_order": F.col("o_orderkey"),
        }
    )
    placed = placed_in_file(df)
    lines = numbered(
        placed,
        2,
        F.concat(
            F.lit(" "), F.col("uwi"), F.lit("  "),
            F.rpad(F.concat(F.lit("WELL NO "), F.col("o_orderkey")), 30, " "),
            F.lpad(F.col("o_orderkey").cast("string"), 7, "0"), F.lit("  NEW"),
        ),
        F.concat(F.lit("    "), F.col("drilling_contractor"), F.lit("   ")),
        first=2,
    )
    lines = with_header(df, lines, "DAILY SPUDS", "WELL  LICENCE  CONTRACTOR")
    return reports.parse_spud_lines(lines).select(
        "uwi", "licence_number", "well_name", "drilling_contractor", "spud_date"
    )


@query(
    "s06_confidential_list",
    """select uwi, op_name, cast(snapshot_date as varchar) as listed,
    if(day(snapshot_date) % 3 = 0, null, cast(snapshot_date + 365 as date)::varchar)
      as release_date_parsed from {confidential_snapshots}""",
)
def s06(t):
    df = t("confidential_snapshots").withColumns(
        {
            "file": F.concat(F.col("snapshot_date").cast("string"), F.lit("_ConWell.txt")),
            "_order": F.col("uwi"),
        }
    )
    placed = placed_in_file(df, F.substring("uwi", 1, 8))
    release = F.when(F.dayofmonth("snapshot_date") % 3 == 0, F.lit("no date avail")).otherwise(
        F.date_format(F.date_add("snapshot_date", 365), "MM/dd/yyyy")
    )
    shown = {"uwi": F.lower("uwi"), "op_name": F.col("op_name"), "release_date": release}
    row = F.concat(
        *[
            F.rpad(shown.get(name, F.lit("X")), end - start, " ")
            for name, start, end in CONFIDENTIAL_FIELDS
        ]
    )
    lines = with_header(
        df, numbered(placed, 1, row, first=3), "Confidential Well List", "UWI   LICENCE", "=" * 60
    )
    return reports.parse_confidential(lines).select(
        "uwi", "op_name", F.substring("file", 1, 10).alias("listed"), "release_date_parsed"
    )


# --- tables -----------------------------------------------------------------


@query(
    "s03_volumetric",
    """select from_to_id, productionmonth, activityid, productid, cast(volume as double) as volume,
    l_orderkey::varchar as operator_ba_id, null as uwi from {volumetric}""",
)
def s03(t):
    """Two spellings of the header, one per province."""
    df = t("volumetric").withColumns({"file": F.col("province"), "_order": F.col("l_orderkey") * 8 + F.col("l_linenumber")})
    def columns(names):
        cells = ["productionmonth", "activityid", "productid", "volume", "from_to_id", "l_orderkey"]
        return {n: F.col(c) for n, c in zip(names, cells)}

    new = sheet(
        df.where("province = 'AB'"),
        columns(["ProductionMonth", "ActivityID", "ProductID", "Volume", "FromToIDIdentifier", "OperatorBAID"]),
    )
    old = sheet(
        df.where("province = 'SK'"),
        columns(["Production Month", "Activity-ID", "Product ID", "Volume", "FromToID", "Operator BAID"]),
    )
    table = tables.table_from_lines(new.unionByName(old), VOLUMETRIC_ALIASES)
    parsed = tables.shape_volumetric(table)
    return parsed.select(
        "from_to_id", "productionmonth", "activityid", "productid",
        F.col("volume").cast("double").alias("volume"), "operator_ba_id", "uwi",
    )


@query(
    "s07_status_changes",
    """select uwi, cast(event_date as varchar) as event_date, new_status, 'Was, ' || new_status as
    old_status, cast(event_id as varchar) as licence, 'status_change' as event_type
    from {status_changes}""",
)
def s07(t):
    df = t("status_changes").withColumns(
        {
            "file": F.concat(F.col("event_date").cast("string"), F.lit("_WeeklyStatus.csv")),
            "_order": F.col("event_id"),
        }
    )
    lines = sheet(
        df,
        {
            "00.UnFormatted UWI": F.lit(""),
            "01.Formatted UWI": F.col("uwi"),
            "03.Lic No": F.col("event_id"),
            "08.StatCurrDesc": F.col("new_status"),
            "10.StatPrevDesc": F.concat(F.lit("Was, "), F.col("new_status")),
        },
    )
    table = tables.table_from_lines(
        lines, STATUS_CHANGE_ALIASES, name_rule=tables.numbered_name_column
    )
    return tables.shape_status_changes(table).select(
        "uwi", "event_date", "new_status", "old_status", "licence", "event_type"
    )


@query(
    "s08_weekly_drilling",
    """select uwi, lpad(cast(o_orderkey as varchar), 7, '0') as licence,
    cast(spud_date as varchar) as spud_date, cast(null as varchar) as stat_date,
    cast(spud_date as varchar) as event_date, 'drilling' as event_type from {spuds}""",
)
def s08(t):
    df = t("spuds").withColumns(
        {
            "file": F.concat(F.col("spud_date").cast("string"), F.lit("_WeeklyDrilling.csv")),
            "_order": F.col("o_orderkey"),
        }
    )
    lines = sheet(
        df,
        {
            "01.Formatted UWI": F.col("uwi"),
            "04.StatDate": F.lit("unknown"),
            "08.Lic#": F.lpad(F.col("o_orderkey").cast("string"), 7, "0"),
            "15.SpudDate": F.date_format("spud_date", "MM/dd/yyyy"),
        },
    )
    table = tables.table_from_lines(lines, DRILLING_ALIASES, name_rule=tables.numbered_name_column)
    return tables.shape_drilling(table).select(
        "uwi", "licence", "spud_date", "stat_date", "event_date", "event_type"
    )


@query(
    "s09_well_facility_link",
    """select well_id, facility_name, cast(status_date as varchar) as status_date, province,
    if(m = '', null, lpad(l, 2, '0') || '-' || lpad(s, 2, '0') || '-001-0' || (1 + well_id::int % 9)
      || 'W' || m) as well_dls
    from (select cast(o_orderkey as varchar) as well_id, 'BATTERY, "' || o_orderpriority || '"'
      as facility_name, cast(o_orderdate as date) as status_date, 'AB' as province,
      cast(1 + o_orderkey % 16 as varchar) as l, cast(1 + o_orderkey % 36 as varchar) as s,
      case o_orderkey % 4 when 0 then '' else '4' end as m from {orders})""",
)
def s09(t):
    df = t("orders").withColumns({"file": F.lit("link.csv"), "_order": F.col("o_orderkey")})
    key = F.col("o_orderkey")
    shown = {
        "WellID": key,
        "WellLegalSubdivision": 1 + key % 16,
        "WellSection": 1 + key % 36,
        "WellTownship": F.lit("1"),
        "WellRange": 1 + key % 9,
        "WellMeridian": F.when(key % 4 == 0, "").otherwise("4"),
        "WellStatusStartDate": F.date_format("o_orderdate", "yyyy-MM-dd"),
        "LinkedFacilityName": F.concat(F.lit('BATTERY, "'), F.col("o_orderpriority"), F.lit('"')),
    }
    lines = sheet(df, {c: shown.get(c, F.lit("")) for c in WELL_FACILITY_LINK_COLUMNS})
    table = tables.table_from_lines(lines, tables.LINK_ALIASES)
    return tables.shape_well_facility_link(table).select(
        "well_id", "facility_name", "status_date", "province", "well_dls"
    )


@query(
    "s10_disposal_wells",
    "select uwi, trim(licensee) as approval_holder, mode as scheme_status from {wells}",
)
def s10(t):
    from wellspring.constants import DISPOSAL_ALIASES

    df = t("wells").withColumns(
        {"file": F.col("province"), "_order": F.col("uwi")}
    ).withColumn("licensee", F.trim("licensee"))
    ab = sheet(
        df.where("province = 'AB'"),
        {"Well Identifier": F.col("uwi"), "Operator": F.col("licensee"), "Status": F.col("mode")},
        bucket=F.substring("uwi", 1, 8),
    )
    sk = sheet(
        df.where("province = 'SK'"),
        {"Scheme Status": F.col("mode"), "Well ID": F.col("uwi"), "Approval Holder": F.col("licensee")},
        bucket=F.substring("uwi", 1, 8),
    )
    return tables.table_from_lines(ab.unionByName(sk), DISPOSAL_ALIASES).select(
        "uwi", "approval_holder", "scheme_status"
    )


@query(
    "s11_sk_drilling",
    """select 'SK' || o_orderkey as cwi, uwi, cast(spud_date as varchar) as spud_date,
    cast(null as varchar) as rig_release_date, drilling_contractor, 'SK' as province
    from {spuds} where province = 'SK'""",
)
def s11(t):
    df = t("spuds").where("province = 'SK'").withColumns(
        {"file": F.date_format("spud_date", "yyyy"), "_order": F.col("o_orderkey")}
    )

    def cut(start, length):
        return F.substring("uwi", start, length).cast("int")

    lines = sheet(
        df,
        {
            "Canadian Well Identifier": F.concat(F.lit("SK"), F.col("o_orderkey")),
            "Drilling Start Date": F.date_format("spud_date", "yyyy-MM-dd"),
            "Rig Release Date": F.lit("n/a"),
            "Contractor Name": F.col("drilling_contractor"),
            "Surface Legal Subdivision": cut(4, 2),
            "Surface Section": cut(7, 2),
            "Surface Township": cut(10, 3),
            "Surface Range": cut(14, 2),
            "Surface Meridian": F.substring("uwi", 16, 2),
        },
    )
    table = tables.table_from_lines(lines, SK_DRILLING_ALIASES)
    return tables.shape_sk_drilling(table).select(
        "cwi", "uwi", "spud_date", "rig_release_date", "drilling_contractor", "province"
    )


@query(
    "s12_sk_bulletin",
    """select licence_number, uwi, licensee, cast(issue_date as varchar) as issued_date,
    cast(null as varchar) as cancelled_date, 'SK' as province, o_orderkey::varchar as cwi
    from {licences}""",
)
def s12(t):
    df = t("licences").withColumns({"file": F.lit("bulletin.csv"), "_order": F.col("o_orderkey")})
    lines = sheet(
        df,
        {
            "Licence Number": F.col("licence_number"),
            "Issued Date": F.date_format("issue_date", "yyyyMMdd"),
            "Cancelled Date": F.lit(""),
            "Licensee/Address": F.col("licensee"),
            "CWI": F.col("o_orderkey"),
            "UWI": F.col("uwi"),
        },
    )
    table = tables.table_from_lines(lines, SK_BULLETIN_ALIASES)
    return tables.shape_sk_bulletin(table).select(
        "licence_number", "uwi", "licensee", "issued_date", "cancelled_date", "province", "cwi"
    )


@query(
    "s13_reference_lists",
    "select cast(c_custkey as varchar) as ba_id, c_name as ba_name, c_mktsegment as ba_type from {customer}",
)
def s13(t):
    df = t("customer").withColumns({"file": F.lit("ba.csv"), "_order": F.col("c_custkey")})
    lines = sheet(
        df,
        {"BA ID": F.col("c_custkey"), "BA (Name)": F.col("c_name"), "BA-Type": F.col("c_mktsegment")},
    )
    return tables.table_from_lines(lines, {c: [c] for c in ("ba_id", "ba_name", "ba_type")}).drop(
        "file", "member", "line_no"
    )


@query(
    "s15_pipe_table",
    """select uwi, name as well_name, trim(licensee) as operator from {wells}""",
)
def s15(t):
    df = t("wells").withColumns(
        {
            "file": F.lit("master.txt"),
            "_order": F.col("uwi"),
            "licensee": F.trim("licensee"),
        }
    )
    lines = sheet(
        df,
        {"UWI": F.col("uwi"), "Well Name": F.col("name"), "Operator": F.col("licensee")},
        sep="|",
        bucket=F.substring("uwi", 1, 8),
    )
    # malformed rows are skipped
    wide = df.select("file", F.lit("").alias("member"), (F.abs(F.xxhash64("uwi") % 10**9) + 10**9).alias("line_no"), F.lit("a|b|c|d").alias("value"))
    parsed = tables.table_from_lines(
        lines.unionByName(wide), {c: [c] for c in ("uwi", "well_name", "operator")}, sep="|"
    )
    return parsed.drop("file", "member", "line_no")


LINE_CHECK = """select 'PL-' || p_partkey as licence_number, p_brand as licensee,
  p_type as substance, cast(p_partkey as varchar) as segment_id, p_retailprice as length_m,
  50 + p_size / 100.0 as from_lat, -106 - p_size / 50.0 as from_lon,
  50 + (p_size + 2) / 100.0 as to_lat, -106 - (p_size + 7) / 50.0 as to_lon from {part}"""


def line_feature_pages(t) -> DataFrame:
    """GeoJSON pages, a page per hundred parts, three points per line."""
    size = F.col("p_size")

    def point(dx, dy):
        return F.array(-106 - (size + dx) / 50.0, 50 + (size + dy) / 100.0)

    feature = F.struct(
        F.struct(
            F.concat(F.lit("PL-"), F.col("p_partkey")).alias("LICENCENUMBER"),
            F.col("p_brand").alias("OWNERNAME"),
            F.col("p_type").alias("SUBSTANCE"),
            F.col("p_partkey").cast("string").alias("SEGMENTIDENTIFIER"),
            F.col("p_retailprice").alias("SHAPE.LEN"),
        ).alias("properties"),
        F.struct(
            F.lit("LineString").alias("type"),
            F.array(point(0, 0), point(3, 1), point(7, 2)).alias("coordinates"),
        ).alias("geometry"),
    )
    empty = F.lit('{"properties": {"OWNERNAME": "X"}, "geometry": {"coordinates": []}}')
    return (
        t("part")
        .groupBy(F.floor(F.col("p_partkey") / 100).alias("page"))
        .agg(F.array_join(F.collect_list(F.to_json(feature)), ",").alias("body"))
        .select(
            F.concat(F.lit('{"features": ['), F.col("body"), F.lit(","), empty, F.lit("]}")).alias(
                "value"
            )
        )
    )


@query("s14_line_features", LINE_CHECK)
def s14(t):
    return features.parse_line_features(line_feature_pages(t)).select(
        "licence_number", "licensee", "substance", "segment_id", "length_m",
        "from_lat", "from_lon", "to_lat", "to_lon",
    )


@query(
    "s17_decode_text",
    """select c_custkey, 'Société ' || c_name as utf8, 'Société ' || c_name as latin
    from {customer}""",
)
def s17(t):
    """The same text stored as UTF-8 and as latin-1 bytes."""
    name = F.concat(F.lit("Société "), F.col("c_name"))
    raw = t("customer").select(
        "c_custkey",
        F.encode(name, "UTF-8").cast("string").alias("utf8"),
        F.encode(name, "ISO-8859-1").cast("string").alias("latin"),
    )
    return raw.select(
        "c_custkey",
        decode_text(F.col("utf8")).alias("utf8"),
        decode_text(F.col("latin")).alias("latin"),
    )


@query(
    "s19_latest_snapshot",
    """select uwi, well_name, province, snapshot_date from {well_snapshots}
    where snapshot_date = '2024-04-01'""",
)
def s19(t):
    return snapshots.latest_snapshot(t("well_snapshots")).select(
        "uwi", "well_name", "province", "snapshot_date"
    )


@query(
    "s20_all_snapshots",
    """select snapshot_date, count(*) as n, count(distinct uwi) as wells
    from {well_snapshots} group by 1""",
)
def s20(t):
    """Snapshots dated by their file name."""
    files = t("well_snapshots").withColumn("name", F.concat("snapshot_date", F.lit(".parquet")))
    return (
        files.withColumn("snapshot_date", file_date(F.col("name")))
        .groupBy("snapshot_date")
        .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("uwi").alias("wells"))
    )


@query(
    "s21_provincial_stats",
    """select province, productionmonth, substr(productionmonth, 1, 4) as source_year,
    'oil' as product_type, cast(sum(oil_prod_vol) as double) as production
    from {production} group by all""",
)
def s21(t):
    months = (
        t("production")
        .groupBy("province", "productionmonth")
        .agg(F.sum("oil_prod_vol").alias("oil"))
        .withColumns(
            {
                "file": F.concat(
                    F.lit("/stats/"), F.col("province"), F.lit("_Oil_"), F.substring("productionmonth", 1, 4), F.lit(".csv")
                ),
                "_n": F.substring("productionmonth", 6, 2).cast("int") - 1,
            }
        )
    )
    body = numbered(
        months, 2, F.concat_ws(",", "productionmonth", F.col("oil").cast("string")), F.lit(" , "),
        first=3,
    )
    lines = with_header(months, body, "Supply and disposition", ",", "Month,Production (m3)")
    parsed = tables.shape_provincial_stats(lines)
    return parsed.select(
        F.regexp_extract("file", r"(AB|SK)", 1).alias("province"),
        F.col("values")["month"].alias("productionmonth"),
        "source_year",
        "product_type",
        F.col("values")["production_m3"].cast("double").alias("production"),
    )


@query(
    "s22_code_lookup",
    """select w.uwi, w.fluid, b.n as fluid_wells from {wells} w
    join (select fluid, count(*) as n from {wells} group by 1) b on b.fluid = w.fluid""",
)
def s22(t):
    """A code list joined to the wells; its size decides how."""
    from wellspring.functions.names import normalize_columns

    codes = normalize_columns(
        t("wells").groupBy(F.col("fluid").alias("Fluid Code")).agg(F.count(F.lit(1)).alias("Fluid Wells"))
    )
    return t("wells").join(codes, F.col("fluid") == F.col("fluid_code")).select(
        "uwi", "fluid", "fluid_wells"
    )


CENTROID_CHECK = """
with p as (select 'PL-' || p_partkey as licence_number, -106 - p_size / 50.0::double as x0,
    50 + p_size / 100.0::double as y0, -106 - (p_size + 3) / 50.0::double as x1,
    50 + (p_size + 1) / 100.0::double as y1, -106 - (p_size + 7) / 50.0::double as x2,
    50 + (p_size + 2) / 100.0::double as y2 from {part}),
  l as (select *, sqrt((x1 - x0) * (x1 - x0) + (y1 - y0) * (y1 - y0)) as a,
    sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as b from p)
select licence_number, round(((x0 + x1) / 2 * a + (x1 + x2) / 2 * b) / (a + b), 5) as centroid_lon,
  round(((y0 + y1) / 2 * a + (y1 + y2) / 2 * b) / (a + b), 5) as centroid_lat,
  round(a + b, 5) as line_length from l"""


@query("s23_feature_centroids", CENTROID_CHECK)
def s23(t):
    lines = features.parse_line_features(line_feature_pages(t))
    located = features.feature_centroids(lines)
    return located.select(
        "licence_number",
        *[F.round(c, 5).alias(c) for c in ("centroid_lon", "centroid_lat", "line_length")],
    )
