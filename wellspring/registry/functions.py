"""Queries over the scalar functions."""

from pyspark.sql import functions as F

from wellspring.functions import facility, identifiers, survey, text, values
from wellspring.functions.names import canonicalize, drop_metadata, normalize_columns
from wellspring.registry import query


@query(
    "p01_normalize_columns",
    """select c_custkey as customer_key, c_name as customer_name,
    c_mktsegment as well_facility_id, c_acctbal as account_bal from {customer}""",
)
def p01(t):
    raw = t("customer").select(
        F.col("c_custkey").alias(" CustomerKey "),
        F.col("c_name").alias("Customer.Name"),
        F.col("c_mktsegment").alias("Well/Facility ID"),
        F.col("c_acctbal").alias("account - (bal)"),
    )
    return normalize_columns(raw)


@query(
    "p02_header_aliases",
    """select uwi, productionmonth, productid, cast(volume as double) as volume,
    cast(null as varchar) as energy from {volumetric}""",
)
def p02(t):
    raw = t("volumetric").select(
        F.col("uwi").alias("well"),
        F.col("productionmonth").alias("production_month"),
        F.col("productid").alias("product_id"),
        F.when(F.col("l_linenumber") > 3, F.col("volume")).alias("volume"),
        F.when(F.col("l_linenumber") <= 3, F.col("volume")).alias("oil_prod_vol"),
    )
    return canonicalize(
        raw,
        {
            "uwi": ["uwi", "well"],
            "productionmonth": ["productionmonth", "production_month"],
            "productid": ["productid", "product_id"],
            "volume": ["volume", "oil_prod_vol"],
            "energy": ["energy"],
        },
    )


@query(
    "p03_trim_keys",
    """select p_partkey, case when p_size % 5 in (0, 1) then null else p_brand end as licensee
    from {part}""",
)
def p03(t):
    messy = t("part").select(
        "p_partkey",
        F.expr(
            "case p_size % 5 when 0 then '   ' when 1 then ' nan'"
            " when 2 then p_brand else concat('  ', p_brand, ' ') end"
        ).alias("licensee"),
    )
    return text.trim_keys(messy, ["licensee", "not_there"])


@query(
    "p04_format_uwi",
    """select from_to_id, uwi as display, 'P' || substr(uwi, 1, 10) as passed_through,
    l_orderkey, l_linenumber from {volumetric}""",
)
def p04(t):
    return t("volumetric").select(
        "from_to_id",
        identifiers.format_uwi(F.col("from_to_id")).alias("display"),
        identifiers.format_uwi(F.concat(F.lit("P"), F.substring("uwi", 1, 10))).alias(
            "passed_through"
        ),
        "l_orderkey",
        "l_linenumber",
    )


@query(
    "p05_normalized_uwi",
    """select uwi, province, case when province = 'SK'
      then '1' || replace(replace(uwi, '/', ''), '-', '') || '0' else uwi end as normalized_uwi
    from {wells}""",
)
def p05(t):
    return t("wells").select(
        "uwi",
        "province",
        identifiers.normalized_uwi(F.col("province"), F.col("uwi")).alias("normalized_uwi"),
    )


SURVEY_CHECK = """
with parts as (
  select uwi, cast(substr(uwi, 4, 2) as int) - 1 as l, cast(substr(uwi, 7, 2) as int) - 1 as s,
    cast(substr(uwi, 10, 3) as int) - 1 as t, cast(substr(uwi, 14, 2) as int) - 1 as r,
    cast(substr(uwi, 17, 1) as int) as m
  from {wells}),
north as (
  select *, 49.0::double + t * 0.087::double + (floor(s / 6) + 0.5) * 0.087::double / 6
      + (floor(l / 4) + 0.5) * 0.087::double / 24 as lat,
    case when floor(s / 6) % 2 = 1 then 5 - s % 6 else s % 6 end as c
  from parts),
west as (select *, 9.656::double / (111.32::double * cos(radians(lat))) as w from north)
select uwi, round(lat, 5) as lat,
  round(-(94 + 4 * m) - r * w - (c + 0.5) * w / 6 - (l % 4 + 0.5) * w / 24, 5) as lon
from west"""


@query("p06_survey_position", SURVEY_CHECK)
def p06(t):
    return t("wells").select(
        "uwi",
        survey.uwi_lat(F.col("uwi"), 5).alias("lat"),
        survey.uwi_lon(F.col("uwi"), 5).alias("lon"),
    )


@query(
    "p07_dls_string",
    """select p_partkey, case when p_size % 10 = 0 then null
      else substr(uwi, 4, 14) end as well_dls
    from (select p_partkey, p_size from {part}) p
    join (select uwi, cast(substr(uwi, 4, 2) as int) - 1
        + 16 * (cast(substr(uwi, 7, 2) as int) - 1)
        + 576 * (cast(substr(uwi, 10, 3) as int) - 1) as k from {wells}) w
      on w.k = p.p_partkey""",
)
def p07(t):
    key = F.col("p_partkey")
    parts = t("part").select(
        "p_partkey",
        (key % 16 + 1).cast("string").alias("lsd"),
        (F.floor(key / 16) % 36 + 1).cast("string").alias("sec"),
        (F.floor(key / 576) % 126 + 1).cast("string").alias("twp"),
        (key % 30 + 1).cast("string").alias("rng"),
        F.expr(
            "case when p_size % 10 = 0 then '' when p_partkey % 5 = 0"
            " then string(p_partkey % 2 + 2) else string(p_partkey % 3 + 4) end"
        ).alias("mer"),
    )
    return parts.select(
        "p_partkey",
        identifiers.dls(*[F.col(c) for c in ("lsd", "sec", "twp", "rng", "mer")]).alias(
            "well_dls"
        ),
    )


@query(
    "p08_sk_uwi",
    "select uwi, substr(uwi, 4, 2) as lsd, uwi as built from {wells}",
)
def p08(t):
    def cut(start, length):
        return F.substring("uwi", start, length).cast("int").cast("string")

    return t("wells").select(
        "uwi",
        F.substring("uwi", 4, 2).alias("lsd"),
        identifiers.sk_uwi(
            cut(4, 2), cut(7, 2), cut(10, 3), cut(14, 2), F.substring("uwi", 16, 2)
        ).alias("built"),
    )


@query(
    "p09_facility_text",
    """select facility_id, cast(snapshot_date as varchar) as snapshot_date,
    sub_type as from_sub_type, coalesce(operator_name, '') as from_name, '' as from_nothing
    from {facility_snapshots}""",
)
def p09(t):
    df = t("facility_snapshots")
    named = df.select(F.col("operator_name").alias("facility_name"))
    return df.withColumn("facility_name", F.col("operator_name")).select(
        "facility_id",
        "snapshot_date",
        facility.facility_text(df).alias("from_sub_type"),
        facility.facility_text(named).alias("from_name"),
        facility.facility_text(df.select("facility_id")).alias("from_nothing"),
    )


CLASS_CHECK = """case
  when sub_type like 'Crude Oil Single%' then 'gas_battery'
  when sub_type like 'Gas Multiwell%' then 'gas_battery'
  when sub_type like 'SAGD%' then 'bitumen_battery'
  when sub_type = 'Gas Plant' then 'gas_plant'
  when sub_type = 'Compressor Station' then 'compressor'
  when sub_type = 'Meter Station' then 'meter'
  when sub_type = 'Tank Terminal' then 'terminal'
  else 'disposal' end"""
GROUP_CHECK = """case
  when sub_type like '%Battery' then 'Battery'
  when sub_type in ('Gas Plant', 'Compressor Station') then 'Plant'
  when sub_type = 'Meter Station' then 'Gathering/Meter'
  when sub_type = 'Tank Terminal' then 'Storage/Terminal'
  else 'Injection/Disposal' end"""
COMMODITY_CHECK = """case
  when sub_type like 'Crude%' or sub_type like 'SAGD%' then 'Crude'
  when sub_type like 'Gas%' then 'Gas' else 'Other' end"""
FACILITY_KEY = "facility_id, cast(snapshot_date as varchar) as snapshot_date"


@query(
    "p10_facility_class",
    f"select {FACILITY_KEY}, sub_type, {CLASS_CHECK} as facility_class from {{facility_snapshots}}",
)
def p10(t):
    return t("facility_snapshots").select(
        "facility_id", "snapshot_date", "sub_type",
        facility.facility_class(F.col("sub_type")).alias("facility_class"),
    )


@query(
    "p11_facility_group",
    f"select {FACILITY_KEY}, {GROUP_CHECK} as facility_group from {{facility_snapshots}}",
)
def p11(t):
    cls = facility.facility_class(F.col("sub_type"))
    return t("facility_snapshots").select(
        "facility_id", "snapshot_date", facility.facility_group(cls).alias("facility_group")
    )


@query(
    "p12_facility_commodity",
    f"select {FACILITY_KEY}, {COMMODITY_CHECK} as facility_commodity from {{facility_snapshots}}",
)
def p12(t):
    return t("facility_snapshots").select(
        "facility_id", "snapshot_date",
        facility.facility_commodity(F.col("sub_type")).alias("facility_commodity"),
    )


@query(
    "p13_normalize_operator",
    """select c_custkey, upper(c_name) || case c_custkey % 6 when 0 then ' CORP.'
      when 1 then ' CORP LTD' when 2 then ' INC' when 3 then ' INC' when 4 then ' CORP'
      else '' end as operator from {customer}""",
)
def p13(t):
    raw = F.expr(
        "concat(c_name, case c_custkey % 6 when 0 then '  corp.' when 1 then ' Corporation Ltd'"
        " when 2 then ' Incorporated' when 3 then '   inc ' when 4 then ' CORP' else '' end)"
    )
    return t("customer").select("c_custkey", text.normalize_operator(raw).alias("operator"))


@query(
    "p14_first_word",
    """select p_partkey, split_part(p_name, ' ', 1) as word,
    case when p_size % 2 = 0 then '' else upper(split_part(p_name, ' ', 1)) end as token
    from {part}""",
)
def p14(t):
    padded = F.expr("case when p_size % 2 = 0 then concat(' ', p_name) else p_name end")
    return t("part").select(
        "p_partkey",
        text.first_word(padded).alias("word"),
        text.first_token(padded).alias("token"),
    )


@query(
    "p15_coerce_dates",
    """select o_orderkey, case when o_orderkey % 10 in (3, 4) then null
      else cast(cast(o_orderdate as date) as varchar) end as issued
    from {orders}""",
)
def p15(t):
    """Fast forms, lenient forms (date-times, slashes, unpadded, month names) and junk."""
    raw = t("orders").select(
        "o_orderkey",
        F.expr(
            "case o_orderkey % 10 when 0 then date_format(o_orderdate, 'yyyyMMdd')"
            " when 1 then date_format(o_orderdate, 'yyyy-MM-dd')"
            " when 2 then date_format(o_orderdate, 'MM/dd/yyyy')"
            " when 3 then 'nan' when 4 then '20241399'"
            " when 5 then date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
            " when 6 then date_format(o_orderdate, 'yyyy/MM/dd')"
            " when 7 then date_format(o_orderdate, 'M/d/yyyy')"
            " when 8 then date_format(o_orderdate, 'MMM d, yyyy')"
            " else date_format(o_orderdate, 'dd-MMM-yyyy') end"
        ).alias("issued"),
    )
    return values.coerce_dates(raw, ["issued", "not_there"])


@query(
    "p16_coerce_numbers",
    """select l_orderkey, l_linenumber, l_partkey,
    case when l_linenumber in (2, 3) then 0 else l_quantity end as volume from {lineitem}""",
)
def p16(t):
    raw = F.expr(
        "case l_linenumber when 2 then '***' when 3 then null"
        " else concat(' ', string(l_quantity)) end"
    )
    return t("lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", values.coerce_num(raw).alias("volume")
    )


@query(
    "p17_to_imperial",
    """select uwi, productionmonth, cast(oil_prod_vol * 6.29287 as double) as oil_bbl,
    cast(water_prod_vol * 6.29287 as double) as water_bbl,
    cast(gas_prod_vol * 35.3147 as double) as gas_mcf from {production}""",
)
def p17(t):
    return values.to_imperial(t("production")).select(
        "uwi", "productionmonth", "oil_bbl", "water_bbl", "gas_mcf"
    )


@query(
    "p18_location_keys",
    """select uwi, substring(uwi, 10, 3) as township, substring(uwi, 14, 5) as range_mer,
    substring(uwi, 4, 11) as legal_key, substring(uwi, 4, 14) as legal from {wells}""",
)
def p18(t):
    uwi = F.col("uwi")
    return t("wells").select(
        "uwi",
        identifiers.township(uwi).alias("township"),
        identifiers.range_meridian(uwi).alias("range_mer"),
        identifiers.legal_key(uwi).alias("legal_key"),
        identifiers.legal_location(uwi).alias("legal"),
    )


@query(
    "p19_safe_ratio",
    """select uwi, productionmonth,
    cast(gas_prod_vol as double) / nullif(cast(oil_prod_vol as double), 0) as gor
    from {production}""",
)
def p19(t):
    return t("production").select(
        "uwi",
        "productionmonth",
        values.safe_ratio(
            F.col("gas_prod_vol").cast("double"), F.col("oil_prod_vol").cast("double")
        ).alias("gor"),
    )


@query(
    "p20_status_label",
    f"""select {FACILITY_KEY}, if(is_active, 'Active', 'Inactive') as status
    from {{facility_snapshots}}""",
)
def p20(t):
    return t("facility_snapshots").select(
        "facility_id", "snapshot_date", text.status_label(F.col("is_active")).alias("status")
    )


@query(
    "p21_date_arithmetic",
    """select o_orderkey, cast(date_trunc('month', o_orderdate)::date as varchar) as month_start,
    cast(o_orderdate::date - interval 30 day as date)::varchar as window_start,
    datediff('month', date '1995-01-31', o_orderdate::date) as months
    from {orders}""",
)
def p21(t):
    day = F.col("o_orderdate").cast("date")
    return t("orders").select(
        "o_orderkey",
        values.month_start(F.date_format(day, "yyyy-MM")).alias("month_start"),
        F.date_sub(day, 30).alias("window_start"),
        values.months_crossed(F.lit("1995-01-31").cast("date"), day).cast("bigint").alias("months"),
    )


@query("p22_drop_metadata", "select p_partkey, p_brand from {part}")
def p22(t):
    loaded = t("part").select("p_partkey", "p_brand").withColumn("_source_id", F.lit("list"))
    return drop_metadata(loaded)


@query(
    "p23_file_name_parts",
    """select o_orderkey, cast(cast(o_orderdate as date) as varchar) as event_date,
    substr(cast(cast(o_orderdate as date) as varchar), 1, 7) as period,
    substr(cast(cast(o_orderdate as date) as varchar), 1, 4) as source_year,
    case o_orderkey % 4 when 0 then 'oil' when 1 then 'gas_prices'
      when 2 then 'propane' else 'unknown' end as product_type
    from {orders}""",
)
def p23(t):
    name = F.expr(
        "concat(date_format(o_orderdate, 'yyyy-MM-dd'), case o_orderkey % 4 when 0 then '_Oil.csv'"
        " when 1 then '_Gas_Prices.csv' when 2 then '_Propane.csv' else '_Weekly.csv' end)"
    )
    return t("orders").select(
        "o_orderkey",
        text.file_date(name).alias("event_date"),
        text.file_period(name).alias("period"),
        text.file_year(name).alias("source_year"),
        text.file_product(name).alias("product_type"),
    )
