"""Queries over the silver tables, each against an independent SQL build."""

from pyspark.sql import functions as F

from wellspring.plans import silver
from wellspring.registry import query
from wellspring.registry.functions import CLASS_CHECK, COMMODITY_CHECK, GROUP_CHECK
from wellspring.registry.operators import CHANGES_CHECK, confidential
from wellspring.registry.sources import line_feature_pages
from wellspring.sources.features import parse_line_features

CLASSES = f"""{CLASS_CHECK} as facility_class, {GROUP_CHECK} as facility_group,
  {COMMODITY_CHECK} as facility_commodity"""


@query(
    "b01_facilities",
    f"""with l as (
      select * from {{facility_snapshots}} where is_active and snapshot_date =
        (select max(snapshot_date) from {{facility_snapshots}} where is_active)
      union all select * from {{facility_snapshots}} where not is_active and snapshot_date =
        (select max(snapshot_date) from {{facility_snapshots}} where not is_active))
    select facility_id, is_active, operator_name, sub_type, 'AB' as province, {CLASSES},
      centroid_lat, centroid_lon from l left join {{facility_geo}} using (facility_id)""",
)
def b01(t):
    df = t("facility_snapshots")
    lists = {
        "active": df.where("is_active").drop("is_active"),
        "inactive": df.where("not is_active").drop("is_active"),
        "geo": t("facility_geo"),
    }
    return silver.build_facilities(lists)


@query(
    "b02_facility_history",
    f"""with h as (select facility_id, arg_max(operator_name, snapshot_date)
        filter (where operator_name is not null) as operator_name,
      any_value(sub_type) as sub_type, arg_max(is_active, snapshot_date) as is_active,
      min(snapshot_date) as a, max(snapshot_date) as b,
      min(snapshot_date) filter (where is_active) as c,
      max(snapshot_date) filter (where is_active) as d
      from {{facility_snapshots}} group by facility_id)
    select facility_id, operator_name, sub_type, is_active, cast(a as varchar) as first_seen,
      cast(b as varchar) as last_seen, cast(c as varchar) as first_active_date,
      cast(d as varchar) as last_active_date, c is not null as was_ever_active,
      is_active as is_currently_active, centroid_lat, centroid_lon, {CLASSES}
    from h left join {{facility_geo}} using (facility_id)""",
)
def b02(t):
    return silver.build_facility_history(
        {"snapshots": t("facility_snapshots"), "geo": t("facility_geo")}
    )


@query(
    "b03_facility_status_changes",
    f"""with o as (select *, lag(is_active) over w as p, row_number() over w as r,
        first_value(operator_name ignore nulls) over (partition by facility_id
          order by snapshot_date rows between unbounded preceding and unbounded following) as f
        from {{facility_snapshots}} window w as (partition by facility_id order by snapshot_date)),
      e as (select facility_id, f as operator_name, sub_type, snapshot_date, null as old_status,
          is_active from o where r = 1
        union all select facility_id, operator_name, sub_type, snapshot_date,
          if(p, 'Active', 'Inactive'), is_active from o where p <> is_active)
    select facility_id, operator_name, sub_type, cast(snapshot_date as varchar) as event_date,
      old_status, if(is_active, 'Active', 'Inactive') as new_status, is_active, {CLASSES},
      centroid_lat, centroid_lon from e left join {{facility_geo}} using (facility_id)""",
)
def b03(t):
    return silver.build_facility_status_changes(
        {"snapshots": t("facility_snapshots"), "geo": t("facility_geo")}
    )


@query(
    "b04_production",
    """with d as (select * from {volumetric} where activityid = 'PROD' qualify row_number() over (
        partition by from_to_id, productionmonth, productid
        order by snapshot_date desc, l_orderkey desc, l_linenumber desc, volume desc) = 1)
    select productionmonth, uwi, province,
      cast(coalesce(sum(volume) filter (where productid = 'OIL'), 0) as double) as oil_prod_vol,
      cast(coalesce(sum(volume) filter (where productid = 'GAS'), 0) as double) as gas_prod_vol,
      cast(coalesce(sum(volume) filter (where productid = 'WATER'), 0) as double)
        as water_prod_vol
    from d group by 1, 2, 3""",
)
def b04(t):
    """Both provinces' submissions as text, well known only by its compact id."""
    raw = t("volumetric").drop("uwi").withColumn("volume", F.col("volume").cast("string"))
    return silver.build_production(
        {"ab": raw.where("province = 'AB'"), "sk": raw.where("province = 'SK'")},
        tiebreak=["l_orderkey", "l_linenumber", "volume"],
    )


@query(
    "b05_pipelines",
    """select 'PL-' || p_partkey as licence_number, p_brand as licensee, p_type as substance,
    p_retailprice as length_m from {part}""",
)
def b05(t):
    lines = parse_line_features(line_feature_pages(t)).withColumn(
        "snapshot_date", F.lit("2024-01-01")
    )
    built = silver.build_pipelines({"lines": lines})
    located = built.where("centroid_lat between 50 and 51 and line_length > 0")
    return located.select("licence_number", "licensee", "substance", "length_m")


@query(
    "b06_pipeline_installations",
    """select p_partkey as installation, round(50 + p_size / 100.0, 6) as centroid_lat,
    -106 - p_size / 50.0 as centroid_lon from {part}""",
)
def b06(t):
    points = t("part").select(
        F.col("p_partkey").alias("installation"),
        F.array(-106 - F.col("p_size") / 50.0, F.round(50 + F.col("p_size") / 100.0, 6)).alias(
            "coordinates"
        ),
        F.lit("2024-01-01").alias("snapshot_date"),
    )
    return silver.build_pipeline_installations({"points": points}).drop("coordinates")


@query(
    "b07_sk_pipelines",
    """select 'PL-' || p_partkey as licence_no, p_brand as licensee, p_type as substance,
    '' as status, 50 + p_size / 100.0 as from_lat, -106 - p_size / 50.0 as from_lon,
    'SK' as province from {part}""",
)
def b07(t):
    segments = parse_line_features(line_feature_pages(t))
    return silver.build_sk_pipelines({"segments": segments}).select(
        "licence_no", "licensee", "substance", "status", "from_lat", "from_lon", "province"
    )


@query(
    "b08_confidential_wells",
    """select uwi, max(op_name) as operator_name, null as release_date,
    cast(min(snapshot_date) as varchar) as first_seen,
    cast(max(snapshot_date) as varchar) as last_seen,
    max(snapshot_date) = (select max(snapshot_date) from {confidential_snapshots})
      as is_currently_confidential, true as was_ever_confidential
    from {confidential_snapshots} group by uwi""",
)
def b08(t):
    return confidential(t)


@query(
    "b09_spud_activity",
    """select * exclude (spud_date), cast(spud_date as varchar) as spud_date from {spuds}
    qualify row_number() over (partition by uwi, spud_date, province order by o_orderkey desc) = 1""",
)
def b09(t):
    """Daily reports, archives and Saskatchewan, with padded keys."""
    padded = t("spuds").withColumn("uwi", F.concat(F.lit(" "), F.col("uwi"), F.lit("  ")))
    alberta = padded.where("province = 'AB'").drop("province")
    return silver.build_spud_activity(
        {
            "daily": alberta.where("o_orderkey % 2 = 0"),
            "archive": alberta.where("o_orderkey % 2 = 1"),
            "sk": padded.where("province = 'SK'").drop("province"),
        },
        tiebreak=["o_orderkey"],
    )


@query(
    "b10_well_licences",
    """select licence_number, uwi, licensee, cast(issue_date as varchar) as issue_date, province,
    o_orderkey from {licences} qualify row_number() over (partition by licence_number, province
      order by o_orderkey desc) = 1""",
)
def b10(t):
    df = t("licences")
    bulletin = df.where("province = 'SK'").withColumnRenamed("issue_date", "issued_date")
    built = silver.build_well_licences(
        {"daily": df.where("province = 'AB'"), "sk": bulletin}, tiebreak=["o_orderkey"]
    )
    return built.select(
        "licence_number", "uwi", "licensee", "issue_date", "province", "o_orderkey"
    )


def well_list(t):
    """The fixture wells under the column names of the published list."""
    return t("wells").select(
        F.concat(F.lit(" "), F.col("uwi")).alias("uwi"),
        F.col("name").alias("well_name"),
        F.col("licensee").alias("licensee_code"),
        "fluid",
        "mode",
        "province",
        F.col("stat_code").alias("well_stat_code"),
        F.expr(
            "case cast(stat_code as int) % 3 when 0 then 'nan' when 1 then '20231399'"
            " else concat('202401', lpad(cast(cast(stat_code as int) % 28 + 1 as string), 2, '0'))"
            " end"
        ).alias("well_stat_date"),
    )


STAT_DATE = """case when cast(stat_code as int) % 3 = 2 then
  '2024-01-' || lpad(cast(cast(stat_code as int) % 28 + 1 as varchar), 2, '0') end"""


@query(
    "b11_well_attributes",
    f"""select uwi, name as well_name, trim(licensee) as licensee_code, fluid, mode, province,
    stat_code as well_stat_code, {STAT_DATE} as well_stat_date from {{wells}}""",
)
def b11(t):
    df = well_list(t)
    return silver.build_well_attributes(
        {"ab": df.where("province = 'AB'"), "sk": df.where("province = 'SK'")}
    )


@query(
    "b12_wells",
    f"""select uwi, name, trim(licensee) as licensee, fluid, mode, province, stat_code,
    coalesce(cast((select max(event_date) from {{status_changes}} s where s.uwi = w.uwi)
      as varchar), {STAT_DATE}) as stat_date,
    uwi in (select uwi from {{confidential_snapshots}}) as was_ever_confidential,
    uwi in (select uwi from {{confidential_snapshots}} where snapshot_date =
      (select max(snapshot_date) from {{confidential_snapshots}})) as is_currently_confidential,
    true as located from {{wells}} w""",
)
def b12(t):
    df = well_list(t)
    built = silver.build_wells(
        {
            "ab": df.where("province = 'AB'").drop("province"),
            "sk": df.where("province = 'SK'").drop("province"),
            "confidential": confidential(t),
            "status": t("status_changes"),
        }
    )
    return built.withColumn(
        "located", F.col("centroid_lat").isNotNull() & F.col("centroid_lon").isNotNull()
    ).drop("centroid_lat", "centroid_lon", "release_date")


@query(
    "b13_status_changes",
    """with d as (select uwi, event_date, max(event_id) as event_id,
        arg_max(new_status, event_id) as new_status from {status_changes}
        where new_status <> 'click' group by 1, 2)
    select d.uwi, cast(d.event_date as varchar) as event_date, d.new_status, d.event_id,
      trim(w.licensee) as well_licensee, w.name as well_name, w.uwi is not null as located
    from d left join {wells} w using (uwi)""",
)
def b13(t):
    """The click rows arrive as an error page and are dropped before deduping."""
    page = F.when(F.col("new_status") == "click", "<html>error</html>").otherwise(
        F.col("new_status")
    )
    weekly = t("status_changes").withColumn("new_status", page)
    wells = silver.build_wells({"ab": t("wells")})
    built = silver.build_status_changes({"weekly": weekly, "wells": wells}, ["event_id"])
    return built.withColumn("located", F.col("centroid_lat").isNotNull()).select(
        "uwi", "event_date", "new_status", "event_id", "well_licensee", "well_name", "located"
    )


@query(
    "b14_drilling_activity",
    """with s as (select uwi, event_date, 'st2_drilling' as source, null as event_type
        from {status_changes}
      union all select uwi, snapshot_date, 'st49_spud', 'spud' from {confidential_snapshots}
      union all select uwi, event_date, 'st49_spud_archive', 'spud' from {status_changes}
        where new_status = 'view'),
      d as (select * from s qualify row_number() over (
        partition by uwi, event_date order by source desc) = 1)
    select d.uwi, cast(d.event_date as varchar) as event_date, d.source, d.event_type,
      w.name as well_name from d left join {wells} w using (uwi)""",
)
def b14(t):
    def dated(df, column):
        return df.select("uwi", F.col(column).alias("spud_date"))

    built = silver.build_drilling_activity(
        {
            "weekly": t("status_changes").select("uwi", "event_date"),
            "daily": dated(t("confidential_snapshots"), "snapshot_date"),
            "archive": dated(t("status_changes").where("new_status = 'view'"), "event_date"),
            "wells": t("wells"),
        }
    )
    return built.select("uwi", "event_date", "source", "event_type", "well_name")


@query(
    "b15_ownership_changes",
    f"""select uwi, old_well_name, new_well_name, change_date,
    split_part(old_well_name, ' ', 1) as old_operator,
    split_part(new_well_name, ' ', 1) as new_operator from ({CHANGES_CHECK})""",
)
def b15(t):
    return silver.build_ownership_changes({"well_list": t("well_snapshots")})
