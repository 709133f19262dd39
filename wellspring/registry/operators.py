"""Queries over filters, joins, aggregates, windows, sorts and unions."""

from pyspark.sql import functions as F

from wellspring.constants import VOLUMETRIC_KEYS
from wellspring.functions.text import status_label
from wellspring.operators import aggregates, filters, joins, keyed
from wellspring.operators.sets import activity_feed, table_counts, top_k, union_all
from wellspring.registry import query

# --- filters ----------------------------------------------------------------


@query(
    "f01_activity",
    """select from_to_id, productid, cast(volume as double) as volume, l_orderkey, l_linenumber
    from {volumetric} where activityid = 'PROD'""",
)
def f01(t):
    return filters.activity(t("volumetric")).select(
        "from_to_id", "productid", "volume", "l_orderkey", "l_linenumber"
    )


@query(
    "f02_producing",
    """select uwi, productionmonth from {production}
    where greatest(oil_prod_vol, gas_prod_vol) > 0""",
)
def f02(t):
    return filters.producing(t("production")).select("uwi", "productionmonth")


@query(
    "f03_latest_month",
    """select uwi, productionmonth, cast(oil_prod_vol as double) as oil_prod_vol from {production}
    where province = 'AB' and productionmonth =
      (select max(productionmonth) from {production} where province = 'AB')""",
)
def f03(t):
    return filters.latest_month(t("production"), "AB").select(
        "uwi", "productionmonth", "oil_prod_vol"
    )


@query(
    "f04_non_blank",
    """select facility_id, cast(snapshot_date as varchar) as snapshot_date, operator_name
    from {facility_snapshots} where length(trim(operator_name)) > 0""",
)
def f04(t):
    return filters.non_blank(t("facility_snapshots"), "operator_name").select(
        "facility_id", "snapshot_date", "operator_name"
    )


@query(
    "f05_like_and_in",
    """select uwi, fluid, mode from {wells}
    where starts_with(fluid, 'CR') and mode <> 'ABD' and mode <> 'SUS'""",
)
def f05(t):
    return (
        t("wells")
        .where(F.col("fluid").like("CR%") & ~F.col("mode").isin("ABD", "SUS"))
        .select("uwi", "fluid", "mode")
    )


@query(
    "f06_within_days",
    """select licence_number, o_orderkey, cast(issue_date as varchar) as issue_date
    from {licences}
    where issue_date + 90 >= (select max(issue_date) from {licences})""",
)
def f06(t):
    df = t("licences")
    return filters.within_days(df, "issue_date", filters.max_of(df, "issue_date"), 90).select(
        "licence_number", "o_orderkey", "issue_date"
    )


@query("f07_drop_html", "select event_id, event_type from {events} where event_type <> 'error'")
def f07(t):
    page = F.when(F.col("event_type") == "error", "<!DOCTYPE html><p>").otherwise(
        F.col("event_type")
    )
    loaded = t("events").select("event_id", page.alias("event_type"), F.lit(1).alias("<html>_0"))
    return filters.drop_html(loaded)


@query(
    "f08_having",
    """select licensee, n from (select licensee, count(*) as n, min(issue_date) as d
      from {licences} group by licensee) where n > 100""",
)
def f08(t):
    return (
        t("licences").groupBy("licensee").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 100)
    )


# --- joins ------------------------------------------------------------------


@query(
    "j01_enrich_geo",
    """select s.facility_id, cast(s.snapshot_date as varchar) as snapshot_date,
    g.centroid_lat, g.centroid_lon from {facility_snapshots} s
    left join {facility_geo} g on g.facility_id = s.facility_id""",
)
def j01(t):
    return joins.enrich_geo(t("facility_snapshots"), t("facility_geo")).select(
        "facility_id", "snapshot_date", "centroid_lat", "centroid_lon"
    )


def confidential(t):
    from wellspring.plans.silver import build_confidential_wells

    return build_confidential_wells({"confidential": t("confidential_snapshots")})


@query(
    "j02_enrich_confidential",
    """select uwi, uwi in (select uwi from {confidential_snapshots}) as was_ever_confidential,
    uwi in (select uwi from {confidential_snapshots} where snapshot_date =
      (select max(snapshot_date) from {confidential_snapshots})) as is_currently_confidential
    from {wells}""",
)
def j02(t):
    return joins.enrich_confidential(t("wells"), confidential(t)).select(
        "uwi", "was_ever_confidential", "is_currently_confidential"
    )


@query(
    "j03_enrich_status",
    """select w.uwi, cast((select max(event_date) from {status_changes} s where s.uwi = w.uwi)
      as varchar) as stat_date from {wells} w""",
)
def j03(t):
    return joins.enrich_status(t("wells"), t("status_changes")).select("uwi", "stat_date")


@query(
    "j04_enrich_wells",
    """select e.event_id, e.uwi, e.new_status, w.licensee as well_licensee, w.name as well_name
    from {status_changes} e left join {wells} w using (uwi)""",
)
def j04(t):
    return joins.enrich_wells(t("status_changes"), t("wells")).select(
        "event_id", "uwi", "new_status", "well_licensee", "well_name"
    )


@query(
    "j05_merged_ranges",
    """with seen as (select facility_id, min(snapshot_date) as a, max(snapshot_date) as b
        from {facility_snapshots} group by 1),
      act as (select facility_id, min(snapshot_date) as c, max(snapshot_date) as d
        from {facility_snapshots} where is_active group by 1)
    select facility_id, cast(a as varchar) as first_seen, cast(b as varchar) as last_seen,
      cast(c as varchar) as first_active_date, cast(d as varchar) as last_active_date
    from seen left join act using (facility_id)""",
)
def j05(t):
    return t("facility_snapshots").groupBy("facility_id").agg(
        *keyed.seen_range("snapshot_date", "is_active")
    )


CHANGES_CHECK = """
with d as (select distinct snapshot_date from {well_snapshots}),
  o as (select snapshot_date, row_number() over (order by snapshot_date) as i from d),
  s as (select w.*, o.i from {well_snapshots} w join o using (snapshot_date))
select b.uwi, a.well_name as old_well_name, b.well_name as new_well_name,
  b.snapshot_date as change_date
from s a join s b on a.uwi = b.uwi and b.i = a.i + 1 and a.well_name <> b.well_name"""


@query("j06_snapshot_pairs", CHANGES_CHECK)
def j06(t):
    return keyed.snapshot_pairs(t("well_snapshots"), "uwi", "snapshot_date", "well_name")


@query(
    "j07_fact_dim",
    """select p.uwi, p.productionmonth, trim(w.licensee) as operator, w.fluid,
    cast(p.oil_prod_vol as double) as oil_prod_vol from {production} p, {wells} w
    where w.uwi = p.uwi""",
)
def j07(t):
    return joins.fact_dim(t("production"), t("wells")).select(
        "uwi", "productionmonth", F.trim("licensee").alias("operator"), "fluid", "oil_prod_vol"
    )


@query(
    "j08_dim_left_fact",
    """select w.uwi, cast(coalesce(sum(p.oil_prod_vol), 0) as double) as total_oil
    from {wells} w left join {production} p on p.uwi = w.uwi group by w.uwi""",
)
def j08(t):
    totals = aggregates.cumulative(t("production")).select("uwi", "total_oil")
    return (
        t("wells")
        .select("uwi")
        .join(totals, "uwi", "left")
        .withColumn("total_oil", F.coalesce("total_oil", F.lit(0)))
    )


def aliases(t):
    """Two operator codes under one name, as a manual override table."""
    return t("part").sparkSession.createDataFrame(
        [("Brand#1", "ALFA GROUP"), ("Brand#2", "ALFA GROUP")], "ba_code string, canonical_name string"
    )


@query(
    "j09_apply_aliases",
    """select uwi, trim(licensee) as ba_code,
    case when trim(licensee) in ('Brand#1', 'Brand#2') then 'ALFA GROUP' else name end as operator
    from {wells}""",
)
def j09(t):
    operators = t("wells").select(
        "uwi", F.trim("licensee").alias("ba_code"), F.col("name").alias("operator")
    )
    return joins.apply_aliases(operators, aliases(t), "operator")


@query(
    "j10_same_legal",
    """select l.licence_number, l.o_orderkey, l.uwi, count(*) as other_wells
    from {licences} l join {wells} w
      on substring(w.uwi, 4, 11) = substring(l.uwi, 4, 11) and w.uwi <> l.uwi
    group by all""",
)
def j10(t):
    return joins.same_legal(t("licences"), t("wells")).select(
        "licence_number", "o_orderkey", "uwi", "other_wells"
    )


@query(
    "j11_one_sided_residual",
    """select s.uwi, cast(s.spud_date as varchar) as spud_date, count(p.uwi) as oil_months
    from {spuds} s left join {production} p on p.uwi = s.uwi and p.oil_prod_vol > 0
    group by all""",
)
def j11(t):
    """Residual predicate on one side: applied and reduced below the join."""
    months = (
        t("production")
        .where("oil_prod_vol > 0")
        .groupBy("uwi")
        .agg(F.count(F.lit(1)).alias("months"))
    )
    spuds = t("spuds").groupBy("uwi", "spud_date").agg(F.count(F.lit(1)).alias("spuds"))
    return spuds.join(months, "uwi", "left").select(
        "uwi",
        "spud_date",
        (F.col("spuds") * F.coalesce("months", F.lit(0))).alias("oil_months"),
    )


@query(
    "j12_not_in",
    "select uwi, name from {wells} where uwi not in (select uwi from {status_changes})",
)
def j12(t):
    return joins.not_in(t("wells"), t("status_changes"), "uwi").select("uwi", "name")


@query(
    "j13_alias_views",
    """select uwi, 'wells' as from_view from {wells}
    union all select uwi, 'licence_activity' from {licences}""",
)
def j13(t):
    from wellspring.plans.views import alias_tables

    shown = alias_tables({"well_attributes": t("wells"), "well_licences": t("licences")})
    return union_all(
        *[
            shown[name].select("uwi", F.lit(name).alias("from_view"))
            for name in ("wells", "licence_activity")
        ]
    )


# --- aggregates -------------------------------------------------------------


@query(
    "a01_pivot_products",
    """select * from (select productionmonth, uwi, province,
      cast(sum(if(productid = 'OIL', volume, 0)) as double) as oil_prod_vol,
      cast(sum(if(productid = 'GAS', volume, 0)) as double) as gas_prod_vol,
      cast(sum(if(productid = 'WATER', volume, 0)) as double) as water_prod_vol
    from {volumetric} where activityid = 'PROD' group by 1, 2, 3)""",
)
def a01(t):
    return aggregates.pivot_products(filters.activity(t("volumetric")))


@query(
    "a02_conditional_counts",
    """select trim(licensee) as operator_code, count(*) as total_wells,
    count(*) filter (where mode <> 'ABD') as active_wells,
    count(*) filter (where mode = 'ABD') as abandoned_wells,
    count(*) filter (where fluid in ('CR-OIL', 'CR-BIT')) as crude_wells,
    count(*) filter (where fluid = 'GAS') as gas_wells
    from {wells} group by 1""",
)
def a02(t):
    return aggregates.scorecard(t("wells"))


@query(
    "a03_count_distinct",
    """select province, count(distinct uwi) as wells, count(distinct productionmonth) as months
    from {production} group by province""",
)
def a03(t):
    return (
        t("production")
        .groupBy("province")
        .agg(
            F.countDistinct("uwi").alias("wells"),
            F.countDistinct("productionmonth").alias("months"),
        )
    )


@query(
    "a04_seen_range",
    """select uwi, min(snapshot_date) as first_seen, max(snapshot_date) as last_seen
    from {well_snapshots} group by uwi""",
)
def a04(t):
    return t("well_snapshots").groupBy("uwi").agg(*keyed.seen_range("snapshot_date"))


@query(
    "a05_last_first_nonnull",
    """select facility_id,
    (array_agg(operator_name order by snapshot_date desc)
      filter (where operator_name is not null))[1] as last_operator,
    (array_agg(operator_name order by snapshot_date)
      filter (where operator_name is not null))[1] as first_operator
    from {facility_snapshots} group by facility_id""",
)
def a05(t):
    order = F.col("snapshot_date")
    return (
        t("facility_snapshots")
        .groupBy("facility_id")
        .agg(
            keyed.last_nonnull("operator_name", order).alias("last_operator"),
            keyed.first_nonnull("operator_name", order).alias("first_operator"),
        )
    )


@query(
    "a06_ordered_string_aggregate",
    """select fluid, string_agg(distinct trim(licensee), ',' order by trim(licensee)) as ba_codes
    from {wells} group by fluid""",
)
def a06(t):
    """Codes are made distinct per fluid before they are listed."""
    codes = t("wells").select("fluid", F.trim("licensee").alias("code")).distinct()
    return codes.groupBy("fluid").agg(
        F.array_join(F.array_sort(F.collect_set("code")), ",").alias("ba_codes")
    )


@query(
    "a07_most_common_name",
    """with c as (select trim(licensee) as ba_code, upper(split_part(name, ' ', 1)) as n,
        count(*) as k from {wells} group by 1, 2)
    select ba_code, (array_agg(n order by k desc, n))[1] as primary_name,
      cast(sum(k) as bigint) as total_wells from c group by 1""",
)
def a07(t):
    return aggregates.mode_name(t("wells"))


GROUPS_CHECK = """
with c as (select trim(licensee) as ba_code, upper(split_part(name, ' ', 1)) as n,
    count(*) as k from {wells} group by 1, 2),
  p as (select ba_code, (array_agg(n order by k desc, n))[1] as primary_name, sum(k) as w
    from c group by 1),
  g as (select *, case when ba_code in ('Brand#1', 'Brand#2') then 'ALFA GROUP'
    else primary_name end as normalized_name from p)
select normalized_name, (array_agg(primary_name order by w desc, primary_name))[1] as display_name,
  cast(sum(w) as bigint) as total_wells, string_agg(ba_code, ',' order by ba_code) as ba_codes,
  count(*) as ba_code_count from g group by 1"""


@query("a08_operator_groups", GROUPS_CHECK)
def a08(t):
    return aggregates.operator_groups(t("wells"), aliases(t))


CUMULATIVE_CHECK = """
select uwi, cast(sum(oil_prod_vol) as double) as total_oil,
  cast(sum(gas_prod_vol) as double) as total_gas,
  cast(sum(water_prod_vol) as double) as total_water,
  min(productionmonth) as first_prod_month, max(productionmonth) as last_prod_month,
  count(distinct productionmonth) as producing_months
from {production} group by uwi"""


@query("a09_cumulative", CUMULATIVE_CHECK)
def a09(t):
    return aggregates.cumulative(t("production"))


@query(
    "a10_conditional_pivot",
    """with y as (select province, substr(productionmonth, 1, 4) as y, sum(oil_prod_vol) as oil
      from {production} group by 1, 2)
    select province, cast(max(oil) filter (where y = '1996') as double) as oil_1996,
      cast(max(oil) filter (where y = '1997') as double) as oil_1997 from y group by 1""",
)
def a10(t):
    year = F.substring("productionmonth", 1, 4)
    oil = F.col("oil_prod_vol")
    return (
        t("production")
        .groupBy("province")
        .agg(
            F.sum(F.when(year == "1996", oil)).alias("oil_1996"),
            F.sum(F.when(year == "1997", oil)).alias("oil_1997"),
        )
    )


@query(
    "a11_global_aggregate",
    """select max(productionmonth) as latest, count(*) as n,
    cast(sum(volume) as double) as volume from {volumetric}""",
)
def a11(t):
    return t("volumetric").agg(
        F.max("productionmonth").alias("latest"),
        F.count(F.lit(1)).alias("n"),
        F.sum("volume").alias("volume"),
    )


@query("a12_distinct", "select uwi from {production} group by uwi")
def a12(t):
    return aggregates.distinct_keys(t("production"), "uwi")


# --- which row wins ---------------------------------------------------------


@query(
    "w01_latest_row_dedupe",
    """select uwi, province, well_name, snapshot_date from {well_snapshots} qualify
    row_number() over (partition by uwi, province order by snapshot_date desc) = 1""",
)
def w01(t):
    return keyed.latest_by(
        t("well_snapshots"), ["uwi", "province"], [F.desc("snapshot_date"), "well_name"]
    ).select("uwi", "province", "well_name", "snapshot_date")


@query(
    "w02_dedupe_spuds",
    """select uwi, cast(spud_date as varchar) as spud_date, province,
    (array_agg(drilling_contractor order by o_orderkey desc))[1] as drilling_contractor
    from {spuds} group by uwi, spuds.spud_date, province""",
)
def w02(t):
    return keyed.latest_by(
        t("spuds"), ["uwi", "spud_date", "province"], [F.desc("o_orderkey")]
    ).select("uwi", "spud_date", "province", "drilling_contractor")


@query(
    "w03_dedupe_licences",
    """select l.licence_number, l.province, l.uwi, l.licensee, l.o_orderkey from {licences} l
    where not exists (select 1 from {licences} m where m.licence_number = l.licence_number
      and m.province = l.province and (m.issue_date > l.issue_date
        or (m.issue_date = l.issue_date and m.o_orderkey > l.o_orderkey)))""",
)
def w03(t):
    return keyed.latest_by(
        t("licences"), ["licence_number", "province"], [F.desc("issue_date"), F.desc("o_orderkey")]
    ).select("licence_number", "province", "uwi", "licensee", "o_orderkey")


TRANSITIONS_CHECK = """
select facility_id, cast(snapshot_date as varchar) as event_date,
  if(p, 'Active', 'Inactive') as old_status, if(is_active, 'Active', 'Inactive') as new_status
from (select *, lag(is_active) over (partition by facility_id order by snapshot_date) as p
  from {facility_snapshots}) where p <> is_active"""


@query("w04_status_transitions", TRANSITIONS_CHECK)
def w04(t):
    changed = keyed.transitions(
        t("facility_snapshots"), "facility_id", "snapshot_date", "is_active"
    )
    return changed.select(
        "facility_id",
        F.col("snapshot_date").alias("event_date"),
        status_label(F.col("prev_is_active")).alias("old_status"),
        status_label(F.col("is_active")).alias("new_status"),
    )


@query("w05_snapshot_changes", CHANGES_CHECK)
def w05(t):
    return keyed.snapshot_changes(t("well_snapshots"), "uwi", "snapshot_date", "well_name")


@query(
    "w06_amendment_dedupe",
    """select from_to_id, productionmonth, activityid, productid, l_orderkey, l_linenumber,
    cast(volume as double) as volume from {volumetric} qualify row_number() over (
      partition by from_to_id, productionmonth, activityid, productid
      order by snapshot_date desc, l_orderkey desc, l_linenumber desc, volume desc) = 1""",
)
def w06(t):
    return keyed.latest_by(
        t("volumetric"),
        VOLUMETRIC_KEYS,
        [F.desc(c) for c in ("snapshot_date", "l_orderkey", "l_linenumber", "volume")],
    ).select(*VOLUMETRIC_KEYS, "l_orderkey", "l_linenumber", "volume")


@query(
    "w07_source_priority",
    """with s as (select uwi, event_date, 'st2_drilling' as source from {status_changes}
      union all select uwi, snapshot_date, 'spud_archive' from {confidential_snapshots}
      union all select uwi, event_date, 'spud_daily' from {status_changes}
        where new_status = 'view')
    select uwi, cast(event_date as varchar) as event_date, max(source) as source
    from s group by uwi, s.event_date""",
)
def w07(t):
    status = t("status_changes").select("uwi", "event_date")
    listed = t("confidential_snapshots").select("uwi", F.col("snapshot_date").alias("event_date"))
    daily = t("status_changes").where("new_status = 'view'").select("uwi", "event_date")
    tagged = union_all(
        status.withColumn("source", F.lit("st2_drilling")),
        listed.withColumn("source", F.lit("spud_archive")),
        daily.withColumn("source", F.lit("spud_daily")),
    )
    return keyed.latest_by(tagged, ["uwi", "event_date"], [F.desc("source")])


@query(
    "w08_dedupe_status",
    """select uwi, cast(event_date as varchar) as event_date, max(event_id) as event_id,
    arg_max(new_status, event_id) as new_status from {status_changes}
    group by uwi, status_changes.event_date""",
)
def w08(t):
    return keyed.latest_by(
        t("status_changes"), ["uwi", "event_date"], [F.desc("event_id")]
    ).select("uwi", "event_date", "event_id", "new_status")


@query(
    "w09_latest_event",
    """select uwi, cast(max(event_date) as varchar) as event_date,
    arg_max(new_status, event_id) as new_status from {status_changes} group by uwi""",
)
def w09(t):
    order = F.struct("event_date", "event_id")
    return (
        t("status_changes")
        .groupBy("uwi")
        .agg(
            F.max("event_date").alias("event_date"),
            F.max_by("new_status", order).alias("new_status"),
        )
    )


@query(
    "w10_month_over_month",
    """with m as (select uwi, productionmonth, cast(oil_prod_vol as double) as oil,
      lag(cast(oil_prod_vol as double)) over (partition by uwi order by productionmonth) as prev
      from {production} where oil_prod_vol > 0)
    select uwi, productionmonth, oil as oil_prod_vol, prev as prev_oil_prod_vol,
      (oil - prev) / prev * 100 as mom_change_pct from m""",
)
def w10(t):
    oil = t("production").where("oil_prod_vol > 0").select(
        "uwi", "productionmonth", F.col("oil_prod_vol").cast("double").alias("oil_prod_vol")
    )
    return keyed.mom_change(oil)


@query(
    "w11_first_seen",
    """select facility_id, cast(min(snapshot_date) as varchar) as event_date,
    arg_min(is_active, snapshot_date) as is_active,
    arg_min(operator_name, snapshot_date) filter (where operator_name is not null)
      as operator_name from {facility_snapshots} group by facility_id""",
)
def w11(t):
    return keyed.first_events(
        t("facility_snapshots"), "facility_id", "snapshot_date", ["is_active", "operator_name"]
    )


@query(
    "w12_line_look_ahead",
    """select cast(user_id as varchar) as file, event_id as line_no, event_type as value,
    lead(event_type, 1) over w as next_line, lead(event_type, 4) over w as fourth_line
    from {events} window w as (partition by user_id order by event_id)""",
)
def w12(t):
    """Events as report lines, one file per user; line numbers are dense per file."""
    w = keyed.Window.partitionBy("file").orderBy("event_id")
    lines = (
        t("events")
        .select(
            F.col("user_id").cast("string").alias("file"),
            F.lit("").alias("member"),
            "event_id",
            F.col("event_type").alias("value"),
        )
        .withColumn("line_no", (F.row_number().over(w) - 1).cast("bigint"))
    )
    ahead = keyed.look_ahead(
        lines,
        {"next_line": (F.col("value"), 1), "fourth_line": (F.col("value"), 4)},
        block=32,
    )
    return ahead.select(
        "file", F.col("event_id").alias("line_no"), "value", "next_line", "fourth_line"
    )


# --- sorts, sets ------------------------------------------------------------


@query(
    "o01_top_k",
    """select uwi, cast(sum(oil_prod_vol) as double) as oil from {production}
    group by uwi order by 2 desc, 1 limit 25""",
)
def o01(t):
    totals = t("production").groupBy("uwi").agg(F.sum("oil_prod_vol").alias("oil"))
    return top_k(totals, [F.desc("oil")], 25, ["uwi"])


@query(
    "o02_ordered_series",
    """select productionmonth, cast(sum(oil_prod_vol) as double) as oil from {production}
    group by 1 order by 1""",
)
def o02(t):
    return (
        t("production")
        .groupBy("productionmonth")
        .agg(F.sum("oil_prod_vol").alias("oil"))
        .orderBy("productionmonth")
    )


@query(
    "o03_check_all_rows",
    """select count(*) as n, cast(avg(if(regexp_full_match(uwi,
      '\\d{2}/\\d{2}-\\d{2}-\\d{3}-\\d{2}W\\d/\\d+'), 1.0, 0.0)) as double) as valid_share
    from {volumetric}""",
)
def o03(t):
    """The format share over every row, where a sample would be cheaper but wrong."""
    from wellspring.constants import UWI_DISPLAY

    return t("volumetric").agg(
        F.count("uwi").alias("n"),
        F.avg(F.col("uwi").rlike(UWI_DISPLAY).cast("double")).alias("valid_share"),
    )


@query(
    "u01_union_by_name",
    """select uwi, province, spud_date::varchar as day, drilling_contractor, null as licensee
      from {spuds}
    union all select uwi, province, issue_date::varchar, null, licensee from {licences}""",
)
def u01(t):
    return union_all(
        t("spuds").select(
            "uwi", "province", F.col("spud_date").alias("day"), "drilling_contractor"
        ),
        t("licences").select("uwi", "province", F.col("issue_date").alias("day"), "licensee"),
    )


FEED_CHECK = """
select uwi, 'licence' as event_type, cast(issue_date as varchar) as event_date from {licences}
union all select uwi, 'spud', cast(spud_date as varchar) from {spuds}
union all select uwi, 'status_change', cast(event_date as varchar) from {status_changes}"""


@query("u02_activity_union", FEED_CHECK)
def u02(t):
    return activity_feed(t("licences"), t("spuds"), t("status_changes"))


@query(
    "k06_table_counts",
    """select 'production' as table_name, count(*) as n from {production}
    union all select 'wells', count(*) from {wells}
    union all select 'licences', count(*) from {licences}""",
)
def k06(t):
    return table_counts({n: t(n) for n in ("production", "wells", "licences")})


