"""Queries over the views."""

from wellspring.plans import views
from wellspring.registry import query
from wellspring.registry.operators import FEED_CHECK, GROUPS_CHECK, aliases

VOLUMES = ", ".join(
    f"cast({c} as double) as {c}" for c in ("oil_prod_vol", "gas_prod_vol", "water_prod_vol")
)


@query(
    "v01_production_keys",
    f"""select productionmonth, uwi, province, {VOLUMES},
    if(province = 'SK', '1' || regexp_replace(uwi, '[/-]', '', 'g') || '0', uwi)
      as normalized_uwi from {{production}}""",
)
def v01(t):
    return views.production_with_keys(t("production"))


@query(
    "v02_latest_production",
    f"""select productionmonth, uwi, province, {VOLUMES} from {{production}}
    qualify rank() over (order by productionmonth desc) = 1""",
)
def v02(t):
    return views.latest_production(t("production"))


@query(
    "v03_well_summary",
    """select w.uwi, w.name as well_name, w.licensee, w.fluid, w.mode, w.province,
    w.stat_code as status_code,
    cast(coalesce(sum(p.oil_prod_vol), 0) as double) as cumulative_oil_m3,
    cast(coalesce(sum(p.gas_prod_vol), 0) as double) as cumulative_gas_e3m3,
    cast(coalesce(sum(p.water_prod_vol), 0) as double) as cumulative_water_m3,
    min(p.productionmonth) as first_prod_month, max(p.productionmonth) as last_prod_month,
    nullif(count(distinct p.productionmonth), 0) as producing_months
    from {wells} w left join {production} p
      on p.uwi = w.uwi and (p.oil_prod_vol > 0 or p.gas_prod_vol > 0) group by all""",
)
def v03(t):
    return views.well_summary(t("wells"), t("production"))


@query(
    "v04_operator_scorecard",
    """select trim(licensee) as operator_code, count(*) as total_wells,
    cast(sum(if(mode = 'ABD', 0, 1)) as bigint) as active_wells,
    cast(sum(if(mode = 'ABD', 1, 0)) as bigint) as abandoned_wells,
    cast(sum(if(fluid like 'CR%', 1, 0)) as bigint) as crude_wells,
    cast(sum(if(fluid = 'GAS', 1, 0)) as bigint) as gas_wells
    from {wells} where trim(coalesce(licensee, '')) <> '' group by 1""",
)
def v04(t):
    return views.operator_scorecard(t("wells"))


@query(
    "v05_monthly_provincial",
    """select province, productionmonth, count(distinct uwi) as producing_wells,
    cast(sum(oil_prod_vol) as double) as total_oil_m3,
    cast(sum(gas_prod_vol) as double) as total_gas_e3m3,
    cast(sum(water_prod_vol) as double) as total_water_m3
    from {production} where oil_prod_vol + gas_prod_vol > 0 group by all""",
)
def v05(t):
    return views.monthly_provincial(t("production"))


@query("v06_new_activity", FEED_CHECK)
def v06(t):
    return views.new_activity(t("licences"), t("spuds"), t("status_changes"))


@query("v07_operator_groups", GROUPS_CHECK)
def v07(t):
    return views.operator_groups(t("wells"), aliases(t))


@query(
    "v08_facilities_by_operator",
    """select operator_name, count(*) as facility_count,
    count(*) filter (where is_active) as active_count,
    count(*) filter (where not is_active) as inactive_count
    from {facility_snapshots} where operator_name is not null group by 1""",
)
def v08(t):
    return views.facilities_by_operator(t("facility_snapshots"))


@query(
    "v09_published_views",
    """select 'wells' as table_name, count(*) as n from {wells}
    union all select 'v_latest_production', count(*) from {production}
      where productionmonth = (select max(productionmonth) from {production})
    union all select 'v_new_activity', (select count(*) from {licences})
      + (select count(*) from {spuds}) + (select count(*) from {status_changes})
    union all select 'licence_activity', count(*) from {licences}""",
)
def v09(t):
    """The published names, from tables where only the attribute list was built."""
    from wellspring.operators.sets import table_counts

    spark = t("wells").sparkSession
    shown = views.all_views(
        {
            "well_attributes": t("wells"),
            "production": t("production"),
            "well_licences": t("licences"),
            "spud_activity": t("spuds"),
            "status_changes": t("status_changes"),
        },
        spark,
    )
    names = ("wells", "v_latest_production", "v_new_activity", "licence_activity")
    return table_counts({n: shown[n] for n in names})
