"""The published questions, each against an independent SQL answer."""

from pyspark.sql import functions as F

from wellspring.operators.filters import max_of
from wellspring.operators.sets import top_k
from wellspring.plans import cookbook as c
from wellspring.registry import query
from wellspring.registry.operators import confidential

# production of the newest Alberta month with its well
LATEST = """
with m as (select max(productionmonth) as m from {production} where province = 'AB'),
  x as (select p.*, trim(w.licensee) as operator, w.fluid
    from {production} p join m on m.m = p.productionmonth join {wells} w on w.uwi = p.uwi
    where p.province = 'AB')"""


@query(
    "c01_top_oil_producers",
    LATEST
    + """ select operator, count(distinct uwi) as wells,
    cast(round(sum(oil_prod_vol)) as double) as oil_m3 from x where oil_prod_vol > 0
    group by operator order by oil_m3 desc, operator limit 10""",
)
def c01(t):
    return c.top_oil_producers(t("production"), t("wells"))


@query(
    "c02_top_gas_producers",
    LATEST
    + """ select operator, count(distinct uwi) as wells,
    cast(round(sum(gas_prod_vol)) as double) as gas_e3m3 from x where gas_prod_vol > 0
    group by operator order by gas_e3m3 desc, operator limit 10""",
)
def c02(t):
    return c.top_gas_producers(t("production"), t("wells"))


TOP_WELL_CHECK = """(select uwi from {production} group by uwi
      order by sum(oil_prod_vol) desc, uwi limit 1)"""


def top_well(t):
    """The UWI with the most oil, so the well exists at every scale."""
    totals = t("production").groupBy("uwi").agg(F.sum("oil_prod_vol").alias("oil"))
    return top_k(totals, [F.desc("oil")], 1, ["uwi"]).select("uwi").scalar()


@query(
    "c03_decline_curve",
    f"""select productionmonth, cast(oil_prod_vol as double) as oil_m3,
    cast(gas_prod_vol as double) as gas_e3m3, cast(water_prod_vol as double) as water_m3
    from {{production}} where uwi = {TOP_WELL_CHECK}""",
)
def c03(t):
    return c.decline_curve(t("production"), top_well(t))


@query(
    "c04_licences_by_operator",
    """select licensee, count(*) as licences_issued, cast(min(issue_date) as varchar) as earliest,
    cast(max(issue_date) as varchar) as latest from {licences}
    where issue_date >= (select max(issue_date) - interval 30 day from {licences})
    group by licensee order by 2 desc, 1 limit 20""",
)
def c04(t):
    df = t("licences")
    return c.licences_by_operator(df, max_of(df, "issue_date"))


@query(
    "c05_spud_to_production",
    """with f as (select uwi, min(productionmonth) as m from {production}
      where oil_prod_vol > 0 group by uwi)
    select s.uwi, cast(s.spud_date as varchar) as spud_date, f.m as first_prod_month,
      datediff('month', s.spud_date, cast(f.m || '-01' as date)) as months_to_prod
    from (select distinct uwi, spud_date from {spuds} where spud_date >= '1997-01-01') s
    join f on f.uwi = s.uwi order by 4, 1, 2 limit 50""",
)
def c05(t):
    return c.spud_to_production(t("spuds"), t("production"), since="1997-01-01")


@query(
    "c06_status_by_operator",
    """select trim(licensee) as operator, count(*) as total,
    count(*) filter (where mode not in ('ABD', 'SUS')) as active,
    count(*) filter (where mode = 'SUS') as suspended,
    count(*) filter (where mode = 'ABD') as abandoned,
    (count(*) filter (where mode = 'ABD'))::double / count(*)::double * 100 as pct_abandoned
    from {wells} group by 1 having count(*) > 50 order by 2 desc, 1 limit 20""",
)
def c06(t):
    return c.status_by_operator(t("wells"), digits=None)


@query(
    "c07_water_cut",
    LATEST
    + """, s as (select operator, count(distinct uwi) as wells, sum(water_prod_vol)::double as w,
      sum(oil_prod_vol + water_prod_vol)::double as l from x
      where oil_prod_vol > 0 or water_prod_vol > 0 group by operator)
    select operator, wells, w / l * 100 as water_cut_pct from s where wells > 1
    order by 3 desc, 1 limit 20""",
)
def c07(t):
    """The fixture has few wells per operator and month, so the floor is 1."""
    return c.water_cut(t("production"), t("wells"), min_wells=1, digits=None)


@query(
    "c08_gas_oil_ratio",
    f"""select productionmonth, cast(oil_prod_vol as double) as oil_m3,
    cast(gas_prod_vol as double) as gas_e3m3, gas_prod_vol::double / oil_prod_vol::double as gor
    from {{production}} where oil_prod_vol > 0 and uwi = {TOP_WELL_CHECK}""",
)
def c08(t):
    return c.gas_oil_ratio(t("production"), top_well(t), digits=None)


@query(
    "c09_activity_by_township",
    """select substr(uwi, 10, 3) as township, substr(uwi, 14, 5) as range_mer,
    trim(licensee) as operator, count(*) as wells from {wells}
    where fluid in ('CR-OIL', 'CR-BIT') and province = 'AB'
    group by 1, 2, 3 having count(*) >= 2 order by 4 desc, 1, 2, 3 limit 30""",
)
def c09(t):
    return c.activity_by_township(t("wells"), min_wells=2)


@query(
    "c10_provinces_by_month",
    """select productionmonth, province, count(distinct uwi) as producing_wells,
    cast(round(sum(oil_prod_vol)) as double) as total_oil_m3,
    cast(round(sum(gas_prod_vol)) as double) as total_gas_e3m3
    from {production} where greatest(oil_prod_vol, gas_prod_vol) > 0
    group by 1, 2 order by 1 desc, 2 limit 24""",
)
def c10(t):
    return c.provinces_by_month(t("production"))


SEGMENTS = """(select p_type as substance, p_brand as status,
    cast(p_retailprice * 100 as decimal(18,3)) as length_m from {part})"""


@query(
    "c11_pipeline_density",
    f"""select substance, status, count(*) as segments,
    cast(round(sum(length_m) / 1000) as double) as total_km from {SEGMENTS} group by 1, 2""",
)
def c11(t):
    segments = t("part").selectExpr(
        "p_type as substance", "p_brand as status", "p_retailprice * 100 as length_m"
    )
    return c.pipeline_density(segments)


DECLINE_CHECK = """
with a as (select *, max(productionmonth) over () as newest from {production}
    where province = 'AB'),
  g as (select uwi, productionmonth, newest, oil_prod_vol as oil,
    lag(oil_prod_vol) over (partition by uwi order by productionmonth) as prev
    from a where oil_prod_vol > 0)
select uwi, productionmonth, cast(round(oil) as double) as oil_m3,
  cast(round(prev) as double) as prev_oil_m3,
  (oil - prev)::double / prev::double * 100 as mom_change_pct
from g where productionmonth = newest and prev > 5 order by 5, 1 limit 20"""


@query("c12_monthly_decline", DECLINE_CHECK)
def c12(t):
    return c.monthly_decline(t("production"), min_prev=5, digits=None)


@query(
    "c13_confidential_wells",
    """with s as (select uwi, max(op_name) as operator_name, min(snapshot_date) as a,
      max(snapshot_date) as b from {confidential_snapshots} group by uwi)
    select uwi, operator_name, cast(null as varchar) as release_date,
      cast(a as varchar) as first_seen, cast(b as varchar) as last_seen,
      true as is_currently_confidential, true as was_ever_confidential
    from s where b = (select max(b) from s) order by a desc, uwi limit 20""",
)
def c13(t):
    return c.confidential_wells(confidential(t))


@query(
    "c14_licences_on_same_legal",
    """select l.licence_number, l.uwi as new_uwi, l.licensee,
    cast(l.issue_date as varchar) as issue_date, w.uwi as existing_uwi, w.fluid, w.mode
    from {licences} l, {wells} w where substr(l.uwi, 4, 11) = substr(w.uwi, 4, 11)
      and l.uwi <> w.uwi
      and l.issue_date >= (select max(issue_date) - interval 90 day from {licences})
    order by 4 desc, 1, 2, 3, 5 limit 30""",
)
def c14(t):
    df = t("licences")
    return c.licences_on_same_legal(df, t("wells"), max_of(df, "issue_date"))


@query(
    "c15_production_by_fluid",
    """select p.province, w.fluid, count(distinct p.uwi) as wells,
    cast(round(sum(p.oil_prod_vol)) as double) as oil_m3,
    cast(round(sum(p.gas_prod_vol)) as double) as gas_e3m3
    from {production} p join {wells} w on w.uwi = p.uwi
    where p.productionmonth = (select max(productionmonth) from {production})
    group by 1, 2 having round(sum(p.oil_prod_vol)) > 0 or round(sum(p.gas_prod_vol)) > 0""",
)
def c15(t):
    return c.production_by_fluid(t("production"), t("wells"))


@query(
    "c16_yearly_growth",
    """with y as (select trim(w.licensee) as operator,
      sum(p.oil_prod_vol) filter (where p.productionmonth like '1997%') as new,
      sum(p.oil_prod_vol) filter (where p.productionmonth like '1996%') as old
      from {production} p join {wells} w using (uwi) where p.province = 'AB' group by 1)
    select operator, cast(round(new) as double) as oil_1997,
      cast(round(old) as double) as oil_1996, (new - old)::double / old::double * 100 as yoy_pct
    from y where round(new) > 100 order by 4 desc, 1 limit 20""",
)
def c16(t):
    return c.yearly_growth(
        t("production"), t("wells"), "1997", "1996", min_oil=100, digits=None
    )


@query(
    "c17_without_recent_production",
    """with r as (select uwi, max(productionmonth) as m from {production}
      where oil_prod_vol > 0 or gas_prod_vol > 0 group by uwi)
    select w.uwi, w.name as well_name, trim(w.licensee) as operator, w.fluid, w.mode,
      r.m as last_producing_month
    from {wells} w join r on r.uwi = w.uwi where w.mode = 'PMP' and w.province = 'AB'
      and w.uwi not in (select uwi from {production} where (oil_prod_vol > 0 or gas_prod_vol > 0)
        and productionmonth = (select max(productionmonth) from {production}))
    order by 6 desc, 1 limit 30""",
)
def c17(t):
    return c.without_recent_production(t("production"), t("wells"))


@query(
    "c18_new_entrants",
    """select licensee, cast(min(issue_date) as varchar) as first_date from {licences}
    group by licensee
    having min(issue_date) >= (select max(issue_date) - interval 2400 day from {licences})""",
)
def c18(t):
    df = t("licences")
    return c.new_entrants(df, max_of(df, "issue_date"), days=2400)


@query(
    "c19_cumulative_leaders",
    """select p.uwi, any_value(w.name) as well_name, any_value(trim(w.licensee)) as operator,
    any_value(w.fluid) as fluid, cast(round(sum(p.oil_prod_vol)) as double) as cumulative_oil_m3,
    cast(round(sum(p.gas_prod_vol)) as double) as cumulative_gas_e3m3,
    min(p.productionmonth) as first_month, max(p.productionmonth) as last_month,
    count(distinct p.productionmonth) as producing_months
    from {production} p join {wells} w on w.uwi = p.uwi where p.province = 'AB'
    group by p.uwi order by 5 desc, 1 limit 20""",
)
def c19(t):
    return c.cumulative_leaders(t("production"), t("wells"))


@query(
    "c20_spuds_by_contractor",
    """select drilling_contractor, count(*) as spuds, cast(min(spud_date) as varchar) as earliest,
    cast(max(spud_date) as varchar) as latest from {spuds}
    where spud_date >= (select max(spud_date) - interval 90 day from {spuds})
    group by 1 order by 2 desc, 1 limit 15""",
)
def c20(t):
    df = t("spuds")
    return c.spuds_by_contractor(df, max_of(df, "spud_date"))


@query(
    "c21_top_crude_by_prefix",
    """select left(trim(w.licensee), 4) as operator, cast(sum(p.oil_prod_vol) as double) as oil_m3
    from {production} p join {wells} w on w.uwi = p.uwi and w.fluid like 'CR%'
    where p.productionmonth =
      (select max(productionmonth) from {production} where province = 'AB')
    group by 1 order by 2 desc, 1 limit 10""",
)
def c21(t):
    return c.top_crude_by_prefix(t("production"), t("wells"))


@query(
    "c22_recent_licences",
    """select licence_number, uwi, licensee, cast(issue_date as varchar) as issue_date, province,
    o_orderkey from {licences}
    where issue_date >= (select max(issue_date) - interval 30 day from {licences})""",
)
def c22(t):
    df = t("licences")
    return c.recent_licences(df, max_of(df, "issue_date"))


@query(
    "c23_monthly_growth",
    """with y as (select left(trim(w.licensee), 4) as op,
      sum(p.oil_prod_vol) filter (where p.productionmonth = '1997-06') as a,
      sum(p.oil_prod_vol) filter (where p.productionmonth = '1996-06') as b
      from {production} p join {wells} w using (uwi) where p.province = 'AB' group by 1)
    select op, cast(a as double) as month, cast(b as double) as month_prev,
      (a - b)::double / b::double * 100 as yoy_pct from y where a > 100""",
)
def c23(t):
    return c.monthly_growth(
        t("production"), t("wells"), "1997-06", "1996-06", min_oil=100, digits=None
    )
