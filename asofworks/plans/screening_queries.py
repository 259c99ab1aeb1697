"""Queries of the screening operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import screening as C
from asofworks.plans.registry import Tables, query

SCREEN_SQL = """o as (select cik, max(case when metric = 'A' then value end) as a, max(case when metric = 'N' then value end) as n from annual where fiscal_year = 1998 group by cik),
    s as (select cik, case when a > 60000 then 'PASS' when a is null then 'UNDETERMINED' else 'FAIL' end as x, case when n <= 200000 then 'PASS' when n is null then 'UNDETERMINED' else 'FAIL' end as y from o),
    r as (select cik, case when x = 'FAIL' or y = 'FAIL' then 'FAIL' when x = 'PASS' and y = 'PASS' then 'PASS' else 'UNDETERMINED' end as result, concat_ws(',', case when x = 'UNDETERMINED' then 'A' end, case when y = 'UNDETERMINED' then 'N' end) as undetermined from s)"""


def screened(t: Tables) -> DataFrame:
    return C.screen(t.annual.where("fiscal_year = 1998"), [("A", "GT", 60000), ("N", "LTE", 200000)])


@query("c22_screen", f"with {SCREEN_SQL} select * from r")
def c22(t: Tables) -> DataFrame:
    return screened(t).select("cik", "result", F.array_join("undetermined", ",").alias("undetermined"))


@query("a23_screen_counts", f"""with {SCREEN_SQL} select count(*) as target, count(*) filter (where result = 'PASS') as "pass", count(*) filter (where result = 'FAIL') as "fail", count(*) filter (where result = 'UNDETERMINED') as undetermined, true as reconciles from r""")
def a23(t: Tables) -> DataFrame:
    return C.screen_counts(screened(t))


@query(
    "p5_filter_universe",
    """select cik, exclusions, exclusions = '' as eligible from (select cik, concat_ws(',', case when exchange not in ('BUILDING', 'MACHINERY') then 'EXCHANGE_EXCLUDED' end, case when sic not in (1, 2, 3, 4, 5, 6, 7) then 'SIC_EXCLUDED' end, case when cik not in (3, 5, 8, 13, -1) then 'NOT_REQUESTED' end) as exclusions from companies
    union all select -1, 'METADATA_UNAVAILABLE') x""",
)
def p5(t: Tables) -> DataFrame:
    rows = C.filter_universe(t.companies, "cik", {"exchange": ["BUILDING", "MACHINERY"], "sic": list(range(1, 8))}, [3, 5, 8, 13, -1])
    return rows.select("cik", F.array_join("exclusions", ",").alias("exclusions"), "eligible")


@query("p6_search_companies", "select cik, name, (select count(*) from companies where contains(lower(name), '#00000001')) as total from companies where contains(lower(name), '#00000001') order by name, cik limit 20 offset 3")
def p6(t: Tables) -> DataFrame:
    return C.search_companies(t.companies, "#00000001", ["name"], ["name", "cik"], 3, 20).select("cik", "name", "total")


@query("p8_resolve_company", "select case when count(*) = 1 then min(cik) end as cik, case when count(*) = 0 then 'NOT_FOUND' when count(*) > 1 then 'AMBIGUOUS' end as error from companies where lower(name) = 'customer#000000042' or cast(cik as varchar) = 'customer#000000042'")
def p8(t: Tables) -> DataFrame:
    return C.resolve_company(t.companies, "cik", ["name", "cik"], "Customer#000000042 ")


@query("j8_peers", "select cik, count(*) over (partition by sic) - 1 as n_peers, row_number() over (partition by sic order by balance desc, cik) as position from companies")
def j8(t: Tables) -> DataFrame:
    return C.peers(t.companies, "cik", "sic").select("cik", "n_peers", F.col("position").cast("long"))


@query("j8_peers_of", "select cik, name from companies where sic = (select sic from companies where cik = 7) and cik <> 7")
def j8b(t: Tables) -> DataFrame:
    return C.peers_of(t.companies, "cik", "sic", 7).select("cik", "name")


@query("t1_sort_screen", "select cik, cast(value as double) as value from (select c.cik as cik, a.value as value from companies c left join (select * from annual where fiscal_year = 1998 and metric = 'A') a on c.cik = a.cik) x order by value desc nulls last, cik limit 100")
def t1(t: Tables) -> DataFrame:
    values = t.annual.where("fiscal_year = 1998 and metric = 'A'").select("cik", "value")
    return C.sort_screen(t.companies.select("cik").join(values, "cik", "left"), "value", True, "cik", 100).select("cik", F.col("value").cast("double"))


@query("t4_quarter_series", "select cik, coordinate, cast(value as double) as value from (select *, row_number() over (partition by cik order by coordinate desc) as k from cells) x where k <= 8")
def t4(t: Tables) -> DataFrame:
    return C.latest_periods(t.cells, ["cik"], "coordinate", 8).select("cik", "coordinate", F.col("value").cast("double"))


@query("t2_explore", """select cik, cast(max(case when metric = 'A' then value end) as double) as "A", cast(max(case when metric = 'N' then value end) as double) as "N", cast(max(case when metric = 'R' then value end) as double) as "R" from annual where fiscal_year = 1999 group by cik""")
def t2(t: Tables) -> DataFrame:
    rows = C.explore(t.annual.where("fiscal_year = 1999"), "cik", "metric", "value", ["A", "N", "R"])
    return rows.select("cik", *[F.col(m).cast("double") for m in "ANR"])


@query("j15_compare_peers", "select q.cik as cik, cast(a.value as double) as value, case when a.value is null then 'PERIOD_NOT_PREPARED' end as reason from (values (cast(1 as bigint)), (2), (3), (5), (8), (999999999)) q(cik) left join (select * from annual where metric = 'R' and fiscal_year = 1997) a on q.cik = a.cik")
def j15(t: Tables) -> DataFrame:
    return C.compare_peers(t.annual, [1, 2, 3, 5, 8, 999999999], "R", 1997).select("cik", F.col("value").cast("double"), "reason")


@query(
    "a21_year_options",
    """with c as (select fiscal_year, count(distinct cik) as companies from annual group by 1), d as (select fiscal_year as y from c order by companies = (select count(distinct cik) from annual) desc, case when companies = (select count(distinct cik) from annual) then 0 else companies end desc, fiscal_year desc limit 1)
    select fiscal_year, companies, fiscal_year = (select y from d) as is_default from c""",
)
def a21(t: Tables) -> DataFrame:
    return C.year_options(t.annual, "cik", "fiscal_year")


@query("a26_metric_catalog", "select metric, count(distinct case when value > 50000 then cik end) as companies_available, count(distinct cik) as companies_total, count(distinct case when value > 50000 then fiscal_year end) as periods_available from annual group by metric")
def a26(t: Tables) -> DataFrame:
    return C.metric_catalog(t.annual.withColumn("value", F.when(F.col("value") > 50000, F.col("value"))), "cik", "metric", "fiscal_year", "value")


@query("p10_discover_capability", "select 'Z' as metric, 'NOT_REPORTED' as status, cast(null as bigint) as cik from annual where metric = 'Z' union all select 'Z', 'NOT_REPORTED', null where not exists (select 1 from annual where metric = 'Z')")
def p10(t: Tables) -> DataFrame:
    return C.discover_capability(t.annual, metric="Z").select("metric", "status", "cik")


@query("c29_standard_equivalence", "select part_key, concept, member, count(distinct cik) as companies, case when count(distinct cik) >= 2 then 'EQUIVALENT' else 'UNRESOLVED' end as equivalence from facts group by 1, 2, 3")
def c29(t: Tables) -> DataFrame:
    return C.standard_equivalence(t.facts, "cik", ["part_key", "concept", "member"])


@query(
    "j17_batch_as_of",
    """with b as (select user_id as batch_id, cast(min(ts) as date) + cast(user_id % 28 as integer) as ready_on from events group by user_id),
    c as (select batch_id, ready_on, (select count(*) from sessions where trade_date > ready_on and trade_date <= date '2024-01-25') as n from b where ready_on <= date '2024-01-25'), f as (select * from c where n >= 3)
    select cast(ready_on as varchar) as ready_on, min(batch_id) as batch_id, max(n) as sessions_since, count(*) > 1 as tie from f where ready_on = (select max(ready_on) from f) group by ready_on""",
)
def j17(t: Tables) -> DataFrame:
    batches = t.events.groupBy(F.col("user_id").alias("batch_id")).agg(F.min("ts").cast("date").alias("first")).withColumn("ready_on", F.date_add("first", (F.col("batch_id") % 28).cast("int"))).drop("first")
    return C.batch_as_of(batches, t.sessions, "2024-01-25", 3).select(F.col("ready_on").cast("string"), "batch_id", "sessions_since", "tie")
