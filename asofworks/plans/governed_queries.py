"""Queries of the governed operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.functions import scalars as S
from asofworks.operators import governed as V
from asofworks.operators import setops as U
from asofworks.plans.quarter_queries import CLASSED_SQL, GROWTH_SQL, classed
from asofworks.plans.registry import Tables, query

#: A raw layer made of facts: each nation's customers share a filing; some references are missing, lack a filing or are of another one.
RAW_SQL = """raw as (select case when fact_id % 97 = 0 then null else fact_id end as fact_id, cik % 25 as filing_id, (cik % 25) * 1000 + part_key % 200 as raw_concept_id, (cik % 25) * 10 + line as context_id, case when concept = 'R' then null else (cik % 25) * 100 + unit_key % 50 end as unit_id, value, part_key, line, filed_date from facts),
    ok_filings as (select distinct filing_id from raw where filing_id <> 24),
    concepts as (select raw_concept_id, case when k % 11 = 0 then null when k % 13 = 0 then filing_id + 1 else filing_id end as filing_id from (select distinct filing_id, raw_concept_id, raw_concept_id % 1000 as k from raw) x where k % 9 > 0),
    contexts as (select context_id, case when k = 6 then filing_id + 1 else filing_id end as filing_id, 'D' || k as period from (select distinct filing_id, context_id, context_id % 10 as k from raw) x where k <> 7),
    units as (select unit_id, case when k % 21 = 0 then null else filing_id end as filing_id from (select distinct filing_id, unit_id, unit_id % 100 as k from raw where unit_id is not null) x where k % 8 > 0),
    dims as (select fact_id, filing_id * 1000 + (part_key + 1) % 200 as axis, case when line = 2 then filing_id * 1000 + (part_key + 2) % 200 end as member from raw where line in (2, 3) and fact_id is not null),
    dim as (select d.fact_id as fact_id, bool_or(a.raw_concept_id is null or (d.member is not null and m.raw_concept_id is null)) as o, bool_or((a.raw_concept_id is not null and a.filing_id is null) or (m.raw_concept_id is not null and m.filing_id is null)) as l,
      bool_or(a.filing_id <> d.axis // 1000) or bool_or(m.filing_id <> d.axis // 1000) as x from dims d left join concepts a on a.raw_concept_id = d.axis left join concepts m on m.raw_concept_id = d.member group by d.fact_id),
    observed as (select r.*, x.period as period, concat_ws(',', case when r.fact_id is null then 'MISSING_FACT_ID' end, case when g.filing_id is null then 'FACT_FILING_MISMATCH' end,
      case when c.raw_concept_id is null then 'MISSING_OR_UNRESOLVED_CONCEPT' when c.filing_id is null then 'MISSING_CONCEPT_REFERENCE_FILING_ID' when c.filing_id <> r.filing_id then 'CROSS_FILING_CONCEPT_REFERENCE' end,
      case when x.context_id is null then 'MISSING_OR_UNRESOLVED_CONTEXT' when x.filing_id <> r.filing_id then 'CROSS_FILING_CONTEXT_REFERENCE' end,
      case when r.unit_id is not null and u.unit_id is null then 'MISSING_OR_UNRESOLVED_UNIT' when u.unit_id is not null and u.filing_id is null then 'MISSING_UNIT_REFERENCE_FILING_ID' end,
      case when dim.o then 'MISSING_OR_UNRESOLVED_DIMENSION' end, case when dim.l then 'MISSING_DIMENSION_REFERENCE_FILING_ID' end, case when dim.x then 'CROSS_FILING_DIMENSION_REFERENCE' end) as reasons
      from raw r left join ok_filings g on g.filing_id = r.filing_id left join concepts c on c.raw_concept_id = r.raw_concept_id left join contexts x on x.context_id = r.context_id left join units u on u.unit_id = r.unit_id left join dim on dim.fact_id = r.fact_id)"""


def observed(t: Tables) -> DataFrame:
    nation = F.col("cik") % 25
    raw = t.facts.select(
        F.when(F.col("fact_id") % 97 != 0, F.col("fact_id")).alias("fact_id"), nation.alias("filing_id"), (nation * 1000 + F.col("part_key") % 200).alias("raw_concept_id"), (nation * 10 + F.col("line")).alias("context_id"),
        F.when(F.col("concept") != "R", nation * 100 + F.col("unit_key") % 50).alias("unit_id"), "value", "part_key", "line", "filed_date",
    )
    ids = lambda c, size: raw.where(F.col(c).isNotNull()).select("filing_id", c).distinct().withColumn("k", F.col(c) % size)
    concepts = ids("raw_concept_id", 1000).where("k % 9 > 0").select("raw_concept_id", F.when(F.col("k") % 11 == 0, None).when(F.col("k") % 13 == 0, F.col("filing_id") + 1).otherwise(F.col("filing_id")).alias("filing_id"))
    contexts = ids("context_id", 10).where("k <> 7").select("context_id", F.when(F.col("k") == 6, F.col("filing_id") + 1).otherwise(F.col("filing_id")).alias("filing_id"), F.concat(F.lit("D"), "k").alias("period"))
    units = ids("unit_id", 100).where("k % 8 > 0").select("unit_id", F.when(F.col("k") % 21 != 0, F.col("filing_id")).alias("filing_id"))
    dims = raw.where("line in (2, 3) and fact_id is not null").select(
        "fact_id", (F.col("filing_id") * 1000 + (F.col("part_key") + 1) % 200).alias("axis_raw_concept_id"), F.when(F.col("line") == 2, F.col("filing_id") * 1000 + (F.col("part_key") + 2) % 200).alias("member_raw_concept_id")
    )
    return V.period_observations(raw, raw.select("filing_id").where("filing_id <> 24"), concepts, contexts, units, dims)


@query("p14_j1_observations", f"with {RAW_SQL} select cast(fact_id as varchar) as fact_id, raw_concept_id, context_id, period, reasons, case when reasons = '' then null else split_part(reasons, ',', 1) end as unavailable_reason from observed")
def j1(t: Tables) -> DataFrame:
    return observed(t).select(F.col("fact_id").cast("string"), "raw_concept_id", "context_id", "period", F.array_join("reasons", ",").alias("reasons"), "unavailable_reason")


@query(
    "c1_versioned_panel",
    f"""with {RAW_SQL}, m as (select p_partkey as raw_id, 'canon-' || p_brand as canonical_id, p_size % 3 > 0 as reviewed from part where p_size % 5 > 0),
    r as (select fact_id, context_id, filed_date, case when m.canonical_id is not null and reviewed then m.canonical_id when m.canonical_id is null then 'raw-unmapped:' || part_key else 'raw-review:' || part_key end as canonical_id, case when m.canonical_id is not null and reviewed then 'MAPPED' else 'REVIEW_REQUIRED' end as mapping_status
      from observed left join m on m.raw_id = part_key where reasons = '')
    select fact_id, canonical_id, mapping_status, row_number() over (partition by canonical_id, context_id order by filed_date, fact_id) as version, count(*) over (partition by canonical_id, context_id) as versions from r""",
)
def c1(t: Tables) -> DataFrame:
    mapping = t.part.where("p_size % 5 > 0").selectExpr("p_partkey as raw_id", "concat('canon-', p_brand) as canonical_id", "p_size % 3 > 0 as reviewed")
    rows = V.versioned_panel(observed(t), mapping, "part_key", ["context_id"])
    return rows.select("fact_id", "canonical_id", "mapping_status", F.col("version").cast("long"), "versions")


@query(
    "c8_revenue_q4",
    f"""with {CLASSED_SQL.replace("select cik, concept,", "select cik, concept, member, line,")}, o as (select c.*, cast(year(c.start_date) as bigint) as fiscal_year, line = 2 and fact_id % 19 = 0 as review_required, fact_id % 23 = 0 as held, fact_id % 29 > 0 as qualified from c
      where c.period_class in ('FY', 'YTD_9M') and c.filed_date <= date '1999-12-31'),
    g as (select cik, member, fiscal_year, bool_or(review_required) as r, bool_or(held) as h, bool_or(not qualified) as q, bool_or(not case when period_class = 'FY' then datediff('day', start_date, end_date) between 350 and 378 else datediff('day', start_date, end_date) between 255 and 290 end) as d,
      count(*) filter (where period_class = 'FY') as fy, count(*) filter (where period_class <> 'FY') as nm, max(concept) filter (where period_class = 'FY') as c1, max(concept) filter (where period_class <> 'FY') as c2, max(value) filter (where period_class = 'FY') as v1, max(value) filter (where period_class <> 'FY') as v2,
      max(start_date) filter (where period_class = 'FY') as s1, max(start_date) filter (where period_class <> 'FY') as s2, max(end_date) filter (where period_class = 'FY') as e1, max(end_date) filter (where period_class <> 'FY') as e2 from o group by 1, 2, 3),
    w as (select *, case when r then 'Q4_MAPPING_REVIEW_REQUIRED' when h then 'Q4_INPUT_QUALITY_OR_CONTINUITY_HELD' when q then 'Q4_INPUT_NOT_QUALIFIED' when d then 'Q4_INPUT_PERIOD_NOT_QUALIFIED' when fy = 0 then 'Q4_MISSING_ANNUAL_INPUT' when nm = 0 then 'Q4_MISSING_YTD9_INPUT' when fy > 1 or nm > 1 then 'Q4_AMBIGUOUS_INPUTS'
      when c1 <> c2 then 'Q4_INPUT_CONCEPT_MISMATCH' when s1 <> s2 or datediff('day', e2, e1) not between 75 and 105 then 'Q4_INPUT_SCOPE_OR_PERIOD_MISMATCH' end as reason from g)
    select cik, member, fiscal_year, fy + nm as inputs, reason, case when reason is null then cast(v1 - v2 as double) end as value from w""",
)
def c8(t: Tables) -> DataFrame:
    rows = classed(t).withColumn("fiscal_year", F.year("start_date").cast("long"))
    rows = rows.withColumn("review_required", (F.col("line") == 2) & (F.col("fact_id") % 19 == 0)).withColumn("held", F.col("fact_id") % 23 == 0).withColumn("qualified", F.col("fact_id") % 29 > 0)
    return V.revenue_q4(rows, ["cik", "member"], "1999-12-31").select("cik", "member", "fiscal_year", "inputs", "reason", F.col("value").cast("double"))


@query(
    "a10_eps_ttm_direct",
    """with o as (select cik, source_id as observation_id, coordinate, case when n_sources > 4 then 'b' else 'a' end as scope, source_id % 11 > 0 as eligible, value, make_date(fiscal_year, (fiscal_quarter - 1) * 3 + 1, 1) as s, cast(make_date(fiscal_year, (fiscal_quarter - 1) * 3 + 1, 1) + interval 3 month as date) as e from cells),
    d as (select cik, list(source_id order by coordinate desc) as all_ids, count(*) as cells from cells group by cik),
    n as (select d.cik as cik, d.cik % 7 > 0 as confirmed, date '2001-06-01' + cast(d.cik % 900 as integer) as available_on, unnest(case when d.cik % 5 = 0 then list_slice(all_ids, 2, 5) when d.cik % 6 = 0 then list_slice(all_ids, 1, 3) else list_slice(all_ids, 1, 4) end) as id from d),
    j as (select n.*, o.*, o.cik as ocik, lag(o.coordinate) over w as pc, lag(o.e) over w as pe from n left join o on o.observation_id = n.id window w as (partition by n.cik order by o.e, o.observation_id)),
    l as (select cik, max(e) as latest from o where eligible group by cik),
    g as (select n_cik as cik, bool_and(confirmed) as confirmed, max(available_on) as available_on, count(*) as k, count(*) filter (where eligible and e <= date '2002-12-31') as good, count(distinct scope) as scopes, max(e) as last, bool_or(pc is not null and coordinate <> pc + 1) as gap, bool_and(datediff('day', s, e) between 75 and 105) as fit, bool_or(pe is not null and pe <> s) as apart, sum(value) as v
      from (select j.*, j.ocik as n_cik from j) x group by 1),
    r as (select g.*, case when not confirmed then 'CLASS_OR_BASIS_NOT_CONFIRMED' when available_on > date '2002-12-31' then 'BASIS_EVIDENCE_AFTER_CUTOFF' when k <> 4 then 'FOUR_DIRECT_QUARTERS_REQUIRED' when good <> 4 then 'FOUR_DIRECT_QUARTERS_REQUIRED' when last <> latest then 'LATEST_DIRECT_QUARTERS_NOT_PREPARED' when scopes <> 1 then 'SCOPE_OR_UNIT_NOT_COMPATIBLE'
      when gap then 'QUARTER_GAP_OR_DUPLICATE' when not fit then 'ACTUAL_PERIOD_NOT_CONFIRMED' when apart then 'QUARTER_GAP_OR_DUPLICATE' end as reason from g left join l on l.cik = g.cik)
    select cik, reason, case when reason is null then cast(v as double) end as value from r""",
)
def a10(t: Tables) -> DataFrame:
    start = F.make_date(F.col("fiscal_year").cast("int"), ((F.col("fiscal_quarter") - 1) * 3 + 1).cast("int"), F.lit(1))
    o = t.cells.select(
        "cik", F.col("source_id").alias("observation_id"), "coordinate", F.when(F.col("n_sources") > 4, "b").otherwise("a").alias("scope"), (F.col("source_id") % 11 > 0).alias("eligible"), "value", start.alias("start_date"), F.add_months(start, 3).alias("end_date")
    ).withColumn("filed_date", F.col("end_date"))
    ids = F.transform(F.sort_array(F.collect_list(F.struct("coordinate", "source_id")), asc=False), lambda x: x["source_id"])
    d = t.cells.groupBy("cik").agg(ids.alias("ids"))
    chosen = F.when(F.col("cik") % 5 == 0, F.slice("ids", 2, 4)).when(F.col("cik") % 6 == 0, F.slice("ids", 1, 3)).otherwise(F.slice("ids", 1, 4))
    d = d.select(F.col("cik").alias("declaration_id"), "cik", (F.col("cik") % 7 > 0).alias("confirmed"), F.date_add(F.lit("2001-06-01").cast("date"), (F.col("cik") % 900).cast("int")).alias("available_on"), chosen.alias("observation_ids")).where(F.size("observation_ids") > 0)
    return V.eps_ttm_direct(o, d, "2002-12-31").select("cik", "reason", F.col("value").cast("double"))


@query(
    "c33_change_table",
    f"""with q as (select cik, coordinate, value, case when cik % 3 = 0 then 'PERCENT' else 'MONEY' end as kind, n_sources % 2 as sig from cells), j as (select q.cik as cik, q.coordinate as coordinate, q.kind as kind, q.value as v, p.value as p, q.sig as a, p.sig as b from q left join q p on p.cik = q.cik and p.coordinate = q.coordinate - 4),
    s as (select *, case when v is null then 'INPUT_UNAVAILABLE' when p is null then 'PREDECESSOR_MISSING' when a is distinct from b then 'SIGNATURE_MISMATCH' when kind = 'PERCENT' then 'PERCENTAGE_POINTS' else {GROWTH_SQL} end as status from j)
    select cik, coordinate, kind, status, case when status not in ('PREDECESSOR_MISSING', 'SIGNATURE_MISMATCH') and kind = 'MONEY' and p > 0 and v >= 0 then cast(v - p as double) / cast(p as double) * 100 end as rate, case when status = 'PERCENTAGE_POINTS' then cast(v - p as double) end as points from s""",
)
def c33(t: Tables) -> DataFrame:
    cells = t.cells.select("cik", "coordinate", "value", F.when(F.col("cik") % 3 == 0, "PERCENT").otherwise("MONEY").alias("kind"), (F.col("n_sources") % 2).alias("sig"))
    return V.change_table(cells, ["cik"], "coordinate", 4, "kind", "sig").select("cik", "coordinate", "kind", "status", "rate", F.col("points").cast("double"))


@query(
    "u6_add_metric",
    """select cik, fiscal_year, metric, cast(value as double) as value, cast(null as varchar) as reason from annual
    union all select g.cik, g.fiscal_year, 'TOTAL', cast(s.v as double), case when s.v is null then 'NOT_APPROVED' end from (select distinct cik, fiscal_year from annual) g left join (select cik, fiscal_year, sum(value) as v from annual group by 1, 2 having count(*) = 3) s on s.cik = g.cik and s.fiscal_year = g.fiscal_year""",
)
def u6(t: Tables) -> DataFrame:
    parent = t.annual.select("cik", "fiscal_year", "metric", F.col("value").cast("decimal(38,2)").alias("value"), F.lit(None).cast("string").alias("reason"))
    total = t.annual.groupBy("cik", "fiscal_year").agg(F.sum("value").cast("decimal(38,2)").alias("value"), F.count("*").alias("n")).where("n = 3")
    rows = V.add_metric(parent, t.annual.select("cik", "fiscal_year"), total, "TOTAL", ["cik", "fiscal_year"], "NOT_APPROVED")
    return rows.select("cik", "fiscal_year", "metric", F.col("value").cast("double"), "reason")


SCREENED_SQL = """o as (select a.cik as cik, max(case when metric = 'A' then value end) as a, max(case when metric = 'N' then value end) as n from annual a join chosen y on y.cik = a.cik and y.fiscal_year = a.fiscal_year group by 1),
    s as (select c.cik as cik, case when a > 60000 then 'PASS' when a is null then 'UNDETERMINED' else 'FAIL' end as x, case when n <= 200000 then 'PASS' when n is null then 'UNDETERMINED' else 'FAIL' end as y from companies c left join o on o.cik = c.cik)
    select cik, case when x = 'FAIL' or y = 'FAIL' then 'FAIL' when x = 'PASS' and y = 'PASS' then 'PASS' else 'UNDETERMINED' end as result, concat_ws(',', case when x = 'UNDETERMINED' then 'A' end, case when y = 'UNDETERMINED' then 'N' end) as undetermined from s"""
POLICIES = {
    "fixed_year": ("FIXED_FISCAL_YEAR", {"fiscal_year": 1998}, "select distinct cik, fiscal_year from annual where fiscal_year = 1998"),
    "latest_period": ("LATEST_COMPANY_PERIOD", {}, "select cik, max(fiscal_year) as fiscal_year from annual group by cik"),
    "complete_annual": ("LATEST_COMPLETE_ANNUAL", {"offset": 1}, "select cik, fiscal_year from (select cik, fiscal_year, row_number() over (partition by cik order by fiscal_year desc) as k from annual where metric in ('A', 'N') group by cik, fiscal_year having count(distinct metric) = 2) z where k = 2"),
}
for name, (policy, given, chosen) in POLICIES.items():

    @query(f"c22_screen_{name}", f"with chosen as ({chosen}), {SCREENED_SQL}")
    def c22(t: Tables, policy: str = policy, given: dict[str, int] = given) -> DataFrame:
        rows = V.at_period(t.annual, policy, ["A", "N"], **given)
        return V.screen_universe(t.companies, rows, [("A", "GT", 60000), ("N", "LTE", 200000)]).select("cik", "result", F.array_join("undetermined", ",").alias("undetermined"))


@query(
    "c23_screen_prices",
    """with u as (select distinct security_id as cik from prices), p as (select security_id as cik, close from prices where trade_date = date '2024-01-15')
    select u.cik as cik, case when close is null then 'UNDETERMINED' when close > 40 and close < 60 then 'PASS' else 'FAIL' end as result, case when close is null then 'per,pbr' else '' end as undetermined from u left join p on p.cik = u.cik""",
)
def c23(t: Tables) -> DataFrame:
    values = t.prices.select(F.col("security_id").alias("cik"), "trade_date", F.explode(F.array(F.lit("per"), F.lit("pbr"))).alias("metric"), F.col("close").alias("value"))
    rows = V.screen_prices(t.prices.select(F.col("security_id").alias("cik")).distinct(), values, [("per", "GT", 40), ("pbr", "LT", 60)], "2024-01-15")
    return rows.select("cik", "result", F.array_join("undetermined", ",").alias("undetermined"))


@query(
    "u7_compare_views",
    """with a as (select cik, form, arg_min(amount, (filed_date, accession)) as v from filings where filed_date <= date '1999-06-30' group by 1, 2), b as (select cik, form, arg_max(amount, (filed_date, accession)) as v from filings group by 1, 2)
    select coalesce(a.cik, b.cik) as cik, coalesce(a.form, b.form) as form, case when a.cik is null then 'ADDED' when b.cik is null then 'REMOVED' when a.v is distinct from b.v then 'CHANGED' else 'EQUAL' end as change, cast(a.v as double) as as_filed, cast(b.v as double) as latest from a full outer join b on a.cik = b.cik and a.form = b.form""",
)
def u7(t: Tables) -> DataFrame:
    pick = lambda f, rows: rows.groupBy("cik", "form").agg(f("amount", F.struct("filed_date", "accession")).alias("v"))
    rows = U.compare_runs(pick(F.min_by, t.filings.where("filed_date <= '1999-06-30'")), pick(F.max_by, t.filings), ["cik", "form"], ["v"])
    return rows.select("cik", "form", "change", F.col("old.v").cast("double").alias("as_filed"), F.col("new.v").cast("double").alias("latest"))


@query(
    "f7_f6_growth",
    f"""with g as (select fact_id, case when line % 3 = 0 then -value when line % 7 = 0 then 0 else value end as v, case when part_key % 5 = 0 then 0 when part_key % 3 = 0 then -value - 1 else quantity end as p from facts)
    select fact_id, {GROWTH_SQL} as status, case when p > 0 and v >= 0 then cast(v - p as double) / cast(p as double) * 100 end as rate, case when p < 0 and v < 0 then cast(abs(v) - abs(p) as double) / cast(abs(p) as double) * 100 end as magnitude_change, cast(v - p as double) as delta from g""",
)
def f7(t: Tables) -> DataFrame:
    v = F.when(F.col("line") % 3 == 0, -F.col("value")).when(F.col("line") % 7 == 0, 0).otherwise(F.col("value")).cast("decimal(18,2)")
    p = F.when(F.col("part_key") % 5 == 0, 0).when(F.col("part_key") % 3 == 0, -F.col("value") - 1).otherwise(F.col("quantity")).cast("decimal(18,2)")
    rows = t.facts.select("fact_id", v.alias("v"), p.alias("p")).withColumn("g", S.growth("v", "p"))
    return rows.select("fact_id", "g.status", "g.rate", "g.magnitude_change", F.col("g.delta").cast("double").alias("delta"))


@query(
    "f2_f8_f15_f16_f1_scalars",
    """with o as (select o_orderkey, cast(o_orderdate as date) as d from orders)
    select o_orderkey as id, cast(month(d) as bigint) as fye_month, cast(day(d) as bigint) as fye_day, cast(year(d - 1) as bigint) as calendar_year, cast(quarter(d - 1) as bigint) as calendar_quarter, cast(cast(date_trunc('quarter', d) - interval 6 month as date) as varchar) as spine_first,
      cast(91 as double) as days, cast(3 as double) as months, case when o_orderkey % 3 = 0 then 'iso4217:USD' else 'iso4217:USD|xbrli:shares' end as measures, o_orderkey % 3 = 0 as currency, 'id-' || substr(sha256('{"d":"' || cast(d as varchar) || '","o_orderkey":' || o_orderkey || '}'), 1, 24) as stable from o""",
)
def scalars(t: Tables) -> DataFrame:
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    text = F.when(F.col("o_orderkey") % 4 == 0, F.date_format("d", "--MM-dd")).when(F.col("o_orderkey") % 4 == 1, F.date_format("d", "M/d")).when(F.col("o_orderkey") % 4 == 2, F.date_format("d", "MM-dd")).otherwise(F.col("d").cast("string"))
    unit = F.when(F.col("o_orderkey") % 3 == 0, "iso4217:USD").when(F.col("o_orderkey") % 3 == 1, '["xbrli:shares", "iso4217:USD"]').otherwise("xbrli:shares  iso4217:USD")
    rows = rows.withColumn("f", S.fiscal_year_end(text)).withColumn("q", S.calendar_quarter("d")).withColumn("m", S.parse_measures(unit)).withColumn("first", F.trunc("d", "quarter"))
    return rows.select(
        F.col("o_orderkey").alias("id"), F.col("f.month").cast("long").alias("fye_month"), F.col("f.day").cast("long").alias("fye_day"), F.col("q.year").cast("long").alias("calendar_year"), F.col("q.quarter").cast("long").alias("calendar_quarter"),
        F.get(S.quarter_spine("d", 2), F.lit(0)).cast("string").alias("spine_first"), S.share_weight("d", F.date_add("d", 91), "DAY").alias("days"), S.share_weight("first", F.add_months("first", 3), "MONTH").alias("months"),
        F.array_join("m", "|").alias("measures"), S.is_currency("m").alias("currency"), S.stable_id("id-", "o_orderkey", "d").alias("stable"),
    )
