"""Queries of the metric and quality operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import metrics as M
from asofworks.plans.registry import Tables, query

ROLES = {"A": "REVENUE", "N": "GROSS_PROFIT", "R": "OPERATING_INCOME"}


#: Each line number and flag of the stand-in's facts stands for one of the 21 reported metrics.
ROLE_SQL = "case concept when 'A' then 0 when 'N' then 1 else 2 end + 3 * (line - 1)"
LIST_SQL = ", ".join(f"({k}, '{r}')" for k, r in enumerate(M.REPORTED))


@query(
    "c13_annual_metrics",
    f"""with c as (select cik, cast(year(filed_date) as bigint) as y, accession, {ROLE_SQL} as k, case when part_key % 13 = 0 then null when discount > 0.08 then -value when discount < 0.01 then 0 else value end as v from facts),
    years as (select distinct cik, y from c), own as (select cik, y, k, count(*) as n, max(v) as v, max(accession) as f from c group by 1, 2, 3),
    g as (select years.cik as cik, years.y as y, m.r as r, own.v as v, own.f as f, case when n is null then 'MISSING_INPUT' when n > 1 then 'MULTIPLE_CANDIDATES' when own.v is null then 'MISSING_INPUT' end as why
      from years cross join (values {LIST_SQL}) m(k, r) left join own on own.cik = years.cik and own.y = years.y and own.k = m.k),
    d1 as (select a.cik as cik, a.y as y, d.name as name, a.v as x, b.v as z, coalesce(a.why, b.why, case when a.f <> b.f then 'SOURCE_FILING_MISMATCH' end) as why from (values ('gross_margin', 'gross_profit', 'revenue'), ('operating_margin', 'operating_income', 'revenue'), ('net_margin', 'net_income', 'revenue'), ('standardized_fcf', 'cfo', 'capex'),
      ('current_ratio', 'current_assets', 'current_liabilities'), ('liabilities_to_equity', 'liabilities', 'equity'), ('liabilities_to_assets', 'liabilities', 'assets'), ('net_debt', 'debt', 'cash')) d(name, p, q) join g a on a.r = d.p join g b on b.r = d.q and a.cik = b.cik and a.y = b.y),
    fcf as (select cik, y, coalesce(why, case when z < 0 then 'CAPEX_SIGN_UNCERTAIN' end) as why, x - z as v from d1 where name = 'standardized_fcf'),
    d2 as (select * from d1 union all select f.cik, f.y, 'fcf_margin', f.v, b.v, coalesce(f.why, b.why, case when c.f <> b.f then 'SOURCE_FILING_MISMATCH' end) from fcf f join g b on b.r = 'revenue' and b.cik = f.cik and b.y = f.y join g c on c.r = 'cfo' and c.cik = f.cik and c.y = f.y
      union all select a.cik, a.y, 'revenue_yoy', a.v, b.v, coalesce(a.why, case when b.cik is null then 'MISSING_INPUT' else b.why end) from g a left join g b on b.r = 'revenue' and b.cik = a.cik and b.y = a.y - 1 where a.r = 'revenue'),
    d3 as (select *, coalesce(why, case when name = 'standardized_fcf' and z < 0 then 'CAPEX_SIGN_UNCERTAIN' when name = 'standardized_fcf' then null when name = 'net_debt' and (x < 0 or z < 0) then 'NEGATIVE_BALANCE_COMPONENT' when name = 'net_debt' then null
      when name in ('revenue_yoy', 'current_ratio', 'liabilities_to_equity', 'liabilities_to_assets') and x < 0 then 'NEGATIVE_NUMERATOR' when name = 'liabilities_to_equity' and z < 0 then 'NEGATIVE_EQUITY' when z <= 0 then 'NON_POSITIVE_DENOMINATOR' end) as reason from d2)
    select cik, y as fiscal_year, r as metric, 'REPORTED' as source_kind, why as reason, case when why is null then cast(v as double) end as value from g
    union all select cik, y, name, 'DERIVED_METRIC', reason, case when reason is null then case when name in ('standardized_fcf', 'net_debt') then cast(x - z as double) when name = 'revenue_yoy' then cast(x - z as double) / cast(z as double) * 100 else cast(x as double) / cast(z as double) * 100 end end from d3""",
)
def c13(t: Tables) -> DataFrame:
    value = F.when(F.col("part_key") % 13 == 0, None).when(F.col("discount") > 0.08, -F.col("value")).when(F.col("discount") < 0.01, 0).otherwise(F.col("value"))
    number = F.when(F.col("concept") == "A", 0).when(F.col("concept") == "N", 1).otherwise(2) + 3 * (F.col("line") - 1)
    role = F.element_at(F.array(*[F.lit(r) for r in M.REPORTED]), (number + 1).cast("int"))
    cells = t.facts.select("cik", F.year("filed_date").cast("long").alias("fiscal_year"), "accession", role.alias("role"), value.cast("decimal(18,2)").alias("value"))
    return M.annual_metrics(cells, "cik", "fiscal_year", "role", filing="accession").select("cik", "fiscal_year", "metric", "source_kind", "reason", "value")


@query(
    "c10_metric_inputs",
    """with n as (select cik, fiscal_year, count(*) filter (where metric = 'A') as a, count(*) filter (where metric = 'N') as g from annual group by 1, 2)
    select cik, fiscal_year, concat_ws(',', case when a = 0 then 'MISSING_REVENUE' end, case when g = 0 then 'MISSING_GROSS_PROFIT' end, case when a > 1 then 'AMBIGUOUS_REVENUE' end, case when g > 1 then 'AMBIGUOUS_GROSS_PROFIT' end) as diagnostics from n""",
)
def c10(t: Tables) -> DataFrame:
    from asofworks.operators.periods import assign_roles

    rows = M.metric_inputs(assign_roles(t.annual, ROLES, "metric"), ["cik", "fiscal_year"], "role", ["REVENUE", "GROSS_PROFIT"])
    return rows.select("cik", "fiscal_year", F.array_join("diagnostics", ",").alias("diagnostics"))


@query(
    "c34_apply_quality",
    """with d as (select user_id as cik, string_agg(distinct case when event_type = 'error' then 'BLOCK' else 'WARN' end, ',') as k from events where event_type in ('error', 'signup') and value > 30 group by 1)
    select case when contains(k, 'BLOCK') then 'BLOCK' when contains(k, 'WARN') then 'WARN' else 'CLEAR' end as quality, count(*) as n, cast(sum(value) as double) as raw, cast(sum(case when k is null or not contains(k, 'BLOCK') then value end) as double) as analytical from cells left join d on cells.cik = d.cik group by 1""",
)
def c34(t: Tables) -> DataFrame:
    decisions = t.events.where("event_type in ('error', 'signup') and value > 30").select(F.col("user_id").alias("cik"), F.when(F.col("event_type") == "error", "BLOCK").otherwise("WARN").alias("decision"))
    rows = M.apply_quality(t.cells, decisions, ["cik"])
    return rows.groupBy("quality").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("raw"), F.sum("analytical_value").cast("double").alias("analytical"))


@query(
    "c35_trace",
    "select f.cik as cik, year(f.filed_date) * 4 + quarter(f.filed_date) as coordinate, f.accession as accession, cast(l.fact_id as varchar) as fact_id, cast(l.value as double) as fact_value from filings f left join facts l on f.accession = l.accession",
)
def c35(t: Tables) -> DataFrame:
    cells = t.filings.groupBy("cik", (F.year("filed_date") * 4 + F.quarter("filed_date")).cast("long").alias("coordinate")).agg(F.array_sort(F.collect_list("accession")).alias("lineage"))
    facts = t.facts.select("accession", "fact_id", F.col("value").cast("double").alias("fact_value"))
    rows = M.trace(cells, "lineage", facts, "accession", t.filings.select("accession", "form"), "accession")
    return rows.select("cik", "coordinate", "accession", F.col("fact_id").cast("string"), "fact_value")


@query(
    "c36_fiscal_focus_overlay",
    """with c as (select accession, case when accession % 3 = 0 then 'O' else 'F' end as old_status, 'X' as new_status from filings where accession % 7 = 0)
    select case when c.accession is not null and f.status = c.old_status then 'X' else f.status end as status, coalesce(f.status = c.old_status, false) as corrected, count(*) as n from filings f left join c on f.accession = c.accession group by 1, 2""",
)
def c36(t: Tables) -> DataFrame:
    old = F.when(F.col("accession") % 3 == 0, "O").otherwise("F")
    corrections = t.filings.where("accession % 7 = 0").select("accession", old.alias("old_status"), F.lit("X").alias("new_status"))
    rows, _ = M.fiscal_focus_overlay(t.filings, corrections, "accession", ["status"])
    return rows.groupBy("status", "corrected").agg(F.count("*").alias("n"))


@query(
    "j16_source_equations",
    """with s as (select accession, sum(value) as v from facts where concept <> 'A' group by 1), p as (select accession, sum(value) as v from facts where accession % 4 > 0 group by 1)
    select case when p.v is null then 'MISSING_PARENT' when abs(s.v - p.v) <= 1 then 'MATCH' else 'MISMATCH' end as status, count(*) as n, cast(sum(s.v) as double) as calculated from s left join p on s.accession = p.accession group by 1""",
)
def j16(t: Tables) -> DataFrame:
    inputs = t.facts.where("concept <> 'A'").select("accession", F.lit(1).alias("weight"), "value")
    totals = t.facts.where("accession % 4 > 0").groupBy("accession").agg(F.sum("value").alias("value"))
    return M.source_equations(inputs, totals, "accession", 1).groupBy("status").agg(F.count("*").alias("n"), F.sum("calculated").cast("double").alias("calculated"))


@query(
    "j10_bind_recast",
    """with e as (select cik, concept, accession, min(filed_date) as d from facts group by 1, 2, 3), f as (select *, row_number() over () as place from facts),
    r as (select f.fact_id as fact_id, f.accession as accession, f.place as place, count(e.accession) as n, arg_max(e.accession, (e.d, e.accession)) as p from f left join e on f.cik = e.cik and f.concept = e.concept and e.d < f.filed_date group by 1, 2, 3)
    select fact_id, accession, n as priors, cast(p as varchar) as prior, case when n > 0 then 'RECAST' else 'NO_PRIOR_FILING' end as basis from r""",
)
def j10(t: Tables) -> DataFrame:
    return M.bind_recast(t.facts, t.facts, ["cik", "concept"], t.parts()).select("fact_id", "accession", "priors", F.col("prior").cast("string"), "basis")


@query(
    "a13_financial_anchor",
    """with k as (select * from filings where filed_date <= date '1999-12-31'), l as (select cik, max(report_date) as anchor from k group by cik)
    select k.cik as cik, cast(anchor as varchar) as anchor, cast(anchor + 1 as varchar) as exclusive_end, string_agg(cast(accession as varchar), ',' order by accession) as accessions from k join l on k.cik = l.cik and k.report_date = l.anchor group by k.cik, anchor""",
)
def a13(t: Tables) -> DataFrame:
    rows = M.financial_anchor(t.filings, "1999-12-31")
    return rows.select("cik", F.col("anchor").cast("string"), F.col("exclusive_end").cast("string"), F.array_join("accessions", ",").alias("accessions"))


@query(
    "a12_four_quarters",
    """with k as (select cik, coordinate, case when source_id % 7 > 0 then value end as value, row_number() over (partition by cik order by coordinate desc) as k from cells where coordinate <= 8000),
    g as (select cik, count(*) as quarters, max(coordinate) - min(coordinate) as s, sum(value) as v, count(value) as h, max(coordinate) as last_quarter from k where k <= 4 group by cik),
    r as (select *, case when quarters < 4 then 'MISSING' when s <> 3 then 'QUARTER_GAP' when h < 4 then 'INPUT_UNAVAILABLE' end as reason from g)
    select cik, quarters, last_quarter, reason, case when reason is null then cast(v as double) end as total from r""",
)
def a12(t: Tables) -> DataFrame:
    cells = t.cells.withColumn("value", F.when(F.col("source_id") % 7 > 0, F.col("value")))
    return M.four_quarters(cells, ["cik"], "coordinate", 8000).select("cik", "quarters", "last_quarter", "reason", F.col("total").cast("double"))


@query(
    "c30_comparison_panel",
    """with s as (select * from annual where cik in (2, 4, 5, 7)), n as (select fiscal_year, metric, count(distinct cik) as companies from s group by 1, 2)
    select s.cik as cik, s.fiscal_year as fiscal_year, s.metric as metric, companies, case when companies >= 2 then 'EQUIVALENT' else 'UNRESOLVED' end as relation from s join n on s.fiscal_year = n.fiscal_year and s.metric = n.metric""",
)
def c30(t: Tables) -> DataFrame:
    return M.comparison_panel(t.annual, [2, 4, 5, 7], ["fiscal_year", "metric"]).select("cik", "fiscal_year", "metric", "companies", "relation")
