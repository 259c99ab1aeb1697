"""Queries of the panel operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import graph as G
from asofworks.operators import panels as N
from asofworks.plans.registry import Tables, query


@query("p9_fact_series", "select fact_id, cast(end_date as varchar) as end_date, cast(value as double) as value from facts where concept = 'A' and member = 'O' and end_date between date '1997-01-01' and date '1998-12-31'")
def p9(t: Tables) -> DataFrame:
    return N.fact_series(t.facts, "1997-01-01", "1998-12-31", concept="A", member="O").select("fact_id", F.col("end_date").cast("string"), F.col("value").cast("double"))


@query("p11_discover_metrics", "select cik, metric, count(*) as records, string_agg(distinct cast(fiscal_year as varchar), ',' order by cast(fiscal_year as varchar)) as periods from annual group by 1, 2")
def p11(t: Tables) -> DataFrame:
    return N.discover_metrics(t.annual, ["cik", "metric"], "fiscal_year").select("cik", "metric", "records", F.array_join("periods", ",").alias("periods"))


@query(
    "w13_metric_revisions",
    "with r as (select *, row_number() over (partition by cik, form order by filed_date desc, accession desc) as k, count(*) over (partition by cik, form) as revisions from filings where filed_date <= date '1999-06-30') select cik, form, accession, cast(amount as double) as amount, revisions from r where k = 1",
)
def w13(t: Tables) -> DataFrame:
    return N.metric_revisions(t.filings, ["cik", "form"], "1999-06-30", "LATEST").select("cik", "form", "accession", F.col("amount").cast("double"), "revisions")


@query(
    "g5_anchor_evidence",
    """with e as (select parent, child, case when parent like 'R%' then 'PRIMARY' else 'DIMENSION' end as kind, case when ordinal % 2 = 0 then 'even' else 'odd' end as role from edges), a as (select * from e where parent = 'R0' and kind = 'PRIMARY')
    select 'R0' as root, 'R0' as node, 'START' as state, null as role, 0::bigint as depth union all select 'R0', child, 'HYPERCUBE', role, 1 from a union all select 'R0', e.child, 'MEMBER', e.role, 2 from a join e on e.parent = a.child and e.role = a.role and e.kind = 'DIMENSION'""",
)
def g5(t: Tables) -> DataFrame:
    kind = F.when(F.col("parent").startswith("R"), "PRIMARY").otherwise("DIMENSION")
    edges = t.edges.select("parent", "child", kind.alias("kind"), F.when(F.col("ordinal") % 2 == 0, "even").otherwise("odd").alias("role"), F.lit(None).cast("string").alias("target_role"))
    transitions = t.spark.createDataFrame([("START", "PRIMARY", "HYPERCUBE"), ("HYPERCUBE", "DIMENSION", "MEMBER")], "state string, kind string, next_state string")
    return N.state_walk(edges, transitions, ["R0"], "START", 4).select("root", "node", "state", "role", F.col("depth").cast("long"))


@query(
    "g8_statement_discovery",
    "with f as (select 'C' || cik as child, count(*) as n from filings group by 1) select 'N' || n_nationkey as anchor, count(*) as children, count(f.n) as reported, cast(coalesce(sum(f.n), 0) as bigint) as facts from nation join edges on parent = 'N' || n_nationkey left join f on f.child = edges.child group by 1",
)
def g8(t: Tables) -> DataFrame:
    anchors = t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("anchor"))
    facts = t.filings.select(F.concat(F.lit("C"), "cik").alias("node"))
    return N.statement_discovery(t.edges, facts, anchors, "node")


@query("g9_hierarchy_catalog", "select parent, count(*) as children, arg_min(child, (ordinal, child)) as first_child from edges group by parent")
def g9(t: Tables) -> DataFrame:
    return N.hierarchy_catalog(t.edges)


@query(
    "c25_company_panel",
    "select s.accession as accession, case when m.c_nationkey is null then 'NOT_IN_GRAPH' else 'PLACED' end as panel_status from (select accession, cik from filings) s left join (select c_custkey, c_nationkey from customer join nation on c_nationkey = n_nationkey where n_regionkey < 2) m on s.cik = m.c_custkey",
)
def c25(t: Tables) -> DataFrame:
    nodes = G.simple_paths(t.edges, ["R0", "R1"], 2)
    selected = t.filings.select("accession", F.concat(F.lit("C"), "cik").alias("place"))
    return N.company_panel(selected, nodes, "place").select("accession", "panel_status")


@query(
    "c26_fiscal_series",
    """with n as (select cik, concept, member, line, year(end_date) as y, count(distinct value) as k, min(value) as v from facts group by 1, 2, 3, 4, 5), g as (select distinct cik, concept, member, line, e.y as y from facts cross join (values (1997), (1998), (1999)) e(y))
    select g.cik as cik, g.concept as concept, g.member as member, cast(g.line as bigint) as line, cast(g.y as bigint) as fiscal_year, case when k is null then 'PERIOD_MISSING' when k > 1 then 'CONFLICT' else 'AVAILABLE' end as cell_status, case when k = 1 then cast(v as double) end as value from g left join n on g.cik = n.cik and g.concept = n.concept and g.member = n.member and g.line = n.line and g.y = n.y""",
)
def c26(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("fiscal_year", F.year("end_date").cast("long"))
    return N.fiscal_series(rows, ["cik", "concept", "member", "line"], "fiscal_year", [1997, 1998, 1999]).select("cik", "concept", "member", F.col("line").cast("long"), F.col("fiscal_year").cast("long"), "cell_status", F.col("value").cast("double"))


@query(
    "c18_project_inputs",
    """select role, reason, count(*) as n from (select d.role as role, case when d.metric is null then 'ROLE_NOT_DECLARED' when v is null then 'VALUE_MISSING' when d.currency is null then 'CURRENCY_UNKNOWN' when v < 0 then 'NEGATIVE_INPUT' end as reason
    from (select metric, case when n_sources % 4 = 0 then null when n_sources % 3 = 0 then -value else value end as v from annual) a left join (values ('A', 'REVENUE', 'USD'), ('N', 'EPS', null)) d(metric, role, currency) on a.metric = d.metric) x group by 1, 2""",
)
def c18(t: Tables) -> DataFrame:
    value = F.when(F.col("n_sources") % 4 == 0, None).when(F.col("n_sources") % 3 == 0, -F.col("value")).otherwise(F.col("value"))
    declared = t.spark.createDataFrame([("A", "REVENUE", "USD"), ("N", "EPS", None)], "metric string, role string, currency string")
    return N.project_inputs(t.annual.withColumn("value", value), declared, "metric").groupBy("role", "reason").agg(F.count("*").alias("n"))


@query(
    "c21_eps_ttm_reviewed",
    """with q as (select cik, coordinate, case when source_id % 7 > 0 then value end as value, case n_sources when 1 then 'x' when 2 then 'x' when 3 then 'y' end as c, n_sources > 3 as open from cells where coordinate between 7997 and 8000),
    g as (select cik, count(distinct coordinate) as quarters, count(*) as k, count(distinct c) as s, count(*) filter (where open) as o, sum(value) as v, count(value) as h from q group by cik)
    select cik, quarters, case when quarters < 4 then 'QUARTER_MISSING' when k > 4 then 'COMPETING_ROWS' when o > 0 then 'SCOPE_NOT_APPROVED' when s > 1 then 'SCOPES_DIFFER' when h < k then 'INPUT_UNAVAILABLE' end as reason, case when quarters = 4 and k = 4 and o = 0 and s = 1 and h = 4 then cast(v as double) end as total from g""",
)
def c21(t: Tables) -> DataFrame:
    cells = t.cells.withColumn("scope", F.col("n_sources")).withColumn("value", F.when(F.col("source_id") % 7 > 0, F.col("value")))
    mapping = t.spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "scope long, canonical_scope string")
    return N.eps_ttm_reviewed(cells, mapping, ["cik"], "coordinate", 8000).select("cik", "quarters", "reason", F.col("total").cast("double"))


@query(
    "c38_statement_occurrence",
    """with n as (select cik, concept, count(*) as k, min(fact_id) as f from facts group by 1, 2) select s.fact_id as fact_id, cast(case when k = 1 then f end as varchar) as occurrence_id, case when k is null then 'OCCURRENCE_MISSING' when k > 1 then 'OCCURRENCE_AMBIGUOUS' end as reason
    from facts s left join n on s.cik = n.cik and s.concept = n.concept""",
)
def c38(t: Tables) -> DataFrame:
    occurrences = t.facts.select("cik", "concept", F.col("fact_id").alias("occurrence_id"))
    return N.statement_occurrence(t.facts, occurrences, ["cik", "concept"]).select("fact_id", F.col("occurrence_id").cast("string"), "reason")
