"""Queries of the selection operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import selection as S
from asofworks.plans.registry import Tables, query


def text(*names: str) -> list:
    return [F.col(n).cast("string").alias(n) for n in names]


@query(
    "a1_unique_or_reason",
    """with k as (select distinct cik, concept, member, line from (select cik from filings) x cross join (values ('A'), ('N'), ('R')) v(concept) cross join (values ('F'), ('O')) m(member) cross join (values (1), (2), (3), (4), (5), (6), (7)) l(line)),
    g as (select cik, concept, member, line, count(*) as n, min(value) as value from facts group by 1, 2, 3, 4)
    select k.cik as cik, k.concept as concept, k.member as member, cast(k.line as bigint) as line, coalesce(n, 0) as n_candidates, case when n = 1 then cast(value as double) end as value, case when n is null then 'MISSING' when n > 1 then 'MULTIPLE_CANDIDATES' end as reason
    from k left join g on k.cik = g.cik and k.concept = g.concept and k.member = g.member and k.line = g.line""",
)
def a1(t: Tables) -> DataFrame:
    spine = t.filings.select("cik").distinct().withColumn("concept", F.explode(F.array(*[F.lit(c) for c in "ANR"])))
    spine = spine.withColumn("member", F.explode(F.array(F.lit("F"), F.lit("O")))).withColumn("line", F.explode(F.sequence(F.lit(1), F.lit(7))))
    rows = S.unique_or_reason(t.facts, ["cik", "concept", "member", "line"], "value", "fact_id", spine)
    return rows.select("cik", "concept", "member", F.col("line").cast("long"), F.col("n_candidates").cast("long"), F.col("value").cast("double"), "reason")


for view, name, rank in (("AS_FILED", "a3_as_filed", "asc"), ("LATEST_REPORTED", "a3_latest_reported", "desc")):

    @query(
        name,
        f"""with r as (select *, row_number() over (partition by cik, concept, member order by filed_date {rank}, accession {rank}, fact_id {rank}, value) as n from facts where filed_date <= date '1997-06-30'),
        i as (select distinct cik, concept, member from facts)
        select i.cik as cik, i.concept as concept, i.member as member, cast(r.accession as varchar) as accession, cast(r.fact_id as varchar) as fact_id, case when r.cik is null then 'UNAVAILABLE' else 'AVAILABLE' end as status
        from i left join r on i.cik = r.cik and i.concept = r.concept and i.member = r.member and r.n = 1""",
    )
    def a3(t: Tables, view: str = view) -> DataFrame:
        rows = S.select_reported(t.facts, ["cik", "concept", "member"], "1997-06-30", view)
        return rows.select("cik", "concept", "member", *text("accession", "fact_id"), "status")


@query(
    "w10_core_fact",
    """with j as (select f.cik as cik, f.concept as concept, f.value as value, f.accession as accession, f.filed_date as filed_date, g.form as form, f.line % 3 as dims from facts f join filings g on f.accession = g.accession where g.form not like '%/A'),
    r as (select *, rank() over (partition by cik, concept order by form = '10-Q' desc, filed_date desc, accession desc, dims = 0 desc) as k from j)
    select cik, concept, count(*) as n_candidates, case when count(*) = 1 then cast(min(value) as double) end as value, cast(case when count(*) = 1 then min(accession) end as varchar) as accession, case when count(*) > 1 then 'TIE_REVIEW_REQUIRED' end as reason from r where k = 1 group by 1, 2""",
)
def w10(t: Tables) -> DataFrame:
    rows = t.facts.join(t.filings.select("accession", "form"), "accession").withColumn("n_dimensions", F.col("line") % 3)
    return S.core_fact(rows, ["cik", "concept"]).select("cik", "concept", "n_candidates", F.col("value").cast("double"), *text("accession"), "reason")


@query(
    "w11_select_as_filed",
    """with r as (select cik, concept, year(end_date) as y, accession, line % 2 = 0 as is_direct, row_number() over (partition by cik, concept, year(end_date) order by line % 2 = 0 desc, filed_date, accession, fact_id) as n from facts where filed_date <= date '1999-12-31')
    select cik, concept, cast(y as bigint) as period, accession, is_direct from r where n = 1""",
)
def w11(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("period", F.year("end_date").cast("long")).withColumn("is_direct", F.col("line") % 2 == 0)
    return S.select_as_filed(rows, ["cik", "concept", "period"], "1999-12-31").select("cik", "concept", "period", "accession", "is_direct")


@query(
    "w12_current_comparable",
    """with k as (select *, cast(year(end_date) as bigint) as period from facts where filed_date <= date '1999-12-31'),
    b as (select cik, concept, member as basis from (select *, row_number() over (partition by cik, concept order by filed_date desc, accession desc, fact_id desc, member desc) as n from k) x where n = 1),
    l as (select k.cik as cik, k.concept as concept, k.period as period, k.accession as accession, k.member as member, row_number() over (partition by k.cik, k.concept, k.period order by filed_date desc, accession desc, fact_id desc) as n from k join b on k.cik = b.cik and k.concept = b.concept and k.member = b.basis),
    p as (select distinct cik, concept, period from k)
    select p.cik as cik, p.concept as concept, p.period as period, cast(l.accession as varchar) as accession, l.member as member, case when l.cik is null then 'PERIOD_NOT_AVAILABLE_IN_SELECTED_BASIS' end as reason
    from p left join l on p.cik = l.cik and p.concept = l.concept and p.period = l.period and l.n = 1""",
)
def w12(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("period", F.year("end_date").cast("long"))
    return S.select_current_comparable(rows, ["cik", "concept"], "period", "member", "1999-12-31").select("cik", "concept", "period", *text("accession"), "member", "reason")


@query(
    "w9_effective_decisions",
    """with e as (select user_id as issue, event_id, event_type, ts, row_number() over (partition by user_id order by ts, event_id) as k, lag(ts) over (partition by user_id order by ts, event_id) as prior, row_number() over (partition by user_id order by ts desc, event_id desc) as last from events where ts <= timestamp '2024-01-20 00:00:00')
    select issue, max(case when last = 1 then event_id end) as event_id, max(case when last = 1 then event_type end) as event_type, count(*) as n_events,
      case when bool_or(coalesce(prior = ts, false)) then 'TIE' when bool_or(k = 1 and event_type in ('error')) then 'RELEASE_FIRST' end as chain_error from e group by issue""",
)
def w9(t: Tables) -> DataFrame:
    events = t.events.withColumnRenamed("user_id", "issue")
    rows = S.effective_decisions(events, "issue", F.lit("2024-01-20").cast("timestamp_ntz"), "ts", "event_type", "event_id", ("error",))
    return rows.select("issue", "event_id", "event_type", "n_events", "chain_error")


@query(
    "w14_disclosure_states",
    """with f as (select cik, coordinate, value > 200000 as reported, n_sources % 2 = 0 as changed, n_sources = 3 as resolved, lag(value > 200000 and n_sources <> 3) over (partition by cik order by coordinate) as b from cells)
    select cik, coordinate, case when resolved then 'RESOLVED' when not reported then 'NOT_REPORTED_THIS_QUARTER' when b is null then 'BASELINE' when not b then 'NEW' when changed then 'CHANGED' else 'REPORTED_UNCHANGED' end as state from f""",
)
def w14(t: Tables) -> DataFrame:
    flags = t.cells.withColumn("reported", F.col("value") > 200000).withColumn("changed", F.col("n_sources") % 2 == 0).withColumn("resolved", F.col("n_sources") == 3)
    return S.disclosure_states(flags, ["cik"], "coordinate", "reported", "changed", "resolved").select("cik", "coordinate", "state")


@query(
    "w17_latest_company_period",
    """with f as (select cik, concept, year(end_date) as y, start_date, end_date from facts), l as (select cik, max(y) as m from f group by cik),
    s as (select f.cik as cik, count(distinct start_date) as a, count(distinct end_date) as b from f join l on f.cik = l.cik and f.y = l.m group by f.cik)
    select case when f.y <> l.m then 'PERIOD_MISMATCH' when a > 1 or b > 1 then 'PERIOD_CONFLICT' else 'PERIOD_AVAILABLE' end as period_status, f.concept as concept, count(*) as n from f join l on f.cik = l.cik join s on f.cik = s.cik group by 1, 2""",
)
def w17(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("period", F.year("end_date"))
    return S.latest_company_period(rows, "cik", "period", "start_date", "end_date").groupBy("period_status", "concept").agg(F.count("*").alias("n"))


@query("a14_dedupe_inputs", "select part_key, unit_key, cast(min(value) as double) as value, string_agg(distinct concept, ',' order by concept) as refs, case when count(distinct value) > 1 then 'CONFLICT' else 'UNIQUE' end as status from facts group by 1, 2")
def a14(t: Tables) -> DataFrame:
    rows = S.dedupe_inputs(t.facts, ["part_key", "unit_key"], "value", "concept")
    return rows.select("part_key", "unit_key", F.col("value").cast("double"), F.array_join("references", ",").alias("refs"), "status")


@query(
    "w16_canonical_ids",
    """with r as (select cik, accession, form, status, row_number() over w as n, lag(status) over w as p from filings window w as (partition by cik, form order by filed_date, accession)),
    s as (select *, case when n = 1 or status = p then 0 else 1 end as b from r), u as (select *, sum(b) over (partition by cik, form order by n) as run from s)
    select accession, concat_ws(':', cast(cik as varchar), form, cast(first_value(accession) over (partition by cik, form, run order by n) as varchar)) as canonical_id, case when n = 1 then 'NEW' when b = 1 then 'UNKNOWN_CHANGE' else 'SAME' end as relation from u""",
)
def w16(t: Tables) -> DataFrame:
    return S.canonical_ids(t.filings, ("filed_date", "accession"), ["form"], ["status"]).select("accession", "canonical_id", "relation")


@query(
    "a17_merge_duplicates",
    """with f as (select cik, concept, fact_id, cast(value as double) as v, 5.0 * (1 + line % 4) * 1000 as h from facts),
    r as (select cik, concept, max(v - h) as lo, min(v + h) as hi, count(*) as n_reports from f group by 1, 2),
    b as (select cik, concept, v, row_number() over (partition by cik, concept order by (v + h) - (v - h), fact_id, v) as k from f)
    select r.cik as cik, r.concept as concept, lo, hi, n_reports, case when lo > hi then 'CONFLICT' else 'MERGED' end as status from r""",
)
def a17(t: Tables) -> DataFrame:
    half = 5.0 * (1 + F.col("line") % 4) * 1000
    v = F.col("value").cast("double")
    rows = t.facts.select("cik", "concept", "fact_id", v.alias("v"), (v - half).alias("l"), (v + half).alias("h"))
    return S.merge_duplicates(rows, ["cik", "concept"], "l", "h", "v", "fact_id").select("cik", "concept", "lo", "hi", "n_reports", "status")
