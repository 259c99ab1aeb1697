"""Queries of the composed operators and of the sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asofworks.operators import composed as K
from asofworks.operators.periods import assign_roles, classify_period
from asofworks.plans.period_queries import CLASS_SQL
from asofworks.plans.quarter_queries import CLASSED_SQL, classed
from asofworks.plans.registry import Tables, cents, query
from asofworks.sources import tables as X


def money(*names: str) -> list:
    return [F.col(n).cast("double").alias(n) for n in names]


@query(
    "a6_publication_coverage",
    "select coalesce(a.cik, b.cik) as cik, coalesce(facts, 0) as facts, coalesce(concepts, 0) as concepts, coalesce(exclusions, 0) as exclusions from (select cik, count(*) as facts, count(distinct concept) as concepts from facts where discount < 0.05 group by 1) a full outer join (select cik, count(*) as exclusions from facts where discount >= 0.05 group by 1) b on a.cik = b.cik",
)
def a6(t: Tables) -> DataFrame:
    return K.coverage(t.facts.where("discount < 0.05"), t.facts.where("discount >= 0.05"))


@query(
    "a7_capability_inventory",
    "select cik, concept, member, 'OBSERVED' as status from (select distinct cik, concept, member from facts) x union all select cik, null, null, 'COVERAGE_UNAVAILABLE' from companies where cik not in (select cik from facts)",
)
def a7(t: Tables) -> DataFrame:
    return K.capability_inventory(t.facts, t.companies, ["concept", "member"]).select("cik", "concept", "member", "status")


@query(
    "a11_reported_12m",
    """with a as (select cik, concept, end_date, value from facts where datediff('day', start_date, end_date) between 350 and 378 and filed_date <= date '1999-12-31'), m as (select cik, concept, max(end_date) as e from a group by 1, 2)
    select a.cik as cik, a.concept as concept, cast(e as varchar) as end_date, case when count(distinct value) > 1 then 'AMBIGUOUS' end as reason, case when count(distinct value) = 1 then cast(min(value) as double) end as value from a join m on a.cik = m.cik and a.concept = m.concept and a.end_date = m.e group by 1, 2, 3""",
)
def a11(t: Tables) -> DataFrame:
    return K.reported_twelve_months(t.facts, ["cik", "concept"], "1999-12-31").select("cik", "concept", F.col("end_date").cast("string"), "reason", *money("value"))


@query(
    "a22_role_inventory",
    """with a as (select parent as role, count(*) as arcs, count(distinct child) as concepts from edges group by 1), f as (select 'N' || c_nationkey as role, count(*) as facts from orders join customer on o_custkey = c_custkey group by 1), r as (select 'N' || n_nationkey as role from nation)
    select r.role as role, coalesce(arcs, 0) as arcs, coalesce(concepts, 0) as concepts, coalesce(facts, 0) as facts from r left join a on r.role = a.role left join f on r.role = f.role""",
)
def a22(t: Tables) -> DataFrame:
    name = lambda c: F.concat(F.lit("N"), c).alias("role")
    facts = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(name("c_nationkey"))
    return K.role_inventory(t.nation.select(name("n_nationkey")), t.edges.withColumnRenamed("parent", "role"), facts, "role")


@query(
    "a24_review_inventory",
    f"with {CLASSED_SQL}, q as (select a.fact_id as fact_id from c a join c b on a.cik = b.cik and a.concept = b.concept and a.start_date = b.start_date and a.period_class = 'FY' and b.period_class = 'YTD_9M' and b.end_date < a.end_date) select fact_id, 'Q4' as kind from q union all select fact_id, 'LARGE' from facts where value > 104000",
)
def a24(t: Tables) -> DataFrame:
    q4 = K.mechanical_q4(classed(t, "FY", "YTD_9M", "QTD_3M"), ["cik", "concept"], "2002-01-01").withColumnRenamed("later_fact_id", "fact_id")
    return K.review_inventory([("Q4", q4), ("LARGE", t.facts.where("value > 104000"))], ["fact_id"])


@query(
    "c2_company_series",
    f"""with j as (select f.*, g.form as form, {CLASS_SQL} as period_class from facts f join filings g on f.accession = g.accession), s as (select case when form like '10-K%' and period_class = 'FY' then 'ANNUAL' when form like '10-K%' or form like '10-Q%' then 'CURRENT' end as series, value from j)
    select series, case when series is null then 'FORM_NOT_IN_SERIES' end as exclusion, count(*) as n, cast(sum(value) as double) as total from s group by 1, 2""",
)
def c2(t: Tables) -> DataFrame:
    rows = t.facts.join(t.filings.select("accession", "form"), "accession").withColumn("period_class", classify_period("start_date", "end_date"))
    return K.company_series(rows, "form").groupBy("series", "exclusion").agg(F.count("*").alias("n"), F.sum("value").cast("double").alias("total"))


@query(
    "c3_both_views",
    """with r as (select *, row_number() over (partition by cik, concept order by filed_date, accession, fact_id) as a, row_number() over (partition by cik, concept order by filed_date desc, accession desc, fact_id desc) as b from facts where filed_date <= date '1998-12-31'), i as (select distinct cik, concept from facts)
    select i.cik as cik, i.concept as concept, 'AS_FILED' as view, cast(accession as varchar) as accession from i left join r on i.cik = r.cik and i.concept = r.concept and r.a = 1 union all select i.cik, i.concept, 'LATEST_REPORTED', cast(accession as varchar) from i left join r on i.cik = r.cik and i.concept = r.concept and r.b = 1""",
)
def c3(t: Tables) -> DataFrame:
    return K.both_views(t.facts, ["cik", "concept"], "1998-12-31").select("cik", "concept", "view", F.col("accession").cast("string"))


@query(
    "c4_comparable_companion",
    "select cik, coordinate, 'AS_FILED' as row_kind, cast(value as double) as value from cells union all select cik, coordinate, 'COMPARABLE', cast(value + 1 as double) from cells where n_sources > 2",
)
def c4(t: Tables) -> DataFrame:
    reviewed = t.cells.where("n_sources > 2").select("cik", "coordinate", (F.col("value") + 1).alias("value"))
    return K.comparable_companion(t.cells.select("cik", "coordinate", "value"), reviewed, ["cik", "coordinate"]).select("cik", "coordinate", "row_kind", *money("value"))


@query(
    "c5_c9_reviewed_q4",
    f"""with {CLASSED_SQL}, p as (select a.cik as cik, a.concept as concept, a.fact_id as later_fact_id, a.value as lv, b.value as ev, datediff('day', b.end_date, a.end_date) as days, a.end_date as e,
      count(*) over (partition by a.cik, a.concept, a.fact_id) as k from c a join c b on a.cik = b.cik and a.concept = b.concept and a.start_date = b.start_date and a.period_class = 'FY' and b.period_class = 'YTD_9M' and b.end_date < a.end_date),
    d as (select distinct cik, concept, end_date, true as yes from c where period_class = 'QTD_3M'), ok as (select distinct cik, concept from facts where line = 6 and filed_date <= date '2000-01-01'),
    r as (select p.cik as cik, p.concept as concept, later_fact_id, lv, ev, case when k > 1 then 'AMBIGUOUS_PAIR' when days not between 75 and 105 then 'DURATION_OUT_OF_RANGE' when d.yes then 'DIRECT_QUARTER_REPORTED' when ok.cik is null then 'REVIEW_REQUIRED' end as reason
      from p left join d on p.cik = d.cik and p.concept = d.concept and p.e = d.end_date left join ok on p.cik = ok.cik and p.concept = ok.concept)
    select cik, concept, later_fact_id, reason, case when reason is null then cast(lv - ev as double) end as value from r""",
)
def c9(t: Tables) -> DataFrame:
    candidates = K.mechanical_q4(classed(t, "FY", "YTD_9M", "QTD_3M"), ["cik", "concept"], "2002-01-01")
    approvals = t.facts.where("line = 6").select("cik", "concept", F.col("filed_date").alias("known_at"))
    return K.reviewed_quarters(candidates, approvals, ["cik", "concept"], "2000-01-01").select("cik", "concept", "later_fact_id", "reason", *money("value"))


@query(
    "c14_quarter_metrics",
    """with t as (select c.cik as cik, c.coordinate as coordinate, c.value as v, q.value as q, y.value as y, count(*) over w as n, min(c.coordinate) over w as f, sum(c.value) over w as s from cells c left join cells q on q.cik = c.cik and q.coordinate = c.coordinate - 1
      left join cells y on y.cik = c.cik and y.coordinate = c.coordinate - 4 window w as (partition by c.cik order by c.coordinate rows between 3 preceding and current row))
    select cik, coordinate, cast(v as double) as value, case when q > 0 and v >= 0 then cast(v - q as double) / cast(q as double) * 100 end as qoq, case when y > 0 and v >= 0 then cast(v - y as double) / cast(y as double) * 100 end as yoy, case when y is null then 'PREDECESSOR_MISSING' end as yoy_reason,
      case when n < 4 or coordinate - f <> 3 then 'INPUTS_NOT_CONTIGUOUS' end as ttm_reason, case when n = 4 and coordinate - f = 3 then cast(s as double) end as ttm from t where coordinate between 7996 and 8003""",
)
def c14(t: Tables) -> DataFrame:
    rows = K.quarter_metrics(t.cells, ["cik"], "coordinate", list(range(7996, 8004)))
    return rows.select("cik", "coordinate", "qoq", "yoy", "yoy_reason", "ttm_reason", *money("value", "ttm"))


@query(
    "c17_price_timeline",
    """with placed as (select p.security_id as security_id, s.session as session, p.close as close from prices p join sessions s on p.trade_date = s.trade_date), span as (select security_id, min(session) as a, max(session) as b from placed group by 1), places as (select security_id, unnest(generate_series(a, b)) as session from span),
    d as (select c_custkey as security_id, cast(c_acctbal / 1000 as decimal(18,2)) as denominator from customer where c_custkey % 3 > 0),
    r as (select g.security_id as security_id, g.session as session, p.close as close, d.denominator as denominator, case when p.close > 0 and d.denominator > 0 then cast(p.close as double) / cast(d.denominator as double) end as ratio from places g left join placed p on g.security_id = p.security_id and g.session = p.session left join d on d.security_id = g.security_id)
    select security_id, session, ratio, case when ratio >= 10 then 10.0 when ratio >= 5 then 5.0 when ratio >= 1 then 1.0 end::double as below, case when ratio < 1 then 1.0 when ratio < 5 then 5.0 when ratio < 10 then 10.0 end::double as above,
      case when close is null then 'SESSION_PRICE_MISSING' when denominator is null then 'DENOMINATOR_MISSING' when ratio is null then 'NON_POSITIVE_INPUT' end as reason from r""",
)
def c17(t: Tables) -> DataFrame:
    from asofworks.plans.price_queries import grid

    d = t.customer.where("c_custkey % 3 > 0").select(F.col("c_custkey").alias("security_id"), cents(F.col("c_acctbal") / 1000).alias("denominator"))
    return K.price_timeline(grid(t), d, [1, 5, 10]).select("security_id", "session", "ratio", "below", "above", "reason")


@query(
    "c19_cover_shares",
    """with k as (select *, rank() over (partition by cik, concept order by filed_date desc, accession desc) as r from facts) select cik, concept, fact_id, count(*) over (partition by cik, concept) as n_candidates from k where r = 1""",
)
def c19(t: Tables) -> DataFrame:
    return K.cover_shares(t.facts, ["cik"], "concept").select("cik", "concept", "fact_id", "n_candidates")


@query(
    "c20_q4_eps",
    """with r as (select fact_id, cast(value as double) * 2 as fy, cast(value as double) as nm, cast(quantity as double) as w, line % 2 = 0 as ok from facts),
    s as (select fact_id, ok, (fy - 0.5) - (nm + 0.5) as nlo, (fy + 0.5) - (nm - 0.5) as nhi, ((w - 0.5) * 365 - (w + 0.5) * 270) / 95 as wlo, ((w + 0.5) * 365 - (w - 0.5) * 270) / 95 as whi from r)
    select fact_id, case when not (wlo > 0 or whi < 0) then 'SHARES_SPAN_ZERO' when not ok then 'DIAGNOSTIC_ONLY' end as reason, case when wlo > 0 or whi < 0 then least(nlo / wlo, nlo / whi, nhi / wlo, nhi / whi) end as lo, case when wlo > 0 or whi < 0 then greatest(nlo / wlo, nlo / whi, nhi / wlo, nhi / whi) end as hi from s""",
)
def c20(t: Tables) -> DataFrame:
    around = lambda c: F.struct((c - 0.5).alias("lo"), (c + 0.5).alias("hi"))
    v, w = F.col("value").cast("double"), F.col("quantity").cast("double")
    rows = t.facts.select("fact_id", around(v * 2).alias("fy_n"), around(v).alias("nm_n"), around(w).alias("fy_w"), around(w).alias("nm_w"), F.lit(365).alias("fy_days"), F.lit(270).alias("nm_days"), (F.col("line") % 2 == 0).alias("approved"))
    return K.q4_eps(rows).select("fact_id", "reason", F.col("eps.lo").alias("lo"), F.col("eps.hi").alias("hi"))


@query(
    "c37_total_liabilities",
    """with v as (select cik, fiscal_year, max(case when metric = 'A' then value end) as a, max(case when metric = 'N' then value end) as e, max(case when metric = 'R' then value end) as c from annual group by 1, 2),
    r as (select cik, fiscal_year, a - e as residual, case when a is null or e is null then 'EQUATION_INPUT_MISSING' when c is null then 'COMPONENTS_MISSING' when a - e <> case when cik % 2 = 0 then coalesce(a - e, 0) else c end then 'RESIDUAL_MISMATCH' end as reason from v)
    select reason, case when reason is null then 'EQUATION' end as source, count(*) as n, cast(sum(case when reason is null then residual end) as double) as total from r group by 1, 2""",
)
def c37(t: Tables) -> DataFrame:
    rows = assign_roles(t.annual, {"A": "ASSETS", "N": "EQUITY", "R": "CURRENT"}, "metric").select("cik", "fiscal_year", "role", "value")
    wide = rows.groupBy("cik", "fiscal_year").pivot("role", ["ASSETS", "EQUITY", "CURRENT"]).agg(F.max("value"))
    current = F.when(F.col("CURRENT").isNotNull(), F.when(F.col("cik") % 2 == 0, F.coalesce(F.col("ASSETS") - F.col("EQUITY"), F.lit(0))).otherwise(F.col("CURRENT")))
    parts = [("ASSETS", F.col("ASSETS")), ("EQUITY", F.col("EQUITY")), ("CURRENT", current), ("NONCURRENT", F.when(F.col("CURRENT").isNotNull(), F.lit(0)))]
    long = wide.select("cik", "fiscal_year", F.explode(F.array(*[F.struct(F.lit(n).alias("role"), v.cast("decimal(28,2)").alias("value")) for n, v in parts])).alias("e")).select("cik", "fiscal_year", "e.role", "e.value")
    out = K.total_liabilities(long, ["cik", "fiscal_year"], "role")
    return out.groupBy("reason", "source").agg(F.count("*").alias("n"), F.sum("total").cast("double").alias("total"))


@query(
    "c40_core_cells",
    """with l as (select * from (values ('LINE_A', 'A'), ('LINE_NR', 'N'), ('LINE_NR', 'R'), ('LINE_Z', 'Z')) v(line_id, metric)), n as (select a.cik as cik, a.fiscal_year as fiscal_year, line_id, count(*) as k, min(value) as value from annual a join l on a.metric = l.metric group by 1, 2, 3),
    g as (select x.cik as cik, x.fiscal_year as fiscal_year, i.line_id as line_id from (select distinct cik, fiscal_year from annual) x cross join (select distinct line_id from l) i)
    select g.cik as cik, g.fiscal_year as fiscal_year, g.line_id as line_id, case when k is null then 'MISSING' when k > 1 then 'MULTIPLE_CANDIDATES' end as reason, case when k = 1 then cast(value as double) end as value from g left join n on g.cik = n.cik and g.fiscal_year = n.fiscal_year and g.line_id = n.line_id""",
)
def c40(t: Tables) -> DataFrame:
    profile = t.spark.createDataFrame([("LINE_A", ["A"]), ("LINE_NR", ["N", "R"]), ("LINE_Z", ["Z"])], "line_id string, concepts array<string>")
    rows = K.core_cells(t.annual.withColumnRenamed("metric", "concept"), profile, ["cik", "fiscal_year"])
    return rows.select("cik", "fiscal_year", "line_id", "reason", *money("value"))


@query(
    "c39_reviewed_interpretation",
    """with a as (select accession as a, 'K' || (accession % 3) as target from filings where accession % 5 = 0), r as (select f.cik as cik, f.accession as accession, coalesce(target, status) as slot, target from filings f left join a on f.accession = a.a)
    select accession, slot, case when target is not null and count(*) over (partition by cik, slot) > 1 then 'SLOT_CONFLICT' when target is not null then 'REINTERPRETED' else 'AS_REPORTED' end as status from r""",
)
def c39(t: Tables) -> DataFrame:
    approved = t.filings.where("accession % 5 = 0").select("accession", F.concat(F.lit("K"), (F.col("accession") % 3).cast("string")).alias("target"))
    cells = t.filings.select("cik", "accession", F.col("status").alias("slot"))
    return K.reviewed_interpretation(cells, approved, "accession").select("accession", "slot", "status")


@query(
    "c42_screening_dataset",
    """with a as (select cik, count(*) as annual from (select * from annual where value > 80000) x group by 1), q as (select cik, count(*) as quarterly from cells group by 1)
    select c.cik as cik, coalesce(annual, 0) as annual, coalesce(quarterly, 0) as quarterly, case when coalesce(annual, 0) = 0 or coalesce(quarterly, 0) = 0 then 'OBSERVATIONS_MISSING' else 'AGREES' end as set_status from companies c left join a on c.cik = a.cik left join q on c.cik = q.cik""",
)
def c42(t: Tables) -> DataFrame:
    return K.screening_dataset(t.companies, t.annual.where("value > 80000"), t.cells).select("cik", "annual", "quarterly", "set_status")


@query(
    "t3_important_children",
    """with r as (select m.c_nationkey as nation, c.cik as cik, row_number() over (partition by m.c_nationkey order by sum(c.value) desc, c.cik) as amount_rank, count(*) over (partition by m.c_nationkey) as k from cells c join customer m on m.c_custkey = c.cik group by 1, 2)
    select nation, cik, amount_rank, greatest(k - 2 - 3, 0) as hidden from r where amount_rank between 3 and 5""",
)
def t3(t: Tables) -> DataFrame:
    total = t.cells.groupBy("cik").agg(F.sum("value").alias("v")).join(t.customer.select(F.col("c_custkey").alias("cik"), F.col("c_nationkey").alias("nation")), "cik")
    ranked = total.withColumn("amount_rank", F.row_number().over(Window.partitionBy("nation").orderBy(F.col("v").desc(), "cik")).cast("long"))
    return K.important_children(ranked, "nation", 3, 2).select("nation", "cik", "amount_rank", F.col("hidden").cast("long"))


@query("c24_company_profile", "select c.cik as cik, c.name as name, a.fiscal_year as fiscal_year, a.metric as metric, cast(a.value as double) as value from companies c left join (select * from annual where cik = 7 and fiscal_year = (select max(fiscal_year) from annual where cik = 7)) a on c.cik = a.cik where c.cik = 7")
def c24(t: Tables) -> DataFrame:
    return K.company_profile(t.companies, t.annual, 7).select("cik", "name", "fiscal_year", "metric", *money("value"))


@query("c41_overview", "select cik, coordinate, cast(value as double) as value from cells where coordinate in (7990, 7994, 7998)")
def c41(t: Tables) -> DataFrame:
    periods = t.cells.where("coordinate in (7990, 7994, 7998)").select("coordinate").distinct()
    return K.overview(t.cells, periods, ["coordinate"]).select("cik", "coordinate", *money("value"))


@query(
    "j11_link_security_headers",
    """with s as (select c_custkey as cik, c_mktsegment as ticker from customer), h as (select o_custkey as cik, case o_orderstatus when 'F' then 'BUILDING' when 'O' then 'MACHINERY' else 'HOUSEHOLD' end as ticker, o_orderpriority as title, o_orderkey as context_id from orders),
    r as (select s.cik as cik, s.ticker as ticker, title, context_id from s join h on s.cik = h.cik and s.ticker = h.ticker), n as (select cik, ticker, count(distinct title) as a, count(distinct context_id) as b from r group by 1, 2)
    select r.cik as cik, r.context_id as context_id, case when a = 1 and b = 1 then 'REPORTED_CLASS_IDENTITY' else 'HEADER_MATCH_CLASS_UNCONFIRMED' end as link_status from r join n on r.cik = n.cik and r.ticker = n.ticker""",
)
def j11(t: Tables) -> DataFrame:
    ticker = F.when(F.col("o_orderstatus") == "F", "BUILDING").when(F.col("o_orderstatus") == "O", "MACHINERY").otherwise("HOUSEHOLD")
    symbols = t.orders.select(F.col("o_custkey").alias("cik"), ticker.alias("ticker"), F.col("o_orderpriority").alias("title"), F.col("o_orderkey").alias("context_id"))
    securities = t.customer.select(F.col("c_custkey").alias("cik"), F.col("c_mktsegment").alias("ticker"))
    return K.link_security_headers(securities, symbols).select("cik", "context_id", "link_status")


@query(
    "p17_normalize_lexical",
    """select o_orderkey, 'P' || cast(floor(v * 7) as bigint) || 'D' as weeks, 'PT' || cast(floor(v) as bigint) || 'H' as hours,
    'P' || cast(floor(v) as bigint) || 'Y' || case when floor((v - floor(v)) * 12) > 0 then cast(floor((v - floor(v)) * 12) as bigint) || 'M' else '' end as years from (select o_orderkey, cast(cast(o_totalprice / 1000 as decimal(18,2)) as decimal(20,8)) as v from orders) x""",
)
def p17(t: Tables) -> DataFrame:
    rows = t.orders.withColumn("text", cents(F.col("o_totalprice") / 1000).cast("string"))
    return rows.select("o_orderkey", K.normalize_duration("text", "durweek").alias("weeks"), K.normalize_duration("text", "durhour").alias("hours"), K.normalize_duration("text", "duryear").alias("years"))


@query(
    "s10_read_price_batch",
    """with m as (select c.c_custkey as cik, count(s.security_id) as n, min(s.security_id) as id from customer c left join (select user_id as security_id, user_id as cik from (select distinct user_id from events where user_id % 4 > 0) u union all select user_id + 1000000, user_id from (select distinct user_id from events where user_id % 7 = 1) w) s on s.cik = c.c_custkey group by 1),
    p as (select * from prices where trade_date between date '2024-01-10' and date '2024-01-12')
    select m.cik as cik, cast(p.trade_date as varchar) as trade_date, case when n = 0 then 'SECURITY_MISSING' when n > 1 then 'SECURITY_AMBIGUOUS' when p.trade_date is null then 'PRICE_MISSING' end as reason, cast(p.close as double) as close from m left join p on n = 1 and p.security_id = m.id""",
)
def s10(t: Tables) -> DataFrame:
    users = t.events.select(F.col("user_id").alias("cik")).distinct()
    one = lambda df, shift: df.select(F.col("cik"), F.lit("T").alias("ticker"), (F.col("cik") + shift).alias("security_id"))
    securities = one(users.where("cik % 4 > 0"), 0).unionAll(one(users.where("cik % 7 = 1"), 1000000))
    companies = t.customer.select(F.col("c_custkey").alias("cik"), F.lit("T").alias("ticker"))
    return X.read_price_batch(companies, securities, t.prices, "2024-01-10", "2024-01-12").select("cik", F.col("trade_date").cast("string"), "reason", *money("close"))


@query(
    "s6_company_metadata",
    """with o as (select o_custkey as cik, cast(o_orderdate as date) as d, o_orderkey from orders where o_orderdate <= timestamp '1996-06-30'), n as (select cik, max(d) as observed_on from o group by 1)
    select c_custkey as cik, cast(observed_on as varchar) as observed_on, n_name as industry, case when observed_on is null then 'CANDIDATE_ONLY' else 'CURRENT' end as metadata_status from customer left join n on c_custkey = n.cik left join nation on c_nationkey = n_nationkey""",
)
def s6(t: Tables) -> DataFrame:
    observations = t.orders.select(F.col("o_custkey").alias("cik"), F.col("o_orderdate").cast("date").alias("observed_on")).groupBy("cik", "observed_on").count().drop("count")
    inventory = t.customer.select(F.col("c_custkey").alias("cik"), F.col("c_nationkey").alias("sic"), F.col("c_name").alias("ticker"), F.col("c_mktsegment").alias("exchange"))
    industries = t.nation.select(F.col("n_nationkey").alias("sic"), F.col("n_name").alias("industry"))
    return X.company_metadata(observations, inventory, industries, "1996-06-30").select("cik", F.col("observed_on").cast("string"), "industry", "metadata_status")


@query("s14_export_rows", "select accession, case when starts_with(t, '-') or starts_with(t, '=') then '''' || t else t end as t from (select o_orderkey as accession, case o_orderkey % 3 when 0 then '=' || o_orderstatus when 1 then '-5' else o_orderpriority end as t from orders) x")
def s14(t: Tables) -> DataFrame:
    k = F.col("o_orderkey") % 3
    rows = t.orders.select(F.col("o_orderkey").alias("accession"), F.when(k == 0, F.concat(F.lit("="), "o_orderstatus")).when(k == 1, "-5").otherwise(F.col("o_orderpriority")).alias("t"))
    return X.export_rows(rows)


@query("s8_canonical_json", """select '{"accession":' || accession || ',"cik":' || cik || ',"form":"' || form || '"}' as value from filings""")
def s8(t: Tables) -> DataFrame:
    return X.canonical_json(t.filings.select("form", "cik", "accession"))


@query("s13_hydrate", "select o_orderkey as accession, cast(o_totalprice as double) as amount, o_orderpriority as priority from orders where o_totalprice > 400000")
def s13(t: Tables) -> DataFrame:
    rows = t.orders.selectExpr("o_orderkey as accession", "cast(o_totalprice as double) as amount", "o_orderpriority as priority")
    core, evidence = X.split_evidence(rows, "accession", ["priority"])
    return X.hydrate(core.where("amount > 400000"), evidence, "accession")
