"""Queries of the quarter operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import quarters as Q
from asofworks.operators.periods import classify_period
from asofworks.plans.period_queries import CLASS_SQL
from asofworks.plans.registry import Tables, query
from asofworks.sources.tables import written

GROWTH_SQL = """case when p is null then 'PREDECESSOR_MISSING' when p = 0 and v = 0 then 'ZERO_UNCHANGED' when p = 0 then 'ZERO_BASE' when v = 0 then 'ZERO_REACHED' when p > 0 and v > 0 then 'RATE_AVAILABLE'
    when p < 0 and v < 0 and abs(v) < abs(p) then 'NEGATIVE_MAGNITUDE_REDUCED' when p < 0 and v < 0 and abs(v) > abs(p) then 'NEGATIVE_MAGNITUDE_EXPANDED' when p < 0 and v < 0 then 'NEGATIVE_MAGNITUDE_UNCHANGED' when v > 0 then 'POSITIVE_TURN' else 'NEGATIVE_TURN' end"""


def flagship(t: Tables) -> DataFrame:
    """Year-over-year growth of each customer's quarter cells, known at a date, on a grid with gaps."""
    known = t.cells
    grown = Q.growth_table(known, ["cik"], "coordinate")
    grid = Q.gap_grid(known, ["cik"], "coordinate").select("cik", "coordinate", "cell_status")
    rows = grid.join(grown, ["cik", "coordinate"], "left")
    return rows.select("cik", "coordinate", "cell_status", F.col("value").cast("double"), F.coalesce("status", F.lit("GAP")).alias("status"), "rate", F.col("delta").cast("double"))


query(
    "c27_growth_grid",
    f"""with s as (select cik, min(coordinate) as a, max(coordinate) as b from cells group by cik), g as (select cik, unnest(generate_series(a, b)) as coordinate from s),
    j as (select c.cik as cik, c.coordinate as coordinate, c.value as v, p.value as p from cells c left join cells p on p.cik = c.cik and p.coordinate = c.coordinate - 4)
    select g.cik as cik, g.coordinate as coordinate, case when v is null then 'GAP' else 'REPORTED' end as cell_status, cast(v as double) as value, case when v is null then 'GAP' else {GROWTH_SQL} end as status,
      case when p > 0 and v >= 0 then cast(v - p as double) / cast(p as double) * 100 end as rate, cast(v - p as double) as delta from g left join j on g.cik = j.cik and g.coordinate = j.coordinate""",
)(flagship)


@query(
    "j5_predecessor_qoq",
    "select c.cik as cik, c.coordinate as coordinate, cast(c.value as double) as value, cast(p.value as double) as prior from cells c left join cells p on p.cik = c.cik and p.coordinate = c.coordinate - 1",
)
def j5(t: Tables) -> DataFrame:
    return Q.predecessor(t.cells, ["cik"], "coordinate", 1).select("cik", "coordinate", F.col("value").cast("double"), F.col("prior").cast("double"))


def classed(t: Tables, *kinds: str) -> DataFrame:
    """Facts of a concept with a common start per company and year, so that cumulative periods pair; those of the kinds are written once for all branches that read them.

    A class goes by days, which a common start leaves as they are, so it is told
    before the shift: a filter by class then need not make the dates of each line.
    """
    year_start = F.trunc("start_date", "year")
    rows = t.facts.withColumn("period_class", classify_period("start_date", "end_date"))
    rows = rows.where(F.col("period_class").isin(*kinds)) if kinds else rows
    shifted = rows.withColumn("end_date", F.date_add(year_start, F.datediff("end_date", "start_date"))).withColumn("start_date", year_start)
    return written(shifted.select("cik", "concept", "fact_id", "value", "filed_date", "start_date", "end_date", "period_class"), "classed") if kinds else shifted


CLASSED_SQL = f"""c as (select cik, concept, fact_id, value, filed_date, start_date, end_date, {CLASS_SQL} as period_class from
    (select cik, concept, fact_id, value, filed_date, cast(date_trunc('year', start_date) as date) as start_date, cast(date_trunc('year', start_date) as date) + cast(datediff('day', start_date, end_date) as integer) as end_date from facts) z)"""


@query(
    "j4_pair_cumulative",
    f"""with {CLASSED_SQL}, p as (select a.cik as cik, a.concept as concept, a.fact_id as later_fact_id, b.fact_id as earlier_fact_id, cast(a.value - b.value as double) as gap, a.start_date as s,
      case when count(*) over (partition by a.cik, a.concept, a.fact_id) > 1 then 'AMBIGUOUS' else 'UNIQUE' end as pair_status from c a join c b on a.cik = b.cik and a.concept = b.concept and a.start_date = b.start_date and a.period_class = 'FY' and b.period_class = 'YTD_9M' and b.end_date < a.end_date)
    select cik, concept, later_fact_id, earlier_fact_id, gap, pair_status from p""",
)
def j4(t: Tables) -> DataFrame:
    rows = Q.pair_cumulative(classed(t, "FY", "YTD_9M"), ["cik", "concept"], "FY", "YTD_9M")
    return rows.select("cik", "concept", "later_fact_id", "earlier_fact_id", (F.col("later_value") - F.col("earlier_value")).cast("double").alias("gap"), "pair_status")


for number, (later, earlier) in enumerate((("YTD_6M", "QTD_3M"), ("YTD_9M", "YTD_6M"), ("FY", "YTD_9M")), 2):

    @query(
        f"c7_derive_q{number}",
        f"""with {CLASSED_SQL}, p as (select a.cik as cik, a.concept as concept, a.fact_id as later_fact_id, a.value as lv, b.value as ev, a.filed_date as lf, b.filed_date as ef, datediff('day', b.end_date, a.end_date) as days, a.end_date as e,
          count(*) over (partition by a.cik, a.concept, a.fact_id) as k from c a join c b on a.cik = b.cik and a.concept = b.concept and a.start_date = b.start_date and a.period_class = '{later}' and b.period_class = '{earlier}' and b.end_date < a.end_date),
        d as (select distinct cik, concept, end_date, true as yes from c where period_class = 'QTD_3M'),
        r as (select p.cik as cik, p.concept as concept, later_fact_id, lv, ev, case when k > 1 then 'AMBIGUOUS_PAIR' when lf > date '2000-06-30' or ef > date '2000-06-30' then 'NOT_FILED_AS_OF' when days not between 75 and 105 then 'DURATION_OUT_OF_RANGE' when d.yes then 'DIRECT_QUARTER_REPORTED' end as reason
          from p left join d on p.cik = d.cik and p.concept = d.concept and p.e = d.end_date)
        select cik, concept, later_fact_id, reason, case when reason is null then cast(lv - ev as double) end as value from r""",
    )
    def c7(t: Tables, later: str = later, earlier: str = earlier) -> DataFrame:
        rows = Q.derive_quarter(classed(t, later, earlier, "QTD_3M"), ["cik", "concept"], later, earlier, "2000-06-30")
        return rows.select("cik", "concept", "later_fact_id", "reason", F.col("value").cast("double"))


TTM_SQL = """q as (select cik, coordinate, n_sources, case when source_id % 7 > 0 then value end as value from cells),
    t as (select cik, coordinate, value, n_sources, count(*) over w as n, count(value) over w as k, min(coordinate) over w as f, sum(value) over w as s, sum(n_sources) over w as m from q window w as (partition by cik order by coordinate rows between 3 preceding and current row)),
    u as (select *, case when n < 4 or coordinate - f <> 3 then 'INPUTS_NOT_CONTIGUOUS' when k < 4 then 'INPUT_UNAVAILABLE' end as reason from t)"""


def reported(t: Tables) -> DataFrame:
    """Cells of which some have no value."""
    return t.cells.withColumn("value", F.when(F.col("source_id") % 7 > 0, F.col("value")))


@query("a8_ttm", f"with {TTM_SQL} select cik, coordinate, reason, case when reason is null then cast(s as double) end as ttm from u")
def a8(t: Tables) -> DataFrame:
    return Q.ttm(reported(t), ["cik"], "coordinate").select("cik", "coordinate", "reason", F.col("ttm").cast("double"))


@query("a9_ttm_margin", f"with {TTM_SQL} select cik, coordinate, reason, case when reason is null then cast(m as double) / cast(s as double) * 100 end as margin from u")
def a9(t: Tables) -> DataFrame:
    counts = t.cells.select("cik", "coordinate", F.col("n_sources").cast("decimal(18,2)").alias("value"))
    return Q.ttm_margin(counts, reported(t).select("cik", "coordinate", "value"), ["cik"], "coordinate").select("cik", "coordinate", "reason", "margin")


@query(
    "a19_period_inventory",
    """with f as (select cik, year(filed_date) * 4 + quarter(filed_date) as coordinate, accession, filed_date, month(filed_date) as m from filings), b as (select max(coordinate) as l from f),
    s as (select c.cik as cik, g.coordinate as coordinate from (select distinct cik from f) c cross join (select unnest(generate_series(l - 7, l)) as coordinate from b) g),
    x as (select cik, coordinate, count(distinct m) as k, arg_max(accession, (filed_date, accession)) as accession from f group by 1, 2)
    select s.cik as cik, cast(s.coordinate as bigint) as coordinate, cast(x.accession as varchar) as accession, case when k is null then 'NO_FILING_AS_OF_CUTOFF' when k > 1 then 'PERIOD_CONFLICT' else 'PERIOD_AVAILABLE' end as bucket_status from s left join x on s.cik = x.cik and s.coordinate = x.coordinate""",
)
def a19(t: Tables) -> DataFrame:
    filings = t.filings.withColumn("coordinate", (F.year("filed_date") * 4 + F.quarter("filed_date")).cast("long")).withColumn("period", F.month("filed_date"))
    rows = Q.period_inventory(filings, Q.spine(filings, "cik", "coordinate", 8), "cik", "coordinate", "period")
    return rows.select("cik", "coordinate", F.col("accession").cast("string"), "bucket_status")


@query(
    "a5_core_coverage",
    """with g as (select c.cik as cik, y.fiscal_year as fiscal_year, m.metric as metric from (select distinct cik from annual) c cross join (select distinct fiscal_year from annual) y cross join (values ('A'), ('N'), ('R')) m(metric)),
    f as (select cik, fiscal_year, metric, count(case when value > 50000 then value end) as r, count(*) as k from annual group by 1, 2, 3), d as (select distinct cik, fiscal_year, metric from annual where n_sources > 2)
    select coverage, fiscal_year, count(*) as n from (select g.fiscal_year as fiscal_year, case when r > 0 then 'REPORTED' when d.cik is not null then 'DERIVED' when k > 0 then 'UNAVAILABLE' else 'MISSING' end as coverage
      from g left join f on g.cik = f.cik and g.fiscal_year = f.fiscal_year and g.metric = f.metric left join d on g.cik = d.cik and g.fiscal_year = d.fiscal_year and g.metric = d.metric) x group by 1, 2""",
)
def a5(t: Tables) -> DataFrame:
    keys = ["cik", "fiscal_year", "metric"]
    facts = t.annual.withColumn("value", F.when(F.col("value") > 50000, F.col("value")))
    years = t.annual.select("fiscal_year").distinct()
    grid = t.annual.select("cik").distinct().crossJoin(F.broadcast(years)).withColumn("metric", F.explode(F.array(*[F.lit(c) for c in "ANR"])))
    return Q.core_coverage(facts, t.annual.where("n_sources > 2"), grid, keys).groupBy("coverage", "fiscal_year").agg(F.count("*").alias("n"))


@query(
    "a4_metric_support",
    """with r as (select cik, metric, case when value > 50000 then value end as v, case when value <= 20000 then 'SMALL' when value <= 50000 then 'MEDIUM' end as reason from annual)
    select cik, metric, cast(count(v) as bigint) as available, cast(count(*) - count(v) as bigint) as unavailable, count(*) filter (where reason = 'SMALL') as small, count(*) filter (where reason = 'MEDIUM') as medium from r group by 1, 2""",
)
def a4(t: Tables) -> DataFrame:
    reason = F.when(F.col("value") <= 20000, "SMALL").when(F.col("value") <= 50000, "MEDIUM")
    rows = t.annual.withColumn("reason", reason).withColumn("value", F.when(F.col("value") > 50000, F.col("value")))
    out = Q.metric_support(rows, ["cik", "metric"], "value", "reason")
    count = lambda k: F.coalesce(F.try_element_at("reason_counts", F.lit(k)), F.lit(0)).cast("long")
    return out.select("cik", "metric", "available", "unavailable", count("SMALL").alias("small"), count("MEDIUM").alias("medium"))
