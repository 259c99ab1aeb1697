"""Queries of the price operators; the driver's events stand for prices and span 30 sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import prices as R
from asofworks.plans.registry import Tables, query

GRID_SQL = """placed as (select p.security_id as security_id, s.session as session, p.trade_date as trade_date, p.close as close from prices p join sessions s on p.trade_date = s.trade_date),
    span as (select security_id, min(session) as a, max(session) as b from placed group by security_id), places as (select security_id, unnest(generate_series(a, b)) as session from span),
    grid as (select g.security_id as security_id, g.session as session, p.trade_date as trade_date, p.close as close from places g left join placed p on g.security_id = p.security_id and g.session = p.session)"""


def grid(t: Tables) -> DataFrame:
    return R.price_grid(t.prices, R.session_calendar(t.prices))


@query("s11_session_calendar", "select cast(trade_date as varchar) as trade_date, session from sessions")
def s11(t: Tables) -> DataFrame:
    return R.session_calendar(t.prices).select(F.col("trade_date").cast("string"), "session")


@query("j7_price_grid", f"with {GRID_SQL} select security_id, session, cast(close as double) as close from grid")
def j7(t: Tables) -> DataFrame:
    return grid(t).select("security_id", "session", F.col("close").cast("double"))


#: The grid with some closes negative and some missing.
QUOTED_SQL = f"""{GRID_SQL}, quoted as (select security_id, session, trade_date, case when (security_id + session) % 13 = 0 then null when (security_id + session) % 11 = 0 then -close else close end as close from grid)"""


def quoted(t: Tables) -> DataFrame:
    place = F.col("security_id") + F.col("session")
    return grid(t).withColumn("close", F.when(place % 13 == 0, None).when(place % 11 == 0, -F.col("close")).otherwise(F.col("close")))


def window_sql(n: int, bad: str, why: str) -> str:
    return f"""case when session <= {n} then 'INSUFFICIENT_VERIFIED_SESSION_HISTORY' when count(trade_date) over z < {n + 1} then 'PRICE_SESSION_GAP' when count(*) filter (where {bad}) over z > 0 then '{why}' end"""


for n in (1, 5, 10):

    @query(
        f"w1_price_returns_{n}",
        f"""with {QUOTED_SQL}, r as (select *, {window_sql(n, "close is null or close <= 0", "CLOSE_MISSING_OR_NONPOSITIVE")} as reason, lag(close, {n}) over (partition by security_id order by session) as p from quoted window z as (partition by security_id order by session rows between {n} preceding and current row))
        select security_id, session, case when reason is null then (cast(close as double) / cast(p as double) - 1) * 100 end as "return", reason from r""",
    )
    def w1(t: Tables, n: int = n) -> DataFrame:
        return R.price_returns(quoted(t), n).select("security_id", "session", "return", "reason")


@query(
    "w2_volatility",
    f"""with {QUOTED_SQL}, l as (select *, lag(close) over (partition by security_id order by session) as p, {window_sql(5, "close is null or close <= 0", "CLOSE_MISSING_OR_NONPOSITIVE")} as reason from quoted window z as (partition by security_id order by session rows between 5 preceding and current row)),
    r as (select *, case when close > 0 and p > 0 then ln(cast(close as double)) - ln(cast(p as double)) end as lr from l)
    select security_id, session, reason, case when reason is null then round(stddev_samp(lr) over (partition by security_id order by session rows between 4 preceding and current row) * sqrt(252.0) * 100, 6) end as volatility from r""",
)
def w2(t: Tables) -> DataFrame:
    return R.volatility(quoted(t), 5).select("security_id", "session", "reason", F.round("volatility", 6).alias("volatility"))


@query(
    "w3_relative_volume",
    f"""with {QUOTED_SQL}, v as (select security_id, session, trade_date, case when (security_id + session) % 11 = 0 then close when (security_id + session) % 13 = 0 then null when security_id % 17 = 0 then 0 else close end as close from quoted),
    r as (select *, {window_sql(5, "false", "")} as gap, count(*) filter (where close is null or close < 0) over z as bad, cast(sum(close) over (partition by security_id order by session rows between 5 preceding and 1 preceding) as double) / 5 as m from v window z as (partition by security_id order by session rows between 5 preceding and current row)),
    s as (select *, coalesce(gap, case when security_id % 19 = 0 then 'VOLUME_SPLIT_BASIS_UNKNOWN' when bad > 0 then 'VOLUME_MISSING_OR_NEGATIVE' when m <= 0 then 'VOLUME_BASE_NONPOSITIVE' end) as reason from r)
    select security_id, session, reason, case when reason is null then cast(close as double) / m end as relative_volume from s""",
)
def w3(t: Tables) -> DataFrame:
    place = F.col("security_id") + F.col("session")
    volume = F.when(place % 11 == 0, F.col("close")).when(place % 13 == 0, None).when(F.col("security_id") % 17 == 0, 0).otherwise(F.col("close"))
    rows = R.relative_volume(quoted(t).withColumn("close", volume.cast("decimal(18,2)")), 5, "close", F.col("security_id") % 19 != 0)
    return rows.select("security_id", "session", "reason", "relative_volume")


@query(
    "w4_rolling_distribution",
    f"""with {GRID_SQL}, r as (select *, count(case when close > 0 then 1 end) over w as k, quantile_cont(cast(close as double), 0.25) over w as q25, quantile_cont(cast(close as double), 0.5) over w as q50 from grid window w as (partition by security_id order by session rows between 9 preceding and current row))
    select security_id, session, case when k = 10 then round(q25, 6) end as q25, case when k = 10 then round(q50, 6) end as q50, case when k <> 10 then 'WINDOW_INCOMPLETE' end as reason from r""",
)
def w4(t: Tables) -> DataFrame:
    q = lambda k: F.round(F.get("quantiles", F.lit(k)), 6)
    return R.rolling_distribution(grid(t), 10, "close").select("security_id", "session", q(1).alias("q25"), q(2).alias("q50"), "reason")


@query(
    "w5_missing_ranges",
    f"""with {GRID_SQL}, m as (select security_id, session, session - row_number() over (partition by security_id order by session) as island from grid where close is null)
    select security_id, 'SESSION_PRICE_MISSING' as reason, min(session) as first_session, max(session) as last_session, count(*) as sessions from m group by security_id, island""",
)
def w5(t: Tables) -> DataFrame:
    return R.missing_ranges(grid(t).withColumn("reason", F.when(F.col("close").isNull(), "SESSION_PRICE_MISSING")))


@query(
    "a15_multiple_percentiles",
    """select security_id, count(case when close > 0 then 1 end) as valid, count(*) as expected, case when count(case when close > 0 then 1 end) >= 20 then round(quantile_cont(case when close > 0 then cast(close as double) end, 0.1), 6) end as q10,
    case when count(case when close > 0 then 1 end) >= 20 then round(quantile_cont(case when close > 0 then cast(close as double) end, 0.9), 6) end as q90, case when count(case when close > 0 then 1 end) < 20 then 'INSUFFICIENT_VALID_VALUES' end as reason from prices group by security_id""",
)
def a15(t: Tables) -> DataFrame:
    q = lambda k: F.round(F.get("quantiles", F.lit(k)), 6)
    return R.percentiles(t.prices, ["security_id"], "close", 20).select("security_id", "valid", "expected", q(0).alias("q10"), q(4).alias("q90"), "reason")


@query(
    "a20_timeline_coverage",
    f"""with {GRID_SQL}, r as (select *, count(close) over (partition by security_id order by session rows between 4 preceding and current row) = 5 as f from grid) select session, count(close) as with_value, count(*) filter (where f) as with_distribution from r group by session""",
)
def a20(t: Tables) -> DataFrame:
    return R.timeline_coverage(grid(t), 5, "close")


@query("c16_fixed_bands", "select cik, fiscal_year, metric, m.multiple as multiple, case when value > 0 then cast(value as double) * m.multiple end as band from annual cross join (values (cast(0.5 as double)), (cast(2 as double)), (cast(12.5 as double))) m(multiple)")
def c16(t: Tables) -> DataFrame:
    return R.fixed_bands(t.annual, "value", [0.5, 2, 12.5]).select("cik", "fiscal_year", "metric", "multiple", "band")


@query("p18_query_prices_latest", "select security_id, cast(max(trade_date) as varchar) as trade_date, cast(arg_max(close, trade_date) as double) as close from prices where trade_date between date '2024-01-05' and date '2024-01-20' group by security_id")
def p18(t: Tables) -> DataFrame:
    rows = R.query_prices(t.prices, "latest", start="2024-01-05", end="2024-01-20")
    return rows.select("security_id", F.col("trade_date").cast("string"), F.col("close").cast("double"))


@query(
    "j6_bind_inputs",
    """with i as (select accession, cik, filed_date + 400 as known_on, amount from filings), d as (select distinct cik, date '1999-01-01' + cast(cik % 900 as integer) as day from filings),
    g as (select d.cik as cik, d.day as day, count(i.accession) as n, count(*) filter (where i.known_on <= d.day) as r, max(case when i.known_on <= d.day then i.accession end) as a from d left join i on d.cik = i.cik group by 1, 2)
    select cik, cast(day as varchar) as day, case when n = 0 then 'INPUT_MISSING' when r = 0 then 'INPUT_NOT_KNOWN' when r > 1 then 'INPUT_AMBIGUOUS' end as reason, cast(case when r = 1 then a end as varchar) as accession from g""",
)
def j6(t: Tables) -> DataFrame:
    inputs = t.filings.select("accession", "cik", F.date_add("filed_date", 400).alias("known_on"), "amount")
    days = t.filings.select("cik").distinct().withColumn("day", F.date_add(F.lit("1999-01-01").cast("date"), (F.col("cik") % 900).cast("int")))
    rows = R.bind_inputs(days, inputs, "accession", ["cik"], "known_on", "day")
    return rows.select("cik", F.col("day").cast("string"), "reason", F.col("input_accession").cast("string").alias("accession"))


@query(
    "c15_valuation",
    """with v as (select o.o_orderkey as id, cast(l.l_discount * 100 - 1 as decimal(18,2)) as price, cast(l.l_quantity as decimal(18,2)) as shares, cast(c.c_acctbal as decimal(18,2)) as earnings, cast(o.o_totalprice as decimal(18,2)) as revenue, cast(l.l_extendedprice as decimal(18,2)) as debt, l.l_linenumber as line
      from lineitem l join orders o on l.l_orderkey = o.o_orderkey join customer c on o.o_custkey = c.c_custkey),
    r as (select *, case when price is null or price <= 0 then 'PRICE_NONPOSITIVE_OR_MISSING' when shares is null then 'SHARES_MISSING' end as base, cast(price as double) * cast(shares as double) as cap from v)
    select count(*) as n, count(base) as no_cap, max(case when base is null then cap end) as top_cap, coalesce(base, case when earnings <= 0 then 'NON_POSITIVE_EARNINGS' end) as per_reason,
      max(case when base is null and earnings > 0 then cap / cast(earnings as double) end) as top_per, min(case when base is null then cap + cast(debt as double) - cast(earnings as double) end) as least_ev from r group by 4""",
)
def c15(t: Tables) -> DataFrame:
    dec = lambda c: F.col(c).cast("decimal(18,2)")
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select((F.col("l_discount") * 100 - 1).cast("decimal(18,2)").alias("price"), dec("l_quantity").alias("shares"), dec("c_acctbal").alias("earnings"), dec("o_totalprice").alias("revenue"), dec("l_extendedprice").alias("debt"))
    out = R.valuation(rows, "price", "shares", "earnings", "earnings", "revenue", "debt", "earnings")
    return out.groupBy("per_reason").agg(F.count("*").alias("n"), F.count("market_cap_reason").alias("no_cap"), F.max("market_cap").alias("top_cap"), F.max("per").alias("top_per"), F.min("ev").alias("least_ev"))
