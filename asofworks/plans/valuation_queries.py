"""Queries of valuation by grants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import valuation as V
from asofworks.plans.registry import Tables, query

#: Accounts stand for securities; what is odd about a day, a grant or an input follows from numbers of the account and the role.
ROLES = list(V.ROLE_UNITS)
DAYS_SQL = """cast(security_id as bigint) as security_id, trade_date, cast(security_id as bigint) as cik, case when (security_id + day(trade_date)) % 17 = 0 then null when (security_id + day(trade_date)) % 13 = 0 then 0 else close end as close,
    case when (security_id + day(trade_date)) % 34 = 0 then null when security_id % 29 = 0 then '' else 'USD' end as currency, case when security_id % 8 = 3 then 2 else 1 end as split_factor, trade_date as ready_on,
    case when security_id % 9 = 4 then date '2023-10-01' when security_id % 9 = 5 then date '2024-01-01' end as financial_anchor, case when security_id % 12 = 7 then date '2024-01-10' else date '2024-02-01' end as financial_as_of"""
GRANTS_SQL = """cast(s as bigint) as security_id, cast(s as bigint) as cik, case when s % 23 = 1 then null else 'common' end as stock_class_id, 'unadjusted' as split_basis_id, case when g = 1 and s % 4 = 0 then 'new' else 'issuer' end as financial_scope_id,
    case when s % 19 = 2 then 'OTHER' else 'EXACT_COMMON_CLASS_OR_APPROVED_ISSUER_AGGREGATION' end as valuation_scope, 'USD' as currency, cast(date '2024-01-02' + cast(s % 6 + 12 * g as int) as date) as known_on, date '2024-01-05' as ready_on, date '2024-01-01' as financial_anchor,
    case when s % 8 < 4 then 1 end as required_split_factor, s % 31 <> 3 as evidenced, g"""
INPUTS_SQL = """s, k, cast(s as bigint) as cik, case when h % 31 = 0 then 'UNAVAILABLE' else 'AVAILABLE' end as status, case when h % 62 = 0 then 'UPSTREAM' end as reason, case when h % 37 = 0 then 'EUR' else 'USD' end as currency, case when h % 41 = 0 then 'other' when g = 1 and s % 4 = 0 then 'new' else 'issuer' end as scope_id,
    case when h % 47 = 0 then 'B' else 'common' end as stock_class_id, cast(date '2024-01-01' + cast(h % 9 as int) as date) as known_on, cast(date '2024-01-01' + cast(h % 9 + h % 4 as int) as date) as ready_on, case when h % 43 = 0 then date '2023-10-01' when h % 67 = 0 then date '2024-03-01' else date '2024-01-01' end as period_end,
    case when h % 43 = 0 then date '2022-10-01' when h % 71 = 0 then date '2023-06-01' else date '2023-01-01' end as period_start, h % 73 <> 0 as sourced, s % 2 = 0 as evidenced_zero, case when h % 29 = 0 then 'GOVERNED_Q4_COMPONENT_TTM' when h % 29 = 1 then 'GUESS' else 'DIRECT_REPORTED' end as source_kind,
    case when s % 18 = 5 then 'ISSUED' else 'OUTSTANDING_COMMON_EX_TREASURY' end as share_measure, case when s % 18 = 6 then 'OTHER' else 'STANDARDIZED_CFO_MINUS_PPE_ACQUISITIONS' end as formula_id, case when h % 26 = 0 then 'GUESS' else 'REPORTED_CARRYING_VALUE' end as valuation_basis,
    case when s % 15 = 1 then 'ALL' else 'INTEREST_BEARING_INCLUDING_FINANCE_EXCLUDING_OPERATING_LEASES' end as debt_scope, 'CASH_AND_CASH_EQUIVALENTS' as cash_scope, 'OPERATING_INCOME_INCLUDED_DA' as da_scope, case when s % 10 = 3 and k = 11 then 'part' else 'total' end as ebitda_scope_id, cast(h % 40 - 4 as decimal(18,2)) as value, g"""
_ROWS = ", ".join(f"({k}, '{r}', '{u}')" for k, (r, u) in enumerate(V.ROLE_UNITS.items()))
_ROLE_WHY = """case when i.n is null then 'FINANCIAL_INPUT_NOT_BOUND' when i.n > 1 then 'AMBIGUOUS_FINANCIAL_INPUT' when i.status <> 'AVAILABLE' then coalesce(i.reason, 'FINANCIAL_INPUT_UNAVAILABLE') when r.role <> 'common_shares' and i.currency <> d.currency then 'UNIT_OR_CURRENCY_MISMATCH'
      when r.role = 'diluted_eps_12m' and i.source_kind = 'GOVERNED_Q4_COMPONENT_TTM' then 'CURRENT_Q4_EPS_EVALUATION_REQUIRED' when i.known_on > d.trade_date or i.ready_on > d.trade_date then 'INPUT_AFTER_PRICE_AS_OF' when not i.sourced then 'INPUT_LINEAGE_MISSING' when i.scope_id <> d.financial_scope_id then 'FINANCIAL_SCOPE_MISMATCH'
      when i.period_end > d.trade_date + 1 then 'FINANCIAL_PERIOD_AFTER_AS_OF' when r.role like '%_12m' and datediff('day', i.period_start, i.period_end) not between 350 and 378 then 'TWELVE_MONTH_PERIOD_REQUIRED'
      when r.role in ('common_shares', 'diluted_eps_12m', 'book_value_per_common_share') and i.stock_class_id <> d.stock_class_id then 'CLASS_OR_SPLIT_BASIS_MISMATCH' when r.role in ('preferred_equity', 'nci') and i.value = 0 and not i.evidenced_zero then 'EXPLICIT_ZERO_EVIDENCE_REQUIRED' when r.role = 'diluted_eps_12m' and i.source_kind = 'GUESS' then 'EPS_DIRECT_OBSERVATION_REQUIRED'
      when r.role = 'common_shares' and i.share_measure = 'ISSUED' then 'ACTUAL_OUTSTANDING_COMMON_REQUIRED' when r.role = 'standardized_fcf_12m' and i.formula_id = 'OTHER' then 'STANDARDIZED_FCF_DEFINITION_MISMATCH' when r.role like '%_12m' and i.period_end <> coalesce(d.financial_anchor, d.granted_anchor) then 'TWELVE_MONTH_INPUT_NOT_AT_LATEST_FINANCIAL_END' end"""
_EV_WHY = """case when interest_debt < 0 or preferred_equity < 0 or nci < 0 or cash_equivalents < 0 then 'EV_COMPONENT_NEGATIVE' when security_id % 15 = 1 then 'EV_COMPONENT_SCOPE_NOT_APPROVED' when guessed then 'FINANCING_VALUATION_BASIS_UNKNOWN' when ends > 1 then 'EV_COMPONENT_PERIOD_MISMATCH' end"""
C15_SQL = f"""with days as (select {DAYS_SQL} from prices), firms as (select distinct security_id as s from prices), grants as (select {GRANTS_SQL} from firms cross join (values (0), (1)) v(g) where g = 0 or s % 3 = 0),
    made as (select f.s as s, r.k as k, v.g as g, f.s * 13 + r.k * 7 + v.g * 5 as h from firms f cross join (values {_ROWS}) r(k, role, unit) cross join (values (0), (1)) v(g)),
    raw as (select {INPUTS_SQL} from made union all select {INPUTS_SQL} from made where h % 53 = 0),
    inputs as (select s, k, g, count(*) as n, {", ".join(f"any_value({c}) as {c}" for c in "status reason currency scope_id stock_class_id known_on ready_on period_end period_start sourced evidenced_zero source_kind share_measure formula_id valuation_basis ebitda_scope_id value".split())} from raw group by 1, 2, 3),
    held as (select d.*, x.g as g, x.stock_class_id as stock_class_id, x.financial_scope_id as financial_scope_id, x.valuation_scope as valuation_scope, x.financial_anchor as granted_anchor, x.required_split_factor as required_split_factor, x.evidenced as evidenced
      from days d left join grants x on x.security_id = d.security_id and x.known_on <= d.trade_date and not exists (select 1 from grants y where y.security_id = x.security_id and y.known_on <= d.trade_date and y.known_on > x.known_on)),
    priced as (select *, case when close is null and currency is null then 'EXACT_SESSION_PRICE_MISSING' when close is null or close <= 0 then 'PRICE_NONPOSITIVE_OR_MISSING' when coalesce(currency, '') = '' then 'PRICE_CURRENCY_UNKNOWN'
      when g is null or not evidenced or stock_class_id is null or valuation_scope = 'OTHER' then 'CLASS_CURRENCY_SPLIT_COMPATIBILITY_NOT_APPROVED' when required_split_factor <> split_factor then 'SPLIT_FACTOR_DIFFERENT_FROM_APPROVED_BASIS' when financial_as_of < trade_date then 'FINANCIAL_CUTOFF_BEFORE_PRICE_AS_OF' when financial_anchor <> granted_anchor then 'FINANCIAL_ANCHOR_SCOPE_NOT_APPROVED' end as price_reason from held),
    bound as (select d.security_id as security_id, d.trade_date as trade_date, r.k as k, r.role as role, {_ROLE_WHY} as why, i.value as value, i.valuation_basis as basis, i.period_end as period_end, case when i.n = 1 then i.ready_on end as ready_on, i.scope_id as scope, i.period_start as period_start from priced d cross join (values {_ROWS}) r(k, role, unit)
      left join inputs i on i.s = d.security_id and i.k = r.k and i.g = d.g and (d.security_id * 13 + r.k * 7 + d.g * 5) % 59 <> 0),
    wide as (select security_id, trade_date, {", ".join(f"cast(max(case when role = '{r}' then value end) as double) as {r}" for r in ROLES)}, bool_or(k in (6, 7, 8) and basis = 'GUESS') as guessed, count(distinct case when k between 6 and 9 then period_end end) as ends,
      count(distinct case when k in (10, 11) then period_end end) + count(distinct case when k in (10, 11) then period_start end) as spans from bound group by 1, 2),
    needs as (select * from (values {", ".join(f"('{m}', {p}, '{r}')" for m, roles in V.METRICS.items() for p, r in enumerate(roles))}) n(metric, place, role)),
    first as (select security_id, trade_date, metric, arg_min(why, place) filter (where why is not null) as why, bool_and(coalesce(ready_on <= trade_date, false)) as ready from bound join needs on needs.role = bound.role group by 1, 2, 3),
    v as (select p.*, w.* exclude (security_id, trade_date), f.metric as metric, f.why as role_reason, f.ready as ready, cast(close as double) as p, cast(close as double) * common_shares as cap from first f join priced p on p.security_id = f.security_id and p.trade_date = f.trade_date join wide w on w.security_id = f.security_id and w.trade_date = f.trade_date),
    e as (select *, cap + interest_debt + preferred_equity + nci - cash_equivalents as ev, operating_income_12m + depreciation_amortization_12m as ebitda from v),
    o as (select *, coalesce(price_reason, role_reason, case when metric in ('enterprise_value', 'ev_revenue', 'ev_ebitda') then {_EV_WHY} end,
      case when metric in ('common_market_cap', 'pbr', 'price_sales', 'standardized_fcf_yield', 'enterprise_value', 'ev_revenue', 'ev_ebitda') and common_shares <= 0 then 'COMMON_SHARES_NONPOSITIVE' when metric = 'per' and diluted_eps_12m <= 0 then 'EPS_NONPOSITIVE' when metric = 'pbr' and common_equity <= 0 then 'COMMON_EQUITY_NONPOSITIVE'
      when metric = 'pbr_bps' and book_value_per_common_share <= 0 then 'BPS_NONPOSITIVE' when metric in ('price_sales', 'ev_revenue') and revenue_12m <= 0 then 'REVENUE_NONPOSITIVE' when metric = 'ev_ebitda' and (security_id % 10 = 3 or spans <> 2) then 'EBITDA_SCOPE_OR_PERIOD_MISMATCH' when metric = 'ev_ebitda' and depreciation_amortization_12m < 0 then 'DA_NEGATIVE' when metric = 'ev_ebitda' and ebitda <= 0 then 'EBITDA_NONPOSITIVE' end) as why,
      case metric when 'common_market_cap' then cap when 'per' then p / diluted_eps_12m when 'pbr' then cap / common_equity when 'pbr_bps' then p / book_value_per_common_share when 'price_sales' then cap / revenue_12m when 'earnings_yield' then diluted_eps_12m / p * 100 when 'standardized_fcf_yield' then standardized_fcf_12m / cap * 100 when 'enterprise_value' then ev when 'ev_revenue' then ev / revenue_12m else ev / ebitda end as out from e)
    select security_id, cast(trade_date as varchar) as trade_date, metric, why as reason, case when why is null then out end as value, ready and trade_date >= date '2024-01-05' and g is not null as historical_ready from o"""


def _tables(t: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    fixed = lambda c: [F.lit(x).alias(c) for x in ("EXCLUSIVE",)]
    days = t.spark.sql(f"select {DAYS_SQL} from {{p}}", p=t.prices)
    firms = t.prices.select(F.col("security_id").alias("s")).distinct()
    twice = F.explode(F.array(F.lit(0), F.lit(1))).alias("g")
    ids = F.map_from_entries(F.filter(F.array(*[F.struct(F.lit(r).alias("role"), F.when((F.col("security_id") * 13 + k * 7 + F.col("g") * 5) % 59 != 0, F.concat_ws("-", "security_id", F.lit(str(k)), "g")).alias("id")) for k, r in enumerate(ROLES)]), lambda e: e["id"].isNotNull()))
    grants = t.spark.sql(f"select {GRANTS_SQL} from {{f}} where g = 0 or s % 3 = 0", f=firms.select("s", twice)).withColumn("input_ids", ids)
    roles = F.inline(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(r).alias("role"), F.lit(u).alias("unit_kind")) for k, (r, u) in enumerate(V.ROLE_UNITS.items())]))
    made = firms.select("s", twice).select("s", "g", roles).withColumn("h", F.col("s") * 13 + F.col("k") * 7 + F.col("g") * 5)
    made = made.unionByName(made.where("h % 53 = 0"))
    inputs = t.spark.sql(f"select role, unit_kind, {INPUTS_SQL} from {{m}}", m=made)
    duration = F.col("role").endswith("_12m")
    inputs = inputs.select("*", F.concat_ws("-", "s", "k", "g").alias("observation_id"), F.lit("unadjusted").alias("split_basis_id"), F.when(duration, "FY").otherwise("INSTANT").alias("period_class"), *fixed("end_convention"))
    return days, grants, inputs


@query("c15_valuation_grants", C15_SQL)
def c15_grants(t: Tables) -> DataFrame:
    rows = V.valuation(*_tables(t), ev_policy=V.EV_POLICY)
    return rows.select("security_id", F.col("trade_date").cast("string"), "metric", "reason", "value", "historical_ready")
