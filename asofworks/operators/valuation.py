"""Valuation of price days by approved inputs: grants bind exact input ids, and every metric has a value or its first reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: The roles of inputs with the kind of unit each has; those of twelve months; those that belong to a class of shares.
ROLE_UNITS = {
    "common_shares": "shares", "diluted_eps_12m": "currency/share", "common_equity": "currency", "book_value_per_common_share": "currency/share", "revenue_12m": "currency", "standardized_fcf_12m": "currency",
    "interest_debt": "currency", "preferred_equity": "currency", "nci": "currency", "cash_equivalents": "currency", "operating_income_12m": "currency", "depreciation_amortization_12m": "currency",
}
DURATIONS = ("diluted_eps_12m", "revenue_12m", "standardized_fcf_12m", "operating_income_12m", "depreciation_amortization_12m")
OF_CLASS = ("common_shares", "diluted_eps_12m", "book_value_per_common_share")
#: Metrics with the roles that each needs, in the order in which the first reason counts.
_EV = ("common_shares", "interest_debt", "preferred_equity", "nci", "cash_equivalents")
METRICS = {
    "common_market_cap": ("common_shares",), "per": ("diluted_eps_12m",), "pbr": ("common_shares", "common_equity"), "pbr_bps": ("book_value_per_common_share",), "price_sales": ("common_shares", "revenue_12m"), "earnings_yield": ("diluted_eps_12m",),
    "standardized_fcf_yield": ("common_shares", "standardized_fcf_12m"), "enterprise_value": _EV, "ev_revenue": (*_EV, "revenue_12m"), "ev_ebitda": (*_EV, "operating_income_12m", "depreciation_amortization_12m"),
}
#: Scopes, policies and sources that are accepted.
COMMON_SCOPE, EV_POLICY = "EXACT_COMMON_CLASS_OR_APPROVED_ISSUER_AGGREGATION", "ev-finance-lease-ex-operating-v1"
DEBT_SCOPE, CASH_SCOPE, DA_SCOPE = "INTEREST_BEARING_INCLUDING_FINANCE_EXCLUDING_OPERATING_LEASES", "CASH_AND_CASH_EQUIVALENTS", "OPERATING_INCOME_INCLUDED_DA"
FINANCING_BASES = ("REPORTED_CARRYING_VALUE", "OBSERVED_MARKET_VALUE", "REVIEWED_BOOK_CAPITAL_RESIDUAL_ZERO")
EPS_SOURCES, EVALUATED_SOURCE = ("DIRECT_REPORTED", "GOVERNED_DIRECT_QTD_TTM"), "GOVERNED_Q4_COMPONENT_TTM"
SHARE_MEASURE, FCF_FORMULA = "OUTSTANDING_COMMON_EX_TREASURY", "STANDARDIZED_CFO_MINUS_PPE_ACQUISITIONS"

#: Columns of a price day, of a grant, and of an input.
DAYS = "security_id, trade_date, cik, close, currency, split_factor, ready_on, financial_anchor, financial_as_of"
GRANTS = "security_id, cik, stock_class_id, split_basis_id, financial_scope_id, valuation_scope, currency, known_on, ready_on, financial_anchor, required_split_factor, evidenced, input_ids"
INPUTS = "observation_id, role, cik, value, status, reason, unit_kind, currency, scope_id, stock_class_id, split_basis_id, known_on, ready_on, period_start, period_end, end_convention, period_class, source_kind, sourced, share_measure, formula_id, evidenced_zero, valuation_basis, debt_scope, cash_scope, da_scope, ebitda_scope_id"


def _names(columns: str) -> list[str]:
    return columns.split(", ")


def keyed(grants: DataFrame) -> DataFrame:
    """(security_id, _key, _g): grants with a known day, once each; _key is all their columns as text."""
    g = F.struct(*_names(GRANTS))
    return grants.where(F.col("known_on").isNotNull()).select("security_id", F.to_json(g).alias("_key"), g.alias("_g")).dropDuplicates(["security_id", "_key"])


def inputs_of(grants: DataFrame, inputs: DataFrame) -> DataFrame:
    """(security_id, _key, _inputs): of each grant a map from each role to its input id, how many inputs have it (null: none), and one of them.

    Grants are far fewer than days, so inputs meet grants, and days only look them up.
    """
    roles = F.array(*[F.lit(r) for r in ROLE_UNITS])
    asked = keyed(grants).select("security_id", "_key", "_g.input_ids", F.explode(roles).alias("role"))
    asked = asked.select("security_id", "_key", "role", F.try_element_at("input_ids", F.col("role")).alias("id"))
    by = inputs.groupBy("observation_id").agg(F.count("*").alias("n"), F.first(F.struct(*_names(INPUTS))).alias("x")).withColumnRenamed("observation_id", "its")
    rows = asked.join(by, F.col("id") == F.col("its"), "left")
    return rows.groupBy("security_id", "_key").agg(F.map_from_entries(F.collect_list(F.struct("role", F.struct("id", "n", "x")))).alias("_inputs"))


def grants_as_of(days: DataFrame, grants: DataFrame, inputs: DataFrame) -> DataFrame:
    """days with g, the newest grant of the security that is known by the day, or null, and _inputs, what it binds.

    Days and grants of a security stand in one order by date; they are not
    paired.  Of grants known on one day the last by all their columns counts.
    """
    order = Window.partitionBy("security_id").orderBy("_at", "_kind", "_key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g = keyed(grants).join(inputs_of(grants, inputs), ["security_id", "_key"]).select("security_id", F.col("_g.known_on").alias("_at"), F.lit(0).alias("_kind"), "_key", F.struct("_g", "_inputs").alias("_held"))
    d = days.select("security_id", F.col("trade_date").alias("_at"), F.lit(1).alias("_kind"), F.struct(*_names(DAYS)).alias("_d"))
    rows = d.unionByName(g, allowMissingColumns=True).withColumn("_held", F.last("_held", ignorenulls=True).over(order))
    return rows.where("_kind = 1").select("_d.*", F.col("_held._g").alias("g"), F.col("_held._inputs").alias("_inputs"))


def _price_reason(g: Column) -> Column:
    """Why a day has no valuation at all: its price (a session without one has neither close nor currency), its grant, its basis or its cutoffs."""
    approved = (
        g.isNotNull() & F.coalesce(g["evidenced"], F.lit(False)) & g["cik"].eqNullSafe(F.col("cik")) & g["stock_class_id"].isNotNull() & g["financial_scope_id"].isNotNull() & g["split_basis_id"].isNotNull()
        & g["valuation_scope"].eqNullSafe(F.lit(COMMON_SCOPE)) & g["currency"].eqNullSafe(F.col("currency"))
    )
    return (
        F.when(F.col("close").isNull() & F.col("currency").isNull(), "EXACT_SESSION_PRICE_MISSING")
        .when(F.col("close").isNull() | (F.col("close") <= 0), "PRICE_NONPOSITIVE_OR_MISSING")
        .when(F.coalesce("currency", F.lit("")) == "", "PRICE_CURRENCY_UNKNOWN")
        .when(~approved, "CLASS_CURRENCY_SPLIT_COMPATIBILITY_NOT_APPROVED")
        .when(g["required_split_factor"].isNotNull() & ~g["required_split_factor"].eqNullSafe(F.col("split_factor")), "SPLIT_FACTOR_DIFFERENT_FROM_APPROVED_BASIS")
        .when(F.col("financial_as_of").isNull() | (F.col("financial_as_of") < F.col("trade_date")), "FINANCIAL_CUTOFF_BEFORE_PRICE_AS_OF")
        .when(F.col("financial_anchor").isNotNull() & ~g["financial_anchor"].eqNullSafe(F.col("financial_anchor")), "FINANCIAL_ANCHOR_SCOPE_NOT_APPROVED")
    )


def _role_reason(role: Column, x: Column, g: Column) -> Column:
    """Why the one input x of a role can't be used on a day under grant g."""
    day = F.col("trade_date")
    unit = F.try_element_at(F.create_map(*[F.lit(v) for pair in ROLE_UNITS.items() for v in pair]), role)
    duration, of_class = role.isin(*DURATIONS), role.isin(*OF_CLASS)
    same = lambda a, b: a.eqNullSafe(b)
    anchor = F.coalesce("financial_anchor", g["financial_anchor"])
    twelve = x["period_class"].isin("FY", "TTM") & F.datediff(x["period_end"], x["period_start"]).between(350, 378)
    return (
        F.when(~same(x["cik"], F.col("cik")) | ~same(x["role"], role), "INPUT_IDENTITY_MISMATCH")
        .when(~same(x["status"], F.lit("AVAILABLE")) | x["value"].isNull(), F.coalesce(x["reason"], F.lit("FINANCIAL_INPUT_UNAVAILABLE")))
        .when(~same(x["unit_kind"], unit) | ((role != "common_shares") & ~same(x["currency"], F.col("currency"))), "UNIT_OR_CURRENCY_MISMATCH")
        .when((role == "diluted_eps_12m") & same(x["source_kind"], F.lit(EVALUATED_SOURCE)), "CURRENT_Q4_EPS_EVALUATION_REQUIRED")
        .when(x["known_on"].isNull() | (x["known_on"] > day) | (x["ready_on"].isNotNull() & (x["ready_on"] > day)), "INPUT_AFTER_PRICE_AS_OF")
        .when(~F.coalesce(x["sourced"], F.lit(False)), "INPUT_LINEAGE_MISSING")
        .when(~same(x["scope_id"], g["financial_scope_id"]), "FINANCIAL_SCOPE_MISMATCH")
        .when(~same(x["end_convention"], F.lit("EXCLUSIVE")) | x["period_end"].isNull(), "FINANCIAL_PERIOD_UNKNOWN")
        .when(x["period_end"] > F.date_add(day, 1), "FINANCIAL_PERIOD_AFTER_AS_OF")
        .when(duration & ~F.coalesce(twelve, F.lit(False)), "TWELVE_MONTH_PERIOD_REQUIRED")
        .when(of_class & (~same(x["stock_class_id"], g["stock_class_id"]) | ~same(x["split_basis_id"], g["split_basis_id"])), "CLASS_OR_SPLIT_BASIS_MISMATCH")
        .when(role.isin("preferred_equity", "nci") & (x["value"] == 0) & ~F.coalesce(x["evidenced_zero"], F.lit(False)), "EXPLICIT_ZERO_EVIDENCE_REQUIRED")
        .when((role == "diluted_eps_12m") & ~F.coalesce(x["source_kind"].isin(*EPS_SOURCES), F.lit(False)), "EPS_DIRECT_OBSERVATION_REQUIRED")
        .when((role == "common_shares") & ~same(x["share_measure"], F.lit(SHARE_MEASURE)), "ACTUAL_OUTSTANDING_COMMON_REQUIRED")
        .when((role == "standardized_fcf_12m") & ~same(x["formula_id"], F.lit(FCF_FORMULA)), "STANDARDIZED_FCF_DEFINITION_MISMATCH")
        .when(duration & anchor.isNull(), "LATEST_FINANCIAL_ANCHOR_NOT_BOUND")
        .when(duration & (x["period_end"] != anchor), "TWELVE_MONTH_INPUT_NOT_AT_LATEST_FINANCIAL_END")
    )


def bind_roles(days: DataFrame, grants: DataFrame, inputs: DataFrame) -> DataFrame:
    """Every day with its grant, price_reason, and bound: of each role its input id, the one input of that id, and a reason or null.

    A grant names the exact id of each role's input.  An id that the grant
    doesn't name, or no input has, is FINANCIAL_INPUT_NOT_BOUND; one that several
    inputs have is AMBIGUOUS_FINANCIAL_INPUT, never the first of them.  What is
    known or ready only after the day doesn't count.
    """
    held = grants_as_of(days, grants, inputs).withColumn("price_reason", _price_reason(F.col("g")))
    def one(role: Column) -> Column:
        e = F.try_element_at("_inputs", role)
        why = F.when(e["n"].isNull(), "FINANCIAL_INPUT_NOT_BOUND").when(e["n"] > 1, "AMBIGUOUS_FINANCIAL_INPUT").otherwise(_role_reason(role, e["x"], F.col("g")))
        return F.struct(e["id"].alias("id"), why.alias("reason"), F.when(e["n"] == 1, e["x"]).alias("x"))

    bound = F.map_from_arrays(F.array(*[F.lit(r) for r in ROLE_UNITS]), F.transform(F.array(*[F.lit(r) for r in ROLE_UNITS]), one))
    return held.withColumn("bound", bound).drop("_inputs")


def valuation(days: DataFrame, grants: DataFrame, inputs: DataFrame, ev_policy: str | None = None) -> DataFrame:
    """Ten metrics of each day, each with a value or the first reason.

    The price's reason goes first, then that of the first role, in the metric's
    order, that has one; then for enterprise values the policy (ev_policy names
    the approved one), signs, scopes, bases and periods of their components; then
    signs of denominators.  input_ids are what the grant names, historical_ready
    says whether all was ready on the day.  One row for each day and metric; days
    of a security are unique.
    """
    rows = bind_roles(days, grants, inputs)
    literal = F.array(*[F.struct(F.lit(m).alias("metric"), F.array(*[F.lit(r) for r in roles]).alias("roles")) for m, roles in METRICS.items()])
    rows = rows.select("*", F.inline(literal))
    bound = lambda r: F.try_element_at("bound", r if isinstance(r, Column) else F.lit(r))
    x = lambda r: bound(r)["x"]
    v = lambda r: x(r)["value"].cast("double")
    first = F.get(F.filter(F.transform("roles", lambda r: bound(r)["reason"]), lambda w: w.isNotNull()), F.lit(0))
    of_ev = F.col("metric").isin("enterprise_value", "ev_revenue", "ev_ebitda")
    parts = ("interest_debt", "preferred_equity", "nci", "cash_equivalents")
    negative = (v(parts[0]) < 0) | (v(parts[1]) < 0) | (v(parts[2]) < 0) | (v(parts[3]) < 0)
    scopes = ~x("interest_debt")["debt_scope"].eqNullSafe(F.lit(DEBT_SCOPE)) | ~x("cash_equivalents")["cash_scope"].eqNullSafe(F.lit(CASH_SCOPE))
    known_bases = F.forall(F.array(*[x(r)["valuation_basis"] for r in parts[:3]]), lambda b: F.coalesce(b.isin(*FINANCING_BASES), F.lit(False)))
    periods = F.size(F.array_distinct(F.array(*[F.struct(x(r)["period_end"].alias("end"), x(r)["scope_id"].alias("scope")) for r in parts])))
    policy = (
        F.when(F.lit(ev_policy != EV_POLICY), "EV_POLICY_NOT_APPROVED").when(negative, "EV_COMPONENT_NEGATIVE").when(scopes, "EV_COMPONENT_SCOPE_NOT_APPROVED")
        .when(~known_bases, "FINANCING_VALUATION_BASIS_UNKNOWN").when(periods != 1, "EV_COMPONENT_PERIOD_MISMATCH")
    )
    income, written_off = x("operating_income_12m"), x("depreciation_amortization_12m")
    unlike = income["ebitda_scope_id"].isNull() | ~income["ebitda_scope_id"].eqNullSafe(written_off["ebitda_scope_id"]) | ~income["period_start"].eqNullSafe(written_off["period_start"]) | ~income["period_end"].eqNullSafe(written_off["period_end"]) | ~written_off["da_scope"].eqNullSafe(F.lit(DA_SCOPE))
    metric = F.col("metric")
    not_positive = lambda name, r, word: F.when((metric == name) & (v(r) <= 0), word)
    ebitda = v("operating_income_12m") + v("depreciation_amortization_12m")
    signs = F.coalesce(
        F.when(F.array_contains("roles", "common_shares") & (v("common_shares") <= 0), "COMMON_SHARES_NONPOSITIVE"), not_positive("per", "diluted_eps_12m", "EPS_NONPOSITIVE"), not_positive("pbr", "common_equity", "COMMON_EQUITY_NONPOSITIVE"),
        not_positive("pbr_bps", "book_value_per_common_share", "BPS_NONPOSITIVE"), not_positive("price_sales", "revenue_12m", "REVENUE_NONPOSITIVE"), not_positive("ev_revenue", "revenue_12m", "REVENUE_NONPOSITIVE"),
        F.when(metric == "ev_ebitda", F.when(unlike, "EBITDA_SCOPE_OR_PERIOD_MISMATCH").when(v("depreciation_amortization_12m") < 0, "DA_NEGATIVE").when(ebitda <= 0, "EBITDA_NONPOSITIVE")),
    )
    reason = F.coalesce("price_reason", first, F.when(of_ev, policy), signs)
    p = F.col("close").cast("double")
    cap = p * v("common_shares")
    ev = cap + v("interest_debt") + v("preferred_equity") + v("nci") - v("cash_equivalents")
    of = lambda a, b: F.try_divide(a, b)
    value = (
        F.when(metric == "common_market_cap", cap).when(metric == "per", of(p, v("diluted_eps_12m"))).when(metric == "earnings_yield", of(v("diluted_eps_12m"), p) * 100).when(metric == "pbr", of(cap, v("common_equity"))).when(metric == "pbr_bps", of(p, v("book_value_per_common_share")))
        .when(metric == "price_sales", of(cap, v("revenue_12m"))).when(metric == "standardized_fcf_yield", of(v("standardized_fcf_12m"), cap) * 100).when(metric == "enterprise_value", ev).when(metric == "ev_revenue", of(ev, v("revenue_12m"))).otherwise(of(ev, ebitda))
    )
    by_day = lambda c: F.coalesce(c <= F.col("trade_date"), F.lit(False))
    ready = by_day(F.col("ready_on")) & by_day(F.col("g.ready_on")) & F.forall("roles", lambda r: by_day(bound(r)["x"]["ready_on"]))
    rows = rows.withColumn("why", reason)
    return rows.select("security_id", "trade_date", "metric", F.when(F.col("why").isNull(), value).alias("value"), F.col("why").alias("reason"), F.transform("roles", lambda r: bound(r)["id"]).alias("input_ids"), ready.alias("historical_ready"))
