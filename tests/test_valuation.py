"""Valuation by grants: the full case, then one change at a time."""

import datetime as dt
from decimal import Decimal

import pytest
from asofworks.operators import valuation as V

D = dt.date
VALUES = {"common_shares": 10, "diluted_eps_12m": 2, "common_equity": 200, "book_value_per_common_share": 20, "revenue_12m": 400, "standardized_fcf_12m": -10, "interest_debt": 50, "preferred_equity": 0, "nci": 0, "cash_equivalents": 20, "operating_income_12m": 30, "depreciation_amortization_12m": 10}
DAY = "security_id string, trade_date date, cik string, close decimal(20,4), currency string, split_factor int, ready_on date, financial_anchor date, financial_as_of date"
GRANT = "security_id string, cik string, stock_class_id string, split_basis_id string, financial_scope_id string, valuation_scope string, currency string, known_on date, ready_on date, financial_anchor date, required_split_factor int, evidenced boolean, input_ids map<string,string>"
INPUT = "observation_id string, role string, cik string, value decimal(20,4), status string, reason string, unit_kind string, currency string, scope_id string, stock_class_id string, split_basis_id string, known_on date, ready_on date, period_start date, period_end date, end_convention string, period_class string, source_kind string, sourced boolean, share_measure string, formula_id string, evidenced_zero boolean, valuation_basis string, debt_scope string, cash_scope string, da_scope string, ebitda_scope_id string"


def day(**more):
    return {"security_id": "X", "trade_date": D(2026, 10, 23), "cik": "1", "close": Decimal(100), "currency": "USD", "split_factor": 1, "ready_on": D(2026, 10, 23), "financial_anchor": None, "financial_as_of": D(2026, 10, 25)} | more


def grant(**more):
    return {"security_id": "X", "cik": "1", "stock_class_id": "common", "split_basis_id": "u", "financial_scope_id": "issuer", "valuation_scope": V.COMMON_SCOPE, "currency": "USD", "known_on": D(2026, 10, 2), "ready_on": D(2026, 10, 2), "financial_anchor": D(2026, 10, 1), "required_split_factor": None, "evidenced": True, "input_ids": {r: r for r in VALUES}} | more


def observed(role, **more):
    long = role.endswith("_12m")
    return {"observation_id": role, "role": role, "cik": "1", "value": Decimal(VALUES[role]), "status": "AVAILABLE", "reason": None, "unit_kind": V.ROLE_UNITS[role], "currency": "USD", "scope_id": "issuer", "stock_class_id": "common", "split_basis_id": "u", "known_on": D(2026, 10, 1), "ready_on": D(2026, 10, 2), "period_start": D(2025, 10, 1) if long else None, "period_end": D(2026, 10, 1), "end_convention": "EXCLUSIVE",
            "period_class": "FY" if long else "INSTANT", "source_kind": "DIRECT_REPORTED", "sourced": True, "share_measure": V.SHARE_MEASURE, "formula_id": V.FCF_FORMULA, "evidenced_zero": True, "valuation_basis": "REPORTED_CARRYING_VALUE", "debt_scope": V.DEBT_SCOPE, "cash_scope": V.CASH_SCOPE, "da_scope": V.DA_SCOPE, "ebitda_scope_id": "total"} | more


def valued(spark, days=None, grants=None, changes=None, more=(), policy=V.EV_POLICY):
    make = lambda rows, schema: spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    inputs = [observed(r, **(changes or {}).get(r, {})) for r in VALUES] + list(more)
    rows = V.valuation(make(days or [day()], DAY), make([grant()] if grants is None else grants, GRANT), make(inputs, INPUT), policy).collect()
    return {r.metric if not days or len(days) == 1 else (r.metric, r.trade_date): r for r in rows}


def test_the_whole_case(spark):
    got = valued(spark)
    assert {m: r.value for m, r in got.items()} == {"common_market_cap": 1000.0, "per": 50.0, "pbr": 5.0, "pbr_bps": 5.0, "price_sales": 2.5, "earnings_yield": 2.0, "standardized_fcf_yield": -1.0, "enterprise_value": 1030.0, "ev_revenue": 2.575, "ev_ebitda": 25.75}
    assert all(r.reason is None and r.historical_ready for r in got.values()) and got["price_sales"].input_ids == ["common_shares", "revenue_12m"]


@pytest.mark.parametrize(("days", "grants", "reason"), [
    (day(close=None, currency=None), None, "EXACT_SESSION_PRICE_MISSING"), (day(close=Decimal(0)), None, "PRICE_NONPOSITIVE_OR_MISSING"), (day(currency=""), None, "PRICE_CURRENCY_UNKNOWN"),
    (day(), [], "CLASS_CURRENCY_SPLIT_COMPATIBILITY_NOT_APPROVED"), (day(), [grant(known_on=D(2026, 10, 24))], "CLASS_CURRENCY_SPLIT_COMPATIBILITY_NOT_APPROVED"), (day(), [grant(currency="EUR")], "CLASS_CURRENCY_SPLIT_COMPATIBILITY_NOT_APPROVED"), (day(), [grant(evidenced=False)], "CLASS_CURRENCY_SPLIT_COMPATIBILITY_NOT_APPROVED"),
    (day(), [grant(required_split_factor=2)], "SPLIT_FACTOR_DIFFERENT_FROM_APPROVED_BASIS"), (day(financial_as_of=D(2026, 10, 22)), None, "FINANCIAL_CUTOFF_BEFORE_PRICE_AS_OF"), (day(financial_anchor=D(2026, 7, 1)), None, "FINANCIAL_ANCHOR_SCOPE_NOT_APPROVED"),
])
def test_a_day_without_a_valuation(spark, days, grants, reason):
    assert {r.reason for r in valued(spark, [days], grants).values()} == {reason}


def test_reasons_of_inputs(spark):
    per = lambda **change: valued(spark, changes={"diluted_eps_12m": change})["per"].reason
    assert per(cik="2") == "INPUT_IDENTITY_MISMATCH" and per(status="NO", reason="WHY") == "WHY" and per(value=None) == "FINANCIAL_INPUT_UNAVAILABLE" and per(currency="EUR") == "UNIT_OR_CURRENCY_MISMATCH" and per(source_kind=V.EVALUATED_SOURCE) == "CURRENT_Q4_EPS_EVALUATION_REQUIRED"
    assert per(known_on=D(2026, 10, 24)) == per(ready_on=D(2026, 10, 24)) == per(known_on=None) == "INPUT_AFTER_PRICE_AS_OF" and per(sourced=False) == "INPUT_LINEAGE_MISSING" and per(scope_id="other") == "FINANCIAL_SCOPE_MISMATCH" and per(end_convention="X") == "FINANCIAL_PERIOD_UNKNOWN"
    assert per(period_end=D(2026, 12, 1)) == "FINANCIAL_PERIOD_AFTER_AS_OF" and per(period_start=D(2026, 1, 1)) == "TWELVE_MONTH_PERIOD_REQUIRED" and per(split_basis_id="v") == "CLASS_OR_SPLIT_BASIS_MISMATCH" and per(source_kind="GUESS") == "EPS_DIRECT_OBSERVATION_REQUIRED"
    assert per(period_start=D(2025, 7, 1), period_end=D(2026, 7, 1)) == "TWELVE_MONTH_INPUT_NOT_AT_LATEST_FINANCIAL_END" and per(value=Decimal(0)) == "EPS_NONPOSITIVE"
    got = valued(spark, changes={"nci": {"evidenced_zero": False}, "standardized_fcf_12m": {"formula_id": "X"}, "common_equity": {"value": Decimal(-1)}})
    assert (got["enterprise_value"].reason, got["standardized_fcf_yield"].reason, got["pbr"].reason, got["per"].reason) == ("EXPLICIT_ZERO_EVIDENCE_REQUIRED", "STANDARDIZED_FCF_DEFINITION_MISMATCH", "COMMON_EQUITY_NONPOSITIVE", None)
    twice = valued(spark, more=[observed("revenue_12m")])
    assert (twice["price_sales"].reason, twice["price_sales"].historical_ready, twice["per"].reason) == ("AMBIGUOUS_FINANCIAL_INPUT", False, None)
    unbound = valued(spark, grants=[grant(input_ids={"common_shares": "common_shares", "revenue_12m": "gone"})])
    assert (unbound["common_market_cap"].reason, unbound["price_sales"].reason, unbound["per"].reason) == (None, "FINANCIAL_INPUT_NOT_BOUND", "FINANCIAL_INPUT_NOT_BOUND")


def test_enterprise_value_policy(spark):
    ev = lambda policy=V.EV_POLICY, **changes: valued(spark, changes=changes, policy=policy)["ev_ebitda"].reason
    assert ev(policy=None) == "EV_POLICY_NOT_APPROVED" and ev(interest_debt={"value": Decimal(-1)}) == "EV_COMPONENT_NEGATIVE" and ev(interest_debt={"debt_scope": "X"}) == "EV_COMPONENT_SCOPE_NOT_APPROVED" and ev(nci={"valuation_basis": "X"}) == "FINANCING_VALUATION_BASIS_UNKNOWN"
    assert ev(interest_debt={"period_end": D(2026, 7, 1)}) == "EV_COMPONENT_PERIOD_MISMATCH" and ev(depreciation_amortization_12m={"ebitda_scope_id": "part"}) == "EBITDA_SCOPE_OR_PERIOD_MISMATCH" and ev(depreciation_amortization_12m={"value": Decimal(-1)}) == "DA_NEGATIVE" and ev(operating_income_12m={"value": Decimal(-30)}) == "EBITDA_NONPOSITIVE"


def test_the_newest_grant_known_by_the_day_counts(spark):
    days = [day(trade_date=D(2026, 10, d), financial_as_of=D(2026, 11, 1)) for d in (1, 5, 20)]
    got = valued(spark, days, [grant(), grant(known_on=D(2026, 10, 10), financial_scope_id="other")])
    assert [got["per", D(2026, 10, d)].reason for d in (1, 5, 20)] == ["CLASS_CURRENCY_SPLIT_COMPATIBILITY_NOT_APPROVED", None, "FINANCIAL_SCOPE_MISMATCH"]
