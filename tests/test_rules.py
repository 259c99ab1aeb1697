"""Rules of single operators on small tables."""

import datetime as dt
from decimal import Decimal

import pytest
from asofworks.functions import scalars as S
from asofworks.operators import calculation, composed, graph, metrics, panels, periods, prices, quarters, registry, screening, selection, setops
from asofworks.sources import tables
from pyspark.sql import functions as F

D = dt.date


def one(spark, column, **values):
    kinds = {str: "string", int: "long", float: "double", D: "date", bool: "boolean", type(None): "string", Decimal: "decimal(20,4)"}
    schema = ", ".join(f"{k} {kinds[type(v)]}" for k, v in values.items()) or "x int"
    return spark.createDataFrame([tuple(values.values()) or (1,)], schema).select(column.alias("r")).first().r


@pytest.mark.parametrize(("text", "want"), [("--12-28", (12, 28)), ("2024-09-30", (9, 30)), ("06-30", (6, 30)), ("3/31", (3, 31)), ("soon", None), (None, None)])
def test_fiscal_year_end(spark, text, want):
    got = one(spark, S.fiscal_year_end("t"), t=text)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(("text", "want"), [("20251031", D(2025, 10, 31)), (" 2025-02-03 ", D(2025, 2, 3)), ("", None), ("2025-02-31", None), ("x", None)])
def test_filing_date(spark, text, want):
    assert one(spark, S.filing_date("t"), t=text) == want


@pytest.mark.parametrize(("value", "want"), [("320193", "0000320193"), ("1234567890", "1234567890"), ("12345678901", None), ("12.5", None), ("", None)])
def test_canonical_cik(spark, value, want):
    assert one(spark, S.canonical_cik("c"), c=value) == want


@pytest.mark.parametrize(("text", "want"), [("1.5", Decimal("1.5")), ("NaN", None), ("Infinity", None), ("abc", None), ("-0.00000001", Decimal("-0.00000001"))])
def test_finite_decimal(spark, text, want):
    assert one(spark, S.finite_decimal("t"), t=text) == want


@pytest.mark.parametrize(
    ("current", "prior", "status", "rate"),
    [("12", "10", "RATE_AVAILABLE", 20.0), ("0", "10", "ZERO_REACHED", -100.0), ("5", "0", "ZERO_BASE", None), ("0", "0", "ZERO_UNCHANGED", None), ("5", "-5", "POSITIVE_TURN", None), ("-5", "5", "NEGATIVE_TURN", None),
     ("-4", "-5", "NEGATIVE_MAGNITUDE_REDUCED", None), ("-6", "-5", "NEGATIVE_MAGNITUDE_EXPANDED", None), ("-5", "-5", "NEGATIVE_MAGNITUDE_UNCHANGED", None)],
)
def test_growth(spark, current, prior, status, rate):
    got = one(spark, S.growth("c", "p"), c=Decimal(current), p=Decimal(prior))
    assert got.status == status and got.rate == rate and got.delta == Decimal(current) - Decimal(prior)


def test_intervals(spark):
    rounded = one(spark, S.interval("v", F.col("d")), v=100.0, d="-1")
    assert tuple(rounded) == (95.0, 105.0) and tuple(one(spark, S.interval("v", F.col("d")), v=3.0, d="INF")) == (3.0, 3.0)
    assert one(spark, S.interval_divide(S.interval("v", F.col("d")), S.interval("w", F.col("d"))), v=4.0, w=0.0, d="0") is None
    assert tuple(one(spark, S.interval_multiply(S.interval("v", F.col("d")), S.interval("w", F.col("d"))), v=2.0, w=-3.0, d="INF")) == (-6.0, -6.0)


def test_measures_labels_and_namespaces(spark):
    assert one(spark, S.parse_measures("t"), t='["iso4217:USD", "a"]') == ["a", "iso4217:USD"]
    assert one(spark, S.parse_measures("t"), t="xbrli:shares  iso4217:USD") == ["iso4217:USD", "xbrli:shares"]
    assert one(spark, S.is_currency(S.parse_measures("t")), t="iso4217:USD") is True
    assert one(spark, S.split_label("t"), t="us-gaap:NetIncomeLoss") == "Net Income Loss"
    assert one(spark, S.gaap_namespace_year("t"), t="http://fasb.org/us-gaap/2023") == 2023
    for uri in ("http://example.com/us-gaap/2023", "http://xbrl.us/us-gaap/2009-01-31", "http://fasb.org/us-gaap/2023-02-30", "http://fasb.org/us-gaap/2023x", "http://fasb.org/us-gaap/2023\n"):
        assert one(spark, S.gaap_namespace_year("t"), t=uri) is None
    assert one(spark, S.gaap_namespace_year("t"), t="HTTPS://FASB.org/us-gaap/2019-01-31") == 2019
    assert one(spark, S.statement_type("t"), t="CONSOLIDATED STATEMENTS OF CASH FLOWS AND INCOME") == "CF"
    assert [one(spark, S.statement_type("t"), t=t) for t in ("Statement of Shareholders' Investment", "Stockholder accounts", "Notes")] == ["EQ", "EQ", None]
    a, b = (one(spark, S.stable_id("p-", *c), x="1", y="2") for c in (("x", "y"), ("y", "x")))
    assert a == b and len(a) == 26


def test_spine_and_weights(spark):
    got = one(spark, S.quarter_spine("d", 3), d=D(2025, 8, 15))
    assert got == [D(2024, 10, 1), D(2025, 1, 1), D(2025, 4, 1)]
    assert one(spark, S.share_weight("s", "e", "DAY"), s=D(2025, 1, 1), e=D(2025, 4, 1)) == 90.0
    assert one(spark, S.share_weight("s", "e", "MONTH"), s=D(2025, 1, 1), e=D(2025, 4, 1)) == 3.0
    assert one(spark, S.share_weight("s", "e", "MONTH"), s=D(2025, 1, 1), e=D(2025, 4, 2)) is None
    assert one(spark, S.share_weight("s", "e", "EQUAL_QUARTER"), s=D(2025, 1, 1), e=D(2025, 10, 1)) == 3.0


@pytest.mark.parametrize(
    ("start", "end", "period", "comparative"),
    [(D(2025, 6, 29), D(2025, 9, 27), "QTD_3M", "CURRENT_FOCUS"), (D(2024, 12, 29), D(2025, 9, 27), "YTD_9M", "CURRENT_FOCUS"), (D(2023, 12, 31), D(2024, 9, 28), "YTD_9M", "PRIOR_YEAR_COMPARABLE"), (D(2025, 1, 1), D(2025, 2, 1), "OTHER_DURATION", "OTHER_COMPARATIVE_CONTEXT"),
     (D(2025, 6, 29), D(2025, 9, 28), "QTD_3M", "CURRENT_FOCUS")],
)
def test_period_classes(spark, start, end, period, comparative):
    rows = spark.createDataFrame([(start, end, D(2025, 9, 27))], "s date, e date, f date").withColumn("c", periods.classify_period("s", "e"))
    got = rows.select("c", periods.comparative_type("e", "c", "f").alias("k")).first()
    assert (got.c, got.k) == (period, comparative)


def test_instants_and_annual_boundaries(spark):
    rows = spark.createDataFrame([(D(2024, 12, 28), D(2025, 9, 27), "INSTANT")], "e date, f date, c string")
    assert rows.select(periods.comparative_type("e", "c", "f", F.lit(12), F.lit(28)).alias("k")).first().k == "PRIOR_FY_BALANCE"
    case = lambda s, e, form, focus, report: one(spark, periods.classify_annual("s", "e", "form", "focus", "r", "m", "d"), s=s, e=e, form=form, focus=focus, r=report, m=12, d=31)
    assert case(D(2024, 1, 1), D(2025, 1, 1), "10-K", "FY", D(2024, 12, 31)).period_class == "FY"
    assert case(D(2024, 7, 1), D(2025, 7, 1), "10-Q", "Q2", D(2025, 6, 30)).period_class == "TTM"
    assert case(D(2024, 1, 20), D(2025, 1, 1), "10-K", "FY", D(2024, 12, 31)).reason == "ANNUAL_START_BOUNDARY_MISMATCH"


def test_reported_views(spark):
    rows = spark.createDataFrame([("c", D(2025, 5, 1), 1, 1, 100), ("c", D(2025, 6, 1), 2, 2, 120), ("d", D(2025, 9, 1), 3, 3, 7)], "concept string, filed_date date, accession long, fact_id long, value long")
    first = {r.concept: (r.value, r.status) for r in selection.select_reported(rows, ["concept"], "2025-07-01", "AS_FILED").collect()}
    last = {r.concept: (r.value, r.status) for r in selection.select_reported(rows, ["concept"], "2025-07-01", "LATEST_REPORTED").collect()}
    assert first == {"c": (100, "AVAILABLE"), "d": (None, "UNAVAILABLE")} and last["c"] == (120, "AVAILABLE")


def test_quarter_from_a_pair(spark):
    facts = [(1, "k", D(2024, 1, 1), D(2025, 1, 1), D(2025, 2, 1), 100, "FY"), (2, "k", D(2024, 1, 1), D(2024, 10, 1), D(2024, 11, 1), 70, "YTD_9M"), (3, "m", D(2024, 1, 1), D(2025, 1, 1), D(2025, 2, 1), 100, "FY"),
             (4, "m", D(2024, 1, 1), D(2024, 10, 1), D(2024, 11, 1), 70, "YTD_9M"), (5, "m", D(2024, 1, 1), D(2024, 9, 28), D(2024, 11, 1), 60, "YTD_9M")]
    df = spark.createDataFrame(facts, "fact_id long, scope string, start_date date, end_date date, filed_date date, value long, period_class string")
    got = {(r.scope, r.earlier_fact_id): (r.value, r.reason) for r in quarters.derive_quarter(df, ["scope"], "FY", "YTD_9M", "2025-06-01").collect()}
    assert got == {("k", 2): (30, None), ("m", 4): (None, "AMBIGUOUS_PAIR"), ("m", 5): (None, "AMBIGUOUS_PAIR")}
    early = quarters.derive_quarter(df.where("scope = 'k'"), ["scope"], "FY", "YTD_9M", "2025-01-15").first()
    assert early.reason == "NOT_FILED_AS_OF" and early.value is None


def test_ttm_needs_four_contiguous_compatible_quarters(spark):
    rows = [("a", k, 10, "u") for k in (1, 2, 3, 4, 6, 7)] + [("b", k, 10, "u" if k < 4 else "v") for k in range(1, 5)]
    got = {(r.k, r.c): (r.ttm, r.reason) for r in quarters.ttm(spark.createDataFrame(rows, "k string, c long, value long, unit string"), ["k"], "c", same=["unit"]).collect()}
    assert got[("a", 4)] == (40, None) and got[("a", 7)][1] == got[("a", 3)][1] == "INPUTS_NOT_CONTIGUOUS" and got[("b", 4)] == (None, "INPUTS_NOT_COMPATIBLE")


def test_a_missing_quarter_is_never_summed_away(spark):
    rows = spark.createDataFrame([("a", k, None if k == 2 else 10, 1) for k in range(1, 7)], "k string, c long, value long, scope long")
    got = {r.c: (r.ttm, r.reason) for r in quarters.ttm(rows, ["k"], "c").collect()}
    assert got[4] == got[5] == (None, "INPUT_UNAVAILABLE") and got[6] == (40, None)
    margin = {r.c: (r.margin, r.reason) for r in quarters.ttm_margin(rows, rows, ["k"], "c").collect()}
    assert margin[5] == (None, "INPUT_UNAVAILABLE") and margin[6] == (100.0, None)
    four = {a: metrics.four_quarters(rows, ["k"], "c", a).first() for a in (3, 5, 6)}
    assert [(four[a].total, four[a].reason) for a in (3, 5, 6)] == [(None, "MISSING"), (None, "INPUT_UNAVAILABLE"), (40, None)]
    mapping = spark.createDataFrame([(1, "x")], "scope long, canonical_scope string")
    assert [panels.eps_ttm_reviewed(rows, mapping, ["k"], "c", a).select("total", "reason").first() for a in (5, 6)] == [(None, "INPUT_UNAVAILABLE"), (40, None)]


def test_calculation_checks_by_the_rules(spark):
    arcs = spark.createDataFrame([("f", "p", "x", 1, 1), ("f", "p", "y", -1, 2), ("f", "q", "x", 1, 1), ("f", "d", "x", 1, 1), ("f", "d", "x", 1, 2), ("f", "w", "x", None, 1), ("f", "o", "z", 1, 1), ("g", "p", "x", 1, 1)], "filing string, parent string, child string, weight int, place int")
    values = {1: (5, 8, 3), 2: (8, 8, "none"), 4: (None, 1, 1), 5: (5, 8, 2), 6: (5, "none", "none"), 7: (1, 8, None)}
    facts = [("f", s, n, v) for s, row in values.items() for n, v in zip("pxy", row, strict=True) if v != "none"]
    facts += [("f", 3, "p", 5), ("f", 3, "x", 8), ("f", 3, "x", 8), ("f", 3, "y", 3), ("f", 8, "p", 1), ("f", 8, "p", 1), ("f", 1, "d", 16), ("f", 1, "w", 8), ("f", 1, "o", 8)]
    facts = spark.createDataFrame(facts, "filing string, s long, node string, value long")
    rows = calculation.calculation_checks(facts, arcs, ["s"], "node", "value", filing=["filing"], order=["place"]).collect()
    got = {(r.filing, r.s, r.parent): r.status for r in rows}
    assert len(rows) == len(got) == 13
    assert {k: got["f", k, "p"] for k in range(1, 9)} == {1: "MATCH", 2: "INCOMPATIBLE_SCOPE", 3: "AMBIGUOUS_INPUT", 4: "NONFINITE_OR_NIL_PARENT", 5: "MISMATCH", 6: "INCOMPATIBLE_SCOPE", 7: "NONFINITE_OR_NIL_INPUT", 8: "AMBIGUOUS_PARENT"}
    assert (got["f", None, "q"], got["g", None, "p"], got["f", 1, "d"], got["f", 1, "w"], got["f", 1, "o"]) == ("MISSING_PARENT", "MISSING_PARENT", "DUPLICATE_RELATIONSHIP_INPUT", "INVALID_WEIGHT", "MISSING_INPUT")
    by = {(r.s, r.parent): r for r in rows if r.filing == "f"}
    assert (by[5, "p"].calculated, by[5, "p"].difference, by[8, "p"].calculated) == (6, 1, None) and by[8, "p"].issues == ["AMBIGUOUS_PARENT", "INCOMPATIBLE_SCOPE"]


def test_interval_checks_reject_cycles_and_unsupported_arcs(spark):
    arcs = [("n", "p", "x", 1), ("n", "p", "y", -1), ("n", "a", "b", 1), ("n", "b", "c", 1), ("n", "c", "b", 1), ("n", "z", "x", 0), ("n", "t", "x", 1), ("n", "t", "x", 1), ("n", "m", "x", 1), ("n", "m", "gone", 1), ("m", "a", "b", 1)]
    arcs = spark.createDataFrame(arcs, "net string, parent string, child string, weight int")
    facts = spark.createDataFrame([(1, n, lo, hi) for n, lo, hi in [("p", 1, 2), ("x", 5, 6), ("y", 3, 4), ("a", 7, 7), ("b", 7, 7), ("c", 7, 7), ("z", 0, 0), ("t", 10, 12), ("m", 5, 6)]] + [(2, "p", 9, 9), (2, "x", 5, 6), (2, "x", 6, 7), (2, "y", -4, -4)], "s long, node string, lo long, hi long")
    rows = calculation.interval_checks(facts, arcs, ["s"], "node", ["net"]).collect()
    got = {(r.net, r.s, r.parent): r.status.removeprefix("CALCULATION_") for r in rows}
    assert got == {("n", 1, "p"): "VERIFIED", ("n", 2, "p"): "ROUNDING_MISMATCH", ("n", 1, "a"): "NETWORK_CYCLE", ("n", 1, "b"): "NETWORK_CYCLE", ("n", 1, "c"): "NETWORK_CYCLE", ("n", 1, "z"): "CHILD_IDENTITY_OR_WEIGHT_UNSUPPORTED",
                   ("n", 1, "t"): "CHILD_IDENTITY_OR_WEIGHT_UNSUPPORTED", ("n", 1, "m"): "CHILD_FACT_MISSING_IN_EQUIVALENT_CONTEXT", ("m", 1, "a"): "VERIFIED"}


def test_a_hierarchy_loses_no_arc(spark):
    arcs = [("t", "r", "a"), ("t", "r", "b"), ("t", "a", "c"), ("t", "b", "c"), ("t", "c", "d"), ("c", "y", "x"), ("c", "x", "y"), ("c", "x", "leaf"), ("s", "o", "o"), ("m", "r", "a"), ("m", "q", "p"), ("m", "p", "q"), ("m", "v", "u"), ("m", "u", "v")]
    rows = calculation.statement_hierarchy(spark.createDataFrame(arcs, "net string, parent string, child string"), ["net"]).collect()
    got = {(r.net, r.parent, r.child): (r.depth, r.entry_kind) for r in rows}
    assert len(rows) == len(arcs) == len(got)
    assert got == {("t", "r", "a"): (1, "ROOT"), ("t", "r", "b"): (1, "ROOT"), ("t", "a", "c"): (2, "ROOT"), ("t", "b", "c"): (2, "ROOT"), ("t", "c", "d"): (3, "ROOT"), ("c", "x", "y"): (1, "CYCLE"), ("c", "x", "leaf"): (1, "CYCLE"), ("c", "y", "x"): (2, "CYCLE"), ("s", "o", "o"): (1, "CYCLE"),
                   ("m", "r", "a"): (1, "ROOT"), ("m", "p", "q"): (1, "CYCLE"), ("m", "q", "p"): (2, "CYCLE"), ("m", "u", "v"): (1, "CYCLE"), ("m", "v", "u"): (2, "CYCLE")}
    assert calculation.statement_hierarchy(spark.createDataFrame([], "net string, parent string, child string"), ["net"]).count() == 0


def test_amendments_by_name_blank_name_and_description(spark):
    rows = [("a", "10-K", D(2020, 2, 1), None, None, None, None), ("b", "10-K/A", D(2020, 3, 1), None, "  ", None, "TRUE"), ("c", "10-K/A", D(2020, 3, 2), None, "z", "0000000001-20-000001", "false"), ("d", "10-K/A", D(2020, 3, 3), D(2019, 1, 1), "", "Amendment No. 2 of 0000000001-20-000001, see 0000000001-20-000001", None),
            ("e", "10-K/A", D(2020, 3, 4), D(2019, 1, 1), None, "0000000001-20-000001 0000000001-20-000002", "1")]
    df = spark.createDataFrame([(1, *r) for r in rows], "cik long, accession string, form string, filed_date date, report_date date, named string, said string, flag string")
    got = {r.accession: (r.link_method, r.amends, r.reported_ordinal, r.flag_state) for r in periods.filing_ledger(df, "named", "said", "flag").collect()}
    assert got == {"a": ("NOT_AN_AMENDMENT", None, None, "NOT_REPORTED"), "b": ("FORM_REPORT_DATE_COMPATIBLE_CANDIDATE", "a", None, "REPORTED_TRUE"), "c": ("RAW_FILING_AMENDS_ACCESSION", "z", None, "REPORTED_FALSE"),
                   "d": ("DEI_DESCRIPTION_ACCESSION", "0000000001-20-000001", "2", "NOT_REPORTED"), "e": ("UNKNOWN", None, None, "REPORTED_TRUE")}


def test_annual_metrics_by_the_rules(spark):
    def case(**values):
        rows = [(1, y, r, v, f) for (r, y), (v, f) in {(k.rsplit("_", 1)[0], int(k.rsplit("_", 1)[1])): v if isinstance(v, tuple) else (v, 1) for k, v in values.items()}.items()]
        df = spark.createDataFrame(rows, "cik long, y long, role string, value long, f long")
        return {(r.metric, r.y): (r.value, r.reason) for r in metrics.annual_metrics(df, "cik", "y", "role", filing="f").collect()}

    got = case(revenue_1=80, revenue_2=100, operating_income_2=-20, net_income_2=5, cfo_2=10, capex_2=30, equity_2=0, liabilities_2=50, debt_2=5, cash_2=9, assets_2=-1, current_assets_2=-1, current_liabilities_2=4, gross_profit_2=(50, 2))
    want = {"operating_margin": (-20.0, None), "net_margin": (5.0, None), "standardized_fcf": (-20.0, None), "fcf_margin": (-20.0, None), "liabilities_to_equity": (None, "NON_POSITIVE_DENOMINATOR"), "net_debt": (-4.0, None), "revenue_yoy": (25.0, None),
            "liabilities_to_assets": (None, "NON_POSITIVE_DENOMINATOR"), "current_ratio": (None, "NEGATIVE_NUMERATOR"), "gross_margin": (None, "SOURCE_FILING_MISMATCH"), "research": (None, "MISSING_INPUT"), "revenue": (100.0, None)}
    assert {k: got[k, 2] for k in want} == want
    assert got["revenue_yoy", 1] == (None, "MISSING_INPUT") and len(got) == 62
    got = case(liabilities_1=5, equity_1=-1, cfo_1=1, capex_1=-1, debt_1=-1, cash_1=1, revenue_1=(None, 1), net_income_1=3, revenue_3=5)
    assert (got["liabilities_to_equity", 1][1], got["standardized_fcf", 1][1], got["fcf_margin", 1][1], got["net_debt", 1][1], got["net_margin", 1][1], got["revenue_yoy", 3][1]) == ("NEGATIVE_EQUITY", "CAPEX_SIGN_UNCERTAIN", "CAPEX_SIGN_UNCERTAIN", "NEGATIVE_BALANCE_COMPONENT", "MISSING_INPUT", "MISSING_INPUT")
    twice = spark.createDataFrame([(1, 1, "cash", 1, 1), (1, 1, "cash", 1, 1)], "cik long, y long, role string, value long, f long")
    assert {r.metric: r.reason for r in metrics.annual_metrics(twice, "cik", "y", "role", filing="f").collect()}["cash"] == "MULTIPLE_CANDIDATES"


def test_amendments_link_by_report_date_and_need_review(spark):
    rows = [(1, 10, "10-K", D(2020, 2, 1), D(2019, 12, 31), None), (1, 11, "10-K", D(2021, 2, 1), D(2020, 12, 31), None), (1, 12, "10-K/A", D(2021, 3, 1), D(2019, 12, 31), None), (1, 13, "10-K/A", D(2021, 3, 2), D(2018, 12, 31), None), (1, 14, "10-K/A", D(2021, 3, 3), D(2018, 12, 31), 11),
            (1, 15, "10-K", D(2021, 3, 1), D(2019, 12, 31), None), (1, 16, "10-K/A", D(2021, 4, 1), D(2019, 12, 31), None)]
    df = spark.createDataFrame(rows, "cik long, accession long, form string, filed_date date, report_date date, named long")
    got = {r.accession: (r.link_state, r.amends, r.review_status) for r in periods.filing_ledger(df, "named").collect()}
    assert got == {10: ("NOT_APPLICABLE", None, "NOT_REQUIRED"), 11: ("NOT_APPLICABLE", None, "NOT_REQUIRED"), 15: ("NOT_APPLICABLE", None, "NOT_REQUIRED"), 12: ("CANDIDATE", 10, "REVIEW_REQUIRED"), 13: ("UNKNOWN", None, "UNKNOWN"), 14: ("LINKED", 11, "NOT_REQUIRED"), 16: ("UNKNOWN", None, "UNKNOWN")}


def test_prices_on_260_sessions(spark):
    days = [(1, D(2025, 1, 1) + dt.timedelta(days=2 * k), Decimal(100 + k), 200 if k == 259 else 100) for k in range(260) if k != 100]
    df = spark.createDataFrame(days, "security_id long, trade_date date, close decimal(18,2), volume long")
    calendar = prices.session_calendar(spark.createDataFrame([(D(2025, 1, 1) + dt.timedelta(days=2 * k),) for k in range(260)], "trade_date date"))
    grid = prices.price_grid(df, calendar)
    assert grid.count() == 260
    r = {x.session: x for x in prices.price_returns(grid, 21).collect()}
    assert r[260]["return"] == pytest.approx((359 / 338 - 1) * 100) and r[105].reason == "PRICE_SESSION_GAP" and r[21].reason == "INSUFFICIENT_VERIFIED_SESSION_HISTORY" and r[22].reason is None
    v = {x.session: (x.relative_volume, x.reason) for x in prices.relative_volume(grid, 20, "volume").collect()}
    assert v[260] == (2.0, None) and v[110] == (None, "PRICE_SESSION_GAP")
    unknown = prices.relative_volume(grid, 20, "volume", F.lit(False)).where("session = 260").first()
    assert unknown.reason == "VOLUME_SPLIT_BASIS_UNKNOWN" and unknown.relative_volume is None
    bad = grid.withColumn("close", F.when(F.col("session") != 200, F.col("close"))).withColumn("volume", F.when(F.col("session") == 200, -1).otherwise(0))
    assert prices.price_returns(bad, 5).where("session = 203").first().reason == "CLOSE_MISSING_OR_NONPOSITIVE" == prices.volatility(bad, 5).where("session = 205").first().reason
    w = {x.session: x.reason for x in prices.relative_volume(bad, 20, "volume").collect()}
    assert w[210] == "VOLUME_MISSING_OR_NEGATIVE" and w[250] == "VOLUME_BASE_NONPOSITIVE"
    assert prices.missing_ranges(grid.withColumn("reason", F.when(F.col("close").isNull(), "GAP"))).first().first_session == 101


def test_valuation_by_the_formulas(spark):
    row = spark.createDataFrame([(100, 10, 20, 200, 400, 50, 20), (100, 10, -1, 200, 400, 50, 20), (0, 10, 20, 200, 400, 50, 20)], "p int, s int, e int, q int, r int, d int, c int")
    got = sorted(prices.valuation(row, "p", "s", "e", "q", "r", "d", "c").collect(), key=lambda x: (-x.p, -x.e))
    assert (got[0].market_cap, got[0].per, got[0].pbr, got[0].ps, got[0].earnings_yield, got[0].ev, got[0].ev_revenue) == (1000, 50, 5, 2.5, 2.0, 1030, 2.575)
    assert got[1].per is None and got[1].per_reason == "NON_POSITIVE_EARNINGS" and got[2].market_cap_reason == "PRICE_NONPOSITIVE_OR_MISSING"


def test_screen_precedence(spark):
    rows = spark.createDataFrame([(1, "a", 5.0), (1, "b", 1.0), (2, "a", 5.0), (2, "b", None), (3, "a", 1.0), (4, "a", 5.0), (4, "a", 6.0), (4, "b", 1.0)], "cik long, metric string, value double")
    got = {r.cik: (r.result, r.undetermined) for r in screening.screen(rows, [("a", "GT", 3), ("b", "LTE", 1)]).collect()}
    assert got == {1: ("PASS", []), 2: ("UNDETERMINED", ["b"]), 3: ("FAIL", ["b"]), 4: ("UNDETERMINED", ["a"])}


def test_paths_stop_at_cycles(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("a", "c")], "parent string, child string")
    got = {tuple(r.path) for r in graph.simple_paths(edges, ["a"], 5).collect()}
    assert got == {("a",), ("a", "b"), ("a", "c"), ("a", "b", "c")}


def test_incremental_equals_full(spark):
    facts = spark.createDataFrame([(k, k % 5, k) for k in range(40)], "id long, cik long, value long")
    build = lambda df: df.groupBy("cik").agg(F.sum("value").alias("v"))
    before = facts.where("id < 33")
    dirty = setops.dirty_keys(before, facts, ["id"], ["cik"])
    assert sorted(setops.refresh(build(before), facts, dirty, ["cik"], build).collect()) == sorted(build(facts).collect())
    assert setops.prefix_breaks(before, facts).count() == 0


def test_quality_blocks_the_analytical_value_only(spark):
    cells = spark.createDataFrame([(1, 5), (2, 6), (3, 7)], "cik long, value long")
    decisions = spark.createDataFrame([(1, "BLOCK"), (1, "WARN"), (2, "WARN")], "cik long, decision string")
    got = {r.cik: (r.value, r.analytical_value, r.quality) for r in metrics.apply_quality(cells, decisions, ["cik"]).collect()}
    assert got == {1: (5, None, "BLOCK"), 2: (6, 6, "WARN"), 3: (7, 7, "CLEAR")}


def test_durations(spark):
    case = lambda v, u: one(spark, composed.normalize_duration("v", u), v=v)
    assert [case("1.5", "durday"), case("2.5", "durweek"), case("-1.5", "duryear"), case("1.5", "durmonth"), case("7.9", "durhour"), case("x", "durday")] == ["P1DT12H", "P17D", "-P1Y6M", "P1M15D", "PT7H", None]


def test_sources(spark, tmp_path):
    (tmp_path / "s.json").write_text(
        '{"cik": "320193", "filings": {"recent": {"accessionNumber": ["a", "b", "c", "c"], "form": ["10-K", "8-K", "10-Q", "10-Q"], "filingDate": ["20251031", "2025-01-01", "2025-02-03", "2025-02-03"],'
        ' "reportDate": ["2025-09-27", "", "2024-12-28", "2024-12-29"], "primaryDocument": ["d", "d", "d", "d"], "isXBRL": [1, 0, true, true], "isInlineXBRL": [1, 0, 1, 1]}}}'
    )
    got = sorted((r.accession, r.cik, r.form, r.filed_date, r.is_xbrl, r.status) for r in tables.read_submissions(spark, str(tmp_path / "s.json")).collect())
    assert got == [("a", "0000320193", "10-K", D(2025, 10, 31), True, "OK"), ("c", "0000320193", "10-Q", D(2025, 2, 3), True, "CONFLICT"), ("c", "0000320193", "10-Q", D(2025, 2, 3), True, "CONFLICT")]
    (tmp_path / "t.jsonl").write_text('{"cik": "1", "ticker": "A"}\n{"cik": "01", "ticker": "B"}\n{"cik": "x"}\n{"cik": "7"}\n')
    assert sorted(r.status for r in tables.read_targets(spark, str(tmp_path / "t.jsonl")).collect()) == ["DUPLICATE", "DUPLICATE", "INVALID", "OK"]
    panel = spark.createDataFrame([(1, 10, "x"), (1, 11, "y"), (2, 12, "z")], "cik long, accession long, v string")
    assert {(r.cik, r.n_rows) for r in tables.write_panel(panel, str(tmp_path / "panel")).collect()} == {(1, 2), (2, 1)}
    assert tables.read_company_partition(spark, str(tmp_path / "panel"), 1, 11).first().v == "y"
    (tmp_path / "d.csv").write_text("decision_id,issue_id,ticker,accession,concept,axis,member,decision,known_at,reviewer,reason,evidence\n1,i,T,a,c,,,WARN,2025-01-01T00:00:00,r,x,e\n2,i,T,a,c,,,BLOCK,2025-03-01T00:00:00,r,x,e\n")
    assert [r.decision for r in tables.read_decisions(spark, str(tmp_path / "d.csv"), "2025-02-01").collect()] == ["WARN"]
    raw = spark.createDataFrame([("f", "9")], "filing_id string, cik string")
    for name in ("filing", "unit"):
        raw.write.partitionBy("cik").parquet(str(tmp_path / "raw" / name)) if name == "unit" else raw.write.parquet(str(tmp_path / "raw" / name))
    got = tables.read_raw(spark, str(tmp_path / "raw"), ("filing", "unit"), ["9"])
    assert got["filing"].count() == 1 and got["unit"].count() == 1


CATALOG = "metric string, version string, status string, reviewed_at date, kind string, inputs array<string>, basis string, unit string"


def test_definitions_are_chosen_by_date_and_sorted_by_inputs(spark):
    day = lambda y: D(y, 1, 1)
    rows = [("a", "1", "ACTIVE", day(2020), "REPORTED", [], "DECLARED", "USD"), ("c", "1", "ACTIVE", day(2020), "PERCENT", ["b", "a"], "DECLARED", "PERCENT"), ("b", "1", "ACTIVE", day(2020), "DIFFERENCE", ["a", "a"], "DECLARED", "USD"), ("b", "2", "ACTIVE", day(2021), "PERCENT", ["a", "a"], "DECLARED", "PERCENT"),
            ("b", "3", "DRAFT", day(2021), "PERCENT", ["x", "a"], "DECLARED", "PERCENT"), ("d", "1", "ACTIVE", day(2022), "PERCENT", ["gone", "a"], "DECLARED", "PERCENT")]
    table = spark.createDataFrame(rows, CATALOG)
    assert [(d.metric, d.version) for d in registry.active(table, "2020-06-01")] == [("a", "1"), ("b", "1"), ("c", "1")]
    assert [(d.metric, d.kind) for d in registry.active(table, "2021-06-01")] == [("a", "REPORTED"), ("b", "PERCENT"), ("c", "PERCENT")]
    assert registry.active(table, "2019-06-01") == [] and [[d.metric for d in p] for p in registry.passes(registry.active(table, "2021-06-01"))] == [["b"], ["c"]]
    with pytest.raises(ValueError, match="gone"):
        registry.active(table, "2022-06-01")
    circle = spark.createDataFrame([("a", "1", "ACTIVE", day(2020), "PERCENT", ["b", "b"], "DECLARED", "PERCENT"), ("b", "1", "ACTIVE", day(2020), "PERCENT", ["a", "a"], "DECLARED", "PERCENT")], CATALOG)
    with pytest.raises(ValueError, match="depend on each other"):
        registry.active(circle, "2020-06-01")
    with pytest.raises(ValueError, match="several versions"):
        registry.active(table.unionByName(table.withColumn("version", F.lit("9"))), "2020-06-01")


def quarter_cells(spark, **rows):
    """Cells of the rows' metrics; each quarter is a value, or a value and what else it has."""
    out = []
    for metric, values in rows.items():
        for bucket, v in values.items():
            for one in v if isinstance(v, list) else [v]:
                value, more = one if isinstance(one, tuple) else (one, {})
                y, q = divmod(bucket - 1, 4)
                cell = {"company": 1, "metric": f"quarter_{metric}", "bucket": bucket, "coordinate": bucket, "start": D(y, q * 3 + 1, 1), "end": D(y + q // 3, (q + 1) % 4 * 3 + 1, 1), "filed": D(y + 1, 1, 1), "filing": f"f{bucket}", "value": None if value is None else Decimal(value), "unit": "USD", "dims": "", "basis": "b", "versions": "s", "mapping": "m", "concept": metric, "combined_debt": True, "reasons": []} | more
                out.append(tuple(cell.values()))
    return spark.createDataFrame(out, "company long, metric string, bucket long, coordinate long, start date, end date, filed date, filing string, value decimal(20,4), unit string, dims string, basis string, versions string, mapping string, concept string, combined_debt boolean, reasons array<string>")


def evaluated(spark, spine, as_of="2020-06-01", **rows):
    catalog = registry.quarter_catalog(spark, D(2020, 1, 1), D(2021, 1, 1))
    return {(r.metric.removeprefix("quarter_"), r.bucket): (r.value, r.reason) for r in registry.evaluate(quarter_cells(spark, **rows), spine, registry.active(catalog, as_of)).collect()}


def test_quarter_metrics_of_one_quarter(spark):
    b = 8001
    other = {"filing": "other"}
    got = evaluated(spark, [b, b + 1], revenue={b: 200, b + 2: 1}, gross_profit={b: 50}, operating_income={b: (10, other)}, net_income={b: (5, {"basis": None})}, cfo={b: 30}, capex={b: 10}, assets={b: [1, 2]}, liabilities={b: 9}, equity={b: -3}, debt={b: (9, {"combined_debt": False})}, cash={b: 1}, current_assets={b: -1}, current_liabilities={b: 3}, inventory={b: (4, {"reasons": ["QUALITY_BLOCKED", "UNIT_NOT_USD"]})}, receivables={b: None})
    want = {"revenue": (200.0, None), "gross_margin": (25.0, None), "operating_margin": (None, "SOURCE_FILING_MISMATCH"), "net_margin": (None, "BASIS_INCOMPATIBLE"), "standardized_fcf": (20.0, None), "fcf_margin": (10.0, None), "assets": (None, "MULTIPLE_CANDIDATES"), "liabilities_to_assets": (None, "MULTIPLE_CANDIDATES"), "liabilities_to_equity": (None, "NEGATIVE_EQUITY"),
            "net_debt": (None, "DIRECT_COMBINED_DEBT_UNAVAILABLE"), "current_ratio": (None, "NEGATIVE_NUMERATOR"), "inventory": (None, "QUALITY_BLOCKED"), "receivables": (None, "INPUT_NOT_REPORTED"), "research": (None, "INPUT_NOT_REPORTED"), "revenue_qoq": (None, "MISSING_INPUT"), "ttm_revenue": (None, "INPUTS_NOT_COMPATIBLE")}
    assert {k: got[k, b] for k in want} == want and len(got) == 82
    assert got["revenue", b + 1] == got["gross_margin", b + 1] == (None, "NO_FILING_AS_OF_CUTOFF")


def test_quarter_metrics_across_quarters(spark):
    q = 8005
    year = {k: 100 + k - q for k in range(q - 4, q + 1)}
    fine = {"revenue": year, "gross_profit": {k: 40 for k in year}, "cfo": {k: 30 for k in year}, "capex": {k: 10 for k in year}}
    got = evaluated(spark, [q], **fine)
    total = 97 + 98 + 99 + 100
    assert (got["ttm_revenue", q], got["ttm_gross_margin", q], got["ttm_standardized_fcf", q]) == ((float(total), None), (160 / total * 100, None), (80.0, None))
    assert got["revenue_qoq", q] == (1 / 99 * 100, None) and got["revenue_yoy", q] == (4 / 96 * 100, None)
    change = lambda at, more, value=99: evaluated(spark, [q], **(fine | {"revenue": year | {at: (value, more)}}))
    undeclared = {k: (v, {"basis": None}) for k, v in year.items()}
    assert evaluated(spark, [q], revenue=undeclared)["ttm_revenue", q] == (None, "INPUTS_NOT_COMPATIBLE")
    assert evaluated(spark, [q], "2021-06-01", revenue=undeclared)["ttm_revenue", q] == (float(total), None)
    short = {k: (v, {"basis": None, "start": D(2000, 1, 1), "end": D(2000, 1, 1)}) for k, v in year.items()}
    assert evaluated(spark, [q], "2021-06-01", revenue=short)["ttm_revenue", q] == (None, "INPUTS_NOT_COMPATIBLE")
    moved = change(q - 1, {"end": D(2000, 11, 30)})
    assert (moved["ttm_revenue", q][1], moved["revenue_qoq", q][1], moved["ttm_gross_margin", q][1]) == ("INPUTS_NOT_CONTIGUOUS", "PERIOD_NOT_CONTIGUOUS", "INPUTS_NOT_CONTIGUOUS")
    renamed = change(q - 1, {"concept": "other"})
    assert (renamed["ttm_revenue", q][1], renamed["revenue_qoq", q][1], renamed["revenue_yoy", q][1]) == ("INPUTS_NOT_COMPATIBLE", "SEMANTIC_IDENTITY_MISMATCH", None)
    claimed = evaluated(spark, [q], **(fine | {"revenue": year | {q - 5: (7, {"coordinate": q - 1})}}))
    assert (claimed["revenue_qoq", q][1], claimed["ttm_revenue", q][1], claimed["revenue_yoy", q][1]) == ("MISSING_INPUT", "INPUTS_NOT_COMPATIBLE", None)
    filed = change(q - 2, {"filing": "other"}, 98)
    assert filed["ttm_revenue", q] == (float(total), None) and filed["ttm_gross_margin", q] == (None, "SOURCE_FILING_MISMATCH")
    assert change(q - 4, {}, 0)["revenue_yoy", q][1] == "NON_POSITIVE_DENOMINATOR" and change(q, {}, -1)["revenue_yoy", q][1] == "NEGATIVE_CURRENT_VALUE"
