"""Mappings over companies, declared fourth quarters, transformed texts and the quarter explorer."""

import datetime as dt

from asofworks.operators import bindings as B

D = dt.date


def test_unmapped_rows_stay_as_unresolved(spark):
    rows = spark.createDataFrame([(1, "concept", "a"), (2, "concept", "b"), (3, "member", "a")], "n long, entity_type string, company_canonical_id string")
    maps = spark.createDataFrame([("concept", "a", "A", "RELATED", 0.5, "M", True)], "entity_type string, company_canonical_id string, analytical_id string, relation string, confidence double, method string, review_required boolean")
    got = {r.n: (r.analytical_id, r.mapping_relation, r.mapping_confidence, r.mapping_method, r.mapping_review_required) for r in B.apply_cross_mapping(rows, maps).collect()}
    none = (None, "UNRESOLVED", 0.0, "NO_CROSS_COMPANY_MAPPING", True)
    assert got == {1: ("A", "RELATED", 0.5, "M", True), 2: none, 3: none}


def test_fourth_quarters_need_a_reviewed_additive_declaration(spark):
    year = lambda n, concept, kind, start, end, value, source="REPORTED", safe=True: (n, concept, kind, start, end, value, source, safe)
    s, e9, e12 = D(2020, 1, 1), D(2020, 10, 1), D(2021, 1, 1)
    rows = [year(1, "ok", "FY", s, e12, 10), year(2, "ok", "YTD_9M", s, e9, 7), year(3, "ok", "YTD_9M", D(2019, 1, 1), D(2019, 10, 1), 7), year(4, "eps", "FY", s, e12, 1), year(5, "unsafe", "FY", s, e12, 1), year(6, "unsafe", "YTD_9M", s, e9, 1, safe=False), year(7, "alone", "FY", s, e12, 1),
            year(8, "derived", "FY", s, e12, 1), year(9, "derived", "YTD_9M", s, e9, 1, "DERIVED"), year(10, "late", "FY", s, e9, 1), year(11, "late", "YTD_9M", s, e9, 1), year(12, "text", "FY", s, e12, None), year(13, "text", "YTD_9M", s, e9, 1), year(14, "ok", "QTD_3M", s, e9, 1)]
    facts = spark.createDataFrame(rows, "fact_id long, concept string, period_class string, start_date date, end_date date, value long, source_type string, safe boolean")
    declared = spark.createDataFrame([(c, "REVIEWED_ADDITIVE_AMOUNT", "ADDITIVE_AMOUNT" if c != "eps" else "RATIO", True, c) for c in ("ok", "eps", "unsafe", "alone", "derived", "late", "text")], "concept string, semantic_review_state string, value_kind string, is_additive boolean, declaration_id string")
    found, refused = B.policy_q4(facts, declared, ["concept"])
    assert [(r.fy_fact_id, r.ytd_fact_id, r.value, r.q4_start, r.q4_end, r.declaration_id) for r in found.collect()] == [(1, 2, 3, e9, e12, "ok")]
    unsafe = "Q4_REVIEWED_MONETARY_ADDITIVE_SEMANTICS_REQUIRED"
    assert {r.fact_id: r.reason for r in refused.collect()} == {3: "Q4_FISCAL_START_MISMATCH", 4: "Q4_SEMANTIC_DECLARATION_REQUIRED", 5: unsafe, 6: unsafe, 7: "Q4_COMPATIBLE_FY_AND_YTD9M_REQUIRED", 8: "Q4_REPORTED_SOURCES_REQUIRED", 10: "Q4_PERIOD_BOUNDARIES_INCOMPATIBLE", 12: "Q4_NON_NUMERIC_SOURCE"}
    found, refused = B.policy_q4(facts, declared, ["concept"], spark.createDataFrame([(8, 9)], "fy_id long, ytd_id long"))
    assert found.count() == 0 and {r.fact_id: r.reason for r in refused.collect()}[1] == "Q4_V2_EXACT_SCOPE_POLICY_REQUIRED"


def test_texts_are_transformed_by_their_own_column_and_checked(spark):
    lookups = spark.createDataFrame([("countrynameen", "new zealand", "NZ")], "transform string, text string, code string")
    source = [(1, "2.5", "durday"), (2, " ☒ ", "boolballotbox"), (3, "Non-Accelerated  FILER", "entityfilercategoryen"), (4, "New\tZealand", "countrynameen"), (5, "Atlantis", "countrynameen"), (6, "x", "numwordsen"), (7, "as it is", None), (8, "abc", "durweek"), (9, None, "boolballotbox"), (10, "☐", "boolballotbox")]
    source = spark.createDataFrame(source, "k long, text string, transform string")
    facts = spark.createDataFrame([(1, "P2DT12H"), (2, "false"), (3, "Non-accelerated Filer"), (4, "NZ"), (5, "AT"), (6, "1"), (7, "as it is"), (8, "P1D"), (9, "true"), (11, "alone")], "k long, value string")
    got = {r.k: (r.normalized, r.status) for r in B.check_transforms(source, facts, ["k"], lookups).collect()}
    assert got == {1: ("P2DT12H", "MATCH"), 2: ("true", "MISMATCH"), 3: ("Non-accelerated Filer", "MATCH"), 4: ("NZ", "MATCH"), 5: (None, "INVALID_TEXT"), 6: (None, "UNSUPPORTED_TRANSFORM"), 7: ("as it is", "MATCH"), 8: (None, "INVALID_TEXT"), 9: (None, "INVALID_TEXT"), 10: ("false", "FACT_MISSING"), 11: (None, "SOURCE_MISSING")}


def test_quarter_explorer_shows_every_company(spark):
    inventory = spark.createDataFrame([(1, 7, "PERIOD_AVAILABLE"), (1, 8, "NO_FILING_AS_OF_CUTOFF"), (2, 7, "PERIOD_AVAILABLE"), (2, 8, "PERIOD_CONFLICT"), (3, 7, "NO_FILING_AS_OF_CUTOFF"), (3, 8, "NO_FILING_AS_OF_CUTOFF")], "cik long, bucket long, bucket_status string")
    seen = spark.createDataFrame([(1, 7, "m", 5.0, None, False), (2, 7, "m", 6.0, None, True), (2, 8, "m", 7.0, None, False)], "cik long, bucket long, metric string, value double, reason string, blocked boolean")
    rows, coverage = B.quarter_explorer(seen, inventory, ["m", "n"])
    assert {(r.cik, r.metric): (r.bucket, r.value, r.reason) for r in rows.collect()} == {(1, "m"): (7, 5.0, None), (1, "n"): (7, None, "OBSERVATION_MISSING"), **{(c, m): (b, None, "PERIOD_NOT_PREPARED") for c, b in ((2, 8), (3, None)) for m in "mn"}}
    assert {r.metric: (r.companies_available, r.companies_total) for r in coverage.collect()} == {"m": (1, 3), "n": (0, 3)}
    rows, coverage = B.quarter_explorer(seen, inventory, ["m"], 7)
    assert {r.cik: r.value for r in rows.collect()} == {1: 5.0, 2: 6.0, 3: None} and coverage.first().companies_available == 1
