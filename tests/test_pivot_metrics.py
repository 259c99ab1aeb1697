"""Growth, margins and shares of the quarterly pivot, one odd cell at a time."""

import datetime as dt

from asofworks.operators import pivot_metrics as M

SCHEMA = "company long, row_id string, coordinate long, value long, reported boolean, review boolean, unit string, dims string, view string, as_of date, basis string, mapping string, context boolean, role string, line_id string, parent_line_id string, linked boolean"


def cell(row, at, value, **more):
    return tuple(({"company": 1, "row_id": row, "coordinate": at, "value": value, "reported": True, "review": False, "unit": "USD", "dims": "", "view": "AS_FILED", "as_of": dt.date(2020, 1, 1), "basis": "b", "mapping": "m", "context": True, "role": None, "line_id": row, "parent_line_id": None, "linked": False} | more).values())


def made(spark, cells, columns=(1, 2, 3, 5)):
    rows = M.quarterly_metrics(spark.createDataFrame(cells, SCHEMA), spark.createDataFrame([(1, c) for c in columns], "company long, coordinate long")).collect()
    return {(r.metric.removesuffix("_GROWTH"), r.row_id, r.coordinate): (r.value, r.code) for r in rows}


def test_growth_margins_and_shares(spark):
    cells = [cell("rev", k, v, role="REVENUE") for k, v in ((1, 80), (2, 100), (5, 160), (9, 1))] + [cell("gp", 2, 40, role="GROSS_PROFIT"), cell("part", 2, 25, parent_line_id="rev", linked=True), cell("loose", 2, 25, parent_line_id="rev")]
    got = made(spark, cells)
    assert got["QOQ", "rev", 2] == (25.0, None) and got["YOY", "rev", 5] == (100.0, None) and got["QOQ", "rev", 5] == (None, "PREDECESSOR_PERIOD_NOT_DECLARED") and got["QOQ", "rev", 3] == (None, "REQUIRED_INPUT_NOT_AVAILABLE")
    assert got["GROSS_MARGIN", None, 2] == (40.0, None) and got["OPERATING_MARGIN", None, 2] == (None, "REQUIRED_INPUT_NOT_AVAILABLE") and got["COMPONENT_SHARE", "part", 2] == (25.0, None) and ("COMPONENT_SHARE", "loose", 2) not in got
    assert len(got) == 4 * 4 * 2 + 1 + 4 * 2
    twice = made(spark, [*cells, cell("other", 2, 1, role="REVENUE", line_id="rev")])
    assert twice["GROSS_MARGIN", None, 2] == (None, "MULTIPLE_CANDIDATES") and ("COMPONENT_SHARE", "part", 2) not in twice


def test_codes_in_order(spark):
    odd = [({"reported": False, "review": True}, "INPUT_NOT_REPORTED"), ({"review": True, "basis": None}, "MAPPING_REVIEW_REQUIRED"), ({"basis": ""}, "INCOMPLETE_GOVERNED_SCOPE"), ({"unit": "EUR", "dims": "x"}, "INCOMPATIBLE_UNIT"), ({"dims": "x", "view": "V"}, "INCOMPATIBLE_DIMENSIONS"), ({"view": "V", "mapping": "n"}, "INCOMPATIBLE_SELECTION_SCOPE"), ({"mapping": "n", "context": False}, "INCOMPATIBLE_MAPPING"), ({"context": False}, "INCOMPLETE_CONTEXT")]
    cells = [c for k, (more, _) in enumerate(odd) for c in (cell(f"r{k}", 1, 5), cell(f"r{k}", 2, 6, **more))] + [cell("none", 1, None), cell("none", 2, 1), cell("zero", 1, 0), cell("zero", 2, 1)]
    got = made(spark, cells)
    assert [got["QOQ", f"r{k}", 2][1] for k in range(len(odd))] == [code for _, code in odd] and got["QOQ", "none", 2][1] == "NON_DECIMAL_INPUT" and got["QOQ", "zero", 2][1] == "ZERO_DENOMINATOR"
