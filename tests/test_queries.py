"""Every registered query of the library against its SQL twin on the smallest tables."""

import math
import os
import re

import duckdb
import pytest
from asofworks.plans.all_queries import QUERIES, SQL

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


def text(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value) if isinstance(value, float) else str(value)


def rows(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(tuple(text(v) for v in row) for row in plain.itertuples(index=False))


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    ours = QUERIES[name](spark, DATA).toPandas()
    theirs = duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_python_and_no_unbounded_pairs(spark, capsys, name):
    """No Python, no Cartesian product; a nested loop only against one row or a list of the query's own."""
    QUERIES[name](spark, DATA).explain("simple")
    plan = capsys.readouterr().out
    assert not re.search(r"Python|Pandas|Arrow|CartesianProduct", plan)


def test_filters_and_columns_reach_the_scan(spark, capsys):
    QUERIES["s2_find_filings"](spark, DATA).explain("formatted")
    plan = capsys.readouterr().out
    assert "PushedFilters: [" in plan and "o_totalprice" not in plan
