"""What queries read: casts on which the two engines must agree, tasks of bounded size, and no table more often than needed."""

import re

import duckdb
import pytest
from asofworks.operators import composed, graph
from asofworks.plans import registry
from asofworks.plans.all_queries import QUERIES, SQL
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def ties(spark, tmp_path_factory):
    """Orders and customers whose amounts over 1000 end in half a cent; in binary some lie a little below it."""
    path = str(tmp_path_factory.mktemp("ties"))
    con = duckdb.connect()
    con.execute(f"copy (select i as o_orderkey, i as o_custkey, 'F' as o_orderstatus, cast(i * 10 + 5 as double) as o_totalprice, timestamp '1995-01-01' as o_orderdate, '1-URGENT' as o_orderpriority from range(3000) r(i)) to '{path}/orders.parquet'")
    con.execute(f"copy (select i as c_custkey, 'C' as c_name, 1 as c_nationkey, cast(i * 10 + 5 as double) as c_acctbal, 'BUILDING' as c_mktsegment from range(3000) r(i)) to '{path}/customer.parquet'")
    con.execute(f"copy (select i as event_id, timestamp '2024-01-01' + to_days(cast(i % 3 as int)) as ts, i // 3 as user_id, 'view' as event_type, cast(i % 90 + 1 as double) as value, '' as props from range(9000) r(i)) to '{path}/events.parquet'")
    for t in ("orders", "customer", "events"):
        con.execute(f"create view {t} as select * from '{path}/{t}.parquet'")
    return path, con


@pytest.mark.parametrize("name", ["p17_normalize_lexical", "c17_price_timeline"])
def test_half_cents_of_doubles_round_as_in_sql(spark, ties, name):
    path, con = ties
    ours = QUERIES[name](spark, path)
    theirs = con.execute(SQL[name]).df()[ours.columns]
    plain = lambda frame: sorted(map(repr, frame.astype(object).where(frame.notna(), None).itertuples(index=False, name=None)))
    assert plain(ours.toPandas()) == plain(theirs)


SMALL = "/root/testdata/sf0.001"


def scans(query):
    """How often the query's plan reads a file of lines."""
    return query._jdf.queryExecution().optimizedPlan().toString().count("Relation [l_orderkey#")


@pytest.mark.parametrize("name", ["facts", "annual"])
def test_tasks_over_lines_hold_a_bounded_number_of_rows(spark, monkeypatch, name):
    monkeypatch.setattr(registry, "ROWS_A_TASK", 500)
    rows = registry.table(spark, SMALL, name)
    most = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 1000 < rows.count()


def test_recast_sorts_a_bounded_number_of_rows_in_a_task(spark, monkeypatch):
    monkeypatch.setattr(registry, "ROWS_A_TASK", 500)
    rows = QUERIES["j10_bind_recast"](spark, SMALL)
    most = rows.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 1000 < rows.count()
    # a second exchange by scope would be joined by its bytes again
    assert "ENSURE_REQUIREMENTS" not in rows._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["c12_quarterly_metrics", "c14_quarter_catalog", "c7_derive_q2", "c7_derive_q3", "c7_derive_q4"])
def test_what_many_branches_read_is_computed_once(spark, name):
    assert scans(QUERIES[name](spark, SMALL)) == 0


def test_levels_of_shares_come_from_one_pass(spark):
    """Two sides of one join: an exchange that they share may still be planned twice."""
    assert scans(QUERIES["c31_revenue_shares"](spark, SMALL)) <= 2


def test_graph_drops_repeats_before_it_names_them(spark):
    facts = spark.createDataFrame([("A", 1, "F"), ("A", 1, "F"), ("A", 1, None), (None, 2, "F")], "concept string, fact_id long, member string")
    arcs = spark.createDataFrame([("R1", "N1"), ("R1", "N1")], "parent string, child string")
    built = graph.build_graph(facts, arcs)
    assert sorted(map(str, map(tuple, built.collect()))) == sorted(map(str, [("FACT_SCOPE", "concept:A", "fact:1"), ("FACT_SCOPE", None, "fact:2"), ("DIMENSION_LENS", "fact:1", "member:F"), ("DIMENSION_LENS", "fact:1", None), ("DIMENSION_LENS", "fact:2", "member:F"), ("STATEMENT_COMPONENT", "R1", "N1")]))
    assert not re.search(r"Aggregate \[(kind|parent|child)#", built._jdf.queryExecution().optimizedPlan().toString().replace("Aggregate [parent#", "Aggregate [arcs#"))


def test_core_cells_read_candidates_once_and_nulls_match_nothing(spark):
    rows = spark.createDataFrame([(1, 2000, "A", 5), (1, 2000, "N", 6), (1, 2000, "R", 7), (None, 2000, "A", 8), (2, 2001, "X", 9)], "cik int, fiscal_year int, concept string, value int")
    profile = spark.createDataFrame([("L", ["A"]), ("M", ["N", "R"])], "line_id string, concepts array<string>")
    cells = composed.core_cells(rows, profile, ["cik", "fiscal_year"])
    assert {(r.cik, r.line_id): (r.value, r.reason) for r in cells.collect()} == {
        (1, "L"): (5, None), (1, "M"): (None, "MULTIPLE_CANDIDATES"), (None, "L"): (None, "MISSING"), (None, "M"): (None, "MISSING"), (2, "L"): (None, "MISSING"), (2, "M"): (None, "MISSING"),
    }
    assert cells._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD [cik#") == 1
