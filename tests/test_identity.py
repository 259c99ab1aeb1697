"""Company-stable ids against a plain row-by-row application of the rules."""

import random
import re

import duckdb
import pytest
from asofworks.operators import identity as I
from asofworks.plans.all_queries import QUERIES, SQL
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tests.test_queries import DATA

SCHEMA = "cik long, kind string, filing_id string, position long, raw_id string, local_name string, qname string, namespace_uri string, is_standard boolean, taxonomy_family string, label string, period_type string, data_type string, balance string, abstract boolean, signature string"
FIELDS = [f.split()[0] for f in SCHEMA.split(", ")]


def family(uri):
    m = re.search(r"/((?:19|20)\d{2})$", uri or "")
    return uri[: m.start()] + "/v" if m else uri


def meaning(r):
    return (r["period_type"], r["data_type"], r["balance"], r["abstract"]) if r["period_type"] and r["data_type"] else None


def label(r):
    return " ".join((r["label"] or r["local_name"] or "").lower().split())


def yearly(r):
    return r["taxonomy_family"] == "us-gaap" and re.fullmatch(r"https?://fasb\.org/us-gaap/\d{4}(-\d\d-\d\d)?", r["namespace_uri"] or "")


def plain(rows, changes):
    """(method, confidence, canonical id, prior) of each raw id."""
    out, ids = {}, {}
    for r in sorted(rows, key=lambda r: (r["position"], r["raw_id"])):
        before = [p for p in sorted(rows, key=lambda p: (p["position"], p["raw_id"])) if (p["position"], p["raw_id"]) < (r["position"], r["raw_id"]) and (p["cik"], p["kind"]) == (r["cik"], r["kind"])][::-1]
        repeated = lambda x: not x["is_standard"] and sum((y["filing_id"], y["local_name"], y["is_standard"], y["kind"]) == (x["filing_id"], x["local_name"], False, x["kind"]) for y in rows) > 1
        own = f"{r['cik']}:{r['kind']}:{r['raw_id']}"
        change = next((c for c in changes if c[:2] == (r["cik"], r["raw_id"])), None)
        documented = next((p for p in before if change and p["raw_id"] in change[2]), None)
        standard = next((p for p in before if p["is_standard"] and r["is_standard"] and p["local_name"] == r["local_name"] and meaning(p) and meaning(p) == meaning(r) and (p["namespace_uri"] == r["namespace_uri"] or (yearly(p) and yearly(r)))), None)
        custom = next((p for p in before if not p["is_standard"] and not r["is_standard"] and p["local_name"] == r["local_name"]), None)
        text = next((p for p in before if label(r) and label(p) == label(r)), None)
        if documented:
            new = f"{own}:recast:{r['filing_id']}" if change[3] in I.BREAKS else ids[documented["raw_id"]]
            got = f"DOCUMENTED_{change[3]}", 1.0, new, documented
        elif standard:
            got = "EXACT_STANDARD_TAXONOMY" if standard["namespace_uri"] == r["namespace_uri"] else "STANDARD_US_GAAP_NAMESPACE_CONTINUITY", 1.0, ids[standard["raw_id"]], standard
        elif custom:
            fits = not repeated(r) and not repeated(custom) and r["filing_id"] != custom["filing_id"] and r["label"] and custom["label"] and label(r) == label(custom) and meaning(r) and meaning(r) == meaning(custom) and family(r["namespace_uri"]) == family(custom["namespace_uri"]) and r["signature"] and r["signature"] == custom["signature"]
            got = ("CUSTOM_SEMANTIC_NETWORK_CONTINUITY", 0.9, ids[custom["raw_id"]], custom) if fits else ("STRING_SIMILARITY_ONLY" if label(r) == label(custom) else "CUSTOM_EVIDENCE_CHANGED", 0.35, own, custom)
        elif text:
            got = "STRING_SIMILARITY_ONLY", 0.35, own, text
        else:
            got = ("AMBIGUOUS_CUSTOM_LOCAL_IDENTITY", 0.0, own, None) if repeated(r) else ("RAW_IDENTITY_BASELINE", 1.0, own, None)
        ids[r["raw_id"]] = got[2]
        out[r["raw_id"]] = (*got[:3], got[3] and got[3]["raw_id"])
    return out


def random_rows(seed):
    r = random.Random(seed)
    rows, changes = [], []
    for filing in range(7):
        for n in range(r.randrange(4, 9)):
            standard = r.random() < 0.5
            year = 2015 + filing // 2
            uri = r.choice([f"http://fasb.org/us-gaap/{year}-01-31", f"http://fasb.org/us-gaap/{year}", "http://xbrl.sec.gov/dei/2014"]) if standard else r.choice([f"http://co.com/{year}", "http://co.com/2015"])
            raw = f"f{filing}-{n}"
            rows.append({"cik": 1, "kind": r.choice(["concept", "member"]), "filing_id": f"f{filing}", "position": filing, "raw_id": raw, "local_name": r.choice("AB"), "qname": None, "namespace_uri": uri, "is_standard": standard, "taxonomy_family": "us-gaap" if "fasb" in uri else "dei", "label": r.choice(["The  A", "the a", "B", None]), "period_type": r.choice(["instant"] * 5 + [None]), "data_type": "monetary", "balance": r.choice([None, None, "debit"]), "abstract": False, "signature": r.choice(["s", "s", "t", None])})
            if filing and r.random() < 0.15:
                changes.append((1, raw, [f"f{r.randrange(filing)}-{r.randrange(5)}" for _ in range(2)], r.choice(["RECAST", "SPLIT", "RENAMED", "SAME", "MERGED"])))
    return rows, changes


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_rules_row_by_row(spark, seed):
    rows, changes = random_rows(seed)
    concepts = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], SCHEMA)
    found = I.canonical_ids(concepts, spark.createDataFrame(changes, "cik long, raw_id string, prior_raw_ids array<string>, relation string")).collect()
    got = {r.raw_id: (r.method, r.confidence, r.canonical_id, r.prior_raw_id) for r in found}
    assert len(found) == len(rows) and got == plain(rows, changes)


def test_chains_breaks_and_events(spark):
    base = {"cik": 1, "kind": "member", "local_name": "X", "qname": None, "namespace_uri": "http://co.com/2015", "is_standard": False, "taxonomy_family": None, "label": "X", "period_type": "instant", "data_type": "m", "balance": None, "abstract": False, "signature": "s"}
    rows = [base | {"filing_id": f"f{k}", "position": k, "raw_id": f"r{k}", "namespace_uri": f"http://co.com/{2015 + k // 3}"} for k in range(8)]
    changes = spark.createDataFrame([(1, "r5", ["r4", "r2"], "RECAST")], "cik long, raw_id string, prior_raw_ids array<string>, relation string")
    found = {r.raw_id: r for r in I.canonical_ids(spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows], SCHEMA), changes).collect()}
    assert {found[f"r{k}"].canonical_id for k in range(5)} == {"1:member:r0"} and {found[f"r{k}"].canonical_id for k in (5, 6, 7)} == {"1:member:r5:recast:f5"}
    assert [found[f"r{k}"].event for k in range(8)] == ["NEW_MEMBER", None, None, "MEMBER_RENAME", None, "SEGMENT_RECAST", "MEMBER_RENAME", None] and found["r5"].prior_raw_id == "r4"


def test_network_signatures(spark):
    concepts = [("f1", "a", "http://co.com/2015", "A"), ("f1", "b", "http://co.com/2015", "B"), ("f2", "a2", "http://co.com/2016", "A"), ("f2", "b2", "http://co.com/2016", "B"), ("f2", "c2", "http://co.com/2016", "C")]
    concepts = spark.createDataFrame([(*c, "instant", "m", None, False) for c in concepts], "filing_id string, raw_id string, namespace_uri string, local_name string, period_type string, data_type string, balance string, abstract boolean")
    arc = lambda f, year, a, b, role="role/x", arcrole=I.STRUCTURES["PRE"][0]: (f, "PRE", f"http://co.com/{year}/{role}", arcrole, "l", "a", a, b, None, None, None, None, None)
    schema = "filing_id string, network_type string, role_uri string, arcrole string, link_qname string, arc_qname string, from_raw_id string, to_raw_id string, target_role_uri string, weight string, usable boolean, closed boolean, context_element string"
    of = lambda *arcs: {r.raw_id: r.signature for r in I.network_signatures(concepts, spark.createDataFrame(list(arcs), schema)).collect()}
    got = of(arc("f1", 2015, "a", "b"), arc("f2", 2016, "a2", "b2"), arc("f1", 2015, "a", "b", arcrole=I.RESOURCES[0]))
    assert got["a"] == got["a2"] is not None and got["b"] == got["b2"] and "c2" not in got
    other = of(arc("f1", 2015, "a", "b"), arc("f2", 2016, "a2", "b2"), arc("f2", 2016, "a2", "c2"))
    assert other["a"] != other["a2"] and other["b"] == other["b2"]
    assert of(arc("f1", 2015, "a", "gone"))["a"] is None and of(arc("f1", 2015, "a", "b", arcrole="http://unknown"))["a"] is None


def test_long_chains_ties_and_rows_without_a_company(spark):
    """A chain of 70 rows, one of rows that only changes connect, names that come from no row, and rows of no company or kind."""
    base = {"cik": 1, "kind": "concept", "local_name": "X", "qname": None, "namespace_uri": "http://co.com/2015", "is_standard": False, "taxonomy_family": None, "label": "X", "period_type": "instant", "data_type": "m", "balance": None, "abstract": False, "signature": "s"}
    rows = [base | {"filing_id": f"f{k}", "position": k, "raw_id": f"r{k:02}"} for k in range(70)]
    rows += [base | {"cik": 2, "filing_id": f"f{k}", "position": k // 2, "raw_id": f"r{k:02}", "local_name": f"N{k}", "label": None} for k in range(21)]
    changes = [(2, f"r{k:02}", [None, "gone", f"r{k - 1:02}"] + [f"r{k:02}", f"r{min(k + 1, 20):02}"], "RENAMED" if k % 2 else "SAME") for k in range(1, 21)]
    expected = plain([r for r in rows if r["cik"] == 1], changes) | {("b", k): v for k, v in plain([r for r in rows if r["cik"] == 2], changes).items()}
    alone = [base | {"cik": c, "kind": k, "filing_id": f"g{n}", "position": n, "raw_id": f"z{n}"} for c, k in ((None, "concept"), (3, None)) for n in range(2)]
    made = spark.createDataFrame([tuple(r[f] for f in FIELDS) for r in rows + alone], SCHEMA)
    found = I.canonical_ids(made, spark.createDataFrame([*changes, (None, "z1", ["z0"], None)], "cik long, raw_id string, prior_raw_ids array<string>, relation string")).collect()
    assert len(found) == len(rows) + len(alone)
    assert {("b", r.raw_id) if r.cik == 2 else r.raw_id: (r.method, r.confidence, r.canonical_id, r.prior_raw_id) for r in found if r.cik in (1, 2)} == expected
    assert {r.canonical_id for r in found if r.cik == 1} == {"1:concept:r00"} and {r.canonical_id for r in found if r.cik == 2} == {"2:concept:r00"}
    assert sorted(r.canonical_id for r in found if r.cik not in (1, 2)) == ["3:z0", "3:z1", "concept:z0", "concept:z1"]


def test_rows_are_dealt_by_company_once_and_not_written(spark, capsys, monkeypatch):
    """What goes to disk does not grow with the rounds along chains: lines and orders are dealt once, rows once by company."""
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda *_: pytest.fail("rows are written"))
    QUERIES["w16_identity"](spark, DATA).explain("simple")
    plan = capsys.readouterr().out
    assert plan.count("Window") > 10 and plan.count("Exchange") - plan.count("BroadcastExchange") <= 3 and len(re.findall(r"Exchange hashpartitioning\(cik", plan)) == 1


@pytest.mark.parametrize("more", [0, 10])
def test_query_equals_sql_where_fact_ids_come_from_two_orders(spark, tmp_path, more):
    """A line number beyond 9 makes the fact id of a line of the next order; such lines are numbered together."""
    lines = spark.read.parquet(f"{DATA}/lineitem.parquet").where("l_orderkey < 400")
    lines.withColumn("l_linenumber", (F.col("l_linenumber") + F.when(F.col("l_orderkey") % 3 == 1, more).otherwise(0)).cast("int")).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.read.parquet(f"{DATA}/orders.parquet").withColumn("o_custkey", F.col("o_custkey") % 20).write.parquet(f"{tmp_path}/orders.parquet")
    con = duckdb.connect()
    for t in ("lineitem", "orders"):
        con.execute(f"create view {t} as select * from '{tmp_path}/{t}.parquet/*.parquet'")
    ours = QUERIES["w16_identity"](spark, str(tmp_path))
    theirs = con.execute(f"select {', '.join(ours.columns)} from ({SQL['w16_identity']})").fetchall()
    assert len(theirs) > 1000 and sorted(map(repr, map(tuple, ours.collect()))) == sorted(map(repr, theirs))
