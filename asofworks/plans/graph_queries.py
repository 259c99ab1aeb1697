"""Queries of the graph operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.operators import calculation as K
from asofworks.operators import graph as G
from asofworks.plans.registry import Tables, query

WALK_SQL = """with recursive walk(root, node, depth, path) as (select 'R' || r_regionkey, 'R' || r_regionkey, 0, ['R' || r_regionkey] from region where r_regionkey < 2
    union all select w.root, e.child, w.depth + 1, list_append(w.path, e.child) from walk w join edges e on e.parent = w.node where w.depth < 2 and not list_contains(w.path, e.child))"""


@query("g3_simple_paths", f"{WALK_SQL} select root, node, cast(depth as bigint) as depth, array_to_string(path, '/') as path from walk")
def g3(t: Tables) -> DataFrame:
    rows = G.simple_paths(t.edges, ["R0", "R1"], 2)
    return rows.select("root", "node", F.col("depth").cast("long"), F.array_join("path", "/").alias("path"))


@query(
    "g2_statement_hierarchy",
    """with d as (select parent, child, case when parent like 'R%' then 1 else 2 end as depth, case when parent like 'R%' then cast(substr(parent, 2) as bigint) else n_regionkey end as region from edges left join nation on parent = concat('N', n_nationkey))
    select 'tree' as network, parent, child, cast(depth as bigint) as depth, 'ROOT' as entry_kind from d
    union all select 'ring', parent, child, cast(depth + region as bigint), 'CYCLE' from d
    union all select 'ring', concat('R', r_regionkey), concat('R', (r_regionkey + 1) % 5), cast(r_regionkey + 1 as bigint), 'CYCLE' from region""",
)
def g2(t: Tables) -> DataFrame:
    ring = t.region.select(F.lit("ring").alias("network"), F.concat(F.lit("R"), "r_regionkey").alias("parent"), F.concat(F.lit("R"), (F.col("r_regionkey") + 1) % 5).alias("child"))
    arcs = t.edges.select(F.explode(F.array(F.lit("tree"), F.lit("ring"))).alias("network"), "parent", "child").unionByName(ring)
    return K.statement_hierarchy(arcs, ["network"]).select("network", "parent", "child", F.col("depth").cast("long"), "entry_kind")


@query(
    "t5_statement_order",
    """with n as (select 'R0' as node, 0 as depth, 'R0' as path union all select child, 1, 'R0/' || lpad(cast(ordinal as varchar), 10, '0') || '|' || child from edges where parent = 'R0')
    select node, cast(depth as bigint) as depth, path from n union all select e.child, 2, n.path || '/' || lpad(cast(e.ordinal as varchar), 10, '0') || '|' || e.child from n join edges e on e.parent = n.node where n.depth = 1""",
)
def t5(t: Tables) -> DataFrame:
    return G.statement_order(t.edges, ["R0"], 2).select("node", F.col("depth").cast("long"), F.array_join("path", "/").alias("path"))


@query("g6_edges_for", "select parent, child from edges where parent = 'N3' or child = 'N3'")
def g6(t: Tables) -> DataFrame:
    return G.edges_for(t.edges, "N3", "BOTH").select("parent", "child")


@query(
    "g1_build_graph",
    """select kind, count(*) as n from (select distinct 'FACT_SCOPE' as kind, 'concept:' || concept as parent, 'fact:' || fact_id as child from facts union select distinct 'DIMENSION_LENS', 'fact:' || fact_id, 'member:' || member from facts union select 'STATEMENT_COMPONENT', parent, child from edges) x group by kind""",
)
def g1(t: Tables) -> DataFrame:
    return G.build_graph(t.facts, t.edges).groupBy("kind").agg(F.count("*").alias("n"))


@query("j13_unlinked_nodes", "select 'N' || s_nationkey || 'S' || s_suppkey as node from supplier union select 'N' || n_nationkey from nation where 'N' || n_nationkey not in (select parent from edges union select child from edges)")
def j13(t: Tables) -> DataFrame:
    nodes = t.supplier.select(F.concat(F.lit("N"), "s_nationkey", F.lit("S"), "s_suppkey").alias("node")).unionAll(t.nation.select(F.concat(F.lit("N"), "n_nationkey").alias("node")))
    return G.unlinked_nodes(nodes, t.edges, "node")


@query("g4_anchors", "select parent, min(ordinal) as best_order, arg_min(child, (ordinal, child)) as anchor from edges group by parent")
def g4(t: Tables) -> DataFrame:
    return G.anchors(t.edges, ["parent"], "ordinal", "child").select("parent", F.col("best_order").cast("long"), "anchor")


@query(
    "a16_calculation_checks",
    """with o as (select o_custkey, year(o_orderdate) as y, case when o_custkey % 4 = 1 then 1 else min(o_orderkey) end as fact, case when o_custkey % 17 = 0 then null else sum(cast(o_totalprice as decimal(18,2))) end as value from orders group by o_custkey, year(o_orderdate), case when o_custkey % 4 = 1 then 1 else o_orderkey end),
    f as (select 'C' || o_custkey as node, y, value from o union all
      select 'N' || c_nationkey, year(o_orderdate), case when c_nationkey % 11 = 2 then null else sum(cast(o_totalprice as decimal(18,2))) + case when c_nationkey % 4 = 0 then 1 else 0 end end from orders join customer on o_custkey = c_custkey where c_nationkey % 5 > 0 group by c_nationkey, year(o_orderdate)
      union all select 'N1', 1996, 5),
    e2 as (select 'all' as network, parent, child, case when ordinal % 1000 = 3 then null else weight end as weight from edges
      union all select 'some', parent, child, weight from edges where parent like 'N%' and ordinal % 4 = 1
      union all select 'some', parent, child, weight from edges where parent = 'N6' and ordinal % 4 = 1),
    heads as (select network, parent, count(*) <> count(distinct child) as twice from e2 group by 1, 2),
    c as (select node, y, count(*) as n, max(value) as v from f group by 1, 2),
    p as (select heads.*, c.y as y, c.n as n, c.v as v from heads left join c on c.node = heads.parent),
    i as (select p.network as network, p.parent as parent, p.y as y, p.n as n, p.v as v, p.twice as twice, e2.child as child, e2.weight * x.v as part, case when weight is null then 'INVALID_WEIGHT' when x.node is null and e2.child in (select node from f) then 'INCOMPATIBLE_SCOPE' when x.node is null then 'MISSING_INPUT' when x.n > 1 then 'AMBIGUOUS_INPUT' when x.v is null then 'NONFINITE_OR_NIL_INPUT' end as problem
      from p join e2 on e2.network = p.network and e2.parent = p.parent left join c x on x.node = e2.child and x.y = p.y),
    r as (select network, parent, y, n, v, sum(part) as total, coalesce(case when n > 1 then 'AMBIGUOUS_PARENT' when n is null then 'MISSING_PARENT' when v is null then 'NONFINITE_OR_NIL_PARENT' when twice then 'DUPLICATE_RELATIONSHIP_INPUT' end, arg_min(problem, child) filter (where problem is not null)) as why from i group by network, parent, y, n, v, twice)
    select network, parent, cast(y as varchar) as fiscal_year, coalesce(why, case when total = v then 'MATCH' else 'MISMATCH' end) as status, cast(case when why is null then total end as double) as calculated, cast(case when why is null then total - v end as double) as difference from r""",
)
def a16(t: Tables) -> DataFrame:
    price = F.col("o_totalprice").cast("decimal(18,2)")
    year = F.year("o_orderdate").cast("long").alias("fiscal_year")
    one = F.when(F.col("o_custkey") % 4 == 1, 1).otherwise(F.col("o_orderkey"))
    own = t.orders.groupBy("o_custkey", year, one.alias("fact")).agg(F.sum(price).alias("value"))
    own = own.select(F.concat(F.lit("C"), "o_custkey").alias("node"), "fiscal_year", F.when(F.col("o_custkey") % 17 != 0, F.col("value")).alias("value"))
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).where("c_nationkey % 5 > 0")
    total = F.when(F.col("c_nationkey") % 11 != 2, F.col("_s") + F.when(F.col("c_nationkey") % 4 == 0, 1).otherwise(0))
    nation = joined.groupBy("c_nationkey", year).agg(F.sum(price).alias("_s")).select(F.concat(F.lit("N"), "c_nationkey").alias("node"), "fiscal_year", total.alias("value"))
    second = t.spark.sql("select 'N1' as node, 1996L as fiscal_year, cast(5 as decimal(18,2)) as value")
    some = t.edges.where(F.col("parent").startswith("N") & (F.col("ordinal") % 4 == 1)).select("parent", "child", "weight")
    some = some.unionByName(some.where("parent = 'N6'")).withColumn("network", F.lit("some"))
    arcs = t.edges.select(F.lit("all").alias("network"), "parent", "child", F.when(F.col("ordinal") % 1000 != 3, F.col("weight")).alias("weight")).unionByName(some)
    rows = K.calculation_checks(own.unionByName(nation).unionByName(second), arcs, ["fiscal_year"], "node", "value", ["network"])
    return rows.select("network", "parent", F.col("fiscal_year").cast("string"), "status", F.col("calculated").cast("double"), F.col("difference").cast("double"))


@query(
    "a18_interval_checks",
    """with f as (select 'N' || c_nationkey as node, sum(round(c_acctbal)) as v, 0.5 * count(*) as h, n_regionkey as r from customer join nation on c_nationkey = n_nationkey where c_nationkey <> 8 group by 1, 4),
    p as (select 'R' || n_regionkey as node, n_regionkey as r, sum(round(c_acctbal)) + case when n_regionkey % 2 = 0 then 5000 else 0 end as v, 0.5 as h from customer join nation on c_nationkey = n_nationkey group by n_regionkey),
    s as (select r, sum(v - h) as lo, sum(v + h) as hi from f group by r),
    k as (select p.node as parent, p.r as r, p.v - p.h as lo, p.v + p.h as hi, s.lo as sum_lo, s.hi as sum_hi from p join s on p.r = s.r),
    w as (select 'plain' as network, *, case when r = (select n_regionkey from nation where n_nationkey = 8) then 'CALCULATION_CHILD_FACT_MISSING_IN_EQUIVALENT_CONTEXT' end as why from k
      union all select 'odd', *, case when r = 1 then 'CALCULATION_NETWORK_CYCLE' when r in (3, 4) then 'CALCULATION_CHILD_IDENTITY_OR_WEIGHT_UNSUPPORTED' when r = (select n_regionkey from nation where n_nationkey = 8) then 'CALCULATION_CHILD_FACT_MISSING_IN_EQUIVALENT_CONTEXT' end from k
      union all select 'odd', f.node, r, v - h, v + h, null, null, 'CALCULATION_NETWORK_CYCLE' from f where r = 1)
    select network, parent, case when why is null then sum_lo end as sum_lo, case when why is null then sum_hi end as sum_hi, coalesce(why, case when sum_lo <= hi and lo <= sum_hi then 'VERIFIED' else 'CALCULATION_ROUNDING_MISMATCH' end) as status from w""",
)
def a18(t: Tables) -> DataFrame:
    base = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).withColumn("b", F.round("c_acctbal"))
    n = base.where("c_nationkey <> 8").groupBy("c_nationkey").agg(F.sum("b").alias("v"), (F.count("*") * F.lit(0.5)).alias("h")).select(F.lit(1).alias("scope"), F.concat(F.lit("N"), "c_nationkey").alias("node"), (F.col("v") - F.col("h")).alias("lo"), (F.col("v") + F.col("h")).alias("hi"))
    r = base.groupBy("n_regionkey").agg(F.sum("b").alias("v")).withColumn("v", F.col("v") + F.when(F.col("n_regionkey") % 2 == 0, 5000).otherwise(0))
    r = r.select(F.lit(1).alias("scope"), F.concat(F.lit("R"), "n_regionkey").alias("node"), (F.col("v") - 0.5).alias("lo"), (F.col("v") + 0.5).alias("hi"))
    plain = t.edges.where(F.col("parent").startswith("R")).select("parent", "child", "weight")
    odd = plain.withColumn("weight", F.when(F.col("parent") == "R4", 0).otherwise(F.col("weight"))).unionByName(plain.where("parent = 'R3'"))
    back = plain.where("parent = 'R1'").select(F.col("child").alias("parent"), F.col("parent").alias("child"), "weight")
    arcs = plain.withColumn("network", F.lit("plain")).unionByName(odd.unionByName(back).withColumn("network", F.lit("odd")))
    return K.interval_checks(n.unionByName(r), arcs, ["scope"], "node", ["network"]).select("network", "parent", "sum_lo", "sum_hi", "status")


@query(
    "w6_importance",
    """with q as (select c.cik as cik, c.coordinate as coordinate, c.value as value, p.value as prior, m.c_nationkey as nation from cells c left join cells p on c.cik = p.cik and p.coordinate = c.coordinate - 4 join customer m on m.c_custkey = c.cik),
    r as (select *, row_number() over (partition by nation, coordinate order by abs(value) desc, cik) as amount_rank, case when prior is not null then row_number() over (partition by nation, coordinate order by abs(value - prior) desc nulls last, cik) end as change_rank from q)
    select cik, coordinate, amount_rank, concat_ws(',', case when amount_rank <= 5 then 'TOP_AMOUNT' end, case when change_rank <= 5 then 'TOP_CHANGE' end) as tags from r""",
)
def w6(t: Tables) -> DataFrame:
    rows = t.cells.join(t.customer.select(F.col("c_custkey").alias("cik"), F.col("c_nationkey").alias("nation")), "cik")
    return G.importance(rows.select("nation", "cik", "coordinate", "value"), ["nation"], "cik", "coordinate").select("cik", "coordinate", "amount_rank", F.array_join("tags", ",").alias("tags"))


@query(
    "p16_w7_signals",
    """with q as (select c.cik as cik, c.coordinate as coordinate, cast(c.value as double) as v, cast(p.value as double) as p, m.c_nationkey as nation from cells c left join cells p on c.cik = p.cik and p.coordinate = c.coordinate - 4 join customer m on m.c_custkey = c.cik),
    r as (select *, row_number() over (partition by nation, coordinate order by v desc, cik) as k, max(v) over (partition by nation, coordinate) as top from q),
    s as (select *, v / top * 100 as share, v - p as delta, (v - p) / p * 100 as rate from r),
    z as (select concat_ws(',', case when k <= 3 then 'TOP_3_COMPARABLE_AMOUNT' end, case when share >= 10 then 'REVIEWED_SHARE_AT_LEAST_10_PERCENT' end, case when abs(rate) >= 25 and top > 0 and delta is not null and abs(delta) * 100 >= top then 'YOY_25_PERCENT_AND_PARENT_SCALE_1_PERCENT' end) as signals,
      case when abs(rate) >= 25 and abs(delta) * 100 < top then 'SMALL_BASE_OR_SMALL_ABSOLUTE_CHANGE' end as warning from s) select signals, warning, count(*) as n from z group by 1, 2""",
)
def p16(t: Tables) -> DataFrame:
    from pyspark.sql import Window

    from asofworks.operators.quarters import predecessor

    rows = predecessor(t.cells, ["cik"], "coordinate", 4).join(t.customer.select(F.col("c_custkey").alias("cik"), F.col("c_nationkey").alias("nation")), "cik")
    rows = rows.withColumn("v", F.col("value").cast("double")).withColumn("p", F.col("prior").cast("double"))
    w = Window.partitionBy("nation", "coordinate")
    rows = rows.withColumn("k", F.row_number().over(w.orderBy(F.col("v").desc(), "cik"))).withColumn("top", F.max("v").over(w))
    rows = rows.withColumn("share", F.col("v") / F.col("top") * 100).withColumn("delta", F.col("v") - F.col("p")).withColumn("rate", F.col("delta") / F.col("p") * 100).withColumn("share_change", F.lit(None).cast("double"))
    out = G.evaluate_signals(rows, "k", "share", "share_change", "rate", "delta", "top")
    return out.groupBy(F.array_join("signals", ",").alias("signals"), "warning").agg(F.count("*").alias("n"))


@query(
    "w8_member_ordering",
    """with l as (select concept, part_key, max(end_date) as latest, arg_max(value, (end_date, fact_id, value)) as v from (select concept, part_key, end_date, fact_id, value from facts) x group by 1, 2), r as (select concept, part_key, cast(v as double) as latest_value, row_number() over (partition by concept order by v desc, part_key) as position from l) select * from r""",
)
def w8(t: Tables) -> DataFrame:
    rows = t.facts.withColumn("at", F.struct("end_date", "fact_id", "value"))
    return G.member_ordering(rows, ["concept"], "part_key", "at").select("concept", "part_key", F.col("latest_value").cast("double"), "position")


@query("c28_axis_timeseries", """select cik, cast(year(end_date) as bigint) as period, cast(sum(value) as double) as total, cast(sum(case when member = 'F' then value end) as double) as "F", cast(sum(case when member = 'O' then value end) as double) as "O" from facts group by 1, 2""")
def c28(t: Tables) -> DataFrame:
    rows = G.axis_timeseries(t.facts.withColumn("period", F.year("end_date").cast("long")), ["cik"], "member", "period", ["F", "O"])
    return rows.select("cik", "period", *[F.col(c).cast("double") for c in ("total", "F", "O")])


@query(
    "c31_revenue_shares",
    """with m as (select accession, concept, member, sum(value) as v from facts group by 1, 2, 3), c as (select accession, concept, sum(value) as v from facts group by 1, 2), a as (select accession, sum(value) as v from facts group by 1)
    select m.accession as accession, m.concept || '/' || m.member as dims, m.concept as parent, case when m.v >= 0 and m.v <= c.v and c.v > 0 then cast(m.v as double) / cast(c.v as double) * 100 end as share from m join c on m.accession = c.accession and m.concept = c.concept
    union all select m.accession, m.concept || '/' || m.member, '', case when m.v >= 0 and m.v <= a.v and a.v > 0 then cast(m.v as double) / cast(a.v as double) * 100 end from m join a on m.accession = a.accession
    union all select c.accession, c.concept, '', case when c.v >= 0 and c.v <= a.v and a.v > 0 then cast(c.v as double) / cast(a.v as double) * 100 end from c join a on c.accession = a.accession""",
)
def c31(t: Tables) -> DataFrame:
    f = t.facts
    empty = F.array().cast("array<string>")
    c, m = F.concat(F.lit("c:"), "concept"), F.concat(F.lit("m:"), "member")
    rows = f.select("accession", "value", F.explode(F.array(F.array(c, m), F.array(c), empty)).alias("dims")).groupBy("accession", "dims").agg(F.sum("value").alias("value"))
    out = G.revenue_shares(rows, ["accession"], "dims")
    name = lambda c: F.array_join(F.transform(c, lambda d: F.substring(d, 3, 100)), "/")
    return out.select("accession", name("dims").alias("dims"), name("_pd").alias("parent"), "share")


@query(
    "c32_product_partitions",
    """with m as (select accession, concept, sum(value) as v from facts group by 1, 2), p as (select accession, sum(value) + case when accession % 6 = 0 then 1 else 0 end as v from facts group by 1)
    select m.accession as accession, count(*) as members, case when count(*) >= 2 and min(m.v) > 0 and sum(m.v) = p.v then 'VERIFIED' else 'NONE' end as partition_status from m join p on m.accession = p.accession group by m.accession, p.v""",
)
def c32(t: Tables) -> DataFrame:
    members = t.facts.groupBy("accession", "concept").agg(F.sum("value").alias("value"))
    parents = t.facts.groupBy("accession").agg(F.sum("value").alias("_s")).select("accession", (F.col("_s") + F.when(F.col("accession") % 6 == 0, 1).otherwise(0)).alias("value"))
    return G.product_partitions(members, parents, ["accession"]).select("accession", "members", "partition_status")


@query(
    "g7_disclosure_index",
    """with d as (select source, contains(lower(text), 'hate') or contains(lower(text), 'scum') as a, contains(lower(text), 'apache license') as b from documents)
    select source, topic, count(*) as texts from (select source, 'speech' as topic from d where a union all select source, 'licence' from d where b union all select source, 'P2' from d where not a and not b) x group by 1, 2""",
)
def g7(t: Tables) -> DataFrame:
    return G.disclosure_index(t.documents, "source", "text", {"speech": ("hate", "scum"), "licence": ("apache license",)})
