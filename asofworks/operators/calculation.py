"""Calculation and presentation networks of filings: signed sums, interval sums, cycles, and hierarchies that lose no arc."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asofworks.functions.scalars import reasons
from asofworks.sources.tables import scratch_path


def _same(columns: list[str], prefix: str) -> Column:
    """Whether columns equal those of the same name behind prefix; null equals null."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"{prefix}{c}")) for c in columns], F.lit(True))


def calculation_checks(facts: DataFrame, arcs: DataFrame, scope: list[str], node: str, value: str, network: list[str] | None = None, filing: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """A row for each parent of each network and each scope that it is reported in: the signed sum of its children against it.

    arcs has the columns filing, network, parent, child, weight, and order (by
    which the first problem is found; child without one).  A parent without any
    fact gets one row with a null scope, so no parent is lost.  issues has all
    problems; status is AMBIGUOUS_PARENT where the parent has several facts of a
    scope, else the first of: MISSING_PARENT, NONFINITE_OR_NIL_PARENT,
    DUPLICATE_RELATIONSHIP_INPUT (a child has two arcs), and by arc
    INVALID_WEIGHT, INCOMPATIBLE_SCOPE (the child has facts of other scopes
    only), MISSING_INPUT, AMBIGUOUS_INPUT, NONFINITE_OR_NIL_INPUT; else MATCH or
    MISMATCH, exactly.
    """
    filing, network, order = filing or [], network or [], order or ["child"]
    cells = facts.groupBy(*filing, *scope, node).agg(F.count("*").alias("_n"), F.max(value).alias("_v"))
    parents = cells.select(*[F.col(c).alias(f"_{c}") for c in filing], *scope, F.col(node).alias("_node"), F.col("_n").alias("_pn"), F.col("_v").alias("reported"))
    heads = arcs.groupBy(*filing, *network, "parent").agg((F.count("*") != F.countDistinct("child")).alias("_twice"))
    heads = heads.join(parents, _same(filing, "_") & (F.col("parent") == F.col("_node")), "left").drop("_node", *[f"_{c}" for c in filing])
    children = cells.select(*[F.col(c).alias(f"_{c}") for c in [*filing, *scope]], F.col(node).alias("_child"), F.col("_n").alias("_cn"), F.col("_v").alias("_c"))
    seen = facts.select(*[F.col(c).alias(f"_{c}") for c in filing], F.col(node).alias("_child")).distinct().withColumn("_seen", F.lit(True))
    key = [*filing, *network, "parent"]
    own = arcs.select(*[F.col(c).alias(f"_{c}") for c in key], "child", F.col("weight"), F.struct(*order).alias("_rank"))
    items = heads.join(own, _same(key, "_")).drop(*[f"_{c}" for c in key])
    items = items.join(children, _same([*filing, *scope], "_") & (F.col("child") == F.col("_child")) & F.col("_pn").isNotNull(), "left").drop("_child", *[f"_{c}" for c in [*filing, *scope]])
    items = items.join(seen, _same(filing, "_") & (F.col("child") == F.col("_child")), "left").drop("_child", *[f"_{c}" for c in filing])
    problem = (
        F.when(F.col("weight").isNull(), "INVALID_WEIGHT")
        .when(F.col("_cn").isNull() & F.col("_seen"), "INCOMPATIBLE_SCOPE")
        .when(F.col("_cn").isNull(), "MISSING_INPUT")
        .when(F.col("_cn") > 1, "AMBIGUOUS_INPUT")
        .when(F.col("_c").isNull(), "NONFINITE_OR_NIL_INPUT")
    )
    items = items.withColumn("_problem", problem)
    first = F.min(F.when(F.col("_problem").isNotNull(), F.struct("_rank", F.col("_problem").alias("p"))))
    rows = items.groupBy(*key, *scope, "_pn", "reported", "_twice").agg(F.sum(F.col("weight") * F.col("_c")).alias("_sum"), first.alias("_first"), F.collect_set("_problem").alias("_all"))
    above = reasons(
        (F.col("_pn") > 1, "AMBIGUOUS_PARENT"),
        (F.col("_pn").isNull(), "MISSING_PARENT"),
        (F.col("_pn").isNotNull() & (F.col("_pn") == 1) & F.col("reported").isNull(), "NONFINITE_OR_NIL_PARENT"),
        (F.col("_twice"), "DUPLICATE_RELATIONSHIP_INPUT"),
    )
    rows = rows.withColumn("_above", above).withColumn("issues", F.array_sort(F.array_distinct(F.concat("_above", "_all"))))
    status = F.coalesce(F.get("_above", F.lit(0)), F.col("_first.p"), F.when(F.col("_sum") == F.col("reported"), "MATCH").otherwise("MISMATCH"))
    fine = F.size("issues") == 0
    one = F.when(F.coalesce(F.col("_pn"), F.lit(1)) == 1, F.col("reported"))
    return rows.select(*key, *scope, status.alias("status"), "issues", F.when(fine, F.col("_sum")).alias("calculated"), one.alias("reported"), F.when(fine, F.col("_sum") - F.col("reported")).alias("difference"))


def cyclic_parents(arcs: DataFrame, network: list[str]) -> DataFrame:
    """(network, parent): the parents from which a cycle of arcs can be reached.

    Arcs to nodes without arcs of their own are taken away again and again; what
    is left leads to cycles.  A round for each level of a network, each written.
    """
    spark = arcs.sparkSession
    folder = scratch_path(spark, "cycles")
    left = arcs.select(*network, "parent", "child").distinct()
    n, k = -1, 0
    while True:
        left.write.parquet(f"{folder}/{k}")
        left = spark.read.schema(left.schema).parquet(f"{folder}/{k}")
        now, k = left.count(), k + 1
        if now in (n, 0):
            return left.select(*network, "parent").distinct()
        n = now
        inner = left.select(*[F.col(c).alias(f"_{c}") for c in network], F.col("parent").alias("_child")).distinct()
        left = left.join(inner, _same(network, "_") & (F.col("child") == F.col("_child")), "left_semi")


def interval_checks(facts: DataFrame, arcs: DataFrame, scope: list[str], node: str, network: list[str] | None = None, order: list[str] | None = None) -> DataFrame:
    """A row for each parent of each network and each scope it is reported in, by rounding intervals lo, hi.

    Repeated reports of a node in a scope are one interval, what all have in
    common.  In order: CALCULATION_NETWORK_CYCLE (a cycle can be reached from the
    parent), then the first arc with
    CALCULATION_CHILD_IDENTITY_OR_WEIGHT_UNSUPPORTED (no weight, zero, or a
    child that comes twice) or CALCULATION_CHILD_FACT_MISSING_IN_EQUIVALENT_CONTEXT,
    then VERIFIED where the sum's interval overlaps the parent's, else
    CALCULATION_ROUNDING_MISMATCH.
    """
    network, order = network or [], order or ["child"]
    cells = facts.groupBy(*scope, node).agg(F.max("lo").alias("lo"), F.min("hi").alias("hi"))
    key = [*network, "parent"]
    loops = cyclic_parents(arcs, network).select(*[F.col(c).alias(f"_{c}") for c in key]).withColumn("_loop", F.lit(True))
    parents = arcs.select(*key).distinct().join(cells.withColumnRenamed(node, "parent"), "parent").join(loops, _same(key, "_"), "left").drop(*[f"_{c}" for c in key])
    rank = F.struct(*order)
    own = arcs.groupBy(*[F.col(c).alias(f"_{c}") for c in key], "child").agg(F.min(rank).alias("_rank"), F.when(F.count("*") > 1, F.max(rank)).alias("_again"), F.sum("weight").alias("_w"), F.bool_or(F.col("weight").isNull() | (F.col("weight") == 0)).alias("_bad"))
    child = cells.select(*[F.col(c).alias(f"_{c}") for c in scope], F.col(node).alias("_child"), F.col("lo").alias("_l"), F.col("hi").alias("_h"))
    items = parents.join(own, _same(key, "_")).drop(*[f"_{c}" for c in key])
    items = items.join(child, _same(scope, "_") & (F.col("child") == F.col("_child")), "left").drop("_child", *[f"_{c}" for c in scope])
    bad = F.when(F.col("_bad"), F.struct(F.col("_rank").alias("rank"), F.lit("CALCULATION_CHILD_IDENTITY_OR_WEIGHT_UNSUPPORTED").alias("why")))
    missing = F.when(F.col("_l").isNull() | F.col("_h").isNull(), F.struct(F.col("_rank").alias("rank"), F.lit("CALCULATION_CHILD_FACT_MISSING_IN_EQUIVALENT_CONTEXT").alias("why")))
    again = F.when(F.col("_again").isNotNull(), F.struct(F.col("_again").alias("rank"), F.lit("CALCULATION_CHILD_IDENTITY_OR_WEIGHT_UNSUPPORTED").alias("why")))
    items = items.withColumn("_first", F.coalesce(bad, missing, again))
    low = F.when(F.col("_w") >= 0, F.col("_w") * F.col("_l")).otherwise(F.col("_w") * F.col("_h"))
    high = F.when(F.col("_w") >= 0, F.col("_w") * F.col("_h")).otherwise(F.col("_w") * F.col("_l"))
    rows = items.groupBy(*key, *scope, "lo", "hi", "_loop").agg(F.sum(low).alias("sum_lo"), F.sum(high).alias("sum_hi"), F.min("_first").alias("_first"))
    why = F.coalesce(F.when(F.col("_loop"), "CALCULATION_NETWORK_CYCLE"), F.col("_first.why"))
    fits = (F.col("sum_lo") <= F.col("hi")) & (F.col("lo") <= F.col("sum_hi"))
    status = F.coalesce(why, F.when(fits, "VERIFIED").otherwise("CALCULATION_ROUNDING_MISMATCH"))
    return rows.select(*key, *scope, "lo", "hi", *[F.when(why.isNull(), F.col(c)).alias(c) for c in ("sum_lo", "sum_hi")], status.alias("status"))


def statement_hierarchy(arcs: DataFrame, network: list[str]) -> DataFrame:
    """Every arc of each network once, with depth, the least number of steps from an entry, and entry_kind.

    Entries are the nodes that no arc leads to (ROOT).  Arcs that no root reaches
    stand on or behind cycles: the smallest parent among them that leads to a
    cycle is a network's next entry (CYCLE), until no arc is left, so none is lost.  One written table
    for each level; arcs leave the rest when they are reached, so it ends on any
    graph and no path is kept.
    """
    spark = arcs.sparkSession
    folder = scratch_path(spark, "hierarchy")
    on = lambda left: _same([*network, left], "_")
    named = lambda df, c: df.select(*[F.col(x).alias(f"_{x}") for x in network], F.col(c).alias(f"_{c}"))
    written = 0

    def kept(df: DataFrame) -> DataFrame:
        nonlocal written
        written += 1
        df.write.parquet(f"{folder}/{written}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{written}")

    rest = kept(arcs)
    children = named(arcs.select(*network, F.col("child").alias("parent")), "parent").distinct()
    level = arcs.select(*network, "parent").distinct().join(children, on("parent"), "left_anti")
    kind, depth, found = "ROOT", 1, []
    while True:
        at = named(level, "parent").distinct()
        reached = kept(rest.join(at, on("parent"), "left_semi").withColumn("depth", F.lit(depth)).withColumn("entry_kind", F.lit(kind)))
        if reached.isEmpty():
            if rest.isEmpty():
                break
            # nothing left is reached: the next entry of each network
            level = cyclic_parents(rest, network).groupBy(*network).agg(F.min("parent").alias("parent"))
            kind, depth = "CYCLE", 1
            continue
        found.append(reached)
        rest = kept(rest.join(at, on("parent"), "left_anti"))
        level = reached.select(*network, F.col("child").alias("parent"))
        depth += 1
    return reduce(DataFrame.unionByName, found) if found else arcs.withColumn("depth", F.lit(1)).withColumn("entry_kind", F.lit("ROOT")).limit(0)
