"""Statement and dimension graphs as edge tables: walks, hierarchies, checks along arcs, importance."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofworks.sources.tables import scratch_path


def build_graph(facts: DataFrame, arcs: DataFrame) -> DataFrame:
    """(kind, parent, child) edges without repeats: FACT_SCOPE concept to fact, DIMENSION_LENS fact to member, STATEMENT_COMPONENT from arcs (G1)."""
    # repeats go before names are made of the ids: equal ids make equal names, and names of several kinds never meet
    scope = facts.select("concept", "fact_id").distinct().select(F.lit("FACT_SCOPE").alias("kind"), F.concat(F.lit("concept:"), "concept").alias("parent"), F.concat(F.lit("fact:"), F.col("fact_id").cast("string")).alias("child"))
    lens = facts.select("fact_id", "member").distinct().select(F.lit("DIMENSION_LENS").alias("kind"), F.concat(F.lit("fact:"), F.col("fact_id").cast("string")).alias("parent"), F.concat(F.lit("member:"), "member").alias("child"))
    statement = arcs.select("parent", "child").distinct().select(F.lit("STATEMENT_COMPONENT").alias("kind"), "parent", "child")
    return scope.unionAll(lens).unionAll(statement)


def walk(start: DataFrame, step: Callable[[DataFrame], DataFrame], max_depth: int) -> DataFrame:
    """start and all that max_depth steps make of it.

    Each level is a join of the one before, written to the shared folder, so a
    walk has no limit on its rows and recomputes no level.  It ends early where
    a level is empty.
    """
    spark = start.sparkSession
    folder = scratch_path(spark, "walk")
    paths, level = [], start
    for depth in range(max_depth + 1):
        paths.append(f"{folder}/{depth}")
        level.write.parquet(paths[-1])
        level = spark.read.schema(start.schema).parquet(paths[-1])
        if level.isEmpty():
            break
        level = step(level)
    return spark.read.schema(start.schema).parquet(*paths)


def simple_paths(edges: DataFrame, roots: list[str], max_depth: int) -> DataFrame:
    """(root, node, depth, path) of all outbound paths without repeats."""
    start = edges.sparkSession.createDataFrame([(r, r, 0, [r]) for r in roots], "root string, node string, depth int, path array<string>")
    arcs = edges.select("parent", "child")

    def step(level: DataFrame) -> DataFrame:
        on = level.join(arcs, F.col("node") == F.col("parent")).where(~F.array_contains("path", F.col("child")))
        return on.select("root", F.col("child").alias("node"), (F.col("depth") + 1).alias("depth"), F.array_append("path", F.col("child")).alias("path"))

    return walk(start, step, max_depth)


def edges_for(edges: DataFrame, node: str, direction: str) -> DataFrame:
    """INCOMING, OUTGOING or BOTH edges of a node."""
    conditions = {"INCOMING": F.col("child") == node, "OUTGOING": F.col("parent") == node, "BOTH": (F.col("child") == node) | (F.col("parent") == node)}
    return edges.where(conditions[direction])


def statement_order(edges: DataFrame, roots: list[str], max_depth: int) -> DataFrame:
    """(node, depth, path): nodes depth first, sorted by the path of ordinals from the root (T5)."""
    keyed = edges.select("parent", F.col("child").alias("_child"), F.concat(F.lpad(F.col("ordinal").cast("string"), 10, "0"), F.lit("|"), "child").alias("_step"))
    start = edges.sparkSession.createDataFrame([(r, 0, [r]) for r in roots], "node string, depth int, path array<string>")

    def step(level: DataFrame) -> DataFrame:
        on = level.join(keyed, F.col("node") == F.col("parent")).where(~F.array_contains("path", F.col("_step")))
        return on.select(F.col("_child").alias("node"), (F.col("depth") + 1).alias("depth"), F.array_append("path", F.col("_step")).alias("path"))

    return walk(start, step, max_depth)


def unlinked_nodes(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """Nodes that no edge touches."""
    touched = edges.select(F.col("parent").alias(node)).unionAll(edges.select(F.col("child").alias(node))).distinct()
    return nodes.join(touched, node, "left_anti")


def anchors(arcs: DataFrame, keys: list[str], order: str, node: str) -> DataFrame:
    """The best placed arc of each key."""
    return arcs.groupBy(*keys).agg(F.min(order).alias("best_order"), F.min_by(node, F.struct(order, node)).alias("anchor"))


def importance(cells: DataFrame, parents: list[str], node: str, coordinate: str, value: str = "value", top: int = 5, back: int = 4) -> DataFrame:
    """Per parent and period: ranks by amount and by change over back periods, ties by id, with tags and sign transitions."""
    prior = cells.select(*parents, node, (F.col(coordinate) + back).alias(coordinate), F.col(value).alias("prior"))
    rows = cells.join(prior, [*parents, node, coordinate], "left").withColumn("change", F.col(value) - F.col("prior"))
    group = Window.partitionBy(*parents, coordinate)
    rows = rows.withColumn("amount_rank", F.row_number().over(group.orderBy(F.abs(value).desc(), node)).cast("long"))
    ranked = F.row_number().over(group.orderBy(F.abs("change").desc_nulls_last(), node)).cast("long")
    rows = rows.withColumn("change_rank", F.when(F.col("change").isNotNull(), ranked))
    tags = F.array_compact(F.array(
        F.when(F.col("amount_rank") <= top, "TOP_AMOUNT"), F.when(F.col("change_rank") <= top, "TOP_CHANGE"), F.when((F.col("prior") < 0) & (F.col(value) > 0), "TURNED_POSITIVE"), F.when((F.col("prior") > 0) & (F.col(value) < 0), "TURNED_NEGATIVE")
    ))
    return rows.withColumn("tags", tags)


def evaluate_signals(rows: DataFrame, amount_rank: str, share: str, share_change: str, rate: str, delta: str, scale: str) -> DataFrame:
    """Threshold tags, and a warning where a rate stands on a small or missing base."""
    big_rate = F.coalesce(F.abs(rate) >= 25, F.lit(False))
    based = F.coalesce((F.col(scale) > 0) & F.col(delta).isNotNull(), F.lit(False))
    enough = F.abs(delta) * 100 >= F.col(scale)
    signals = F.array_compact(F.array(
        F.when(F.col(amount_rank) <= 3, "TOP_3_COMPARABLE_AMOUNT"),
        F.when(F.col(share) >= 10, "REVIEWED_SHARE_AT_LEAST_10_PERCENT"),
        F.when(F.abs(share_change) >= 5, "REVIEWED_SHARE_CHANGE_AT_LEAST_5_PP"),
        F.when(big_rate & based & enough, "YOY_25_PERCENT_AND_PARENT_SCALE_1_PERCENT"),
    ))
    warning = F.when(big_rate & based & ~enough, "SMALL_BASE_OR_SMALL_ABSOLUTE_CHANGE").when(big_rate & ~based, "EXACT_POSITIVE_REFERENCE_SCALAR_UNAVAILABLE")
    return rows.withColumn("signals", signals).withColumn("warning", warning)


def member_ordering(rows: DataFrame, axis: list[str], member: str, coordinate: str, value: str = "value") -> DataFrame:
    """Members of an axis by their latest value, descending."""
    latest = rows.groupBy(*axis, member).agg(F.max_by(value, coordinate).alias("latest_value"), F.max(coordinate).alias("latest"))
    return latest.withColumn("position", F.row_number().over(Window.partitionBy(*axis).orderBy(F.col("latest_value").desc(), member)).cast("long"))


def axis_timeseries(rows: DataFrame, keys: list[str], member: str, coordinate: str, members: list[str], value: str = "value") -> DataFrame:
    """Total and members side by side over periods; a member without a value is null, not zero."""
    wide = rows.groupBy(*keys, coordinate).pivot(member, members).agg(F.sum(value))
    total = rows.groupBy(*keys, coordinate).agg(F.sum(value).alias("total"))
    return total.join(wide, [*keys, coordinate])


def revenue_shares(rows: DataFrame, scope: list[str], dims: str, value: str = "value") -> DataFrame:
    """Share of the parent whose dimensions are strictly fewer and all the row's own, where 0 <= value <= parent."""
    # both sides of the join read one exchange of the rows
    rows = rows.repartition(*scope)
    parent = rows.select(*scope, F.col(dims).alias("_pd"), F.col(value).alias("parent_value"))
    pairs = rows.join(parent, scope).where((F.size("_pd") < F.size(dims)) & (F.size(F.array_except("_pd", dims)) == 0))
    fine = (F.col(value) >= 0) & (F.col(value) <= F.col("parent_value")) & (F.col("parent_value") > 0)
    return pairs.withColumn("share", F.when(fine, F.col(value).cast("double") / F.col("parent_value").cast("double") * 100))


def product_partitions(members: DataFrame, parents: DataFrame, scope: list[str], value: str = "value") -> DataFrame:
    """Member sets that sum exactly to the parent are VERIFIED; two members at least, all positive (C32, verified mode)."""
    sums = members.groupBy(*scope).agg(F.sum(value).alias("member_sum"), F.count("*").alias("members"), F.min(value).alias("_least"))
    rows = sums.join(parents.select(*scope, F.col(value).alias("parent_value")), scope)
    fine = (F.col("members") >= 2) & (F.col("_least") > 0) & (F.col("member_sum") == F.col("parent_value"))
    return rows.withColumn("partition_status", F.when(fine, "VERIFIED").otherwise("NONE")).drop("_least")


def disclosure_index(rows: DataFrame, role: str, text: Column | str, topics: dict[str, tuple[str, ...]]) -> DataFrame:
    """Roles by topic, with how many texts match; roles without any are the P2 fallback."""
    from asofworks.functions.scalars import match_topics

    found = rows.withColumn("_t", match_topics(text, topics))
    return found.select(role, F.explode(F.when(F.size("_t") > 0, F.col("_t")).otherwise(F.array(F.lit("P2")))).alias("topic")).groupBy(role, "topic").agg(F.count("*").alias("texts"))
