"""Panels, series reads, walks with a state, and projections of cells to typed inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asofworks.functions.scalars import first_reason, reasons
from asofworks.operators.graph import walk


def fact_series(series: DataFrame, start: str | None = None, end: str | None = None, period: str = "end_date", **exact: object) -> DataFrame:
    """Exact series read in period order; period classes are never coalesced."""
    for name, value in exact.items():
        series = series.where(F.col(name) == F.lit(value))
    if start:
        series = series.where(F.col(period) >= F.lit(start).cast("date"))
    if end:
        series = series.where(F.col(period) <= F.lit(end).cast("date"))
    return series.orderBy(period)


def discover_metrics(records: DataFrame, keys: list[str], period: str) -> DataFrame:
    """Records of each metric by definition with their periods."""
    return records.groupBy(*keys).agg(F.count("*").alias("records"), F.array_sort(F.collect_set(period)).alias("periods"))


def metric_revisions(revisions: DataFrame, keys: list[str], as_of: str, view: str) -> DataFrame:
    """The first or the newest revision of each metric known at as_of."""
    known = revisions.where(F.col("filed_date") <= F.lit(as_of).cast("date"))
    others = [c for c in revisions.columns if c not in keys]
    pick = F.min_by if view == "AS_FILED" else F.max_by
    out = known.groupBy(*keys).agg(pick(F.struct(*others), F.struct("filed_date", "accession")).alias("_r"), F.count("*").alias("revisions"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others], "revisions")


def state_walk(edges: DataFrame, transitions: DataFrame, roots: list[str], start_state: str, max_depth: int) -> DataFrame:
    """(root, node, state, role, depth): nodes reached along edges whose kind the state allows.

    transitions has (state, kind, next_state); an edge's target_role, if any,
    becomes the role of what follows, else the role stays and must agree.
    Nodes are not met twice on a path.
    """
    start = edges.sparkSession.createDataFrame([(r, r, start_state, None, 0, [r]) for r in roots], "root string, node string, state string, role string, depth int, path array<string>")
    arcs = edges.select("parent", "child", F.col("kind").alias("_kind"), F.col("role").alias("_role"), "target_role")
    rules = transitions.select(F.col("state").alias("_from"), F.col("kind").alias("_on"), "next_state")

    def step(level: DataFrame) -> DataFrame:
        on = level.join(arcs, F.col("node") == F.col("parent")).join(rules, (F.col("state") == F.col("_from")) & (F.col("_kind") == F.col("_on")))
        on = on.where((F.col("role").isNull() | (F.col("role") == F.col("_role"))) & ~F.array_contains("path", F.col("child")))
        return on.select("root", F.col("child").alias("node"), F.col("next_state").alias("state"), F.coalesce("target_role", "_role").alias("role"), (F.col("depth") + 1).alias("depth"), F.array_append("path", F.col("child")).alias("path"))

    return walk(start, step, max_depth).select("root", "node", "state", "role", "depth").distinct()


def statement_discovery(edges: DataFrame, facts: DataFrame, anchors: DataFrame, node: str) -> DataFrame:
    """Of each anchor: its children, how many are reported, and their facts."""
    counted = facts.groupBy(F.col(node).alias("child")).agg(F.count("*").alias("_facts"))
    rows = anchors.join(edges.select("parent", "child"), F.col("anchor") == F.col("parent")).join(counted, "child", "left")
    return rows.groupBy("anchor").agg(F.count("*").alias("children"), F.count("_facts").alias("reported"), F.coalesce(F.sum("_facts"), F.lit(0)).alias("facts"))


def hierarchy_catalog(edges: DataFrame) -> DataFrame:
    """Each parent with its number of children and first child."""
    return edges.groupBy("parent").agg(F.count("*").alias("children"), F.min_by("child", F.struct("ordinal", "child")).alias("first_child"))


def company_panel(selected: DataFrame, graph_nodes: DataFrame, node: str) -> DataFrame:
    """Selected facts on graph nodes; a selected fact must be in the graph."""
    placed = graph_nodes.select(F.col("node").alias(node), "depth").distinct()
    return selected.join(placed, node, "left").withColumn("panel_status", F.when(F.col("depth").isNull(), "NOT_IN_GRAPH").otherwise("PLACED"))


def fiscal_series(candidates: DataFrame, keys: list[str], column: str, expected: list) -> DataFrame:
    """Every key and expected column: the one value, CONFLICT for different ones, PERIOD_MISSING for none."""
    n = candidates.where(F.col(column).isin(*expected)).groupBy(*keys, column).agg(F.countDistinct("value").alias("_n"), F.min("value").alias("value"), F.count("*").alias("candidates"))
    grid = candidates.select(*keys).distinct().withColumn(column, F.explode(F.array(*[F.lit(e) for e in expected])))
    rows = grid.join(n, [*keys, column], "left")
    status = F.when(F.col("_n").isNull(), "PERIOD_MISSING").when(F.col("_n") > 1, "CONFLICT").otherwise("AVAILABLE")
    return rows.withColumn("cell_status", status).withColumn("value", F.when(F.col("_n") == 1, F.col("value"))).drop("_n")


def project_inputs(cells: DataFrame, declarations: DataFrame, key: str) -> DataFrame:
    """Cells as typed market inputs by reviewed declarations; the first failing check is the reason."""
    d = declarations.select(F.col(key).alias("_k"), "role", "currency")
    rows = cells.join(d, F.col(key) == F.col("_k"), "left")
    why = reasons((F.col("_k").isNull(), "ROLE_NOT_DECLARED"), (F.col("value").isNull(), "VALUE_MISSING"), (F.col("currency").isNull(), "CURRENCY_UNKNOWN"), (F.col("value") < 0, "NEGATIVE_INPUT"))
    return rows.withColumn("reason", first_reason(why)).drop("_k")


def eps_ttm_reviewed(quarters: DataFrame, mapping: DataFrame, keys: list[str], coordinate: str, anchor: int) -> DataFrame:
    """Sum of four quarters up to an anchor whose scopes an approved mapping makes one."""
    m = mapping.select(F.col("scope").alias("_s"), F.col("canonical_scope").alias("_c"))
    rows = quarters.join(m, F.col("scope") == F.col("_s"), "left")
    last = rows.where((F.col(coordinate) <= anchor) & (F.col(coordinate) > anchor - 4))
    out = last.groupBy(*keys).agg(F.countDistinct(coordinate).alias("quarters"), F.count("*").alias("_rows"), F.countDistinct("_c").alias("_scopes"), F.count_if(F.col("_c").isNull()).alias("_open"), F.sum("value").alias("_sum"), F.count("value").alias("_have"))
    reason = F.when(F.col("quarters") < 4, "QUARTER_MISSING").when(F.col("_rows") > 4, "COMPETING_ROWS").when(F.col("_open") > 0, "SCOPE_NOT_APPROVED").when(F.col("_scopes") > 1, "SCOPES_DIFFER").when(F.col("_have") < F.col("_rows"), "INPUT_UNAVAILABLE")
    return out.withColumn("reason", reason).withColumn("total", F.when(F.col("reason").isNull(), F.col("_sum"))).select(*keys, "quarters", "reason", "total")


def statement_occurrence(selected: DataFrame, occurrences: DataFrame, keys: list[str]) -> DataFrame:
    """Selected facts with the one equal occurrence in the statement, else OCCURRENCE_MISSING or OCCURRENCE_AMBIGUOUS."""
    n = occurrences.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("occurrence_id").alias("occurrence_id"))
    rows = selected.join(n, keys, "left")
    reason = F.when(F.col("_n").isNull(), "OCCURRENCE_MISSING").when(F.col("_n") > 1, "OCCURRENCE_AMBIGUOUS")
    return rows.withColumn("reason", reason).withColumn("occurrence_id", F.when(F.col("_n") == 1, F.col("occurrence_id"))).drop("_n")
