"""Growth, margins and shares of a company's quarterly pivot, each with a compatibility code where it has no value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a cell: where it stands, its value, whether it is reported and needs review, its scope, its role and its place in the statement.
CELLS = "company, row_id, coordinate, value, reported, review, unit, dims, view, as_of, basis, mapping, context, role, line_id, parent_line_id, linked"
_KEPT = "row_id value reported review unit dims view as_of basis mapping context".split()


def _code(a: Column, b: Column) -> Column:
    """The first reason why two cells make no ratio."""
    either = lambda f: f(a) | f(b)
    differ = lambda *fields: ~F.struct(*[a[c].alias(c) for c in fields]).eqNullSafe(F.struct(*[b[c].alias(c) for c in fields]))
    blank = lambda x: (F.coalesce(x["view"], F.lit("")) == "") | x["as_of"].isNull() | (F.coalesce(x["basis"], F.lit("")) == "") | x["dims"].isNull()
    return (
        F.when(a.isNull() | b.isNull(), "REQUIRED_INPUT_NOT_AVAILABLE")
        .when(either(lambda x: ~F.coalesce(x["reported"], F.lit(False))), "INPUT_NOT_REPORTED")
        .when(either(lambda x: F.coalesce(x["review"], F.lit(False))), "MAPPING_REVIEW_REQUIRED")
        .when(either(blank), "INCOMPLETE_GOVERNED_SCOPE")
        .when(differ("unit"), "INCOMPATIBLE_UNIT")
        .when(differ("dims"), "INCOMPATIBLE_DIMENSIONS")
        .when(differ("view", "as_of", "basis"), "INCOMPATIBLE_SELECTION_SCOPE")
        .when(differ("mapping"), "INCOMPATIBLE_MAPPING")
        .when(either(lambda x: ~F.coalesce(x["context"], F.lit(False))), "INCOMPLETE_CONTEXT")
        .when(either(lambda x: x["value"].isNull()), "NON_DECIMAL_INPUT")
        .when(b["value"] == 0, "ZERO_DENOMINATOR")
    )


def quarterly_metrics(cells: DataFrame, columns: DataFrame) -> DataFrame:
    """(company, row_id, coordinate, metric, value, code): QOQ_GROWTH and YOY_GROWTH of every row in every declared column (company, coordinate), COMPONENT_SHARE of cells with one evidenced parent, GROSS_MARGIN and OPERATING_MARGIN of every column.

    A predecessor is the cell of the same row one or four fiscal quarters back; a
    quarter that is no declared column is PREDECESSOR_PERIOD_NOT_DECLARED.  A
    parent is the one cell of the column on the child's parent line, if the
    statement's arcs link them; without exactly one there is no share.  A margin
    with several candidates of a role is MULTIPLE_CANDIDATES.  Values are in
    percent.  Only cells of declared columns count; cells of a row and column
    are unique.
    """
    cells = cells.join(columns.select("company", "coordinate").distinct(), ["company", "coordinate"])
    cell = F.struct(*_KEPT)
    known = cells.select("company", "row_id", "coordinate", cell.alias("c"))
    grid = cells.select("company", "row_id").distinct().join(columns.select("company", "coordinate").distinct(), "company")
    rows = grid.join(known, ["company", "row_id", "coordinate"], "left")
    growth = rows.select("*", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(k).alias("back")) for m, k in (("QOQ_GROWTH", 1), ("YOY_GROWTH", 4))])))
    growth = growth.withColumn("then", F.col("coordinate") - F.col("back"))
    declared = columns.select("company", F.col("coordinate").alias("then")).distinct().withColumn("declared", F.lit(True))
    growth = growth.join(declared, ["company", "then"], "left").join(known.select("company", "row_id", F.col("coordinate").alias("then"), F.col("c").alias("p")), ["company", "row_id", "then"], "left")
    growth = growth.withColumn("code", F.when(F.col("declared").isNull(), "PREDECESSOR_PERIOD_NOT_DECLARED").otherwise(_code(F.col("c"), F.col("p"))))
    percent = lambda a, b: F.when(F.col("code").isNull(), a.cast("double") / b.cast("double") * 100)
    out = growth.select("company", "row_id", "coordinate", "metric", percent(F.col("c.value") - F.col("p.value"), F.col("p.value")).alias("value"), "code")

    parents = cells.groupBy("company", "coordinate", F.col("line_id").alias("parent_line_id")).agg(F.count("*").alias("n"), F.first(cell).alias("p")).where("n = 1 and parent_line_id is not null")
    shares = cells.where("linked and parent_line_id is not null").select("company", "coordinate", "parent_line_id", "row_id", cell.alias("c")).join(parents, ["company", "coordinate", "parent_line_id"])
    shares = shares.withColumn("code", _code(F.col("c"), F.col("p")))
    out = out.unionByName(shares.select("company", "row_id", "coordinate", F.lit("COMPONENT_SHARE").alias("metric"), percent(F.col("c.value"), F.col("p.value")).alias("value"), "code"))

    roles = cells.where("role is not null").groupBy("company", "coordinate", "role").agg(F.count("*").alias("n"), F.first(cell).alias("c"))
    roles = roles.groupBy("company", "coordinate").agg(F.map_from_entries(F.collect_list(F.struct("role", F.struct("n", "c")))).alias("roles"))
    margins = columns.select("company", "coordinate").distinct().join(roles, ["company", "coordinate"], "left")
    margins = margins.select("company", "coordinate", "roles", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(r).alias("role")) for m, r in (("GROSS_MARGIN", "GROSS_PROFIT"), ("OPERATING_MARGIN", "OPERATING_INCOME"))])))
    margins = margins.withColumn("a", F.try_element_at("roles", F.col("role"))).withColumn("b", F.try_element_at("roles", F.lit("REVENUE")))
    several = F.coalesce(F.col("a.n") > 1, F.lit(False)) | F.coalesce(F.col("b.n") > 1, F.lit(False))
    margins = margins.withColumn("code", F.when(several, "MULTIPLE_CANDIDATES").otherwise(_code(F.col("a.c"), F.col("b.c"))))
    return out.unionByName(margins.select("company", F.lit(None).cast(dict(out.dtypes)["row_id"]).alias("row_id"), "coordinate", "metric", percent(F.col("a.c.value"), F.col("b.c.value")).alias("value"), "code"))
