"""Quarters: cumulative pairs, derived quarters, predecessors, trailing twelve months, inventories and grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asofworks.functions.scalars import growth


def predecessor(cells: DataFrame, keys: list[str], coordinate: str, back: int, value: str = "value") -> DataFrame:
    """Cells with the value back steps earlier on the fiscal coordinate; one step back is QOQ, four are YOY."""
    prior = cells.select(*keys, (F.col(coordinate) + back).alias(coordinate), F.col(value).alias("prior"))
    return cells.join(prior, [*keys, coordinate], "left")


def pair_cumulative(facts: DataFrame, scope: list[str], later: str, earlier: str, kind: str = "period_class") -> DataFrame:
    """Pairs of a later and an earlier cumulative period with equal scope and start (J4): an equi join with a range condition on the ends.

    Several pairs for one later fact are all AMBIGUOUS.
    """
    names = ["fact_id", "end_date", "value", "filed_date"]
    # dealt by scope once: the join, the count and what derive_quarter joins need no other exchange
    a = facts.where(F.col(kind) == later).select(*scope, "start_date", *[F.col(c).alias(f"later_{c}") for c in names]).repartition(*scope)
    b = facts.where(F.col(kind) == earlier).select(*scope, "start_date", *[F.col(c).alias(f"earlier_{c}") for c in names]).repartition(*scope)
    pairs = a.join(b, [*scope, "start_date"]).where(F.col("earlier_end_date") < F.col("later_end_date"))
    n = F.count("*").over(Window.partitionBy(*scope, "later_fact_id"))
    return pairs.withColumn("pair_status", F.when(n > 1, "AMBIGUOUS").otherwise("UNIQUE"))


def derive_quarter(facts: DataFrame, scope: list[str], later: str, earlier: str, as_of: str, direct: str = "QTD_3M") -> DataFrame:
    """later - earlier as a quarter, with the first reason why not.

    In order: several partners, filed after as_of, not 75 to 105 days, a direct
    quarter with the same end.  Values are null where there is a reason.
    """
    pairs = pair_cumulative(facts, scope, later, earlier)
    direct_rows = facts.where(F.col("period_class") == direct).select(*scope, F.col("end_date").alias("later_end_date")).repartition(*scope).distinct().withColumn("_direct", F.lit(True))
    rows = pairs.join(direct_rows, [*scope, "later_end_date"], "left")
    cutoff = F.lit(as_of).cast("date")
    days = F.datediff("later_end_date", "earlier_end_date")
    reason = (
        F.when(F.col("pair_status") == "AMBIGUOUS", "AMBIGUOUS_PAIR")
        .when((F.col("later_filed_date") > cutoff) | (F.col("earlier_filed_date") > cutoff), "NOT_FILED_AS_OF")
        .when(~days.between(75, 105), "DURATION_OUT_OF_RANGE")
        .when(F.col("_direct"), "DIRECT_QUARTER_REPORTED")
    )
    rows = rows.withColumn("reason", reason).withColumn("days", days)
    return rows.withColumn("value", F.when(F.col("reason").isNull(), F.col("later_value") - F.col("earlier_value"))).drop("_direct")


def ttm(cells: DataFrame, keys: list[str], coordinate: str, value: str = "value", same: list[str] | None = None) -> DataFrame:
    """Sum of four contiguous quarters ending at each, else INPUTS_NOT_CONTIGUOUS, INPUT_UNAVAILABLE (one has no value) or INPUTS_NOT_COMPATIBLE."""
    order = Window.partitionBy(*keys).orderBy(coordinate)
    four = order.rowsBetween(-3, 0)
    n, first = F.count("*").over(four), F.min(coordinate).over(four)
    compatible = F.lit(True)
    for c in same or []:
        compatible = compatible & (F.size(F.collect_set(c).over(four)) == 1)
    reason = F.when((n < 4) | (F.col(coordinate) - first != 3), "INPUTS_NOT_CONTIGUOUS").when(F.count(value).over(four) < 4, "INPUT_UNAVAILABLE").when(~compatible, "INPUTS_NOT_COMPATIBLE")
    rows = cells.withColumn("reason", reason).withColumn("_sum", F.sum(value).over(four))
    return rows.withColumn("ttm", F.when(F.col("reason").isNull(), F.col("_sum"))).drop("_sum")


def ttm_margin(numerator: DataFrame, denominator: DataFrame, keys: list[str], coordinate: str) -> DataFrame:
    """100 * TTM numerator / TTM denominator where both stand and the denominator is positive, else the first reason."""
    a = ttm(numerator, keys, coordinate).select(*keys, coordinate, F.col("ttm").alias("numerator"), F.col("reason").alias("_a"))
    b = ttm(denominator, keys, coordinate).select(*keys, coordinate, F.col("ttm").alias("denominator"), F.col("reason").alias("_b"))
    rows = a.join(b, [*keys, coordinate])
    reason = F.coalesce("_a", "_b", F.when(F.col("denominator") <= 0, "NON_POSITIVE_DENOMINATOR"))
    rows = rows.withColumn("reason", reason)
    ratio = F.col("numerator").cast("double") / F.col("denominator").cast("double") * 100
    return rows.withColumn("margin", F.when(F.col("reason").isNull(), ratio)).drop("_a", "_b")


def period_inventory(filings: DataFrame, spine: DataFrame, company: str, coordinate: str, period: str) -> DataFrame:
    """Every company and spine quarter: NO_FILING_AS_OF_CUTOFF, PERIOD_AVAILABLE or PERIOD_CONFLICT, with the latest filing."""
    latest = filings.groupBy(company, coordinate).agg(F.max_by("accession", F.struct("filed_date", "accession")).alias("accession"), F.countDistinct(period).alias("_n"))
    rows = spine.join(latest, [company, coordinate], "left")
    status = F.when(F.col("_n").isNull(), "NO_FILING_AS_OF_CUTOFF").when(F.col("_n") > 1, "PERIOD_CONFLICT").otherwise("PERIOD_AVAILABLE")
    return rows.withColumn("bucket_status", status).drop("_n")


def spine(rows: DataFrame, company: str, coordinate: str, count: int) -> DataFrame:
    """Every company with the last count coordinates of all rows; one row of bounds, so nothing grows with the product but the result."""
    bounds = rows.agg(F.max(coordinate).alias("_last"))
    grid = bounds.select(F.explode(F.sequence(F.col("_last") - count + 1, F.col("_last"))).alias(coordinate))
    return rows.select(company).distinct().join(F.broadcast(grid), how="cross")


def gap_grid(cells: DataFrame, keys: list[str], coordinate: str, value: str = "value") -> DataFrame:
    """Every coordinate between a key's first and last, with GAP where there is no cell."""
    span = cells.groupBy(*keys).agg(F.min(coordinate).alias("_a"), F.max(coordinate).alias("_b"))
    grid = span.select(*keys, F.explode(F.sequence("_a", "_b")).alias(coordinate))
    rows = grid.join(cells.select(*keys, coordinate, value), [*keys, coordinate], "left")
    return rows.withColumn("cell_status", F.when(F.col(value).isNull(), "GAP").otherwise("REPORTED"))


def growth_table(cells: DataFrame, keys: list[str], coordinate: str, back: int = 4) -> DataFrame:
    """Cells with growth over the predecessor back steps earlier, PREDECESSOR_MISSING where there is none."""
    rows = predecessor(cells, keys, coordinate, back)
    rows = rows.withColumn("_g", growth("value", "prior"))
    status = F.coalesce(F.col("_g.status"), F.lit("PREDECESSOR_MISSING"))
    return rows.select(*keys, coordinate, "value", "prior", status.alias("status"), F.col("_g.rate").alias("rate"), F.col("_g.delta").alias("delta"))


def core_coverage(facts: DataFrame, derived: DataFrame, grid: DataFrame, keys: list[str]) -> DataFrame:
    """For each place of the grid REPORTED, DERIVED, UNAVAILABLE (rows without a value) or MISSING (A5)."""
    r = facts.groupBy(*keys).agg(F.count("value").alias("_r"), F.count("*").alias("_all"))
    d = derived.select(*keys).distinct().withColumn("_d", F.lit(1))
    rows = grid.join(r, keys, "left").join(d, keys, "left")
    status = F.when(F.col("_r") > 0, "REPORTED").when(F.col("_d") == 1, "DERIVED").when(F.col("_all") > 0, "UNAVAILABLE").otherwise("MISSING")
    return rows.withColumn("coverage", status).drop("_r", "_all", "_d")


def metric_support(rows: DataFrame, keys: list[str], value: str, reason: str) -> DataFrame:
    """Available and unavailable counts, and a map of reason counts, by two-level aggregation (A4)."""
    counted = rows.groupBy(*keys, reason).agg(F.count(value).alias("_have"), F.count("*").alias("_n"))
    pairs = F.collect_list(F.when(F.col(reason).isNotNull(), F.struct(F.col(reason).alias("key"), F.col("_n").alias("value"))))
    return counted.groupBy(*keys).agg(F.sum("_have").alias("available"), F.sum(F.col("_n") - F.col("_have")).alias("unavailable"), F.map_from_entries(F.array_sort(pairs)).alias("reason_counts"))
