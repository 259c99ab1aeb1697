"""Ranks and running sums over orders that are too long for one task, in DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a part, about, and parts that the interval from 0 to 1 is cut into at least.
PART_ROWS, LEAST_PARTS = 50_000, 64


def parts_for(table: DataFrame) -> int:
    """Into how many parts the groups of a written table are cut."""
    return max(LEAST_PARTS, -(-table.count() // PART_ROWS))


def running(df: DataFrame, parts: int, groups: list[str], place: str, order: list[Column], value: Column, before: str, total: str | None = None) -> DataFrame:
    """df with the sum of value over all rows of the row's group that stand before it.

    place is a number from 0 to 1 that grows along the order; order breaks its
    ties.  Each group is cut by place into parts.  One row for each group and
    part carries the sums of all earlier parts, so a task sorts one part of a
    group at a time, never a whole group.  total names a column for the group's
    whole sum, if wanted.
    """
    part = F.least(F.floor(F.col(place) * parts).cast("int"), F.lit(parts - 1))
    df = df.withColumn("_part", part).withColumn("_value", value)
    sums = df.groupBy(*groups, "_part").agg(F.sum("_value").alias("_sum"))
    along = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    sums = sums.withColumn("_earlier", F.coalesce(F.sum("_sum").over(along.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    if total:
        sums = sums.withColumn(total, F.sum("_sum").over(along))
    sums = sums.drop("_sum").select(*[F.col(c).alias(f"_{c}") for c in groups], F.col("_part").alias("_its"), *[c for c in sums.columns if c not in [*groups, "_part", "_sum"]])
    same = F.col("_part") == F.col("_its")
    for c in groups:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    inside = Window.partitionBy(*groups, "_part").orderBy(place, *order).rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    out = df.join(sums, same).withColumn(before, F.col("_earlier") + F.col("_inside"))
    return out.drop("_part", "_value", "_its", "_earlier", "_inside", *[f"_{c}" for c in groups])


def uniform(seed: int, *columns: str) -> Column:
    """A number over 0 and under 1, drawn by a hash keyed by seed; the same for equal values."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed).cast("long"), *[F.col(c) for c in columns]), 11)
    return (bits + F.lit(0.5)) / F.lit(float(1 << 53))
