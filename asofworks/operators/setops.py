"""Union, comparison and incremental reuse of datasets by key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cohort_union(members: list[DataFrame], owner: str) -> DataFrame:
    """Rows of all members with their number, and owner_status CONFLICT where several members have one owner."""
    out = None
    for k, member in enumerate(members):
        member = member.withColumn("member_no", F.lit(k))
        out = member if out is None else out.unionByName(member)
    owners = out.select(owner, "member_no").distinct().groupBy(owner).agg(F.count("*").alias("_n"))
    return out.join(owners, owner).withColumn("owner_status", F.when(F.col("_n") > 1, "CONFLICT").otherwise("ONE_OWNER")).drop("_n")


def compare_runs(old: DataFrame, new: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """ADDED, REMOVED, CHANGED or EQUAL for each key of either run, and which values changed."""
    a = old.select(*keys, F.struct(*values).alias("_old"))
    b = new.select(*keys, F.struct(*values).alias("_new"))
    rows = a.join(b, keys, "full_outer")
    changed: list[Column] = [F.when(~F.col(f"_old.{v}").eqNullSafe(F.col(f"_new.{v}")), v) for v in values]
    status = F.when(F.col("_old").isNull(), "ADDED").when(F.col("_new").isNull(), "REMOVED").when(F.size(F.array_compact(F.array(*changed))) > 0, "CHANGED").otherwise("EQUAL")
    out = rows.withColumn("change", status)
    return out.select(*keys, "change", F.when(F.col("change") == "CHANGED", F.array_compact(F.array(*changed))).alias("changed"), F.col("_old").alias("old"), F.col("_new").alias("new"))


def append_new(previous: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """previous and those of incoming whose keys are new (U3); prefix_breaks() says whether incoming keeps the old ones."""
    return previous.unionByName(incoming.join(previous.select(*keys), keys, "left_anti"))


def prefix_breaks(previous: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of previous that incoming does not have exactly; an append needs none."""
    return previous.exceptAll(incoming.select(*previous.columns))


def dirty_keys(previous: DataFrame, incoming: DataFrame, identity: list[str], scope: list[str]) -> DataFrame:
    """Scope keys that incoming facts touch and previous facts did not have (U4)."""
    return incoming.join(previous.select(*identity), identity, "left_anti").select(*scope).distinct()


def refresh(reused: DataFrame, facts: DataFrame, dirty: DataFrame, scope: list[str], build) -> DataFrame:  # noqa: ANN001
    """build() on the facts of dirty keys only, with all other rows of the earlier result (U4)."""
    return reused.join(dirty, scope, "left_anti").unionByName(build(facts.join(dirty, scope, "left_semi")))


def overlay(parent: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """delta's rows instead of the parent's of the same key."""
    return parent.join(delta.select(*keys), keys, "left_anti").unionByName(delta)


def fill_reviewed(parent: DataFrame, reviewed: DataFrame, keys: list[str], value: str, reason: str, expected: str) -> DataFrame:
    """Reviewed values in cells that are unavailable for the expected reason; all other cells stay."""
    r = reviewed.select(*keys, F.col(value).alias("_new"))
    rows = parent.join(r, keys, "left")
    rows = rows.withColumn("filled", F.coalesce(F.col("_new").isNotNull() & (F.col(reason) == expected), F.lit(False)))
    filled = rows.withColumn(value, F.when(F.col("filled"), F.col("_new")).otherwise(F.col(value)))
    return filled.withColumn(reason, F.when(~F.col("filled"), F.col(reason))).drop("_new")


def common_years(rows: DataFrame, company: str, year: str) -> DataFrame:
    """Years that every company has (U8)."""
    total = rows.agg(F.countDistinct(company).alias("_total"))
    counted = rows.groupBy(year).agg(F.countDistinct(company).alias("companies"))
    return counted.join(F.broadcast(total), F.col("companies") == F.col("_total")).drop("_total")


def check_integrity(rows: DataFrame, cells: DataFrame, row_id: str) -> DataFrame:
    """One row of counts: null and repeated row ids, and cells without their row."""
    r = rows.agg(F.count_if(F.col(row_id).isNull()).alias("null_ids"), (F.count(row_id) - F.countDistinct(row_id)).alias("repeated_ids"))
    c = cells.join(rows.select(row_id), row_id, "left_anti").agg(F.count("*").alias("orphans"))
    return r.crossJoin(c)
