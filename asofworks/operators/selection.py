"""Point-in-time selection: unique or a reason, first and latest reported, one comparable basis, latest decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def unique_or_reason(df: DataFrame, keys: list[str], value: str, candidate: str, spine: DataFrame | None = None) -> DataFrame:
    """One row per key: the value if there is exactly one candidate, else MISSING or MULTIPLE_CANDIDATES with the candidates' ids (A1).

    spine holds the keys that must be there; without it only keys of df are.
    """
    n = F.count("*")
    one = df.groupBy(*keys).agg(n.alias("n_candidates"), F.when(n == 1, F.first(value)).alias(value), F.array_sort(F.collect_list(candidate)).alias("candidates"))
    if spine is not None:
        one = spine.select(*keys).distinct().join(one, keys, "left").fillna({"n_candidates": 0})
    return one.withColumn("reason", F.when(F.col("n_candidates") == 0, "MISSING").when(F.col("n_candidates") > 1, "MULTIPLE_CANDIDATES"))


def select_reported(facts: DataFrame, identity: list[str], as_of: str, view: str, order: tuple[str, ...] = ("filed_date", "accession", "fact_id")) -> DataFrame:
    """First (AS_FILED) or last (LATEST_REPORTED) fact of each identity that is known at as_of; identities with none are UNAVAILABLE (A3).

    One grouped minimum or maximum over the order, combined before the shuffle.
    """
    known = F.col("filed_date") <= F.lit(as_of).cast("date")
    others = [c for c in facts.columns if c not in identity]
    pick = F.min_by if view == "AS_FILED" else F.max_by
    row = F.when(known, F.struct(*others))
    chosen = facts.groupBy(*identity).agg(pick(row, F.when(known, F.struct(*order))).alias("_row"))
    return chosen.select(*identity, *[F.col(f"_row.{c}").alias(c) for c in others], F.when(F.col("_row").isNull(), "UNAVAILABLE").otherwise("AVAILABLE").alias("status"))


def core_fact(candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key: no amendments, 10-Q before others, newest filing, undimensioned first; a tie is TIE_REVIEW_REQUIRED."""
    rows = candidates.where(~F.col("form").endswith("/A"))
    best = Window.partitionBy(*keys).orderBy((F.col("form") == "10-Q").desc(), F.col("filed_date").desc(), F.col("accession").desc(), (F.col("n_dimensions") == 0).desc())
    top = rows.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") == 1)
    n = F.count("*")
    return top.groupBy(*keys).agg(n.alias("n_candidates"), F.when(n == 1, F.first("value")).alias("value"), F.when(n == 1, F.first("accession")).alias("accession")).withColumn(
        "reason", F.when(F.col("n_candidates") > 1, "TIE_REVIEW_REQUIRED")
    )


def select_as_filed(facts: DataFrame, family: list[str], as_of: str) -> DataFrame:
    """Of each family and period the earliest direct report, else the earliest comparative, known at as_of."""
    order = Window.partitionBy(*family).orderBy(F.col("is_direct").desc(), "filed_date", "accession", "fact_id")
    return facts.where(F.col("filed_date") <= F.lit(as_of).cast("date")).withColumn("_n", F.row_number().over(order)).where(F.col("_n") == 1).drop("_n")


def select_current_comparable(facts: DataFrame, family: list[str], period: str, basis: str, as_of: str) -> DataFrame:
    """One basis per family, the one whose latest observation is newest; its newest row for each period; periods without it say so."""
    known = facts.where(F.col("filed_date") <= F.lit(as_of).cast("date"))
    newest = known.groupBy(*family).agg(F.max(F.struct("filed_date", "accession", "fact_id", basis)).alias("_top"))
    newest = newest.select(*family, F.col(f"_top.{basis}").alias("_basis"))
    periods = known.select(*family, period).distinct()
    rows = known.join(newest, family).where(F.col(basis) == F.col("_basis"))
    latest = rows.groupBy(*family, period).agg(F.max_by(F.struct("value", "accession", "fact_id", basis), F.struct("filed_date", "accession", "fact_id")).alias("_r"))
    out = periods.join(latest, [*family, period], "left")
    return out.select(*family, period, "_r.value", "_r.accession", "_r.fact_id", F.col(f"_r.{basis}").alias(basis), F.when(F.col("_r").isNull(), "PERIOD_NOT_AVAILABLE_IN_SELECTED_BASIS").alias("reason"))


def effective_decisions(events: DataFrame, issue: str, as_of: Column, at: str, action: str, decision: str, releasing: tuple[str, ...]) -> DataFrame:
    """The latest decision of each issue before a cutoff, with chain_error: TIE, or RELEASE_FIRST if it starts with a release."""
    known = events.where(F.col(at) <= as_of)
    order = Window.partitionBy(issue).orderBy(at, decision)
    chained = known.withColumn("_prior", F.lag(at).over(order)).withColumn("_n", F.row_number().over(order))
    tie = F.bool_or(F.col("_prior") == F.col(at))
    first = F.bool_or((F.col("_n") == 1) & F.col(action).isin(*releasing))
    out = chained.groupBy(issue).agg(F.max_by(F.struct(decision, action, at), F.struct(at, decision)).alias("_d"), tie.alias("_tie"), first.alias("_first"), F.count("*").alias("n_events"))
    return out.select(issue, f"_d.{decision}", f"_d.{action}", f"_d.{at}", "n_events", F.when(F.col("_tie"), "TIE").when(F.col("_first"), "RELEASE_FIRST").alias("chain_error"))


def disclosure_states(flags: DataFrame, keys: list[str], order: str, reported: str, changed: str, resolved: str) -> DataFrame:
    """RESOLVED on explicit evidence only, NOT_REPORTED_THIS_QUARTER, BASELINE at first, NEW after either, CHANGED or REPORTED_UNCHANGED.

    A state depends on the flags of its row and of the row before.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    before = F.lag(F.col(reported) & ~F.col(resolved)).over(w)
    state = (
        F.when(F.col(resolved), "RESOLVED")
        .when(~F.col(reported), "NOT_REPORTED_THIS_QUARTER")
        .when(before.isNull(), "BASELINE")
        .when(~before, "NEW")
        .when(F.col(changed), "CHANGED")
        .otherwise("REPORTED_UNCHANGED")
    )
    return flags.withColumn("state", state)


def latest_company_period(rows: DataFrame, company: str, period: str, start: str, end: str) -> DataFrame:
    """The latest period of each company; several starts or ends are PERIOD_CONFLICT; cells elsewhere are PERIOD_MISMATCH."""
    latest = rows.groupBy(company).agg(F.max(period).alias("latest_period"))
    joined = rows.join(latest, company)
    at = joined.where(F.col(period) == F.col("latest_period"))
    scope = at.groupBy(company).agg(F.countDistinct(start).alias("_s"), F.countDistinct(end).alias("_e"))
    out = joined.join(scope, company)
    status = F.when(F.col(period) != F.col("latest_period"), "PERIOD_MISMATCH").when((F.col("_s") > 1) | (F.col("_e") > 1), "PERIOD_CONFLICT").otherwise("PERIOD_AVAILABLE")
    return out.withColumn("period_status", status).drop("_s", "_e")


def dedupe_inputs(rows: DataFrame, key: list[str], value: str, reference: str) -> DataFrame:
    """Equal inputs as one row with its references; different values of one key are CONFLICT."""
    out = rows.groupBy(*key).agg(F.min(value).alias(value), F.countDistinct(value).alias("_n"), F.array_sort(F.collect_set(reference)).alias("references"))
    return out.withColumn("status", F.when(F.col("_n") > 1, "CONFLICT").otherwise("UNIQUE")).drop("_n")


def canonical_ids(concepts: DataFrame, order: tuple[str, ...], name: list[str], semantics: list[str]) -> DataFrame:
    """A company-stable id for concepts over its filings (W16, rule 2): the same name keeps its first id while its semantics stay the same.

    A change of semantics starts a new id; running breaks are counted over the
    company's rows of that name in filing order.
    """
    w = Window.partitionBy("cik", *name).orderBy(*order)
    same = F.lit(True)
    for s in semantics:
        same = same & F.col(s).eqNullSafe(F.lag(s).over(w))
    rows = concepts.withColumn("_n", F.row_number().over(w)).withColumn("_break", F.when(same | (F.col("_n") == 1), 0).otherwise(1))
    rows = rows.withColumn("_run", F.sum("_break").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.first(F.struct(*order)).over(Window.partitionBy("cik", *name, "_run").orderBy(*order))
    relation = F.when(F.col("_n") == 1, "NEW").when(F.col("_break") == 1, "UNKNOWN_CHANGE").otherwise("SAME")
    return rows.withColumn("canonical_id", F.concat_ws(":", F.col("cik").cast("string"), *[F.col(c).cast("string") for c in name], first[order[-1]].cast("string"))).withColumn("relation", relation).drop("_n", "_break", "_run")


def merge_duplicates(facts: DataFrame, key: list[str], lo: str, hi: str, value: str, fact: str) -> DataFrame:
    """Duplicate reports as the intersection of their rounding intervals; an empty one is CONFLICT; the value is the most precise one."""
    out = facts.groupBy(*key).agg(F.max(lo).alias("lo"), F.min(hi).alias("hi"), F.min_by(value, F.struct(F.col(hi) - F.col(lo), fact)).alias(value), F.count("*").alias("n_reports"))
    return out.withColumn("status", F.when(F.col("lo") > F.col("hi"), "CONFLICT").otherwise("MERGED"))
