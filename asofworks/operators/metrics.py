"""Metrics from cells: annual pairs, growth, same-period ratios, roles, quality, traces, corrections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofworks.functions.scalars import first_reason, percentage, reasons

#: Reported annual metrics, and derived ones as kind, two inputs and the signs that the inputs must have.
REPORTED = (
    "revenue", "cost", "gross_profit", "research", "operating_income", "net_income", "cfo", "capex", "cfi", "cff", "repurchases", "stock_compensation",
    "cash", "assets", "current_assets", "receivables", "inventory", "liabilities", "current_liabilities", "debt", "equity",
)
DERIVED = (
    ("revenue_yoy", "GROWTH", "revenue", "prior_revenue"),
    ("gross_margin", "PERCENT", "gross_profit", "revenue"),
    ("operating_margin", "PERCENT", "operating_income", "revenue"),
    ("net_margin", "PERCENT", "net_income", "revenue"),
    ("standardized_fcf", "SUBTRACT", "cfo", "capex"),
    ("fcf_margin", "PERCENT", "standardized_fcf", "revenue"),
    ("current_ratio", "STOCK_PERCENT", "current_assets", "current_liabilities"),
    ("liabilities_to_equity", "STOCK_PERCENT", "liabilities", "equity"),
    ("liabilities_to_assets", "STOCK_PERCENT", "liabilities", "assets"),
    ("net_debt", "NET_DEBT", "debt", "cash"),
)


def _derived(name: str, kind: str, a: Column, b: Column) -> tuple[Column, Column]:
    """(value, reason) of a derived metric from two values that are there."""
    below, rate = F.when(b < 0, "NEGATIVE_EQUITY") if name == "liabilities_to_equity" else F.lit(None), percentage(a, b)
    below = F.coalesce(below, F.when(b <= 0, "NON_POSITIVE_DENOMINATOR"))
    negative = F.when(a < 0, "NEGATIVE_NUMERATOR")
    if kind == "GROWTH":
        return percentage(a - b, b), F.coalesce(negative, below)
    if kind == "PERCENT":
        return rate, below
    if kind == "STOCK_PERCENT":
        return rate, F.coalesce(negative, below)
    if kind == "SUBTRACT":
        return (a - b).cast("double"), F.when(b < 0, "CAPEX_SIGN_UNCERTAIN")
    return (a - b).cast("double"), F.when((a < 0) | (b < 0), "NEGATIVE_BALANCE_COMPONENT")


def annual_metrics(cells: DataFrame, company: str, year: str, role: str, value: str = "value", filing: str | None = None) -> DataFrame:
    """Long rows (company, year, metric, source_kind, value, reason) of all 21 reported and 10 derived annual metrics.

    cells has a row for each candidate of a role.  A role without one is
    MISSING_INPUT, with several MULTIPLE_CANDIDATES, with one that has no value
    MISSING_INPUT.  A derived metric takes its first input's reason, else its
    second's, else SOURCE_FILING_MISMATCH where both stand in different filings
    (column filing), else that of its signs: margins may be negative, but their
    denominators must be positive; stocks and growth need a numerator of zero at
    least; equity below zero is NEGATIVE_EQUITY.  One aggregation by company
    and year, and the year before by a window over a company's years.
    """
    each = []
    for r in REPORTED:
        own = F.col(role) == r
        each += [F.max(F.when(own, F.col(value))).alias(f"v_{r}"), F.count_if(own).alias(f"n_{r}"), F.max(F.when(own, F.col(filing) if filing else F.lit(0))).alias(f"f_{r}")]
    wide = cells.groupBy(company, year).agg(*each)
    known: dict[str, tuple[Column, Column, Column]] = {}
    for r in REPORTED:
        n = F.col(f"n_{r}")
        why = F.when(n == 0, "MISSING_INPUT").when(n > 1, "MULTIPLE_CANDIDATES").when(F.col(f"v_{r}").isNull(), "MISSING_INPUT")
        known[r] = (F.col(f"v_{r}"), why, F.col(f"f_{r}"))
    before = Window.partitionBy(company).orderBy(year)
    last = F.when(F.lag(year).over(before) == F.col(year) - 1, F.lag(F.struct(known["revenue"][0].alias("v"), known["revenue"][1].alias("why"), F.lit(True).alias("has"))).over(before))
    wide = wide.withColumn("prior", last)
    known["prior_revenue"] = (F.col("prior.v"), F.when(F.col("prior.has").isNull(), "MISSING_INPUT").otherwise(F.col("prior.why")), F.lit(None))
    rows = [F.struct(F.lit(r).alias("metric"), F.lit("REPORTED").alias("source_kind"), F.when(known[r][1].isNull(), known[r][0].cast("double")).alias("value"), known[r][1].alias("reason")) for r in REPORTED]
    for name, kind, first, second in DERIVED:
        (a, why_a, file_a), (b, why_b, file_b) = known[first], known[second]
        found, signs = _derived(name, kind, a, b)
        why = F.coalesce(why_a, why_b, F.when(file_a != file_b, "SOURCE_FILING_MISMATCH"), signs)
        known[name] = (F.when(why.isNull(), a - b), why, file_a)
        rows.append(F.struct(F.lit(name).alias("metric"), F.lit("DERIVED_METRIC").alias("source_kind"), F.when(why.isNull(), found).alias("value"), why.alias("reason")))
    return wide.select(company, year, F.explode(F.array(*rows)).alias("_m")).select(company, year, "_m.*")


def metric_inputs(facts: DataFrame, scope: list[str], role: str, wanted: list[str]) -> DataFrame:
    """Of each scope: candidates of each wanted role, and MISSING or AMBIGUOUS roles."""
    counts = facts.groupBy(*scope).agg(*[F.count_if(F.col(role) == r).alias(f"n_{r}") for r in wanted])
    problems = reasons(*[(F.col(f"n_{r}") == 0, f"MISSING_{r}") for r in wanted], *[(F.col(f"n_{r}") > 1, f"AMBIGUOUS_{r}") for r in wanted])
    return counts.withColumn("diagnostics", problems)


def apply_quality(cells: DataFrame, decisions: DataFrame, keys: list[str], value: str = "value") -> DataFrame:
    """BLOCK empties the analytical value, WARN keeps it, the raw value stays."""
    by = decisions.groupBy(*keys).agg(F.array_sort(F.collect_set("decision")).alias("decisions"))
    rows = cells.join(by, keys, "left")
    blocked = F.coalesce(F.array_contains("decisions", "BLOCK"), F.lit(False))
    return rows.withColumn("analytical_value", F.when(~blocked, F.col(value))).withColumn("quality", F.when(blocked, "BLOCK").when(F.array_contains("decisions", "WARN"), "WARN").otherwise("CLEAR"))


def trace(cells: DataFrame, lineage: str, facts: DataFrame, fact: str, filings: DataFrame, filing: str) -> DataFrame:
    """Cells to the facts of their lineage to the filings of those."""
    flat = cells.select("*", F.posexplode(lineage).alias("input_order", fact))
    return flat.join(facts, fact, "left").join(filings, filing, "left")


def fiscal_focus_overlay(filings: DataFrame, corrections: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Filings with reviewed corrections that match the old value, and corrections that were not used."""
    c = corrections.select(key, *[F.col(f"old_{x}") for x in columns], *[F.col(f"new_{x}") for x in columns])
    fits: Column = F.lit(True)
    for x in columns:
        fits = fits & F.col(x).eqNullSafe(F.col(f"old_{x}"))
    joined = filings.join(c.withColumn("_has", F.lit(True)), key, "left").withColumn("corrected", F.coalesce(F.col("_has") & fits, F.lit(False)))
    out = joined
    for x in columns:
        out = out.withColumn(x, F.when(F.col("corrected"), F.col(f"new_{x}")).otherwise(F.col(x)))
    out = out.drop("_has", *[f"{p}_{x}" for p in ("old", "new") for x in columns])
    unused = corrections.join(out.where("corrected").select(key), key, "left_anti")
    return out, unused


def source_equations(inputs: DataFrame, totals: DataFrame, key: str, tolerance: float) -> DataFrame:
    """Weighted sums of reviewed inputs against their parent: MATCH, MISMATCH or MISSING_PARENT."""
    sums = inputs.groupBy(key).agg(F.sum(F.col("weight") * F.col("value")).alias("calculated"), F.count("*").alias("inputs"))
    rows = sums.join(totals.select(key, F.col("value").alias("reported")), key, "left")
    status = F.when(F.col("reported").isNull(), "MISSING_PARENT").when(F.abs(F.col("calculated") - F.col("reported")) <= tolerance, "MATCH").otherwise("MISMATCH")
    return rows.withColumn("status", status)


def bind_recast(facts: DataFrame, evidence: DataFrame, scope: list[str], parts: int | None = None) -> DataFrame:
    """Facts with the number of earlier filings of equal scope in evidence, and the newest of them; NO_PRIOR_FILING where none is earlier.

    Facts and filings of a scope stand in one order by date; they are never
    paired.  parts, if given, is the number of partitions to which both are dealt
    by scope, so that a task sorts a bounded number of rows; Spark neither joins
    such partitions nor deals their rows again for the sums.
    """
    if parts:
        facts, evidence = facts.repartition(parts, *scope), evidence.repartition(parts, *scope)
    e = evidence.groupBy(*scope, "accession").agg(F.min("filed_date").alias("_at")).select(*scope, "_at", F.lit(1).alias("_kind"), F.col("accession").alias("_prior"))
    f = facts.select(*scope, F.col("filed_date").alias("_at"), F.lit(0).alias("_kind"), "fact_id", "accession")
    # of one day facts stand before filings, so only earlier days count
    before = Window.partitionBy(*scope).orderBy("_at", "_kind", "_prior").rowsBetween(Window.unboundedPreceding, -1)
    rows = f.unionByName(e, allowMissingColumns=True)
    rows = rows.repartition(parts, *scope) if parts else rows
    rows = rows.withColumn("priors", F.count("_prior").over(before)).withColumn("prior", F.last("_prior", ignorenulls=True).over(before))
    return rows.where("_kind = 0").select("fact_id", "accession", *scope, "priors", "prior", F.when(F.col("priors") > 0, "RECAST").otherwise("NO_PRIOR_FILING").alias("basis"))


def financial_anchor(filings: DataFrame, cutoff: str) -> DataFrame:
    """The latest report date of each company by a cutoff, its exclusive end, and its filings."""
    known = filings.where(F.col("filed_date") <= F.lit(cutoff).cast("date"))
    latest = known.groupBy("cik").agg(F.max("report_date").alias("anchor"))
    at = known.join(latest, "cik").where(F.col("report_date") == F.col("anchor"))
    return at.groupBy("cik", "anchor").agg(F.array_sort(F.collect_list("accession")).alias("accessions")).withColumn("exclusive_end", F.date_add("anchor", 1))


def four_quarters(cells: DataFrame, keys: list[str], coordinate: str, anchor: int) -> DataFrame:
    """The four quarters up to an anchor: MISSING, QUARTER_GAP, INPUT_UNAVAILABLE (one has no value) or the sum."""
    near = cells.where(F.col(coordinate) <= anchor)
    w = Window.partitionBy(*keys).orderBy(F.col(coordinate).desc())
    last = near.withColumn("_k", F.row_number().over(w)).where("_k <= 4")
    out = last.groupBy(*keys).agg(F.count("*").alias("quarters"), (F.max(coordinate) - F.min(coordinate)).alias("_span"), F.sum("value").alias("_sum"), F.count("value").alias("_have"), F.max(coordinate).alias("last_quarter"))
    reason = F.when(F.col("quarters") < 4, "MISSING").when(F.col("_span") != 3, "QUARTER_GAP").when(F.col("_have") < 4, "INPUT_UNAVAILABLE")
    return out.withColumn("reason", reason).withColumn("total", F.when(F.col("reason").isNull(), F.col("_sum"))).drop("_span", "_sum", "_have")


def comparison_panel(rows: DataFrame, companies: list, identity: list[str], company: str = "cik") -> DataFrame:
    """Rows that several of the companies share, side by side; others are UNRESOLVED."""
    some = rows.where(F.col(company).isin(*companies))
    n = some.groupBy(*identity).agg(F.countDistinct(company).alias("companies"))
    return some.join(n, identity).withColumn("relation", F.when(F.col("companies") >= 2, "EQUIVALENT").otherwise("UNRESOLVED"))


def gate_unavailable(df: DataFrame, *checks: tuple[Column, str]) -> DataFrame:
    """df with value emptied and unavailable_reason set where a check fails."""
    return df.withColumn("_r", reasons(*checks)).withColumn("unavailable_reason", first_reason("_r")).withColumn("value", F.when(F.col("unavailable_reason").isNull(), F.col("value"))).drop("_r")
