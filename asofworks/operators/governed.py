"""Governed rows: observations with every exclusion reason, versions, declared and derived values, additions, period policies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asofworks.functions.scalars import growth
from asofworks.operators.periods import attach_mapping, gate
from asofworks.operators.quarters import predecessor
from asofworks.operators.screening import screen


def period_observations(facts: DataFrame, filings: DataFrame, concepts: DataFrame, contexts: DataFrame, units: DataFrame, dims: DataFrame) -> DataFrame:
    """Every fact with its context's columns and all reasons, in order, that exclude it; none makes it an observation.

    facts has fact_id, filing_id, raw_concept_id, context_id and unit_id (which
    may be null); the other tables have their id and the filing they belong to,
    dims the fact, axis and member.  A reference is missing, or lacks its
    filing, or is of another filing; a fact's dimensions are looked at as one.
    """
    rows = facts.join(filings.select(F.col("filing_id").alias("_filing")).distinct(), F.col("filing_id") == F.col("_filing"), "left")
    checks = [(F.col("fact_id").isNull(), "MISSING_FACT_ID"), (F.col("_filing").isNull(), "FACT_FILING_MISMATCH")]
    for kind, key, table in (("CONCEPT", "raw_concept_id", concepts), ("CONTEXT", "context_id", contexts), ("UNIT", "unit_id", units)):
        more = [c for c in table.columns if kind == "CONTEXT" and c not in (key, "filing_id")]
        one = table.select(F.col(key).alias(f"_{kind}"), F.col("filing_id").alias(f"_{kind}_filing"), *more)
        rows = rows.join(one, F.col(key) == F.col(f"_{kind}"), "left")
        wanted = F.col(key).isNotNull() if kind == "UNIT" else F.lit(True)
        found = F.col(f"_{kind}").isNotNull()
        checks += [
            (wanted & ~found, f"MISSING_OR_UNRESOLVED_{kind}"),
            (found & F.col(f"_{kind}_filing").isNull(), f"MISSING_{kind}_REFERENCE_FILING_ID"),
            (found & (F.col(f"_{kind}_filing") != F.col("filing_id")), f"CROSS_FILING_{kind}_REFERENCE"),
        ]
    member = F.col("member_raw_concept_id")
    of = lambda side: concepts.select(F.col("raw_concept_id").alias(f"_{side}"), F.col("filing_id").alias(f"_{side}_filing"))
    d = dims.join(facts.select("fact_id", F.col("filing_id").alias("_own")), "fact_id")
    d = d.join(of("a"), F.col("axis_raw_concept_id") == F.col("_a"), "left").join(of("m"), member == F.col("_m"), "left")
    some = lambda c: F.coalesce(F.max(c), F.lit(False))
    d = d.groupBy(F.col("fact_id").alias("_dims")).agg(
        some(F.col("_a").isNull() | (member.isNotNull() & F.col("_m").isNull())).alias("_open"),
        some((F.col("_a").isNotNull() & F.col("_a_filing").isNull()) | (F.col("_m").isNotNull() & F.col("_m_filing").isNull())).alias("_lacks"),
        some((F.col("_a_filing") != F.col("_own")) | (F.col("_m_filing") != F.col("_own"))).alias("_other"),
    )
    rows = rows.join(d, F.col("fact_id") == F.col("_dims"), "left")
    checks += [(F.col("_open"), "MISSING_OR_UNRESOLVED_DIMENSION"), (F.col("_lacks"), "MISSING_DIMENSION_REFERENCE_FILING_ID"), (F.col("_other"), "CROSS_FILING_DIMENSION_REFERENCE")]
    return gate(rows, *checks).select(*facts.columns, *[c for c in contexts.columns if c not in ("context_id", "filing_id")], "reasons", "unavailable_reason")


def versioned_panel(observed: DataFrame, mapping: DataFrame, raw: str, scope: list[str]) -> DataFrame:
    """All observations, mapped, with the ordinal of each version of its scope and how many there are; none is chosen."""
    rows = attach_mapping(observed.where(F.col("unavailable_reason").isNull()), mapping, raw)
    order = Window.partitionBy("canonical_id", *scope)
    return rows.withColumn("version", F.row_number().over(order.orderBy("filed_date", "fact_id"))).withColumn("versions", F.count("*").over(order))


def revenue_q4(observations: DataFrame, scope: list[str], cutoff: str) -> DataFrame:
    """One row for each scope and fiscal year: FY less nine months, or why not.

    observations has period_class, concept, value, start_date, end_date,
    filed_date and the flags review_required, held and qualified.  The first
    reason, in this order, that any input has: review, quality or continuity,
    qualification, length (350 to 378 and 255 to 290 days); then a missing or
    repeated input, other concepts, other starts or a gap of not 75 to 105 days.
    One aggregation, no join.
    """
    rows = observations.where(F.col("period_class").isin("FY", "YTD_9M") & (F.col("filed_date") <= F.lit(cutoff).cast("date")))
    fy = F.col("period_class") == "FY"
    days = F.datediff("end_date", "start_date")
    fits = F.when(fy, days.between(350, 378)).otherwise(days.between(255, 290))
    any_ = lambda c: F.coalesce(F.max(c), F.lit(False))
    each = [F.max(F.when(own, F.col(c))).alias(f"_{n}_{c}") for n, own in (("fy", fy), ("nm", ~fy)) for c in ("concept", "value", "start_date", "end_date")]
    out = rows.groupBy(*scope, "fiscal_year").agg(
        any_(F.col("review_required")).alias("_r"), any_(F.col("held")).alias("_h"), any_(~F.col("qualified") | F.col("value").isNull()).alias("_q"), any_(~fits).alias("_d"), F.count_if(fy).alias("_fy"), F.count_if(~fy).alias("_nm"), *each
    )
    gap = F.datediff("_fy_end_date", "_nm_end_date")
    reason = (
        F.when(F.col("_r"), "Q4_MAPPING_REVIEW_REQUIRED").when(F.col("_h"), "Q4_INPUT_QUALITY_OR_CONTINUITY_HELD").when(F.col("_q"), "Q4_INPUT_NOT_QUALIFIED").when(F.col("_d"), "Q4_INPUT_PERIOD_NOT_QUALIFIED")
        .when(F.col("_fy") == 0, "Q4_MISSING_ANNUAL_INPUT").when(F.col("_nm") == 0, "Q4_MISSING_YTD9_INPUT").when((F.col("_fy") > 1) | (F.col("_nm") > 1), "Q4_AMBIGUOUS_INPUTS")
        .when(F.col("_fy_concept") != F.col("_nm_concept"), "Q4_INPUT_CONCEPT_MISMATCH").when((F.col("_fy_start_date") != F.col("_nm_start_date")) | ~gap.between(75, 105), "Q4_INPUT_SCOPE_OR_PERIOD_MISMATCH")
    )
    out = out.withColumn("reason", reason).withColumn("inputs", F.col("_fy") + F.col("_nm"))
    return out.withColumn("value", F.when(F.col("reason").isNull(), F.col("_fy_value") - F.col("_nm_value"))).select(*scope, "fiscal_year", "inputs", "reason", "value")


def eps_ttm_direct(observations: DataFrame, declarations: DataFrame, cutoff: str) -> DataFrame:
    """One row per declaration: the exact sum of the four direct quarters that it names, or why not (A10).

    declarations has declaration_id, cik, confirmed, available_on and
    observation_ids; observations has cik, observation_id, eligible (a reported
    quarter with a unit of EPS), scope, coordinate, start_date, end_date,
    filed_date and value.  A declaration binds rows that exist; it never makes
    or chooses one.
    """
    day = F.lit(cutoff).cast("date")
    o = observations.withColumn("_rivals", F.size(F.collect_set("observation_id").over(Window.partitionBy("cik", "scope", "start_date", "end_date"))))
    named = declarations.select("declaration_id", "cik", "confirmed", "available_on", F.col("observation_ids").alias("_ids"), F.explode_outer(F.array_distinct("observation_ids")).alias("_id"))
    rows = named.join(o.withColumnRenamed("cik", "_cik"), F.col("_id") == F.col("observation_id"), "left")
    good = F.coalesce((F.col("_cik") == F.col("cik")) & F.col("eligible") & (F.col("filed_date") <= day) & F.col("value").isNotNull(), F.lit(False))
    line = F.struct("end_date", "observation_id", "start_date", "coordinate")
    out = rows.groupBy("declaration_id", "cik", "confirmed", "available_on").agg(
        F.max(F.size("_ids")).alias("_n"), F.count("_id").alias("_k"), F.count("observation_id").alias("_found"), F.count_if(good).alias("_good"), F.countDistinct("scope").alias("_scopes"), F.max("end_date").alias("_end"),
        F.max("_rivals").alias("_rivals"), F.sum("value").alias("_sum"), F.sort_array(F.collect_list(F.when(F.col("observation_id").isNotNull(), line))).alias("_q"),
    )
    latest = observations.where("eligible").groupBy("cik").agg(F.max("end_date").alias("_latest"))
    out = out.join(latest, "cik", "left")
    steps = lambda test: F.forall(F.sequence(F.lit(1), F.lit(3)), lambda i: test(F.get("_q", i - 1), F.get("_q", i)))
    length = F.forall("_q", lambda q: F.datediff(q["end_date"], q["start_date"]).between(75, 105))
    reason = (
        F.when(~F.col("confirmed"), "CLASS_OR_BASIS_NOT_CONFIRMED").when(F.col("available_on").isNull() | (F.col("available_on") > day), "BASIS_EVIDENCE_AFTER_CUTOFF")
        .when((F.coalesce("_n", F.lit(0)) != 4) | (F.col("_k") != 4), "FOUR_DIRECT_QUARTERS_REQUIRED").when(F.col("_found") != 4, "INPUT_IDENTITY_NOT_CONFIRMED").when(F.col("_good") != 4, "FOUR_DIRECT_QUARTERS_REQUIRED")
        .when(F.col("_end") != F.col("_latest"), "LATEST_DIRECT_QUARTERS_NOT_PREPARED").when(F.col("_scopes") != 1, "SCOPE_OR_UNIT_NOT_COMPATIBLE")
        .when(~steps(lambda a, b: b["coordinate"] == a["coordinate"] + 1), "QUARTER_GAP_OR_DUPLICATE").when(~F.coalesce(length, F.lit(False)), "ACTUAL_PERIOD_NOT_CONFIRMED")
        .when(~steps(lambda a, b: a["end_date"] == b["start_date"]), "QUARTER_GAP_OR_DUPLICATE").when(F.col("_rivals") != 1, "AMBIGUOUS_DIRECT_QUARTER")
    )
    return out.withColumn("reason", reason).withColumn("value", F.when(F.col("reason").isNull(), F.col("_sum"))).select("declaration_id", "cik", "reason", "value")


def change_table(cells: DataFrame, keys: list[str], coordinate: str, back: int, kind: str, signature: str) -> DataFrame:
    """Growth of amounts, and percentage points of metrics whose kind is PERCENT, over back periods; equal signatures only."""
    prior = predecessor(cells, keys, coordinate, back, signature).withColumnRenamed("prior", "_s")
    rows = predecessor(prior, keys, coordinate, back).withColumn("_g", growth("value", "prior"))
    fine = F.col(signature).eqNullSafe(F.col("_s"))
    percent = F.col(kind) == "PERCENT"
    status = (
        F.when(F.col("value").isNull(), "INPUT_UNAVAILABLE").when(F.col("prior").isNull(), "PREDECESSOR_MISSING").when(~fine, "SIGNATURE_MISMATCH")
        .when(percent, "PERCENTAGE_POINTS").otherwise(F.col("_g.status"))
    )
    rows = rows.withColumn("status", status)
    open_ = F.col("status").isin("INPUT_UNAVAILABLE", "PREDECESSOR_MISSING", "SIGNATURE_MISMATCH")
    return rows.select(*keys, coordinate, kind, "status", F.when(~open_ & ~percent, F.col("_g.rate")).alias("rate"), F.when(~open_ & percent, F.col("value") - F.col("prior")).alias("points"))


def add_metric(parent: DataFrame, inventory: DataFrame, rows: DataFrame, metric: str, keys: list[str], reason: str) -> DataFrame:
    """parent and a cell of a new metric for each place of the inventory, UNAVAILABLE for reason where rows has none.

    A metric that the parent has already is an error, and so are rows outside
    the inventory.
    """
    if not parent.where(F.col("metric") == metric).isEmpty():
        raise ValueError(f"{metric} would overwrite a metric of the parent")
    if not rows.join(inventory, keys, "left_anti").isEmpty():
        raise ValueError(f"{metric} has rows outside the inventory")
    cells = inventory.select(*keys).distinct().join(rows.select(*keys, "value"), keys, "left").withColumn("metric", F.lit(metric))
    return parent.unionByName(cells.withColumn("reason", F.when(F.col("value").isNull(), reason)))


def at_period(observations: DataFrame, policy: str, metrics: list[str], company: str = "cik", **given: int) -> DataFrame:
    """The observations of one period of each company, by a policy.

    FIXED_FISCAL_YEAR (fiscal_year); FIXED_CALENDAR_QUARTER_END (calendar_year,
    calendar_quarter); LATEST_COMPANY_PERIOD: each company's newest fiscal year
    with any observation; LATEST_COMPLETE_ANNUAL (offset): its newest year in
    which each of metrics has a value, offset such years back.
    """
    if policy == "FIXED_FISCAL_YEAR":
        return observations.where(F.col("fiscal_year") == given["fiscal_year"])
    if policy == "FIXED_CALENDAR_QUARTER_END":
        return observations.where((F.col("calendar_year") == given["calendar_year"]) & (F.col("calendar_quarter") == given["calendar_quarter"]))
    if policy == "LATEST_COMPANY_PERIOD":
        newest = observations.groupBy(company).agg(F.max("fiscal_year").alias("fiscal_year"))
        return observations.join(newest, [company, "fiscal_year"], "left_semi")
    if policy != "LATEST_COMPLETE_ANNUAL":
        raise ValueError(f"unknown period policy {policy}")
    own = observations.where(F.col("metric").isin(*metrics) & F.col("value").isNotNull())
    complete = own.groupBy(company, "fiscal_year").agg(F.countDistinct("metric").alias("_n")).where(F.col("_n") == len(metrics))
    back = F.row_number().over(Window.partitionBy(company).orderBy(F.col("fiscal_year").desc())) - 1
    chosen = complete.withColumn("_back", back).where(F.col("_back") == given.get("offset", 0))
    return observations.join(chosen, [company, "fiscal_year"], "left_semi")


def screen_universe(universe: DataFrame, observations: DataFrame, predicates: list[tuple[str, str, float]], company: str = "cik") -> DataFrame:
    """screen() for each company of a universe; one without any observation is UNDETERMINED in all."""
    found = screen(observations, predicates, company).select(company, "result", "undetermined")
    every = F.array(*[F.lit(name) for name, _, _ in predicates])
    rows = universe.select(company).join(found, company, "left")
    return rows.withColumn("undetermined", F.when(F.col("result").isNull(), every).otherwise(F.col("undetermined"))).withColumn("result", F.coalesce("result", F.lit("UNDETERMINED")))


#: The price metrics that a condition may name; distributions and scenarios may not be screened.
PRICE_METRICS = (
    *(f"price_return_{n}s" for n in (1, 5, 21, 63, 126, 252)), *(f"volatility_{n}s" for n in (20, 60, 252)), "relative_volume_20s",
    "market_cap", "per", "pbr", "ps", "earnings_yield", "fcf_yield", "ev", "ev_revenue", "ev_ebitda",
)


def screen_prices(universe: DataFrame, observations: DataFrame, conditions: list[tuple[str, str, float]], as_of: str, company: str = "cik") -> DataFrame:
    """1 to 32 conditions over the price metrics of one session."""
    if not 1 <= len(conditions) <= 32:
        raise ValueError("1 to 32 conditions")
    odd = [name for name, _, _ in conditions if name not in PRICE_METRICS]
    if odd:
        raise ValueError(f"not a price metric: {odd[0]}")
    return screen_universe(universe, observations.where(F.col("trade_date") == F.lit(as_of).cast("date")), conditions, company)
