"""Bindings that show every row: mappings over companies, declared fourth quarters, transformed source text, and the quarter explorer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asofworks.operators.composed import normalize_duration

#: Filer categories by their text in lower case, the ballot boxes, and the transforms of durations.
FILERS = {"large accelerated filer": "Large Accelerated Filer", "accelerated filer": "Accelerated Filer", "non-accelerated filer": "Non-accelerated Filer", "smaller reporting company": "Smaller Reporting Company", "emerging growth company": "Emerging Growth Company"}
BOXES = {"☐": "false", "☑": "true", "☒": "true"}
DURATIONS = ("durday", "durweek", "durmonth", "duryear", "durhour")


def apply_cross_mapping(observations: DataFrame, mappings: DataFrame) -> DataFrame:
    """Every observation (entity_type, company_canonical_id, ...) once, with its mapping over companies.

    mappings has one row per entity_type and company_canonical_id: analytical_id,
    relation, confidence, method, review_required.  An observation without one is
    UNRESOLVED, of confidence 0, and needs review; nothing is left out or promoted.
    """
    key = ["entity_type", "company_canonical_id"]
    names = {"analytical_id": "analytical_id", "relation": "mapping_relation", "confidence": "mapping_confidence", "method": "mapping_method", "review_required": "mapping_review_required"}
    rows = observations.join(mappings.select(*key, *[F.col(c).alias(n) for c, n in names.items()]), key, "left")
    default = {"mapping_relation": "UNRESOLVED", "mapping_confidence": 0.0, "mapping_method": "NO_CROSS_COMPANY_MAPPING", "mapping_review_required": True}
    return rows.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in default.items()})


def policy_q4(facts: DataFrame, declarations: DataFrame, scope: list[str], registry: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(candidates, exclusions): FY less nine months only of concepts that a reviewed declaration permits.

    facts has the scope columns (concept among them), fact_id, period_class,
    start_date, end_date, value, source_type and safe (monetary and additive by
    its raw semantics).  A declaration permits a concept if it is a
    REVIEWED_ADDITIVE_AMOUNT, its value_kind ADDITIVE_AMOUNT, and is_additive.
    By scope, in order: no such declaration; a fact that isn't safe; no FY or no
    nine months; then pairs of equal start whose nine months end before the
    year.  A fact in no pair is excluded once, with the reason of its class.
    registry, if given, has fact_id pairs (fy_id, ytd_id) whose full scope was
    reviewed: other candidates become exclusions.  Facts of a scope are paired
    only by start, so many years don't multiply.
    """
    allowed = declarations.where((F.col("semantic_review_state") == "REVIEWED_ADDITIVE_AMOUNT") & (F.col("value_kind") == "ADDITIVE_AMOUNT") & F.col("is_additive")).select("concept", "declaration_id").dropDuplicates(["concept"])
    rows = facts.where(F.col("period_class").isin("FY", "YTD_9M")).join(allowed, "concept", "left")
    of = lambda k: F.count_if(F.col("period_class") == k)
    whole = rows.groupBy(*scope).agg(F.bool_and(F.coalesce("safe", F.lit(False))).alias("_safe"), of("FY").alias("_fy"), of("YTD_9M").alias("_ytd"))
    why = F.when(F.col("declaration_id").isNull(), "Q4_SEMANTIC_DECLARATION_REQUIRED").when(~F.col("_safe"), "Q4_REVIEWED_MONETARY_ADDITIVE_SEMANTICS_REQUIRED").when((F.col("_fy") == 0) | (F.col("_ytd") == 0), "Q4_COMPATIBLE_FY_AND_YTD9M_REQUIRED")
    rows = rows.join(whole, scope).withColumn("_why", why)
    some = rows.where("_why is null")
    side = lambda k, name: some.where(F.col("period_class") == k).select(*scope, "start_date", *[F.col(c).alias(f"{name}_{c}") for c in ("fact_id", "end_date", "value", "source_type")], *(["declaration_id"] if name == "fy" else []))
    pairs = side("FY", "fy").join(side("YTD_9M", "ytd"), [*scope, "start_date"])
    reason = (
        F.when((F.col("fy_source_type") != "REPORTED") | (F.col("ytd_source_type") != "REPORTED"), "Q4_REPORTED_SOURCES_REQUIRED").when(F.col("ytd_end_date") >= F.col("fy_end_date"), "Q4_PERIOD_BOUNDARIES_INCOMPATIBLE")
        .when(F.col("fy_value").isNull() | F.col("ytd_value").isNull(), "Q4_NON_NUMERIC_SOURCE")
    )
    pairs = pairs.withColumn("reason", reason)
    if registry is not None:
        pairs = pairs.join(registry.select(F.col("fy_id").alias("fy_fact_id"), F.col("ytd_id").alias("ytd_fact_id")).distinct().withColumn("_seen", F.lit(True)), ["fy_fact_id", "ytd_fact_id"], "left")
        pairs = pairs.withColumn("reason", F.coalesce("reason", F.when(F.col("_seen").isNull(), "Q4_V2_EXACT_SCOPE_POLICY_REQUIRED"))).drop("_seen")
    candidates = pairs.where("reason is null").select(*scope, "start_date", F.col("ytd_end_date").alias("q4_start"), F.col("fy_end_date").alias("q4_end"), "fy_fact_id", "ytd_fact_id", "declaration_id", (F.col("fy_value") - F.col("ytd_value")).alias("value"))
    met = pairs.select(F.explode(F.array("fy_fact_id", "ytd_fact_id")).alias("fact_id")).distinct()
    alone = some.join(met, "fact_id", "left_anti").select("fact_id", F.lit(None).cast(dict(facts.dtypes)["fact_id"]).alias("other_id"), F.lit("Q4_FISCAL_START_MISMATCH").alias("reason"))
    refused = rows.where("_why is not null").select("fact_id", F.lit(None).cast(dict(facts.dtypes)["fact_id"]).alias("other_id"), F.col("_why").alias("reason"))
    unfit = pairs.where("reason is not null").select(F.col("fy_fact_id").alias("fact_id"), F.col("ytd_fact_id").alias("other_id"), "reason")
    return candidates, refused.unionByName(alone).unionByName(unfit)


def normalize_lexical(rows: DataFrame, value: str, transform: str, lookups: DataFrame | None = None) -> DataFrame:
    """rows with normalized, by the transform that each row's own column names, and normalize_status.

    Durations, boolballotbox and entityfilercategoryen are built in; lookups
    (transform, text, code) has all others, say countries, states or exchanges,
    by their text in lower case with single spaces.  OK, INVALID_TEXT for a text
    that the transform doesn't know, UNSUPPORTED_TRANSFORM for one that nobody
    knows, NO_TRANSFORM where none is named (the text stays).
    """
    key = F.lower(F.trim(F.regexp_replace(value, r"\s+", " ")))
    table: list[tuple[str, str, str]] = [("entityfilercategoryen", k, v) for k, v in FILERS.items()] + [("boolballotbox", k, v) for k, v in BOXES.items()]
    known = rows.sparkSession.createDataFrame(table, "_transform string, _text string, _code string")
    if lookups is not None:
        known = known.unionByName(lookups.select(F.col("transform").alias("_transform"), F.col("text").alias("_text"), F.col("code").alias("_code")))
    named = known.select(F.col("_transform").alias("_named")).distinct()
    durations: Column = F.lit(None).cast("string")
    rows = rows.withColumn("_number", F.trim(F.col(value)))
    for unit in DURATIONS:
        durations = F.when(F.col(transform) == unit, normalize_duration("_number", unit)).otherwise(durations)
    out = rows.withColumn("_key", key).join(known, (F.col(transform) == F.col("_transform")) & (F.col("_key") == F.col("_text")), "left").join(named, F.col(transform) == F.col("_named"), "left")
    found = F.when(F.col(transform).isNull(), F.col(value)).when(F.col(transform).isin(*DURATIONS), durations).otherwise(F.col("_code"))
    status = F.when(F.col(transform).isNull(), "NO_TRANSFORM").when(F.col("_named").isNull() & ~F.col(transform).isin(*DURATIONS), "UNSUPPORTED_TRANSFORM").when(F.col("normalized").isNull(), "INVALID_TEXT").otherwise("OK")
    out = out.withColumn("normalized", found)
    return out.withColumn("normalize_status", status).drop("_number", "_key", "_transform", "_text", "_code", "_named")


def check_transforms(source: DataFrame, facts: DataFrame, key: list[str], lookups: DataFrame | None = None) -> DataFrame:
    """Source rows (key, text, transform) against stored facts (key, value), each row of either side once.

    MATCH or MISMATCH of what the transform makes of the text and what is stored;
    FACT_MISSING, SOURCE_MISSING where one side has no row; the status of
    normalize_lexical() where the text can't be transformed.
    """
    made = normalize_lexical(source, "text", "transform", lookups).withColumn("_source", F.lit(True))
    stored = facts.select(*key, F.col("value").alias("stored"), F.lit(True).alias("_fact"))
    rows = made.join(stored, key, "full_outer")
    status = (
        F.when(F.col("_source").isNull(), "SOURCE_MISSING").when(F.col("_fact").isNull(), "FACT_MISSING").when(~F.col("normalize_status").isin("OK", "NO_TRANSFORM"), F.col("normalize_status"))
        .when(F.col("normalized").eqNullSafe(F.col("stored")), "MATCH").otherwise("MISMATCH")
    )
    return rows.select(*key, "text", "transform", "normalized", "stored", status.alias("status"))


def quarter_explorer(observations: DataFrame, inventory: DataFrame, metrics: list[str], bucket: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, coverage): every company's metrics of one calendar quarter, or of its own latest, and how many companies have each.

    inventory (cik, bucket, bucket_status) has a row for each company and quarter;
    observations (cik, bucket, metric, value, reason, blocked).  A company whose
    quarter isn't PERIOD_AVAILABLE, in the latest form, has PERIOD_NOT_PREPARED
    for all metrics; a metric without a row is OBSERVATION_MISSING.  Coverage
    counts values that no quality decision blocks, out of all companies.
    """
    if bucket is None:
        period = inventory.where("bucket_status <> 'NO_FILING_AS_OF_CUTOFF'").groupBy("cik").agg(F.max_by(F.struct("bucket", "bucket_status"), "bucket").alias("p"))
        period = inventory.select("cik").distinct().join(period, "cik", "left").select("cik", F.col("p.bucket").alias("bucket"), F.coalesce("p.bucket_status", F.lit("NO_FILING_AS_OF_CUTOFF")).alias("bucket_status"))
        prepared = F.col("bucket_status") == "PERIOD_AVAILABLE"
    else:
        period, prepared = inventory.where(F.col("bucket") == bucket), F.lit(True)
    grid = period.withColumn("_prepared", prepared).select("*", F.explode(F.array(*[F.lit(m) for m in metrics])).alias("metric"))
    rows = grid.join(observations.select("cik", "bucket", "metric", "value", "reason", "blocked", F.lit(True).alias("_has")), ["cik", "bucket", "metric"], "left")
    why = F.when(~F.col("_prepared"), "PERIOD_NOT_PREPARED").when(F.col("_has").isNull(), "OBSERVATION_MISSING").otherwise(F.col("reason"))
    rows = rows.withColumn("reason", why).withColumn("value", F.when(F.col("reason").isNull(), F.col("value"))).drop("_prepared", "_has")
    usable = F.col("value").isNotNull() & ~F.coalesce("blocked", F.lit(False))
    coverage = rows.groupBy("metric").agg(F.count_if(usable).alias("companies_available"), F.count("*").alias("companies_total"))
    return rows, coverage
