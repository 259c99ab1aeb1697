"""Sources and sinks: raw tables with fixed schemas, submissions, targets, panels, decisions, exports."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.functions.scalars import canonical_cik, filing_date

#: Columns of the raw tables; names without a type are text.
RAW = {
    "filing": "filing_id, cik, accession, accession_nodash, form, filed_date, report_date, primary_document, document_fiscal_year_focus, document_fiscal_period_focus, fiscal_year_end, is_amendment boolean, amends_accession, source_url, package_hash, parser_version",
    "concept": "raw_concept_id, filing_id, qname, namespace_uri, namespace_prefix, local_name, taxonomy_family, taxonomy_version, is_standard boolean, is_custom boolean, data_type, period_type, balance, abstract boolean, nillable boolean, label, documentation",
    "context": "context_id, filing_id, entity_identifier, period_kind, start_date, end_date, instant_date, duration_days bigint, dimension_count bigint, context_xml, context_hash",
    "unit": "unit_id, filing_id, numerator_measures, denominator_measures, raw_representation",
    "fact": "fact_id, filing_id, raw_concept_id, context_id, unit_id, value_numeric, value_text, decimals, precision, is_nil boolean, source_document, source_locator, reported_or_derived, period_class, comparative_type, raw_value",
    "dimension_fact": "fact_id, axis_raw_concept_id, member_raw_concept_id, typed_member, dimension_type, is_default_member boolean",
    "role": "role_id, filing_id, role_uri, role_definition, role_category",
    "relationship": "relationship_id, filing_id, network_type, role_id, arcrole, link_qname, arc_qname, from_raw_concept_id, to_raw_concept_id, order, weight, preferred_label, target_role_uri, usable boolean, closed boolean, context_element, source_document, source_locator",
}
#: Forms that submissions are read for.
FORMS = ("10-K", "10-K/A", "10-Q", "10-Q/A")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share; in local mode without one, in a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='spark-scratch-')}"
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once to the shared folder, where several branches of a plan read it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def raw_schema(table: str) -> str:
    """The schema of a raw table as DDL."""
    fields = [f.split() for f in RAW[table].split(", ")]
    return ", ".join(f"`{f[0]}` {f[1] if len(f) > 1 else 'string'}" for f in fields)


def read_raw(spark: SparkSession, path: str, tables: tuple[str, ...] = tuple(RAW), ciks: list[str] | None = None) -> dict[str, DataFrame]:
    """The raw tables under path, partitioned by cik; ciks prune the scan."""
    out = {}
    for name in tables:
        parts = "" if name == "filing" else ", `cik` string"
        df = spark.read.schema(raw_schema(name) + parts).parquet(f"{path}/{name}")
        out[name] = df.where(F.col("cik").isin(*ciks)) if ciks is not None else df
    return out


def read_submissions(spark: SparkSession, path: str) -> DataFrame:
    """One row per filing of a submissions file of parallel arrays, supported forms only, with status.

    UNEQUAL_LENGTHS marks a file whose arrays differ in length, CONFLICT an
    accession that comes twice with different rows; equal repeats are one row.
    """
    names = ["accessionNumber", "form", "filingDate", "reportDate", "primaryDocument", "isXBRL", "isInlineXBRL"]
    fields = ", ".join(f"{n}: array<string>" for n in names)
    raw = spark.read.schema(f"cik string, filings struct<recent: struct<{fields}>>").option("multiLine", "true").json(path)
    recent = {n: F.col(f"filings.recent.{n}") for n in names}
    equal = F.lit(True)
    for n in names[1:]:
        equal = equal & (F.size(recent[n]) == F.size(recent["accessionNumber"]))
    rows = raw.select("cik", equal.alias("_equal"), F.explode(F.arrays_zip(*[recent[n].alias(n) for n in names])).alias("r"))
    flag = lambda c: F.lower(c).isin("1", "true")
    flat = rows.select(
        canonical_cik("cik").alias("cik"), F.col("r.accessionNumber").alias("accession"), F.col("r.form").alias("form"), filing_date("r.filingDate").alias("filed_date"), filing_date("r.reportDate").alias("report_date"),
        F.col("r.primaryDocument").alias("primary_document"), flag(F.col("r.isXBRL")).alias("is_xbrl"), flag(F.col("r.isInlineXBRL")).alias("is_inline_xbrl"), "_equal",
    )
    kept = flat.where(F.col("form").isin(*FORMS)).distinct()
    n = kept.groupBy("accession").agg(F.count("*").alias("_n"))
    status = F.when(~F.col("_equal"), "UNEQUAL_LENGTHS").when(F.col("_n") > 1, "CONFLICT").otherwise("OK")
    return kept.join(n, "accession").withColumn("status", status).drop("_equal", "_n")


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Companies of a JSONL list, padded, with DUPLICATE and INVALID marked."""
    raw = spark.read.schema("cik string, ticker string, name string").json(path)
    rows = raw.withColumn("canonical", canonical_cik("cik"))
    n = rows.groupBy(F.col("canonical").alias("_c")).agg(F.count("*").alias("_n"))
    status = F.when(F.col("canonical").isNull(), "INVALID").when(F.col("_n") > 1, "DUPLICATE").otherwise("OK")
    return rows.join(n, F.col("canonical").eqNullSafe(F.col("_c"))).select(F.col("canonical").alias("cik"), "ticker", "name", status.alias("status"))


def company_metadata(observations: DataFrame, inventory: DataFrame, industries: DataFrame, cutoff: str) -> DataFrame:
    """The newest observation of each company at a cutoff, its industry, CANDIDATE_ONLY without one, TICKER_COLLISION for a shared ticker."""
    known = observations.where(F.col("observed_on") <= F.lit(cutoff).cast("date"))
    others = [c for c in observations.columns if c != "cik"]
    newest = known.groupBy("cik").agg(F.max_by(F.struct(*others), "observed_on").alias("_o")).select("cik", *[F.col(f"_o.{c}").alias(c) for c in others])
    rows = inventory.join(newest, "cik", "full_outer").join(industries, "sic", "left")
    shared = rows.where(F.col("ticker").isNotNull()).groupBy("ticker", "exchange").agg(F.count("*").alias("_n"))
    rows = rows.join(shared, ["ticker", "exchange"], "left")
    return rows.withColumn("metadata_status", F.when(F.col("observed_on").isNull(), "CANDIDATE_ONLY").when(F.col("_n") > 1, "TICKER_COLLISION").otherwise("CURRENT")).drop("_n")


def write_panel(df: DataFrame, path: str, by: str = "cik", files: int | None = None) -> DataFrame:
    """Write a dataset partitioned by company and return the row count of each.

    Rows are spread by company and a hash, so a company with very many rows is
    written by several tasks.
    """
    spread = df.repartition(F.col(by), F.pmod(F.xxhash64(*df.columns), F.lit(8))) if files is None else df.repartition(files, F.col(by))
    spread.write.partitionBy(by).parquet(path)
    return df.sparkSession.read.parquet(path).groupBy(by).agg(F.count("*").alias("n_rows"))


def read_company_partition(spark: SparkSession, path: str, cik: object, accession: object | None = None) -> DataFrame:
    """One company's or filing's rows; the company is a partition, so no other is read."""
    rows = spark.read.parquet(path).where(F.col("cik") == F.lit(cik))
    return rows.where(F.col("accession") == F.lit(accession)) if accession is not None else rows


def canonical_json(df: DataFrame) -> DataFrame:
    """Each row as JSON with sorted fields, nulls kept (S8); write it with .write.text()."""
    return df.select(F.to_json(F.struct(*sorted(df.columns)), {"ignoreNullFields": "false"}).alias("value"))


def read_price_batch(companies: DataFrame, securities: DataFrame, prices: DataFrame, start: str, end: str) -> DataFrame:
    """Prices of each company's one security within dates; companies with none or several get the reason."""
    match = companies.join(securities, ["cik", "ticker"], "left").groupBy("cik", "ticker").agg(F.count("security_id").alias("_n"), F.min("security_id").alias("security_id"))
    match = match.withColumn("reason", F.when(F.col("_n") == 0, "SECURITY_MISSING").when(F.col("_n") > 1, "SECURITY_AMBIGUOUS"))
    match = match.withColumn("security_id", F.when(F.col("reason").isNull(), F.col("security_id"))).drop("_n")
    within = prices.where(F.col("trade_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    rows = match.join(within, "security_id", "left")
    return rows.withColumn("reason", F.coalesce("reason", F.when(F.col("trade_date").isNull(), "PRICE_MISSING")))


def read_decisions(spark: SparkSession, path: str, as_of: str) -> DataFrame:
    """Append-only decisions of a CSV file known at a time; resolve them with effective_decisions()."""
    schema = "decision_id string, issue_id string, ticker string, accession string, concept string, axis string, member string, decision string, known_at timestamp, reviewer string, reason string, evidence string"
    return spark.read.schema(schema).option("header", "true").csv(path).where(F.col("known_at") <= F.lit(as_of).cast("timestamp"))


def split_evidence(rows: DataFrame, key: str, wide: list[str]) -> tuple[DataFrame, DataFrame]:
    """A narrow core table and a wide evidence table."""
    return rows.drop(*wide), rows.select(key, *wide)


def hydrate(core: DataFrame, evidence: DataFrame, key: str) -> DataFrame:
    """The evidence of selected core rows only."""
    return core.join(evidence, key, "left")


def export_rows(df: DataFrame) -> DataFrame:
    """df for a spreadsheet: text that would start a formula is quoted (S14); write it with .write.csv() or .json()."""
    guard = lambda c: F.when(F.col(c).rlike(r"^[=+\-@]"), F.concat(F.lit("'"), F.col(c))).otherwise(F.col(c)).alias(c)
    return df.select(*[guard(c) if kind == "string" else F.col(c) for c, kind in df.dtypes])
