"""Period classes, comparatives, knowledge cutoff, and gates from raw facts to observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofworks.functions.scalars import col, first_reason, reasons

#: Days of a duration class, both ends included.
DURATIONS = (("QTD_3M", 75, 105), ("YTD_6M", 160, 205), ("YTD_9M", 250, 300), ("FY", 350, 378))


def classify_period(start: str, end: str, instant: Column | None = None) -> Column:
    """INSTANT if instant says so, else a class by the days from start to exclusive end, else OTHER_DURATION."""
    days = F.datediff(F.col(end), F.col(start))
    out = F.when(instant, "INSTANT") if instant is not None else F.when(F.lit(False), "INSTANT")
    for name, low, high in DURATIONS:
        out = out.when(days.between(low, high), name)
    return out.otherwise("OTHER_DURATION")


def classify_annual(start: str, end: str, form: str, focus_period: str, report_date: str, fye_month: str, fye_day: str) -> Column:
    """struct(period_class, reason) of a duration of 350 to 378 days.

    FY needs a start within 7 days of the exclusive end's anniversary, and a
    10-K whose report date is the end, or an end within 7 days of the fiscal
    year end; a 10-Q at that date makes it TTM.
    """
    s, e, focus = F.col(start), F.col(end), F.col(report_date)
    last = F.date_sub(e, 1)
    day = F.when(F.month(e) == 2, F.least(F.day(e), F.lit(28))).otherwise(F.day(e))
    anniversary = F.make_date(F.year(e) - 1, F.month(e), day)
    base = F.regexp_replace(F.col(form), "/A$", "")
    at_focus = (e == focus) | (e == F.date_add(focus, 1))
    near = F.lit(False)
    for shift in (-1, 0, 1):
        day_of = F.try_to_date(F.concat_ws("-", (F.year(last) + shift).cast("string"), F.lpad(F.col(fye_month).cast("string"), 2, "0"), F.lpad(F.col(fye_day).cast("string"), 2, "0")), "yyyy-MM-dd")
        near = near | F.coalesce(F.abs(F.datediff(last, day_of)) <= 7, F.lit(False))
    make = lambda c, r: F.struct(F.lit(c).alias("period_class"), F.lit(r).alias("reason"))
    return (
        F.when(s.isNull() | e.isNull(), make("OTHER_DURATION", "ANNUAL_BOUNDARY_EVIDENCE_MISSING"))
        .when(F.abs(F.datediff(s, anniversary)) > 7, make("OTHER_DURATION", "ANNUAL_START_BOUNDARY_MISMATCH"))
        .when((base == "10-K") & (F.col(focus_period) == "FY") & at_focus, make("FY", "ANNUAL_FILING_CONTEXT_BOUNDARIES"))
        .when(near, make("FY", "DEI_FISCAL_END_AND_ANNUAL_START_ALIGNMENT"))
        .when(at_focus & (base == "10-Q") & F.col(fye_month).isNotNull(), make("TTM", "ROLLING_ANNUAL_DURATION_AT_INTERIM_FOCUS"))
        .otherwise(make("OTHER_DURATION", "ANNUAL_BOUNDARY_EVIDENCE_MISSING"))
    )


def comparative_type(observed: str, period_class: str, focus: str, fye_month: Column | None = None, fye_day: Column | None = None) -> Column:
    """How a context's end stands to the filing's focus; an end one day after the focus counts as the focus."""
    f = F.col(focus)
    o = F.when(F.datediff(F.col(observed), f) == 1, f).otherwise(F.col(observed))
    instant = F.col(period_class) == "INSTANT"
    balance = F.lit(False) if fye_month is None else instant & (F.month(o) == fye_month) & (F.day(o) == fye_day) & (o < f)
    return (
        F.when(o.isNull() | f.isNull(), "OTHER_COMPARATIVE_CONTEXT")
        .when(o == f, "CURRENT_FOCUS")
        .when(~instant & F.datediff(f, o).between(330, 390), "PRIOR_YEAR_COMPARABLE")
        .when(balance, "PRIOR_FY_BALANCE")
        .otherwise("OTHER_COMPARATIVE_CONTEXT")
    )


def as_of(df: DataFrame, date: str, column: str = "filed_date") -> DataFrame:
    """Rows known at a date."""
    return df.where(F.col(column) <= F.lit(date).cast("date"))


def gate(df: DataFrame, *checks: tuple[Column, str]) -> DataFrame:
    """df with reasons, all that fail a row in order, and the first of them; rows are never dropped."""
    return df.withColumn("reasons", reasons(*checks)).withColumn("unavailable_reason", first_reason("reasons"))


def dimension_signature(dims: DataFrame, key: str, *parts: str) -> DataFrame:
    """One sorted array of (axis, member, ...) for each fact, and a hash of it as join key (A2)."""
    signature = F.array_sort(F.collect_list(F.struct(*parts)))
    return dims.groupBy(key).agg(signature.alias("signature")).withColumn("signature_hash", F.sha2(F.to_json("signature"), 256))


def attach_mapping(rows: DataFrame, mapping: DataFrame, raw: str) -> DataFrame:
    """The canonical id of a raw id; unmapped or unreviewed ids get one of their own and REVIEW_REQUIRED."""
    m = mapping.select(F.col("raw_id").alias("_raw"), "canonical_id", "reviewed")
    found = rows.join(m, F.col(raw) == F.col("_raw"), "left")
    fine = F.col("canonical_id").isNotNull() & F.col("reviewed")
    own = F.concat(F.when(F.col("canonical_id").isNull(), "raw-unmapped:").otherwise("raw-review:"), F.col(raw).cast("string"))
    return found.withColumn("mapping_status", F.when(fine, "MAPPED").otherwise("REVIEW_REQUIRED")).withColumn("canonical_id", F.when(fine, F.col("canonical_id")).otherwise(own)).drop("_raw", "reviewed")


def assign_roles(rows: DataFrame, roles: dict[str, str], name: str) -> DataFrame:
    """The metric role of a standard local name, by an exact lookup."""
    lookup = rows.sparkSession.createDataFrame(list(roles.items()), "_name string, role string")
    return rows.join(F.broadcast(lookup), F.col(name) == F.col("_name"), "left").drop("_name")


def join_ledger(rows: DataFrame, ledger: DataFrame, key: str, agree: dict[str, str]) -> DataFrame:
    """rows with ledger_status: MATCH, NOT_IN_LEDGER, AMBIGUOUS_LEDGER or DISAGREES, the ledger's key being key."""
    one = ledger.groupBy(F.col(key).alias("_key")).agg(F.count("*").alias("_n"), *[F.min(theirs).alias(f"_{theirs}") for theirs in agree.values()])
    same = F.lit(True)
    for ours, theirs in agree.items():
        same = same & F.col(ours).eqNullSafe(F.col(f"_{theirs}"))
    found = rows.join(one, F.col(key) == F.col("_key"), "left")
    status = F.when(F.col("_n").isNull(), "NOT_IN_LEDGER").when(F.col("_n") > 1, "AMBIGUOUS_LEDGER").when(~same, "DISAGREES").otherwise("MATCH")
    return found.withColumn("ledger_status", status).drop("_key", "_n", *[f"_{t}" for t in agree.values()])


def has_match(rows: DataFrame, others: DataFrame, keys: list[str], name: str) -> DataFrame:
    """rows with a flag for whether others has their keys."""
    return rows.join(others.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").fillna({name: False})


#: An accession within a description, and the ordinal that an amendment gives itself.
ACCESSION = r"\b\d{10}-\d{2}-\d{6}\b"
ORDINAL = r"(?i)\bamendment\s+(?:number|no\.?|#)\s*(\d+)\b"


def filing_ledger(filings: DataFrame, amends: str | None = None, description: str | None = None, flag: str | None = None) -> DataFrame:
    """One version row per filing: base form, ordinal within it, and the filing that it amends.

    A filing is an amendment if its form or its column is_amendment says so.
    One that names the filing it amends (column amends, not blank) is LINKED, as
    is one whose description names exactly one accession.  Of all others the
    original filings of the same company, base form and report date (none equals
    none), filed on an earlier day, are compatible: exactly one is a CANDIDATE
    that needs review, none or several leave the link UNKNOWN.  No chain is
    inferred.  reported_ordinal is what the description calls the amendment,
    flag_state what the reported flag says.
    """
    text = lambda c: F.col(c).cast("string") if c else F.lit(None).cast("string")
    named = F.when(F.trim(text(amends)) != "", F.col(amends)) if amends else F.lit(None)
    kind = dict(filings.dtypes)["accession"]
    said = F.array_distinct(F.regexp_extract_all(text(description), F.lit(ACCESSION), F.lit(0)))
    described = F.when(F.size(said) == 1, F.get(said, F.lit(0)))
    base = F.regexp_replace("form", "/A$", "")
    marked = F.coalesce(F.col("is_amendment"), F.lit(False)) if "is_amendment" in filings.columns else F.lit(False)
    rows = filings.withColumn("base_form", base).withColumn("is_amendment", F.coalesce(F.col("form").endswith("/A"), F.lit(False)) | marked)
    rows = rows.withColumn("ordinal", F.row_number().over(Window.partitionBy("cik", "base_form").orderBy("filed_date", "accession")))
    earlier = Window.partitionBy("cik", "base_form", "report_date").orderBy(F.unix_date("filed_date")).rangeBetween(Window.unboundedPreceding, -1)
    original = F.when(F.col("form") == F.col("base_form"), F.col("accession"))
    rows = rows.withColumn("_n", F.count(original).over(earlier)).withColumn("_one", F.min(original).over(earlier)).withColumn("_described", described)
    method = (
        F.when(~F.col("is_amendment"), "NOT_AN_AMENDMENT").when(named.isNotNull(), "RAW_FILING_AMENDS_ACCESSION").when(F.col("_described").isNotNull(), "DEI_DESCRIPTION_ACCESSION")
        .when(F.col("_n") == 1, "FORM_REPORT_DATE_COMPATIBLE_CANDIDATE").otherwise("UNKNOWN")
    )
    rows = rows.withColumn("link_method", method)
    how = F.col("link_method")
    state = F.when(how == "NOT_AN_AMENDMENT", "NOT_APPLICABLE").when(how.isin("RAW_FILING_AMENDS_ACCESSION", "DEI_DESCRIPTION_ACCESSION"), "LINKED").when(how == "UNKNOWN", "UNKNOWN").otherwise("CANDIDATE")
    target = F.when(how == "RAW_FILING_AMENDS_ACCESSION", named.cast("string")).when(how == "DEI_DESCRIPTION_ACCESSION", F.col("_described")).when(how == "FORM_REPORT_DATE_COMPATIBLE_CANDIDATE", F.col("_one").cast("string"))
    rows = rows.withColumn("link_state", state).withColumn("amends", target if description or kind == "string" else target.cast(kind))
    review = F.when(F.col("link_state") == "CANDIDATE", "REVIEW_REQUIRED").when(F.col("link_state") == "UNKNOWN", "UNKNOWN").otherwise("NOT_REQUIRED")
    reported = F.nullif(F.regexp_extract(text(description), ORDINAL, 1), F.lit(""))
    raised = F.lower(F.trim(text(flag))).isin("true", "1")
    told = F.when(text(flag).isNull(), "NOT_REPORTED").when(raised, "REPORTED_TRUE").otherwise("REPORTED_FALSE")
    return rows.withColumn("review_status", review).withColumn("reported_ordinal", reported).withColumn("flag_state", told).drop("_n", "_one", "_described")


def trailing_filings(filings: DataFrame, years: int, annual: str = "10-K") -> DataFrame:
    """Filings with a report date after the baseline before the last years baselines; a baseline is the first annual filing of a report date."""
    per_date = filings.where(F.col("form") == annual).groupBy("cik", "report_date").agg(F.min("filed_date").alias("_first"))
    newest = Window.partitionBy("cik").orderBy(F.col("report_date").desc())
    ranked = per_date.withColumn("_rank", F.row_number().over(newest))
    bound = ranked.where(F.col("_rank") == years + 1).select("cik", F.col("report_date").alias("_bound"))
    known = ranked.where(F.col("_rank") <= years).select("cik").distinct()
    return filings.join(known, "cik", "left_semi").join(bound, "cik", "left").where(F.col("_bound").isNull() | (F.col("report_date") > F.col("_bound"))).drop("_bound")


def select_cohort(filings: DataFrame, declared: DataFrame, keys: list[str]) -> DataFrame:
    """Declared rows with cohort_status: FOUND, MISSING or DUPLICATE (S3)."""
    counted = filings.groupBy(*keys).agg(F.count("*").alias("_n"))
    status = F.when(F.col("_n").isNull(), "MISSING").when(F.col("_n") > 1, "DUPLICATE").otherwise("FOUND")
    return declared.join(counted, keys, "left").withColumn("cohort_status", status).drop("_n")


def find_filings(filings: DataFrame, **exact: object) -> DataFrame:
    """All filings that equal every field given; a field that is left out is not inferred."""
    for name, value in exact.items():
        if value is not None:
            filings = filings.where(col(name) == F.lit(value))
    return filings
