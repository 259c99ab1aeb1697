"""Composed analytical operators: panels, quarter metrics, reviewed values, shares, liabilities, core cells, comparisons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from asofworks.functions.scalars import growth, interval_divide, interval_subtract
from asofworks.operators.quarters import derive_quarter, predecessor, ttm


def coverage(facts: DataFrame, exclusions: DataFrame, company: str = "cik") -> DataFrame:
    """Facts and exclusions of each company."""
    a = facts.groupBy(company).agg(F.count("*").alias("facts"), F.countDistinct("concept").alias("concepts"))
    b = exclusions.groupBy(company).agg(F.count("*").alias("exclusions"))
    return a.join(b, company, "full_outer").fillna(0, ["facts", "concepts", "exclusions"])


def capability_inventory(facts: DataFrame, companies: DataFrame, keys: list[str]) -> DataFrame:
    """Observed combinations once each; companies without rows get a COVERAGE_UNAVAILABLE row."""
    seen = facts.select("cik", *keys).distinct().withColumn("status", F.lit("OBSERVED"))
    none = companies.select("cik").join(facts.select("cik").distinct(), "cik", "left_anti").withColumn("status", F.lit("COVERAGE_UNAVAILABLE"))
    return seen.unionByName(none, allowMissingColumns=True)


def reported_twelve_months(facts: DataFrame, scope: list[str], cutoff: str) -> DataFrame:
    """Direct facts of 350 to 378 days that end at the newest such end, one group or AMBIGUOUS."""
    annual = facts.where(F.datediff("end_date", "start_date").between(350, 378) & (F.col("filed_date") <= F.lit(cutoff).cast("date")))
    newest = annual.groupBy(*scope).agg(F.max("end_date").alias("end_date"))
    at = annual.join(newest, [*scope, "end_date"]).groupBy(*scope, "end_date").agg(F.countDistinct("value").alias("_n"), F.min("value").alias("value"))
    return at.withColumn("reason", F.when(F.col("_n") > 1, "AMBIGUOUS")).withColumn("value", F.when(F.col("_n") == 1, F.col("value"))).drop("_n")


def role_inventory(roles: DataFrame, arcs: DataFrame, facts: DataFrame, role: str) -> DataFrame:
    """Arcs, concepts and facts of each role."""
    a = arcs.groupBy(role).agg(F.count("*").alias("arcs"), F.countDistinct("child").alias("concepts"))
    f = facts.groupBy(role).agg(F.count("*").alias("facts"))
    return roles.select(role).join(a, role, "left").join(f, role, "left").fillna(0, ["arcs", "concepts", "facts"])


def review_inventory(candidates: list[tuple[str, DataFrame]], columns: list[str]) -> DataFrame:
    """Candidates of several kinds as one queue, without any calculation."""
    return reduce(DataFrame.unionByName, [df.select(*columns).withColumn("kind", F.lit(kind)) for kind, df in candidates])


def reviewed_quarters(candidates: DataFrame, approvals: DataFrame, keys: list[str], as_of: str) -> DataFrame:
    """Only exactly approved candidates become values; others are REVIEW_REQUIRED."""
    known = approvals.where(F.col("known_at") <= F.lit(as_of).cast("date")).select(*keys).distinct().withColumn("_ok", F.lit(True))
    rows = candidates.join(known, keys, "left")
    reason = F.coalesce("reason", F.when(F.col("_ok").isNull(), "REVIEW_REQUIRED"))
    return rows.withColumn("reason", reason).withColumn("value", F.when(F.col("reason").isNull(), F.col("value"))).drop("_ok")


def quarter_metrics(cells: DataFrame, keys: list[str], coordinate: str, spine: list[int]) -> DataFrame:
    """Value, QOQ and YOY rates and TTM of each cell of the spine; look-ups use all cells; registry.py has the whole catalog (C14)."""
    q = predecessor(cells, keys, coordinate, 1).withColumnRenamed("prior", "_q")
    y = predecessor(q, keys, coordinate, 4).withColumnRenamed("prior", "_y")
    t = ttm(y, keys, coordinate)
    rate = lambda prior: growth("value", prior)["rate"]
    out = t.withColumn("qoq", rate("_q")).withColumn("yoy", rate("_y")).withColumn("qoq_reason", F.when(F.col("_q").isNull(), "PREDECESSOR_MISSING")).withColumn("yoy_reason", F.when(F.col("_y").isNull(), "PREDECESSOR_MISSING"))
    return out.where(F.col(coordinate).isin(*spine)).withColumnRenamed("reason", "ttm_reason").drop("_q", "_y")


def comparable_companion(as_filed: DataFrame, reviewed: DataFrame, keys: list[str]) -> DataFrame:
    """Reviewed comparable rows beside the ones as filed (C4)."""
    a = as_filed.withColumn("row_kind", F.lit("AS_FILED"))
    r = as_filed.drop("value").join(reviewed.select(*keys, "value"), keys).withColumn("row_kind", F.lit("COMPARABLE"))
    return a.unionByName(r)


def both_views(facts: DataFrame, identity: list[str], as_of: str) -> DataFrame:
    """First and latest reported rows of each identity, labelled."""
    from asofworks.operators.selection import select_reported

    views = [select_reported(facts, identity, as_of, v).withColumn("view", F.lit(v)) for v in ("AS_FILED", "LATEST_REPORTED")]
    return views[0].unionByName(views[1])


def company_series(facts: DataFrame, form: str, kind: str = "period_class") -> DataFrame:
    """ANNUAL (10-K and FY) and CURRENT (10-K or 10-Q) candidates; others are excluded with a reason."""
    base = F.regexp_replace(form, "/A$", "")
    series = F.when((base == "10-K") & (F.col(kind) == "FY"), "ANNUAL").when(base.isin("10-K", "10-Q"), "CURRENT")
    return facts.withColumn("series", series).withColumn("exclusion", F.when(F.col("series").isNull(), "FORM_NOT_IN_SERIES"))


def price_timeline(grid: DataFrame, denominator: DataFrame, multiples: list[float], security: str = "security_id") -> DataFrame:
    """Close over denominator on each session, and the nearest bands below and above (C17)."""
    rows = grid.join(denominator, security, "left")
    ratio = F.when((F.col("close") > 0) & (F.col("denominator") > 0), F.col("close").cast("double") / F.col("denominator").cast("double"))
    bands = F.array(*[F.lit(float(m)) for m in sorted(multiples)])
    rows = rows.withColumn("ratio", ratio).withColumn("below", F.array_max(F.filter(bands, lambda m: m <= ratio))).withColumn("above", F.array_min(F.filter(bands, lambda m: m > ratio)))
    return rows.withColumn("reason", F.when(F.col("close").isNull(), "SESSION_PRICE_MISSING").when(F.col("denominator").isNull(), "DENOMINATOR_MISSING").when(ratio.isNull(), "NON_POSITIVE_INPUT"))


def cover_shares(facts: DataFrame, scope: list[str], share_class: str) -> DataFrame:
    """The newest share counts of each class; several in one scope are kept, none wins."""
    newest = Window.partitionBy(*scope, share_class).orderBy(F.col("filed_date").desc(), F.col("accession").desc())
    top = facts.withColumn("_k", F.rank().over(newest)).where("_k = 1").drop("_k")
    return top.withColumn("n_candidates", F.count("*").over(Window.partitionBy(*scope, share_class)))


def q4_eps(rows: DataFrame) -> DataFrame:
    """(FY income - 9M income) over fourth-quarter average shares, as rounding intervals (C20).

    Columns fy_n, nm_n, fy_w, nm_w are structs (lo, hi), fy_days and nm_days
    counts.  Without approval the row is only a diagnostic.
    """
    scale = lambda c, k: F.struct((F.col(c)["lo"] * F.col(k)).alias("lo"), (F.col(c)["hi"] * F.col(k)).alias("hi"))
    days = F.col("fy_days") - F.col("nm_days")
    total = interval_subtract(scale("fy_w", "fy_days"), scale("nm_w", "nm_days"))
    shares = F.struct((total["lo"] / days).alias("lo"), (total["hi"] / days).alias("hi"))
    out = rows.withColumn("eps", interval_divide(interval_subtract("fy_n", "nm_n"), shares))
    reason = F.when(days <= 0, "DAYS_NOT_POSITIVE").when(F.col("eps").isNull(), "SHARES_SPAN_ZERO").when(~F.col("approved"), "DIAGNOSTIC_ONLY")
    return out.withColumn("reason", reason)


def total_liabilities(cells: DataFrame, keys: list[str], role: str) -> DataFrame:
    """A direct total, or assets less equity if that equals the components exactly, else a reason."""
    roles = ("LIABILITIES", "ASSETS", "EQUITY", "CURRENT", "NONCURRENT")
    wide = cells.groupBy(*keys).agg(*[F.max(F.when(F.col(role) == r, F.col("value"))).alias(r) for r in roles], F.count_if(F.col(role) == "LIABILITIES").alias("_n"))
    residual = F.col("ASSETS") - F.col("EQUITY")
    parts = F.col("CURRENT") + F.col("NONCURRENT")
    reason = (
        F.when(F.col("_n") > 1, "MULTIPLE_CANDIDATES").when((F.col("_n") == 1) & (F.col("LIABILITIES") < 0), "NEGATIVE_TOTAL").when(F.col("_n") == 1, F.lit(None))
        .when(F.col("ASSETS").isNull() | F.col("EQUITY").isNull(), "EQUATION_INPUT_MISSING").when(parts.isNull(), "COMPONENTS_MISSING").when(residual != parts, "RESIDUAL_MISMATCH")
    )
    out = wide.withColumn("reason", reason)
    return out.withColumn("total", F.when(F.col("reason").isNull(), F.coalesce("LIABILITIES", residual))).withColumn("source", F.when(F.col("reason").isNull(), F.when(F.col("_n") == 1, "DIRECT").otherwise("EQUATION"))).drop("_n", *roles)


def core_cells(candidates: DataFrame, profile: DataFrame, keys: list[str]) -> DataFrame:
    """Each line of the profile for each key: the one eligible candidate of its concepts, or a reason."""
    lines = F.broadcast(profile.select(F.col("line_id").alias("_line"), F.explode("concepts").alias("concept")))
    n = candidates.join(lines, "concept", "left").groupBy(*keys, "_line").agg(F.count("*").alias("_n"), F.min("value").alias("_least"))
    # one row for each key: candidates are read once; a key with a null has no candidates, as in a join
    whole = F.col("_line").isNotNull()
    for k in keys:
        whole = whole & F.col(k).isNotNull()
    found = n.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.when(whole, F.struct("_line", F.struct("_n", "_least"))))).alias("_found"))
    rows = found.crossJoin(F.broadcast(profile.select("line_id"))).withColumn("_x", F.try_element_at("_found", F.col("line_id")))
    reason = F.when(F.col("_x").isNull(), "MISSING").when(F.col("_x._n") > 1, "MULTIPLE_CANDIDATES")
    return rows.select(*keys, "line_id", F.when(F.col("_x._n") == 1, F.col("_x._least")).alias("value"), reason.alias("reason"))


def reviewed_interpretation(cells: DataFrame, approved: DataFrame, key: str) -> DataFrame:
    """Approved cells get their target; the source cell is suppressed; two in one slot are SLOT_CONFLICT."""
    rows = cells.join(approved.select(key, "target"), key, "left").withColumn("slot", F.coalesce("target", F.col("slot")))
    n = F.count("*").over(Window.partitionBy("cik", "slot"))
    return rows.withColumn("status", F.when(F.col("target").isNotNull() & (n > 1), "SLOT_CONFLICT").when(F.col("target").isNotNull(), "REINTERPRETED").otherwise("AS_REPORTED")).drop("target")


def screening_dataset(companies: DataFrame, annual: DataFrame, quarterly: DataFrame) -> DataFrame:
    """Companies with counts of their observations; a set that lacks one says so."""
    a = annual.groupBy("cik").agg(F.count("*").alias("annual"))
    q = quarterly.groupBy("cik").agg(F.count("*").alias("quarterly"))
    rows = companies.join(a, "cik", "full_outer").join(q, "cik", "full_outer").fillna(0, ["annual", "quarterly"])
    return rows.withColumn("set_status", F.when(F.col("name").isNull(), "METADATA_MISSING").when((F.col("annual") == 0) | (F.col("quarterly") == 0), "OBSERVATIONS_MISSING").otherwise("AGREES"))


def important_children(ranked: DataFrame, parent: str, k: int, after: int = 0) -> DataFrame:
    """The next k children of each parent after a rank, with how many are left out."""
    page = ranked.where((F.col("amount_rank") > after) & (F.col("amount_rank") <= after + k))
    total = ranked.groupBy(parent).agg(F.count("*").alias("_all"))
    return page.join(total, parent).withColumn("hidden", F.greatest(F.col("_all") - after - k, F.lit(0))).drop("_all")


def company_profile(companies: DataFrame, annual: DataFrame, one: object) -> DataFrame:
    """One company with its newest year's metrics."""
    own = annual.where(F.col("cik") == F.lit(one))
    newest = own.agg(F.max("fiscal_year").alias("fiscal_year"))
    return companies.where(F.col("cik") == F.lit(one)).join(own.join(F.broadcast(newest), "fiscal_year"), "cik", "left")


def overview(cells: DataFrame, periods: DataFrame, keys: list[str]) -> DataFrame:
    """Cells of exactly the given periods."""
    return cells.join(periods, keys, "left_semi")


def mechanical_q4(facts: DataFrame, scope: list[str], as_of: str) -> DataFrame:
    """FY less nine months as candidates with their exclusion reasons."""
    return derive_quarter(facts, scope, "FY", "YTD_9M", as_of)


def link_security_headers(securities: DataFrame, symbols: DataFrame) -> DataFrame:
    """Every match of a ticker in a context; one title and one symbol make REPORTED_CLASS_IDENTITY."""
    rows = securities.join(symbols, ["cik", "ticker"])
    n = rows.groupBy("cik", "ticker").agg(F.countDistinct("title").alias("_t"), F.countDistinct("context_id").alias("_c"))
    status = F.when((F.col("_t") == 1) & (F.col("_c") == 1), "REPORTED_CLASS_IDENTITY").otherwise("HEADER_MATCH_CLASS_UNCONFIRMED")
    return rows.join(n, ["cik", "ticker"]).withColumn("link_status", status).drop("_t", "_c")


def normalize_duration(value: str, unit: str) -> Column:
    """Decimal durday, durweek, durmonth, duryear or durhour as an ISO duration, fractions truncated."""
    v = F.col(value).try_cast("decimal(20,8)")
    m, sign = F.abs(v), F.when(v < 0, "-").otherwise("")
    whole = F.floor(m)
    rest = m - whole
    part = lambda c, name: F.when(c > 0, F.concat(c.cast("long").cast("string"), F.lit(name))).otherwise("")
    if unit == "durweek":
        body = F.concat(F.lit("P"), F.floor(m * 7).cast("long").cast("string"), F.lit("D"))
    elif unit == "durhour":
        body = F.concat(F.lit("PT"), whole.cast("long").cast("string"), F.lit("H"))
    elif unit == "durday":
        hours = F.floor(rest * 24)
        body = F.concat(F.lit("P"), whole.cast("long").cast("string"), F.lit("D"), F.when(hours > 0, F.concat(F.lit("T"), part(hours, "H"))).otherwise(""))
    elif unit == "durmonth":
        body = F.concat(F.lit("P"), whole.cast("long").cast("string"), F.lit("M"), part(F.floor(rest * F.lit("30.4375").cast("decimal(6,4)")), "D"))
    elif unit == "duryear":
        body = F.concat(F.lit("P"), whole.cast("long").cast("string"), F.lit("Y"), part(F.floor(rest * 12), "M"))
    else:
        raise ValueError(unit)
    return F.when(v.isNotNull(), F.concat(sign, body))
