"""Universes, searches, three-valued screens, comparisons, sorts and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asofworks.functions.scalars import reasons

COMPARE = {"GT": lambda a, b: a > b, "GTE": lambda a, b: a >= b, "LT": lambda a, b: a < b, "LTE": lambda a, b: a <= b, "EQ": lambda a, b: a == b}


def filter_universe(companies: DataFrame, company: str, allowed: dict[str, list], requested: list | None = None) -> DataFrame:
    """Every company with eligible and its exclusion reasons; requested ids that are unknown are METADATA_UNAVAILABLE (P5)."""
    checks = [(~F.coalesce(F.col(c).isin(*values), F.lit(False)), f"{c.upper()}_EXCLUDED") for c, values in allowed.items()]
    if requested is not None:
        checks.append((~F.col(company).isin(*requested), "NOT_REQUESTED"))
    rows = companies.withColumn("exclusions", reasons(*checks))
    if requested is not None:
        asked = companies.sparkSession.createDataFrame([(r,) for r in requested], f"{company} {companies.schema[company].dataType.simpleString()}")
        unknown = asked.join(companies.select(company), company, "left_anti").withColumn("exclusions", F.array(F.lit("METADATA_UNAVAILABLE")))
        rows = rows.unionByName(unknown, allowMissingColumns=True)
    return rows.withColumn("eligible", F.size("exclusions") == 0)


def search_companies(companies: DataFrame, text: str, columns: list[str], order: list[str], offset: int = 0, limit: int | None = None) -> DataFrame:
    """Case-folded substring search over columns, in order, as a page with the total."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.col(c).cast("string")), F.lit(text.lower()))
    found = companies.where(F.coalesce(hit, F.lit(False)))
    total = found.agg(F.count("*").alias("total"))
    page = found.orderBy(*order).offset(offset)
    page = page.limit(limit) if limit is not None else page
    return page.join(F.broadcast(total), how="cross")


def resolve_company(companies: DataFrame, company: str, selectors: list[str], value: str) -> DataFrame:
    """One row: the company that a selector names exactly, or NOT_FOUND or AMBIGUOUS."""
    hit = F.lit(False)
    for c in selectors:
        hit = hit | (F.lower(F.trim(F.col(c).cast("string"))) == value.strip().lower())
    n = F.count("*")
    return companies.where(hit).agg(F.when(n == 1, F.first(company)).alias(company), F.when(n == 0, "NOT_FOUND").when(n > 1, "AMBIGUOUS").alias("error"))


def peers(companies: DataFrame, company: str, group: str) -> DataFrame:
    """Pairs of companies of one group (J8), as each company with the number of its peers, its rank among them, and their mean balance.

    The pairs themselves grow with the square of a group; the peer list of one
    company is a filter on its group.
    """
    w = Window.partitionBy(group)
    return companies.withColumn("n_peers", F.count("*").over(w) - 1).withColumn("position", F.row_number().over(w.orderBy(F.col("balance").desc(), company)))


def peers_of(companies: DataFrame, company: str, group: str, one: object) -> DataFrame:
    """The companies of one company's group, itself excluded."""
    its = companies.where(F.col(company) == F.lit(one)).select(group)
    return companies.join(F.broadcast(its), group, "left_semi").where(F.col(company) != F.lit(one))


def screen(observations: DataFrame, predicates: list[tuple[str, str, float]], company: str = "cik", metric: str = "metric", value: str = "value") -> DataFrame:
    """PASS, FAIL or UNDETERMINED for each company: any FAIL fails, all PASS pass.

    Predicates are (metric, GT | GTE | LT | LTE | EQ, threshold).  A company
    without an observation, or with one without a value, is undetermined there
    and carries the metrics that are.  One aggregation by company, no join.
    """
    outcomes = []
    for k, (name, op, threshold) in enumerate(predicates):
        own = F.col(metric) == name
        v = F.max(F.when(own, F.col(value)))
        n = F.count_if(own)
        outcome = F.when(n > 1, "UNDETERMINED").when(v.isNull(), "UNDETERMINED").when(COMPARE[op](v, F.lit(threshold)), "PASS").otherwise("FAIL")
        outcomes.append(outcome.alias(f"outcome_{k}"))
    rows = observations.groupBy(company).agg(*outcomes)
    every = [F.col(f"outcome_{k}") for k in range(len(predicates))]
    any_fail, all_pass = F.array_contains(F.array(*every), "FAIL"), F.size(F.filter(F.array(*every), lambda o: o != "PASS")) == 0
    open_ = F.array_compact(F.array(*[F.when(o == "UNDETERMINED", p[0]) for o, p in zip(every, predicates, strict=True)]))
    return rows.withColumn("result", F.when(any_fail, "FAIL").when(all_pass, "PASS").otherwise("UNDETERMINED")).withColumn("undetermined", open_)


def screen_counts(results: DataFrame) -> DataFrame:
    """Target = PASS + FAIL + UNDETERMINED, with whether they reconcile."""
    out = results.agg(F.count("*").alias("target"), *[F.count_if(F.col("result") == r).alias(r.lower()) for r in ("PASS", "FAIL", "UNDETERMINED")])
    return out.withColumn("reconciles", F.col("target") == F.col("pass") + F.col("fail") + F.col("undetermined"))


def sort_screen(rows: DataFrame, column: str, descending: bool, tie: str, limit: int | None = None) -> DataFrame:
    """Sorted by a column with missing values last either way, ties by id, with the place (T1); limit makes it a top-k."""
    order = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    out = rows.orderBy(order, tie)
    return out.limit(limit) if limit is not None else out


def latest_periods(rows: DataFrame, keys: list[str], period: str, n: int) -> DataFrame:
    """The last n periods of each key (T4)."""
    w = Window.partitionBy(*keys).orderBy(F.col(period).desc())
    return rows.withColumn("position", F.row_number().over(w)).where(F.col("position") <= n)


def explore(rows: DataFrame, company: str, metric: str, value: str, metrics: list[str]) -> DataFrame:
    """Company x metric matrix (T2, C43); the metrics are named, so no pass over the data finds them."""
    return rows.groupBy(company).pivot(metric, metrics).agg(F.max(value))


def compare_peers(rows: DataFrame, companies: list, metric: str, period: int, company: str = "cik") -> DataFrame:
    """One cell for each of 2 to 100 companies, PERIOD_NOT_PREPARED where there is none."""
    if not 2 <= len(companies) <= 100:
        raise ValueError("2 to 100 companies")
    asked = rows.sparkSession.createDataFrame([(c,) for c in companies], f"{company} long")
    cells = rows.where((F.col("metric") == metric) & (F.col("fiscal_year") == period))
    out = F.broadcast(asked).join(cells.select(company, "value"), company, "left")
    return out.withColumn("reason", F.when(F.col("value").isNull(), "PERIOD_NOT_PREPARED"))


def year_options(rows: DataFrame, company: str, year: str) -> DataFrame:
    """Companies of each year, and the default: the newest year all have, else the year most have."""
    total = rows.agg(F.countDistinct(company).alias("_all"))
    counted = rows.groupBy(year).agg(F.countDistinct(company).alias("companies")).join(F.broadcast(total), how="cross")
    default = counted.agg(F.max_by(year, F.struct(F.col("companies") == F.col("_all"), F.when(F.col("companies") == F.col("_all"), F.lit(0)).otherwise(F.col("companies")), year)).alias("_default"))
    return counted.join(F.broadcast(default), how="cross").withColumn("is_default", F.col(year) == F.col("_default")).drop("_all", "_default")


def metric_catalog(rows: DataFrame, company: str, metric: str, period: str, value: str) -> DataFrame:
    """Companies and periods for which each metric has a value, of how many."""
    have = F.when(F.col(value).isNotNull(), F.col(company))
    return rows.groupBy(metric).agg(F.countDistinct(have).alias("companies_available"), F.countDistinct(company).alias("companies_total"), F.countDistinct(F.when(F.col(value).isNotNull(), F.col(period))).alias("periods_available"))


def discover_capability(inventory: DataFrame, **exact: object) -> DataFrame:
    """Rows that match exactly, or one explicit NOT_REPORTED row (P10)."""
    found = inventory
    for name, value in exact.items():
        found = found.where(F.col(name) == F.lit(value))
    found = found.withColumn("status", F.lit("REPORTED"))
    none = found.limit(1).agg(F.count("*").alias("_n")).where("_n = 0").select(*[F.lit(v).alias(k) for k, v in exact.items()], F.lit("NOT_REPORTED").alias("status"))
    return found.unionByName(none, allowMissingColumns=True)


def standard_equivalence(rows: DataFrame, company: str, identity: list[str]) -> DataFrame:
    """EQUIVALENT for an identity that several companies use, else UNRESOLVED."""
    n = rows.groupBy(*identity).agg(F.countDistinct(company).alias("companies"))
    return n.withColumn("equivalence", F.when(F.col("companies") >= 2, "EQUIVALENT").otherwise("UNRESOLVED"))


def batch_as_of(batches: DataFrame, sessions: DataFrame, decision: str, lag: int) -> DataFrame:
    """The newest batch that was ready at least lag sessions before the decision day."""
    day = F.lit(decision).cast("date")
    s = sessions.where(F.col("trade_date") <= day).select("trade_date")
    counted = batches.where(F.col("ready_on") <= day).join(F.broadcast(s), F.col("trade_date") > F.col("ready_on"), "left").groupBy("batch_id", "ready_on").agg(F.count("trade_date").alias("sessions_since"))
    fit = counted.where(F.col("sessions_since") >= lag)
    top = fit.agg(F.max("ready_on").alias("ready_on"))
    return fit.join(F.broadcast(top), "ready_on").groupBy("ready_on").agg(F.min("batch_id").alias("batch_id"), F.max("sessions_since").alias("sessions_since"), (F.count("*") > 1).alias("tie"))
