"""Prices on a verified session calendar: strict windows, distributions, valuation, bands."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

QUANTILES = (0.1, 0.25, 0.5, 0.75, 0.9)


def session_calendar(days: DataFrame, day: str = "trade_date") -> DataFrame:
    """Distinct sessions with a dense index from 1 (S11); a calendar has one row per session, so one task numbers it."""
    return days.select(day).distinct().withColumn("session", F.row_number().over(Window.orderBy(day)).cast("long"))


def price_grid(prices: DataFrame, sessions: DataFrame, security: str = "security_id", day: str = "trade_date") -> DataFrame:
    """Every security on every session between its first and last price, so that gaps are rows."""
    placed = prices.join(sessions, day)
    span = placed.groupBy(security).agg(F.min("session").alias("_a"), F.max("session").alias("_b"))
    grid = span.select(security, F.explode(F.sequence("_a", "_b")).alias("session"))
    others = [c for c in prices.columns if c not in (security, day)]
    return grid.join(placed.select(security, "session", day, *others), [security, "session"], "left")


def _window_reason(order: WindowSpec, n: int, bad: Column, why: str, day: str) -> Column:
    """Why a window of n sessions and the one before them has no value: too few sessions, a session without a row, or a bad value."""
    window = order.rowsBetween(-n, 0)
    return (
        F.when(F.col("session") <= n, "INSUFFICIENT_VERIFIED_SESSION_HISTORY")
        .when(F.count(day).over(window) < n + 1, "PRICE_SESSION_GAP")
        .when(F.count_if(bad).over(window) > 0, why)
    )


def price_returns(grid: DataFrame, n: int, security: str = "security_id", close: str = "close", day: str = "trade_date") -> DataFrame:
    """100 * (P[t] / P[t - n] - 1) where all n + 1 sessions have a positive close, else the first reason.

    day is null on a session without a row; sessions count from 1 over the
    whole calendar.
    """
    order = Window.partitionBy(security).orderBy("session")
    reason = _window_reason(order, n, F.col(close).isNull() | (F.col(close) <= 0), "CLOSE_MISSING_OR_NONPOSITIVE", day)
    rate = (F.col(close).cast("double") / F.lag(close, n).over(order).cast("double") - 1) * 100
    return grid.withColumn("reason", reason).withColumn("return", F.when(F.col("reason").isNull(), rate))


def volatility(grid: DataFrame, n: int, security: str = "security_id", close: str = "close", day: str = "trade_date") -> DataFrame:
    """100 * sample deviation of n log returns * sqrt(252), on the same strict window, or its reason."""
    order = Window.partitionBy(security).orderBy("session")
    price, before = F.col(close).cast("double"), F.lag(close).over(order).cast("double")
    reason = _window_reason(order, n, F.col(close).isNull() | (F.col(close) <= 0), "CLOSE_MISSING_OR_NONPOSITIVE", day)
    rows = grid.withColumn("_log", F.when((price > 0) & (before > 0), F.ln(price) - F.ln(before))).withColumn("reason", reason)
    value = F.stddev_samp("_log").over(order.rowsBetween(-(n - 1), 0)) * F.sqrt(F.lit(252.0)) * 100
    return rows.withColumn("volatility", F.when(F.col("reason").isNull(), value)).drop("_log")


def relative_volume(grid: DataFrame, n: int, volume: str, basis_known: Column | None = None, security: str = "security_id", day: str = "trade_date") -> DataFrame:
    """Volume over the mean of the n sessions before, or the first reason; basis_known says whether volumes are split compatible."""
    order = Window.partitionBy(security).orderBy("session")
    mean = F.sum(volume).over(order.rowsBetween(-n, -1)).cast("double") / n
    window = order.rowsBetween(-n, 0)
    bad = F.count_if(F.col(volume).isNull() | (F.col(volume) < 0)).over(window) > 0
    reason = F.coalesce(
        _window_reason(order, n, F.lit(False), "", day),
        F.when(~(F.lit(True) if basis_known is None else basis_known), "VOLUME_SPLIT_BASIS_UNKNOWN"),
        F.when(bad, "VOLUME_MISSING_OR_NEGATIVE"),
        F.when(mean <= 0, "VOLUME_BASE_NONPOSITIVE"),
    )
    return grid.withColumn("reason", reason).withColumn("relative_volume", F.when(F.col("reason").isNull(), F.col(volume).cast("double") / mean))


def rolling_distribution(grid: DataFrame, n: int, value: str, security: str = "security_id") -> DataFrame:
    """Five linear percentiles of n consecutive sessions that all have a positive value, else a reason."""
    order = Window.partitionBy(security).orderBy("session").rowsBetween(-(n - 1), 0)
    full = F.count(F.when(F.col(value) > 0, 1)).over(order) == n
    found = F.percentile(F.col(value).cast("double"), F.array(*[F.lit(q) for q in QUANTILES])).over(order)
    return grid.withColumn("quantiles", F.when(full, found)).withColumn("reason", F.when(~full, "WINDOW_INCOMPLETE"))


def missing_ranges(points: DataFrame, security: str = "security_id", session: str = "session", reason: str = "reason") -> DataFrame:
    """Islands of consecutive sessions that are missing for one reason."""
    w = Window.partitionBy(security, reason).orderBy(session)
    islands = points.where(F.col(reason).isNotNull()).withColumn("_island", F.col(session) - F.row_number().over(w))
    return islands.groupBy(security, reason, "_island").agg(F.min(session).alias("first_session"), F.max(session).alias("last_session"), F.count("*").alias("sessions")).drop("_island")


def percentiles(rows: DataFrame, keys: list[str], value: str, least: int) -> DataFrame:
    """Linear percentiles of a key's valid values if there are at least so many; valid, expected and missing counts."""
    valid = F.when(F.col(value) > 0, F.col(value).cast("double"))
    out = rows.groupBy(*keys).agg(F.percentile(valid, F.array(*[F.lit(q) for q in QUANTILES])).alias("_q"), F.count(valid).alias("valid"), F.count("*").alias("expected"))
    enough = F.col("valid") >= least
    return out.withColumn("quantiles", F.when(enough, F.col("_q"))).withColumn("reason", F.when(~enough, "INSUFFICIENT_VALID_VALUES")).withColumn("missing", F.col("expected") - F.col("valid")).drop("_q")


def timeline_coverage(grid: DataFrame, n: int, value: str, session: str = "session", security: str = "security_id") -> DataFrame:
    """Companies with a value, and with a full window of n, on each session."""
    order = Window.partitionBy(security).orderBy(session).rowsBetween(-(n - 1), 0)
    rows = grid.withColumn("_full", F.count(value).over(order) == n)
    return rows.groupBy(session).agg(F.count(value).alias("with_value"), F.count_if("_full").alias("with_distribution"))


def fixed_bands(rows: DataFrame, denominator: str, multiples: list[float]) -> DataFrame:
    """denominator times each positive multiple (C16); the multiples are a fixed list."""
    if any(m <= 0 for m in multiples):
        raise ValueError("multiples must be positive")
    out = rows.withColumn("multiple", F.explode(F.array(*[F.lit(float(m)) for m in multiples])))
    return out.withColumn("band", F.when(F.col(denominator) > 0, F.col(denominator).cast("double") * F.col("multiple")))


def query_prices(rows: DataFrame, mode: str, securities: list | None = None, start: str | None = None, end: str | None = None, security: str = "security_id", day: str = "trade_date") -> DataFrame:
    """latest, series or historical rows of some securities within dates."""
    if mode not in ("latest", "series", "historical"):
        raise ValueError(f"unknown mode {mode}")
    if securities is not None:
        rows = rows.where(F.col(security).isin(*securities))
    if start:
        rows = rows.where(F.col(day) >= F.lit(start).cast("date"))
    if end:
        rows = rows.where(F.col(day) <= F.lit(end).cast("date"))
    if mode == "latest":
        others = [c for c in rows.columns if c != security]
        rows = rows.groupBy(security).agg(F.max_by(F.struct(*others), day).alias("_r")).select(security, *[F.col(f"_r.{c}").alias(c) for c in others])
    return rows


def bind_inputs(days: DataFrame, inputs: DataFrame, key: str, scope: list[str], known: str, day: str) -> DataFrame:
    """The one input of a day's scope that is known by that day, else INPUT_MISSING, INPUT_NOT_KNOWN or INPUT_AMBIGUOUS.

    Days and inputs of a scope stand in one order by date, so a day sees the
    inputs before it by a running count; they are never paired.
    """
    names = [c for c in inputs.columns if c not in scope]
    a = days.select(*scope, F.col(day).alias("_at"), F.lit(1).alias("_kind"), F.struct(*days.columns).alias("_day"))
    usable = F.col(key).isNotNull()
    for c in scope:
        usable = usable & F.col(c).isNotNull()
    b = inputs.where(usable).select(*scope, F.col(known).alias("_at"), F.lit(0).alias("_kind"), F.struct(*names).alias("_input"))
    order = Window.partitionBy(*scope).orderBy("_at", "_kind")
    upto, whole = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), Window.partitionBy(*scope)
    dated = F.when(F.col("_at").isNotNull(), F.col("_input"))
    rows = a.unionByName(b, allowMissingColumns=True).withColumn("_all", F.count("_input").over(whole)).withColumn("_ready", F.count(dated).over(upto)).withColumn("_row", F.max(dated).over(upto))
    reason = F.when(F.col("_all") == 0, "INPUT_MISSING").when(F.col("_ready") == 0, "INPUT_NOT_KNOWN").when(F.col("_ready") > 1, "INPUT_AMBIGUOUS")
    out = rows.where("_kind = 1").withColumn("reason", reason)
    return out.select(*[F.col(f"_day.{c}").alias(c) for c in days.columns], *[F.when(F.col("reason").isNull(), F.col(f"_row.{c}")).alias(f"input_{c}") for c in names], "reason")


def valuation(rows: DataFrame, price: str, shares: str, earnings: str, equity: str, revenue: str, debt: str, cash: str) -> DataFrame:
    """Market cap, PER, PBR, P/S, earnings yield, EV and EV / revenue; a reason for each that has no value."""
    number = lambda c: F.col(c).cast("double")
    cap = number(price) * number(shares)
    ev = cap + number(debt) - number(cash)
    bad_price = F.col(price).isNull() | (F.col(price) <= 0)
    reason = lambda *checks: F.coalesce(F.when(bad_price, "PRICE_NONPOSITIVE_OR_MISSING"), F.when(F.col(shares).isNull(), "SHARES_MISSING"), *checks)
    positive = lambda c, name: [F.when(F.col(c).isNull(), f"{name}_MISSING"), F.when(F.col(c) <= 0, f"NON_POSITIVE_{name}")]
    ev_checks = [F.when(F.col(debt).isNull(), "DEBT_MISSING"), F.when(F.col(cash).isNull(), "CASH_MISSING")]
    metrics: dict[str, tuple[Column, Column]] = {
        "market_cap": (cap, reason()),
        "per": (cap / number(earnings), reason(*positive(earnings, "EARNINGS"))),
        "pbr": (cap / number(equity), reason(*positive(equity, "EQUITY"))),
        "ps": (cap / number(revenue), reason(*positive(revenue, "REVENUE"))),
        "earnings_yield": (number(earnings) / cap * 100, reason(F.when(F.col(earnings).isNull(), "EARNINGS_MISSING"))),
        "ev": (ev, reason(*ev_checks)),
        "ev_revenue": (ev / number(revenue), reason(*ev_checks, *positive(revenue, "REVENUE"))),
    }
    for name, (value, why) in metrics.items():
        rows = rows.withColumn(f"{name}_reason", why)
        rows = rows.withColumn(name, F.when(F.col(f"{name}_reason").isNull(), value))
    return rows
