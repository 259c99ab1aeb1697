"""Scalar functions: ids, dates, decimals, growth, labels, intervals, measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stable_id(prefix: str, *columns: str) -> Column:
    """prefix and 24 hex digits of the SHA-256 of the columns as canonical JSON (F1)."""
    text = F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})
    return F.concat(F.lit(prefix), F.left(F.sha2(text, 256), F.lit(24)))


def fiscal_year_end(text: str | Column) -> Column:
    """struct(month, day) of --MM-DD, an ISO date, MM-DD or MM/DD; null otherwise (F2)."""
    t = col(text)
    pattern = r"^(?:--|\d{4}-)?(\d{1,2})[-/](\d{1,2})$"
    month, day = (F.try_to_number(F.nullif(F.regexp_extract(t, pattern, k), F.lit("")), F.lit("99")).cast("int") for k in (1, 2))
    return F.when(t.rlike(pattern), F.struct(month.alias("month"), day.alias("day")))


def filing_date(text: str | Column) -> Column:
    """A date from YYYYMMDD or ISO text; null for blank or other text."""
    t = F.trim(col(text))
    return F.coalesce(F.when(t.rlike(r"^\d{8}$"), F.try_to_date(t, "yyyyMMdd")), F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(t, "yyyy-MM-dd")))


def canonical_cik(value: str | Column) -> Column:
    """Ten digits, filled with zeros; null for anything but one to ten digits."""
    t = col(value).cast("string")
    return F.when(t.rlike(r"^\d{1,10}$"), F.lpad(t, 10, "0"))


def finite_decimal(text: str | Column, precision: int = 28, scale: int = 8) -> Column:
    """A decimal, or null for NaN, infinity and text that is no number."""
    return col(text).cast("string").try_cast(f"decimal({precision},{scale})")


def percentage(part: str | Column, whole: str | Column) -> Column:
    """100 * part / whole in double precision from exact decimals; null for a zero or missing whole."""
    a, b = col(part).cast("double"), col(whole).cast("double")
    return F.when(b != 0, a / b * 100)


def growth(current: str | Column, prior: str | Column) -> Column:
    """struct(status, rate, magnitude_change, delta) by the sign policy; null if either is missing."""
    c, p = col(current), col(prior)
    status = (
        F.when((p == 0) & (c == 0), "ZERO_UNCHANGED")
        .when(p == 0, "ZERO_BASE")
        .when(c == 0, "ZERO_REACHED")
        .when((p > 0) & (c > 0), "RATE_AVAILABLE")
        .when((p < 0) & (c < 0) & (F.abs(c) < F.abs(p)), "NEGATIVE_MAGNITUDE_REDUCED")
        .when((p < 0) & (c < 0) & (F.abs(c) > F.abs(p)), "NEGATIVE_MAGNITUDE_EXPANDED")
        .when((p < 0) & (c < 0), "NEGATIVE_MAGNITUDE_UNCHANGED")
        .when(c > 0, "POSITIVE_TURN")
        .otherwise("NEGATIVE_TURN")
    )
    rate = F.when((p > 0) & (c >= 0), percentage(c - p, p))
    magnitude = F.when((p < 0) & (c < 0), percentage(F.abs(c) - F.abs(p), F.abs(p)))
    return F.when(c.isNotNull() & p.isNotNull(), F.struct(status.alias("status"), rate.alias("rate"), magnitude.alias("magnitude_change"), (c - p).alias("delta")))


def calendar_quarter(exclusive_end: str | Column) -> Column:
    """struct(year, quarter) of the last day of a period (F8)."""
    last = inclusive_end(exclusive_end)
    return F.struct(F.year(last).alias("year"), F.quarter(last).alias("quarter"))


def quarter_spine(as_of: str | Column, count: int = 8) -> Column:
    """First days of the count last completed calendar quarters (F8)."""
    this = F.trunc(col(as_of), "quarter")
    return F.transform(F.sequence(F.lit(count), F.lit(1), F.lit(-1)), lambda k: F.add_months(this, -3 * k))


def inclusive_end(exclusive_end: str | Column) -> Column:
    """The day before an exclusive end."""
    return F.date_sub(col(exclusive_end), 1)


def split_label(qname: str | Column) -> Column:
    """The local name of a qualified name as spaced words."""
    local = F.regexp_replace(col(qname), "^.*:", "")
    return F.regexp_replace(local, "(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", " ")


def gaap_namespace_year(uri: str | Column) -> Column:
    """The year of an official yearly US-GAAP namespace of fasb.org, in letters of any case, else null."""
    pattern = r"(?i)\Ahttps?://fasb\.org/us-gaap/([0-9]{4})(?:-([0-9]{2})-([0-9]{2}))?\z"
    u = col(uri)
    year, month, day = (F.regexp_extract(u, pattern, k) for k in (1, 2, 3))
    dated = F.try_to_date(F.concat_ws("-", year, F.when(month == "", "01").otherwise(month), F.when(day == "", "01").otherwise(day)), "yyyy-MM-dd")
    return F.when(u.rlike(pattern), F.year(dated))


#: Statement types by the words of a role's title, the first that fits counts.
STATEMENT_WORDS = (("CF", ("CASH FLOW",)), ("EQ", ("EQUITY", "STOCKHOLDER", "SHAREHOLDER")), ("BS", ("BALANCE SHEET", "FINANCIAL POSITION")), ("IS", ("INCOME", "OPERATIONS", "EARNINGS")))


def statement_type(title: str | Column) -> Column:
    """CF, EQ, BS or IS by title words, in that order; null if none fits."""
    t = F.upper(col(title))
    out = F.lit(None).cast("string")
    for kind, phrases in reversed(STATEMENT_WORDS):
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | F.contains(t, F.lit(phrase))
        out = F.when(hit, kind).otherwise(out)
    return out


def match_topics(text: str | Column, topics: dict[str, tuple[str, ...]]) -> Column:
    """The topics of which the lower-cased text has a phrase, in the order given."""
    t = F.lower(col(text))
    found = []
    for topic, phrases in topics.items():
        hit = F.lit(False)
        for phrase in phrases:
            hit = hit | F.contains(t, F.lit(phrase))
        found.append(F.when(hit, topic))
    return F.array_compact(F.array(*found))


def interval(value: str | Column, decimals: str | Column) -> Column:
    """struct(lo, hi) of a rounded value: it is within 5 * 10^(-decimals - 1); decimals INF is exact."""
    v, d = col(value), col(decimals).cast("string")
    half = F.when(F.upper(d) == "INF", F.lit(0.0)).otherwise(0.5 * F.pow(F.lit(10.0), -d.try_cast("double")))
    v = v.cast("double")
    return F.struct((v - half).alias("lo"), (v + half).alias("hi"))


def interval_subtract(a: str | Column, b: str | Column) -> Column:
    a, b = col(a), col(b)
    return F.struct((a["lo"] - b["hi"]).alias("lo"), (a["hi"] - b["lo"]).alias("hi"))


def interval_multiply(a: str | Column, b: str | Column) -> Column:
    a, b = col(a), col(b)
    ends = [a[x] * b[y] for x in ("lo", "hi") for y in ("lo", "hi")]
    return F.struct(F.least(*ends).alias("lo"), F.greatest(*ends).alias("hi"))


def interval_divide(a: str | Column, b: str | Column) -> Column:
    """Null if the denominator spans zero."""
    a, b = col(a), col(b)
    ends = [F.try_divide(a[x], b[y]) for x in ("lo", "hi") for y in ("lo", "hi")]
    return F.when((b["lo"] > 0) | (b["hi"] < 0), F.struct(F.least(*ends).alias("lo"), F.greatest(*ends).alias("hi")))


def intervals_overlap(a: str | Column, b: str | Column) -> Column:
    a, b = col(a), col(b)
    return (a["lo"] <= b["hi"]) & (b["lo"] <= a["hi"])


def share_weight(start: str | Column, end: str | Column, method: str) -> Column:
    """A period's weight by DAY, MONTH (aligned days only, else null) or EQUAL_QUARTER."""
    s, e = col(start), col(end)
    if method == "DAY":
        return F.datediff(e, s).cast("double")
    months = F.months_between(e, s)
    if method == "MONTH":
        return F.when(F.day(e) == F.day(s), months)
    return F.round(months / 3).cast("double")


def parse_measures(text: str | Column) -> Column:
    """A sorted array of unit measures from a JSON list or spaced text (F16)."""
    t = F.trim(col(text))
    listed = F.from_json(F.when(t.startswith("["), t), "array<string>")
    return F.array_sort(F.array_remove(F.coalesce(listed, F.split(t, r"[\s,]+")), ""))


def is_currency(measures: str | Column) -> Column:
    """One measure that is an ISO 4217 currency (F16)."""
    m = col(measures)
    return (F.size(m) == 1) & F.element_at(m, 1).rlike("^(?i:iso4217):[A-Z]{3}$")


def reasons(*checks: tuple[Column, str]) -> Column:
    """The names of all checks that hold, in order: a row's reasons."""
    return F.array_compact(F.array(*[F.when(check, name) for check, name in checks]))


def first_reason(reason_array: str | Column) -> Column:
    """The first reason, or null."""
    return F.try_element_at(col(reason_array), F.lit(1))
