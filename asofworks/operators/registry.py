"""Metric definitions as a table of versions, and their evaluation in dependency order on prepared cells.

A definition is a row: metric, version, status, reviewed_at, kind, inputs,
basis, unit.  active() takes of each metric the newest version that is ACTIVE
and reviewed by a date; evaluate() sorts these by their inputs and computes each
level for all companies and quarters at once.  A new metric is a new row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.sources.tables import scratch_path

DEFINITIONS = "metric string, version string, status string, reviewed_at date, kind string, inputs array<string>, basis string, unit string"
#: Kinds: a cell as reported; 100 a / b of one period; the same of balances, which must not be negative; a - b; debt less cash; growth over the quarter and the year before; the sum of four quarters; 100 times one such sum over another.
REPORTED, PERCENT, STOCK_PERCENT, DIFFERENCE, NET_DEBT, QOQ, YOY, TTM, TTM_PERCENT = "REPORTED PERCENT STOCK_PERCENT DIFFERENCE NET_DEBT QOQ YOY TTM TTM_PERCENT".split()
ACROSS = (QOQ, YOY, TTM, TTM_PERCENT)
#: Basis policies of sums over quarters: one declared basis for all four, or none for all four and quarters of 75 to 105 days.
DECLARED, ARITHMETIC = "DECLARED", "ARITHMETIC"

#: Rows of the core profile that quarters report as flows and as balances, and metrics made of them.
FLOWS = "revenue gross_profit operating_income net_income cfo capex cost research cfi cff repurchases stock_compensation".split()
BALANCES = "assets cash liabilities current_assets current_liabilities receivables inventory debt equity".split()
MADE = (
    ("revenue_qoq", QOQ, "revenue", "revenue"), ("revenue_yoy", YOY, "revenue", "revenue"),
    ("gross_margin", PERCENT, "gross_profit", "revenue"), ("operating_margin", PERCENT, "operating_income", "revenue"),
    ("standardized_fcf", DIFFERENCE, "cfo", "capex"), ("net_margin", PERCENT, "net_income", "revenue"), ("fcf_margin", PERCENT, "standardized_fcf", "revenue"),
    ("current_ratio", STOCK_PERCENT, "current_assets", "current_liabilities"), ("liabilities_to_equity", STOCK_PERCENT, "liabilities", "equity"),
    ("liabilities_to_assets", STOCK_PERCENT, "liabilities", "assets"), ("net_debt", NET_DEBT, "debt", "cash"),
)
SUMS = ("revenue", "operating_income", "net_income", "cfo", "standardized_fcf")
MARGINS = (("gross_margin", "gross_profit"), ("operating_margin", "operating_income"), ("net_margin", "net_income"), ("fcf_margin", "standardized_fcf"))

#: A prepared candidate of a metric; reasons say why it can't be used.
CELLS = "company, metric, bucket, coordinate, start, end, filed, filing, value, unit, dims, basis, versions, mapping, concept, combined_debt, reasons"
_CELL = ("value decimal(28,4)", "percent double", "coordinate bigint", "start date", "end date", "filed date", "filing string", "unit string", "dims string", "basis string", "versions string", "mapping string", "concept string", "combined_debt boolean", "semantic string", "lineage array<string>")


@dataclass(frozen=True)
class Definition:
    metric: str
    version: str
    kind: str
    inputs: tuple[str, ...]
    basis: str
    unit: str


def quarter_catalog(spark: SparkSession, strict_from: dt.date, arithmetic_from: dt.date | None = None) -> DataFrame:
    """The 41 quarterly definitions: 21 reported, 11 made of one or two quarters, 5 sums of four and 4 margins of sums.

    Version 1 of the sums needs a declared basis; version 2, from
    arithmetic_from on, also takes quarters without any.
    """
    rows = [(f"quarter_{r}", "1", "ACTIVE", strict_from, REPORTED, [], DECLARED, "USD") for r in (*FLOWS, *BALANCES)]
    rows += [(f"quarter_{m}", "1", "ACTIVE", strict_from, kind, [f"quarter_{a}", f"quarter_{b}"], DECLARED, "USD" if kind in (DIFFERENCE, NET_DEBT) else "PERCENT") for m, kind, a, b in MADE]
    for version, since, basis in (("1", strict_from, DECLARED), ("2", arithmetic_from, ARITHMETIC)):
        if since is not None:
            rows += [(f"ttm_{m}", version, "ACTIVE", since, TTM, [f"quarter_{m}"], basis, "USD") for m in SUMS]
            rows += [(f"ttm_{m}", version, "ACTIVE", since, TTM_PERCENT, [f"quarter_{a}", "quarter_revenue"], basis, "PERCENT") for m, a in MARGINS]
    return spark.createDataFrame(rows, DEFINITIONS)


def active(definitions: DataFrame, as_of: str) -> list[Definition]:
    """Of each metric the newest ACTIVE version reviewed by as_of, in an order in which inputs come first (C11).

    Definitions are a catalog, not data: they come to the driver to be compiled.
    A version that comes twice, an input that is no metric, and a circle are
    errors.
    """
    known = definitions.where((F.col("status") == "ACTIVE") & (F.col("reviewed_at") <= F.lit(as_of).cast("date")))
    newest = known.groupBy("metric").agg(F.max("reviewed_at").alias("reviewed_at"))
    rows = known.join(newest, ["metric", "reviewed_at"]).orderBy("metric", "version").collect()
    by = {r["metric"]: Definition(r["metric"], r["version"], r["kind"], tuple(r["inputs"]), r["basis"], r["unit"]) for r in rows}
    if len(by) != len(rows):
        raise ValueError("several versions of a metric are reviewed on one day")
    out: dict[str, Definition] = {}
    while len(out) < len(by):
        ready = [d for d in by.values() if d.metric not in out and all(i in out for i in d.inputs)]
        if not ready:
            stuck = sorted(set(by) - set(out))
            missing = sorted({i for m in stuck for i in by[m].inputs} - set(by))
            raise ValueError(f"inputs that are no metric: {missing}" if missing else f"metrics that depend on each other: {stuck}")
        out |= {d.metric: d for d in ready}
    return list(out.values())


def passes(definitions: Iterable[Definition]) -> list[list[Definition]]:
    """Definitions in passes: each needs only what earlier passes made, and is either of one quarter or across quarters."""
    left = [d for d in definitions if d.kind != REPORTED]
    have = {d.metric for d in definitions if d.kind == REPORTED}
    out = []
    while left:
        ready = [d for d in left if set(d.inputs) <= have]
        now = [d for d in ready if d.kind not in ACROSS] or ready
        out.append(now)
        have |= {d.metric for d in now}
        left = [d for d in left if d.metric not in have]
    return out


def _cell(**values: Column) -> Column:
    """A cell of the given fields, all others null."""
    fields = [f.split(" ", 1) for f in _CELL]
    return F.struct(*[values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields])


def _differ(a: Column, b: Column, *fields: str) -> Column:
    out = F.lit(False)
    for f in fields:
        out = out | ~a[f].eqNullSafe(b[f])
    return out


def _scope(a: Column, b: Column) -> Column:
    """The first reason why two cells don't go together, whatever their periods are."""
    return (
        F.when(_differ(a, b, "dims"), "SOURCE_SCOPE_MISMATCH")
        .when(_differ(a, b, "basis", "versions", "mapping"), "BASIS_INCOMPATIBLE")
        .when(~a["unit"].eqNullSafe(F.lit("USD")) | ~b["unit"].eqNullSafe(F.lit("USD")), "UNIT_NOT_USD")
    )


def _one_period(a: Column, b: Column) -> Column:
    """The first reason why two cells are no pair of one quarter of one filing."""
    return (
        F.when(_differ(a, b, "start", "end", "coordinate"), "PERIOD_MISMATCH")
        .when(a["filing"].isNull() | b["filing"].isNull(), "SOURCE_ENDPOINT_MISSING")
        .when(_differ(a, b, "filing"), "SOURCE_FILING_MISMATCH")
    )


def _rate(a: Column, b: Column) -> Column:
    return F.when(b != 0, a.cast("double") / b.cast("double") * 100)


def _same_quarter(rows: DataFrame, d: dict[str, Column]) -> DataFrame:
    """rows with reason and cell of a definition of one quarter, from the cells x and y."""
    kind, a, b = d["kind"], F.col("x"), F.col("y")
    x, y = a["value"], b["value"]
    apart = kind.isin(DIFFERENCE, NET_DEBT)
    signs = (
        F.when((kind == NET_DEBT) & ~F.coalesce(a["combined_debt"], F.lit(False)), "DIRECT_COMBINED_DEBT_UNAVAILABLE")
        .when((kind == NET_DEBT) & ((x < 0) | (y < 0)), "NEGATIVE_INPUT")
        .when((kind == DIFFERENCE) & (y < 0), "CAPEX_SIGN_UNCERTAIN")
        .when(~apart & (y < 0) & (d["metric"] == "quarter_liabilities_to_equity"), "NEGATIVE_EQUITY")
        .when(~apart & (y <= 0), "NON_POSITIVE_DENOMINATOR")
        .when((kind == STOCK_PERCENT) & (x < 0), "NEGATIVE_NUMERATOR")
    )
    keep = {f: a[f] for f in ("coordinate", "start", "end", "dims", "basis", "versions", "mapping", "concept")}
    made = _cell(
        **keep, value=F.when(apart, x - y), percent=F.when(~apart, _rate(x, y)), filed=F.greatest(a["filed"], b["filed"]), filing=F.when(kind == DIFFERENCE, a["filing"]), unit=d["unit"],
        semantic=F.when(kind == DIFFERENCE, F.concat_ws(";", a["semantic"], b["semantic"])).otherwise(a["semantic"]), lineage=F.concat(a["lineage"], b["lineage"]),
    )
    return rows.withColumn("reason", F.coalesce("x_why", "y_why", _scope(a, b), _one_period(a, b), signs)).withColumn("cell", made)


def _four(near: Column) -> Column:
    """The four quarters up to a cell, oldest first; null where one is missing."""
    four = F.transform(F.sequence(F.lit(3), F.lit(0), F.lit(-1)), lambda k: F.try_element_at(near, k))
    return F.when(F.forall(four, lambda c: c.isNotNull()), four)


def _sum_reason(d: dict[str, Column], four: Column) -> Column:
    """Why four quarters can't be added up."""
    touch = F.forall(F.sequence(F.lit(1), F.lit(3)), lambda k: F.get(four, k - 1)["end"].eqNullSafe(F.get(four, k)["start"]))
    unlike = F.size(F.array_distinct(F.transform(four, lambda c: F.struct(*[c[f] for f in ("semantic", "basis", "unit", "dims", "mapping", "versions", "concept")])))) > 1
    arithmetic, basis = d["basis"] == ARITHMETIC, F.get(four, F.lit(0))["basis"]
    undeclared = (F.coalesce(basis, F.lit("")) == "") & ~(arithmetic & basis.isNull())
    odd = F.exists(four, lambda c: ~F.coalesce(F.datediff(c["end"], c["start"]).between(75, 105), F.lit(False)))
    compatible = F.lit("INPUTS_NOT_COMPATIBLE")
    return F.when(four.isNull(), compatible).when(~touch, "INPUTS_NOT_CONTIGUOUS").when(unlike | undeclared | (arithmetic & odd), compatible)


def _total(four: Column) -> Column:
    return F.aggregate(four, F.lit(0).cast("decimal(28,4)"), lambda t, c: (t + c["value"]).cast("decimal(28,4)"))


def _across(rows: DataFrame, d: dict[str, Column]) -> DataFrame:
    """rows with reason and cell of a definition across quarters; near has the cells up to four quarters back by fiscal coordinate, where only one claims it."""
    kind, why, a = d["kind"], F.col("x_why"), F.col("x")
    growth, ratio = kind.isin(QOQ, YOY), kind == TTM_PERCENT
    back = F.when(kind == QOQ, 1).when(kind == YOY, 4)
    rows = rows.withColumn("p", F.try_element_at("near", back)).withColumn("four", F.when(~growth, _four(F.col("near")))).withColumn("below", F.when(ratio, _four(F.col("near_b"))))
    p, four, below = F.col("p"), F.col("four"), F.col("below")
    rows = rows.withColumn("top", _total(four)).withColumn("bottom", _total(below))
    pairs = F.filter(F.transform(F.arrays_zip("four", "below"), lambda z: F.coalesce(_scope(z["four"], z["below"]), _one_period(z["four"], z["below"]))), lambda r: r.isNotNull())
    identity = F.when(_differ(a, p, "concept"), "SEMANTIC_IDENTITY_MISMATCH").when((kind == QOQ) & ~p["end"].eqNullSafe(a["start"]), "PERIOD_NOT_CONTIGUOUS").when((kind == YOY) & F.coalesce(p["end"] > a["start"], F.lit(True)), "PERIOD_OVERLAP")
    signs = F.when(p["value"] <= 0, "NON_POSITIVE_DENOMINATOR").when(a["value"] < 0, "NEGATIVE_CURRENT_VALUE")
    rows = rows.withColumn("of_growth", F.when(growth, F.coalesce(why, F.when(p.isNull(), "MISSING_INPUT"), _scope(a, p), identity, signs)))
    rows = rows.withColumn("of_sum", F.when(~growth, F.coalesce(F.when(why.isNotNull(), "INPUTS_NOT_COMPATIBLE"), _sum_reason(d, four))))
    rows = rows.withColumn("of_ratio", F.when(ratio, F.coalesce(_sum_reason(d, below), F.get(pairs, F.lit(0)), F.when(F.col("bottom") <= 0, "NON_POSITIVE_DENOMINATOR"))))
    percent = F.when(growth, _rate(a["value"] - p["value"], p["value"])).when(ratio, _rate(F.col("top"), F.col("bottom")))
    each = F.when(growth, F.array(a, p)).otherwise(F.concat(four, F.coalesce("below", F.slice("four", F.lit(1), F.lit(0)))))
    rows = rows.withColumn("each", each)
    keep = {f: a[f] for f in ("coordinate", "end", "dims", "versions", "mapping", "concept", "semantic")}
    first = F.when(growth, a).otherwise(F.get(four, F.lit(0)))
    made = _cell(
        **keep, value=F.when(kind == TTM, F.col("top")), percent=percent, start=first["start"], basis=first["basis"], unit=d["unit"],
        filed=F.array_max(F.transform("each", lambda c: c["filed"])), lineage=F.flatten(F.transform("each", lambda c: c["lineage"])),
    )
    return rows.withColumn("reason", F.coalesce("of_growth", "of_sum", "of_ratio")).withColumn("cell", made)


def _index(found: DataFrame) -> DataFrame:
    """(company, metric, coordinate, cell) of usable cells (company, metric, cell), less coordinates that several claim."""
    keyed = found.withColumn("coordinate", F.col("cell.coordinate")).where("coordinate is not null")
    return keyed.groupBy("company", "metric", "coordinate").agg(F.count("*").alias("n"), F.first("cell").alias("cell")).where("n = 1").drop("n")


def _written(df: DataFrame) -> DataFrame:
    """df, written once to the shared folder, as a pass across quarters reads it several times."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "quarters")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def evaluate(cells: DataFrame, spine: list[int], definitions: list[Definition]) -> DataFrame:
    """One row for each company, bucket of the spine and metric: value, unit, reason, and what it stands on (C11, C14).

    cells (see CELLS) has the candidates of reported metrics; a bucket is a
    calendar quarter as year * 4 + quarter, coordinate the fiscal quarter in the
    same form.  A bucket without a candidate is NO_FILING_AS_OF_CUTOFF if the
    company has none at all there, else INPUT_NOT_REPORTED; several are
    MULTIPLE_CANDIDATES; one with reasons has its first.  Look-ups use all
    buckets, the result has those of the spine.  A fiscal quarter that several
    usable cells of a metric claim is no one's predecessor.

    Quarters of all metrics stand in one map per company and bucket, at most
    one cell for each definition; each pass of definitions is one expression
    over that map.  Only passes across quarters shuffle: their inputs are joined
    with the cells up to four quarters back.
    """
    version = {d.metric: d for d in definitions}
    reported = [d.metric for d in definitions if d.kind == REPORTED]
    lineage = F.array(F.concat_ws("|", "metric", F.col("coordinate").cast("string"), "filing"))
    names = {f.split(" ")[0] for f in _CELL} - {"percent", "semantic", "lineage"}
    made = _cell(**{c: F.col(c) for c in names}, semantic=F.concat_ws("|", F.coalesce("concept", F.lit("")), F.coalesce("mapping", F.lit(""))), lineage=lineage)
    why = F.when(F.size(F.coalesce("reasons", F.array().cast("array<string>"))) > 0, F.get("reasons", F.lit(0))).when(F.col("value").isNull(), "INPUT_NOT_REPORTED")
    known = cells.where(F.col("metric").isin(*reported)).select("company", "metric", "bucket", why.alias("reason"), F.when(why.isNull(), made).alias("cell"))
    one = known.groupBy("company", "bucket", "metric").agg(F.count("*").alias("n"), F.first("reason").alias("reason"), F.first("cell").alias("cell"))
    several = F.col("n") > 1
    chosen = one.select("company", "bucket", "metric", F.struct(F.when(several, "MULTIPLE_CANDIDATES").otherwise(F.col("reason")).alias("reason"), F.when(~several, F.col("cell")).alias("cell")).alias("got"))
    grid = known.select("company").distinct().select("company", F.explode(F.array(*[F.lit(b).cast("long") for b in spine])).alias("bucket"))
    there = chosen.groupBy("company", "bucket").agg(F.map_from_entries(F.collect_list(F.struct("metric", "got"))).alias("m"))
    wide = there.join(grid, ["company", "bucket"], "full")
    absent = F.when(F.col("m").isNull(), "NO_FILING_AS_OF_CUTOFF").otherwise("INPUT_NOT_REPORTED")
    nothing = F.create_map().cast(dict(there.dtypes)["m"])
    wide = wide.select("company", "bucket", absent.alias("absent"), F.coalesce("m", nothing).alias("m"))
    usable = known.where("cell is not null").select("company", "metric", "cell")
    for now in passes(definitions):
        literal = F.array(*[F.struct(F.lit(d.metric).alias("metric"), F.lit(d.kind).alias("kind"), F.array(*[F.lit(i) for i in d.inputs]).alias("inputs"), F.lit(d.basis).alias("basis"), F.lit(d.unit).alias("unit")) for d in now])
        source = wide
        across = now[0].kind in ACROSS
        if across:
            needed = sorted({i for d in now for i in d.inputs})
            wide = _written(wide)
            source = wide
            current = wide.select("company", "bucket", F.explode(F.map_filter("m", lambda k, v: k.isin(*needed) & v["cell"].isNotNull())).alias("metric", "got"))
            made_here = current.where(~F.col("metric").isin(*reported)).select("company", "metric", F.col("got.cell").alias("cell"))
            index = _index(usable.where(F.col("metric").isin(*needed)).unionByName(made_here))
            asked = current.select("company", "bucket", "metric", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("back"), F.col("got.cell.coordinate").alias("at")).withColumn("coordinate", F.col("at") - F.col("back"))
            near = asked.join(index, ["company", "metric", "coordinate"])
            near = near.groupBy("company", "bucket", "metric").agg(F.map_from_entries(F.collect_list(F.struct("back", "cell"))).alias("near"))
            near = near.groupBy("company", "bucket").agg(F.map_from_entries(F.collect_list(F.struct("metric", "near"))).alias("all_near"))
            source = wide.join(near, ["company", "bucket"], "left")
        rows = source.withColumn("d", F.explode(literal))
        d = {c: F.col(f"d.{c}") for c in ("metric", "kind", "inputs", "basis", "unit")}
        got = lambda k: F.try_element_at("m", F.get(d["inputs"], F.lit(k)))
        rows = rows.withColumn("x", got(0)).withColumn("y", got(1))
        gap = lambda c: F.when(F.col(c).isNull(), F.col("absent")).otherwise(F.col(f"{c}.reason"))
        rows = rows.withColumn("x_why", gap("x")).withColumn("y_why", gap("y")).withColumn("x", F.col("x.cell")).withColumn("y", F.col("y.cell"))
        if across:
            at = lambda k: F.try_element_at("all_near", F.get(d["inputs"], F.lit(k)))
            rows = _across(rows.withColumn("near", at(0)).withColumn("near_b", at(1)), d)
        else:
            rows = _same_quarter(rows, d)
        rows = rows.select("company", "bucket", "absent", "m", F.col("d.metric").alias("metric"), F.struct("reason", F.when(F.col("reason").isNull(), F.col("cell")).alias("cell")).alias("got"))
        gathered = rows.groupBy("company", "bucket").agg(F.first("absent").alias("absent"), F.first("m").alias("m"), F.map_from_entries(F.collect_list(F.struct("metric", "got"))).alias("more"))
        wide = gathered.select("company", "bucket", "absent", F.map_concat("m", "more").alias("m"))
    every = F.array(*[F.struct(F.lit(d.metric).alias("metric"), F.lit(d.version).alias("version"), F.lit("REPORTED" if d.kind == REPORTED else "DERIVED_METRIC").alias("source_kind")) for d in version.values()])
    rows = wide.where(F.col("bucket").isin(*spine)).select("company", "bucket", "absent", "m", F.inline(every)).withColumn("got", F.try_element_at("m", F.col("metric")))
    why = F.when(F.col("got").isNull(), F.col("absent")).otherwise(F.col("got.reason"))
    value = F.coalesce(F.col("got.cell.value").cast("double"), F.col("got.cell.percent"))
    return rows.select("company", "bucket", "metric", "version", "source_kind", value.alias("value"), why.alias("reason"), *[F.col(f"got.cell.{c}").alias(c) for c in ("unit", "coordinate", "start", "end", "filed", "lineage")])
