"""Operator 8: mixing sources to target weights, by Pareto order sampling after whole copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from asofworks.llm.ranks import parts_for, running, uniform
from asofworks.llm.store import kept, packed_rows, read_table, unpacked

#: Weights of the sources in code point order, null last, repeating; the words of the mix as a share of all words; copies of a source at most.
WEIGHTS, SHARE, MOST, SEED = (3, 1, 2), 1.5, 2.0, 20240607
#: By how much of its source's rate the longest or shortest document's rate may differ from it.
TILT = 0.25


def words_in(text: str = "text") -> Column:
    """Number of words, that is runs without space or tab to carriage return; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """sizes (source, source_size and more, a row for each source) with target.

    Targets are proportional to the weights, but never over most times the
    source; what is over goes to the others by weight.  That is a level L with
    target = min(most * size, L * weight): sources in the order of their cap per
    weight are capped while the level that the rest would get is over the cap.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("nth") % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("nth", nth).withColumn("weight", weight).withColumn("cap", F.col("source_size") * most)
    up = Window.orderBy(F.col("cap") / F.col("weight"), "nth")
    everything = Window.partitionBy(F.lit(0))
    earlier = up.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("wanted", F.sum("source_size").over(everything) * share)
    rows = rows.withColumn("left", F.col("wanted") - F.coalesce(F.sum("cap").over(earlier), F.lit(0.0)))
    rows = rows.withColumn("heavy", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    rows = rows.withColumn("level", F.col("left") / F.col("heavy"))
    open_ = F.col("level") * F.col("weight") <= F.col("cap")
    # the first source, in that order, that its level leaves under its cap fixes the level of all that follow
    first = F.min(F.when(open_, F.struct(F.col("cap") / F.col("weight"), "nth", "level"))).over(everything)
    rows = rows.withColumn("final", first.getField("level"))
    target = F.least(F.col("cap"), F.coalesce(F.col("final"), F.lit(float("inf"))) * F.col("weight"))
    return rows.select(*sizes.columns, target.alias("target"))


def _quotas(rows: DataFrame) -> DataFrame:
    """(its_source, its_stratum, quota): how many documents each stratum's sample has, fixed before any is drawn.

    From the longest documents to the shortest, each stratum gets the number
    that brings the words, at its mean length, nearest to what is expected so
    far: what a few long documents leave over goes to the shorter ones.
    """
    some = F.col("p") > 0
    strata = rows.groupBy("source", "stratum").agg(
        F.sum(F.col("p") * F.col("n")).alias("p"), F.sum(F.col("p") * F.col("n") * F.col("size")).alias("words"), F.sum(F.when(some, F.col("n")).otherwise(0)).cast("double").alias("have")
    )
    # a source has as many strata as powers of two up to its longest document: some thirty at most
    each = strata.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("stratum", "p", "words", "have")), asc=False).alias("strata"))
    quota = "if(x.words > 0, least(greatest(round((acc.want + x.words - acc.got) / (x.words / x.p)), 0D), x.have), 0D)"
    start = "named_struct('want', 0D, 'got', 0D, 'out', cast(array() as array<struct<stratum: int, quota: double>>))"
    step = f"named_struct('want', acc.want + x.words, 'got', acc.got + if(x.words > 0, {quota} * x.words / x.p, 0D), 'out', concat(acc.out, array(named_struct('stratum', x.stratum, 'quota', {quota}))))"
    out = each.select(F.col("source").alias("its_source"), F.expr(f"inline(aggregate(strata, {start}, (acc, x) -> {step}).out)"))
    return out.select("its_source", F.col("stratum").alias("its_stratum"), "quota")


def _units(docs: DataFrame, seed: int, weights: tuple[int, ...], share: float, most: float) -> DataFrame:
    """(source, doc_id, text_hash, size, n, source_size, target, p, copies): equal rows as one unit of n rows."""
    rows = docs.select("source", "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words_in().alias("size"))
    rows = rows.groupBy("source", "doc_id", "text_hash", "size").agg(F.count("*").alias("n"))
    rows = kept(rows.withColumn("draw", uniform(seed, "doc_id", "text_hash")), "sizes")
    parts = parts_for(rows)
    words, length = F.col("size") * F.col("n"), F.log2(F.col("size") + F.lit(1.0))
    sizes = rows.groupBy("source").agg(F.sum(words).alias("source_size"), (F.sum(words * length) / F.sum(words)).alias("mean"), F.min(length).alias("low"), F.max(length).alias("high"))
    aims = targets(sizes, weights, share, most).withColumnRenamed("source", "its_source")
    rows = rows.join(aims, F.col("source").eqNullSafe(F.col("its_source"))).drop("its_source")
    # a document's expected copies: its source's rate, tilted by its length; the tilts cancel out over the source's words
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    reach = F.greatest(F.col("high") - F.col("mean"), F.col("mean") - F.col("low"))
    tilt = F.when((F.col("rate") > 0) & (reach > 0), F.greatest(F.least(F.lit(TILT), (most - F.col("rate")) / F.col("rate")), F.lit(0.0)) * (length - F.col("mean")) / reach).otherwise(F.lit(0.0))
    rows = rows.withColumn("rate", rate).withColumn("expected", F.greatest(F.least(F.col("rate") * (1 + tilt), F.lit(float(most))), F.lit(0.0)))
    rows = rows.withColumn("whole", F.floor(F.col("expected") + F.lit(1e-9)).cast("long"))
    left = F.col("expected") - F.col("whole")
    rows = rows.withColumn("p", F.when(left > 1e-9, left).otherwise(F.lit(0.0))).withColumn("stratum", F.floor(length).cast("int"))
    quotas = _quotas(rows)
    rows = rows.join(quotas, F.col("source").eqNullSafe(F.col("its_source")) & (F.col("stratum") == F.col("its_stratum")))
    odds = F.col("draw") / (1 - F.col("draw"))
    rank = F.when(F.col("p") > 0, odds * (1 - F.col("p")) / F.col("p"))
    # q / (1 + q) grows as the rank q does, and lies between 0 and 1; where no rank counts, draw spreads the rows
    rows = rows.withColumn("place", F.coalesce(rank / (1 + rank), F.col("draw")))
    counts = F.when(F.col("p") > 0, F.col("n")).otherwise(F.lit(0).cast("long"))
    ranked = running(rows, parts, ["source", "stratum"], "place", [F.col("doc_id"), F.col("size"), F.col("text_hash")], counts, "before")
    extra = (F.col("p") > 0) & (F.col("before") + F.col("n") / 2 <= F.col("quota"))
    return ranked.withColumn("copies", (F.col("whole") + F.when(extra, 1).otherwise(0)).cast("int"))


def mix(docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, taken, copies, p.

    A source that is to be taken r times gives each document r expected copies,
    up to TILT of r more or less as it is longer or shorter than the source's
    mean word finds its document (in log2 of words), never over most.  The
    whole part is allocated as certain copies; what is left is the document's
    inclusion probability p in a Pareto sample: documents are ranked by the
    random odds u / (1 - u) over the inclusion odds p / (1 - p), u drawn by a
    keyed hash, and the smallest are taken, as many as fixed before.  Sampling
    is by strata of documents whose lengths are within a factor of two, so the
    words come near the target.  taken counts words, repeats too.

    size is the number of words, 0 for null.  Null sources are a source of
    their own, last in the order.  The documents of a source without words are
    not taken.  A null doc_id is hashed like any value.  Rows of equal source,
    doc_id and text are taken together or not at all.  Other columns are
    ignored.  An empty table gives an empty result.
    """
    units = _units(docs, seed, weights, share, most)
    taken = (F.col("copies") * F.col("size")).cast("long")
    each = units.withColumn("nth_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return each.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"), "copies", "p")


def mixed(docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The documents of the mix, all columns of docs, whatever their names, each as often as mix() takes it."""
    units = _units(docs, seed, weights, share, most).where("copies > 0").select("source", "doc_id", "text_hash", "copies")
    rows = packed_rows(docs).withColumn("hash", F.xxhash64(F.coalesce("row.text", F.lit(""))))
    same = F.col("row.source").eqNullSafe(F.col("source")) & F.col("row.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    rows = rows.join(units, same).select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    return rows.select(*unpacked(docs))


def op8_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(read_table(spark, sf_dir, "documents")).drop("source")
