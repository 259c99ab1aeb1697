"""Operator 7: shards that all have the mixture of the whole, by proportional stratified interleaving."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.llm.ranks import parts_for, running, uniform
from asofworks.llm.store import kept, read_table

SHARDS, SEED = 24, 20240607


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """One row per row of docs: doc_id, source, size, text_crc32, law, shard, slot, grown_shard.

    The rows of each source are shuffled by a seeded hash and ranked; a row's
    place is (rank + 1/2) / rows of its source, so sorting all rows by place
    spreads every source evenly.  The sorted rows are cut into shards of equal
    numbers of rows, at most one apart (law "rows"); slot counts a shard's rows
    from 0 in that order.

    size is the UTF-8 bytes of the text (null: none) plus 8.  Null sources are
    a source of their own.  Rows that repeat share the hash and follow each
    other in any order, which changes no result but theirs among each other.  A
    null doc_id is hashed like any value.  Other columns are ignored.  With
    fewer rows than shards the last shards are empty; an empty table gives an
    empty result.
    """
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select("doc_id", "source", (F.octet_length(raw) + 8).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = kept(rows.withColumn("draw", uniform(seed, "doc_id", "text_crc32")), "rows")
    order = [F.col("doc_id"), F.col("text_crc32")]
    parts = parts_for(rows)
    ranked = running(rows, parts, ["source"], "draw", order, F.lit(1).cast("long"), "rank", "of")
    ranked = kept(ranked.withColumn("place", (F.col("rank") + 0.5) / F.col("of")).drop("rank", "of"), "places")
    sorted_rows = running(ranked, parts, [], "place", [F.col("source"), *order], F.lit(1).cast("long"), "at", "n")
    # the first n % shards shards take one row more
    small, more = F.floor(F.col("n") / shards), F.col("n") % shards
    wide = F.col("at") < more * (small + 1)
    number = F.when(wide, F.floor(F.col("at") / (small + 1))).otherwise(more + F.floor((F.col("at") - more * (small + 1)) / F.greatest(small, F.lit(1))))
    first = F.when(wide, F.col("shard") * (small + 1)).otherwise(more * (small + 1) + (F.col("shard") - more) * small)
    out = sorted_rows.withColumn("shard", number.cast("int")).withColumn("slot", (F.col("at") - first).cast("long"))
    return out.select("doc_id", "source", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(read_table(spark, sf_dir, "documents")).drop("source")
