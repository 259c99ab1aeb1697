"""Operator 1: line dedup by an exact set-similarity join with prefix, positional and length filters.

DataFrame functions only.  A line's tokens are hashes of its 5-word shingles.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.llm.store import kept, packed_rows, read_table, unpacked, unused

#: Words in a token (a shingle), and the share (in hundredths) of common tokens at which two lines match.
WIDTH, SIMILAR = 5, 75
#: Counters of the table of token frequencies; a token's rarity is its counter's.
COUNTERS = 1 << 16
#: Rows that are broadcast at most; a larger table is joined by a shuffle.
BROADCAST_ROWS = 1 << 20
#: Tokens that a line must have in common with others, among its first by hash, before its tokens are counted and ranked.
COMMON = 4


def _small(df: DataFrame) -> DataFrame:
    """df, to be broadcast if its rows are few."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at, line, key, other_key): every line that has words; the two keys name its text."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")).alias("at", "line"))
    return rows.where(F.col("line").rlike(r"[^ \t\x0b\f\r]")).withColumn("key", F.xxhash64("line")).withColumn("other_key", F.xxhash64(F.lit(1), "line"))


def _place(docs: DataFrame) -> Column:
    """Where a line stands in the corpus, as one number: by doc_id (null last), then by line.  A long where ids and lengths let it."""
    least, most, length = docs.agg(F.min("doc_id"), F.max("doc_id"), F.max(F.octet_length("text"))).first()
    least, most, bits = least or 0, most or 0, (1 + (length or 0)).bit_length()
    if (most - least + 2) << bits < 1 << 62:
        return F.shiftleft(F.coalesce("doc_id", F.lit(most + 1)) - F.lit(least), bits) + F.col("at")
    number = lambda x, digits: F.lit(str(x)).cast(f"decimal({digits},0)")
    document = F.coalesce(F.col("doc_id").cast("decimal(20,0)"), number(most + 1, 20)) - number(least, 20)
    return (document.cast("decimal(21,0)") * number(1 << bits, 11) + F.col("at")).cast("decimal(38,0)")


def _hashed(lines: DataFrame, *keep: str) -> DataFrame:
    """The columns keep, and h, a hash of each lower-cased word of a line."""
    # each step is a projection of its own, so that nothing is computed twice; most lines have single spaces only and need no pattern
    rows = lines.select(*keep, F.lower("line").alias("low"))
    odd = F.col("low").startswith(" ") | F.col("low").endswith(" ")
    for c in ("  ", "\t", "\x0b", "\f", "\r"):
        odd = odd | F.contains("low", F.lit(c))
    words = F.when(odd, F.array_remove(F.split("low", "[ \t\x0b\f\r]+"), "")).otherwise(F.split("low", " "))
    return rows.select(*keep, words.alias("w")).select(*keep, F.transform("w", lambda w: F.xxhash64(w)).alias("h"))


# words beyond the end are null and leave the hash as it is: a line of fewer words is one token
_RUN = "xxhash64(" + ", ".join(["get(h, i)", *[f"get(h, i + {k})" for k in range(1, WIDTH)]]) + ")"
_PLACES = f"sequence(0, greatest(size(h) - {WIDTH}, 0))"
_TOKENS = f"transform({_PLACES}, i -> {_RUN})"


def _tokens(lines: DataFrame, *keep: str) -> DataFrame:
    """The columns keep, and t, the distinct tokens of a line."""
    return _hashed(lines, *keep).select(*keep, F.array_distinct(F.expr(_TOKENS)).alias("t"))


def _rarity(sets: DataFrame) -> Callable[[Column], Column]:
    """A function of a token: its hash below the level, 4 log2 of 1 + n, of its counter's n."""
    counted = sets.select(F.explode("t").alias("t")).groupBy(F.pmod("t", F.lit(COUNTERS)).cast("int").alias("counter")).agg(F.count("*").alias("n")).toPandas()
    n = np.zeros(COUNTERS)
    n[counted["counter"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    levels = np.minimum(np.floor(4 * np.log2(n + 1.0)), 127).astype(int)
    table = F.split(F.lit(",".join(map(str, levels.tolist()))), ",").cast("array<bigint>")
    return lambda t: F.shiftleft(F.get(table, F.pmod(t, F.lit(COUNTERS)).cast("int")), 56).bitwiseOR(F.shiftrightunsigned(t, 8))


def _first(common: int) -> Column:
    """Of the distinct tokens t in their order so many first ones that two lines that match have at least common of them in common, or all that they have in common."""
    n = F.size("t")
    return F.slice("t", F.lit(1), (n - F.ceil(n * SIMILAR / 100) + common).cast("int"))


def _near(common: int) -> Column:
    """Whether place i is one at which a pair meets in its smaller line: among the first n - ceil(6/7 n) + common."""
    return F.col("i") < F.col("n") - F.ceil(F.col("n") * (2 * SIMILAR) / (100 + SIMILAR)) + common


def _alive(firsts: DataFrame) -> DataFrame:
    """(key, other_key, place, t): the lines of firsts of whose first tokens by hash enough stand among those of other lines, with all their tokens.

    Two lines that match have COMMON of them in common under any order of
    tokens, or three quarters of the tokens of each, so the lines that are left
    out match nothing.  Hashes need no count.
    """
    ordered = _tokens(firsts, "key").select("key", F.sort_array("t").alias("t"))
    hashes = kept(ordered.select("key", F.size("t").alias("n"), _first(COMMON).alias("t")), "hashes")
    entries = hashes.select("key", "n", F.posexplode("t").alias("i", "token"))
    shared = kept(entries.groupBy("token").agg(F.count("*").alias("lines"), F.max(_near(COMMON)).alias("near")).where("lines > 1 and near").select("token"), "common")
    met = entries.join(_small(shared), "token", "left_semi").groupBy("key", "n").agg(F.count("*").alias("common"))
    keys = kept(met.where(F.col("common") >= F.least(F.lit(COMMON), F.ceil(F.col("n") * SIMILAR / 100))).select("key").distinct(), "alive")
    # no filter on the words here: it would move below the join and look at every line
    return kept(_tokens(firsts.join(_small(keys), "key", "left_semi"), "key", "other_key", "place"), "sets")


def matched_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, at): the lines that match an earlier line.

    Lines stand in the order of doc_id (null last) and place.  Equal lines are
    a class, placed where its first is.  A class's tokens are ordered by rarity;
    two classes can only match if they share one among the first
    n - ceil(0.75 n) + 1 tokens of both, if enough tokens stand behind it in
    both, and if their numbers of tokens are not too far apart.  What is left is
    verified on the full sets: first each class against the earliest that shares
    a token, then those still without a match against all earlier ones.
    Rarity only orders tokens, so the result is exact.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    at = _place(docs)
    lines = _lines(docs).withColumn("place", at)
    places = kept(lines.drop("line", "place"), "places").withColumn("place", at)
    repeats = places.groupBy("key", "other_key").agg(F.count("*").alias("n"), F.min("place").alias("first")).where("n > 1")
    repeats = kept(repeats.select("key", "other_key", "first"), "repeats")
    sets = _alive(lines.join(_small(repeats), ["key", "other_key"], "left").where("first is null or place = first"))
    ordered = sets.select("key", "place", F.sort_array(F.transform("t", _rarity(sets))).alias("t"))
    ranked = kept(ordered.select("key", "place", F.size("t").alias("n"), _first(1).alias("t")), "ranked")
    entries = ranked.select("key", "place", "n", F.posexplode("t").alias("i", "token"))
    shared = entries.groupBy("token").agg(F.min("place").alias("head"), F.max("place").alias("last"), F.max(_near(1)).alias("near")).where("head < last and near").select("token", "head")
    shared = kept(shared, "shared")
    entries = kept(entries.join(_small(shared), "token"), "entries")

    def pairs(left: DataFrame, right: DataFrame, more: Column) -> DataFrame:
        """(a, b) by a common token of left and right, through the length and positional filters."""
        a = left.select("token", F.col("key").alias("a"), F.col("place").alias("a_place"), F.col("n").alias("a_n"), F.col("i").alias("a_i"))
        b = right.select(F.col("token").alias("its"), "head", F.col("key").alias("b"), F.col("place").alias("b_place"), F.col("n").alias("b_n"), F.col("i").alias("b_i"))
        near = (F.col("a_n") * 100 >= F.col("b_n") * SIMILAR) & (F.col("b_n") * 100 >= F.col("a_n") * SIMILAR)
        # of the first token that two lines share, only what stands behind it can be common too
        most = F.least(F.col("a_n") - F.col("a_i"), F.col("b_n") - F.col("b_i"))
        enough = most * (100 + SIMILAR) >= SIMILAR * (F.col("a_n") + F.col("b_n"))
        return kept(a.join(b, (F.col("token") == F.col("its")) & (F.col("a_place") < F.col("b_place")) & more & near & enough).select("a", "b").distinct(), "pairs")

    def verified(pairs: DataFrame) -> DataFrame:
        """(key, other_key, place) of the later lines of pairs (a, b) that do match."""
        keys = kept(pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "keys")
        some = sets.join(_small(keys), "key", "left_semi")
        one = some.select(F.col("key").alias("a"), F.col("place").alias("a_place"), F.col("t").alias("a_t"))
        two = some.select(F.col("key").alias("b"), "other_key", F.col("place").alias("b_place"), F.col("t").alias("b_t"))
        both = pairs.join(one, "a").join(two, "b").where("a_place < b_place").withColumn("common", F.size(F.array_intersect("a_t", "b_t")))
        match = both.where(F.col("common") * 100 >= SIMILAR * (F.size("a_t") + F.size("b_t") - F.col("common")))
        return kept(match.select(F.col("b").alias("key"), "other_key", F.col("b_place").alias("place")).distinct(), "matched")

    matched = verified(pairs(_small(entries.where("place = head")), entries, F.lit(True)))
    rest = entries.join(_small(matched.select("key", "place")), ["key", "place"], "left_anti")
    matched = matched.unionAll(verified(pairs(entries, rest, F.col("a_place") > F.col("head"))))

    # a class that matches is removed whole, of another all but the first
    first_gone = matched.select("key", "other_key", F.lit(None).cast(dict(repeats.dtypes)["first"]).alias("spare")).distinct()
    others = repeats.join(_small(first_gone.select("key", "other_key")), ["key", "other_key"], "left_anti").select("key", "other_key", F.col("first").alias("spare"))
    gone = kept(first_gone.unionAll(others), "gone")
    found = places.join(_small(gone), ["key", "other_key"])
    return found.where("spare is null or place <> spare").select("doc_id", "text_hash", "at")


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with lines removed, and (lines, removed): how many lines each text had and lost.

    A line is removed if an earlier line of the corpus has 75 % of their united
    distinct 5-word shingles (lower-cased words between white space) in common;
    earlier means a smaller doc_id (null last), then a smaller place in the
    text.  Every earlier line counts, whether it is itself removed or not.  All
    words of a line of fewer than five are its one shingle; a line without
    words stays.

    A null text has 0 lines and stays null; an empty one has one line.  Rows
    that repeat a doc_id have lines at equal places, which don't precede each
    other.  All columns of docs are kept, whatever their names; if one is named
    lines or removed, the new column gets underscores behind its name.
    n_chars, if there, counts the new text.  An empty table gives an empty
    result.
    """
    gone = matched_lines(docs).distinct().groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list("at")).alias("gone"))
    gone = kept(gone, "removed").select(F.col("doc_id").alias("its_doc"), F.col("text_hash").alias("its_hash"), "gone")
    rows = packed_rows(docs).select("row", F.xxhash64(F.coalesce("row.text", F.lit(""))).alias("text_hash"))
    rows = rows.join(_small(gone), F.col("row.doc_id").cast("long").eqNullSafe(F.col("its_doc")) & (F.col("text_hash") == F.col("its_hash")), "left")
    parts = F.split("row.text", "\n")
    left = F.array_join(F.filter(F.transform(parts, lambda line, at: F.when(~F.array_contains("gone", at), line)), lambda line: line.isNotNull()), "\n")
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(left)
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("gone").isNull(), F.col("row.n_chars")).otherwise(F.length(left)).cast(docs.schema["n_chars"].dataType)
    had = F.when(F.col("row.text").isNull(), 0).otherwise(F.size(parts))
    lost = F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone"))
    names = unused(docs, "lines", "removed")
    return rows.select(*unpacked(docs, new), had.alias(names[0]), lost.alias(names[1]))


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """docs less their repeated lines; a document that loses all its lines goes."""
    lines, removed = unused(docs, "lines", "removed")
    return dedup_lines(docs).where(F.col(removed).isin(0) | (F.col(removed) < F.col(lines))).drop(lines, removed)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return rows.select("doc_id", F.col("lines").cast("long").alias("n_lines"), F.col("removed").cast("long").alias("n_removed"), F.octet_length(text).cast("long").alias("bytes_left"), F.crc32(text).alias("text_crc32"))
