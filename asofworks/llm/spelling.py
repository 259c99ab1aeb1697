"""Operator 13: groups of spelling variants, by PartEnum signatures of letter multisets.  DataFrame functions only.

A word's letters are a binary vector with one dimension for each letter and
occurrence (first a, second a, ...).  One inserted or deleted code point flips
one dimension, one replaced code point two.  The dimensions are cut into
classes; vectors that differ in at most k dimensions differ in at most k of the
classes, so they agree in all classes of some subset that leaves k out.  The
letters of each such subset make one signature, and near words share one
(PartEnum with one partition on its first level).
"""

from __future__ import annotations

import math
from itertools import combinations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asofworks.llm.store import kept, read_table

#: Runs that are words: A-Z, a-z, and U+00C0 to U+00FF.
RUN = "[A-Za-zÀ-ÿ]+"
#: A run is edited if this divides its hash.
EDIT = 199
#: Code points and occurrences that a word has at least.
LETTERS, OCCURRENCES = 6, 5
#: A form is as many times as frequent as its word, at least.
TIMES = 5
#: Classes of letters for words of equal length (two are left out of a signature), and of lengths that differ by one (one is left out).
CLASSES_EQUAL, CLASSES_LONGER = 4, 3

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(docs: DataFrame) -> DataFrame:
    """(word, n): the words of all texts, of LETTERS code points and OCCURRENCES at least.

    Words are maximal runs of A-Z, a-z and U+00C0 to U+00FF, only A-Z made lower
    case.  With h the crc32 of `<doc_id>:<word>`, a word whose h EDIT divides
    loses its code point h modulo its length.  A null doc_id counts as empty
    text, a null text has no words.
    """
    doc_id = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit(""))
    found = docs.select(doc_id.alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    # lower() would change letters beyond A-Z too, where there are any
    low = F.when(F.octet_length("run") == F.length("run"), F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER))
    found = found.select("id", low.alias("run"))
    found = found.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    edited = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    found = found.select(F.when(F.col("h") % EDIT == 0, edited).otherwise(F.col("run")).alias("word"))
    counted = found.where(F.length("word") >= LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= OCCURRENCES)


def letter_classes(counts: dict[str, int], classes: int) -> list[str]:
    """The letters dealt to classes: the most frequent first, each to the class that has the fewest so far."""
    out, load = [""] * classes, [0] * classes
    for letter, n in sorted(counts.items(), key=lambda x: (-x[1], x[0])):
        least = load.index(min(load))
        out[least] += letter
        load[least] += n
    return out


def _signatures(counts: dict[str, int], classes: int, left_out: int, length: Column, half: Column, role: int) -> list[Column]:
    """(key, role) of each subset of the classes, with either half of the word; length is that of the shorter word of a pair."""
    others = ["".join(set(counts) - set(c)) for c in letter_classes(counts, classes)]
    some = [F.translate("letters", "".join(sorted(o)), "") for o in others]
    out = []
    for number, subset in enumerate(combinations(range(classes), classes - left_out)):
        for side, part in ((0, F.substring("word", F.lit(1), half)), (1, F.substring("word", F.length("word") - half + 1, half))):
            key = F.xxhash64(F.lit(left_out), F.lit(number), F.lit(side), length, part, *[some[k] for k in subset])
            out.append(F.struct(key.alias("key"), F.lit(role).alias("role")))
    return out


def near_words(table: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): the pairs of words of table (word, n) that differ by exactly one code point, each once.

    Words of equal length meet by signatures that leave out two of
    CLASSES_EQUAL classes of letters, words whose lengths differ by one by
    signatures that leave out one of CLASSES_LONGER.  One edit also leaves the
    first or the last half of the shorter word as it is, so a signature holds
    the length and one half as well: anagrams and words of common letters then
    don't crowd one key.  What meets is verified by edit distance, so the pairs
    are exact.

    Each word makes two dozen entries, which Spark's estimate from the size of
    the word table leaves out: without a hint it would send them all to the
    driver and to every executor, as long as that table alone is small.
    """
    letters = table.select(F.explode(F.split("word", "")).alias("letter")).groupBy("letter").count()
    counts = {r["letter"]: r["count"] for r in letters.collect()}  # of an alphabet of 90
    length, whole = F.length("word"), table.withColumn("letters", F.array_join(F.array_sort(F.split("word", "")), ""))
    floor = lambda x: F.floor(x / 2).cast("int")
    made = [
        *_signatures(counts, CLASSES_EQUAL, 2, length, floor(length), 0),
        *_signatures(counts, CLASSES_LONGER, 1, length, floor(length + 1), 1),
        *_signatures(counts, CLASSES_LONGER, 1, length - 1, floor(length), 2),
    ]
    entries = whole.select("word", "n", F.inline(F.array(*made)))
    one, two = (entries.select("key", F.col("role").alias(f"{x}_role"), F.col("word").alias(x), F.col("n").alias(f"{x}_n")) for x in "ab")
    roles = ((F.col("a_role") == 0) & (F.col("b_role") == 0) & (F.col("a") < F.col("b"))) | ((F.col("a_role") == 1) & (F.col("b_role") == 2))
    met = one.join(two.withColumnRenamed("key", "its_key").hint("merge"), (F.col("key") == F.col("its_key")) & roles & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def variants(docs: DataFrame) -> DataFrame:
    """(word, form, root, n, n_near, form_n): each word, its form, and the last form that forms lead to.

    A word's form is its most frequent near word (of equal ones the first by
    code points), if that is TIMES as frequent at least; without one form and
    form_n are null and root is the word itself.  n_near counts near words.  See
    words() for what a word is, and for null ids and texts.  Repeated rows count
    each.  Other columns are ignored.  Without words the result is empty.  No
    join broadcasts: files of words are many times larger in memory.
    """
    table = kept(words(docs), "words")
    near = near_words(table)
    both = near.select(F.col("a").alias("word"), F.col("b").alias("other"), F.col("b_n").alias("other_n")).unionAll(near.select("b", "a", "a_n"))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"))
    rows = table.join(best.hint("merge"), "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.other").alias("other"), (-F.col("best.less")).alias("other_n"))
    has = F.col("other_n") >= TIMES * F.col("n")
    rows = kept(rows.select("word", "n", "n_near", F.when(has, F.col("other")).alias("form"), F.when(has, F.col("other_n")).alias("form_n")), "forms")
    most = rows.agg(F.max("n")).first()[0] or 1
    # each form is TIMES as frequent as what it is the form of, which bounds the steps to a root; each round doubles those taken
    steps = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1.0, math.log(most, TIMES))))):
        ahead = steps.select(F.col("word").alias("its"), F.col("root").alias("further"))
        steps = kept(steps.join(ahead.hint("merge"), F.col("root") == F.col("its"), "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    out = rows.join(steps.hint("merge"), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.col("n_near").cast("long").alias("n_near"), "form_n")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(read_table(spark, sf_dir, "documents"))


#: The same in SQL: crc32 from its table, near words by what is left when one code point is deleted or covered.
OP13_SQL = """
WITH RECURSIVE
bits AS (
    SELECT i, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
    UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bits WHERE k < 8
),
crc_table AS (SELECT list(v ORDER BY i) AS t FROM bits WHERE k = 8),
runs AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{00C0}-\\x{00FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
),
counted AS (SELECT run, hex(encode(id || ':' || run)) AS code, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(0, length(code) // 2), lambda k: ('0x' || substring(code, 2 * k + 1, 2))::BIGINT)),
        lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
    FROM counted, crc_table
),
edited AS (SELECT CASE WHEN h % 199 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS (SELECT word, sum(n)::BIGINT AS n FROM edited WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
cut AS (SELECT word, n, k, substring(word, 1, k - 1) AS a, substring(word, k + 1) AS b FROM less),
near AS (
    SELECT x.word, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.k = y.k AND x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON x.a || x.b = y.word
    UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON x.a || x.b = y.word
),
best AS (SELECT word, count(*) AS n_near, min({'less': -other_n, 'other': other}) AS best FROM near GROUP BY word),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * w.n THEN best.other END AS form, CASE WHEN -best.less >= 5 * w.n THEN -best.less END AS form_n
    FROM words w LEFT JOIN best USING (word)
),
steps AS (
    SELECT word, word AS root, 0 AS k FROM formed
    UNION ALL SELECT s.word, f.form, k + 1 FROM steps s JOIN formed f ON s.root = f.word WHERE f.form IS NOT NULL
),
roots AS (SELECT word, max_by(root, k) AS root FROM steps GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""
