"""Operator 13 against brute force over all pairs of words, and against its SQL."""

import re
import zlib
from collections import Counter

import duckdb
import pytest
from asofworks.llm import spelling

from tests.llm.conftest import CLASHING, rows

AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def expected_words(items):
    counts = Counter()
    for doc_id, text in items:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(AZ)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def expected(items):
    words = expected_words(items)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return out


def got(df):
    found = df.select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert len(found) == len({r.word for r in found})
    return {tuple(r) for r in found}


def letters(word, n):
    return f"{word} " * n


#: Chains of forms, ties, letters beyond ASCII, edits at the ends and in the middle, repeated letters, anagrams, short and rare words.
VARIED = [
    (1, letters("letters", 700) + letters("lettters", 120) + letters("letter", 30) + letters("lettre", 30) + letters("xetter", 6)),
    (2, letters("anbncn", 40) + letters("anbncm", 8) + letters("anbnck", 40) + letters("nanbcn", 5) + letters("anbnc", 900)),
    (3, letters("ÉTÉÉTÉ", 30) + letters("étéété", 6) + letters("étéétéx", 7) + letters("Éétéété", 5) + letters("naïveté", 50) + letters("naivetÉ", 9) + letters("naiveté", 9)),
    (4, letters("aaaaaa", 50) + letters("aaaaaaa", 9) + letters("aaaaaaaa", 60) + letters("baaaaa", 5) + letters("aaabaaa", 10) + letters("aaaaab", 4)),
    (None, letters("sixsix", 5) + letters("sixsiz", 25)),
    (5, "x1y2 _under_score_ wörd×÷wörd ſtrange " * 6),
]


def test_small_words_by_hand(spark):
    found = {r[0]: r for r in got(spelling.variants(spark.createDataFrame(VARIED, "doc_id long, text string")))}
    assert found["xetter"][1:3] == ("letter", "letters") and found["lettters"][1] == "letters"
    assert found["sixsix"][1] == "sixsiz" and "anbnc" not in found and "aaaaab" not in found


@pytest.mark.parametrize("which", ["varied", "rows"])
def test_equals_brute_force(spark, docs, which):
    data = spark.createDataFrame(VARIED, "doc_id long, text string") if which == "varied" else docs
    items = VARIED if which == "varied" else [(r[0], r[1]) for r in rows()]
    assert got(spelling.variants(data)) == expected(items)


def test_equals_sql(spark, tmp_path):
    items = VARIED + [(r[0], r[1]) for r in rows()]
    data = spark.createDataFrame(items, "doc_id long, text string")
    data.write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    found = con.sql(f"SELECT word, form, root, n, n_near, form_n FROM ({spelling.OP13_SQL})").fetchall()
    assert set(found) == got(spelling.variants(data))


def test_one_very_common_word_and_near_words_of_half_of_all(spark):
    """Thousands of words one edit away from one another's letters: no word is lost, and pairs are each found once."""
    stems = [f"{a}{b}{c}" for a in "abcdefghij" for b in "klmnop" for c in "qrstu"]
    items = [(1, "common " * 20000)] + [(k + 2, f"{s}{t} " * (5 + k % 7)) for k, s in enumerate(stems) for t in ("xxx", "xyx")]
    data = spark.createDataFrame(items, "doc_id long, text string").repartition(4)
    assert got(spelling.variants(data)) == expected(items)


def test_cases(spark, docs, no_docs):
    assert set(CLASHING) < set(docs.columns)
    assert spelling.variants(no_docs).count() == 0
    assert spelling.variants(spark.createDataFrame([(1, None), (2, ""), (3, "short words only")], "doc_id long, text string")).count() == 0


def test_classes_are_dealt_by_frequency():
    classes = spelling.letter_classes({"a": 9, "b": 5, "c": 4, "d": 1}, 2)
    assert classes == ["ad", "bc"]


def test_entries_are_not_broadcast(spark, capsys):
    """A small file of words makes two dozen entries a word, so its size says nothing of the join's sides."""
    table = spelling.kept(spelling.words(spark.createDataFrame(VARIED, "doc_id long, text string")), "words")
    words = sorted(r.word for r in table.collect())
    assert {tuple(sorted((r.a, r.b))) for r in spelling.near_words(table).collect()} == {(a, b) for a in words for b in words if a < b and one_edit(a, b)}
    for df in (spelling.near_words(table), spelling.variants(spark.createDataFrame(VARIED, "doc_id long, text string"))):
        df.explain("simple")
        plan = capsys.readouterr().out
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
