"""Operators 1 and 9 against brute force."""

import zlib
from collections import Counter

import pytest
from asofworks.llm import graph, lines, minhash

from tests.llm.conftest import CLASHING, edited, prose, rows

LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingle_set(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def expected_components(items):
    sets = [(i, shingle_set(t)) for i, t in items]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if i is None or j is None or not a or not b:
                continue
            if 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in parent}, sets


def test_near_duplicates_equal_brute_force(docs):
    want, sets = expected_components([(r[0], r[1]) for r in rows()])
    got = [r.asDict() for r in minhash.near_duplicates(docs).collect()]
    assert len(got) == len(sets)
    for r in got:
        assert r["component_id"] == want.get(r["doc_id"])
        assert r["kept"] == (None if r["doc_id"] is None else r["doc_id"] == r["component_id"])
    assert Counter((r["doc_id"], r["n_shingles"]) for r in got) == Counter((i, len(s)) for i, s in sets)
    assert len({r["component_id"] for r in got}) < len({r["doc_id"] for r in got})


def test_near_duplicates_of_a_large_group(spark):
    base = prose(5, 60)
    items = [(k, edited(base, k, k % 6)) for k in range(300)]
    want, _ = expected_components(items)
    got = dict(minhash.near_duplicates(spark.createDataFrame(items, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert got == want


@pytest.mark.parametrize("block", [1024, 16])
def test_crowded_regions_lose_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(graph, "HUB", 3 if block == 16 else 10_000)
    base = prose(6, 300)
    family = [edited(base, k, 6) for k in range(250)]
    items = [(2 * k, t) for k, t in enumerate(family)] + [(2 * k + 1, edited(t, 1000 + k, 7)) for k, t in enumerate(family)]
    want, _ = expected_components(items)
    got = dict(minhash.near_duplicates(spark.createDataFrame(items, "doc_id long, text string")).select("doc_id", "component_id").collect())
    assert sum(got[k] != want[k] for k in want) == 0
    assert len(set(want.values())) > 1


def test_dropping_keeps_columns_and_one_of_each_group(docs):
    kept = minhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want, _ = expected_components([(r[0], r[1]) for r in rows()])
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows() if r[0] is None or want[r[0]] == r[0])


def test_near_duplicates_of_nothing(no_docs):
    assert minhash.near_duplicates(no_docs).count() == 0
    assert minhash.drop_near_duplicates(no_docs).count() == 0


def removed_lines(items):
    placed = []
    for i, text in items:
        for at, line in enumerate((text or "").split("\n")):
            placed.append(((i is None, i or 0, at), i, text, at, shingle_set(line.lower())))
    gone = set()
    for place, i, text, at, a in placed:
        for other, _, _, _, b in placed:
            if a and b and other < place and 100 * len(a & b) >= 75 * len(a | b):
                gone.add((i, text, at))
                break
    return gone


def test_line_dedup_equals_brute_force(docs):
    items = [(r[0], r[1]) for r in rows() if r[0] != 80]
    gone = removed_lines(items)
    got = lines.dedup_lines(docs.where("doc_id is null or doc_id <> 80"))
    assert got.columns == [*docs.columns, "lines_", "removed_"]
    want = Counter()
    for i, text in items:
        left = None if text is None else "\n".join(x for k, x in enumerate(text.split("\n")) if (i, text, k) not in gone)
        want[(i, left, 0 if text is None else len(text.split("\n")))] += 1
    got = got.collect()
    assert Counter((r.doc_id, r.text, r.lines_) for r in got) == want
    assert len(gone) > 20
    # columns of any name keep their values
    first = Counter((r[0], *r[12:]) for r in rows() if r[0] != 80)
    assert Counter((r.doc_id, *[r[c] for c in CLASHING]) for r in got) == first


@pytest.mark.parametrize("counters", [1 << 16, 8])
def test_line_dedup_of_many_near_lines(spark, monkeypatch, counters):
    """Thousands of pairs below and above the limit, lines of 1 to 60 words, few counters or many."""
    monkeypatch.setattr(lines, "COUNTERS", counters)
    bases = [prose(k, 2 + 5 * (k % 12)).replace("\n", " ") for k in range(24)]
    texts = [edited(bases[k % 24], k, k % 5) for k in range(240)] + [b[: len(b) // 2] for b in bases]
    items = [(k, "\n".join(texts[k::60])) for k in range(60)]
    gone = removed_lines(items)
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    assert got == {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, t, k) not in gone) for i, t in items}
    assert 40 < len(gone) < 250


@pytest.mark.parametrize("common", [1, 3, 16])
def test_lines_left_out_by_their_hashes_match_nothing(spark, monkeypatch, common):
    monkeypatch.setattr(lines, "COMMON", common)
    bases = [prose(k, 3 + 4 * (k % 10)).replace("\n", " ") for k in range(20)]
    items = [(k, edited(bases[k % 20], k, k % 4)) for k in range(120)]
    gone = removed_lines(items)
    got = {r.doc_id: r.removed for r in lines.dedup_lines(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    assert got == {i: (i, t, 0) in gone for i, t in items}
    assert 20 < len(gone) < 100


def test_only_lines_that_may_match_are_counted(spark, monkeypatch):
    counted, rarity = [], lines._rarity
    monkeypatch.setattr(lines, "_rarity", lambda rows: (counted.append(rows.count()), rarity(rows))[1])
    texts = [prose(k, 40).replace("\n", " ") for k in range(30)]
    items = list(enumerate([*texts, texts[0] + " end"]))
    got = {r.doc_id: r.removed for r in lines.dedup_lines(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    assert got == {k: k == 30 for k, _ in items}
    assert counted == [2]


def test_short_lines_that_repeat_are_removed(spark):
    items = [(1, "Share this\none two three four five\n \nshare that"), (2, "Share this\nx\n "), (3, "SHARE  this\none two three four"), (4, "x\nshare")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    assert got == {1: items[0][1], 2: "x\n ", 3: "one two three four", 4: "share"}


def test_huge_and_negative_ids_keep_their_order(spark):
    items = [(-(1 << 63), "a b c d e f\nshare this"), ((1 << 63) - 1, "a b c d e f\nz"), (None, "share this\nz\ny"), (0, "share this")]
    got = {r.doc_id: r.text for r in lines.dedup_lines(spark.createDataFrame(items, "doc_id long, text string")).collect()}
    assert got == {-(1 << 63): items[0][1], (1 << 63) - 1: "z", None: "y", 0: ""}


def test_line_dedup_drops_emptied_documents_only(docs):
    kept = lines.drop_repeated_lines(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    # 74 has the words of 73 and no others
    assert {1, 70, 71, 72, 73} <= ids and 74 not in ids


def test_line_dedup_runs_no_python(docs, capsys):
    lines.dedup_lines(docs).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_line_dedup_of_nothing(no_docs):
    assert lines.dedup_lines(no_docs).count() == 0


def test_digest_is_of_the_cleaned_text(spark, docs, tmp_path):
    docs.select("doc_id", "text", "source").write.parquet(str(tmp_path / "documents.parquet"))
    got = lines.op1_line_dedup(spark, str(tmp_path)).collect()
    want = lines.dedup_lines(docs.select("doc_id", "text", "source")).collect()
    assert Counter((r.doc_id, r.text_crc32) for r in got) == Counter((r.doc_id, zlib.crc32((r.text or "").encode())) for r in want)
