"""Operator 12 against the tokenizers library."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
from asofworks.llm import word_bpe
from asofworks.llm.units import UnitCache
from hypothesis import example, given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.conftest import prose, rows

LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
OWN = word_bpe.tokenizer(word_bpe.TOKENIZER)


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def letters(seed, n, of="abcdefghijklmnopqrstuvwxyzé"):
    r = random.Random(seed)
    return "".join(r.choice(of) for _ in range(n))


ODD = [
    "Don't STOP, it's 'tis '’s x's' 12.5% a1b2 İstanbul ΑΣ'Α ΑΣ. é ñ ≠ ≮ a b c　d \x0b\x0c\x1c\x85 ​­x",
    "<|endoftext|> a<|startoftext|>b <|endoftext|><|endoftext|> <|ENDOFTEXT|> <|endof text|> <|endoftext|",
    "日本語の長い文章です。" * 60 + " 中文字符" * 40,
    letters(1, 3000), letters(2, 700, "aab"), "w" * 5000, "!?*" * 900, "7" * 700, "😀" * 300, "é" * 999 + "'s",
    letters(3, 400) + "'ve" + letters(4, 600) + "<|endoftext|>" + letters(5, 500),
]


@pytest.mark.parametrize("k", range(len(ODD)))
def test_odd_texts(k):
    import pyarrow as pa

    (flat, counts), *more = OWN.texts(pa.array([ODD[k], ODD[k] + " x"]))
    assert not more and flat.tolist() == library(ODD[k]) + library(ODD[k] + " x") and counts.tolist() == [len(library(ODD[k])), len(library(ODD[k] + " x"))]


@given(st.text(alphabet=st.one_of(st.sampled_from("abth eing'snt.,-—<|> \n éÉ日9"), st.characters(codec="utf-8")), max_size=80), st.integers(2, 9))
@example("<|startoftext|>'s", 2)
@settings(max_examples=400, deadline=None)
def test_any_text_with_small_leaves(text, leaf):
    before, word_bpe.LEAF = word_bpe.LEAF, leaf
    try:
        flat, counts = OWN.encoded([w.encode() for w in text.split() if w and not any(t in w for t in OWN.added)])
        assert flat.tolist() == [i for w in text.split() if not any(t in w for t in OWN.added) for i in library(w)]
    finally:
        word_bpe.LEAF = before
    import pyarrow as pa

    (flat, counts), *_ = OWN.texts(pa.array([text]))
    assert flat.tolist() == library(text) and counts.tolist() == [len(flat)]


@given(st.text(alphabet="abctheingxyz", min_size=1, max_size=400), st.integers(0, 10**6))
@settings(max_examples=200, deadline=None)
def test_any_two_halves_join(word, seed):
    at = random.Random(seed).randrange(len(word) + 1)
    left = OWN._leaf(word[:at], False) if at else []
    right = OWN._leaf(word[at:], True) if at < len(word) else []
    if right:
        assert OWN.joined(left, right, True) == library(word)


def test_windows_grow_until_both_sides_agree(monkeypatch):
    """A run of one letter has no early agreement: the window grows as far as it must."""
    monkeypatch.setattr(word_bpe, "WINDOW", 1)
    for word in ("a" * 999, "ab" * 400 + "a", letters(8, 2000, "ab")):
        monkeypatch.setattr(word_bpe, "LEAF", 7)
        assert OWN.word(word) == library(word)


def digests(found):
    return Counter((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found)


def wanted(items):
    out = Counter()
    for doc_id, text in items:
        ids = library(text)
        sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
        out[doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))] += 1
    return out


@pytest.mark.parametrize("limits", [{}, {"LONG": 2000, "PART": 100, "LEAF": 16}, {"LONG": 0, "PART": 1 << 14}])
def test_query_equals_the_library(spark, docs, tmp_path, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(word_bpe, name, value)
    items = [(r[0], r[1]) for r in rows()] + [(1000 + k, t) for k, t in enumerate(ODD)] + [(2000, " \n" * 40000), (2001, prose(5, 20000)), (2002, prose(5, 20000)), (2003, letters(9, 90000) + " x " + letters(10, 70000))]
    spark.createDataFrame(items, "doc_id long, text string").repartition(5).write.parquet(str(tmp_path / "documents.parquet"))
    got = word_bpe.op12_tree_bpe(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    assert digests(got.collect()) == wanted(items)


def test_cases(spark, docs, no_docs):
    found = word_bpe.decode(word_bpe.encode(docs))
    assert found.columns == ["doc_id", "ids", "decoded"] and found.count() == docs.count()
    assert word_bpe.decode(word_bpe.encode(no_docs)).count() == 0
    data = spark.createDataFrame([(1, None), (2, []), (3, [320, 99999, -1, 320]), (4, [49407])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in word_bpe.decode(data).collect()} == {1: None, 2: "", 3: "a</w> a</w>", 4: "<|endoftext|>"}


def test_cache_is_limited_in_bytes():
    """Texts with white space that the cut doesn't know are units of their own; what they hold is given up."""
    import numpy as np

    units = UnitCache(limit=1 << 20)
    for k in range(60):
        keys = np.arange(k * 20, k * 20 + 20, dtype=np.uint64)
        start, length = units.slots(keys, lambda some: (np.zeros(2000 * len(some), np.int32), np.full(len(some), 2000, np.int64)))
        assert (length == 2000).all() and start.min() > 0
        assert units.size() < (1 << 20) + 2 * 4 * 20 * 2000
