"""Operators 3 and 4 against brute force."""

import numpy as np
import pytest
from asofworks.llm import vectors


@pytest.fixture(scope="module")
def data():
    r = np.random.default_rng(5)
    centre = r.standard_normal((6, 24))
    x = (centre[r.integers(0, 6, 600)] + 0.6 * r.standard_normal((600, 24))).astype(np.float32)
    x[300:320] = x[7]
    x[50] = x[51]
    return x


def table(spark, x, extra=()):
    rows = [(k, [float(v) for v in row], 1, "s") for k, row in enumerate(x)] + list(extra)
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int, score string")


ODD = [(1000, None, 1, "s"), (1050, [], 1, "s"), (1100, [float("nan")] * 24, 1, "s"), (1150, [None] * 24, 1, "s"), (1200, [float("inf")] * 24, 1, "s"), (None, [1.0] * 24, 1, "s")]


def test_nearest_finds_most(spark, data):
    got = vectors.nearest(table(spark, data, [*ODD, (1250, [0.0] * 24, 1, "s")])).collect()
    x = data.astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hits = 0
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append(r)
    assert set(by) == set(range(0, 600, 50))
    for q, found in by.items():
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == [1, 2, 3, 4, 5]
        assert all(r.score == pytest.approx(u[q] @ u[r.vec_id], abs=1e-12) and r.vec_id != q for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)
        s = u @ u[q]
        s[q] = -9
        hits += len({r.vec_id for r in found} & set(np.lexsort((np.arange(600), -s.round(12)))[:5].tolist()))
    assert hits / (5 * len(by)) >= 0.9


def test_fewer_candidates_than_asked(spark):
    got = vectors.nearest(table(spark, np.eye(3, dtype=np.float32)), every=1).collect()
    assert sorted((r.query_id, r.rank, r.vec_id) for r in got) == [(0, 1, 1), (0, 2, 2), (1, 1, 0), (1, 2, 2), (2, 1, 0), (2, 2, 1)]
    assert vectors.nearest(table(spark, [])).count() == 0
    assert vectors.top_products(table(spark, [])).count() == 0


def test_long_lists_are_cut(spark, data, monkeypatch):
    want = sorted(vectors.nearest(table(spark, data), probed=1.0).collect())
    monkeypatch.setattr(vectors, "GROUP_ROWS", 16)
    monkeypatch.setattr(vectors, "GROUP_QUERIES", 2)
    got = sorted(vectors.nearest(table(spark, data), probed=1.0).collect())
    assert len(got) == len(want)
    assert sum(a == b for a, b in zip(got, want, strict=True)) >= 0.95 * len(want)


def test_top_products_are_exact(spark, data):
    zero = [(700, [0.0] * 24, 1, "s")]
    got = vectors.top_products(table(spark, data, [*ODD, *zero])).collect()
    x = np.floor(1024 * data.astype(float)).astype(np.int64)
    ids = [*range(600), 700]
    x = np.vstack([x, np.zeros((1, 24), np.int64)])
    want = []
    for q in [k for k, i in enumerate(ids) if i % 100 == 0]:
        scored = sorted((-int(x[k] @ x[q]), ids[k]) for k in range(len(ids)) if k != q)[:10]
        want += [(ids[q], n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got) == sorted(want)


def test_huge_components_and_other_lengths(spark):
    rows = [(0, [3e30, 1.0], 1, "s"), (1, [1e30, -1.0], 1, "s"), (2, [-2e30, 5.0], 1, "s"), (100, [1.0, 2.0, 3.0], 1, "s"), (101, [1.0, 0.0, 0.0], 1, "s")]
    got = vectors.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int, score string")).collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == [(0, 1, 2**63 - 1), (0, 2, -(2**63)), (100, 101, 1024 * 1024)]


def test_repeated_ids_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0], 1, "s"), (0, [1.0, 0.0], 1, "s"), (1, [0.5, 0.5], 1, "s")]
    got = vectors.top_products(spark.createDataFrame(rows, "vec_id long, embedding array<float>, row int, score string")).collect()
    assert sorted((r.rank, r.vec_id) for r in got) == [(1, 0), (1, 0), (2, 1), (2, 1)]
