"""Operator 11 against numpy."""

import math

import numpy as np
import pytest
from asofworks.llm import whitening


def brute(vectors, components=8):
    x = np.floor(1024 * np.array(vectors, float)).astype(int) + 100000
    n, sums = len(x), x.sum(0)
    y = x - sums / n
    values, columns = np.linalg.eigh(y.T @ y / n)
    values, columns = values[::-1][:components], columns[:, ::-1][:, :components]
    deviation = [sum(int(v) ** 2 for v in n * row - sums) for row in x]
    return n, deviation, y @ columns / np.sqrt(values), values / np.trace(y.T @ y / n)


def vectors(seed, n, dim=12):
    r = np.random.default_rng(seed)
    return (r.normal(size=(n, dim)) @ r.normal(size=(dim, dim)) / 5).astype(np.float32)


def check(found, ids, vecs):
    n, deviation, z, explained = brute(vecs)
    k = z.shape[1]
    assert len(found) == len(ids) * k
    got = {(r.vec_id, r.component): r for r in found}
    for c in range(k):
        signs = {np.sign(got[i, c + 1].whitened * z[row, c]) for row, i in enumerate(ids) if abs(z[row, c]) > 1e-6}
        assert len(signs) == 1
        for row, i in enumerate(ids):
            r = got[i, c + 1]
            assert (r.n, r.deviation) == (n, deviation[row])
            assert r.whitened * signs.copy().pop() == pytest.approx(z[row, c], rel=1e-8, abs=1e-8)
            assert r.explained == pytest.approx(explained[c], rel=1e-9) and 0 <= r.identity_error < 1e-9


@pytest.mark.parametrize("limits", [{}, {"BLOCK_ROWS": 16, "BLOCKS_AT_ONCE": 2}, {"BLOCK_ROWS": 8, "BAND_ROWS": 50}, {"BLOCK_COLUMNS": 5, "BAND_ROWS": 17}])
def test_equals_numpy(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(whitening, name, value)
    vecs = vectors(1, 230)
    data = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vecs)], "vec_id long, embedding array<float>").repartition(3)
    check(whitening.whitened(data).collect(), range(230), vecs)


def test_unusable_rows_and_clashing_names(spark):
    vecs = vectors(2, 40, 9)
    bad = [(100, None), (101, []), (102, [*[0.5] * 8, None]), (103, [math.nan] * 9), (104, [*[0.1] * 8, math.inf]), (105, [1e30] * 9)]
    items = [(k, v.tolist()) for k, v in enumerate(vecs)] + bad
    data = spark.createDataFrame([(i, v, 1, 2, 3, "x", [1.0]) for i, v in items], "vec_id long, embedding array<double>, x long, n long, part long, index string, z array<double>")
    check(whitening.whitened(data).collect(), range(40), vecs)


def test_fewer_dimensions_repeated_rows_and_null_ids(spark):
    vecs = np.repeat(vectors(3, 30, 3), 2, axis=0)
    data = spark.createDataFrame([(None if k == 0 else k // 2, v.tolist()) for k, v in enumerate(vecs)], "vec_id long, embedding array<float>")
    found = whitening.whitened(data).collect()
    assert len(found) == 60 * 3 and sum(r.vec_id is None for r in found) == 3 and {r.n for r in found} == {60}
    assert max(r.identity_error for r in found) < 1e-9


def test_components_without_variance(spark):
    flat = vectors(4, 50, 4)
    flat[:, 2:] = 0.25
    found = whitening.whitened(spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(flat)], "vec_id long, embedding array<float>")).collect()
    assert {(r.component, r.whitened is None) for r in found} == {(1, False), (2, False), (3, True), (4, True)}
    assert max(r.identity_error for r in found) < 1e-9
    one = whitening.whitened(spark.createDataFrame([(7, [0.5, 0.25])], "vec_id long, embedding array<float>")).collect()
    assert [tuple(r) for r in one] == [(7, k, 1, 0, None, None, None) for k in (1, 2)]


def test_nothing_and_unlike_lengths(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whitened(none).count() == 0 and whitening.whitened(none).columns == [c.split(" ")[0] for c in whitening.WHITENED.split(", ")]
    with pytest.raises(ValueError, match="2 and of 3"):
        whitening.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])], "vec_id long, embedding array<float>"))
