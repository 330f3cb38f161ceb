"""Whitening against plain double and whole-number arithmetic; refinement on clustered eigenvalues."""

import math

import numpy as np
import pytest

from faregate.llm import whitening
from faregate.llm.common import table
from faregate.llm.queries import QUERIES
from tests.conftest import SF


def plain(vectors):
    """Whole numbers, n, S and covariance in extended precision."""
    x = [tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v) for v in vectors]
    fit = sorted(set(x))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) for c, s in zip(v, sums)] for v in fit], dtype=np.longdouble) / n
    return x, n, sums, centred.T @ centred / n


def good(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def check(got, vectors, most=16):
    """``got`` rows against ``vectors`` by id."""
    x, n, sums, cov = plain([v for _, v in vectors])
    values, axes = np.linalg.eigh(cov.astype(np.float64))
    values, axes = values[::-1], axes[:, ::-1]
    kept = min(most, int((values > 1e-12 * values.sum()).sum()))
    assert len(got) == len(vectors) * kept
    by = {}
    for r in got:
        by.setdefault(r["id"], {})[r["component"]] = r
    trace = float(np.trace(cov))
    signs = {}
    for (i, _), own in zip(vectors, x):
        assert sorted(by[i]) == list(range(1, kept + 1))
        for k, r in by[i].items():
            assert r["n"] == n and r["deviation"] == sum((n * c - s) ** 2 for c, s in zip(own, sums))
            assert abs(r["explained"] * trace - values[k - 1]) <= 1e-6 * max(values[k - 1], 1e-9)
            assert r["identity_error"] < 1e-9
            gap = min(abs(values[k - 1] - v) for j, v in enumerate(values) if j != k - 1) if len(values) > 1 else 1
            if gap > 1e-3 * values[0]:
                centre = np.array([(n * c - s) / n for c, s in zip(own, sums)])
                want = float(centre @ axes[:, k - 1] / math.sqrt(values[k - 1]))
                sign = signs.setdefault(k, 1 if abs(want - r["whitened"]) < abs(want + r["whitened"]) else -1)
                assert abs(sign * want - r["whitened"]) < 1e-7


def frame(spark, rows, extra=True):
    if not extra:
        return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    return spark.createDataFrame([(*r, "a", 1) for r in rows], "vec_id bigint, embedding array<float>, x string, id int")


def test_awkward_rows(spark):
    draw = np.random.default_rng(3)
    rows = [(i, [float(v) for v in draw.normal(size=6) * [4, 3, 2, 1, 0.5, 0.2]]) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]
    bad = [(2000, None), (2001, []), (2002, [1.0, None] * 3), (2003, [float("nan")] * 6), (2004, [float("inf")] + [0.0] * 5), (2005, [2.0**60] + [0.0] * 5)]
    got = whitening.whiten(frame(spark, rows + bad)).collect()
    vectors = [(i, v) for i, v in rows + bad if good(v) and max(map(abs, v)) < 2**45]
    check(got, vectors)


def test_given_table(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect()]
    renamed = QUERIES["op12_embedding_whitening"](spark, SF).withColumnRenamed("vec_id", "id").collect()
    check(renamed, [(i, v) for i, v in rows if good(v)])


def test_whitened_is_white(spark):
    got = QUERIES["op12_embedding_whitening"](spark, SF).collect()
    vectors = {r["vec_id"]: tuple(math.floor(64 * c) for c in r["embedding"]) for r in table(spark, SF, "embeddings").collect() if good(r["embedding"])}
    first = {v: i for i, v in sorted(vectors.items(), reverse=True)}
    rows = {i: np.zeros(16) for i in first.values()}
    for r in got:
        if r["vec_id"] in rows:
            rows[r["vec_id"]][r["component"] - 1] = r["whitened"]
    matrix = np.array(list(rows.values()))
    matrix = matrix - matrix.mean(axis=0)
    error = np.abs(matrix.T @ matrix / len(matrix) - np.eye(16)).max()
    assert error < 1e-9 and abs(error - got[0]["identity_error"]) < 1e-9


def test_few_or_equal_vectors(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    got = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 2.0])], extra=False)).collect()
    assert sorted(round(abs(r["whitened"]), 12) for r in got) == [1, 1, 1] and {r["explained"] for r in got} == {1.0}


def test_lengths_have_to_agree(spark):
    with pytest.raises(ValueError, match="2 to 3"):
        whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0])]))


def test_deviation_beyond_a_long():
    x = np.array([[1_000_000 + 10**9], [1_000_000]])
    assert whitening._deviations(x, 10, [20 * 10**6 + 10**10]).to_pylist() == [
        v if (v := (10 * int(c) - (20 * 10**6 + 10**10)) ** 2) < 1 << 63 else None for c in x[:, 0]
    ]
    assert whitening._deviations(np.array([[10**12]]), 10**6, [0]).to_pylist() == [None]


SPECTRA = {
    "apart": np.geomspace(1, 1e4, 24),
    "equal": np.r_[np.full(10, 3.0), np.full(8, 1.0), 7.0],
    "close": np.r_[5 + np.arange(8) * 1e-9, 2 + np.arange(6) * 1e-6, 1 + np.arange(4) * 1e-13],
    "singular": np.r_[np.zeros(5), 1e-9, 1, 1, 4],
    "nested": np.r_[1, 1 + 1e-7, 1 + 1e-7 + 1e-12, 1 + 2e-4, 30, 30 + 1e-8],
}


@pytest.mark.parametrize("name", sorted(SPECTRA))
def test_refinement(name):
    spectrum = SPECTRA[name].astype(np.longdouble)
    q = np.linalg.qr(np.random.default_rng(7).normal(size=(len(spectrum),) * 2))[0].astype(np.longdouble)
    for _ in range(3):  # orthogonal to extended precision
        q = q @ (1.5 * np.eye(len(q), dtype=np.longdouble) - 0.5 * q.T @ q)
    a = (q * spectrum) @ q.T
    a = (a + a.T) / 2
    values, x = whitening.refine(a)
    wide = x.astype(np.longdouble)
    top = float(spectrum.max())
    assert np.abs(wide.T @ wide - np.eye(len(x))).max() < 1e-15
    assert np.abs(a @ wide - wide * values).max() < 2e-15 * top
    assert np.abs(values - np.sort(spectrum)[::-1]).max() < 1e-15 * top * 2


def test_refinement_beats_its_start():
    q = np.linalg.qr(np.random.default_rng(9).normal(size=(30, 30)))[0]
    a = q * np.arange(1.0, 31) @ q.T
    a = (a + a.T) / 2
    start = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    values, x = whitening.refine(a)
    off = lambda v: np.abs(v.T @ a @ v - np.diag(np.diag(v.T @ a @ v))).max()
    assert off(x.astype(np.longdouble)) < 1e-13 < 1e-7 < off(start)
    vectors = np.linalg.eigh(a)[1][:, ::-1]
    assert np.abs(np.abs((vectors * x).sum(axis=0)) - 1).max() < 1e-14


def test_zero_and_empty_matrix():
    values, x = whitening.refine(np.zeros((3, 3)))
    assert not values.any() and (x == np.eye(3)).all()
