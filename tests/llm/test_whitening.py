"""Whitening against numpy's dense solvers."""

import os

import numpy as np
import pytest

from sitewell.llm import whitening

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "vec_id long, embedding array<float>, key string, v string, whitened string"


def bidiagonals():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 8, 64, 150):
        yield rng.normal(size=n), rng.normal(size=max(0, n - 1))
    yield 10.0 ** -np.arange(20), 10.0 ** -np.arange(1, 20)  # graded
    yield 10.0 ** np.arange(-15, 5), 10.0 ** np.arange(-15, 4)
    yield np.array([1.0, 0, 2, 0, 0, 3]), np.ones(5)  # without full rank
    yield np.zeros(4), np.zeros(3)
    yield np.ones(30), np.full(29, 1e-9)  # nearly equal values
    yield np.ones(10), np.zeros(9)


@pytest.mark.parametrize("k", range(12))
def test_values_of_bidiagonals(k):
    a, b = list(bidiagonals())[k]
    want = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
    got = np.sqrt(whitening.squared_values(a, b))
    assert np.allclose(got, want, rtol=1e-13, atol=1e-14 * max(want.max(), 1e-300) * (1 if want.min() > 0 else 100))


def test_small_values_keep_their_digits():
    a, b = np.array([1.0, 1e-8, 1e-16, 1e-24]), np.array([1e-3, 1e-11, 1e-19])
    got = np.sqrt(whitening.squared_values(a, b))
    assert got[-1] < 1e-23 and np.prod(got) == pytest.approx(np.prod(a), rel=1e-13, abs=0)  # the determinant


@pytest.mark.parametrize("seed,n", [(0, 1), (1, 2), (2, 5), (3, 64), (4, 200)])
def test_directions_of_triangles(seed, n):
    rng = np.random.default_rng(seed)
    r = np.triu(rng.normal(size=(n, n)) * 2.0 ** -np.arange(n).clip(max=30))
    a, b, _ = whitening.bidiagonal(r)
    assert np.allclose(np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False), np.linalg.svd(r, compute_uv=False))
    values, found = whitening.directions(r, 4)
    _, s, vt = np.linalg.svd(r)
    assert np.allclose(values, s[:4] ** 2, rtol=1e-12)
    assert np.allclose(np.abs(np.sum(found * vt[:4].T, axis=0)), 1, atol=1e-12)
    assert np.allclose(found.T @ found, np.eye(found.shape[1]), atol=1e-13)


def test_equal_values_span_their_space():
    rng = np.random.default_rng(5)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    r = np.triu(np.linalg.qr(np.diag([5.0, 5, 5, 2] + [1] * 8) @ q)[1])
    values, found = whitening.directions(r, 4)
    assert np.allclose(values, [25, 25, 25, 4]) and np.allclose(found.T @ found, np.eye(4), atol=1e-12)
    assert np.allclose(r.T @ (r @ found), found * values, atol=1e-10)


def brute(rows, k=4):
    """By (vec_id, component): n, deviation, |whitened|, explained."""
    kept = [(i, v) for i, v in rows if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    width = max((len(v) for _, v in kept), default=0)
    x = [[int(np.floor(256 * float(np.float32(c)))) for c in v] + [0] * (width - len(v)) for _, v in kept]
    different = sorted(set(map(tuple, x)))
    n, sums = len(different), [sum(c) for c in zip(*different)]
    centred = np.array(different, dtype=float) - np.array(sums, dtype=float) / n
    e, v = np.linalg.eigh(centred.T @ centred / n)
    e, v = e[::-1], v[:, ::-1]
    return [(i, c + 1, n, sum((n * a - s) ** 2 for a, s in zip(r, sums)),
             abs(float((np.array(r) - np.array(sums) / n) @ v[:, c] / np.sqrt(e[c]))), e[c] / e.sum())
            for (i, _), r in zip(kept, x) for c in range(min(k, width)) if e[c] > 1e-20 * e[0]]


def compare(df, rows):
    key = lambda r: (str(r[0]), r[3], r[1])
    got, want = sorted(whitening.query(df).collect(), key=key), sorted(brute(rows), key=key)
    assert [tuple(r)[:4] for r in got] == [w[:4] for w in want]
    assert np.allclose([abs(r["whitened"]) for r in got], [w[4] for w in want], rtol=1e-8, atol=1e-9)
    assert np.allclose([r["explained"] for r in got], [w[5] for w in want], rtol=1e-10)
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


@pytest.mark.parametrize("fan", [2, 16])
def test_on_the_table(spark, monkeypatch, fan):
    monkeypatch.setattr(whitening, "FAN", fan)
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet").repartition(7)
    compare(table, [(r["vec_id"], r["embedding"]) for r in table.collect()])


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(30)] + [(None, [1.0] * 6), (7, [1.0, 2.0]), (7, []), (108, None)]
    rows += [(109, [1.0, None, 2.0]), (110, [float("nan")] * 6), (111, [float("inf")] + [0.0] * 5)] + [(50, [0.5] * 6)] * 40
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA).repartition(5)
    compare(df, rows)
    assert {r["vec_id"] for r in whitening.query(df).collect()}.isdisjoint({108, 109, 110, 111})


def test_without_variance(spark):
    for rows in ([], [(1, None)], [(1, [])], [(1, [1.0, 2.0])] * 3):
        assert whitening.query(spark.createDataFrame([(*r, "a", "b", "c") for r in rows], SCHEMA)).count() == 0
    line = [(i, [float(i), 2.0 * i, 0.0]) for i in range(9)]  # one direction only
    df = spark.createDataFrame([(*r, "a", "b", "c") for r in line], SCHEMA)
    assert {r["component"] for r in whitening.query(df).collect()} == {1}


def test_numbers_beyond_a_long():
    x = np.array([[1 << 40, 3], [-(1 << 40), 5]], dtype=np.int64)
    sums = [int(c) for c in x.sum(axis=0)]
    exact = [sum((2 * int(a) - s) ** 2 for a, s in zip(row, sums)) for row in x]
    assert whitening.deviations(x, 2, sums) == [min(d, whitening.MOST) for d in exact]
    assert whitening.centred(x, 2, sums)[0].tolist() == [float(1 << 40), -1.0]
