"""Whitening against numpy's dense solvers."""

import math

import numpy as np
import pytest

from yieldloom.llm import whitening


def plain(vectors, k=4):
    x = [tuple(math.floor(256 * float(c)) + 0 for c in v) for v in vectors]
    fit = np.array(sorted(set(x)), dtype=np.int64)
    n, sums = len(fit), fit.sum(axis=0)
    away = (fit * n - sums) / n
    values, rows = np.linalg.eigh(away.T @ away / n)
    order = np.argsort(-values)[:k]
    x = np.array(x, dtype=np.int64)
    return n, ((x * n - sums) ** 2).sum(axis=1), ((x * n - sums) / n) @ rows[:, order] / np.sqrt(values[order]), values[order] / values.sum()


def compare(df, ids, vectors, k=4):
    rows = {(r["vec_id"], r["component"]): r for r in whitening.whitened(df, k).collect()}
    n, deviation, wanted, explained = plain(vectors, k)
    assert set(rows) == {(i, c + 1) for i in ids for c in range(wanted.shape[1])}
    for c in range(wanted.shape[1]):
        own = np.array([rows[i, c + 1]["whitened"] for i in ids])
        sign = np.sign(own @ wanted[:, c])
        assert np.allclose(sign * own, wanted[:, c], atol=1e-8)
    for at, i in enumerate(ids):
        r = rows[i, 1]
        assert r["n"] == n and r["deviation"] == deviation[at] and abs(r["explained"] / explained[0] - 1) < 1e-9 and 0 <= r["identity_error"] < 1e-9
    return rows


def test_against_eigh(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.standard_normal((600, 16)) * np.linspace(1, 0.1, 16) + 0.3).astype(np.float32).tolist()
    vectors += [vectors[0]] * 300  # a third of the rows is one vector
    df = spark.createDataFrame([(i, v, i % 3, "x") for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, x string")
    compare(df.repartition(7), list(range(len(vectors))), vectors)


def test_rows_left_out_and_ids(spark):
    rng = np.random.default_rng(4)
    good = rng.standard_normal((40, 5)).tolist()
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [1.0, math.nan, 0.0, 0.0, 0.0], [math.inf] + [0.0] * 4, [1.0, 2.0]]
    rows = [(i, v) for i, v in enumerate(good)] + [(100 + i, v) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    compare(df, list(range(40)), good)
    again = spark.createDataFrame(rows + [(None, good[0]), (3, good[3])], "vec_id long, embedding array<double>")
    assert whitening.whitened(again).count() == 42 * 4


def test_few_directions_and_empty_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whitened(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whitened(spark.createDataFrame([(1, [0.5, 0.5]), (2, [0.5, 0.5])], schema)).count() == 0
    line = [(i, [i / 256, 2 * i / 256, 0.0]) for i in range(9)]
    rows = whitening.whitened(spark.createDataFrame(line, schema)).collect()
    assert len(rows) == 9 and abs(rows[0]["explained"] - 1) < 1e-12
    one = whitening.whitened(spark.createDataFrame([(i, [float(i)]) for i in range(4)], schema)).collect()
    assert sorted(round(abs(r["whitened"]), 6) for r in one) == [0.447214, 0.447214, 1.341641, 1.341641]


def test_equal_variances(spark):
    corners = [[a, b, c, 0.1 * a] for a in (-1.0, 1.0) for b in (-1.0, 1.0) for c in (-1.0, 1.0)]
    df = spark.createDataFrame(list(enumerate(corners)), "vec_id long, embedding array<double>")
    rows = whitening.whitened(df).collect()
    assert len(rows) == 24 and max(r["identity_error"] for r in rows) < 1e-9
    share = sorted({round(r["explained"], 6) for r in rows})
    assert len(share) == 2


def test_large_numbers_stay_exact(spark):
    vectors = [[3e15, 1.0], [-3e15, 2.0], [1e15, 5.0]]
    rows = whitening.whitened(spark.createDataFrame(list(enumerate(vectors)), "vec_id long, embedding array<double>")).collect()
    assert {r["deviation"] for r in rows} == {None}
    assert whitening.deviations(np.array([[10**9]]), 2, np.array([0], dtype=object)) == [4 * 10**18]


@pytest.mark.parametrize("d", [1, 2, 5, 33, 64])
def test_solver(d):
    rng = np.random.default_rng(d)
    for a in (rng.standard_normal((d, d)), rng.standard_normal((d, d)) * np.logspace(0, -6, d), np.tri(d).T, np.eye(d)):
        values, rows = whitening.directions(a, 4)
        s, v = np.linalg.svd(a)[1:]
        assert np.allclose(np.sqrt(values), s, rtol=1e-9, atol=1e-14 * s[0])
        assert np.allclose(rows @ rows.T, np.eye(len(rows)), atol=1e-9)
        for row, value in zip(rows, values):
            assert np.linalg.norm(a.T @ (a @ row) - value * row) < 1e-11 * values[0] * d


def test_small_values_keep_their_digits():
    a, b = np.array([1.0, 1e-3, 1e-6, 1e-9]), np.array([1e-2, 1e-5, 1e-8])
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    product = Decimal(1)
    for v in whitening.squared_singular_values(a, b):
        product *= Decimal(v)
    exact = Decimal(1)
    for v in a:
        exact *= Decimal(float(v)) ** 2
    assert abs(product / exact - 1) < Decimal("1e-13")
