import math
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from tablewright.llm import whitening as W
from tablewright.llm.whitening import (
    characteristic,
    largest_roots,
    null_vectors,
    primes,
    roots_above,
    scatter,
    whitened,
)
from tests.llm.support import CLASHES

OUT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def times(poly, root):
    return [a - root * b for a, b in zip([*poly, 0], [0, *poly], strict=True)]


def with_roots(roots):
    poly = [1]
    for root in roots:
        poly = times(poly, root)
    return poly


def frame(spark, rows):
    schema = T.StructType(
        [
            T.StructField("vec_id", T.LongType()),
            T.StructField("embedding", T.ArrayType(T.FloatType())),
            *(T.StructField(c, T.StringType()) for c in (*CLASHES, "vector", "dims", "component", "whitened")),
        ]
    )
    full = [(*row, *["x" if i % 2 else None] * (len(CLASHES) + 4)) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, schema).repartition(3)


def check(found, rows, most=32):
    """Against a decomposition in double precision of the exactly summed covariance."""
    good = [(k, v) for k, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in good])
    n = len(x)
    centred = n * x - x.sum(axis=0)
    values, vectors = np.linalg.eigh(centred.T @ centred / n**3)
    values, vectors = values[::-1], vectors[:, ::-1].T
    rank = int((values > values[0] * 1e-9).sum())
    k = min(most, rank)
    assert len(found) == n * k
    assert {r.n for r in found} == {n}
    by_id = {}
    for r in found:
        by_id.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    expected = centred @ vectors[:k].T / n / np.sqrt(values[:k])
    signs = {}
    for (key, _), exact, row in zip(good, (centred.astype(object) ** 2).sum(axis=1), expected, strict=True):
        mine = by_id[key, exact]
        assert sorted(mine) == list(range(1, k + 1))
        for c, value in enumerate(row, 1):
            got = mine[c][0]
            assert abs(abs(got.whitened) - abs(value)) < 1e-8 * max(1, abs(value))
            assert got.explained == pytest.approx(values[c - 1] / values.sum(), rel=1e-9)
            if abs(value) > 1e-6:
                signs.setdefault(c, set()).add(got.whitened * value > 0)
    assert all(len(s) == 1 for s in signs.values())
    (error,) = {r.identity_error for r in found}
    assert 0 <= error < 1e-9
    w = np.array([[by_id[key, d][c][0].whitened for c in range(1, k + 1)]
                  for (key, _), d in zip(good, (centred.astype(object) ** 2).sum(axis=1), strict=True)])
    assert np.abs(w.T @ w / n - np.eye(k)).max() < 1e-9


def test_against_decomposition(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 40)) @ np.diag(np.linspace(0.3, 3, 40))
    rows = [(i, v) for i, v in enumerate(base.tolist())]
    rows += [(900, base[5].tolist())] * 90  # one vector in a quarter of all rows, one id
    rows += [(901, None), (902, []), (903, [1.0, None] + [0.0] * 38), (904, [math.nan] * 40),
             (905, [math.inf] + [0.0] * 39), (None, base[7].tolist()), (906, [3e38] + [0.0] * 39)]
    random.Random(1).shuffle(rows)
    df = whitened(frame(spark, rows))
    assert df.columns == OUT
    kinds = ["bigint", "int", "bigint", "bigint", "double", "double", "double"]
    assert [f.dataType.simpleString() for f in df.schema] == kinds
    check(df.collect(), [r for r in rows if r[0] != 906])


def test_fewer_vectors_than_entries(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate(rng.normal(size=(6, 12)).tolist())]
    check(whitened(frame(spark, rows)).collect(), rows)


def test_equal_eigenvalues_keep_the_identity(spark):
    rows = []
    for axis in range(4):
        for sign in (1.0, -1.0):
            rows.append((len(rows), [sign if i == axis else 0.0 for i in range(4)]))
    found = whitened(frame(spark, rows)).collect()
    assert len(found) == 32 and {r.explained for r in found} == {0.25}
    w = np.zeros((8, 4))
    for r in found:
        w[r.vec_id, r.component - 1] = r.whitened
        assert r.identity_error < 1e-12 and r.deviation == (8 * 64) ** 2
    assert np.abs(w.T @ w / 8 - np.eye(4)).max() < 1e-12


def test_lengths_apart_and_nothing_to_whiten(spark):
    rows = [(1, [1.0]), (2, [3.0]), (3, [1.0, 2.0]), (4, [5.0, 2.0]), (5, [7.0] * 3), (6, [7.0] * 3)]
    found = sorted(tuple(r)[:6] for r in whitened(frame(spark, rows)).collect())
    assert [(r[0], r[1], r[2], r[3], abs(r[4]), r[5]) for r in found] == [
        (1, 1, 2, 128**2, 1.0, 1.0), (2, 1, 2, 128**2, 1.0, 1.0), (3, 1, 2, 256**2, 1.0, 1.0), (4, 1, 2, 256**2, 1.0, 1.0)
    ]
    assert whitened(frame(spark, [])).count() == 0
    assert whitened(frame(spark, [(1, None), (2, [1.0, 2.0])])).count() == 0


def test_deviation_beyond_a_long(spark):
    rows = [(1, [1e15, 0.0]), (2, [-1e15, 1.0])]
    found = whitened(frame(spark, rows)).collect()
    assert {r.deviation for r in found} == {None}
    assert {round(abs(r.whitened), 12) for r in found} == {1.0}


def test_large_entries_are_summed_exactly():
    y = np.array([[2**40, -(2**41)], [2**40 + 1, 7]])
    assert scatter(y).tolist() == [[int(a) for a in row] for row in (y.astype(object).T @ y.astype(object))]


def test_polynomial_of_a_matrix(spark):
    rng = random.Random(2)
    for d in (1, 2, 5, 9):
        b = [[rng.randrange(-9, 10) * rng.randrange(2) for _ in range(d)] for _ in range(d + 2)]
        m = [[sum(r[i] * r[j] for r in b) for j in range(d)] for i in range(d)]
        found = characteristic(spark, m)
        for x in range(-3, 4):  # determinants by exact elimination
            a = [[Fraction(x * (i == j) - m[i][j]) for j in range(d)] for i in range(d)]
            det = Fraction(1)
            for k in range(d):
                p = next((i for i in range(k, d) if a[i][k]), None)
                if p is None:
                    det = Fraction(0)
                    break
                if p != k:
                    a[k], a[p], det = a[p], a[k], -det
                det *= a[k][k]
                for i in range(k + 1, d):
                    a[i] = [u - a[i][k] / a[k][k] * v for u, v in zip(a[i], a[k], strict=True)]
            value = 0
            for c in found:
                value = value * x + c
            assert value == det


def test_roots_are_counted_and_narrowed():
    roots = [0, 0, 1, 2, 2, 2, 3, 1000, 1001, 10**15, 10**15 + 1]
    poly = with_roots(roots)
    for a in (0, 1, 2, 5, 1000, 10**15):
        assert roots_above(poly, a) == sum(r > a for r in roots)
    found = largest_roots(poly, 99)
    assert [m for _, m in found] == [1, 1, 1, 1, 1, 3, 1]
    for (root, _), exact in zip(found, [10**15 + 1, 10**15, 1001, 1000, 3, 2, 1], strict=True):
        assert abs(root - exact) * 2**70 < exact
    (first, _), (second, _) = largest_roots([1, -4, 2], 2)  # 2 + sqrt(2), 2 - sqrt(2)
    assert abs((first - 2) ** 2 - 2) < Fraction(1, 2**140) and abs(first + second - 4) < Fraction(1, 2**140)


def test_null_vectors_of_close_roots():
    """Two roots a millionth of a millionth apart: double precision alone would mix them."""
    a = 10**13
    m = [[a, 1, 0], [1, a, 0], [0, 0, 1]]
    poly = times(times(with_roots([1]), a + 1), a - 1)
    for (root, _), v in zip(largest_roots(poly, 2), ([1, 1, 0], [1, -1, 0]), strict=True):
        (found,) = null_vectors(m, root, 1)
        assert np.abs(np.abs(found) - np.abs(v) / np.sqrt(2)).max() < 1e-16 * 4
        assert (found[0] * found[1] > 0) == (v[1] > 0)


def test_primes():
    found = primes(2**200)
    assert found[:3] == [2147483647, 2147483629, 2147483587]
    assert all(all(p % q for q in range(3, 47000, 2)) for p in found)
    assert not any(W._maybe_prime(2147483647 * 1 - k, 2) for k in (3, 9, 15))
