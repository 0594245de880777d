"""Exact scatter, polynomial, roots and whitening against brute force."""

import random
from fractions import Fraction

import numpy as np
import pytest

from corpusloom.llm import whitening as w
from corpusloom.llm.q_vectors import op12_whitening

SF = "/root/testdata/sf0.001"


def determinant_polynomial(values):
    """Coefficients of det(t - M), constant first, by Faddeev and LeVerrier in fractions."""
    d = len(values)
    a = [[Fraction(v) for v in row] for row in values]
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(a[i][x] * m[x][j] for x in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(sum(a[i][x] * m[x][i] for x in range(d)) for i in range(d)) / k)
    return [int(c) for c in reversed(out)]


def scatters():
    rng = random.Random(3)
    for d, rank, size in ((1, 1, 9), (2, 1, 50), (5, 5, 10**6), (6, 3, 20), (8, 8, 10**12), (4, 4, 1)):
        rows = [[rng.randrange(-size, size + 1) for _ in range(d)] for _ in range(rank + 2)]
        yield [[sum(r[i] * r[j] for r in rows[:rank]) for j in range(d)] for i in range(d)]
    yield [[7 if i == j else 0 for j in range(4)] for i in range(4)]  # one root, four times
    yield [[(3, 2, 2, 0)[i] if i == j else 0 for j in range(4)] for i in range(4)]
    yield [[10**9 + (i == j) for j in range(5)] for i in range(5)]


def test_polynomial_is_exact():
    for values in scatters():
        assert w.characteristic_polynomial(values) == determinant_polynomial(values)


def test_polynomial_over_tasks(spark):
    values = list(scatters())[4]
    assert w.characteristic_polynomial(values, spark) == determinant_polynomial(values)


def test_primes():
    found = w.primes_below(1000, 168)
    assert found[0] == 997 and found[-1] == 2 and len(set(found)) == 168
    assert all(pow(2, p - 1, p) == 1 for p in w.primes_below(1 << 31, 20))


def test_roots_are_counted_and_isolated():
    for values in scatters():
        d, trace = len(values), sum(values[i][i] for i in range(len(values)))
        polynomial = determinant_polynomial(values)
        want = np.linalg.eigvalsh(np.array(values, float))[::-1]
        got = [root for root, m in w.largest_roots(polynomial, d, trace) for _ in range(m)]
        assert len(got) == d and np.allclose([float(x) for x in got], want, atol=1e-9 * float(trace))
        assert got == sorted(got, reverse=True)
        for at in (Fraction(-1), Fraction(0), Fraction(trace, 7)):
            assert w.roots_above(polynomial, at) == sum(x > at for x in got)
    assert w.largest_roots([0, 0, 0, 1], 2, 0) == [(0, 3)]


def test_null_space_is_orthonormal():
    for values in scatters():
        trace = sum(values[i][i] for i in range(len(values)))
        found = [(root, v) for root, m in w.largest_roots(determinant_polynomial(values), len(values), trace) if root for v in w.null_space(values, root, m)]
        vectors = np.array([v for _, v in found])
        assert len(found) == np.linalg.matrix_rank(np.array(values, float))
        assert np.abs(vectors @ vectors.T - np.eye(len(found))).max() < 1e-14
        assert np.abs(np.array(values, float) @ vectors.T - vectors.T * [float(r) for r, _ in found]).max() < 1e-12 * trace


def test_sums_in_limbs_are_exact():
    rng = np.random.default_rng(1)
    for x in (rng.integers(-2**52, 2**52, (50, 3)), rng.integers(99_000, 101_000, (9000, 4)), np.zeros((0, 2), np.int64)):
        total, product = w.gram(x)
        big = x.astype(object)
        assert total == (big.sum(axis=0).tolist() if len(x) else [0, 0]) and product == (big.T @ big).tolist()


def brute(rows, k):
    """(ids, n, deviations, scaled projections up to sign, explained) by plain numpy."""
    x = np.array([np.floor(1024 * np.array(v, float)).astype(int) + 100_000 for _, v in rows], object)
    n, s = len(x), x.sum(axis=0)
    dev = ((n * x - s) ** 2).sum(axis=1)
    centred = (n * x - s).astype(float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, dev.tolist(), np.abs(centred @ vectors[:, :k] / np.sqrt(values[:k])), values[:k] / values.sum()


def check(rows, got, k):
    n, dev, projected, explained = brute(rows, k)
    assert len(got) == n * k
    by_id = {}
    for r in got:
        assert r.n == n and abs(r.explained - explained[r.component - 1]) < 1e-6 and r.identity_error < 1e-9
        by_id.setdefault(r.vec_id, {})[r.component] = (r.deviation, r.whitened)
    for i, (vec_id, _) in enumerate(rows):
        for c in range(k):
            d, x = by_id[vec_id][c + 1]
            assert d == dev[i] and abs(abs(x) - projected[i, c]) < 1e-6


def test_query_against_numpy(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(rows, op12_whitening(spark, SF).collect(), 8)


def test_offsets_and_large_entries(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(1e6, 1.0, (300, 5)) * [1, 2, 3, 4, 5])]
    check(rows, w.whitened(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)).collect(), 5)


def test_defined_cases(spark):
    schema = "n string, vec_id long, embedding array<double>, component int"
    nan, inf = float("nan"), float("inf")
    odd = [("a", 1, None, 0), ("a", 2, [1.0, None], 0), ("a", 3, [nan, 1.0], 0), ("a", 4, [inf, 1.0], 0), ("a", 5, [1.0], 0), ("a", 6, [], 0), ("a", 7, [1e300, 0.0], 0)]
    rows = [("b", None, [0.0, 1.0], 1), ("b", 8, [1.0, 2.0], 1), ("b", 8, [2.0, 3.0], 1), ("b", 9, [3.0, 4.0], 1)]
    got = w.whitened(spark.createDataFrame(odd + rows, schema)).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (8, 1), (8, 1), (8, 2), (8, 2), (9, 1), (9, 2)]
    # all on one line: the second eigenvalue is exactly 0
    assert all((r.whitened is None) == (r.component == 2) and r.explained == (2 - r.component) and r.n == 4 for r in got)
    assert {round(abs(r.whitened), 6) for r in got if r.component == 1} == {1.341641, 0.447214}
    same = w.whitened(spark.createDataFrame([(1, [5.0, 5.0])] * 3, "vec_id long, embedding array<double>")).collect()
    assert len(same) == 6 and all(r.whitened is None and r.explained == 0 and r.deviation == 0 and r.identity_error is None for r in same)
    far = [(i, [float(i % 2 * 2**41)]) for i in range(40)]
    assert all(r.deviation is None and abs(abs(r.whitened) - 1) < 1e-12 for r in w.whitened(spark.createDataFrame(far, "vec_id long, embedding array<double>")).collect())
    for empty in (odd[:1], odd[5:6], []):
        assert w.whitened(spark.createDataFrame(empty, schema)).collect() == []


@pytest.mark.parametrize("parts", [1, 9])
def test_the_split_into_tasks_does_not_matter(spark, parts):
    rows = spark.createDataFrame([(i, [float(i % 7), float(i % 5), float(i % 3)]) for i in range(210)], "vec_id long, embedding array<float>")
    vectors, d = w._whole_vectors(rows.repartition(parts), "embedding")
    x = np.floor(1024 * np.array([[i % 7, i % 5, i % 3] for i in range(210)])).astype(int) + 100_000
    assert w.scatter(vectors, d) == (210, x.sum(axis=0).tolist(), (210 * x.T @ x - np.outer(x.sum(axis=0), x.sum(axis=0))).tolist())
