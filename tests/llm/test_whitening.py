"""Whitening against exact sums and numpy's eigenvectors."""

import math
import random
from fractions import Fraction

import numpy as np
import pytest

import __spark_entry__ as entry
from sievemark.llm import whitening


def plain(vectors):
    """x, n, S, V and deviations by exact arithmetic."""
    x = [[math.floor(64 * c) + 1_000_000 for c in v] for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    y = [[n * r[i] - s[i] for i in range(d)] for r in x]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    return np.array(x, object), n, s, v, [sum(c * c for c in r) for r in y]


def agree(rows, vectors, components, tolerance=1e-6):
    """rows: (whitened, deviation, n, explained, identity_error) in the order of ``vectors``; no tolerance: numpy's vectors are not compared."""
    x, n, s, v, deviation = plain(vectors)
    values, basis = np.linalg.eigh(v)
    values, basis = values[::-1][:components], basis[:, ::-1][:, :components]
    assert [r[1] for r in rows] == deviation and {r[2] for r in rows} == {n}
    centred = np.array([[float(Fraction(n * int(c) - t, n)) for c, t in zip(r, s, strict=True)] for r in x])
    wanted, got = centred @ basis / np.sqrt(values), np.array([r[0] for r in rows])
    sign = np.sign((wanted * got).sum(axis=0))
    if tolerance:
        assert np.allclose(got * sign, wanted, rtol=tolerance, atol=tolerance)
        assert np.allclose(rows[0][3], values / np.trace(v), rtol=tolerance)
    assert len({r[4] for r in rows}) == 1
    cov = got.T @ got / n - np.outer(got.mean(axis=0), got.mean(axis=0))
    error = abs(cov - np.eye(len(cov))).max()
    assert error <= 1e-9 and abs(rows[0][4] - error) < 1e-10


def test_factor_and_rotations():
    rng = np.random.default_rng(1)
    for rank in (1, 5, 8):
        a = rng.normal(size=(8, rank))
        v = a @ a.T
        factor = whitening.pivoted_cholesky(v)
        assert factor.shape == (8, rank) and np.allclose(factor @ factor.T, v)
        rotated = whitening.one_sided_jacobi(factor)
        assert np.allclose(sorted((rotated**2).sum(axis=0)), np.linalg.eigvalsh(v)[-rank:])
        crossed = rotated.T @ rotated
        assert abs(crossed - np.diag(crossed.diagonal())).max() < 1e-12 * crossed.max()


def test_product_sums_of_any_size():
    rng = random.Random(2)
    z = np.array([[rng.randrange(-(1 << b), 1 << b) for b in (3, 20, 40, 62)] for _ in range(50)], np.int64)
    wanted = [[sum(int(r[i]) * int(r[j]) for r in z) for j in range(4)] for i in range(4)]
    assert whitening.product_sums(z).tolist() == wanted
    for row in wanted:
        for value in row:
            assert sum(k << (whitening.DIGIT * i) for i, k in enumerate(whitening.digits(value))) == value


@pytest.mark.parametrize(("large", "tolerance"), [(1.0, 1e-9), (1e4, 1e-5), (1e7, None)])
def test_against_exact_covariance(spark, large, tolerance):
    rng = np.random.default_rng(3)
    vectors = [[float(c) for c in rng.normal(size=5) * [1, 2, 3, 4, large * 5] + 9] for _ in range(40)]
    rows = [(i, v, 1.0, 2) for i, v in enumerate(vectors)]
    odd = [(90, None, 1.0, 2), (91, [], 1.0, 2), (92, [1.0, None, 2.0, 3.0, 4.0], 1.0, 2), (93, [1.0, float("nan"), 2.0, 3.0, 4.0], 1.0, 2), (94, [float("-inf")] * 5, 1.0, 2), (95, [1.0, 2.0], 1.0, 2)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, whitened double, x int").repartition(3)
    got = {r.vec_id: (r.whitened, r.deviation, r.n, r.explained, r.identity_error) for r in whitening.whiten(df, 4).collect()}
    assert sorted(got) == list(range(40))
    if large > 1:  # the exact value may not fit a long
        wanted = plain(vectors)[4]
        assert all(r[1] == (w if w < 1 << 63 else None) for r, w in zip((got[i] for i in range(40)), wanted, strict=True))
        got = {i: (r[0], w, *r[2:]) for (i, r), w in zip(sorted(got.items()), wanted, strict=True)}
    agree([got[i] for i in range(40)], vectors, 4, tolerance)


def test_few_rows_equal_rows_and_repeated_ids(spark):
    schema = "vec_id long, embedding array<float>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    alike = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])] * 3 + [(None, [1.0, 2.0])], schema)).collect()
    assert len(alike) == 4 and all(r.whitened == [] and r.deviation == 0 and r.n == 4 and r.explained == [] for r in alike)
    line = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (1, [3.0, 4.0]), (None, [2.0, 3.0])], schema)).collect()
    assert len(line) == 3 and all(len(r.whitened) == 1 and abs(r.explained[0] - 1) < 1e-12 for r in line)
    huge = whitening.whiten(spark.createDataFrame([(i, [3e38 * (-1) ** i, float(i)]) for i in range(4)], schema)).collect()
    assert len(huge) == 4 and all(r.deviation is None and len(r.whitened) >= 1 for r in huge)  # beyond double's reach, no crash


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    vectors = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    found = {}
    for r in entry.queries()["op11_whitening"](spark, folder).collect():
        found.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(found) == sorted(vectors) and all(sorted(f) == list(range(1, 33)) for f in found.values())
    ids = sorted(vectors)
    agree(
        [([found[i][k].whitened for k in range(1, 33)], found[i][1].deviation, found[i][1].n, [found[i][k].explained for k in range(1, 33)], found[i][1].identity_error) for i in ids],
        [vectors[i] for i in ids], 32,
    )
