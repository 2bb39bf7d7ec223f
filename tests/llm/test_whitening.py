"""Eigenvectors of close eigenvalues, exact sums against whole-number loops, the query, defined results."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import queries, whitening

SF = "/root/testdata/sf0.01"
WIDE = np.longdouble


def _orthogonal(dims, seed):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(dims, dims)))[0].astype(WIDE)
    for _ in range(4):
        q = q @ (1.5 * np.eye(dims, dtype=WIDE) - 0.5 * q.T @ q)
    return q


CLOSE = [10, 10 - 1e-9, 10 - 2e-9, 10 - 3e-6, *np.linspace(5, 1, 56), 1e-3, 1e-3 - 1e-9, 1e-9, 0]


@pytest.mark.parametrize(
    "values, least", [(np.arange(64.0, 0, -1), 1e-16), (CLOSE, 1e-9), (1 + 1e-8 * np.arange(64.0)[::-1], 1e-10)]
)
def test_close_eigenvalues(values, least):
    """Better than a solver in double precision, which gives 1e-15, 1e-6 and 1e-8 here."""
    values, q = np.array(values, dtype=WIDE), _orthogonal(64, 3)
    matrix = (q * values) @ q.T
    found, vectors = whitening.eigen((matrix + matrix.T) / 2)
    assert np.abs(found - values).max() < 1e-16 * 64
    assert np.abs(vectors.T @ vectors - np.eye(64)).max() < 1e-16
    for i in range(8):
        assert min(np.abs(vectors[:, i] - q[:, i]).max(), np.abs(vectors[:, i] + q[:, i]).max()) < least


@pytest.mark.parametrize("matrix", [np.zeros((3, 3)), np.eye(5) * 4, np.ones((6, 6)), np.array([[2.5]])])
def test_equal_eigenvalues(matrix):
    found, vectors = whitening.eigen(matrix)
    assert np.abs(vectors.T @ vectors - np.eye(len(matrix))).max() < 1e-17
    assert np.abs(matrix @ vectors - vectors * found).max() < 1e-17
    assert (np.diff(found) <= 1e-17).all()


@pytest.mark.parametrize("largest", [10, 1 << 19, 1 << 28])
def test_products_are_exact(largest):
    rows = np.random.default_rng(4).integers(-largest, largest, (300, 7), endpoint=True)
    wide = rows.astype(object)
    assert (whitening.products(rows) == wide.T @ wide).all()


def _exact(rows):
    """n, S, covariance as fractions, deviations, from rows of whole numbers."""
    n, dims = len(rows), len(rows[0])
    sums = [sum(r[j] for r in rows) for j in range(dims)]
    off = [[n * x - s for x, s in zip(r, sums, strict=True)] for r in rows]
    cov = [[Fraction(sum(r[i] * r[j] for r in off), n**3) for j in range(dims)] for i in range(dims)]
    return n, sums, cov, [sum(x * x for x in r) for r in off]


def _codes(v):
    return [math.floor(1024 * c) + 100_000 for c in v]


def test_whole_query(spark):
    rows = {r.vec_id: _codes(r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    n, sums, cov, deviations = _exact(list(rows.values()))
    want = dict(zip(rows, deviations, strict=True))
    cov = np.array(cov).astype(np.float64)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:8], vectors[:, ::-1][:, :8]
    ids = list(rows)
    plain = np.array([[x - Fraction(s, n) for x, s in zip(rows[i], sums, strict=True)] for i in ids]).astype(np.float64)
    plain = plain @ vectors / np.sqrt(values)
    got = queries.op13_refined_whitening(spark, SF).collect()
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    by = {(r.vec_id, r.component): r for r in got}
    for k in range(8):
        column = np.array([by[i, k + 1].whitened for i in ids])
        assert min(np.abs(column - plain[:, k]).max(), np.abs(column + plain[:, k]).max()) < 1e-9
        assert abs(by[ids[0], k + 1].explained / (values[k] / np.trace(cov)) - 1) < 1e-10
    assert all(r.deviation == want[r.vec_id] for r in got)
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10


def test_covariance_is_exact():
    rng = np.random.default_rng(6)
    rows = rng.integers(-(1 << 20), 1 << 20, (50, 5)) + 100_000
    n, sums, cov, _ = _exact(rows.tolist())
    centre = np.array([(2 * s + n) // (2 * n) for s in sums])
    rest = np.array(sums, dtype=object) - n * centre.astype(object)
    got = whitening.covariance(n, rest, whitening.products(rows - centre))
    for i in range(5):
        for j in range(5):
            assert abs(Fraction(*got[i, j].as_integer_ratio()) / cov[i][j] - 1) < Fraction(1, 10**18)


def _write(spark, path, rows):
    fields = "vec_id long, embedding array<float>, label int, n int, whitened string"
    spark.createDataFrame([(*r, 1, 2, "x") for r in rows], fields).write.parquet(f"{path}/embeddings.parquet")
    return str(path)


def test_hard_rows(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i % 20, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(40, 12)))]
    rows += [(None, rows[3][1])] + [(50 + i, rows[4][1]) for i in range(30)]
    odd = [(200, None), (201, []), (202, [1.0] * 11), (203, [math.nan] + [1.0] * 11), (204, [None] + [1.0] * 11)]
    odd += [(205, [math.inf] * 12)]
    got = queries.op13_refined_whitening(spark, _write(spark, tmp_path / "a", rows + odd)).collect()
    assert len(got) == 8 * len(rows) and got[0].n == len(rows) and got[0].identity_error < 1e-9
    deviations = _exact([_codes(v) for _, v in rows])[3]
    assert sorted(r.deviation for r in got if r.component == 1) == sorted(deviations)
    # Two components, one of them without variance.
    flat = [(1, [1.0, 5.0]), (2, [2.0, 5.0]), (3, [4.0, 5.0])]
    got = sorted(queries.op13_refined_whitening(spark, _write(spark, tmp_path / "b", flat)).collect())
    assert [(r.vec_id, r.component) for r in got] == [(i, k) for i in (1, 2, 3) for k in (1, 2)]
    assert all((r.whitened is None, r.explained) == ((False, 1.0) if r.component == 1 else (True, 0.0)) for r in got)
    one = queries.op13_refined_whitening(spark, _write(spark, tmp_path / "c", [(1, [1.0] * 9)])).collect()
    assert [(r.whitened, r.deviation, r.explained, r.identity_error) for r in one] == [(None, 0, 0.0, 0.0)] * 8
    assert queries.op13_refined_whitening(spark, _write(spark, tmp_path / "d", [])).collect() == []
    assert queries.op13_refined_whitening(spark, _write(spark, tmp_path / "e", odd[:2])).collect() == []


def test_large_components_stay_exact(spark, tmp_path):
    """The general result has 38 digits; a long that can't hold them is null."""
    rng = np.random.default_rng(7)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(rng.normal(size=(30, 3)) * 1e5)] + [(99, [3e38] * 3)]
    path = _write(spark, tmp_path, rows)
    whole = [[max(-whitening.LARGEST, min(whitening.LARGEST, math.floor(1024 * c))) + 100_000 for c in v] for _, v in rows]
    deviations = _exact(whole)[3]
    found = whitening.whiten(spark.read.parquet(f"{path}/embeddings.parquet")).where("component = 1").collect()
    assert sorted(int(r.deviation) for r in found) == sorted(deviations)
    got = queries.op13_refined_whitening(spark, path).where("component = 1").collect()
    assert all(r.deviation is None or r.deviation in deviations for r in got)
