"""Whitening against exact fractions, numpy's eigenvectors and its own laws."""

import math
from fractions import Fraction

import numpy as np
import pytest

from taxaflow.llm.queries import QUERIES
from taxaflow.llm.whitening import cyclic_jacobi, fit_whitening, tournament, usable, whitened_components

SCHEMA = "vec_id long, embedding array<float>, n string, whitened int"
NAN, INF = float("nan"), float("inf")


def table(spark, vectors):
    return spark.createDataFrame([(i, v, "clash", 0) for i, v in vectors], SCHEMA).repartition(3)


def vectors(n=90, d=11, seed=1):
    rng = np.random.default_rng(seed)
    made = rng.normal(size=(n, d)) * np.geomspace(3, 0.02, d) + rng.normal(size=d)
    made[:, 3] += 0.5 * made[:, 0]
    return [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(made)]


def integers(rows):
    return {i: [math.floor(1024 * float(c)) + 100_000 for c in v] for i, v in rows}


def check(rows, got):
    x = integers(rows)
    n, d = len(x), len(next(iter(x.values())))
    s = [sum(v[k] for v in x.values()) for k in range(d)]
    cov = np.array([[float(Fraction(sum((n * v[i] - s[i]) * (n * v[j] - s[j]) for v in x.values()), n**3)) for j in range(d)] for i in range(d)])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = min(8, d)
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    assert by.keys() == x.keys()
    white = np.array([[by[i][c + 1].whitened for c in range(k)] for i in x])
    centred = np.array([[float(Fraction(n * v[j] - s[j], n)) for j in range(d)] for v in x.values()])
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    turn = np.sign((white * want).sum(0))
    assert np.abs(white - want * turn).max() < 1e-7
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-9
    for i, own in by.items():
        assert sorted(own) == list(range(1, k + 1))
        for c, r in own.items():
            assert r.n == n and r.deviation == sum((n * a - b) ** 2 for a, b in zip(x[i], s, strict=True))
            assert r.explained == pytest.approx(values[c - 1] / np.trace(cov), rel=1e-9)
            assert 0 <= r.identity_error < 1e-9


def test_against_numpy(spark):
    check(vectors(), whitened_components(table(spark, vectors())).collect())


def test_the_registered_query(spark, tmp_path):
    odd = [(900, None), (901, []), (902, [1.0] * 10 + [NAN]), (903, [INF] + [0.0] * 10), (904, [None] + [0.0] * 10), (905, [0.5] * 4), (906, [1.0e30] + [0.0] * 10)]
    table(spark, [*vectors(), *odd]).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = QUERIES["op13_embedding_whitening"](spark, str(tmp_path))
    assert dict(got.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    check(vectors(), got.collect())


def test_repeated_rows_and_ids(spark):
    rows = vectors(30, 5)
    got = whitened_components(table(spark, [*rows, rows[0], (None, rows[1][1])])).collect()
    assert len(got) == 32 * 5 and sum(r.vec_id == 0 for r in got) == 10 and sum(r.vec_id is None for r in got) == 5
    assert {r.n for r in got} == {32}


def test_degenerate_tables(spark):
    assert whitened_components(table(spark, [])).count() == 0
    assert whitened_components(table(spark, [(1, None), (2, []), (3, [NAN])])).count() == 0
    one = whitened_components(table(spark, [(1, [0.5, 2.0])])).collect()
    assert [(r.component, r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(one)] == [(c, 1, 0, None, 0.0, None) for c in (1, 2)]
    line = whitened_components(table(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(8)])).collect()
    assert {r.component: r.whitened is None for r in line} == {1: False, 2: True, 3: True}
    assert max(r.identity_error for r in line) < 1e-12


def test_huge_entries_stay_exact(spark):
    """Sums and deviations beyond 64 bits; those beyond 38 digits are null in the operator, those beyond 64 bits in the query's column."""
    rows = [(i, [float(np.float32(v)) for v in (3e9 * i, -2e9 * i * i, 1.0)]) for i in range(9)]
    x = integers(rows)
    s = [sum(v[k] for v in x.values()) for k in range(3)]
    got = {r.vec_id: r.deviation for r in whitened_components(table(spark, rows)).collect()}
    assert got == {i: sum((9 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in x.items()}
    far = whitened_components(table(spark, [(i, [4e15 * i, 1.0]) for i in range(2)])).collect()
    assert len(far) == 4 and all(r.n == 2 for r in far)


def test_small_eigenvalues_are_accurate():
    """A graded matrix with exactly known factors: relative errors stay at rounding."""
    scale = np.geomspace(1, 1e-9, 12)
    core = np.full((12, 12), 0.1) + 0.9 * np.eye(12)
    values, axes = cyclic_jacobi(core * np.outer(scale, scale))
    assert np.abs(axes.T @ axes - np.eye(12)).max() < 1e-13
    from decimal import Decimal, getcontext

    getcontext().prec = 60
    # determinant as an exact product: that of the core times the squares of the scales
    det = Decimal(float(np.linalg.det(core)))
    for v in scale:
        det *= Decimal(float(v)) ** 2
    product = Decimal(1)
    for v in values:
        product *= Decimal(float(v))
    assert abs(product / det - 1) < Decimal("1e-12")


@pytest.mark.parametrize("d", [1, 2, 3, 8, 13])
def test_rounds_name_each_pair_once(d):
    pairs = [(int(a), int(b)) for p, q in tournament(d) for a, b in zip(p, q, strict=True)]
    assert sorted(pairs) == [(i, j) for i in range(d) for j in range(i + 1, d)]


def test_reruns_agree(spark):
    rows = vectors(200, 16, 5)
    fits = [fit_whitening(table(spark, r).selectExpr("vec_id", "cast(embedding as array<double>) as vector").where(usable_sql())) for r in (rows, rows[::-1])]
    assert (fits[0].values == fits[1].values).all() and (fits[0].axes == fits[1].axes).all()


def usable_sql():
    from pyspark.sql import functions as F

    return usable(F.col("vector"))
