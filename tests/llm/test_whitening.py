"""Whitening against eigenvectors of the whole covariance, and rows of little or no variance."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadastra.llm import whitening
from cadastra.llm.common import cut
from cadastra.llm.whitening import finite_vectors, fit_whitening, fixed_point, identity_error, op13_whitening, solve_rows, whiten


def written(spark, x, **extra):
    rows = [(k, [int(v) for v in r], *(v[k] for v in extra.values())) for k, r in enumerate(x)]
    return cut(spark.createDataFrame(rows, "id long, x array<long>" + "".join(f", {c} string" for c in extra)).repartition(3), "test-vectors")


def brute(x):
    """Exact sums, then the eigenvectors of the covariance."""
    n, total = len(x), [sum(int(v) for v in c) for c in x.T]
    centred = np.array([[(n * int(v) - s) / n for v, s in zip(r, total, strict=True)] for r in x])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    deviations = [sum((n * int(v) - s) ** 2 for v, s in zip(r, total, strict=True)) for r in x]
    return centred, values[::-1], vectors[:, ::-1].T, deviations


def agree(spark, x, k, tolerance=1e-9):
    rows = written(spark, x)
    model = fit_whitening(rows)
    centred, values, vectors, deviations = brute(x)
    assert len(model.components) == k and model.n == len(x)
    assert np.allclose(model.variances, values[:k], rtol=1e-9) and math.isclose(model.total, values.sum(), rel_tol=1e-12)
    got = {r["id"]: r for r in whiten(rows, model).collect()}
    assert [got[i]["deviation"] for i in range(len(x))] == deviations
    w = np.array([got[i]["whitened"] for i in range(len(x))])
    for c in range(k):
        want = centred @ vectors[c] / math.sqrt(values[c])
        assert min(abs(w[:, c] - want).max(), abs(w[:, c] + want).max()) < tolerance
    assert identity_error(rows, model) < 1e-10
    return model


def test_triangular_solves():
    rng = np.random.default_rng(0)
    r = np.triu(rng.normal(size=(7, 7))) + 3 * np.eye(7)
    x = rng.normal(size=(20, 7))
    assert np.allclose(solve_rows(x, r) @ r, x)


def test_random_rows(spark):
    rng = np.random.default_rng(1)
    agree(spark, rng.integers(-500, 500, (300, 12)) * np.arange(1, 13) + 100_000, 8)


def test_badly_scaled_rows_keep_their_small_components(spark):
    rng = np.random.default_rng(2)
    scales = np.array([10**6, 10**4, 100, 2])
    agree(spark, (rng.normal(size=(400, 4)) * scales).round().astype(np.int64) + 7, 4, tolerance=1e-6)


def test_directions_without_variance_are_no_components(spark):
    rng = np.random.default_rng(3)
    x = rng.integers(-90, 90, (120, 3)) * np.array([1, 5, 9])
    agree(spark, np.column_stack([x, np.full(120, 100_000), x[:, 0] + x[:, 1]]), 3)


def test_fewer_rows_than_dimensions(spark):
    agree(spark, np.random.default_rng(4).integers(-900, 900, (5, 20)), 4)


def test_one_row_equal_rows_and_none(spark):
    for x in (np.array([[3, 4]]), np.full((9, 3), 5), np.zeros((0, 2), int), np.zeros((4, 0), int)):
        rows = written(spark, x)
        model = fit_whitening(rows)
        assert len(model.components) == 0 and identity_error(rows, model) == 0.0
        assert [(r["deviation"], r["whitened"]) for r in whiten(rows, model).collect()] == [(0, [])] * len(x)


def test_short_vectors_are_filled_up(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-50, 50, (80, 4))
    x[::3, 3] = 0
    short = cut(spark.createDataFrame([(k, [int(v) for v in (r[:3] if k % 3 == 0 else r)]) for k, r in enumerate(x)], "id long, x array<long>"), "test-short")
    a, b = fit_whitening(short), fit_whitening(written(spark, x))
    assert np.allclose(a.components, b.components) and np.allclose(a.variances, b.variances)


def test_repeated_rows_count_and_other_columns_stay(spark):
    x = np.random.default_rng(6).integers(-50, 50, (40, 3))
    rows = written(spark, np.vstack([x, x]), whitened=["mine"] * 80, n=["kept"] * 80)
    model = fit_whitening(rows)
    out = whiten(rows, model)
    assert model.n == 80 and dict(out.dtypes)["whitened"] == "array<double>" and {r["n"] for r in out.collect()} == {"kept"}


def test_deviations_beyond_a_machine_word(spark):
    model = whitening.Whitening(10**6, np.zeros(2, np.int64), np.zeros(2, np.int64), np.zeros((0, 2)), np.zeros(0), 0.0)
    assert model.deviations(np.array([[2000, 1]])).tolist() == [4 * 10**18 + 10**12]
    with pytest.raises(OverflowError):
        model.deviations(np.array([[10**4, 1]]))


def test_entries_too_large_for_exact_sums(spark):
    with pytest.raises(ValueError, match="too large"):
        fit_whitening(written(spark, np.array([[1 << 41, 0], [0, 1]])))


def test_query(spark, tmp_path):
    rng = np.random.default_rng(7)
    good = [[float(v) for v in r] for r in rng.normal(size=(60, 10))]
    odd = [None, [None, *good[0][1:]], [float("nan"), *good[0][1:]], [*good[0][:9], float("inf")], [float("-inf"), *good[0][1:]]]
    rows = [(None if k == 3 else k % 50, v, None) for k, v in enumerate([*good, *odd])]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    out = op13_whitening(spark, str(tmp_path))
    assert [(c, t) for c, t in out.dtypes] == [("vec_id", "bigint"), ("component", "int"), ("n", "bigint"), ("deviation", "bigint"), ("whitened", "double"), ("explained", "double"), ("identity_error", "double")]
    got = out.collect()
    x = np.floor(1024 * np.array(good, np.float32).astype(float)).astype(np.int64) + 100_000
    _, values, _, deviations = brute(x)
    assert len(got) == 60 * 8 and {r["n"] for r in got} == {60} and all(r["identity_error"] < 1e-10 for r in got)
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviations)
    assert all(math.isclose(r["explained"], values[r["component"] - 1] / values.sum(), rel_tol=1e-9) for r in got)
    none = finite_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>"), "embedding").select(fixed_point("embedding", 2.0, 1).alias("x"))
    assert none.count() == 0


def test_query_without_rows(spark, tmp_path):
    spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op13_whitening(spark, str(tmp_path)).where(F.lit(True)).collect() == []
