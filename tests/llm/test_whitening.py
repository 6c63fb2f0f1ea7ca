import math

import numpy as np
import pytest

from postlens.llm import whitening as w

SCHEMA = "vec_id long, embedding array<float>, label int, n long, x string"


def found(spark, vectors, kind="float", **more):
    rows = [(k, None if v is None else [None if c is None else float(c) for c in v], 1, 7, "x") for k, v in enumerate(vectors)]
    return w.whiten(spark.createDataFrame(rows, SCHEMA.replace("float", kind)), **more).toPandas().sort_values(["vec_id", "component"])


def check(spark, vectors, kind="float", count=4):
    """Against a dense decomposition; axes of equal eigenvalues are not compared."""
    got = found(spark, vectors, kind)
    raw = np.array(vectors, dtype=np.float32 if kind == "float" else np.float64).astype(float)
    x = np.floor(256 * raw).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    values, axes = np.linalg.eigh(np.cov(fit.T, bias=True).reshape(x.shape[1], -1))
    values, axes = values[::-1][:count], axes[:, ::-1][:, :count]
    white = (x - sums / n) @ axes / np.sqrt(values)
    own = got["whitened"].to_numpy().reshape(len(x), -1)
    assert own.shape[1] == count and set(got["n"]) == {n} and (got["identity_error"] < 1e-8).all()
    assert np.allclose(got["explained"].to_numpy()[:count], values / np.var(fit, axis=0).sum(), rtol=1e-9)
    assert got["deviation"].to_numpy()[::count].tolist() == ((n * x - sums) ** 2).sum(axis=1).tolist()
    assert np.abs(own - white * np.sign((own * white).sum(axis=0))).max() < 1e-8
    return got


@pytest.mark.parametrize("dims, rows", [(4, 30), (16, 200), (64, 500)])
def test_as_dense(spark, dims, rows):
    rng = np.random.default_rng(dims)
    vectors = rng.standard_normal((rows, dims)) * np.linspace(2, 0.5, dims) @ rng.standard_normal((dims, dims)) / dims
    check(spark, [*vectors, *vectors[: rows // 3]])


def test_small_gaps_and_wide_range(spark):
    rng = np.random.default_rng(7)
    check(spark, rng.standard_normal((400, 12)) * np.array([1000, 900, 899, 30, 20, *[1e-2] * 7]), "double")


def test_fewer_directions_than_components(spark):
    rng = np.random.default_rng(8)
    flat = rng.integers(-9, 9, (50, 2)) @ rng.integers(-3, 4, (2, 6)) / 256
    check(spark, flat, "double", count=2)
    check(spark, [[k / 256, 1, -k / 256] for k in range(9)], "double", count=1)


def test_many_equal_eigenvalues(spark):
    got = found(spark, [*np.eye(8), *-np.eye(8)])
    assert len(got) == 64 and np.allclose(got["explained"], 1 / 8) and (got["identity_error"] < 1e-9).all()


def test_rows_that_are_dropped_or_alike(spark):
    vectors = [[0.5, 1], None, [0.25, None], [math.nan, 1], [math.inf, 0], [0.5, 1], [-0.0, 0.001], [], [3, 4, 5], [3, 4, 5]]
    got = found(spark, vectors)
    assert sorted(set(got["vec_id"])) == [0, 5, 6] and set(got["component"]) == {1} and set(got["n"]) == {2}
    assert len(got) == 3 and got["whitened"].round(9).abs().tolist() == [1, 1, 1]


def test_equal_vectors_and_empty(spark):
    assert len(found(spark, [[1, 2]] * 5)) == len(found(spark, [[1, 2]])) == len(found(spark, [])) == len(found(spark, [None])) == 0


def test_deviations_are_exact_or_null():
    x = np.array([[10**12, -5], [3, 4]])
    moved, deviations = w._deviations(x, 10, [10**12 + 3, -1])
    assert deviations.to_pylist() == [None, None]
    _, deviations = w._deviations(x // 10**4, 3, [10**8, -1])
    assert deviations.to_pylist() == [int((3 * 10**8 - 10**8) ** 2 + (3 * (-5 // 10**4) + 1) ** 2), (10**8) ** 2 + 1]
