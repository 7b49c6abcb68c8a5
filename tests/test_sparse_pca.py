"""Components of sparse vectors against an eigendecomposition of the covariance matrix."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from tidemark.operators.sparse_pca import fit_components


def frame(spark, x, sparse):
    make = lambda v: Vectors.sparse(len(v), [(i, float(z)) for i, z in enumerate(v) if z]) if sparse else Vectors.dense(v)
    return spark.createDataFrame([(i, make(v)) for i, v in enumerate(x)], ["id", "features"]).repartition(3)


def made(seed, n=400, d=80):
    r = np.random.default_rng(seed)
    x = (r.random((n, d)) < 0.1) * r.normal(2, 1, (n, d))
    for j in range(min(6, d)):  # a few strong directions
        x[:, j] += r.normal(0, 12 / (j + 1), n)
    return x


@pytest.mark.parametrize("sparse", [True, False])
def test_leading_components(spark, sparse):
    x = made(1)
    df = frame(spark, x, sparse)
    fit = fit_components(df, 5)
    values, vectors = np.linalg.eigh(np.cov(x.T))
    assert fit.variance == pytest.approx(values[::-1][:5], rel=1e-6)
    assert fit.total == pytest.approx(values.sum()) and np.allclose(fit.matrix.T @ fit.matrix, np.eye(5))
    for j in range(5):
        assert abs(fit.matrix[:, j] @ vectors[:, -1 - j]) > 0.999
    other = made(2, 30)  # fitted on one table, applied to another
    got = {r["id"]: r["pca"] for r in fit.transform(frame(spark, other, sparse)).collect()}
    assert np.allclose([got[i] for i in range(30)], (other - x.mean(0)) @ fit.matrix)
    assert [r["cumulative"] for r in fit.explained(spark).collect()] == pytest.approx(np.cumsum(fit.ratio))


def test_more_components_than_features_and_odd_tables(spark):
    x = made(3, 50, 4)
    df = frame(spark, x, True)
    fit = fit_components(df, 50)
    assert fit.matrix.shape == (4, 4) and fit.ratio.sum() == pytest.approx(1)
    constant = fit_components(frame(spark, np.ones((5, 3)), False), 2)
    assert constant.total == pytest.approx(0) and constant.ratio.tolist() == [0, 0] or constant.total < 1e-12
    with pytest.raises(ValueError, match="no rows"):
        fit_components(df.where("false"))
    with pytest.raises(TypeError):
        fit_components(df, features="id")
