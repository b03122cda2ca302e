"""Whitening against an eigendecomposition in extended precision on small tables."""

import numpy as np
import pandas as pd

from policyscan.llm import whitening

SF = "/root/testdata/sf0.001"


def frame(spark, vectors, **more):
    return spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")


def expected(vectors):
    x = np.floor(np.array(vectors, np.float64) * 1024).astype(np.int64) + 100_000
    n, sums = len(x), x.sum(axis=0)
    centred = (x * n - sums).astype(np.longdouble) / n
    covariance = (centred.T @ centred / n).astype(np.float64)
    values, columns = np.linalg.eigh(covariance)
    order = np.argsort(-values)
    deviation = [sum(int(e) ** 2 for e in row) for row in (x * n - sums)]
    return centred.astype(np.float64), values[order], columns[:, order].T, deviation


def check(out: pd.DataFrame, vectors, components):
    centred, values, rows, deviation = expected(vectors)
    assert sorted(out["component"].unique()) == list(range(1, components + 1))
    assert len(out) == components * len(vectors)
    for k, part in out.groupby("component"):
        part = part.sort_values("vec_id")
        mine = centred @ rows[k - 1] / np.sqrt(values[k - 1])
        theirs = part["whitened"].to_numpy()
        sign = np.sign(mine @ theirs)
        np.testing.assert_allclose(theirs, sign * mine, rtol=0, atol=1e-8)
        np.testing.assert_allclose(part["explained"], values[k - 1] / values.sum(), rtol=1e-10)
        assert part["deviation"].tolist() == deviation
    assert (out["n"] == len(vectors)).all()
    assert out["identity_error"].nunique() == 1 and out["identity_error"].iloc[0] < 1e-9


def test_given_vectors(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet")
    out = whitening.whiten(given.repartition(7)).toPandas()
    vectors = [r.embedding for r in given.orderBy("vec_id").collect()]
    check(out, vectors, 8)


def test_far_apart_scales_and_sum_tree(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "BLOCK_BYTES", 100)
    rng = np.random.default_rng(3)
    scales = np.array([1e5, 3e3, 100.0, 3.0, 0.1])  # condition number 1e6 before squaring
    vectors = (rng.normal(size=(400, 5)) * scales) @ np.linalg.qr(rng.normal(size=(5, 5)))[0]
    out = whitening.whiten(frame(spark, vectors.tolist()).repartition(9)).toPandas()
    centred, values, rows, _ = expected(vectors)
    for k, part in out.groupby("component"):
        mine, theirs = centred @ rows[k - 1] / np.sqrt(values[k - 1]), part.sort_values("vec_id")["whitened"].to_numpy()
        np.testing.assert_allclose(np.abs(theirs), np.abs(mine), atol=1e-4 if k == 5 else 1e-6)
    assert out["identity_error"].iloc[0] < 1e-9


def test_directions_without_variance(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(60, 3))
    vectors = np.concatenate([base, base[:, :1], np.ones((60, 1))], axis=1)  # a repeated and a constant dimension
    out = whitening.whiten(frame(spark, vectors.tolist())).toPandas()
    check(out, vectors, 3)
    fewer = rng.normal(size=(4, 10))  # fewer vectors than dimensions: three directions
    check(whitening.whiten(frame(spark, fewer.tolist())).toPandas(), fewer, 3)


def test_defined_results(spark):
    good = [[0.5, 1.0], [1.5, -1.0], [0.25, 0.0], [0.25, 0.0]]
    nan, inf = float("nan"), float("inf")
    bad = [None, [None, 1.0], [nan, 1.0], [inf, 1.0], [1e30, 0.0], [], [1.0], [1.0, 2.0, 3.0]]
    rows = [(i, v, "x", 1) for i, v in enumerate(good)] + [(None, [2.0, 2.0], "y", 2)] + [(50 + i, v, "z", 3) for i, v in enumerate(bad)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n string, component int")
    out = whitening.whiten(table).toPandas()
    assert len(out) == 10 and out["vec_id"].isna().sum() == 2 and set(out["vec_id"].dropna()) == {0, 1, 2, 3}
    assert (out["n"] == 5).all()
    same = out[out["vec_id"].isin([2, 3])].groupby("component")["whitened"].nunique()
    assert (same == 1).all()
    assert whitening.whiten(table.limit(0)).collect() == []
    assert whitening.whiten(frame(spark, [[1.0, 2.0]] * 3)).collect() == []
    assert whitening.whiten(frame(spark, [[], []])).collect() == []
    floats = table.select("vec_id", table.embedding.cast("array<float>").alias("embedding"))
    assert whitening.whiten(floats).count() == 10


def test_triangular_solve():
    rng = np.random.default_rng(5)
    factor = np.triu(rng.normal(size=(70, 70))) + 10 * np.eye(70)
    rows = rng.normal(size=(20, 70))
    np.testing.assert_allclose(whitening.solve(rows, factor) @ factor, rows, atol=1e-10)
