"""Passes over sparse rows against numpy on the same rows made dense."""

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom.operators import linear, relevance, vectors
from tagloom.session import materialise

CLASSES = ["a", "b", "c"]


def invented(n=200, width=30, seed=0, dense=False):
    rng = np.random.default_rng(seed)
    x = rng.random((n, width)) * (rng.random((n, width)) < 0.25) if not dense else rng.standard_normal((n, width))
    w = rng.standard_normal((width, 3))
    y = np.where(x @ w + 0.5 * rng.standard_normal((n, 3)) > 0, 1.0, -1.0)
    return x, y


def frame(spark, x, y, sparse=True):
    rows = []
    for k, row in enumerate(x):
        at = np.flatnonzero(row)
        vector = Vectors.sparse(len(row), at.tolist(), row[at].tolist()) if sparse and k % 3 else Vectors.dense(row.tolist())
        rows.append((k, vector, [c for c, v in zip(CLASSES, y[k]) if v > 0] + ["other"]))
    return spark.createDataFrame(rows, ["Id", "x", "tags"])


def standard(x):
    deviation = x.std(axis=0)
    return (x - x.mean(axis=0)) / np.where(deviation > 0, deviation, 1)


@pytest.fixture(scope="module")
def sample(spark):
    x, y = invented()
    x[:, 7] = 0.0  # a feature that no row has
    x[5] = 0.0  # a row without features
    df = frame(spark, x, y)
    return x, y, df, linear.row_blocks(df.repartition(5), "x", "tags", CLASSES)


def test_moments_and_products(sample):
    x, y, _, blocks = sample
    stats = linear.moments(blocks, x.shape[1])
    assert stats.rows == len(x) and np.allclose(stats.mean, x.mean(axis=0))
    z = standard(x)
    v = np.random.default_rng(1).standard_normal((x.shape[1], 4))
    assert np.allclose(linear.gram_times(blocks, v, stats), z.T @ (z @ v))
    assert np.allclose(linear.label_sums(blocks, x.shape[1], range(1, 3), stats), z.T @ y[:, 1:])


@pytest.mark.parametrize("scaled", [False, True])
def test_squared_error_solves_the_normal_equations(sample, scaled, monkeypatch):
    x, y, _, blocks = sample
    monkeypatch.setattr(linear, "SENT_BYTES", 8 * x.shape[1] * 4)  # two classes a group
    stats = linear.moments(blocks, x.shape[1], scaled)
    z = standard(x) if scaled else x
    w = linear.solve_squared_error(blocks, x.shape[1], 3, stats, 1e-2)
    exact = np.linalg.solve(z.T @ z / len(z) + 1e-2 * np.eye(z.shape[1]), z.T @ y / len(z))
    assert np.allclose(w, exact, atol=1e-6)


@pytest.mark.parametrize("scaled", [False, True])
def test_hinge_reaches_a_small_duality_gap(sample, scaled):
    x, y, _, blocks = sample
    stats = linear.moments(blocks, x.shape[1], scaled)
    z, penalty = standard(x) if scaled else x, 1e-2
    w, gaps, passes = linear.solve_hinge(blocks, x.shape[1], 3, stats, penalty, tolerance=2e-3)
    assert (gaps <= 2e-3).all() and passes < 400

    def value(w):
        return np.maximum(1 - y * (z @ w), 0).mean(axis=0) + penalty / 2 * (w**2).sum(axis=0)

    # Plain dual coordinate ascent on the same rows.
    for k in range(3):
        alpha, v, squares = np.zeros(len(z)), np.zeros(z.shape[1]), (z**2).sum(axis=1)
        for _ in range(800):
            for i in range(len(z)):
                if squares[i]:
                    new = np.clip(alpha[i] + (1 - y[i, k] * (z[i] @ v)) * penalty * len(z) / squares[i], 0, 1)
                    v += (new - alpha[i]) * y[i, k] * z[i] / (penalty * len(z))
                    alpha[i] = new
        plain = np.maximum(1 - y[:, k] * (z @ v), 0).mean() + penalty / 2 * v @ v
        assert value(w)[k] <= plain + 2.1e-3


@pytest.mark.parametrize("loss", ["squared_error", "hinge"])
def test_wide_models_predict_as_numpy_does(spark, loss):
    """More features than the dense way takes, most of them in few rows."""
    width, n = 20_000, 120
    rng = np.random.default_rng(3)
    rows, dense = [], np.zeros((n, width))
    for k in range(n):
        at = np.unique(np.r_[rng.integers(0, 40, 6), rng.integers(40, width, 12)])
        dense[k, at] = rng.integers(1, 4, len(at))
        rows.append((k, Vectors.sparse(width, at.tolist(), dense[k, at].tolist()), [f"t{c}" for c in range(100) if c in at or (c == 50 and k % 5 == 0)]))
    df = spark.createDataFrame(rows, ["Id", "x", "tags"])
    classes = [f"t{c}" for c in range(100)]
    model = relevance.fit_tags(df, "x", "tags", classes, loss, max_iter=60)
    assert model.weights.shape == (width, 100)
    found = {r.Id: r.predicted for r in relevance.predict_tags(df, "x", model).collect()}
    scores = dense @ model.weights + model.constants
    assert found == {k: [classes[c] for c in np.flatnonzero(scores[k] > 0)] for k in range(n)}
    if loss == "squared_error":
        y = np.array([[1.0 if c in r[2] else -1.0 for c in classes] for r in rows])
        residual = dense.T @ (dense @ model.weights - y) / n + relevance.PENALTY * model.weights
        assert np.abs(residual).max() < 1e-6


def test_products_of_sparse_rows_travel_sparse(sample, monkeypatch):
    x, y, df, _ = sample
    monkeypatch.setattr(linear, "WORK_NUMBERS", 7 * x.shape[1])  # seven rows at once
    table = relevance.gram_rows(df, "x", "tags", CLASSES, x.shape[1])
    plan = table._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("UDF(x") == 0 and plan.count("MapInArrow") == 1
    got = np.array([r["values"] for r in table.orderBy("k").collect()])
    assert np.allclose(got, np.r_[x.T @ x, y.T @ x])


def test_components_of_sparse_rows(sample, monkeypatch):
    x, _, df, blocks = sample
    stats = linear.moments(blocks, x.shape[1])
    z = standard(x)
    values, exact = np.linalg.eigh(z.T @ z)
    shares = values[::-1] / values.sum()
    found, ours = linear.principal_components(blocks, x.shape[1], stats, 5)
    assert np.allclose(found.T @ found, np.eye(5), atol=1e-9) and np.allclose(ours, shares[:5], rtol=1e-4)
    assert np.allclose(np.abs((found * exact[:, ::-1][:, :5]).sum(axis=0)), 1, atol=2e-2)
    monkeypatch.setattr(vectors, "DENSE_FEATURES", 8)
    reducer, kept = vectors.pca_select(df, "x", "z", 0.8)
    assert kept == vectors.components_below(shares.tolist(), 0.8)
    made = np.array([r.z.toArray() for r in reducer.transform(df).orderBy("Id").select("z").collect()])
    assert made.shape == (len(x), kept)
    assert np.allclose(made.var(axis=0) * len(x) / values.sum(), shares[:kept], rtol=1e-3)
    table = vectors.scree_table(df, "x", step=2).orderBy("axis").collect()
    assert np.allclose([r.cumulative_percent for r in table], 100 * np.cumsum(shares)[::2][: len(table)], atol=0.01)


def test_no_rows(spark, sample):
    x, y, df, _ = sample
    blocks = linear.row_blocks(df.limit(0), "x", "tags", CLASSES)
    stats = linear.moments(blocks, 30)
    assert stats.rows == 0 and linear.principal_components(blocks, 30, stats, 3)[1].size == 0
    nulls = df.select("Id", F.when(F.col("Id") > 2, F.col("x")).alias("x"), F.when(F.col("Id") != 4, F.col("tags")).alias("tags"))
    stats = linear.moments(linear.row_blocks(nulls, "x", "tags", CLASSES), 30)
    assert np.allclose(stats.mean, x[3:].sum(axis=0) / len(x))


def test_hinge_with_features_of_uneven_sizes_takes_few_passes(spark):
    """Counts from 1 to many, one feature nearly the sum of others: without the products of the features hundreds of passes."""
    rng = np.random.default_rng(5)
    n, width = 300, 40
    x = rng.poisson(np.geomspace(0.05, 200, width), (n, width)).astype(float)
    x[:, -1] = x[:, 20:39].sum(axis=1) + rng.poisson(1, n)
    y = np.where((x - x.mean(axis=0)) / (x.std(axis=0) + 1e-9) @ rng.standard_normal((width, 3)) > 0, 1.0, -1.0)
    blocks = linear.row_blocks(frame(spark, x, y), "x", "tags", CLASSES)
    _, gaps, passes = linear.solve_hinge(blocks, width, 3, linear.moments(blocks, width, False), 1e-4, 1e-2, most=300)
    assert (gaps <= 1e-2).all() and passes < 300


def test_blocks_travel_a_few_at_a_time(spark, tmp_path, monkeypatch):
    """However many blocks a task has, readers and Python hold a bounded part of them."""
    monkeypatch.setattr(linear, "BATCH_BYTES", 20_000)
    rows = [(Vectors.sparse(50, range(50), [float(i + j) for j in range(50)]),) for i in range(400)]
    df = materialise(spark.createDataFrame(rows, ["x"]).coalesce(1))
    blocks = linear.row_blocks(df, "x", numbers=500)
    files = [f for f in blocks.inputFiles() if pq.ParquetFile(f.removeprefix("file://")).metadata.num_rows]
    for file in files:
        about = pq.ParquetFile(file.removeprefix("file://")).metadata
        assert max(about.row_group(i).num_rows for i in range(about.num_row_groups)) <= linear.STORED_BLOCKS
    held, plain = [], linear._blocks
    folder = str(tmp_path)

    def seen(batch):
        with open(f"{folder}/held", "a") as f:
            f.write(f"{batch.nbytes}\n")
        yield from plain(batch)

    monkeypatch.setattr(linear, "_blocks", seen)
    before = spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")
    sums = linear.moments(blocks, 50).mean
    held = [int(x) for x in (tmp_path / "held").read_text().split()]
    assert len(held) > 5 and max(held) < 40_000
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == before
    np.testing.assert_allclose(sums, np.arange(50) + 199.5)
