"""Model-layer properties: spline partition of unity,
Nyström kernel approximation, train-window = state-array features,
quantile monotonicity, boosting sanity, and the synthetic two-regime
claim that direct beats recursive inside the regime suffix."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tempora.ml import forecast as FC
from tempora.ml.quantile import inverse_cdf
from tempora.ml.splines import fit_nystroem, fit_splines


def test_spline_partition_of_unity(spark):
    df = spark.range(200).select((F.col("id") * 0.37 - 10).alias("x"))
    sp = fit_splines(df, ["x"])
    probe = spark.range(-20, 80).select((F.col("id") * 1.0).alias("x"))
    out = sp.transform(probe)
    total = sum(F.col(f"x_sp_{j}") for j in range(sp.n_splines))
    vals = [r[0] for r in out.select(total).collect()]
    assert np.allclose(vals, 1.0)
    assert sp.n_splines == 7
    from pyspark.ml.functions import vector_to_array as v2a
    arr = [r[0] for r in sp.vector(probe).select(v2a("spl")).collect()]
    cols = [list(r) for r in out.select(*[f"x_sp_{j}" for j in range(7)]).collect()]
    assert np.allclose(arr, cols)


def test_nystroem_approximates_kernel(spark):
    rng = np.random.default_rng(0)
    X = rng.normal(size=(60, 3))
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(X)], "k long, a double, b double, c double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    ny = fit_nystroem(df, "features", n_components=60, gamma=0.5, key="k")
    Z = np.array([r[0] for r in ny.transform(df).orderBy("k").select(vector_to_array("nystroem")).collect()])
    d2 = ((X[:, None, :] - X[None, :, :]) ** 2).sum(-1)
    K = np.exp(-0.5 * d2)
    assert np.abs(Z @ Z.T - K).max() < 1e-6   # all rows are landmarks → exact


def test_window_features_equal_state_array_features(spark):
    n = 120
    s = spark.range(n).select(F.lit(1).alias("series_id"), F.col("id").alias("pos"),
                              (F.sin(F.col("id") * 0.3) * 10 + F.col("id") * 0.1).alias("y"))
    mat = FC.lag_matrix(s).select("pos", *FC.lag_feature_names())
    hist = s.select("pos", F.collect_list("y").over(
        __import__("pyspark.sql", fromlist=["Window"]).Window.orderBy("pos").rowsBetween(-30, -1)).alias("h"))
    arr = hist.where(F.size("h") == 30).select("pos", *FC.array_features(F.col("h")))
    a = {r.pos: np.array(r[1:], dtype=float) for r in mat.collect()}
    b = {r.pos: np.array(r[1:], dtype=float) for r in arr.collect()}
    assert set(a) == set(b) and len(a) == n - 30
    for k in a:
        assert np.allclose(a[k], b[k], rtol=1e-9, atol=1e-9)


def test_inverse_cdf_goldens(spark):
    # cdf [0, .2, .7, 1] on edges [10, 20, 30, 50]
    df = spark.createDataFrame([([0.2, 0.5, 0.3],)], "p array<double>")
    edges = [10.0, 20.0, 30.0, 50.0]
    r = df.select(*[inverse_cdf(F.col("p"), edges, q).alias(f"q{i}") for i, q in enumerate([0.05, 0.5, 0.95])]).first()
    assert r.q0 == pytest.approx(12.5) and r.q1 == pytest.approx(26.0) and r.q2 == pytest.approx(46.666667, abs=1e-6)


def test_averaged_inverted_cdf_edges(spark):
    from tempora.ml.quantile import quantile_edges
    df = spark.range(1, 11).select(F.col("id").cast("double").alias("y"))
    assert quantile_edges(df, "y", 4) == pytest.approx([1.0, 3.0, 5.5, 8.0, 10.0])


def test_state_matrix_equals_state_array_features(spark):
    rng = np.random.default_rng(3)
    h = rng.normal(size=(20, FC.N_LAGS))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(h)], "k long, h array<double>")
    rows = df.select("k", *FC.array_features(F.col("h"))).orderBy("k").collect()
    assert np.allclose([list(r)[1:] for r in rows], FC.state_features(h), atol=1e-9)


def test_spline_values_equal_columns(spark):
    x = np.linspace(-3, 9, 50)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    sp = fit_splines(df.where("x between 0 and 6"), ["x"], 10)
    rows = [list(r) for r in df.select(*sp.columns()).collect()]
    assert np.allclose(rows, FC.spline_values(x, *sp.bounds["x"], 10), atol=1e-12)


def test_classifier_leaves_grow_deep(spark):
    """Leaves of 5 rows need more than the library's default of 5 levels."""
    from tempora.ml.quantile import fit_binned_quantile
    rng = np.random.default_rng(4)
    x = rng.uniform(size=600)
    df = spark.createDataFrame([(float(a), float(np.sin(40 * a))) for a in x], "x double, label double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    depth = lambda **k: max(t.depth for t in fit_binned_quantile(df, "label", n_bins=20, num_trees=4, subset="all", **k).clf.trees)
    assert depth() > 5 and depth(max_depth=3) == 3


def test_direct_beats_recursive_in_regime_suffix(spark):
    """Two-regime fixture (FIXTURES 1.8): 500 segments × 30 steps, type a =
    15 × N(0, 0.01) then 15 × N(1, 0.01), type b = 15 × N(0, 0.1) then
    15 × N(-1, 0.01); last 300 rows are test, origins every 5 steps,
    horizon 60.  Claim: direct beats recursive for horizons in the suffix."""
    rng = np.random.default_rng(42)
    rows, pos = [], 0
    for seg in range(500):
        a = rng.random() < 0.5
        first = rng.normal(0, 0.01 if a else 0.1, 15)
        second = rng.normal(1 if a else -1, 0.01, 15)
        for v in np.concatenate([first, second]):
            rows.append((0, pos, float(v)))
            pos += 1
    s = spark.createDataFrame(rows, "series_id long, pos long, y double").repartition(8)
    n = pos
    train = FC.lag_matrix(s).where(F.col("pos") < n - 300)
    m = FC.fit_lag_model(train, rounds=20)
    o = FC.origins_table(s, n, test_len=300, chunk=5)
    rec = FC.recursive_forecast(o, m, horizon=13)
    direct = FC.direct_forecast(s, o, n, [13], test_len=300, rounds=20)
    act = s.select("series_id", "pos", "y")

    def mae(df, h):
        j = df.where(F.col("horizon") == h).join(act, ["series_id", "pos"])
        return j.agg(F.avg(F.abs(F.col("y") - F.col("y_hat")))).first()[0]
    assert mae(direct, 13) < mae(rec, 13)
