"""Gram-matrix ridge against numpy on the rows themselves."""

import numpy as np
import pytest

from tempora.ml import ridge as R
from tempora.plans.split import TimeSplit


def _frame(spark, n=240, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 30, 0.1, 1] + [0, 500, 2, 0]
    x[:, 3] = 7.0
    y = np.stack([x[:, 0] * 2 + x[:, 1] / 10 + rng.normal(size=n), rng.normal(size=n)])
    x[rng.random(n) < 0.2, 0] = np.nan
    y[0, 5] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in x[i]], *[None if np.isnan(v) else float(v) for v in y[:, i]], "z") for i in range(n)]
    df = spark.createDataFrame(rows, "split_pos long, a double, b double, c double, d double, t double, u double, segment string").repartition(5)
    return df, x, y


def _direct(x, y, alpha, scaled):
    means = np.nanmean(x, axis=0)
    x = np.where(np.isnan(x), means, x)
    c = x - x.mean(axis=0)
    s = np.where(c.std(axis=0) > 1e-9, c.std(axis=0), 1.0) if scaled else np.ones(x.shape[1])
    w = np.linalg.solve((c / s).T @ (c / s) + alpha * np.eye(x.shape[1]), (c / s).T @ (y - y.mean())) / s
    return w, y.mean() - w @ x.mean(axis=0), means


@pytest.mark.parametrize("scaled", [False, True])
def test_folds_and_penalties(spark, scaled):
    df, x, y = _frame(spark)
    split = TimeSplit(240, 3, 40, 5, 120)
    got = R.fold_grams(df, split, ["a", "b", "c", "d"], ["t", "u"])
    alphas = [1e-3, 1.0, 100.0, 1e5]
    ok = ~np.isnan(y).any(axis=0)
    for k in range(3):
        lo, hi, ts, te = split.bounds(k)
        tr = np.arange(lo, hi)[ok[lo:hi]]
        for target in (0, 1):
            for alpha, line in zip(alphas, got.fit(k, alphas, target, scaled=scaled)):
                w, b, means = _direct(x[tr], y[target, tr], alpha, scaled)
                p = np.where(np.isnan(x), means, x) @ w + b
                assert np.allclose(line.weights, w, atol=1e-7) and line.intercept == pytest.approx(b, abs=1e-5)
                for role, own in (("train", tr), ("test", np.arange(ts, te))):
                    r2 = 1 - ((y[target, own] - p[own]) ** 2).sum() / ((y[target, own] - y[target, own].mean()) ** 2).sum()
                    assert line.r2[role] == pytest.approx(r2, abs=1e-7)
    lo, hi, _, _ = split.bounds(0)
    own = np.arange(lo, hi)[ok[lo:hi]]
    few = got.fit(0, [1.0], columns=["c", "b"])[0]
    assert few.features == ["c", "b"] and np.allclose(few.weights, _direct(x[np.ix_(own, [2, 1])], y[0, own], 1.0, False)[0])


def test_predictions_are_of_the_rows_own_fold(spark):
    df, x, y = _frame(spark)
    split = TimeSplit(240, 3, 40, 5, 120)
    got = R.fold_grams(df, split, ["a", "b", "c", "d"], ["t"])
    lines = [got.fit(k, [0.5])[0] for k in range(3)]
    rows = sorted(got.predictions(df, lines, ["split_pos"]).collect())
    assert [r["split_pos"] for r in rows] == list(range(120, 240))
    for r in rows:
        line = lines[r["fold_idx"]]
        v = np.where(np.isnan(x[r["split_pos"]]), line.means, x[r["split_pos"]])
        assert r["fold_idx"] == (r["split_pos"] - 120) // 40 and r["prediction"] == pytest.approx(v @ line.weights + line.intercept, abs=1e-8)


def test_bound(spark):
    df, _, _ = _frame(spark)
    with pytest.raises(ValueError):
        R.gram(df, ["a"] * 1000, ["t"], R._segment(df["split_pos"], [0]))
