"""Histogram trees against a direct search over rows: splits, missing values,
best-first growth, losses, several targets, chunks, exact leaf quantiles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.ml import histogram as H


def _frame(spark, x, ys, members=None, parts=3):
    cols = [f"x{i}" for i in range(x.shape[1])]
    names = [f"y{i}" for i in range(len(ys))]
    rows = [(i, int(members[i]) if members is not None else 1, *[None if np.isnan(v) else float(v) for v in r],
             *[None if np.isnan(y[i]) else float(y[i]) for y in ys]) for i, r in enumerate(x)]
    schema = "id long, member long, " + ", ".join(f"{c} double" for c in cols + names)
    return spark.createDataFrame(rows, schema).repartition(parts), cols, names


def _data(n=300, seed=0, missing=0.2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 4, n), rng.integers(0, 25, n) / 7, rng.normal(size=n)])
    y = np.where(x[:, 0] > 0.3, 2.0, 0.0) + 0.5 * x[:, 1] * (x[:, 2] > 1) + 0.2 * rng.normal(size=n) + 1.5
    x[rng.random(n) < missing, 0] = np.nan
    x[rng.random(n) < missing / 2, 3] = np.nan
    return x, y


class Direct:
    """Best-first trees by trying every cut and both sides for missing rows, row by row."""

    def __init__(self, x, bins, spec):
        self.x, self.bins, self.spec = x, bins, spec

    def gain(self, g, h, left):
        s = self.spec
        if min(left.sum(), (~left).sum()) < s.min_samples_leaf:
            return 0.0
        part = lambda m: (g[m].sum() ** 2) / (h[m].sum() + s.l2)
        return part(left) + part(~left) - (g.sum() ** 2) / (h.sum() + s.l2)

    def split(self, rows, g, h):
        best = (0.0, None)
        for f, cuts in enumerate(self.bins.cuts):
            v = self.x[rows, f]
            gone = np.isnan(v)
            for c in range(len(cuts) + 1):
                low = ~gone & (v <= cuts[c] if c < len(cuts) else True)
                for side in ((False, True) if gone.any() else (False,)):
                    left = low | gone if side else low
                    got = self.gain(g[rows], h[rows], left)
                    if got > best[0] + 1e-9:
                        best = (got, (f, c, side if gone.any() else left.sum() >= (~left).sum(), left))
        return best

    def tree(self, g, h):
        """Leaves as row sets, split in the order of gain."""
        rows = np.arange(len(g))
        leaves = [(rows, self.split(rows, g, h))]
        while len(leaves) < (self.spec.max_leaf_nodes or 10**9):
            at = max(range(len(leaves)), key=lambda i: leaves[i][1][0])
            own, (gain, how) = leaves[at]
            if gain <= 0:
                break
            left = how[3]
            leaves[at:at + 1] = [(p, self.split(p, g, h)) for p in (own[left], own[~left])]
        return [own for own, _ in leaves]

    def fit(self, y):
        s = self.spec
        link = np.exp if s.loss in H.LOG_LINK else lambda r: r
        base = np.percentile(y, 100 * s.quantile) if s.loss == "quantile" else np.log(y.mean()) if s.loss in H.LOG_LINK else y.mean()
        raw = np.full(y.size, base)
        for _ in range(s.rounds):
            g, h = {"squared": (raw - y, np.ones_like(y)), "poisson": (np.exp(raw) - y, np.exp(raw)), "gamma": (1 - y * np.exp(-raw), y * np.exp(-raw)),
                    "quantile": (np.where(y < raw, 1 - s.quantile, -s.quantile), np.ones_like(y))}[s.loss]
            for own in self.tree(g, h):
                value = np.percentile(y[own] - raw[own], 100 * s.quantile) if s.loss == "quantile" else -g[own].sum() / (h[own].sum() + s.l2)
                raw[own] = raw[own] + s.learning_rate * value
        return link(raw)


def _fit(spark, x, y, spec, **options):
    df, cols, names = _frame(spark, x, [y])
    bins = H.fit_bins(df, cols, options.pop("max_bins", 255))
    got, = H.fit(df, bins, names, F.col("member"), [spec], key=["id"], **options)
    return got, bins, df


@pytest.mark.parametrize("loss,leaves", [("squared", 7), ("poisson", 5), ("gamma", 31), ("quantile", 6)])
def test_equals_direct_search(spark, loss, leaves):
    x, y = _data()
    y = np.maximum(y, 0.05) if loss in H.LOG_LINK else y
    spec = H.Spec(loss=loss, quantile=0.7, rounds=3, learning_rate=0.3, max_leaf_nodes=leaves, min_samples_leaf=9)
    got, bins, df = _fit(spark, x, y, spec)
    assert np.allclose(got.predict(bins.apply(x.T))[0], Direct(x, bins, spec).fit(y), atol=1e-8)
    assert all((t.left < 0).sum() <= leaves for t in got.trees) and len(got.trees) == 3
    table = sorted((r["id"], r["predictions"][0]) for r in H.predict(df, bins, [got], ["id"]).collect())
    assert np.allclose([p for _, p in table], got.predict(bins.apply(x.T))[0])


def test_chunks_and_narrowed_ranks(spark, monkeypatch):
    """Rows in many chunks and blocks of two features give the trees of one chunk."""
    x, y = _data(400, 3)
    y = np.round(y, 1)  # ties in the residuals
    specs = [H.Spec(loss=loss, quantile=0.2, rounds=12, max_leaf_nodes=6, min_samples_leaf=10) for loss in ("squared", "quantile")]
    df, cols, names = _frame(spark, x, [y])
    bins = H.fit_bins(df, cols)
    whole = H.fit(df, bins, names, F.col("member"), specs, key=["id"])
    monkeypatch.setattr(H, "BLOCK_FEATURES", 2)
    monkeypatch.setattr(H, "NARROW_TO", 3)
    monkeypatch.setattr(H, "FOLD_TREES", 2)
    monkeypatch.setattr(H, "HISTOGRAM_BYTES", 1)
    parts = H.fit(df, bins, names, F.col("member"), specs, chunk_rows=60, key=["id"])
    for a, b, spec in zip(whole, parts, specs):
        assert np.allclose(a.predict(bins.apply(x.T)), b.predict(bins.apply(x.T)), atol=1e-6)
    assert np.allclose(whole[1].predict(bins.apply(x.T))[0], Direct(x, bins, specs[1]).fit(y), atol=1e-6)


def test_missing_side_is_learned(spark):
    """High values and missing ones belong together; an imputed mean would stand with the low ones."""
    rng = np.random.default_rng(5)
    v = rng.uniform(0, 1, 400)
    gone = rng.random(400) < 0.3
    y = np.where(gone | (v > 0.8), 5.0, 1.0)
    x = np.where(gone, np.nan, v)[:, None]
    got, bins, _ = _fit(spark, x, y, H.Spec(rounds=1, learning_rate=1.0, max_leaf_nodes=2, min_samples_leaf=5))
    assert np.allclose(got.predict(bins.apply(x.T))[0], y) and not got.trees[0].missing_left[0]
    got, bins, _ = _fit(spark, -x, y, H.Spec(rounds=1, learning_rate=1.0, max_leaf_nodes=2, min_samples_leaf=5))
    assert np.allclose(got.predict(bins.apply(-x.T))[0], y) and got.trees[0].missing_left[0]
    # nothing missing in training: the larger side
    full = np.arange(100.0)[:, None]
    got, bins, _ = _fit(spark, full, (full[:, 0] >= 30).astype(float), H.Spec(rounds=1, max_leaf_nodes=2, min_samples_leaf=5))
    assert not got.trees[0].missing_left[0]


def test_opposite_targets(spark):
    """Two targets whose mean is constant: only a gain over the vector can split."""
    rng = np.random.default_rng(6)
    x = rng.uniform(-1, 1, (300, 2))
    up = np.where(x[:, 0] > 0.2, 3.0, -1.0)
    df, cols, names = _frame(spark, x, [up, -up])
    bins = H.fit_bins(df, cols)
    joint, mean = H.fit(df.withColumn("m", F.col("y0") + F.col("y1")), bins, [*names, "m"], F.col("member"),
                        [H.Spec(targets=(0, 1), rounds=1, learning_rate=1.0, max_leaf_nodes=None, min_samples_leaf=30, baseline=False),
                         H.Spec(targets=(2,), rounds=1, learning_rate=1.0, min_samples_leaf=30)], key=["id"])
    p = joint.predict(bins.apply(x.T))
    assert np.allclose(p[0], up) and np.allclose(p[1], -up) and (mean.trees[0].left >= 0).sum() == 0


def test_training_sets_null_targets_and_features(spark):
    x, y = _data(300, 8)
    members = np.where(np.arange(300) < 150, 1, 2) | np.where(np.arange(300) % 3 == 0, 4, 0)
    y[:20] = np.nan
    df, cols, names = _frame(spark, x, [y], members)
    bins = H.fit_bins(df, cols)
    base = dict(rounds=2, max_leaf_nodes=5, min_samples_leaf=8)
    got = H.fit(df, bins, names, F.col("member"), [H.Spec(train_set=0, **base), H.Spec(train_set=2, features=(1, 2), **base)], key=["id"])
    own = np.flatnonzero((members & 1 > 0) & ~np.isnan(y))
    spec = got[0].spec
    assert np.allclose(got[0].predict(bins.apply(x[own].T))[0], Direct(x[own], bins, spec).fit(y[own]), atol=1e-8)
    assert {int(f) for t in got[1].trees for f, left in zip(t.feature, t.left) if left >= 0} <= {1, 2}
    with pytest.raises(ValueError):
        H.fit(df, bins, names, F.col("member"), [H.Spec(train_set=9, **base)])
    with pytest.raises(ValueError):
        H.fit(df.withColumn("y0", -F.abs("y0")), bins, names, F.col("member"), [H.Spec(loss="gamma", **base)])


def test_bootstrap_is_poisson_and_layout_free():
    seed = np.random.default_rng(0).integers(0, 2**63, 20_000).astype(np.uint64)
    c = H._row_counts(seed, 3)
    assert abs(c.mean() - 1) < 0.03 and abs(c.var() - 1) < 0.05 and not np.array_equal(c, H._row_counts(seed, 4))


def test_bins(spark):
    df = spark.createDataFrame([(float(i % 5), float(i), None, float("nan") if i % 2 else 1.0) for i in range(1000)], "a double, b double, c double, d double")
    b = H.fit_bins(df, ["a", "b", "c", "d"], 32)
    assert list(b.cuts[0]) == [0.5, 1.5, 2.5, 3.5] and 25 <= b.cuts[1].size <= 31 and b.cuts[2].size == 0 and b.cuts[3].size == 0
    got = b.apply(np.array([[0.5, 4.0, np.nan], [np.nan, -1.0, 1e9], [np.nan] * 3, [1.0, np.nan, 2.0]]))
    assert got.tolist() == [[0, 4, 255], [255, 0, b.cuts[1].size], [255, 255, 255], [0, 255, 0]]
