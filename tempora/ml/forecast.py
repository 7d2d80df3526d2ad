"""Recursive and direct prediction of several steps over rolling origins (#134,
#135, #137, C11).

Origins are rows, not a loop: every (series, origin) carries its last 30
values as an array; the only sequential part is the feedback over forecast
steps, which goes on within a batch of origins.  The lag-model features are
computed by the *same* definitions from the array state as from the training
windows (property tests check that they agree).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.ml import histogram as H
from tempora.ml import ridge as RG
from tempora.ml.splines import SplineModel, fit_splines
from tempora.operators import windows as W
from tempora.plans.split import TimeSplit
from tempora.session import materialize

N_LAGS, WINDOW = 30, 15


def lag_feature_names(n_lags: int = N_LAGS, window: int = WINDOW) -> list[str]:
    return ([f"lag{k}" for k in range(1, n_lags + 1)]
            + [f"rolling_mean_lag1_window_size{window}", f"rolling_std_lag1_window_size{window}",
               f"rolling_max_lag{window}_window_size{window}", f"rolling_min_lag{window}_window_size{window}"])


def window_specs(value: str = "y", n_lags: int = N_LAGS, window: int = WINDOW) -> list[W.Spec]:
    """Training-table form: lags 1..30, mean / std of y[t-15..t-1],
    max / min of y[t-29..t-15]."""
    specs = [W.lag_spec(value, k, f"lag{k}") for k in range(1, n_lags + 1)]
    specs += [W.rolling_spec(f"rolling_mean_lag1_window_size{window}", W.rolling_mean(value, window, 1), window, 1),
              W.rolling_spec(f"rolling_std_lag1_window_size{window}", W.rolling_std(value, window, 1), window, 1),
              W.rolling_spec(f"rolling_max_lag{window}_window_size{window}",
                             W.rolling_max(value, window, window), window, window),
              W.rolling_spec(f"rolling_min_lag{window}_window_size{window}",
                             W.rolling_min(value, window, window), window, window)]
    return specs


def array_features(hist: Column, n_lags: int = N_LAGS, window: int = WINDOW) -> list[Column]:
    """State-array form of the same features; ``hist`` holds the last
    ``n_lags`` values, oldest first."""
    recent = F.slice(hist, -window, window)                  # y[t-15..t-1]
    older = F.slice(hist, -(2 * window - 1), window)         # y[t-29..t-15]
    n = F.lit(float(window))
    mean = F.aggregate(recent, F.lit(0.0), lambda a, b: a + b) / n
    ss = F.aggregate(recent, F.lit(0.0), lambda a, b: a + (b - mean) * (b - mean))
    cols = [F.element_at(hist, -k).alias(f"lag{k}") for k in range(1, n_lags + 1)]
    cols += [mean.alias(f"rolling_mean_lag1_window_size{window}"),
             F.sqrt(ss / (n - 1)).alias(f"rolling_std_lag1_window_size{window}"),
             F.array_max(older).alias(f"rolling_max_lag{window}_window_size{window}"),
             F.array_min(older).alias(f"rolling_min_lag{window}_window_size{window}")]
    return cols


def lag_matrix(series: DataFrame, keys="series_id", value: str = "y") -> DataFrame:
    """Training matrix, incomplete rows dropped (#136)."""
    out = W.apply_specs(series, keys, "pos", window_specs(value))
    return out.dropna(subset=[value] + lag_feature_names())


def origins_table(series: DataFrame, n: int, keys="series_id", value: str = "y",
                  test_len: int = 300, chunk: int = 5, n_lags: int = N_LAGS) -> DataFrame:
    """One row per (series, origin) with the history array before it; ``_ok``
    tells whether the history is complete.  An origin with a gap in its
    history stays, and its forecasts are null."""
    hist = W.Spec("_hist", lambda w: F.collect_list(F.struct(F.col(value).cast("double").alias("v"))).over(w.rowsBetween(-n_lags, -1)),
                  lookback=n_lags)
    out = W.apply_specs(series, keys, "pos", [hist])
    first = n - test_len
    o = out.where((F.col("pos") >= first) & (F.col("pos") <= n - chunk)
                  & (F.pmod(F.col("pos") - first, F.lit(chunk)) == 0) & (F.size("_hist") == n_lags))
    values = F.transform("_hist", lambda s: s["v"])
    return o.select(*W._keys(keys), F.col("pos").alias("origin_pos"),
                    ((F.col("pos") - first) / chunk).cast("long").alias("origin"),
                    (~F.exists(values, lambda v: v.isNull())).alias("_ok"), values.alias("_hist"))


KINDS = {
    # the reference's settings: library defaults of boosting; 300 rows a leaf for tree and forest
    "boosted": {"rounds": 100, "max_leaf_nodes": 31, "min_samples_leaf": 20},
    "tree": {"rounds": 1, "learning_rate": 1.0, "max_leaf_nodes": None, "max_depth": 8, "min_samples_leaf": 300},
    "forest": {"rounds": 1, "learning_rate": 1.0, "max_leaf_nodes": None, "max_depth": 8, "min_samples_leaf": 300, "baseline": False},
}
FOREST_TREES = 100


@dataclass
class LagModel:
    """Predicts y[t] from the lag features of t: trees, or a ridge on cubic splines of each feature."""
    binning: H.Binning | None = None
    boosters: list[H.Booster] = field(default_factory=list)
    splines: SplineModel | None = None
    line: RG.Line | None = None

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Of a matrix rows x features."""
        if self.line is not None:
            return _splined(x, list(self.splines.bounds.values()), self.splines.n_knots) @ self.line.weights + self.line.intercept
        bins = self.binning.apply(x.T)
        return sum(b.predict(bins)[0] for b in self.boosters) / len(self.boosters)


def spline_values(x: np.ndarray, low: float, high: float, n_knots: int) -> np.ndarray:
    """rows x (n_knots + 2) values of the cubic B-splines on uniform knots,
    inputs clamped to the range (as the column form of the spline model)."""
    h = (high - low) / (n_knots - 1) if high > low else 1.0
    u = (np.clip(x, low, high)[:, None] - low) / h + 3 - np.arange(n_knots + 2)
    tent = lambda k: np.maximum(u - k, 0.0) ** 3
    return np.where((u >= 0) & (u < 4), tent(0) - 4 * tent(1) + 6 * tent(2) - 4 * tent(3), 0.0) / 6


def _splined(x: np.ndarray, bounds: list[tuple[float, float]], n_knots: int) -> np.ndarray:
    return np.concatenate([spline_values(x[:, i], *b, n_knots) for i, b in enumerate(bounds)], axis=1)


def fit_lag_model(train: DataFrame, label: str = "y", kind: str = "boosted", key: Sequence[str] = ("series_id", "pos"),
                  n_knots: int = 10, alpha: float = 1e-6, **settings) -> LagModel:
    """One-step model (#134, #138): ``boosted``, ``forest``, ``tree`` (settings of
    histogram trees) or ``ridge`` (splines with 10 knots, ridge 1e-6).  Forest trees see bootstrap rows
    and 80 % of the features each."""
    names = lag_feature_names()
    if kind == "ridge":
        splines = fit_splines(train, names, n_knots)
        wide = [f"{c}_sp_{j}" for c in names for j in range(splines.n_splines)]
        bounds = list(splines.bounds.values())
        grams = RG.fold_grams(train.withColumn("_at", F.lit(0)), TimeSplit(2, 1, 1), names, [label], "_at", lambda x: _splined(x, bounds, n_knots), wide)
        return LagModel(splines=splines, line=grams.fit(0, [alpha])[0])
    if kind not in KINDS:
        raise ValueError(f"unknown model kind {kind}")
    settings = {**KINDS[kind], **settings}
    specs = [H.Spec(**settings)]
    if kind == "forest":
        pick = np.random.default_rng(0)
        specs = [H.Spec(**settings, bootstrap=i, features=tuple(int(f) for f in np.sort(pick.permutation(len(names))[:round(0.8 * len(names))])))
                 for i in range(FOREST_TREES)]
    binning = H.fit_bins(train, names)
    return LagModel(binning, H.fit(train, binning, [label], F.lit(1).cast("long"), specs, key=list(key)))


def state_features(hist: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The features of :func:`array_features` for a matrix rows x N_LAGS of histories, oldest first."""
    recent, older = hist[:, -window:], hist[:, -(2 * window - 1):-(window - 1)]
    return np.column_stack([hist[:, ::-1], recent.mean(axis=1), recent.std(axis=1, ddof=1), older.max(axis=1), older.min(axis=1)])


def recursive_forecast(origins: DataFrame, model: LagModel, horizon: int = 60) -> DataFrame:
    """Feed each step's prediction back into the state (#134).  Origins don't
    depend on each other, so one pass goes through all steps, a batch of origins at a time."""
    keys = [c for c in origins.columns if c not in ("origin_pos", "origin", "_ok", "_hist")]
    schema = origins.select(*keys, "origin_pos", "origin", "_ok", F.array().cast("array<double>").alias("_preds")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hist = np.array(b.column("_hist").to_pylist(), float).reshape(b.num_rows, -1)
            steps = []
            for _ in range(horizon):
                with np.errstate(all="ignore"):
                    p = model.predict(state_features(hist))
                steps.append(p)
                hist = np.concatenate([hist[:, 1:], p[:, None]], axis=1)
            preds = pa.array(np.stack(steps, axis=1).tolist(), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in (*keys, "origin_pos", "origin", "_ok")], preds], [*keys, "origin_pos", "origin", "_ok", "_preds"])

    return origins.mapInArrow(run, schema).select(*keys, "origin_pos", "origin", "_ok", F.posexplode("_preds").alias("_h", "y_hat")) \
        .select(*keys, "origin", (F.col("_h") + 1).alias("horizon"),
                (F.col("origin_pos") + F.col("_h")).alias("pos"), F.when(F.col("_ok"), F.col("y_hat")).alias("y_hat"))


def direct_forecast(series: DataFrame, origins: DataFrame, n: int, horizons: Sequence[int],
                    keys="series_id", value: str = "y", test_len: int = 300, max_bins: int = 64, **settings) -> DataFrame:
    """One boosted model per horizon h on the same lag block, target
    ``y[t+h-1]`` (#135, #129), all fitted in one run.  A target that lies in the test part is
    null, so each horizon trains on the rows whose future is known."""
    ks = W._keys(keys)
    specs = window_specs(value) + [W.lead_spec(value, h - 1, f"_t{h}") if h > 1 else
                                   W.Spec(f"_t{h}", lambda w, v=value: F.col(v)) for h in horizons]
    names, targets = lag_feature_names(), [f"_t{h}" for h in horizons]
    mat = W.apply_specs(series, ks, "pos", specs).dropna(subset=names)
    mat = materialize(mat.select(*ks, "pos", *names, *[F.when(F.col("pos") + h - 1 < n - test_len, F.col(f"_t{h}")).alias(f"_t{h}") for h in horizons]), "direct-train")
    binning = H.fit_bins(mat, names, max_bins)
    models = H.fit(mat, binning, targets, F.lit(1).cast("long"), [H.Spec(targets=(i,), **{**KINDS["boosted"], **settings}) for i in range(len(targets))], key=[*ks, "pos"])
    feats = origins.select(*ks, "origin", "origin_pos", "_ok", *array_features(F.col("_hist")))
    got = H.predict(feats, binning, models, [*ks, "origin", "origin_pos", "_ok"])
    ahead = F.get(F.array(*[F.lit(h) for h in horizons]), F.col("_i"))
    return got.select("*", F.posexplode("predictions").alias("_i", "_p")).select(
        *ks, "origin", ahead.alias("horizon"), (F.col("origin_pos") + ahead - 1).alias("pos"), F.when(F.col("_ok"), F.col("_p")).alias("y_hat"))
