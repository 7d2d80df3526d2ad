"""Deterministic seasonal-naive predictor (#139) and the back-test
prediction tables it feeds.  Because its predictions are plain lags, every
evaluation operator downstream has an exact SQL oracle."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.operators import windows as W
from tempora.plans.grid_spec import GridSpec
from tempora.plans.split import TimeSplit


def naive_long(series: DataFrame, grid: GridSpec, keys=None, value: str = "load_mw",
               season: int = 24, horizons: Sequence[int] = range(1, 25), warmup: int = 168,
               iqr_window: int = 24, block_size: int = W.DEFAULT_BLOCK) -> DataFrame:
    """Long table ``(keys…, prediction_time, split_pos, horizon, load_mw,
    predicted_load_mw, lower, upper)`` for every prediction time.

    truth(t, h) = y(t+h); prediction = y(t+h-season); interval = prediction
    ± rolling nearest IQR over the ``iqr_window`` values up to t.  One window
    pass (halo blocks) computes all of it; the wide row is unpivoted with
    ``inline`` (no join)."""
    ks = W._keys(keys)
    hs = list(horizons)
    specs = [W.lead_spec(value, h, f"_y{h}") for h in hs]
    for h in hs:
        d = h - season
        if d > 0:
            specs.append(W.lead_spec(value, d, f"_p{h}"))
        elif d < 0:
            specs.append(W.lag_spec(value, -d, f"_p{h}"))
    specs.append(W.rolling_spec("_iqr", W.rolling_iqr(value, iqr_window), iqr_window))
    out = W.apply_specs(series, ks, "pos", specs, block_size)
    hi = grid.n - 1 - max(hs)
    out = out.where((F.col("pos") >= warmup) & (F.col("pos") <= hi))
    recs = F.array(*[F.struct(F.lit(h).cast("long").alias("horizon"), F.col(f"_y{h}").alias("load_mw"),
                              (F.col(f"_p{h}") if h != season else F.col(value)).alias("predicted_load_mw"))
                     for h in hs])
    long = out.select(*ks, F.col("time").alias("prediction_time"),
                      (F.col("pos") - warmup).alias("split_pos"), "_iqr", F.inline(recs))
    return (long.withColumn("lower", F.col("predicted_load_mw") - F.col("_iqr"))
                .withColumn("upper", F.col("predicted_load_mw") + F.col("_iqr"))
                .drop("_iqr"))


def hourly_split(grid: GridSpec, warmup: int = 168, max_horizon: int = 24,
                 k: int = 5, test_size: int = 72, gap: int = 24, max_train: int = 240) -> TimeSplit:
    """The back-test split on the hourly grid (FIXTURES §2)."""
    return TimeSplit(grid.n - warmup - max_horizon, k, test_size, gap, max_train)


def cv_predictions(series: DataFrame, grid: GridSpec, split: TimeSplit, keys=None,
                   horizons: Sequence[int] = range(1, 25), model: str = "seasonal_naive",
                   warmup: int = 168) -> DataFrame:
    """Out-of-fold predictions (#110 shape): test rows only, with fold ids."""
    long = naive_long(series, grid, keys, horizons=horizons, warmup=warmup)
    long = long.withColumn("fold_idx", split.test_fold(F.col("split_pos"))).where(F.col("fold_idx").isNotNull())
    return long.withColumn("model", F.lit(model))
