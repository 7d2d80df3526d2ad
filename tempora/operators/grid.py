"""Time grids and alignment of observations to a grid (#12-#16)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.timecols import (
    from_micros_value, step_seconds, time_at, to_micros_value,
)

# Rows per generated chunk when a series grid is exploded from arrays: keeps
# any one generated array small even for very long series.
_CHUNK = 8192


def time_bounds(df: DataFrame, time_col: str):
    """(min, max) of a time column — one tiny aggregate job, two scalars back."""
    row = df.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).first()
    return row["lo"], row["hi"]


def n_steps(start, end, step, inclusive: str = "both", integer_time: bool = False) -> int:
    """Number of grid points between start and end."""
    if integer_time:
        span = (int(end) - int(start)) // int(step)
    else:
        span = (to_micros_value(end) - to_micros_value(start)) // (step_seconds(step) * 1_000_000)
    return int(span) + (1 if inclusive == "both" else 0)


def time_grid(spark: SparkSession, start, end, step="1 hour", time_col: str = "time",
              inclusive: str = "both", integer_time: bool = False) -> DataFrame:
    """Regular grid ``[start, end]`` (``inclusive='both'``) or ``[start, end)``
    (``inclusive='left'``).  Generated with ``spark.range`` so it is split over
    tasks, never materialised on the driver."""
    n = n_steps(start, end, step, inclusive, integer_time)
    return spark.range(0, max(n, 0)).select(
        time_at(F.col("id"), start, step, integer_time).alias(time_col))


def panel_grid(series: DataFrame, key_cols, start, end, step="1 hour", time_col="time",
               inclusive: str = "both", integer_time: bool = False) -> DataFrame:
    """One grid per series key.  ``series`` holds the distinct keys; each key
    generates its own rows (chunked arrays) — a generator, not a join."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    n = n_steps(start, end, step, inclusive, integer_time)
    n_chunks = max(1, math.ceil(n / _CHUNK))
    chunk = F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("_chunk")
    pos = F.explode(F.sequence(F.col("_chunk") * _CHUNK,
                               F.least(F.col("_chunk") * _CHUNK + _CHUNK, F.lit(n)) - 1)).alias("_pos")
    return (series.select(*keys).select(*keys, chunk)
            .select(*keys, pos)
            .select(*keys, time_at(F.col("_pos"), start, step, integer_time).alias(time_col)))


def prediction_bounds(start, end, warmup_steps: int, max_horizon: int, step="1 hour",
                      integer_time: bool = False):
    """Prediction range: ``start + warmup`` … ``end - max_horizon`` (#14)."""
    if integer_time:
        return int(start) + warmup_steps * int(step), int(end) - max_horizon * int(step)
    s = step_seconds(step) * 1_000_000
    return (from_micros_value(to_micros_value(start) + warmup_steps * s),
            from_micros_value(to_micros_value(end) - max_horizon * s))


def prediction_grid(spark: SparkSession, start, end, warmup_steps: int = 168,
                    max_horizon: int = 24, step="1 hour", time_col="prediction_time",
                    integer_time: bool = False) -> DataFrame:
    lo, hi = prediction_bounds(start, end, warmup_steps, max_horizon, step, integer_time)
    return time_grid(spark, lo, hi, step, time_col, "both", integer_time)


def preview_head(df: DataFrame, order_col: str, n: int = 1000) -> DataFrame:
    """Preview subsample: first ``n`` rows in time order (#15).  Only for
    interactive previews — a limit is the feature here."""
    return df.orderBy(order_col).limit(n)


def align(grid: DataFrame, obs: DataFrame, on, how: str = "left") -> DataFrame:
    """Align observations to a grid (#16).  ``how='inner'`` keeps the
    reference's inner-join behaviour (hours without data vanish);
    ``how='left'`` exposes gaps as nulls so row shift = clock shift."""
    if how not in ("left", "inner"):
        raise ValueError("how must be 'left' or 'inner'")
    return grid.join(obs, on=on, how=how)
