"""Feature-table builders (#100-#105d) — the public API of the engine.

All builders take and return lazy DataFrames.  The target block (lags,
rolling statistics, multi-horizon leads) is computed in **one** halo-block
window pass, so the feature table and the target table share one shuffle and
one sort; covariates are joined on time (broadcast only when the grid length
— a proven bound — is small, otherwise AQE decides).
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.functions import calendar as cal
from tempora.operators import windows as W
from tempora.plans.grid_spec import GridSpec

#: A hinted broadcast is at most so large: rows times columns of 8 bytes.
BROADCAST_MAX_BYTES = 64 << 20

# The reference's lag / window names for an hourly target.
HOURLY_LAGS = {"1h": 1, "2h": 2, "3h": 3, "1d": 24, "1w": 168}
HOURLY_MEDIANS = {"24h": 24, "7d": 168}
HOURLY_IQRS = {"24h": 24, "7d": 168}
TARGET_PATTERN = "{value}_horizon_{h}h"


def _keys(keys) -> list[str]:
    return W._keys(keys)


def target_series(obs: DataFrame, grid: GridSpec, keys=None, value: str = "load_mw",
                  interpolate: bool = True, block_size: int = W.DEFAULT_BLOCK) -> DataFrame:
    """Observations aligned on the full grid (left join, gaps → null) and
    interior gaps linearly interpolated (#102, #16, #63).

    Output: ``keys…, time, pos, value, was_null``.  ``obs`` is
    ``(keys…, time, value)`` already bucketed to the grid step.
    """
    ks = _keys(keys)
    spark = obs.sparkSession
    if ks:
        series = obs.select(*ks).distinct()
        full = grid.panel(series, ks)
    else:
        full = grid.frame(spark)
    aligned = full.join(obs, on=ks + ["time"], how="left")
    aligned = aligned.withColumn("pos", grid.pos("time")).withColumn(
        "was_null", F.col(value).isNull())
    if interpolate:
        aligned = W.interpolate_linear(aligned, ks, "pos", value, block_size=block_size)
    return aligned


def panel_series(obs: DataFrame, grid: GridSpec, keys, value: str = "load_mw",
                 block_size: int = W.DEFAULT_BLOCK) -> DataFrame:
    """:func:`target_series` of a panel, interpolated, for ``obs`` with one row a
    (keys, time), without a join to the grid: only observations are shuffled.  Each row
    finds the next known one of its series by a two-level block scan and generates the grid
    rows up to it; a row at position -1 of each series generates those before its first.
    A null key has no observations, as in the join."""
    ks = _keys(keys)
    pos, v = F.col("pos"), F.col("_v")
    known = (obs.withColumn("pos", grid.pos("time")).where(F.col(value).isNotNull() & F.col("pos").between(0, grid.n - 1))
             .dropna(subset=ks).select(*ks, "pos", F.col(value).alias("_v")))
    start = obs.select(*ks).distinct().select(*ks, F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("double").alias("_v"))
    w = Window.partitionBy(*ks, "_blk").orderBy("pos")
    here = F.struct(pos.alias("pos"), v.alias("v"))
    d = (known.unionByName(start).withColumn("_blk", F.floor(pos / F.lit(int(block_size))))
         .select("*", F.lead(here).over(w).alias("_next_in"), F.row_number().over(w).alias("_rn")))
    carry = d.where("_rn = 1").select(*ks, "_blk", F.lead(here).over(Window.partitionBy(*ks).orderBy("_blk")).alias("_carry"))
    d = d.drop("_rn").join(carry, on=ks + ["_blk"], how="left")
    nxt = F.coalesce("_next_in", "_carry")
    d = d.select(*ks, pos.alias("_at"), "_v", nxt.alias("_next"),
                 F.explode(F.sequence(pos, F.greatest(pos, F.coalesce(nxt["pos"], F.lit(grid.n)) - 1))).alias("pos")).where("pos >= 0")
    at, n = F.col("_at"), F.col("_next")
    filled = F.when(pos == at, v).when(v.isNotNull() & n.isNotNull(), v + (n["v"] - v) * (pos - at) / (n["pos"] - at))
    return d.select(*ks, grid.time(pos).alias("time"), filled.alias(value), "pos", (pos != at).alias("was_null"))


def lagged_block_specs(value: str = "load_mw", lags: Mapping[str, int] = HOURLY_LAGS,
                       medians: Mapping[str, int] = HOURLY_MEDIANS,
                       iqrs: Mapping[str, int] = HOURLY_IQRS, iqr_method: str = "nearest",
                       min_lag: int = 0) -> list[W.Spec]:
    """Specs of the lag + rolling block (#103).  ``min_lag`` shifts every
    feature by a system lag so only values available at prediction time are
    used (#105c)."""
    specs = [W.lag_spec(value, k + min_lag, f"{value}_lag_{n}") for n, k in lags.items()]
    specs += [W.rolling_spec(f"{value}_rolling_median_{n}", W.rolling_median(value, w, min_lag),
                             w, min_lag) for n, w in medians.items()]
    specs += [W.rolling_spec(f"{value}_iqr_{n}", W.rolling_iqr(value, w, iqr_method, min_lag),
                             w, min_lag) for n, w in iqrs.items()]
    return specs


def target_specs(value: str = "load_mw", horizons: Sequence[int] = range(1, 25),
                 pattern: str = TARGET_PATTERN) -> list[W.Spec]:
    """Multi-horizon targets ``value(t + h)`` (#105)."""
    return [W.lead_spec(value, h, pattern.format(value=value, h=h)) for h in horizons]


def lagged_block(series: DataFrame, keys=None, value: str = "load_mw",
                 specs: Sequence[W.Spec] | None = None,
                 block_size: int = W.DEFAULT_BLOCK) -> DataFrame:
    specs = list(specs) if specs is not None else lagged_block_specs(value)
    return W.apply_specs(series, _keys(keys), "pos", specs, block_size)


def exogenous_wide(long: DataFrame, cities: Sequence[str], variables: Sequence[str],
                   prefix: str = "weather", inner: bool = True) -> DataFrame:
    """Long ``(time, city, variable, value)`` → wide ``{prefix}_{var}_{city}``
    (#35, #100, #74).  One shuffle on ``time`` replaces the reference's loop
    of per-city joins; explicit pivot values avoid a distinct-values job.
    ``inner=True`` keeps only times where every city is present (inner-join
    meaning of the reference's star join)."""
    # a value that isn't listed is an error, not a row less
    listed = F.col("city").isin(list(cities)) & F.col("variable").isin(list(variables))
    keyed = long.where(F.when(F.coalesce(listed, F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("unlisted city or variable:"), "city", "variable")).cast("boolean")))
    aggs = [F.max(F.when((F.col("variable") == v) & (F.col("city") == c), F.col("value")))
            .alias(f"{prefix}_{v}_{c}") for v in variables for c in cities]
    # the set of cities per time is bounded by len(cities)
    wide = keyed.groupBy("time").agg(*aggs, F.size(F.collect_set("city")).alias("_nc"))
    if inner:
        wide = wide.where(F.col("_nc") == len(cities))
    return wide.drop("_nc")


def covariate_leads(cov: DataFrame, grid: GridSpec, horizons: Sequence[int] = (1, 24),
                    past: bool = False, block_size: int = W.DEFAULT_BLOCK,
                    fill: float | None = None) -> DataFrame:
    """``{c}_future_{h}h`` = covariate at ``t + h`` (#104), or with
    ``past=True`` ``{c}_past_{h}h`` = covariate at ``t - h`` (#105a).
    The covariate table is first aligned to the full grid (left join) so the
    row shift is a clock shift."""
    cols = [c for c in cov.columns if c != "time"]
    full = grid.frame(cov.sparkSession).join(cov, "time", "left").withColumn("pos", grid.pos("time"))
    if fill is not None:
        full = full.fillna(fill, subset=cols)
    if past:
        specs = [W.lag_spec(c, h, f"{c}_past_{h}h") for c in cols for h in horizons]
    else:
        specs = [W.lead_spec(c, h, f"{c}_future_{h}h") for c in cols for h in horizons]
    out = W.apply_specs(full, [], "pos", specs, block_size)
    return out.select("time", *[s.name for s in specs])


def calendar_leads(df: DataFrame, spark: SparkSession, grid: GridSpec,
                   horizons: Sequence[int] = (1, 24), time_col: str = "prediction_time",
                   past: bool = False) -> DataFrame:
    """Calendar columns at ``t ± h`` computed in place from the time itself —
    no join and no window.  Holiday membership uses the bounded holiday list."""
    if grid.integer_time:
        return df
    y0 = min(grid.start.year, grid.end.year) - 1
    y1 = max(grid.start.year, grid.end.year) + 1
    hol = cal.holiday_dates(spark, y0, y1)
    cols = []
    tag = "past" if past else "future"
    for name in ["cal_hour_of_day", "cal_day_of_week", "cal_day_of_year", "cal_year", "cal_is_holiday"]:
        for h in horizons:
            t = grid.shift(time_col, -h if past else h)
            lt = cal.local_time(t)
            expr = {"cal_hour_of_day": F.hour(lt), "cal_day_of_week": cal.iso_weekday(lt),
                    "cal_day_of_year": F.dayofyear(lt), "cal_year": F.year(lt),
                    "cal_is_holiday": F.to_date(lt).isin(hol)}[name]
            cols.append(expr.alias(f"{name}_{tag}_{h}h"))
    return df.select("*", *cols)


def maybe_broadcast(df: DataFrame, bound_rows: int) -> DataFrame:
    """Broadcast only when the size bound, known from construction (rows) and
    width, is small; otherwise leave the choice to AQE's runtime statistics."""
    return F.broadcast(df) if bound_rows * 8 * len(df.columns) <= BROADCAST_MAX_BYTES else df


def design_table(series: DataFrame, grid: GridSpec, keys=None, value: str = "load_mw",
                 lag_specs: Sequence[W.Spec] | None = None,
                 horizons: Sequence[int] = range(1, 25), warmup: int = 168,
                 block_size: int = W.DEFAULT_BLOCK) -> DataFrame:
    """Lags, rolling statistics and leads of the target in one window pass,
    restricted to the prediction range ``[warmup, n-1-max(h)]``."""
    specs = list(lag_specs if lag_specs is not None else lagged_block_specs(value))
    specs += target_specs(value, horizons)
    out = W.apply_specs(series, _keys(keys), "pos", specs, block_size)
    hi = grid.n - 1 - (max(horizons) if horizons else 0)
    return (out.where((F.col("pos") >= warmup) & (F.col("pos") <= hi))
               .withColumnRenamed("time", "prediction_time"))


def feature_table(series: DataFrame, grid: GridSpec, covariates: DataFrame | None = None,
                  keys=None, value: str = "load_mw", future_horizons: Sequence[int] = (1, 24),
                  horizons: Sequence[int] = range(1, 25), warmup: int = 168,
                  lag_specs: Sequence[W.Spec] | None = None, past_covariates: bool = False,
                  with_targets: bool = False, block_size: int = W.DEFAULT_BLOCK,
                  covariate_fill: float | None = None) -> DataFrame:
    """``build_features`` (#104): target block at ``prediction_time`` + covariates
    at ``prediction_time + h`` + calendar at ``prediction_time + h``."""
    ks = _keys(keys)
    spark = series.sparkSession
    d = design_table(series, grid, ks, value, lag_specs, horizons, warmup, block_size)
    feat_cols = [s.name for s in (lag_specs if lag_specs is not None else lagged_block_specs(value))]
    tcols = [s.name for s in target_specs(value, horizons)] if with_targets else []
    d = d.select(*ks, "prediction_time", value, *feat_cols, *tcols)
    if covariates is not None:
        leads = covariate_leads(covariates, grid, future_horizons, past_covariates, block_size,
                                covariate_fill)
        leads = leads.withColumnRenamed("time", "prediction_time")
        d = d.join(maybe_broadcast(leads, grid.n), "prediction_time", "inner")
    return calendar_leads(d, spark, grid, future_horizons, "prediction_time", past_covariates)


def target_table(series: DataFrame, grid: GridSpec, keys=None, value: str = "load_mw",
                 horizons: Sequence[int] = range(1, 25), warmup: int = 168,
                 block_size: int = W.DEFAULT_BLOCK) -> DataFrame:
    """``build_targets`` (#105): prediction_time, value, value at t+1 … t+H."""
    ks = _keys(keys)
    d = design_table(series, grid, ks, value, [], horizons, warmup, block_size)
    return d.select(*ks, "prediction_time", value,
                    *[s.name for s in target_specs(value, horizons)])


def sample_weight_mask(series: DataFrame, grid: GridSpec, keys=None, lookback: int = 168,
                       lookahead: int = 24, warmup: int = 168, max_horizon: int = 24,
                       block_size: int = W.DEFAULT_BLOCK) -> DataFrame:
    """Weight 0 for prediction times whose feature or target span touches an
    interpolated value, else 1 (#105b).  The table stays contiguous."""
    ks = _keys(keys)
    flag = F.col("was_null").cast("int")
    spec = W.Spec("_touch", lambda w: F.max(flag).over(w.rowsBetween(-lookback, lookahead)),
                  lookback=lookback, lookahead=lookahead)
    out = W.apply_specs(series, ks, "pos", [spec], block_size)
    hi = grid.n - 1 - max_horizon
    return (out.where((F.col("pos") >= warmup) & (F.col("pos") <= hi))
               .select(*ks, F.col("time").alias("prediction_time"),
                       F.when(F.col("_touch") == 1, 0.0).otherwise(1.0).alias("sample_weight")))


def inject_missing_blocks(series: DataFrame, keys=None, value: str = "load_mw",
                          block_len: int = 24, rate_per_mille: int = 100, seed: int = 7) -> DataFrame:
    """Null whole blocks of ``block_len`` steps chosen by the md5 of (series
    keys, block, seed) — robust-training augmentation (#105d)."""
    ks = _keys(keys)
    blk = F.floor(F.col("pos") / block_len)
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in ks], blk.cast("string"), F.lit(str(seed)))
    # the first 32 bits of the digest, shown as hexadecimal digits
    h = F.pmod(F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long"), F.lit(1000))
    return series.withColumn(value, F.when(h < rate_per_mille, F.lit(None).cast("double"))
                             .otherwise(F.col(value))).withColumn("injected", h < rate_per_mille)
