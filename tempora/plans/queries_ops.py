"""Registered queries, part 2: sources / sinks, projections, joins,
aggregates, panel window operators, lag-model features, rolling origin and
target binning.  SQL twins in :mod:`tempora.plans.oracle_ops`."""

from __future__ import annotations

import fnmatch
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions import calendar as cal
from tempora.functions.timecols import shift_time
from tempora.operators import joins as J
from tempora.operators import ranks as R
from tempora.operators import windows as W
from tempora.operators.grid import preview_head
from tempora.plans import common as C
from tempora.plans import evaluate as EV
from tempora.plans import features as FT
from tempora.plans import predictors as PR
from tempora.session import materialize, scratch_path
from tempora.sources import files as FS
from tempora.sources import tables as S

N = C.normalize

# Daily lag / window names used for day-step targets.
DAILY_LAGS = {"1d": 1, "2d": 2, "7d": 7}
DAILY_MEDIANS = {"7d": 7, "28d": 28}
DAILY_IQRS = {"7d": 7, "28d": 28}
DAILY_HORIZONS = range(1, 8)


def _scratch(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


# ------------------------------------------------------------ sources / sinks

def q_scan_parquet(spark, sf_dir):
    df = S.scan_parquet(spark, S.table_path(sf_dir, "events"), ["event_id", "ts", "event_type", "value"],
                        source_col="_file")
    return N(df.select("event_id", "ts", "event_type", "value",
                       F.regexp_replace("_file", r"\.parquet$", "").alias("source")))


def q_literal_table(spark, sf_dir):
    # Display names of the three covariate "cities".
    names = spark.createDataFrame([("a", "Alpha"), ("n", "Nord"), ("r", "Rive")], "city string, city_name string")
    ex = S.exogenous_long(spark, sf_dir).where(F.col("variable") == "quantity")
    agg = ex.groupBy("city").agg(F.count("*").alias("n_days"), F.avg("value").alias("mean_quantity"))
    return N(agg.join(F.broadcast(names), "city"))


def q_explode_payload(spark, sf_dir):
    obs = S.hourly_events(spark, sf_dir)
    return N(FS.explode_payload(FS.payload_table(obs)))


def q_explode_payload_arrays(spark, sf_dir):
    """Six parallel arrays a day (hourly sum and counts by event type) → rows."""
    hourly = S.hourly_events(spark, sf_dir).join(C.events_covariates(spark, sf_dir, None), "time")
    cols = ["load_mw", *[f"weather_n_events_{e}" for e in C.EVENT_TYPES]]
    return N(FS.explode_arrays(FS.payload_arrays(hourly, cols), cols))


def q_scan_load_csv(spark, sf_dir):
    h = C.hourly(spark, sf_dir, interpolate=False)
    path = _scratch(spark, "load-csv")
    FS.write_load_csv(h.series, path)
    return N(FS.scan_load_csv(spark, path))


def q_sink_idempotent(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    path = _scratch(spark, "sink")
    tbl = h.series.select("time", "load_mw", F.to_date("time").alias("day"))
    FS.write_idempotent(tbl, path, "day")
    FS.write_idempotent(tbl, path, "day")  # path present → the second write is skipped
    return N(spark.read.parquet(path).select("time", "load_mw"))


def q_save_load_features(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    cov = C.events_covariates(spark, sf_dir, h.grid)
    path = _scratch(spark, "features")
    FS.save_feature_state(FT.feature_table(h.series, h.grid, cov, covariate_fill=0.0), path,
                          {"start": h.grid.start, "end": h.grid.end, "future_horizons": [1, 24]})
    table, params = FS.load_feature_state(spark, path)
    assert params["future_horizons"] == [1, 24]
    return N(table)


def q_list_inputs(spark, sf_dir):
    df = S.read_table(spark, sf_dir, "events", ["event_id"])
    return FS.list_inputs(df).select(F.regexp_extract("file_path", r"([^/]+)$", 1).alias("file_name"))


def q_prediction_grid(spark, sf_dir):
    grid = C.hourly_grid(spark, sf_dir)
    from tempora.operators.grid import prediction_grid
    return N(prediction_grid(spark, grid.start, grid.end, 168, 24))


def q_preview_head(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    return N(preview_head(h.series.select("time", "load_mw"), "time", 100))


# ------------------------------------------------------- projections / filters

def _exo_wide(spark, sf_dir, inner=True):
    return FT.exogenous_wide(S.exogenous_long(spark, sf_dir), C.RETURN_FLAGS,
                             [v.removeprefix("l_") for v in S.EXOGENOUS_VARS], inner=inner)


def q_star_covariates(spark, sf_dir):
    return N(_exo_wide(spark, sf_dir))


def q_exogenous_wide(spark, sf_dir):
    """Weather-like covariates with leads at +1 and +7 days (#100)."""
    # written once: its bounds and both leads read it
    wide = materialize(_exo_wide(spark, sf_dir), "exo-wide")
    from tempora.plans.grid_spec import GridSpec
    g = GridSpec.from_data(wide, "time", "1 day")
    return N(FT.covariate_leads(wide, g, (1, 7)).join(wide, "time"))


def q_rename_covariates(spark, sf_dir):
    wide = _exo_wide(spark, sf_dir)
    return N(wide.select("time", *[F.col(c).alias(c.replace("weather_", "cov_") + "_daily")
                                   for c in wide.columns if c != "time"]))


def q_select_glob(spark, sf_dir):
    wide = _exo_wide(spark, sf_dir)
    cols = fnmatch.filter(wide.columns, "weather_quantity_*")
    return N(wide.select("time", *cols))


def q_select_glob_diff(spark, sf_dir):
    wide = _exo_wide(spark, sf_dir)
    keep = set(fnmatch.filter(wide.columns, "weather_*")) - set(fnmatch.filter(wide.columns, "weather_*_r"))
    return N(wide.select("time", *[c for c in wide.columns if c in keep]))


def q_null_audit(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir, interpolate=False)
    return N(p.series.where(F.col("load_mw").isNull()).select("series_id", "time"))


def q_filter_open_interval(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    a, b = h.grid.at(100), h.grid.at(200)
    t = F.col("time")
    return N(h.series.where((t > F.lit(a).cast("timestamp_ntz")) & (t < F.lit(b).cast("timestamp_ntz")))
             .select("time", "load_mw"))


def q_filter_closed_right(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    a, b = h.grid.at(100), h.grid.at(200)
    t = F.col("time")
    return N(h.series.where((t > F.lit(a).cast("timestamp_ntz")) & (t <= F.lit(b).cast("timestamp_ntz")))
             .select("time", "load_mw"))


def q_high_iqr_dates(spark, sf_dir):
    """Dates whose 7-day rolling IQR exceeds the 90th percentile of that IQR (#28), in order."""
    h = C.hourly(spark, sf_dir)
    lb = FT.lagged_block(h.series).select("time", "load_mw_iqr_7d")
    thr = R.linear_quantiles(lb, [], "load_mw_iqr_7d", {"thr": 0.9}).first()["thr"]  # one scalar
    return N(lb.where(F.col("load_mw_iqr_7d") > F.lit(thr)).select(F.to_date("time").alias("date")).distinct().orderBy("date"))


def q_holiday_flag(spark, sf_dir):
    d = C.daily(spark, sf_dir, interpolate=False)
    g = d.grid.frame(spark)
    return N(cal.with_holiday_flag(g, spark, "time", out_col="is_holiday"))


# ------------------------------------------------------------------ joins

def q_join_inner(spark, sf_dir):
    h = C.hourly(spark, sf_dir, interpolate=False)
    cov = C.events_covariates(spark, sf_dir, h.grid)
    return N(h.obs.join(cov, "time", "inner"))


def q_join_renamed_key(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    from tempora.operators.grid import prediction_grid
    pg = prediction_grid(spark, h.grid.start, h.grid.end, 168, 24)
    lb = FT.lagged_block(h.series).select("time", "load_mw", "load_mw_lag_1d", "load_mw_lag_1w")
    return N(J.join_renamed_key(pg, lb, "prediction_time", "time"))


def q_join_left_composite(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir, interpolate=False)
    return N(p.series.select("series_id", "time", "pos").join(
        p.obs.withColumnRenamed("load_mw", "observed"), ["series_id", "time"], "left"))


def q_join_back_agg(spark, sf_dir):
    cv = PR.cv_predictions(*_hourly_parts(spark, sf_dir), horizons=[24])
    r = cv.withColumn("residual", F.col("predicted_load_mw") - F.col("load_mw"))
    m = r.groupBy("fold_idx").agg(F.avg("residual").alias("fold_mean_residual"))
    return N(r.join(F.broadcast(m), "fold_idx")
             .select("fold_idx", "prediction_time", "residual", "fold_mean_residual",
                     (F.col("residual") - F.col("fold_mean_residual")).alias("centered_residual")))


def _hourly_parts(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    return h.series, h.grid, PR.hourly_split(h.grid)


def q_concat_quantiles(spark, sf_dir):
    cv = PR.cv_predictions(*_hourly_parts(spark, sf_dir), horizons=[24])
    keys = ["fold_idx", "prediction_time"]
    # rename by mapping (#19), then key-based horizontal concat (#39)
    frames = {"lo": cv.select(*keys, "lower").withColumnsRenamed({"lower": "predicted_load_mw_q05"}),
              "mid": cv.select(*keys, "predicted_load_mw")
                       .withColumnsRenamed({"predicted_load_mw": "predicted_load_mw_q50"}),
              "hi": cv.select(*keys, "upper", "load_mw").withColumnsRenamed({"upper": "predicted_load_mw_q95"})}
    return N(J.concat_by_key(frames, keys))


def q_asof_available(spark, sf_dir):
    """Last event value per type available at each hour with a 3 h system lag."""
    grid = C.hourly_grid(spark, sf_dir)
    ev = S.read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"]) \
          .withColumnRenamed("event_type", "series_id")
    series = ev.select("series_id").distinct()
    g = grid.panel(series, "series_id", "prediction_time")
    out = J.asof_available(g, ev, "series_id", "prediction_time", "ts", ["value", "event_id"], "event_id",
                           system_lag_us=3 * 3_600_000_000, grid_step_us=3_600_000_000)
    return N(out)


# ------------------------------------------------------------ aggregates

def _li(spark, sf_dir):
    return S.read_table(spark, sf_dir, "lineitem", ["l_returnflag", "l_linestatus", "l_quantity",
                                                      "l_extendedprice", "l_discount", "l_tax"])


def q_group_mean(spark, sf_dir):
    return N(_li(spark, sf_dir).groupBy("l_returnflag", "l_linestatus").agg(
        F.avg("l_quantity").alias("mean_quantity"), F.avg("l_extendedprice").alias("mean_price")))


def q_group_std(spark, sf_dir):
    return N(_li(spark, sf_dir).groupBy("l_returnflag", "l_linestatus").agg(
        F.stddev_samp("l_quantity").alias("std_quantity"), F.stddev_samp("l_extendedprice").alias("std_price")))


def q_group_quantile_linear(spark, sf_dir):
    li = _li(spark, sf_dir)
    return N(R.linear_quantiles(li, ["l_returnflag"], "l_extendedprice",
                                {f"q{int(q * 100)}": q for q in (0.1, 0.5, 0.9)}))


def q_group_quantile_nearest(spark, sf_dir):
    li = _li(spark, sf_dir)
    return N(R.nearest_quantiles(li, ["l_returnflag"], "l_extendedprice",
                                 {f"q{int(q * 100)}": q for q in (0.1, 0.5, 0.9)}))


def q_five_number_summary(spark, sf_dir):
    return N(EV.five_number_summary(_li(spark, sf_dir), ["l_returnflag"], "l_extendedprice"))


PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_long(spark, sf_dir):
    return _li(spark, sf_dir).unpivot([], PROFILE_COLS, "column", "value")


def q_profile_columns(spark, sf_dir):
    """Column profile (#53): counts, nulls, exact distinct, moments, quantiles.

    Moments come from one declarative aggregate over the long table; exact
    distinct counts from the map-side pre-aggregated ``(column, value)``
    table; exact quantiles from bucketed rank selection."""
    long = _profile_long(spark, sf_dir)
    mom = long.groupBy("column").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("value").isNull().cast("long")).alias("n_null"),
        F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    nd = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("_c")) \
             .groupBy("column").agg(F.count("*").alias("n_distinct"))
    qs = R.linear_quantiles(long, ["column"], "value", {"q25": 0.25, "median": 0.5, "q75": 0.75})
    out = mom.join(nd, "column").join(qs, "column").select(
        "column", "n_rows", "n_null", "n_distinct", "mean", "std", "min", "q25", "median", "q75", "max")
    return N(out)


def top_k_per_group(counts: DataFrame, keys, value: str, count: str, k: int, n_buckets: int = 64) -> DataFrame:
    """Exact top-k by ``(count desc, value asc)`` per group in two levels:
    top-k inside hash buckets of the value (each bucket a small window),
    then top-k over the ≤ k·n_buckets winners per group."""
    from pyspark.sql import Window
    ks = [keys] if isinstance(keys, str) else list(keys)
    order = [F.col(count).desc(), F.col(value).asc()]
    b = counts.withColumn("_hb", F.pmod(F.xxhash64(value), F.lit(n_buckets)))
    local = b.withColumn("_r", F.row_number().over(Window.partitionBy(*ks, "_hb").orderBy(*order))) \
             .where(F.col("_r") <= k)
    top = local.withColumn("rank", F.row_number().over(Window.partitionBy(*ks).orderBy(*order)))
    return top.where(F.col("rank") <= k).drop("_hb", "_r")


def q_profile_top_values(spark, sf_dir, k: int = 5):
    """Most frequent values per profiled column (#53); a top-k report, so
    the limit is the feature.  Ties go to the smaller value."""
    long = _profile_long(spark, sf_dir)
    vc = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count("*").alias("n"))
    return N(top_k_per_group(vc, "column", "value", "n", k).select("column", "rank", "value", "n"))


def q_profile_histogram(spark, sf_dir, n_bins: int = 10):
    long = _profile_long(spark, sf_dir)
    mm = long.groupBy("column").agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    j = long.join(F.broadcast(mm), "column")  # one row per profiled column
    b = F.least(F.floor((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * n_bins),
                F.lit(n_bins - 1))
    return N(j.groupBy("column", b.alias("bucket")).agg(F.count("*").alias("n")))


# ------------------------------------------------------ panel window operators

def _panel(spark, sf_dir):
    return C.hourly_panel(spark, sf_dir).series


def _panel_specs(spark, sf_dir, specs):
    return W.apply_specs(_panel(spark, sf_dir), "series_id", "pos", specs)


def q_lag_features(spark, sf_dir):
    specs = [W.lag_spec("load_mw", k, f"load_mw_lag_{k}") for k in (1, 2, 24)]
    return N(_panel_specs(spark, sf_dir, specs).select("series_id", "time", *[s.name for s in specs]))


def q_lead_features(spark, sf_dir):
    specs = [W.lead_spec("load_mw", k, f"load_mw_lead_{k}") for k in (1, 24)]
    return N(_panel_specs(spark, sf_dir, specs).select("series_id", "time", *[s.name for s in specs]))


def q_rolling_median(spark, sf_dir):
    specs = [W.rolling_spec("rolling_median_24", W.rolling_median("load_mw", 24), 24)]
    return N(_panel_specs(spark, sf_dir, specs).select("series_id", "time", "rolling_median_24"))


def q_rolling_quantile(spark, sf_dir):
    specs = [W.rolling_spec("rolling_q90_nearest", W.rolling_quantile("load_mw", 0.9, 24, "nearest"), 24),
             W.rolling_spec("rolling_q90_linear", W.rolling_quantile("load_mw", 0.9, 24, "linear"), 24)]
    return N(_panel_specs(spark, sf_dir, specs).select("series_id", "time", *[s.name for s in specs]))


def q_rolling_iqr(spark, sf_dir):
    specs = [W.rolling_spec("iqr_168", W.rolling_iqr("load_mw", 168), 168)]
    return N(_panel_specs(spark, sf_dir, specs).select("series_id", "time", "iqr_168"))


def lag_model_specs(value: str = "y", n_lags: int = 30, window: int = 15) -> list[W.Spec]:
    """Lag-model features (C11): lags 1..30; mean / std over y[t-15..t-1];
    max / min over y[t-29..t-15]."""
    specs = [W.lag_spec(value, k, f"lag{k}") for k in range(1, n_lags + 1)]
    specs += [W.rolling_spec(f"rolling_mean_lag1_window_size{window}", W.rolling_mean(value, window, 1), window, 1),
              W.rolling_spec(f"rolling_std_lag1_window_size{window}", W.rolling_std(value, window, 1), window, 1),
              W.rolling_spec(f"rolling_max_lag{window}_window_size{window}",
                             W.rolling_max(value, window, window), window, window),
              W.rolling_spec(f"rolling_min_lag{window}_window_size{window}",
                             W.rolling_min(value, window, window), window, window)]
    return specs


def _lag_model(spark, sf_dir, names=None):
    specs = lag_model_specs("load_mw")
    if names:
        specs = [s for s in specs if s.name in names]
    return _panel_specs(spark, sf_dir, specs), [s.name for s in specs]


def q_lag_block(spark, sf_dir):
    df, names = _lag_model(spark, sf_dir, [f"lag{k}" for k in range(1, 31)])
    return N(df.select("series_id", "time", *names))


def q_rolling_mean_lagged(spark, sf_dir):
    df, names = _lag_model(spark, sf_dir, ["rolling_mean_lag1_window_size15"])
    return N(df.select("series_id", "time", *names))


def q_rolling_std_lagged(spark, sf_dir):
    df, names = _lag_model(spark, sf_dir, ["rolling_std_lag1_window_size15"])
    return N(df.select("series_id", "time", *names))


def q_rolling_minmax_lagged(spark, sf_dir):
    df, names = _lag_model(spark, sf_dir, ["rolling_max_lag15_window_size15", "rolling_min_lag15_window_size15"])
    return N(df.select("series_id", "time", *names))


def q_lag_matrix(spark, sf_dir):
    """Training matrix of the lag model, incomplete rows dropped (#136)."""
    df, names = _lag_model(spark, sf_dir)
    return N(df.select("series_id", "time", F.col("load_mw").alias("y"), *names).dropna())


def q_difference(spark, sf_dir):
    specs = [W.Spec("diff_1", W.difference("load_mw", 1), lookback=1),
             W.Spec("diff_24", W.difference("load_mw", 24), lookback=24)]
    return N(_panel_specs(spark, sf_dir, specs).select("series_id", "time", "diff_1", "diff_24"))


def q_panel_lagged_block(spark, sf_dir):
    """Big panel (lineitem daily quantity by supplier): daily lag block."""
    obs = materialize(S.supplier_daily_panel(spark, sf_dir), "supplier-obs")
    from tempora.plans.grid_spec import GridSpec
    g = GridSpec.from_data(obs, "time", "1 day")
    s = FT.panel_series(obs, g, "series_id").select("series_id", "pos", "load_mw")
    specs = FT.lagged_block_specs("load_mw", DAILY_LAGS, DAILY_MEDIANS, DAILY_IQRS)
    return N(FT.lagged_block(s, "series_id", specs=specs).select(
        "series_id", g.time(F.col("pos")).alias("time"), "load_mw", *[x.name for x in specs]))


def q_holdout_split(spark, sf_dir):
    """Positional hold-out cut per series: the last 20 % of the grid is test (#69)."""
    p = C.hourly_panel(spark, sf_dir)
    cut = int(p.grid.n * 0.8)
    return N(p.series.groupBy("series_id", F.when(F.col("pos") >= cut, "test").otherwise("train").alias("role"))
             .agg(F.count("*").alias("n_rows"), F.min("time").alias("first_time"), F.max("time").alias("last_time")))


# ------------------------------------------------------------ scalar functions

def q_calendar_fields(spark, sf_dir):
    ev = S.read_table(spark, sf_dir, "events", ["event_id", "ts"])
    lt = cal.local_time("ts")
    return N(ev.select("event_id", F.hour("ts").alias("hour"), cal.iso_weekday("ts").alias("iso_weekday"),
                       F.dayofyear("ts").alias("day_of_year"), F.year("ts").alias("year"),
                       F.month("ts").alias("month"), F.to_date("ts").alias("date"),
                       F.date_format("ts", "yyyy-MM-dd").alias("date_text"),
                       F.hour(lt).alias("local_hour")))


def q_string_parse(spark, sf_dir):
    g = C.hourly_grid(spark, sf_dir).frame(spark)
    text = F.concat_ws(" - ", F.date_format("time", FS.TIME_RANGE_FORMAT),
                       F.date_format(shift_time("time", 1, "1 hour"), FS.TIME_RANGE_FORMAT))
    parsed = F.to_timestamp(F.split(text, " - ").getItem(0), FS.TIME_RANGE_FORMAT).cast("timestamp_ntz")
    return N(g.select("time", text.alias("text"), parsed.alias("parsed")))


def q_label_format(spark, sf_dir):
    ev = S.read_table(spark, sf_dir, "events", ["event_type", "value"])
    g = ev.groupBy("event_type").agg(F.avg("value").alias("_m"), F.count("*").alias("_n"))
    return g.select("event_type", F.initcap("event_type").alias("title"), F.upper("event_type").alias("upper"),
                    F.replace("event_type", F.lit("_"), F.lit(" ")).alias("replaced"),
                    F.format_string("%s: %.4f (n=%d)", F.initcap("event_type"), "_m", "_n").alias("label"))


def q_digitize(spark, sf_dir):
    """Value → bin by left edges (#84): order prices against fixed edges."""
    o = S.read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    edges = [0.0, 50_000.0, 100_000.0, 200_000.0, 300_000.0]
    e = F.array(*[F.lit(v) for v in edges])
    b = F.size(F.filter(e, lambda x: x <= F.col("o_totalprice"))) - 1
    return N(o.groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.min("o_totalprice").alias("min_price")))


# ------------------------------------------------------------ builders

def q_feature_table_past(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    cov = C.events_covariates(spark, sf_dir, h.grid)
    return N(FT.feature_table(h.series, h.grid, cov, past_covariates=True, covariate_fill=0.0))


def q_feature_table_daily(spark, sf_dir):
    """Daily target (orders) + lineitem covariates at +1 / +7 days + calendar."""
    d = C.daily(spark, sf_dir)
    wide = _exo_wide(spark, sf_dir, inner=False)
    specs = FT.lagged_block_specs("load_mw", DAILY_LAGS, DAILY_MEDIANS, DAILY_IQRS)
    return N(FT.feature_table(d.series, d.grid, wide, future_horizons=(1, 7), horizons=DAILY_HORIZONS,
                              warmup=28, lag_specs=specs))


def q_sample_weight_mask(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir)
    return N(FT.sample_weight_mask(p.series, p.grid, "series_id"))


def q_lag_safe_features(spark, sf_dir, system_lag: int = 3):
    h = C.hourly(spark, sf_dir)
    specs = FT.lagged_block_specs(min_lag=system_lag)
    out = FT.lagged_block(h.series, specs=specs)
    return N(out.select("time", *[s.name for s in specs]))


def q_inject_missing_blocks(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir)
    out = FT.inject_missing_blocks(p.series, "series_id")
    return N(out.select("series_id", "time", "load_mw", "injected"))


# ------------------------------------------------------ rolling origin / bins

TEST_LEN, CHUNK, HORIZON = 300, 5, 60


def rolling_origin(series: DataFrame, n: int, keys="series_id", test_len: int = TEST_LEN,
                   chunk: int = CHUNK, horizon: int = HORIZON, season: int = 24) -> DataFrame:
    """Rolling-origin back-test (#137): origins every ``chunk`` steps over the
    last ``test_len`` positions, ``horizon`` steps ahead each, seasonal-naive
    from the history before the origin; actuals by left join (origins near
    the end have rows without actuals).  Origins are rows — no loop."""
    ks = W._keys(keys)
    first = n - test_len
    origins = series.select(*ks).distinct().select(
        *ks, F.explode(F.sequence(F.lit(first), F.lit(n - chunk), F.lit(chunk))).alias("origin_pos"))
    rows = origins.select(*ks, "origin_pos", ((F.col("origin_pos") - first) / chunk).cast("long").alias("origin"),
                          F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("horizon"))
    rows = rows.withColumn("pos", F.col("origin_pos") + F.col("horizon") - 1).withColumn(
        "src_pos", F.col("pos") - F.lit(season) * F.ceil(F.col("horizon") / F.lit(season)))
    s = series.select(*ks, "pos", "time", "load_mw")
    act = s.select(*ks, "pos", F.col("load_mw").alias("y"))
    hist = s.select(*ks, F.col("pos").alias("src_pos"), F.col("load_mw").alias("y_hat"))
    out = rows.join(act, ks + ["pos"], "left").join(hist, ks + ["src_pos"], "left")
    return out.select(*ks, "origin", "horizon", "pos", "y", "y_hat")


def q_rolling_origin(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir)
    # three consumers (origins, actuals, history): read the written series
    return N(rolling_origin(materialize(p.series, "panel-series"), p.grid.n))


def q_rolling_origin_mae(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir)
    ro = rolling_origin(p.series, p.grid.n).dropna(subset=["y", "y_hat"])
    return N(ro.groupBy("horizon").agg(F.avg(F.abs(F.col("y") - F.col("y_hat"))).alias("mae")))


def q_origin_overlay(spark, sf_dir):
    """Prediction vs truth for the first 12 origins within the first 90 test rows (#147)."""
    p = C.hourly_panel(spark, sf_dir)
    ro = rolling_origin(p.series, p.grid.n)
    first = p.grid.n - TEST_LEN
    return N(ro.where((F.col("origin") < 12) & (F.col("pos") < first + 90)))


def target_bin_edges(df: DataFrame, col: str, n_bins: int) -> DataFrame:
    """Quantile bin edges by averaged inverted CDF (#92): one count job, then
    exact values at the needed ranks (bucketed rank selection); equal edges
    collapse."""
    vals = aicdf_edges(df, col, n_bins)
    spark = df.sparkSession
    return spark.createDataFrame(list(enumerate(vals)), "edge_idx long, edge double")  # ≤ n_bins + 1 rows


def aicdf_edges(df: DataFrame, col: str, n_bins: int) -> list[float]:
    """Distinct averaged-inverted-CDF edges (≤ n_bins + 1 values): x[ceil j]
    or, when j = n·q is an integer, the mean of x[j] and x[j+1]."""
    import math
    n = df.where(F.col(col).isNotNull()).count()
    ranks, plan = {}, []
    for i in range(n_bins + 1):
        j = n * i / n_bins
        if abs(j - round(j)) < 1e-9 and 0 < round(j) < n:
            a, b = int(round(j)), int(round(j)) + 1
        else:
            a = b = min(max(math.ceil(j), 1), n)
        ranks[f"r{a}"] = F.lit(a)
        ranks[f"r{b}"] = F.lit(b)
        plan.append((a, b))
    row = R.values_at_ranks(df, [], col, ranks).first().asDict()
    return sorted({(row[f"r{a}"] + row[f"r{b}"]) / 2 if a != b else row[f"r{a}"] for a, b in plan})


def q_target_bins(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    return N(target_bin_edges(h.series, "load_mw", 30))


def q_inverse_cdf(spark, sf_dir, quantiles=(0.05, 0.5, 0.95)):
    """Per fold: histogram of training targets over the target bins → CDF from
    0 → linear inverse at each quantile (C8) — the unconditional form of the
    binned quantile regressor."""
    h = C.hourly(spark, sf_dir)
    split = PR.hourly_split(h.grid)
    edges = [r.edge for r in target_bin_edges(h.series, "load_mw", 30).orderBy("edge_idx").collect()]
    e = F.array(*[F.lit(float(v)) for v in edges])
    from tempora.plans.split import assign_folds
    pg = h.series.where((F.col("pos") >= 168) & (F.col("pos") < 168 + split.n)) \
                 .withColumn("split_pos", F.col("pos") - 168)
    tr = assign_folds(pg, split).where(F.col("role") == "train")
    nb = len(edges) - 1
    b = F.least(F.greatest(F.size(F.filter(e, lambda v: v <= F.col("load_mw"))) - 1, F.lit(0)), F.lit(nb - 1))
    hist = tr.groupBy("fold_idx", b.alias("bin")).agg(F.count("*").alias("c"))
    from pyspark.sql import Window as Wn
    w = Wn.partitionBy("fold_idx").orderBy("bin")
    cdf = hist.withColumn("cum", F.sum("c").over(w.rowsBetween(Wn.unboundedPreceding, 0))) \
              .withColumn("tot", F.sum("c").over(Wn.partitionBy("fold_idx")))
    # cdf at right edge of bin b is cum/tot; the curve starts at (edge_0, 0)
    pts = cdf.select("fold_idx", (F.col("bin") + 1).alias("i"), (F.col("cum") / F.col("tot")).alias("p"))
    zero = pts.select("fold_idx").distinct().select("fold_idx", F.lit(0).alias("i"), F.lit(0.0).alias("p"))
    pts = pts.unionByName(zero)
    w2 = Wn.partitionBy("fold_idx").orderBy("i")
    seg = pts.withColumn("p_prev", F.lag("p").over(w2)).withColumn("i_prev", F.lag("i").over(w2)) \
             .where(F.col("p_prev").isNotNull())
    qdf = seg.select("*", F.explode(F.array(*[F.lit(q) for q in quantiles])).alias("quantile"))
    hit = qdf.where((F.col("p") >= F.col("quantile")) & (F.col("p_prev") < F.col("quantile")))
    hit = hit.withColumn("_r", F.row_number().over(Wn.partitionBy("fold_idx", "quantile").orderBy("i")))
    hit = hit.where(F.col("_r") == 1)
    # empty bins are flat CDF stretches: the rising bracket is bin i-1 → i
    e_lo, e_hi = F.element_at(e, F.col("i")), F.element_at(e, F.col("i") + 1)
    val = e_lo + (e_hi - e_lo) * (F.col("quantile") - F.col("p_prev")) / (F.col("p") - F.col("p_prev"))
    return N(hit.select("fold_idx", "quantile", val.alias("value")))


def q_ridge_1d(spark, sf_dir, alpha: float = 1.0):
    """Closed-form one-feature ridge (lag 1 day → load) per fold's train rows (#132)."""
    h = C.hourly(spark, sf_dir)
    split = PR.hourly_split(h.grid)
    lb = FT.lagged_block(h.series).where((F.col("pos") >= 168) & (F.col("pos") < 168 + split.n)) \
           .withColumn("split_pos", F.col("pos") - 168)
    from tempora.plans.split import assign_folds
    tr = assign_folds(lb, split).where(F.col("role") == "train")
    x, y = F.col("load_mw_lag_1d"), F.col("load_mw")
    g = tr.groupBy("fold_idx").agg(F.covar_pop(x, y).alias("cxy"), F.var_pop(x).alias("vx"),
                                   F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"))
    slope = F.col("cxy") * F.col("n") / (F.col("vx") * F.col("n") + F.lit(alpha))
    return N(g.select("fold_idx", slope.alias("slope"), (F.col("my") - slope * F.col("mx")).alias("intercept")))


def q_pairwise_interactions(spark, sf_dir):
    """Degree-2 interaction terms of the short lags (#93)."""
    from tempora.ml.assemble import pairwise_interactions
    h = C.hourly(spark, sf_dir)
    cols = ["load_mw_lag_1h", "load_mw_lag_2h", "load_mw_lag_3h", "load_mw_lag_1d"]
    lb = FT.lagged_block(h.series, specs=[s for s in FT.lagged_block_specs() if s.name in cols])
    out = pairwise_interactions(lb.select("time", *cols), cols)
    return N(out.select("time", *[c for c in out.columns if "_x_" in c]))


QUERIES_OPS = {
    "scan_parquet": q_scan_parquet, "literal_table": q_literal_table, "explode_payload": q_explode_payload, "explode_payload_arrays": q_explode_payload_arrays,
    "scan_load_csv": q_scan_load_csv, "sink_idempotent": q_sink_idempotent,
    "save_load_features": q_save_load_features, "list_inputs": q_list_inputs,
    "prediction_grid": q_prediction_grid, "preview_head": q_preview_head,
    "star_covariates": q_star_covariates, "exogenous_wide": q_exogenous_wide,
    "rename_covariates": q_rename_covariates, "select_glob": q_select_glob,
    "select_glob_diff": q_select_glob_diff, "null_audit": q_null_audit,
    "filter_open_interval": q_filter_open_interval, "filter_closed_right": q_filter_closed_right,
    "high_iqr_dates": q_high_iqr_dates, "holiday_flag": q_holiday_flag,
    "join_inner": q_join_inner, "join_renamed_key": q_join_renamed_key,
    "join_left_composite": q_join_left_composite, "join_back_agg": q_join_back_agg,
    "concat_quantiles": q_concat_quantiles, "asof_available": q_asof_available,
    "group_mean": q_group_mean, "group_std": q_group_std,
    "group_quantile_linear": q_group_quantile_linear, "group_quantile_nearest": q_group_quantile_nearest,
    "five_number_summary": q_five_number_summary, "profile_columns": q_profile_columns,
    "profile_histogram": q_profile_histogram, "profile_top_values": q_profile_top_values,
    "lag_features": q_lag_features, "lead_features": q_lead_features, "rolling_median": q_rolling_median,
    "rolling_quantile": q_rolling_quantile, "rolling_iqr": q_rolling_iqr,
    "rolling_mean_lagged": q_rolling_mean_lagged, "rolling_std_lagged": q_rolling_std_lagged,
    "rolling_minmax_lagged": q_rolling_minmax_lagged, "lag_block": q_lag_block, "lag_matrix": q_lag_matrix,
    "difference": q_difference, "panel_lagged_block": q_panel_lagged_block, "holdout_split": q_holdout_split,
    "calendar_fields": q_calendar_fields, "string_parse": q_string_parse, "label_format": q_label_format,
    "digitize": q_digitize, "feature_table_past": q_feature_table_past,
    "feature_table_daily": q_feature_table_daily, "sample_weight_mask": q_sample_weight_mask,
    "lag_safe_features": q_lag_safe_features, "inject_missing_blocks": q_inject_missing_blocks,
    "rolling_origin": q_rolling_origin, "rolling_origin_mae": q_rolling_origin_mae,
    "origin_overlay": q_origin_overlay, "target_bins": q_target_bins, "inverse_cdf": q_inverse_cdf,
    "ridge_1d": q_ridge_1d, "pairwise_interactions": q_pairwise_interactions,
}
