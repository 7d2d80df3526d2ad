"""Registered queries: each ``(spark, sf_dir) -> DataFrame`` composes the
library operators over the given tables.  The SQL twins live in
:mod:`tempora.plans.oracle`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions import calendar as cal
from tempora.functions.rounding import round_half_even as bround
from tempora.plans import common as C
from tempora.plans import features as FT

N = C.normalize


# ------------------------------------------------------------- grids / align

def q_time_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    grid = C.hourly_grid(spark, sf_dir)
    return N(grid.frame(spark).withColumn("pos", grid.pos("time")))


def q_align_left(spark, sf_dir):
    h = C.hourly(spark, sf_dir, interpolate=False)
    return N(h.series.select("time", "load_mw"))


def q_align_inner(spark, sf_dir):
    h = C.hourly(spark, sf_dir, interpolate=False)
    return N(h.grid.frame(spark).join(h.obs, "time", "inner").select("time", "load_mw"))


def q_interpolate_linear(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir)
    return N(p.series.select("series_id", "time", "load_mw", "was_null"))


def q_target_series(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    return N(h.series.select("time", "load_mw", "was_null"))


def q_lagged_block(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    out = FT.lagged_block(h.series)
    names = [s.name for s in FT.lagged_block_specs()]
    return N(out.select("time", "load_mw", *names))


def q_target_table(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    return N(FT.target_table(h.series, h.grid))


def q_feature_table(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    cov = C.events_covariates(spark, sf_dir, h.grid)
    return N(FT.feature_table(h.series, h.grid, cov, covariate_fill=0.0))


def q_calendar_features(spark, sf_dir):
    h = C.hourly(spark, sf_dir, interpolate=False)
    return N(cal.calendar_table(h.grid.frame(spark), spark, "time"))


QUERIES = {
    "time_grid": q_time_grid,
    "align_left": q_align_left,
    "align_inner": q_align_inner,
    "interpolate_linear": q_interpolate_linear,
    "target_series": q_target_series,
    "lagged_block": q_lagged_block,
    "target_table": q_target_table,
    "feature_table": q_feature_table,
    "calendar_features": q_calendar_features,
}


# ------------------------------------------------- splits / back-test tables
from tempora.plans import evaluate as EV  # noqa: E402
from tempora.plans import predictors as PR  # noqa: E402
from tempora.plans import split as SP  # noqa: E402

WARMUP, MAXH = 168, 24


def _hourly_cv(spark, sf_dir, horizons=range(1, 25)):
    """Out-of-fold prediction table, written once: every evaluation reads it
    several times (edges, bins, labels, joins) instead of recomputing the
    window plan behind it."""
    from tempora.session import materialize
    h = C.hourly(spark, sf_dir)
    split = PR.hourly_split(h.grid)
    return h, split, materialize(PR.cv_predictions(h.series, h.grid, split, horizons=horizons), "cv")


def _cv24(spark, sf_dir):
    h, split, cv = _hourly_cv(spark, sf_dir, horizons=[24])
    return cv.drop("horizon")


def q_ts_split(spark, sf_dir):
    grid = C.hourly_grid(spark, sf_dir)
    split = PR.hourly_split(grid)
    pg = spark.range(0, split.n).select(F.col("id").alias("split_pos"))
    pg = pg.withColumn("prediction_time", grid.time(F.col("split_pos") + WARMUP))
    return N(SP.assign_folds(pg, split).select("prediction_time", "fold_idx", "role"))


def q_fold_report(spark, sf_dir):
    grid = C.hourly_grid(spark, sf_dir)
    split = PR.hourly_split(grid)
    pg = spark.range(0, split.n).select(F.col("id").alias("split_pos"))
    pg = pg.withColumn("prediction_time", grid.time(F.col("split_pos") + WARMUP))
    return N(SP.fold_report(SP.assign_folds(pg, split)))


def q_fold_assign(spark, sf_dir):
    """Range join of prediction rows against the broadcast fold-bounds table
    (k rows, bounded by the split) (#41)."""
    grid = C.hourly_grid(spark, sf_dir)
    split = PR.hourly_split(grid)
    pg = spark.range(0, split.n).select(F.col("id").alias("split_pos"))
    pg = pg.withColumn("prediction_time", grid.time(F.col("split_pos") + WARMUP))
    b = F.broadcast(split.bounds_table(spark))
    j = pg.join(b, (pg["split_pos"] >= b["test_start"]) & (pg["split_pos"] < b["test_end"]))
    return N(j.select("prediction_time", "fold_idx", "split_pos"))


def q_year_split(spark, sf_dir):
    ys = SP.year_split(C.daily_grid(spark, sf_dir).frame(spark), "time")
    return N(SP.fold_report(ys, "time"))


def q_naive_predictions(spark, sf_dir):
    _, _, cv = _hourly_cv(spark, sf_dir)
    return N(cv.select("model", "fold_idx", "prediction_time", "horizon", "load_mw",
                       "predicted_load_mw", "lower", "upper"))


def q_score_point(spark, sf_dir, predictions=_cv24):
    return N(EV.point_scores(predictions(spark, sf_dir), ["model", "fold_idx"]))


def q_scores_by_horizon(spark, sf_dir):
    _, _, cv = _hourly_cv(spark, sf_dir)
    return N(EV.point_scores(cv, ["fold_idx", "horizon"], prefix="test_"))


def q_score_deviance(spark, sf_dir, predictions=_cv24):
    return N(EV.deviance_scores(predictions(spark, sf_dir), ["fold_idx"]))


def q_score_pinball(spark, sf_dir, predictions=_cv24):
    cv = predictions(spark, sf_dir)
    return N(EV.pinball_scores(cv, ["fold_idx"], preds={0.05: "lower", 0.5: "predicted_load_mw",
                                                       0.95: "upper"}))


def q_coverage_width(spark, sf_dir, predictions=_cv24):
    return N(EV.coverage_width(predictions(spark, sf_dir), ["fold_idx"]))


def q_binned_coverage(spark, sf_dir, predictions=_cv24):
    return N(EV.binned_coverage(predictions(spark, sf_dir)))


def _lorenz_inputs(spark, sf_dir, predictions):
    cv = predictions(spark, sf_dir)
    model = cv.select(F.lit("Model").alias("model"), "fold_idx", "prediction_time", "load_mw",
                      F.col("predicted_load_mw").alias("_ord"))
    oracle = cv.select(F.lit("Oracle").alias("model"), "fold_idx", "prediction_time", "load_mw",
                       F.col("load_mw").alias("_ord"))
    return EV.lorenz(model.unionByName(oracle), ["model", "fold_idx"], order="_ord")


def q_lorenz_curve(spark, sf_dir, predictions=_cv24):
    return N(EV.lorenz_grid(_lorenz_inputs(spark, sf_dir, predictions), ["model", "fold_idx"], 500))


def q_gini(spark, sf_dir, predictions=_cv24):
    return N(EV.gini(_lorenz_inputs(spark, sf_dir, predictions), ["model", "fold_idx"]))


def q_lorenz_summary(spark, sf_dir, n_samples: int = 500, predictions=_cv24):
    g = EV.gini(_lorenz_inputs(spark, sf_dir, predictions), ["model", "fold_idx"])
    s = g.groupBy("model").agg(F.avg("gini_index").alias("gini_mean"),
                               F.stddev_samp("gini_index").alias("gini_std"),
                               F.var_pop("gini_index").alias("_vp"), F.count("*").alias("_nf"))
    m = F.col("_nf") * n_samples
    s = s.withColumn("gini_std_rows", F.sqrt(F.col("_vp") * m / (m - 1)))
    label = F.format_string("%s (Gini: %s +/- %s)", "model", F.format_string("%.4f", "gini_mean"),
                            F.format_string("%.4f", "gini_std_rows"))
    return N(s.select("model", "gini_mean", "gini_std", "gini_std_rows", label.alias("model_label")))


def q_reliability_mean(spark, sf_dir, predictions=_cv24):
    cv = predictions(spark, sf_dir)
    r = EV.reliability(cv, 10, "mean")
    return N(r.join(EV.fold_labels(cv), "fold_idx"))


def q_reliability_quantile(spark, sf_dir, predictions=_cv24):
    cv = predictions(spark, sf_dir)
    r = EV.reliability(cv, 10, "quantile", 0.5)
    return N(r.join(EV.fold_labels(cv), "fold_idx"))


def q_residuals(spark, sf_dir, predictions=_cv24):
    cv = predictions(spark, sf_dir)
    r = cv.select("fold_idx", "prediction_time", "load_mw", "predicted_load_mw",
                  (F.col("predicted_load_mw") - F.col("load_mw")).alias("residual"))
    return N(r.join(F.broadcast(EV.fold_labels(cv, base=1)), "fold_idx"))


def q_residuals_by_hour(spark, sf_dir, predictions=_cv24):
    return N(EV.residuals_binned(predictions(spark, sf_dir), "hour"))


def q_residuals_by_month(spark, sf_dir, predictions=_cv24):
    return N(EV.residuals_binned(predictions(spark, sf_dir), "month"))


def q_interval_table(spark, sf_dir):
    cv = _cv24(spark, sf_dir)
    t = EV.tail_per_group(cv, ["fold_idx"], "prediction_time", 240, "1 hour")
    return N(t.select("fold_idx", "prediction_time", "load_mw", "predicted_load_mw", "lower", "upper"))


def q_tail_per_fold(spark, sf_dir):
    cv = _cv24(spark, sf_dir)
    t = EV.tail_per_group(cv, ["fold_idx"], "prediction_time", 24, "1 hour")
    return N(t.select("fold_idx", "prediction_time", "load_mw"))


def q_horizon_forecast(spark, sf_dir, past_hours: int = 168):
    """Past truth [t0-168h, t0], future truth (t0, t0+24h], forecasts t0+h
    (#125) at t0 = first test time of the last fold."""
    h, split, cv = _hourly_cv(spark, sf_dir)
    t0_pos = split.bounds(split.k - 1)[2] + WARMUP
    t0 = h.grid.at(t0_pos)
    t0c = F.lit(t0).cast("timestamp_ntz")
    s = h.series
    past = s.where((F.col("pos") >= t0_pos - past_hours) & (F.col("pos") <= t0_pos)).select(
        F.lit("past").alias("kind"), "time", F.col("load_mw").alias("value"))
    fut = s.where((F.col("pos") > t0_pos) & (F.col("pos") <= t0_pos + MAXH)).select(
        F.lit("future").alias("kind"), "time", F.col("load_mw").alias("value"))
    at_t0 = cv.where(F.col("prediction_time") == t0c)
    # row by predicate (#30): the forecast record at t0 must be exactly one
    if at_t0.select("prediction_time").distinct().limit(2).count() != 1:
        raise ValueError(f"expected exactly one forecast record at {t0}")
    fc = at_t0.select(
        F.lit("forecast").alias("kind"), h.grid.shift("prediction_time", 0).alias("_t"), "horizon",
        F.col("predicted_load_mw").alias("value"))
    from tempora.functions.timecols import micros, from_micros
    fc = fc.select("kind", from_micros(micros("_t") + F.col("horizon") * F.lit(3_600_000_000)).alias("time"),
                   "value")
    return N(past.unionByName(fut).unionByName(fc))


def _fold_scores(spark, sf_dir):
    return EV.point_scores(_cv24(spark, sf_dir), ["fold_idx"], prefix="test_").drop("test_n")


def q_unpivot_scores(spark, sf_dir):
    s = _fold_scores(spark, sf_dir)
    return N(s.unpivot(["fold_idx"], ["test_mape", "test_r2", "test_mae", "test_mse"], "metric", "value"))


def q_cv_mean_scores(spark, sf_dir):
    s = _fold_scores(spark, sf_dir)
    long = s.unpivot(["fold_idx"], ["test_mape", "test_r2", "test_mae", "test_mse"], "metric", "value")
    return N(long.groupBy("metric").agg(F.avg("value").alias("mean_value")))


def q_union_folds(spark, sf_dir):
    """Train and test scores per fold, unioned by name (#71, #109 shape)."""
    h = C.hourly(spark, sf_dir)
    split = PR.hourly_split(h.grid)
    long = PR.naive_long(h.series, h.grid, horizons=[24])
    tr = SP.assign_folds(long, split)
    sc = EV.point_scores(tr, ["fold_idx", "role"])
    train = sc.where(F.col("role") == "train")
    test = sc.where(F.col("role") == "test")
    return N(train.unionByName(test).select("fold_idx", "role", "mape", "r2", "n"))


def q_score_spread(spark, sf_dir):
    _, _, cv = _hourly_cv(spark, sf_dir)
    s = EV.point_scores(cv, ["fold_idx", "horizon"], prefix="test_")
    long = s.unpivot(["fold_idx", "horizon"], ["test_mape", "test_r2"], "metric", "value")
    return N(EV.five_number_summary(long, ["metric", "horizon"], "value"))


def q_score_integrated(spark, sf_dir):
    _, _, cv = _hourly_cv(spark, sf_dir)
    s = EV.point_scores(cv, ["fold_idx", "horizon"])
    return N(s.groupBy("fold_idx").agg(F.avg("mae").alias("integrated_mae"),
                                       F.avg("mse").alias("integrated_mse"),
                                       F.min("mae").alias("min_mae"), F.max("mae").alias("max_mae")))


def q_mae_by_horizon(spark, sf_dir):
    _, _, cv = _hourly_cv(spark, sf_dir)
    d = cv.dropna(subset=["load_mw", "predicted_load_mw"])
    return N(d.groupBy("model", "horizon").agg(F.avg(F.abs(F.col("load_mw") - F.col("predicted_load_mw")))
                                                .alias("mae")))


def q_conformal_adjust(spark, sf_dir, alpha: float = 0.1):
    """Split-conformal widening (#148): fold i is calibrated on fold i-1's
    conformity scores ``max(lower - y, y - upper)``; q̂ is the
    ``ceil((n+1)(1-alpha))``-th smallest score."""
    cv = _cv24(spark, sf_dir)
    sc = cv.withColumn("score", F.greatest(F.col("lower") - F.col("load_mw"), F.col("load_mw") - F.col("upper")))
    from tempora.operators import ranks as R
    rank = F.least(F.ceil((F.col("_n") + 1) * F.lit(1 - alpha)), F.col("_n"))
    qhat = R.values_at_ranks(sc, ["fold_idx"], "score", {"q_hat": rank}) \
            .select((F.col("fold_idx") + 1).alias("fold_idx"), "q_hat")
    j = cv.join(F.broadcast(qhat), "fold_idx")  # one row per fold
    lo2, hi2 = F.col("lower") - F.col("q_hat"), F.col("upper") + F.col("q_hat")
    y = F.col("load_mw")
    return N(j.groupBy("fold_idx").agg(
        F.first("q_hat").alias("q_hat"),
        bround(F.avg(((y >= F.col("lower")) & (y <= F.col("upper"))).cast("double")), 4).alias("coverage_raw"),
        bround(F.avg(((y >= lo2) & (y <= hi2)).cast("double")), 4).alias("coverage_adjusted"),
        bround(F.avg(F.col("upper") - F.col("lower")), 1).alias("width_raw"),
        bround(F.avg(hi2 - lo2), 1).alias("width_adjusted")))


QUERIES.update({
    "ts_split": q_ts_split,
    "fold_report": q_fold_report,
    "fold_assign": q_fold_assign,
    "year_split": q_year_split,
    "naive_predictions": q_naive_predictions,
    "score_point": q_score_point,
    "scores_by_horizon": q_scores_by_horizon,
    "score_deviance": q_score_deviance,
    "score_pinball": q_score_pinball,
    "coverage_width": q_coverage_width,
    "binned_coverage": q_binned_coverage,
    "lorenz_curve": q_lorenz_curve,
    "gini": q_gini,
    "lorenz_summary": q_lorenz_summary,
    "reliability_mean": q_reliability_mean,
    "reliability_quantile": q_reliability_quantile,
    "residuals": q_residuals,
    "residuals_by_hour": q_residuals_by_hour,
    "residuals_by_month": q_residuals_by_month,
    "interval_table": q_interval_table,
    "tail_per_fold": q_tail_per_fold,
    "horizon_forecast": q_horizon_forecast,
    "unpivot_scores": q_unpivot_scores,
    "cv_mean_scores": q_cv_mean_scores,
    "union_folds": q_union_folds,
    "score_spread": q_score_spread,
    "score_integrated": q_score_integrated,
    "mae_by_horizon": q_mae_by_horizon,
    "conformal_adjust": q_conformal_adjust,
})
