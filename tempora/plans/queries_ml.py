"""Registered model queries (fits can't be said in SQL: rows-only checks plus
property tests; transformers have SQL twins at the end).  All fit on the hourly feature table with the forward
split; the recursive / direct back-tests run on the hourly panel."""

from __future__ import annotations

from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.ml import assemble as A
from tempora.ml import crossval as CV
from tempora.ml import forecast as FC
from tempora.ml.folds import fit_folds
from tempora.ml import ridge as RG
from tempora.ml.quantile import fit_binned_quantile
from tempora.ml.splines import fit_nystroem, fit_splines
from tempora.plans import common as C
from tempora.plans import evaluate as EV
from tempora.plans import features as FT
from tempora.plans import oracle as O
from tempora.plans import oracle_ops as OO
from tempora.plans import predictors as PR
from tempora.session import materialize

LABEL = "load_mw_horizon_24h"
TARGETS = [f"load_mw_horizon_{h}h" for h in range(1, 25)]
KEYS = ["prediction_time", "split_pos"]


def _design(spark, sf_dir):
    """Feature table + 24 targets on the prediction grid, with split
    positions; assembled features are built per fold on train only."""
    h = C.hourly(spark, sf_dir)
    cov = C.events_covariates(spark, sf_dir, h.grid)
    ft = FT.feature_table(h.series, h.grid, cov, with_targets=True, covariate_fill=0.0)
    ft = ft.withColumn("split_pos", h.grid.pos("prediction_time") - 168)
    # every fold / trial reads the written design table, not the window plan
    ft = materialize(ft, "design")
    cols = A.feature_columns(ft, exclude=KEYS + TARGETS)
    return ft, cols, PR.hourly_split(h.grid)


class _Fitted:
    """Impute + assemble fitted on train, then a model; ``transform`` applies both."""

    def __init__(self, prep, va, model):
        self.prep, self.va, self.model = prep, va, model

    def transform(self, df: DataFrame) -> DataFrame:
        return self.model.transform(self.va.transform(self.prep(df)[0]))


def _fitter(make_model, cols, label=LABEL):
    def fit(train: DataFrame):
        prep = A.impute_with_indicator(train, cols)
        tr, fcols = prep(train)
        va = A.assembler(fcols)
        return _Fitted(prep, va, make_model().fit(va.transform(tr)))
    return fit


def _cv(spark, sf_dir, make_model, label=LABEL, cols_filter=None):
    ft, cols, split = _design(spark, sf_dir)
    if cols_filter:
        cols = cols_filter(cols)
    scores, preds, _ = CV.cross_validate(ft, split, _fitter(make_model, cols, label), label)
    return scores, preds


def q_cross_validate(spark, sf_dir):
    scores, _ = _cv(spark, sf_dir, lambda: LinearRegression(labelCol=LABEL, regParam=1e-3))
    return scores


def q_cv_predictions(spark, sf_dir):
    _, preds = _cv(spark, sf_dir, lambda: LinearRegression(labelCol=LABEL, regParam=1e-3))
    return preds.select("fold_idx", "prediction_time", F.col(LABEL).alias("load_mw"),
                        F.col("prediction").alias("predicted_load_mw"))


def _trees(spark, sf_dir, variants, targets=(LABEL,), **options):
    """Design table and histogram trees of all folds."""
    ft, cols, split = _design(spark, sf_dir)
    return ft, fit_folds(ft, split, cols, list(targets), variants, **options)


def _fold_scores(ft, models):
    return models.scores(ft).drop("variant", "target")


def q_gbt_squared(spark, sf_dir):
    """Boosted trees (#126) with the reference's settings: 100 rounds, rate
    0.1, 30 leaves; scores of all folds."""
    return _fold_scores(*_trees(spark, sf_dir, [{"max_leaf_nodes": 30}]))


def q_gbt_poisson(spark, sf_dir):
    return _fold_scores(*_trees(spark, sf_dir, [{"loss": "poisson", "max_leaf_nodes": 30}]))


def q_gbt_gamma(spark, sf_dir):
    return _fold_scores(*_trees(spark, sf_dir, [{"loss": "gamma", "max_leaf_nodes": 30}]))


QUANTILES = (0.05, 0.5, 0.95)


def q_gbt_quantile(spark, sf_dir):
    """Quantile boosting (#128) at 0.05, 0.5 and 0.95 with the reference's
    settings (100 rounds, rate 0.1, 100 leaves) on all folds: D² pinball with
    the matching alpha, coverage and width of the 5-95 % interval by fold."""
    ft, models = _trees(spark, sf_dir, [{"loss": "quantile", "quantile": q, "max_leaf_nodes": 100} for q in QUANTILES])
    names = {q: f"q{int(q * 100):02d}" for q in QUANTILES}
    wide = models.predictions(ft, ["split_pos"]).groupBy("split_pos", "fold_idx").agg(
        F.max("y").alias("load_mw"), *[F.max(F.when(F.col("variant") == v, F.col("prediction"))).alias(n) for v, n in enumerate(names.values())])
    wide = materialize(wide, "quantiles")
    return EV.pinball_scores(wide, ["fold_idx"], preds=names).join(EV.coverage_width(wide, ["fold_idx"], lo="q05", hi="q95"), "fold_idx")


def q_direct_multi_horizon(spark, sf_dir, rounds: int = 100):
    """One model per horizon (#129) on every fold, 120 models in one run:
    scores by horizon, fold and role."""
    ft, models = _trees(spark, sf_dir, [{"rounds": rounds}], TARGETS)
    return models.scores(ft).withColumn("horizon", F.col("target") + 1).drop("variant", "target")


def q_forest_multi_output(spark, sf_dir, num_trees: int = 100):
    """Joint forest (#130) of 100 bootstrap trees, 30 rows a leaf at least:
    each split is the best for all 24 horizons together; test and train scores
    by horizon and fold."""
    ft, models = _trees(spark, sf_dir, [{"max_leaf_nodes": None, "min_samples_leaf": 30}], TARGETS,
                        groups=[tuple(range(len(TARGETS)))], forest=num_trees)
    return models.scores(ft).withColumn("horizon", F.col("target") + 1).drop("variant", "target")


def q_horizon_feature_model(spark, sf_dir, rounds: int = 100):
    """Horizon as a feature (#131): long (t, h) table, one model a fold, MAE
    by horizon and fold."""
    ft, cols, split = _design(spark, sf_dir)
    long = ft.select(*KEYS, *cols, F.inline(F.array(*[F.struct(F.lit(h).cast("double").alias("horizon"),
                                                                F.col(f"load_mw_horizon_{h}h").alias("target"))
                                                      for h in range(1, 25)])))
    models = fit_folds(long, split, [*cols, "horizon"], ["target"], [{"rounds": rounds}], key=["split_pos", "horizon"])
    p = models.predictions(long, ["horizon"])
    return p.groupBy("horizon", "fold_idx").agg(F.avg(F.abs(F.col("y") - F.col("prediction"))).alias("mae"))


class _SplineRidge:
    """Impute → splines → variance filter → top-k → Nyström → ridge, fitted on train."""

    def __init__(self, train, cols, n_components, k_best, alpha):
        self.prep = A.impute_with_indicator(train, cols)
        tr, fcols = self.prep(train)
        self.splines = fit_splines(tr, fcols)
        trs = self._splined(train)
        self.var = A.variance_filter(1e-6, "spl", "spl_var").fit(trs)
        self.best = A.select_k_best(min(k_best, len(self.var.selectedFeatures)), LABEL, "spl_var", "spl_k").fit(self.var.transform(trs))
        trk = materialize(self.best.transform(self.var.transform(trs)).select("split_pos", LABEL, "spl_k"), "spl-k")
        n = trk.count()
        self.map = fit_nystroem(trk, "spl_k", n_components=min(n_components, n), key="split_pos")
        self.map.outputCol = "features"
        self.line = LinearRegression(labelCol=LABEL, regParam=alpha / max(n, 1), elasticNetParam=0.0,
                                     standardization=False).fit(self.map.transform(trk))

    def _splined(self, df):
        # the spline expansion is computed once and written as one vector column
        return materialize(self.splines.vector(self.prep(df)[0], "spl").select("split_pos", LABEL, "spl"), "spl")

    def transform(self, df):
        return self.line.transform(self.map.transform(self.best.transform(self.var.transform(self._splined(df)))))


def q_ridge_spline_model(spark, sf_dir, n_components: int = 150, k_best: int = 100, alpha: float = 1e-2):
    """The reference's ridge chain (#132) on all folds: impute with
    indicators → cubic splines of every feature (Catalyst expressions) →
    variance filter (1e-6) → top-k univariate selection → RBF Nyström →
    ridge.  Scores by fold and role.  Nyström landmarks: at most as many as train rows."""
    ft, cols, split = _design(spark, sf_dir)
    return CV.cross_validate(ft, split, lambda train: _SplineRidge(train, cols, n_components, k_best, alpha), LABEL, return_predictions=False)[0]


class _BinnedQuantile:
    def __init__(self, train, cols, **settings):
        self.prep = A.impute_with_indicator(train, cols)
        tr, fcols = self.prep(train)
        self.va = A.assembler(fcols)
        self.model = fit_binned_quantile(self.va.transform(tr), LABEL, **settings)

    def transform(self, df):
        return self.model.predict_quantiles(self.va.transform(self.prep(df)[0]), list(QUANTILES)).withColumn("prediction", F.col("q_50"))


def q_binned_quantile(spark, sf_dir):
    """Quantile regression as classification (#133) on all folds: coverage and
    width of the 5-95 % interval and D² pinball per quantile and fold.  The reference's
    settings: 30 bins, 300 trees grown to 5 rows a leaf, 20 % of features per split."""
    ft, cols, split = _design(spark, sf_dir)
    _, preds, _ = CV.cross_validate(ft, split, lambda train: _BinnedQuantile(train, cols, n_bins=30, num_trees=300, min_instances=5, subset="0.2"), LABEL)
    p = materialize(preds.select("fold_idx", "split_pos", LABEL, "q_05", "q_50", "q_95"), "binned-quantile")
    cov = EV.coverage_width(p, ["fold_idx"], y=LABEL, lo="q_05", hi="q_95")
    return cov.join(EV.pinball_scores(p, ["fold_idx"], y=LABEL, preds={0.05: "q_05", 0.5: "q_50", 0.95: "q_95"}), "fold_idx")


def q_impute_indicator(spark, sf_dir):
    """Mean imputation + missing indicators (#87), fitted on fold-0 train,
    on a panel copy with injected missing blocks."""
    p = C.hourly_panel(spark, sf_dir)
    inj = FT.inject_missing_blocks(p.series, "series_id")
    lb = FT.lagged_block(inj, "series_id")
    cols = [s.name for s in FT.lagged_block_specs()]
    prep = A.impute_with_indicator(lb.where(F.col("pos") < 400), cols)
    out, fcols = prep(lb)
    return C.normalize(out.select("series_id", "time", *fcols))


def q_variance_filter(spark, sf_dir):
    ft, cols, split = _design(spark, sf_dir)
    tr, _, fcols = A.prepare(ft, None, cols)
    m = A.variance_filter(1e-6).fit(tr)
    kept = [fcols[i] for i in m.selectedFeatures]
    return spark.createDataFrame([(c,) for c in kept], "feature string")


def q_select_k_best(spark, sf_dir, k: int = 10):
    ft, cols, split = _design(spark, sf_dir)
    tr, _, fcols = A.prepare(ft.where(F.col(LABEL).isNotNull()), None, cols)
    m = A.select_k_best(k, LABEL).fit(tr)
    return spark.createDataFrame([(fcols[i],) for i in m.selectedFeatures], "feature string")


def _ridge_grams(spark, sf_dir):
    ft, cols, split = _design(spark, sf_dir)
    return RG.fold_grams(ft, split, cols, [LABEL]), cols, split


def _kept(cols, group):
    gone = set(A.resolve(cols, A.DROP_GROUPS[group]))
    return [c for c in cols if c not in gone]


def q_drop_cols_choice(spark, sf_dir, alpha: float = 1.0):
    """Each named column group dropped in turn (#86): R² of a closed-form ridge on
    every fold; one scan for all groups and folds."""
    grams, cols, split = _ridge_grams(spark, sf_dir)
    rows = []
    for g in A.DROP_GROUPS:
        kept = _kept(cols, g)
        for k in range(split.k):
            line = grams.fit(k, [alpha], columns=kept, scaled=True)[0]
            rows.append((g, k, len(kept), line.r2["train"], line.r2["test"]))
    return spark.createDataFrame(rows, "dropped string, fold_idx long, n_features long, train_r2 double, test_r2 double")


RIDGE_SPACE = {"alpha": CV.LogFloat(1e-6, 1e3, 1e-2), "dropped_cols": CV.Choice(list(A.DROP_GROUPS), "none")}


def q_ridge_search(spark, sf_dir, n_iter: int = 100):
    """100 trials of penalty and dropped columns on all folds (#112, #132), from
    one scan's Gram matrices: R² by trial and fold, fit_time of the small solve."""
    grams, cols, split = _ridge_grams(spark, sf_dir)
    return CV.search_ridge(spark, grams, cols, CV.SearchSpace(RIDGE_SPACE), n_iter)


def q_spline_basis(spark, sf_dir):
    h = C.hourly(spark, sf_dir)
    sp = fit_splines(h.series, ["load_mw"])
    return C.normalize(sp.transform(h.series.select("time", "load_mw")))


def q_nystroem_map(spark, sf_dir):
    ft, cols, split = _design(spark, sf_dir)
    tr, _, _ = A.prepare(ft, None, cols)
    ny = fit_nystroem(tr, "features", n_components=20, key="split_pos")
    from pyspark.ml.functions import vector_to_array
    return ny.transform(tr).select("prediction_time", vector_to_array("nystroem").alias("nystroem"))


def q_randomized_search(spark, sf_dir, n_iter: int = 100, rounds: int = 100):
    """Randomised search over the reference's space (#111, #112): loss in
    {squared, poisson, gamma}, learning rate log-uniform 0.01..1, max
    leaf nodes log-int 3..300, dropped column group; 100 trials, 2 forward
    folds, test R², the best trial refitted on all rows.  All trials are fitted
    together; ``refit_r2`` is the refitted model's R² on its own rows."""
    from tempora.plans.split import TimeSplit
    ft, cols, split = _design(spark, sf_dir)
    search = CV.search_trees(ft, TimeSplit(split.n, 2, split.t, split.gap, split.max_train), cols, LABEL,
                             CV.SearchSpace({"loss": CV.Choice(["squared", "poisson", "gamma"], "squared"),
                                             "learning_rate": CV.LogFloat(0.01, 1.0, 0.1),
                                             "max_leaf_nodes": CV.LogInt(3, 300, 30),
                                             "dropped_cols": CV.Choice(list(A.DROP_GROUPS), "none")}),
                             n_iter=n_iter, rounds=rounds)
    own = search.best_predictions(ft, ["split_pos"])
    r2 = EV.point_scores(own, [], y=LABEL, p="prediction").select(F.col("r2").alias("refit_r2"))
    best = r2.withColumn("trial", F.lit(search.best_trial).cast("long"))
    return search.trials.join(F.broadcast(best), "trial", "left")


def q_trial_table(spark, sf_dir):
    """Trial table of 100 ridge trials persisted as Parquet and read back (#11)."""
    t = materialize(q_ridge_search(spark, sf_dir), "trials")
    return t.groupBy("trial").agg(F.avg("score").alias("mean_score"), F.avg("fit_time").alias("mean_fit_time"))


def q_nested_search(spark, sf_dir, n_iter: int = 100):
    """Nested randomised search (#113): 2 outer folds × 2 inner folds × 100 ridge trials."""
    ft, cols, split = _design(spark, sf_dir)
    from tempora.plans.split import TimeSplit
    return CV.nested_ridge(spark, ft, TimeSplit(split.n, 2, split.t, split.gap, split.max_train), 2, cols, LABEL, CV.SearchSpace(RIDGE_SPACE), n_iter)


# ------------------------------------------------------- recursive / direct

def _panel_y(spark, sf_dir):
    p = C.hourly_panel(spark, sf_dir)
    s = materialize(p.series.select("series_id", "pos", "time", F.col("load_mw").alias("y")), "panel-y")
    return s, p.grid.n


def _recursive(spark, sf_dir, horizon, kind, **settings):
    s, n = _panel_y(spark, sf_dir)
    train = materialize(FC.lag_matrix(s).where(F.col("pos") < n - 300), "lag-train")
    rec = FC.recursive_forecast(FC.origins_table(s, n), FC.fit_lag_model(train, kind=kind, **settings), horizon)
    return rec.join(s.select("series_id", "pos", "y"), ["series_id", "pos"], "left")


def _mae_by_horizon(df):
    return df.dropna(subset=["y", "y_hat"]).groupBy("horizon").agg(F.avg(F.abs(F.col("y") - F.col("y_hat"))).alias("mae"))


def q_recursive_forecast(spark, sf_dir, horizon: int = 60):
    """Recursive boosted trees (#134) with the library defaults: 100 rounds, 31 leaves."""
    return _recursive(spark, sf_dir, horizon, "boosted")


def q_recursive_forecast_forest(spark, sf_dir, horizon: int = 60):
    """The recursive back-test with a random forest as the one-step model (#138)."""
    return _mae_by_horizon(_recursive(spark, sf_dir, horizon, "forest"))


def q_recursive_forecast_tree(spark, sf_dir, horizon: int = 60):
    """The same with one decision tree (#138)."""
    return _mae_by_horizon(_recursive(spark, sf_dir, horizon, "tree"))


def q_recursive_forecast_ridge(spark, sf_dir, horizon: int = 60):
    """The same with a ridge on splines (#138)."""
    return _mae_by_horizon(_recursive(spark, sf_dir, horizon, "ridge"))


def q_direct_forecast(spark, sf_dir, horizons=tuple(range(1, 61))):
    """60 direct models (#135) of 100 rounds, fitted in one run."""
    s, n = _panel_y(spark, sf_dir)
    d = FC.direct_forecast(s, FC.origins_table(s, n), n, horizons)
    return d.join(s.select("series_id", "pos", "y"), ["series_id", "pos"], "left")


QUERIES_ML = {
    "cross_validate": q_cross_validate, "cv_predictions": q_cv_predictions,
    "gbt_squared": q_gbt_squared, "gbt_poisson": q_gbt_poisson, "gbt_gamma": q_gbt_gamma,
    "gbt_quantile": q_gbt_quantile, "direct_multi_horizon": q_direct_multi_horizon,
    "forest_multi_output": q_forest_multi_output, "horizon_feature_model": q_horizon_feature_model,
    "ridge_spline_model": q_ridge_spline_model, "binned_quantile": q_binned_quantile,
    "impute_indicator": q_impute_indicator, "variance_filter": q_variance_filter,
    "select_k_best": q_select_k_best, "drop_cols_choice": q_drop_cols_choice,
    "spline_basis": q_spline_basis, "nystroem_map": q_nystroem_map,
    "randomized_search": q_randomized_search, "trial_table": q_trial_table,
    "recursive_forecast": q_recursive_forecast, "direct_forecast": q_direct_forecast,
    "nested_search": q_nested_search, "recursive_forecast_forest": q_recursive_forecast_forest,
    "recursive_forecast_tree": q_recursive_forecast_tree, "recursive_forecast_ridge": q_recursive_forecast_ridge,
    "ridge_search": q_ridge_search,
}


# ---------------------------------------------------------------- SQL twins

def _spline_sql() -> str:
    values = []
    for j in range(7):
        u = f"((load_mw - lo) / ((hi - lo) / 4) + {3 - j})"
        values.append(O._r(f"CASE WHEN {u} >= 0 AND {u} < 1 THEN {u} * {u} * {u} / 6 WHEN {u} >= 1 AND {u} < 2 THEN (-3 * {u} * {u} * {u} + 12 * {u} * {u} - 12 * {u} + 4) / 6 "
                           f"WHEN {u} >= 2 AND {u} < 3 THEN (3 * {u} * {u} * {u} - 24 * {u} * {u} + 60 * {u} - 44) / 6 WHEN {u} >= 3 AND {u} < 4 THEN (4 - {u}) * (4 - {u}) * (4 - {u}) / 6 ELSE 0 END",
                           f"load_mw_sp_{j}"))
    return f"WITH {O.hourly_ctes()}, mm AS (SELECT min(load_mw) AS lo, max(load_mw) AS hi FROM series)\nSELECT time, {O._r('load_mw')}, {', '.join(values)} FROM series, mm"


def _impute_sql() -> str:
    lags = O.lag_block_sql(part="PARTITION BY series_id ")
    names = [n for n, _ in lags]
    return f"""WITH {OO.panel_ctes()},
h AS (SELECT *, CAST('0x' || substr(md5(series_id || '|' || (pos // 24) || '|7'), 1, 8) AS BIGINT) % 1000 AS hv FROM series),
inj AS (SELECT series_id, time, pos, CASE WHEN hv < 100 THEN NULL ELSE load_mw END AS load_mw FROM h),
lb AS (SELECT series_id, time, pos, {', '.join(f'{e} AS {n}' for n, e in lags)} FROM inj),
m AS (SELECT {', '.join(f'avg({n}) AS m_{n}' for n in names)} FROM lb WHERE pos < 400)
SELECT series_id, time, {', '.join(O._r(f'coalesce({n}, m_{n})', f'{n}_imputed') for n in names)},
  {', '.join(f'CAST(CASE WHEN {n} IS NULL THEN 1 ELSE 0 END AS DOUBLE) AS {n}_missing' for n in names)} FROM lb, m"""


def _features() -> list[str]:
    leads = [f"weather_n_events_{e}_future_{h}h" for e in C.EVENT_TYPES for h in (1, 24)]
    calendar = [f"cal_{n}_future_{h}h" for n in ("hour_of_day", "day_of_week", "day_of_year", "year", "is_holiday") for h in (1, 24)]
    return ["load_mw", *[n for n, _ in O.lag_block_sql()], *leads, *calendar]


def _variance_sql() -> str:
    one = [f"SELECT '{c}_imputed' AS feature FROM ft HAVING var_pop(CAST({c} AS DOUBLE)) * count({c}) / (count(*) - 1) > 1e-6 "
           f"UNION ALL SELECT '{c}_missing' FROM ft HAVING count({c}) < count(*) AND 1.0 * count({c}) * (count(*) - count({c})) / count(*) / (count(*) - 1) > 1e-6" for c in _features()]
    return f"WITH ft AS MATERIALIZED ({O.sql_feature_table()})\n" + "\nUNION ALL ".join(one)


def _best_sql(k: int = 10) -> str:
    """The order of the F statistic is that of the squared correlation."""
    one = [f"SELECT '{c}_imputed' AS feature, corr(CAST({c} AS DOUBLE), y) AS r FROM j" for c in _features()]
    return f"""WITH ft AS MATERIALIZED ({O.sql_feature_table()}), hs AS MATERIALIZED (WITH {O.hourly_ctes()} SELECT time, lead(load_mw, 24) OVER (ORDER BY pos) AS y FROM series),
j AS MATERIALIZED (SELECT ft.*, hs.y FROM ft JOIN hs ON hs.time = ft.prediction_time WHERE hs.y IS NOT NULL),
r AS ({' UNION ALL '.join(one)})
SELECT feature FROM r WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY r * r DESC LIMIT {k}"""


SQL_ML = {k: O._snap_round_even(v) for k, v in {"spline_basis": _spline_sql(), "impute_indicator": _impute_sql(), "variance_filter": _variance_sql(),
                                                "select_k_best": _best_sql()}.items()}
