"""Evaluation of a fitted model's out-of-fold predictions (#110 into #116-#122,
#140-#143), and the closed-form ridge over folds and penalties (#132).

The model is a ridge of the load 24 hours ahead on the load now, fitted on each
fold's training rows from Gram matrices; its interval is the prediction plus and minus
1.645 training errors.  So the whole way from fit to score has a SQL twin."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.ml import ridge as RG
from tempora.plans import common as C
from tempora.plans import oracle as O
from tempora.plans import predictors as PR
from tempora.plans import queries as Q
from tempora.session import materialize

ALPHA, WIDTH = 1.0, 1.645
ALPHAS = (0.001, 1.0, 1e6, 1e9)

EVALUATIONS = {
    "score_point": Q.q_score_point, "score_deviance": Q.q_score_deviance, "score_pinball": Q.q_score_pinball,
    "coverage_width": Q.q_coverage_width, "binned_coverage": Q.q_binned_coverage, "lorenz_curve": Q.q_lorenz_curve, "gini": Q.q_gini,
    "lorenz_summary": Q.q_lorenz_summary, "reliability_mean": Q.q_reliability_mean, "reliability_quantile": Q.q_reliability_quantile,
    "residuals": Q.q_residuals, "residuals_by_hour": Q.q_residuals_by_hour, "residuals_by_month": Q.q_residuals_by_month,
}


def _now_and_ahead(spark: SparkSession, sf_dir: str):
    """(prediction_time, split_pos, load 24 hours ahead, load now), split."""
    h = C.hourly(spark, sf_dir)
    rows = PR.naive_long(h.series, h.grid, horizons=[24]).select("prediction_time", "split_pos", "load_mw", F.col("predicted_load_mw").alias("now"))
    return materialize(rows, "now-ahead"), PR.hourly_split(h.grid)


def ridge_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Out-of-fold rows of the ridge, in the columns of the back-test table."""
    rows, split = _now_and_ahead(spark, sf_dir)
    grams = RG.fold_grams(rows, split, ["now"], ["load_mw"])
    lines = [grams.fit(k, [ALPHA])[0] for k in range(split.k)]
    out = grams.predictions(rows, lines, ["prediction_time", "split_pos", "load_mw"])
    half = F.get(F.array(*[F.lit(WIDTH * line.rmse) for line in lines]), F.col("fold_idx").cast("int"))
    p = F.col("prediction")
    return materialize(out.select(F.lit("ridge").alias("model"), "fold_idx", "prediction_time", "split_pos", "load_mw", p.alias("predicted_load_mw"),
                                  (p - half).alias("lower"), (p + half).alias("upper")), "ridge-cv")


def q_ridge_predictions(spark, sf_dir):
    return C.normalize(ridge_predictions(spark, sf_dir).drop("split_pos"))


def q_ridge_folds(spark, sf_dir):
    """Penalties x folds from one scan: weight, intercept, training error, R²."""
    rows, split = _now_and_ahead(spark, sf_dir)
    grams = RG.fold_grams(rows, split, ["now"], ["load_mw"])
    out = [(a, k, float(line.weights[0]), line.intercept, line.rmse, line.r2["train"], line.r2["test"])
           for k in range(split.k) for a, line in zip(ALPHAS, grams.fit(k, ALPHAS))]
    return C.normalize(spark.createDataFrame(out, "alpha double, fold_idx long, weight double, intercept double, rmse double, train_r2 double, test_r2 double"))


QUERIES_MODEL = {
    "ridge_predictions": q_ridge_predictions,
    "ridge_folds": q_ridge_folds,
    **{f"ridge_{name}": partial(fn, predictions=ridge_predictions) for name, fn in EVALUATIONS.items()},
}


# ---------------------------------------------------------------- SQL twins

def _fits(alphas: str) -> str:
    """CTEs ``tr`` (training rows) and ``fit`` (a row for each fold and penalty)."""
    return f"""tr AS (SELECT fb.fold_idx, nl.predicted_load_mw AS x, nl.load_mw AS y FROM nl JOIN fb
  ON nl.split_pos >= fb.train_start AND nl.split_pos < fb.train_end WHERE nl.load_mw IS NOT NULL),
mom AS (SELECT fold_idx, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx, avg(x) AS mx, avg(y) AS my FROM tr GROUP BY 1),
fit AS (SELECT fold_idx, alpha, sxy / (sxx + alpha) AS w, my - sxy / (sxx + alpha) * mx AS b FROM mom, (SELECT unnest([{alphas}]) AS alpha)),
err AS (SELECT fit.fold_idx, alpha, w, b, sqrt(avg((y - b - w * x) * (y - b - w * x))) AS rmse,
  1 - sum((y - b - w * x) * (y - b - w * x)) / (var_pop(y) * count(*)) AS train_r2 FROM fit JOIN tr USING (fold_idx) GROUP BY ALL)"""


def _ridge_ctes() -> str:
    naive = O.naive_ctes([24]).replace("cv AS (SELECT 'seasonal_naive'", "naive_cv AS (SELECT 'seasonal_naive'")
    return f"""{naive}, {_fits(f'CAST({ALPHA} AS DOUBLE)')},
cv AS (SELECT 'ridge' AS model, fb.fold_idx, nl.prediction_time, nl.split_pos, nl.load_mw, b + w * nl.predicted_load_mw AS predicted_load_mw,
  b + w * nl.predicted_load_mw - {WIDTH} * rmse AS lower, b + w * nl.predicted_load_mw + {WIDTH} * rmse AS upper
  FROM nl JOIN fb ON nl.split_pos >= fb.test_start AND nl.split_pos < fb.test_end JOIN err USING (fold_idx))"""


def _sql() -> dict[str, str]:
    plain, own = O._snap_round_even(O.naive_ctes([24])), _ridge_ctes()
    out = {}
    for name in EVALUATIONS:
        if plain not in O.ORACLE[name]:
            raise ValueError(f"{name} doesn't begin with the back-test table")
        out[f"ridge_{name}"] = O._snap_round_even(O.ORACLE[name].replace(plain, own))
    r = O._r
    out["ridge_predictions"] = O._snap_round_even(f"""WITH {own}
SELECT model, fold_idx, prediction_time, {r('load_mw')}, {r('predicted_load_mw')}, {r('lower')}, {r('upper')} FROM cv""")
    out["ridge_folds"] = O._snap_round_even(f"""WITH {O.naive_ctes([24])}, {_fits(', '.join(f'CAST({a} AS DOUBLE)' for a in ALPHAS))},
te AS (SELECT e.fold_idx, alpha, 1 - sum((nl.load_mw - b - w * predicted_load_mw) * (nl.load_mw - b - w * predicted_load_mw)) / (var_pop(nl.load_mw) * count(*)) AS test_r2
  FROM err e JOIN fb USING (fold_idx) JOIN nl ON nl.split_pos >= fb.test_start AND nl.split_pos < fb.test_end GROUP BY ALL)
SELECT {r('alpha')}, fold_idx, {r('w', 'weight')}, {r('b', 'intercept')}, {r('rmse')}, {r('train_r2')}, {r('test_r2')} FROM err JOIN te USING (fold_idx, alpha)""")
    return out


SQL_MODEL = _sql()
