"""Forward-chaining cross-validation, out-of-fold predictions and randomised
search (#109-#112).

MLlib's ``CrossValidator`` trains on *all other* folds, which leaks the
future; here each fold's train / test rows come from the fold table of
:mod:`tempora.plans.split` and the fits run as concurrent Spark jobs from a
small driver thread pool (the reference's worker processes per fold).
"""

from __future__ import annotations

import random
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.ml import assemble as A
from tempora.ml import histogram as H
from tempora.ml import ridge as RG
from tempora.ml.folds import fit_folds
from tempora.plans import evaluate as EV
from tempora.plans.split import TimeSplit, assign_folds

Fitter = Callable[[DataFrame], object]           # train rows -> model with .transform
Scorer = Callable[[DataFrame], DataFrame]        # predictions -> one-row metrics


def default_scorer(pred: DataFrame, label: str, p: str = "prediction") -> dict:
    """Point scores and D² deviances of one prediction set (two one-row
    aggregates).  A deviance that isn't defined for some row is null."""
    ps = EV.point_scores(pred, [], y=label, p=p).first().asDict()
    dv = EV.deviance_scores(pred, [], y=label, p=p).first().asDict()
    return {**ps, **dv}


def cross_validate(df: DataFrame, split: TimeSplit, fit: Fitter, label: str,
                   pos_col: str = "split_pos", max_workers: int = 4,
                   return_predictions: bool = True):
    """Per fold: fit on train rows, predict train and test, score both.
    Returns ``(scores, predictions, models)``: one score row per
    (fold, role) and the unioned test predictions with ``fold_idx``."""
    assigned = assign_folds(df, split, pos_col)

    def run(i: int):
        train = assigned.where((F.col("fold_idx") == i) & (F.col("role") == "train"))
        test = assigned.where((F.col("fold_idx") == i) & (F.col("role") == "test"))
        t0 = time.perf_counter()
        model = fit(train)
        fit_time = time.perf_counter() - t0
        t1 = time.perf_counter()
        rows = []
        for role, part in (("train", train), ("test", test)):
            pred = model.transform(part)
            s = default_scorer(pred, label)
            rows.append({"fold_idx": i, "role": role, **{k: float(v) if v is not None else None
                                                        for k, v in s.items()}})
        score_time = time.perf_counter() - t1
        for r in rows:
            r["fit_time"], r["score_time"] = fit_time, score_time
        return i, model, rows

    with ThreadPoolExecutor(max_workers=max_workers) as ex:
        results = list(ex.map(run, range(split.k)))
    spark = df.sparkSession
    flat = [r for _, _, rows in results for r in rows]
    scores = spark.createDataFrame(flat)  # k × 2 rows: bounded by the split
    models = {i: m for i, m, _ in results}
    preds = None
    if return_predictions:
        for i, m, _ in results:
            test = assigned.where((F.col("fold_idx") == i) & (F.col("role") == "test"))
            p = m.transform(test)
            preds = p if preds is None else preds.unionByName(p, allowMissingColumns=True)
    return scores, preds, models


# ------------------------------------------------------------ search space

@dataclass(frozen=True)
class Choice:
    options: Sequence
    default: object = None

    def sample(self, rng: random.Random):
        return rng.choice(list(self.options))


@dataclass(frozen=True)
class LogFloat:
    low: float
    high: float
    default: float | None = None

    def sample(self, rng: random.Random):
        import math
        return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))


@dataclass(frozen=True)
class LogInt:
    low: int
    high: int
    default: int | None = None

    def sample(self, rng: random.Random):
        import math
        return int(round(math.exp(rng.uniform(math.log(self.low), math.log(self.high)))))


@dataclass
class SearchSpace:
    params: dict = field(default_factory=dict)

    def trials(self, n: int, seed: int = 0) -> list[dict]:
        rng = random.Random(seed)
        return [{k: v.sample(rng) for k, v in self.params.items()} for _ in range(n)]


def randomized_search(spark: SparkSession, df: DataFrame, split: TimeSplit, space: SearchSpace,
                      make_fit: Callable[[dict], Fitter], label: str, n_iter: int = 4,
                      seed: int = 0, model_name: str = "model") -> DataFrame:
    """Trial table (#111, #112, #11): one row per (trial, fold) with the
    sampled parameters as columns, fit / score times and test R²."""
    rows = []
    for t, params in enumerate(space.trials(n_iter, seed)):
        scores, _, _ = cross_validate(df, split, make_fit(params), label, return_predictions=False)
        for r in scores.where(F.col("role") == "test").collect():
            rows.append({"model": model_name, "trial": t, "fold_idx": int(r["fold_idx"]),
                         **{k: str(v) for k, v in params.items()},
                         "fit_time": float(r["fit_time"]), "score_time": float(r["score_time"]),
                         "score": float(r["r2"]) if r["r2"] is not None else None})
    return spark.createDataFrame(rows)


@dataclass
class TreeSearch:
    """Trials (one row per trial and fold), the best trial and the model that it gave on all rows."""
    trials: DataFrame
    best_trial: int
    best_params: dict
    binning: H.Binning
    best: H.Booster

    def best_predictions(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """``keep`` and target columns with the best model's prediction."""
        label = self.trials.schema["score"].metadata["label"]
        got = H.predict(df, self.binning, [self.best], list(dict.fromkeys([*keep, label])))
        return got.withColumn("prediction", F.col("predictions")[0]).drop("predictions")


def tree_settings(params: dict, columns: Sequence[str], rounds: int) -> dict:
    """A trial's parameters as settings of a histogram model."""
    out = {k: v for k, v in params.items() if k != "dropped_cols"}
    gone = set(A.resolve(columns, A.DROP_GROUPS[params.get("dropped_cols", "none")]))
    kept = [c for c in columns if c not in gone]
    return {**out, "rounds": rounds, "features": kept or list(columns)}


def search_trees(df: DataFrame, split: TimeSplit, columns: Sequence[str], label: str, space: SearchSpace, n_iter: int = 100,
                 rounds: int = 100, seed: int = 0, pos_col: str = "split_pos", model_name: str = "boosted_trees") -> TreeSearch:
    """Randomised search (#112): all trials on all folds are one run of
    histogram trees, ranked by mean test R² (ties: the first), the best refitted on all rows with a label.
    fit_time is the seconds until a trial's model was done, with all trials in work at once."""
    spark = df.sparkSession
    params = space.trials(n_iter, seed)
    models = fit_folds(df, split, columns, [label], [tree_settings(p, columns, rounds) for p in params], pos_col=pos_col)
    t0 = time.perf_counter()
    got = {(r["variant"], r["fold_idx"]): r for r in models.scores(df).where("role = 'test'").collect()}  # trials x folds
    score_time = (time.perf_counter() - t0) / max(1, len(got))
    rows = [{"model": model_name, "trial": t, "fold_idx": k, **{n: str(v) for n, v in p.items()}, "fit_time": float(got[t, k]["fit_time"]),
             "score_time": score_time, "score": got[t, k]["r2"]} for t, p in enumerate(params) for k in range(split.k)]
    means = {t: [r["score"] for r in rows if r["trial"] == t] for t in range(len(params))}
    best = max(means, key=lambda t: (sum(means[t]) / len(means[t]) if None not in means[t] else float("-inf"), -t))
    spec = tree_settings(params[best], columns, rounds)
    spec["features"] = tuple(list(columns).index(c) for c in spec["features"])
    refit, = H.fit(df, models.binning, [label], F.lit(1).cast("long"), [H.Spec(**spec)], key=[pos_col])
    table = spark.createDataFrame(rows)
    return TreeSearch(table.withMetadata("score", {"label": label}), best, params[best], models.binning, refit)


def _ridge_trials(grams: RG.FoldGrams, columns: Sequence[str], params: Sequence[dict]) -> dict[tuple[int, int], tuple[RG.Line, float]]:
    """(trial, fold) → line and seconds; penalties of one fold and column set share a decomposition."""
    groups: dict[tuple[str, ...], list[int]] = {}
    for t, p in enumerate(params):
        gone = set(A.resolve(columns, A.DROP_GROUPS[p.get("dropped_cols", "none")]))
        groups.setdefault(tuple(c for c in columns if c not in gone), []).append(t)
    out = {}
    for kept, trials in groups.items():
        for k in range(grams.split.k):
            t0 = time.perf_counter()
            lines = grams.fit(k, [params[t]["alpha"] for t in trials], columns=kept, scaled=True)
            for t, line in zip(trials, lines):
                out[t, k] = line, (time.perf_counter() - t0) / len(trials)
    return out


def _mean_r2(lines: dict, trial: int, k: int) -> float:
    """Mean test R² over folds; a fold without one counts as the worst."""
    got = [lines[trial, i][0].r2["test"] for i in range(k)]
    return sum(got) / k if None not in got else float("-inf")


def search_ridge(spark: SparkSession, grams: RG.FoldGrams, columns: Sequence[str], space: SearchSpace, n_iter: int = 100, seed: int = 0,
                 model_name: str = "ridge") -> DataFrame:
    """Randomised search over ``alpha`` and ``dropped_cols`` (#112): one row a
    trial and fold; nothing is scanned again.  ``score`` is the test R²."""
    params = space.trials(n_iter, seed)
    lines = _ridge_trials(grams, columns, params)
    return spark.createDataFrame([
        {"model": model_name, "trial": t, "fold_idx": k, **{n: str(v) for n, v in params[t].items()}, "fit_time": seconds,
         "train_score": line.r2["train"], "score": line.r2["test"]} for (t, k), (line, seconds) in sorted(lines.items(), key=lambda x: x[0])],
        "model string, trial long, fold_idx long, " + ", ".join(f"{n} string" for n in space.params) + ", fit_time double, train_score double, score double")


def nested_ridge(spark: SparkSession, df: DataFrame, outer: TimeSplit, inner_k: int, columns: Sequence[str], label: str, space: SearchSpace,
                 n_iter: int = 100, seed: int = 0, pos_col: str = "split_pos") -> DataFrame:
    """Nested search (#113): inside each outer fold's training part a forward
    split of ``inner_k`` folds ranks the trials by mean inner R² (ties: the first); the best one
    is fitted on the outer training part and scored on its test part.  One scan for the outer folds and one for each inner split."""
    params = space.trials(n_iter, seed)
    whole = RG.fold_grams(df, outer, columns, [label], pos_col)
    rows = []
    for i in range(outer.k):
        low, high = outer.bounds(i)[:2]
        inner = TimeSplit(high - low, inner_k, max(1, (high - low) // (inner_k + 1)), outer.gap, None)
        own = df.where((F.col(pos_col) >= low) & (F.col(pos_col) < high)).withColumn(pos_col, F.col(pos_col) - low)
        lines = _ridge_trials(RG.fold_grams(own, inner, columns, [label], pos_col), columns, params)
        best = max(range(n_iter), key=lambda t: (_mean_r2(lines, t, inner_k), -t))
        line = _ridge_trials(whole, columns, [params[best]])[0, i][0]
        rows.append((i, best, _mean_r2(lines, best, inner_k), *[str(v) for v in params[best].values()], line.r2["train"], line.r2["test"]))
    return spark.createDataFrame(rows, "fold_idx long, best_trial long, inner_r2 double, " + ", ".join(f"{n} string" for n in space.params) + ", train_r2 double, test_r2 double")


def nested_search(spark: SparkSession, df: DataFrame, outer: TimeSplit, inner_k: int, space: SearchSpace,
                  make_fit: Callable[[dict], Fitter], label: str, n_iter: int = 2, seed: int = 0,
                  pos_col: str = "split_pos") -> DataFrame:
    """Nested search (#113): inside each outer fold's training part a
    forward split of ``inner_k`` folds ranks ``n_iter`` sampled trials by
    mean inner R²; the best trial is refit on the outer train part and
    scored on the outer test part.  One row per outer fold."""
    assigned = assign_folds(df, outer, pos_col)
    rows = []
    for i in range(outer.k):
        train = assigned.where((F.col("fold_idx") == i) & (F.col("role") == "train")).drop("fold_idx", "role")
        test = assigned.where((F.col("fold_idx") == i) & (F.col("role") == "test")).drop("fold_idx", "role")
        lo, hi = outer.bounds(i)[:2]
        inner = TimeSplit(hi - lo, inner_k, max(1, (hi - lo) // (inner_k + 1)), outer.gap, None)
        tr = train.withColumn(pos_col, F.col(pos_col) - F.lit(lo))
        trials = randomized_search(spark, tr, inner, space, make_fit, label, n_iter, seed)
        best = trials.groupBy("trial").agg(F.avg("score").alias("m")).orderBy(F.desc("m")).first()
        params = space.trials(n_iter, seed)[int(best["trial"])]
        model = make_fit(params)(train)
        s = default_scorer(model.transform(test), label)
        rows.append({"fold_idx": i, "best_trial": int(best["trial"]), "inner_r2": float(best["m"]),
                     **{k: str(v) for k, v in params.items()},
                     "test_r2": float(s["r2"]) if s["r2"] is not None else None,
                     "test_mape": float(s["mape"]) if s["mape"] is not None else None})
    return spark.createDataFrame(rows)     # one row per outer fold
