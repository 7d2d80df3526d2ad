"""Histogram trees over forward folds (#109, #110, #112, #126-#131).

All folds, targets and variants (quantiles, search trials, forest trees) are fitted in one run of
:func:`tempora.ml.histogram.fit`; every row's predictions come out in one pass, and the
scores of all of them are one aggregate."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.ml import histogram as H
from tempora.plans import evaluate as EV
from tempora.plans.split import TimeSplit


def train_mask(split: TimeSplit, pos: Column) -> Column:
    """Bit k is set for rows in the training part of fold k."""
    if split.k > 62:
        raise ValueError("62 folds at most")
    powers = F.array(*[F.lit(1 << k) for k in range(split.k)]).cast("array<long>")
    return F.aggregate(split.train_folds(pos), F.lit(0).cast("long"), lambda a, i: a + F.get(powers, i.cast("int")))


@dataclass
class FoldModels:
    """``models[variant][target group][fold]``: one booster, or the trees of a forest."""
    binning: H.Binning
    split: TimeSplit
    targets: list[str]
    groups: list[tuple[int, ...]]
    variants: list[dict]
    models: list[list[list]]
    pos_col: str = "split_pos"
    seconds: list[list[float]] = field(default_factory=list)

    def predictions(self, df: DataFrame, keep: Sequence[str], roles: Sequence[str] = ("test",), positions: Sequence[int] | None = None) -> DataFrame:
        """Long rows: keep columns, variant, target (positions), fold_idx,
        role, y, prediction.  Each row is predicted by the folds in whose test (or training) part
        it lies; ``positions``: variants wanted (all)."""
        wanted = list(range(len(self.variants))) if positions is None else list(positions)
        order = [(v, g, k) for v in wanted for g in range(len(self.groups)) for k in range(self.split.k)]
        flat = [(v, t, k) for v, g, k in order for t in self.groups[g]]
        got = H.predict(df, self.binning, [self.models[v][g][k] for v, g, k in order], [*dict.fromkeys([*keep, self.pos_col, *self.targets])])
        pos = F.col(self.pos_col)
        meta = {n: F.array(*[F.lit(x[i]) for x in flat]) for i, n in enumerate(("variant", "target", "fold_idx"))}
        long = got.select("*", F.posexplode("predictions").alias("_i", "prediction")).select(
            *keep, *([] if self.pos_col in keep else [self.pos_col]),
            *[F.get(a, F.col("_i")).cast("long").alias(n) for n, a in meta.items()],
            F.get(F.array(*[F.col(f"`{t}`").cast("double") for t in self.targets]), F.get(meta["target"], F.col("_i"))).alias("y"), "prediction")
        role = F.when(self.split.test_fold(pos) == F.col("fold_idx"), "test") \
                .when(F.array_contains(self.split.train_folds(pos).cast("array<long>"), F.col("fold_idx")), "train")
        out = long.withColumn("role", role).where(F.col("role").isin(*roles))
        return out if self.pos_col in keep else out.drop(self.pos_col)

    def scores(self, df: DataFrame) -> DataFrame:
        """One row per (variant, target, fold, role): point scores, deviances
        and the seconds until the model was done (all were fitted together)."""
        spark = df.sparkSession
        keys = ["variant", "target", "fold_idx", "role"]
        long = self.predictions(df, [], ("test", "train"))
        point = EV.point_scores(long, keys, y="y", p="prediction")
        deviance = EV.deviance_scores(long, keys, y="y", p="prediction")
        times = [(v, t, k, float(self.seconds[v][g * self.split.k + k])) for v in range(len(self.variants)) for g, ts in enumerate(self.groups)
                 for t in ts for k in range(self.split.k)]
        fit_time = spark.createDataFrame(times, "variant long, target long, fold_idx long, fit_time double")  # a row a model
        return point.join(deviance, keys, "left").join(fit_time, keys[:3])


def fit_folds(df: DataFrame, split: TimeSplit, columns: Sequence[str], targets: Sequence[str], variants: Sequence[dict],
              groups: Sequence[tuple[int, ...]] | None = None, forest: int = 0, max_bins: int = 255, pos_col: str = "split_pos",
              key: Sequence[str] | None = None) -> FoldModels:
    """``variants``: settings of :class:`tempora.ml.histogram.Spec`; its
    ``features`` may name columns.  ``groups``: targets that share their trees (each
    alone, where not given).  ``forest``: that many bootstrap trees a
    model in place of boosting."""
    columns, targets = list(columns), list(targets)
    groups = [tuple(g) for g in groups] if groups else [(t,) for t in range(len(targets))]
    binning = H.fit_bins(df, columns, max_bins)
    specs = []
    for v in variants:
        v = dict(v)
        if v.get("features") is not None:
            v["features"] = tuple(columns.index(c) for c in v["features"])
        for g in groups:
            for k in range(split.k):
                one = {"train_set": k, "targets": g, **v}
                if forest:
                    one.update(rounds=1, learning_rate=1.0, baseline=False)
                    specs += [H.Spec(**one, bootstrap=i) for i in range(forest)]
                else:
                    specs.append(H.Spec(**one))
    got = iter(H.fit(df, binning, targets, train_mask(split, F.col(pos_col)), specs, key=key or [pos_col]))
    models = [[[[next(got) for _ in range(forest)] if forest else next(got) for _ in range(split.k)] for _ in groups] for _ in variants]
    spent = lambda m: max(b.seconds for b in m) if isinstance(m, list) else m.seconds
    return FoldModels(binning, split, targets, groups, [dict(v) for v in variants], models, pos_col,
                      [[spent(m) for g in v for m in g] for v in models])
