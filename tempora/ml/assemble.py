"""Feature preparation for MLlib (#86-#89): tunable column-group dropping,
mean imputation with missing indicators, variance filter and univariate
top-k selection, assembled into one vector column."""

from __future__ import annotations

import fnmatch
from typing import Iterable, Sequence

from pyspark.ml.feature import UnivariateFeatureSelector, VarianceThresholdSelector, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The reference's tunable column groups, as
# (globs to drop, globs kept back from them).
DROP_GROUPS = {
    "none": ([""], []),
    "load": (["load_*"], []),
    "rolling_load": (["load_mw_rolling_*"], []),
    "weather": (["weather_*"], []),
    "temperature": (["weather_temperature_*"], []),
    "moisture": (["weather_moisture_*"], []),
    "cloud_cover": (["weather_cloud_cover_*"], []),
    "calendar": (["cal_*"], []),
    "holiday": (["cal_is_holiday*"], []),
    "future_1h": (["*_future_1h"], []),
    "future_24h": (["*_future_24h"], []),
    "non_paris_weather": (["weather_*"], ["weather_*_paris_*"]),
}


def resolve(columns: Iterable[str], patterns) -> list[str]:
    """Columns matching the selector (#22, #23): a list of globs, or a
    ``(include, exclude)`` pair for glob set difference; resolved at plan
    time on ``df.columns``."""
    cols = list(columns)
    if isinstance(patterns, tuple):
        inc, exc = patterns
    else:
        inc, exc = patterns, []
    hit = set()
    for p in inc:
        hit.update(fnmatch.filter(cols, p))
    for p in exc:
        hit.difference_update(fnmatch.filter(cols, p))
    return [c for c in cols if c in hit]


def feature_columns(df: DataFrame, exclude: Sequence[str], drop_group: str = "none") -> list[str]:
    """Numeric feature columns minus keys/targets minus the dropped group (#86, #23)."""
    num = [f.name for f in df.schema.fields
           if f.dataType.typeName() in ("double", "float", "integer", "long", "boolean", "short")]
    cand = [c for c in num if c not in set(exclude)]
    dropped = set(resolve(cand, DROP_GROUPS[drop_group]))
    return [c for c in cand if c not in dropped]


def impute_with_indicator(train: DataFrame, cols: Sequence[str]):
    """``SimpleImputer(strategy="mean", add_indicator=True)`` (#87): returns a
    function that adds ``{c}_imputed`` (train mean fill) and, for columns
    with nulls in *train*, a ``{c}_missing`` 0/1 indicator.  Means and null
    counts come from one aggregate (one number per column); NaN counts as
    missing; booleans are cast to 0/1 doubles."""
    def dbl(c):
        x = F.col(c).cast("double")
        return F.when(F.isnan(x), F.lit(None).cast("double")).otherwise(x)
    row = train.agg(*[F.avg(dbl(c)).alias(f"m_{c}") for c in cols],
                    *[F.count(dbl(c)).alias(f"n_{c}") for c in cols], F.count(F.lit(1)).alias("_n")).first()
    means = {c: (row[f"m_{c}"] if row[f"m_{c}"] is not None else 0.0) for c in cols}
    with_nulls = [c for c in cols if row[f"n_{c}"] < row["_n"]]

    def apply(df: DataFrame) -> tuple[DataFrame, list[str]]:
        imp = [F.coalesce(dbl(c), F.lit(float(means[c]))).alias(f"{c}_imputed") for c in cols]
        ind = [dbl(c).isNull().cast("double").alias(f"{c}_missing") for c in with_nulls]
        return df.select("*", *imp, *ind), [f"{c}_imputed" for c in cols] + [f"{c}_missing" for c in with_nulls]
    return apply


def assembler(cols: Sequence[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep")


def variance_filter(threshold: float = 1e-6, inp: str = "features", out: str = "features_var"):
    """``VarianceThreshold(1e-6)`` (#89)."""
    return VarianceThresholdSelector(varianceThreshold=threshold, featuresCol=inp, outputCol=out)


def select_k_best(k: int, label: str, inp: str = "features", out: str = "features_k"):
    """Univariate top-k by F-regression (#88, deviation documented)."""
    sel = UnivariateFeatureSelector(featuresCol=inp, outputCol=out, labelCol=label,
                                    selectionMode="numTopFeatures")
    sel.setFeatureType("continuous").setLabelType("continuous").setSelectionThreshold(k)
    return sel


def prepare(train: DataFrame, test: DataFrame | None, cols: Sequence[str]):
    """Impute + indicators + assemble, fitted on ``train`` only."""
    apply = impute_with_indicator(train, cols)
    tr, fcols = apply(train)
    va = assembler(fcols)
    tr = va.transform(tr)
    te = va.transform(apply(test)[0]) if test is not None else None
    return tr, te, fcols


def pairwise_interactions(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``PolynomialFeatures(degree=2, interaction_only=True)`` (#93) as plain
    Catalyst products ``{a}_x_{b}`` for every pair a < b."""
    cols = list(cols)
    return df.select("*", *[(F.col(a) * F.col(b)).alias(f"{a}_x_{b}")
                            for i, a in enumerate(cols) for b in cols[i + 1:]])
