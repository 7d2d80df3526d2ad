"""Quantile regression as classification (#133, C8).

Binned quantile regressor: the target is cut at averaged-inverted-CDF edges
(exact ranks by bucketed rank selection), a ``RandomForestClassifier``
predicts bin probabilities, their cumulative sum starting at 0 is the CDF on
the edges, and any quantile is read off by linear inversion — all as array
higher-order functions on the probability vector (no UDF).
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.plans.queries_ops import aicdf_edges


def quantile_edges(df: DataFrame, col: str, n_bins: int) -> list[float]:
    """Distinct averaged-inverted-CDF edges (≤ n_bins + 1 values)."""
    return [float(v) for v in aicdf_edges(df, col, n_bins)]


def bin_index(col: Column, edges: Sequence[float]) -> Column:
    e = F.array(*[F.lit(float(v)) for v in edges])
    nb = len(edges) - 1
    return F.least(F.greatest(F.size(F.filter(e, lambda v: v <= col)) - 1, F.lit(0)), F.lit(nb - 1)).cast("double")


def inverse_cdf(prob: Column, edges: Sequence[float], q: float) -> Column:
    """Linear inverse of the CDF ``[0, cumsum(prob)]`` on ``edges`` at ``q``;
    a ``q`` beyond the last CDF value clamps to the last edge; on flat
    stretches the first bracket with ``cdf[i+1] >= q`` wins."""
    e = F.array(*[F.lit(float(v)) for v in edges])
    nb = len(edges) - 1
    p = F.slice(F.concat(prob, F.array_repeat(F.lit(0.0), nb)), 1, nb)   # unseen classes → 0
    cdf = F.concat(F.array(F.lit(0.0)),
                   F.transform(F.sequence(F.lit(1), F.lit(nb)),
                               lambda i: F.aggregate(F.slice(p, 1, i), F.lit(0.0), lambda a, b: a + b)))
    idx = F.array_position(F.transform(cdf, lambda c: c >= F.lit(q)), True).cast("int")  # 1-based
    i1 = F.greatest(idx, F.lit(2))
    c0, c1 = F.element_at(cdf, i1 - 1), F.element_at(cdf, i1)
    e0, e1 = F.element_at(e, i1 - 1), F.element_at(e, i1)
    val = F.when(c1 > c0, e0 + (e1 - e0) * (F.lit(q) - c0) / (c1 - c0)).otherwise(e1)
    return F.when(idx == 0, F.element_at(e, -1)).otherwise(val)


@dataclass
class BinnedQuantileModel:
    clf: object
    edges: list
    featuresCol: str = "features"

    def predict_quantiles(self, df: DataFrame, quantiles: Sequence[float]) -> DataFrame:
        out = self.clf.transform(df).withColumn("_prob", vector_to_array("probability"))
        cols = [inverse_cdf(F.col("_prob"), self.edges, q).alias(f"q_{int(round(q * 100)):02d}")
                for q in quantiles]
        return out.select("*", *cols).drop("_prob", "rawPrediction", "probability", "prediction")

    def transform(self, df: DataFrame, quantile: float = 0.5) -> DataFrame:
        out = self.predict_quantiles(df, [quantile])
        return out.withColumnRenamed(f"q_{int(round(quantile * 100)):02d}", "prediction")


def fit_binned_quantile(df: DataFrame, label: str, n_bins: int = 30, num_trees: int = 30,
                        min_instances: int = 5, subset: str = "0.2", seed: int = 0,
                        featuresCol: str = "features", max_depth: int = 30) -> BinnedQuantileModel:
    """Trees grow until a leaf would get fewer than ``min_instances`` rows, or
    to ``max_depth`` (the forest classifier allows 30 at most)."""
    edges = quantile_edges(df, label, n_bins)
    train = df.withColumn("_bin", bin_index(F.col(label), edges))
    clf = RandomForestClassifier(featuresCol=featuresCol, labelCol="_bin", numTrees=num_trees,
                                 minInstancesPerNode=min_instances, featureSubsetStrategy=subset, maxDepth=max_depth,
                                 seed=seed).fit(train)
    return BinnedQuantileModel(clf, edges, featuresCol)
