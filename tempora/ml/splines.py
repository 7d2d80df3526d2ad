"""Cubic B-spline expansion (#90) and RBF Nyström map (#91).

The spline basis on uniform knots is the cardinal cubic B-spline shifted per
knot — a closed-form piecewise cubic, so the whole expansion is Catalyst
expressions (no Python UDF).  Nyström needs an m×m eigendecomposition of
the landmark kernel: landmarks are a deterministic hash-ordered sample of at
most ``n_components`` rows (≤ 200, a proven bound) decomposed on the
driver; the feature map is applied on executors with an Arrow-batched
pandas UDF.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: Landmarks that may be brought to the driver.
MAX_LANDMARKS = 200


def cardinal_cubic(u: Column) -> Column:
    """Cardinal cubic B-spline on [0, 4]."""
    return (F.when((u >= 0) & (u < 1), u * u * u / 6)
             .when((u >= 1) & (u < 2), (-3 * u * u * u + 12 * u * u - 12 * u + 4) / 6)
             .when((u >= 2) & (u < 3), (3 * u * u * u - 24 * u * u + 60 * u - 44) / 6)
             .when((u >= 3) & (u < 4), (4 - u) * (4 - u) * (4 - u) / 6)
             .otherwise(F.lit(0.0)))


@dataclass
class SplineModel:
    bounds: dict                 # column -> (min, max)
    n_knots: int = 5
    degree: int = 3

    @property
    def n_splines(self) -> int:
        return self.n_knots + self.degree - 1

    def columns(self) -> list[Column]:
        """``{c}_sp_{j}`` basis columns; inputs clamped to the fitted range
        (constant extrapolation)."""
        out = []
        for c, (lo, hi) in self.bounds.items():
            h = (hi - lo) / (self.n_knots - 1) if hi > lo else 1.0
            x = F.least(F.greatest(F.col(c).cast("double"), F.lit(lo)), F.lit(hi))
            for j in range(self.n_splines):
                t_j = lo + (j - self.degree) * h
                out.append(cardinal_cubic((x - F.lit(t_j)) / F.lit(h)).alias(f"{c}_sp_{j}"))
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return df.select("*", *self.columns())

    def basis_array(self, c: str) -> Column:
        """The ``n_splines`` basis values of one input as one array (a small
        expression per input instead of ``n_splines`` inlined ones)."""
        lo, hi = self.bounds[c]
        h = (hi - lo) / (self.n_knots - 1) if hi > lo else 1.0
        x = F.least(F.greatest(F.col(c).cast("double"), F.lit(lo)), F.lit(hi))
        return F.transform(F.sequence(F.lit(0), F.lit(self.n_splines - 1)),
                           lambda j: cardinal_cubic((x - (F.lit(lo) + (j - F.lit(self.degree)) * F.lit(h)))
                                                    / F.lit(h)))

    def vector(self, df: DataFrame, out: str = "spl") -> DataFrame:
        """All inputs' bases as one vector column (input-major order)."""
        arr = F.concat(*[self.basis_array(c) for c in self.bounds])
        return df.withColumn(out, array_to_vector(arr))


def fit_splines(df: DataFrame, cols, n_knots: int = 5) -> SplineModel:
    """Fit = one min / max aggregate over the inputs."""
    row = df.agg(*[F.min(c).alias(f"lo_{c}") for c in cols], *[F.max(c).alias(f"hi_{c}") for c in cols]).first()
    return SplineModel({c: (float(row[f"lo_{c}"]), float(row[f"hi_{c}"])) for c in cols}, n_knots)


@dataclass
class NystroemModel:
    landmarks: np.ndarray        # m × d
    normalization: np.ndarray    # m × m
    gamma: float
    inputCol: str = "features"
    outputCol: str = "nystroem"

    def transform(self, df: DataFrame) -> DataFrame:
        L, M, g = self.landmarks, self.normalization, self.gamma
        bL = df.sparkSession.sparkContext.broadcast((L, M))  # m ≤ 200 rows

        @F.pandas_udf(T.ArrayType(T.DoubleType()))
        def feature_map(x: pd.Series) -> pd.Series:
            Lm, Mm = bL.value
            X = np.stack(x.to_numpy()).astype(float)
            d2 = (X * X).sum(1)[:, None] - 2 * X @ Lm.T + (Lm * Lm).sum(1)[None, :]
            Z = np.exp(-g * np.maximum(d2, 0.0)) @ Mm.T
            return pd.Series(list(Z))

        arr = vector_to_array(F.col(self.inputCol))
        return df.withColumn(self.outputCol, array_to_vector(feature_map(arr)))


def fit_nystroem(df: DataFrame, inputCol: str = "features", n_components: int = 100,
                 gamma: float | None = None, seed: int = 0, key: str | None = None) -> NystroemModel:
    """Landmarks: the ``n_components`` rows with the smallest seeded hash of
    ``key`` (or of the features) — deterministic, independent of
    partitioning; kernel K_mm decomposed on the driver."""
    if not 1 <= n_components <= MAX_LANDMARKS:
        raise ValueError(f"1 to {MAX_LANDMARKS} landmarks")
    h = F.xxhash64(F.col(key) if key else F.to_json(F.struct(vector_to_array(F.col(inputCol)))), F.lit(seed))
    rows = df.select(vector_to_array(F.col(inputCol)).alias("x"), h.alias("_h")) \
             .orderBy("_h").limit(n_components).collect()
    L = np.array([r["x"] for r in rows], dtype=float)
    g = gamma if gamma is not None else 1.0 / L.shape[1]
    d2 = (L * L).sum(1)[:, None] - 2 * L @ L.T + (L * L).sum(1)[None, :]
    K = np.exp(-g * np.maximum(d2, 0.0))
    U, S, Vt = np.linalg.svd(K)
    S = np.maximum(S, 1e-12)
    M = U @ np.diag(1.0 / np.sqrt(S)) @ Vt
    return NystroemModel(L, M, g, inputCol)
