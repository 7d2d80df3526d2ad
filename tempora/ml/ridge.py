"""Ridge over folds and penalties from Gram matrices (#132, #112, #109).

Rows between two neighbouring fold bounds form a segment.  One scan adds up
Z'Z of every segment, Z being 1, the features (missing: 0), an indicator for each feature, and the
targets.  A fold's training and test matrices are sums of segments, so folds,
penalties, dropped columns and R² need no further scan: mean imputation is linear in
(feature, indicator), centring is a rank-one update, and all penalties of a fold share one
eigendecomposition of a small matrix.

What is collected is (segments) x (columns)²: at most SIDE columns, checked."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.plans.split import TimeSplit

#: Columns of Z at most: 32 MB a segment.
SIDE = 2000
#: Rows of Z'Z that travel as one value.
BAND = 64


def _segment(pos: Column, cuts: Sequence[int]) -> Column:
    """The number of cuts at or below ``pos``."""
    return F.size(F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<long>"), lambda c: c <= pos)).cast("long")


def _number(name: str) -> Column:
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def gram(df: DataFrame, features: Sequence[str], targets: Sequence[str], segment: Column,
         expand: Callable[[np.ndarray], np.ndarray] | None = None, n_expanded: int = 0) -> dict[int, np.ndarray]:
    """Z'Z by segment, Z = (1, features, indicators, targets).  Rows with a
    null target or segment don't count.  ``expand`` makes ``n_expanded`` features of
    a batch's matrix (rows x features) in the tasks."""
    q, t = len(features), len(targets)
    p = n_expanded if expand else q
    side = 1 + 2 * p + t
    if side > SIDE:
        raise ValueError(f"{side} columns; {SIDE} at most")
    whole = [~_number(c).isNull() for c in targets]
    read = df.select(segment.cast("long").alias("segment"), *[_number(c).alias(f"x{i}") for i, c in enumerate(features)],
                     *[_number(c).alias(f"y{i}") for i, c in enumerate(targets)]).where(F.col("segment").isNotNull())
    read = read.where(" and ".join(f"y{i} is not null" for i in range(t))) if whole else read
    ddl = "segment long, band long, part binary"

    def rows(sums: dict) -> Iterator[pa.RecordBatch]:
        for (s, b), m in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), pa.array([b], pa.int64()), pa.array([m.tobytes()], pa.binary())], ["segment", "band", "part"])

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                own = part.column(0).to_numpy(zero_copy_only=False)
                v = [part.column(1 + k).to_numpy(zero_copy_only=False).astype(float) for k in range(q + t)]
                x = np.stack(v[:q], axis=1) if q else np.zeros((part.num_rows, 0))
                x = expand(x) if expand else x
                gone = np.isnan(x)
                z = np.ones((part.num_rows, side))
                z[:, 1:1 + p], z[:, 1 + p:1 + 2 * p] = np.where(gone, 0.0, x), gone
                for k in range(t):
                    z[:, 1 + 2 * p + k] = v[q + k]
                for s in np.unique(own):
                    m = z[own == s]
                    sums[int(s)] = sums.get(int(s), 0.0) + m.T @ m
        yield from rows({(s, a): m[a:a + BAND] for s, m in sums.items() for a in range(0, side, BAND)})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total = None, None
        for b in batches:
            for s, a, part in zip(*[c.to_pylist() for c in b.columns]):
                m = np.frombuffer(part)
                if (s, a) == last:
                    total = total + m
                else:
                    if last is not None:
                        yield from rows({last: total})
                    last, total = (s, a), m
        if last is not None:
            yield from rows({last: total})

    got = read.mapInArrow(partial, ddl).repartition("segment", "band").sortWithinPartitions("segment", "band").mapInArrow(added, ddl).collect()
    out: dict[int, np.ndarray] = {}
    for r in got:
        m = out.setdefault(r["segment"], np.zeros((side, side)))
        m[r["band"]:r["band"] + BAND] = np.frombuffer(r["part"]).reshape(-1, side)
    return out


@dataclass
class Line:
    """prediction = intercept + sum of weight * feature, a missing feature
    standing for its training mean."""
    features: list[str]
    intercept: float
    weights: np.ndarray
    means: np.ndarray
    r2: dict[str, float | None] = field(default_factory=dict)
    rmse: float = 0.0

    def column(self) -> Column:
        x = F.array(*[F.coalesce(_number(c), F.lit(float(m))) for c, m in zip(self.features, self.means)]) if self.features else F.array().cast("array<double>")
        w = F.array(*[F.lit(float(v)) for v in self.weights]) if self.features else F.array().cast("array<double>")
        return F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(float(self.intercept)), lambda a, b: a + b)


@dataclass
class FoldGrams:
    """Z'Z of each fold's training and test rows."""
    features: list[str]
    targets: list[str]
    split: TimeSplit
    train: list[np.ndarray]
    test: list[np.ndarray]
    pos_col: str = "split_pos"

    def fit(self, fold: int, alphas: Sequence[float], target: int = 0, columns: Sequence[str] | None = None,
            scaled: bool = False) -> list[Line]:
        """The ridge of each penalty on one fold, with its R² on the fold's
        training and test rows and the training root mean squared error.  ``columns``: features
        used (all); ``scaled``: the penalty is on features of unit variance.  The intercept is
        free.  Features without variance get no weight."""
        p = len(self.features)
        use = np.array([self.features.index(c) for c in (columns if columns is not None else self.features)], int)
        g = self.train[fold]
        n = g[0, 0]
        if not n:
            raise ValueError(f"fold {fold} has no training rows")
        there = n - g[0, 1 + p + use]
        means = np.divide(g[0, 1 + use], there, out=np.zeros(use.size), where=there > 0)
        # from (1, x, indicators, targets) to (1, imputed x, target)
        to = np.zeros((g.shape[0], use.size + 2))
        to[0, 0], to[1 + 2 * p + target, -1] = 1.0, 1.0
        to[1 + use, 1 + np.arange(use.size)] = 1.0
        to[1 + p + use, 1 + np.arange(use.size)] = means
        own, held = to.T @ g @ to, to.T @ self.test[fold] @ to
        mean = own[0, 1:] / n
        centred = own[1:, 1:] - n * np.outer(mean, mean)
        a, b = centred[:-1, :-1], centred[:-1, -1]
        spread = np.sqrt(np.maximum(np.diag(a), 0.0) / n)
        live = spread > 1e-9 * np.maximum(1.0, np.abs(mean[:-1]))
        unit = np.where(live, spread if scaled else 1.0, 1.0)
        values, vectors = np.linalg.eigh((a / np.outer(unit, unit))[np.ix_(live, live)])
        values = np.maximum(values, 0.0)
        turned = vectors.T @ (b / unit)[live]
        small = values <= 1e-12 * (values.max() if values.size else 0.0)
        out = []
        for alpha in alphas:
            w = np.zeros(use.size)
            w[live] = vectors @ np.where(small & (alpha <= 0), 0.0, turned / np.where(small & (alpha <= 0), 1.0, values + alpha)) / unit[live]
            line = Line([self.features[i] for i in use], float(mean[-1] - w @ mean[:-1]), w, means)
            full = np.concatenate([[line.intercept], w, [-1.0]])
            for role, m in (("train", own), ("test", held)):
                rows = m[0, 0]
                total = m[-1, -1] - m[0, -1] ** 2 / rows if rows else 0.0
                line.r2[role] = float(1 - max(full @ m @ full, 0.0) / total) if rows and total > 0 else None
            line.rmse = float(np.sqrt(max(full @ own @ full, 0.0) / n))
            out.append(line)
        return out

    def predictions(self, df: DataFrame, lines: Sequence[Line], keep: Sequence[str]) -> DataFrame:
        """Out-of-fold rows: keep columns, fold_idx, prediction; ``lines`` holds one
        line a fold."""
        fold = self.split.test_fold(F.col(self.pos_col))
        choice = F.array(*[line.column() for line in lines])
        return df.select(*keep, fold.alias("fold_idx"), F.get(choice, fold.cast("int")).alias("prediction")).where("fold_idx is not null")


def fold_grams(df: DataFrame, split: TimeSplit, features: Sequence[str], targets: Sequence[str], pos_col: str = "split_pos",
               expand: Callable[[np.ndarray], np.ndarray] | None = None, expanded: Sequence[str] = ()) -> FoldGrams:
    """One scan for all folds.  ``expand`` makes the features named in
    ``expanded`` of those read."""
    bounds = [split.bounds(i) for i in range(split.k)]
    cuts = sorted({x for b in bounds for x in b})
    parts = gram(df, features, targets, _segment(F.col(f"`{pos_col}`"), cuts), expand, len(expanded))
    features = list(expanded) if expand else features
    side = 1 + 2 * len(features) + len(targets)

    def between(low: int, high: int) -> np.ndarray:
        ids = range(cuts.index(low) + 1, cuts.index(high) + 1) if high > low else ()
        return sum((parts[i] for i in ids if i in parts), np.zeros((side, side)))

    return FoldGrams(list(features), list(targets), split, [between(*b[:2]) for b in bounds], [between(*b[2:]) for b in bounds], pos_col)
