"""Forward-chaining time splits (#106-#108, C1).

Fold membership is computed *arithmetically* from a row's position in the
prediction grid: no join, no global sort.  A row becomes one output row per
(fold, role) it belongs to — at most ``k`` rows, a bound fixed by the split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TimeSplit:
    """``TimeSeriesSplit(n_splits=k, test_size=T, gap=g, max_train_size=M)``
    over ``n`` positions 0..n-1 (end-exclusive bounds)."""
    n: int
    k: int = 5
    test_size: int | None = None
    gap: int = 0
    max_train: int | None = None

    @property
    def t(self) -> int:
        return self.test_size if self.test_size else self.n // (self.k + 1)

    def bounds(self, i: int) -> tuple[int, int, int, int]:
        """(train_start, train_end, test_start, test_end) of fold ``i``."""
        ts = self.n - (self.k - i) * self.t
        te = ts + self.t
        tr_end = ts - self.gap
        tr_start = 0 if self.max_train is None else max(0, tr_end - self.max_train)
        if tr_end <= 0:
            raise ValueError(f"fold {i} has no training rows")
        return tr_start, tr_end, ts, te

    def bounds_table(self, spark) -> DataFrame:
        rows = [(i, *self.bounds(i)) for i in range(self.k)]
        return spark.createDataFrame(
            rows, "fold_idx long, train_start long, train_end long, test_start long, test_end long")

    # -- column expressions on a 0-based position column ----------------------
    def test_fold(self, p: Column) -> Column:
        first = self.n - self.k * self.t
        return F.when((p >= first) & (p < self.n), F.floor((p - first) / self.t)).cast("long")

    def train_folds(self, p: Column) -> Column:
        """Array of fold ids whose training range contains ``p``."""
        t, g, n, k = self.t, self.gap, self.n, self.k
        m = self.max_train

        def contains(i):
            ts = F.lit(n) - (F.lit(k) - i) * F.lit(t)
            tr_end = ts - F.lit(g)
            tr_start = F.lit(0) if m is None else F.greatest(F.lit(0), tr_end - F.lit(m))
            return (p >= tr_start) & (p < tr_end)
        return F.filter(F.sequence(F.lit(0), F.lit(k - 1)), contains)


def assign_folds(df: DataFrame, split: TimeSplit, pos_col: str = "split_pos") -> DataFrame:
    """Rows × (fold_idx, role) — train and test memberships (#106, #41)."""
    p = F.col(pos_col)
    test = F.when(split.test_fold(p).isNotNull(),
                  F.array(F.struct(split.test_fold(p).alias("fold_idx"), F.lit("test").alias("role"))))
    train = F.transform(split.train_folds(p),
                        lambda i: F.struct(i.cast("long").alias("fold_idx"), F.lit("train").alias("role")))
    both = F.concat(F.coalesce(test, F.array().cast("array<struct<fold_idx:long,role:string>>")), train)
    return df.select("*", F.inline(both))


def fold_report(assigned: DataFrame, time_col: str = "prediction_time") -> DataFrame:
    """Fold sizes and time ranges (#107)."""
    return (assigned.groupBy("fold_idx", "role")
            .agg(F.count("*").alias("n_rows"), F.min(time_col).alias("first_time"),
                 F.max(time_col).alias("last_time")))


def year_split(df: DataFrame, time_col: str = "time") -> DataFrame:
    """Year-based expanding split (#108): fold per year after the first;
    test = that year, train = all earlier years."""
    yr = F.year(time_col)
    b = df.agg(F.min(yr).alias("y0"), F.max(yr).alias("y1")).first()   # two scalars
    y0, y1 = b["y0"], b["y1"]
    seq = F.sequence(F.lit(y0 + 1), F.lit(y1))
    mem = F.transform(F.filter(seq, lambda y: y >= yr),
                      lambda y: F.struct((y - F.lit(y0 + 1)).cast("long").alias("fold_idx"),
                                         F.when(y == yr, F.lit("test")).otherwise(F.lit("train"))
                                         .alias("role")))
    return df.select("*", F.inline(mem))
