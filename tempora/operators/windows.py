"""Ordered operators on a grid: lags, leads, rolling statistics, carries,
interpolation and differences (#54-#66).

Scale design
------------
A plain ``Window.partitionBy(series).orderBy(time)`` puts a whole series in one
task; a series that holds a third of all rows would then be one third of the
job in one task.  Every ordered operator here therefore runs on *halo
blocks*: the grid position ``pos`` is cut into blocks of ``block_size``
steps, each row is copied into the (at most two) blocks whose frames need it,
the window is partitioned by ``(series…, block)`` and only home rows are
kept.  Bounded frames (lags, leads, rolling windows) need nothing else.

Unbounded carries (last / next known value for interpolation) use a
two-level scan: per-block summaries (one row per block, pre-aggregated map
side) are carried across blocks on the small summary table, joined back, and
combined with the in-block scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_BLOCK = 4096

WinFn = Callable[["Window"], Column]


def _keys(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def with_windows(df: DataFrame, keys, pos_col: str, columns: Sequence[tuple[str, WinFn]],
                 lookback: int, lookahead: int = 0, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Add window columns computed over halo blocks.

    ``columns`` is a list of ``(name, fn)`` where ``fn(w)`` builds a Column
    from the ordered window spec ``w`` (partitioned by keys + block, ordered
    by ``pos_col``).  ``lookback``/``lookahead`` are the widest row reach of
    any frame, in grid steps.  Rows must be aligned on a full grid (one row
    per position) for row frames to equal clock frames.
    """
    ks = _keys(keys)
    b = max(int(block_size), int(lookback) + int(lookahead) + 1)
    pos = F.col(pos_col)
    lo = F.floor((pos - F.lit(lookahead)) / F.lit(b))
    hi = F.floor((pos + F.lit(lookback)) / F.lit(b))
    dup = (df.withColumn("_home_blk", F.floor(pos / F.lit(b)))
             .withColumn("_blk", F.explode(F.array_distinct(F.array(lo, hi)))))
    w = Window.partitionBy(*ks, "_blk").orderBy(pos_col)
    out = dup.select("*", *[fn(w).alias(name) for name, fn in columns])
    return out.where(F.col("_blk") == F.col("_home_blk")).drop("_blk", "_home_blk")


# ---------------------------------------------------------------- factories

def lag(c: str, k: int) -> WinFn:
    return lambda w: F.lag(c, k).over(w)


def lead(c: str, k: int) -> WinFn:
    return lambda w: F.lead(c, k).over(w)


def _frame(w, size: int, offset: int = 0):
    """Rows ``[t - offset - size + 1, t - offset]``."""
    return w.rowsBetween(-(offset + size - 1), -offset)


def rolling_agg(c: str, size: int, agg: Callable[[Column], Column], offset: int = 0) -> WinFn:
    """Generic trailing aggregate; null unless the frame holds ``size``
    non-null values (the reference's min-periods = window size)."""
    def build(w):
        fr = _frame(w, size, offset)
        return F.when(F.count(c).over(fr) == size, agg(F.col(c)).over(fr))
    return build


def rolling_mean(c: str, size: int, offset: int = 0) -> WinFn:
    return rolling_agg(c, size, F.avg, offset)


def rolling_std(c: str, size: int, offset: int = 0) -> WinFn:
    return rolling_agg(c, size, F.stddev_samp, offset)


def rolling_max(c: str, size: int, offset: int = 0) -> WinFn:
    return rolling_agg(c, size, F.max, offset)


def rolling_min(c: str, size: int, offset: int = 0) -> WinFn:
    return rolling_agg(c, size, F.min, offset)


def nearest_index(n: int, q: float) -> int:
    """0-based index of the nearest-rank quantile: round half up of (n-1)·q."""
    import math
    return int(math.floor((n - 1) * q + 0.5))


@dataclass(frozen=True)
class Derived:
    """A column computed by plain expressions over shared window columns.

    ``needs`` are ``(name, window_fn, lookback)`` triples evaluated once in
    the window pass (deduplicated by name); ``expr`` then reads them.  Rolling
    quantiles use this so every quantile of one frame shares one sorted
    frame array instead of re-aggregating the frame per statistic."""
    needs: tuple
    expr: Column

    def __sub__(self, other: "Derived") -> "Derived":
        return Derived(self.needs + other.needs, self.expr - other.expr)


def sorted_frame(c: str, size: int, offset: int = 0):
    """``(name, fn, lookback)`` of the sorted values of a full trailing frame
    (null unless all ``size`` rows are non-null)."""
    name = f"_sf_{c}_{size}_{offset}"

    def build(w):
        fr = _frame(w, size, offset)
        return F.when(F.count(c).over(fr) == size, F.array_sort(F.collect_list(c).over(fr)))
    return name, build, size - 1 + offset


def quantile_of_sorted(arr: Column, n: int, q: float, method: str) -> Column:
    """Quantile of a sorted array of known length ``n``."""
    if method == "nearest":
        return F.element_at(arr, nearest_index(n, q) + 1)
    if method != "linear":
        raise ValueError("method must be 'nearest' or 'linear'")
    pos = (n - 1) * q
    lo, hi = int(pos // 1), int(-(-pos // 1))
    if lo == hi:
        return F.element_at(arr, lo + 1)
    # same weighting as Spark's exact percentile
    return F.element_at(arr, lo + 1) * F.lit(hi - pos) + F.element_at(arr, hi + 1) * F.lit(pos - lo)


def rolling_quantile(c: str, q: float, size: int, method: str = "nearest",
                     offset: int = 0) -> Derived:
    """Trailing quantile over ``size`` rows: ``linear`` (exact percentile
    interpolation) or ``nearest`` (index ``round_half_up((size-1)·q)``)."""
    need = sorted_frame(c, size, offset)
    return Derived((need,), quantile_of_sorted(F.col(need[0]), size, q, method))


def rolling_median(c: str, size: int, offset: int = 0) -> Derived:
    """Rolling median: linear at 0.5 (mean of the two middle values)."""
    return rolling_quantile(c, 0.5, size, "linear", offset)


def rolling_iqr(c: str, size: int, method: str = "nearest", offset: int = 0) -> Derived:
    return rolling_quantile(c, 0.75, size, method, offset) - rolling_quantile(c, 0.25, size, method, offset)


def difference(c: str, k: int = 1) -> WinFn:
    return lambda w: F.col(c) - F.lag(c, k).over(w)


@dataclass(frozen=True)
class Spec:
    """A named window column with its reach (for block sizing).  ``fn`` is a
    window function builder or a :class:`Derived` expression."""
    name: str
    fn: object
    lookback: int = 0
    lookahead: int = 0


def apply_specs(df: DataFrame, keys, pos_col: str, specs: Sequence[Spec],
                block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """All specs share one window spec, hence one shuffle and one sort.
    Shared frame arrays of :class:`Derived` specs are computed once."""
    if not specs:
        return df
    lb = max(s.lookback for s in specs)
    la = max(s.lookahead for s in specs)
    wins, needs, post = [], {}, []
    for s in specs:
        if isinstance(s.fn, Derived):
            for name, fn, _ in s.fn.needs:
                needs.setdefault(name, fn)
            post.append(s.fn.expr.alias(s.name))
        else:
            wins.append((s.name, s.fn))
    out = with_windows(df, keys, pos_col, wins + list(needs.items()), lb, la, block_size)
    if post:
        out = out.select("*", *post).drop(*needs)
    return out


def plain_window(df: DataFrame, keys, pos_col: str, specs: Sequence[Spec]) -> DataFrame:
    """Reference evaluation of ``specs`` over one window per series (no
    blocks) — used by tests to check the halo-block plan."""
    w = Window.partitionBy(*_keys(keys)).orderBy(pos_col)
    wins, needs, post = [], {}, []
    for s in specs:
        if isinstance(s.fn, Derived):
            for name, fn, _ in s.fn.needs:
                needs.setdefault(name, fn)
            post.append(s.fn.expr.alias(s.name))
        else:
            wins.append(s.fn(w).alias(s.name))
    out = df.select("*", *wins, *[fn(w).alias(n) for n, fn in needs.items()])
    return out.select("*", *post).drop(*needs) if post else out


# ------------------------------------------------------------ spec builders

def lag_spec(c: str, k: int, name: str | None = None) -> Spec:
    return Spec(name or f"{c}_lag_{k}", lag(c, k), lookback=k)


def lead_spec(c: str, k: int, name: str | None = None) -> Spec:
    return Spec(name or f"{c}_lead_{k}", lead(c, k), lookahead=k)


def rolling_spec(name: str, fn: WinFn, size: int, offset: int = 0) -> Spec:
    return Spec(name, fn, lookback=size - 1 + offset)


# ------------------------------------------------------ unbounded carries

def carry_known(df: DataFrame, keys, pos_col: str, value_col: str,
                block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Add ``_prev`` / ``_next`` structs ``(pos, v)``: the last known value at
    or before the row and the first known value at or after it, across any
    gap length, via a two-level block scan.

    The block summaries are window aggregates over the *same* partitioning
    (keys, block) as the in-block scan, so the source is shuffled once
    (the summary branch reuses that exchange); only the summary table —
    one row per block — is re-partitioned by series for the carry."""
    ks = _keys(keys)
    b = int(block_size)
    v = F.col(value_col)
    known = F.when(v.isNotNull(), F.struct(F.col(pos_col).alias("pos"), v.alias("v")))
    d = df.withColumn("_blk", F.floor(F.col(pos_col) / F.lit(b))).withColumn("_known", known)
    # running frames only: an UNBOUNDED FOLLOWING frame is re-evaluated per
    # row by Spark (quadratic), so "next known" is a running last() over the
    # descending order instead.
    w_in = Window.partitionBy(*ks, "_blk").orderBy(pos_col)
    w_rev = Window.partitionBy(*ks, "_blk").orderBy(F.col(pos_col).desc())
    w_all = Window.partitionBy(*ks, "_blk")
    d = (d.withColumn("_prev_in", F.last("_known", ignorenulls=True)
                      .over(w_in.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_next_in", F.last("_known", ignorenulls=True)
                      .over(w_rev.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("_blk_last", F.max("_known").over(w_all))
          .withColumn("_blk_first", F.min("_known").over(w_all))
          .withColumn("_blk_rn", F.row_number().over(w_in)))
    # one row per block, taken from the same window pass (a filter, no aggregate)
    summ = d.where(F.col("_blk_rn") == 1).select(*ks, "_blk", "_blk_last", "_blk_first")
    ws = Window.partitionBy(*ks).orderBy("_blk")
    ws_rev = Window.partitionBy(*ks).orderBy(F.col("_blk").desc())
    carry = summ.select(
        *ks, "_blk",
        F.last("_blk_last", ignorenulls=True).over(ws.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_carry_prev"),
        F.last("_blk_first", ignorenulls=True).over(ws_rev.rowsBetween(Window.unboundedPreceding, -1))
        .alias("_carry_next"))
    out = d.drop("_blk_last", "_blk_first", "_blk_rn").join(carry, on=ks + ["_blk"], how="left")
    return (out.withColumn("_prev", F.coalesce("_prev_in", "_carry_prev"))
               .withColumn("_next", F.coalesce("_next_in", "_carry_next"))
               .drop("_blk", "_known", "_prev_in", "_next_in", "_carry_prev", "_carry_next"))


def interpolate_linear(df: DataFrame, keys, pos_col: str, value_col: str,
                       out_col: str | None = None, block_size: int = DEFAULT_BLOCK) -> DataFrame:
    """Linear interpolation of interior gaps (#63); leading / trailing gaps
    stay null, as in the reference."""
    out_col = out_col or value_col
    d = carry_known(df, keys, pos_col, value_col, block_size)
    p, n = F.col("_prev"), F.col("_next")
    interp = F.when(F.col(value_col).isNotNull(), F.col(value_col)).when(
        p.isNotNull() & n.isNotNull(),
        p["v"] + (n["v"] - p["v"]) * (F.col(pos_col) - p["pos"]) / (n["pos"] - p["pos"]))
    return d.withColumn(out_col, interp).drop("_prev", "_next")
