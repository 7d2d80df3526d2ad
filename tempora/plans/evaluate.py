"""Evaluation operators (#115-#125, #140-#148) as aggregate plans.

Input is a long prediction table
``(model, fold_idx, prediction_time, [horizon,] load_mw, predicted_load_mw
[, lower, upper])``.  Metrics are partial aggregates (map-side combine, no
per-group collection); statistics that need a group-level value first (R²'s
mean, a pinball baseline quantile, bin edges) run as two aggregate passes
joined on the small per-group table, which is bounded by the number of
groups and broadcast.
"""

from __future__ import annotations

import sys
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions.rounding import round_half_even as bround
from tempora.operators import ranks as R
from tempora.session import materialize
from tempora.operators import windows as W

EPS = sys.float_info.epsilon


def _ks(keys) -> list[str]:
    return W._keys(keys)


# ------------------------------------------------------------ point scores

def point_scores(df: DataFrame, keys, y: str = "load_mw", p: str = "predicted_load_mw",
                 prefix: str = "") -> DataFrame:
    """MAPE, R², MAE, MSE per group (#140, #141) in one aggregate pass.
    R²'s total sum of squares is ``var_pop(y)·n`` (stable, mergeable)."""
    yc, pc = F.col(y), F.col(p)
    res = F.sum((yc - pc) * (yc - pc))
    ss_tot = F.var_pop(yc) * F.count(yc)
    return df.groupBy(*_ks(keys)).agg(
        F.avg(F.abs(yc - pc) / F.greatest(F.abs(yc), F.lit(EPS))).alias(f"{prefix}mape"),
        F.when(ss_tot > 0, 1 - res / ss_tot).alias(f"{prefix}r2"),
        F.avg(F.abs(yc - pc)).alias(f"{prefix}mae"),
        F.avg((yc - pc) * (yc - pc)).alias(f"{prefix}mse"),
        F.count("*").alias(f"{prefix}n"))


def deviance_scores(df: DataFrame, keys, y: str = "load_mw", p: str = "predicted_load_mw") -> DataFrame:
    """D² Poisson and gamma (#142, C5).  The baseline deviance at the group
    mean folds into the same pass: Σdev(y, ȳ) is a function of Σy, Σy·ln y,
    Σln y and n.  Rows without truth or prediction don't count; a prediction
    of 0 or less leaves both null, a truth of 0 the gamma score, a truth
    below 0 both."""
    yc, pc = F.col(y), F.col(p)
    df = df.where(yc.isNotNull() & pc.isNotNull())
    ylny = F.when(yc > 0, yc * F.log(yc)).otherwise(F.lit(0.0))
    pois = 2 * (F.when(yc > 0, yc * F.log(F.try_divide(yc, pc))).otherwise(F.lit(0.0)) - yc + pc)
    gam = 2 * (F.log(F.try_divide(pc, yc)) + F.try_divide(yc, pc) - 1)
    g = df.groupBy(*_ks(keys)).agg(
        F.sum(pois).alias("_dp"), F.sum(gam).alias("_dg"), F.sum(yc).alias("_sy"),
        F.sum(ylny).alias("_sylny"), F.sum(F.log(yc)).alias("_slny"), F.count(yc).alias("_n"),
        F.min(pc).alias("_pmin"), F.min(yc).alias("_ymin"))
    ybar = F.col("_sy") / F.col("_n")
    base_p = 2 * (F.col("_sylny") - F.col("_sy") * F.log(ybar))
    base_g = 2 * (F.col("_n") * F.log(ybar) - F.col("_slny"))
    return g.select(*_ks(keys),
                    F.when((F.col("_pmin") <= 0) | (F.col("_ymin") < 0), F.lit(None)).when(base_p != 0, 1 - F.col("_dp") / base_p)
                    .cast("double").alias("d2_poisson"),
                    F.when((F.col("_pmin") <= 0) | (F.col("_ymin") <= 0), F.lit(None)).when(base_g != 0, 1 - F.col("_dg") / base_g)
                    .cast("double").alias("d2_gamma"))


def pinball(y: Column, p: Column, alpha: float) -> Column:
    return F.lit(alpha) * F.greatest(y - p, F.lit(0.0)) + F.lit(1 - alpha) * F.greatest(p - y, F.lit(0.0))


def pinball_scores(df: DataFrame, keys, alphas: Sequence[float] = (0.05, 0.5, 0.95),
                   y: str = "load_mw", preds: dict | None = None) -> DataFrame:
    """D² pinball per alpha (#143, C5): ``1 - ΣL(y,p) / ΣL(y, q_alpha(y))``
    with the baseline quantile linear (exact ``percentile``).  ``preds``
    maps alpha → prediction column (default: the point prediction)."""
    ks = _ks(keys)
    preds = preds or {a: "predicted_load_mw" for a in alphas}
    names = {a: f"_q{i}" for i, a in enumerate(alphas)}
    qv = R.linear_quantiles(df, ks, y, {n: a for a, n in names.items()})
    qs = qv.select(*ks, F.array(*[F.col(names[a]) for a in alphas]).alias("_q"))
    if ks:
        j = df.join(qs, ks)               # one row per group; AQE broadcasts when small
    else:
        j = df.withColumn("_q", F.array(*[F.lit(float(v)) for v in qs.first()["_q"]]))
    aggs = []
    for i, a in enumerate(alphas):
        tag = f"{int(round(a * 100)):02d}"
        aggs += [F.sum(pinball(F.col(y), F.col(preds[a]), a)).alias(f"_m{tag}"),
                 F.sum(pinball(F.col(y), F.col("_q")[i], a)).alias(f"_b{tag}")]
    g = j.groupBy(*ks).agg(*aggs)
    outs = []
    for a in alphas:
        tag = f"{int(round(a * 100)):02d}"
        outs.append(F.when(F.col(f"_b{tag}") != 0, 1 - F.col(f"_m{tag}") / F.col(f"_b{tag}"))
                    .alias(f"d2_pinball_{tag}"))
    return g.select(*ks, *outs)


# ------------------------------------------------------------ intervals

def coverage_width(df: DataFrame, keys, y="load_mw", lo="lower", hi="upper") -> DataFrame:
    """Coverage (both ends inclusive, half-even 4 digits) and mean width
    (half-even 1 digit) (#121).  ``n_samples`` counts the rows that coverage
    is taken over: those with a truth and both ends."""
    inside = ((F.col(y) >= F.col(lo)) & (F.col(y) <= F.col(hi))).cast("double")
    return df.groupBy(*_ks(keys)).agg(
        bround(F.avg(inside), 4).alias("coverage"),
        bround(F.avg(F.abs(F.col(hi) - F.col(lo))), 1).alias("mean_width"),
        F.count(inside).alias("n_samples"))


def linear_edges(df: DataFrame, keys, col: str, probs: Sequence[float], out: str = "edges") -> DataFrame:
    """Exact linear quantile edges per group, as one array column (bucketed
    exact rank selection — no per-group value map)."""
    names = {f"_e{i}": float(q) for i, q in enumerate(probs)}
    v = R.linear_quantiles(df, keys, col, names)
    return v.select(*_ks(keys), F.array(*[F.col(n) for n in names]).alias(out))


def binned_coverage(df: DataFrame, n_bins: int = 10, y="load_mw", lo="lower", hi="upper",
                    fold: str = "fold_idx") -> DataFrame:
    """Coverage per quantile bin of the truth, per fold (#122, C6).

    Pooled linear quantile edges (≤ n_bins + 1 values) and the re-described
    bin left edges (≤ n_bins values) are computed by aggregate jobs and come
    back as bounded literal arrays; every row is then binned in place.  Rows
    without a truth have no bin and don't count; no truth at all gives no rows."""
    df = df.where(F.col(y).isNotNull())
    probs = [i / n_bins for i in range(n_bins + 1)]
    edges = sorted({v for v in linear_edges(df, [], y, probs).first()["edges"] if v is not None} or {0.0})
    e = F.array(*[F.lit(float(v)) for v in edges])
    pooled = df.withColumn("_pbin", F.greatest(F.size(F.filter(e, lambda v: v < F.col(y))) - 1, F.lit(0)))
    bounds = pooled.groupBy("_pbin").agg(F.min(y).alias("bin_left"), F.max(y).alias("bin_right"))
    brows = sorted((r["bin_left"], r["bin_right"]) for r in bounds.collect())  # ≤ n_bins rows
    lefts = F.array(*[F.lit(float(a)) for a, _ in brows])
    fold_rows = df.withColumn("_bin", F.size(F.filter(lefts, lambda v: v <= F.col(y))) - 1)
    inside = ((F.col(y) >= F.col(lo)) & (F.col(y) <= F.col(hi))).cast("double")
    g = fold_rows.groupBy(fold, "_bin").agg(
        bround(F.avg(inside), 4).alias("coverage"),
        bround(F.avg(F.abs(F.col(hi) - F.col(lo))), 1).alias("mean_width"),
        F.count("*").alias("n_samples"))
    left_of = F.element_at(lefts, F.col("_bin") + 1)
    right_of = F.element_at(F.array(*[F.lit(float(b)) for _, b in brows]), F.col("_bin") + 1)
    return g.select(left_of.alias("bin_left"), right_of.alias("bin_right"),
                    ((left_of + right_of) / 2).alias("bin_center"),
                    fold, "coverage", "mean_width", "n_samples")


# ------------------------------------------------------------ quantiles

def group_quantile_nearest(df: DataFrame, keys, col: str, q: float, out: str) -> DataFrame:
    """Exact nearest-rank quantile (index round_half_up((n-1)·q)) per group,
    by bucketed rank selection: only the rows of the one value bucket that
    holds the rank are ordered."""
    return R.nearest_quantiles(df, keys, col, {out: q})


def group_quantile_linear(df: DataFrame, keys, col: str, q: float, out: str) -> DataFrame:
    return R.linear_quantiles(df, keys, col, {out: q})


def five_number_summary(df: DataFrame, keys, col: str) -> DataFrame:
    """min, linear q25 / median / q75, max per group (#52)."""
    ks = _ks(keys)
    mm = df.groupBy(*ks).agg(F.min(col).alias("min"), F.max(col).alias("max"))
    q = R.linear_quantiles(df, ks, col, {"q25": 0.25, "median": 0.5, "q75": 0.75})
    out = mm.join(q, ks) if ks else mm.withColumns({c: F.lit(v) for c, v in q.first().asDict().items()})
    return out.select(*ks, "min", "q25", "median", "q75", "max")


# ------------------------------------------------------------ Lorenz / Gini

def lorenz(df: DataFrame, keys, y: str = "load_mw", order: str = "predicted_load_mw",
           tie: str = "prediction_time") -> DataFrame:
    """Ranked cumulative shares per group (#64, #116, C7): ``_i`` (1-based
    rank by ``(order, tie)``), ``_n``, ``cum_population``, ``cum_observed``.
    The running sum is a distributed prefix scan over value buckets (see
    :mod:`tempora.operators.ranks`), so a huge fold is never sorted in one
    task."""
    ks = _ks(keys)
    r = R.prefix_ranks(df.select(*ks, y, order, tie), ks, order, tie, y)
    r = (r.withColumn("cum_population", F.col("_i") / F.col("_n"))
          .withColumn("cum_observed", F.col("_cum") / F.col("_tot")))
    # written once: Gini, the grid and its two rank joins all read it
    return materialize(r, "lorenz")


def gini(ranked: DataFrame, keys) -> DataFrame:
    """``1 - 2·AUC`` by trapezoids between consecutive points (first point at
    1/N, no origin).  The trapezoid sum telescopes to
    ``ΣL/N - (L_1 + L_N)/(2N)``, so it is one aggregate — no ordered pass."""
    ks = _ks(keys)
    g = ranked.groupBy(*ks).agg(F.sum("cum_observed").alias("_sl"), F.first("_n").alias("_n"),
                                F.min_by("cum_observed", "_i").alias("_l1"),
                                F.max_by("cum_observed", "_i").alias("_ln"))
    auc = F.col("_sl") / F.col("_n") - (F.col("_l1") + F.col("_ln")) / (2 * F.col("_n"))
    return g.select(*ks, (1 - 2 * auc).alias("gini_index"))


def lorenz_grid(ranked: DataFrame, keys, n_samples: int = 500) -> DataFrame:
    """Curve resampled on ``linspace(0, 1, n_samples)`` with ``np.interp``
    semantics (clamped at both ends).  Each grid point joins the ranked rows
    ``i = floor(x·N)`` (clamped to [1, N]) and ``i + 1`` on equi-keys."""
    ks = _ks(keys)
    sizes = ranked.groupBy(*ks).agg(F.first("_n").alias("_n"))
    pts = sizes.select(*ks, "_n", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))).alias("_j"))
    x = F.col("_j") / F.lit(n_samples - 1)
    pts = pts.withColumn("cum_population", x).withColumn(
        "_i", F.least(F.greatest(F.floor(x * F.col("_n")), F.lit(1)), F.col("_n")).cast("long"))
    r = ranked.select(*ks, "_i", F.col("cum_observed").alias("_l"))
    rn = ranked.select(*ks, (F.col("_i") - 1).alias("_i"), F.col("cum_observed").alias("_ln"))
    j = pts.join(r, ks + ["_i"]).join(rn, ks + ["_i"], "left")
    frac = x * F.col("_n") - F.col("_i")
    val = (F.when(x * F.col("_n") <= 1, F.col("_l"))
             .when(F.col("_i") >= F.col("_n"), F.col("_l"))
             .otherwise(F.col("_l") + (F.col("_ln") - F.col("_l")) * frac))
    return j.select(*ks, "cum_population", val.alias("cum_observed"))


# ------------------------------------------------------------ reliability

def reliability(df: DataFrame, n_bins: int = 10, kind: str = "mean", quantile_level: float = 0.5,
                fold: str = "fold_idx", y: str = "load_mw", p: str = "predicted_load_mw") -> DataFrame:
    """Reliability table (#118, C4): bins from the fold's linear quantiles of
    the prediction at ``linspace(0, 1, n_bins)``, right-closed; per bin the
    mean (or nearest-rank quantile) of the truth and the mean prediction."""
    if kind not in ("mean", "quantile"):
        raise ValueError(f"a reliability table shows the mean or a quantile of the truth, not {kind!r}")
    probs = [i / (n_bins - 1) for i in range(n_bins)]
    edges = linear_edges(df, [fold], p, probs)
    b = df.join(F.broadcast(edges), fold).withColumn(
        "bin_idx", F.size(F.filter("edges", lambda e: e < F.col(p))).cast("long"))
    agg = b.groupBy(fold, "bin_idx").agg(F.avg(p).alias("mean_predicted_load_mw"),
                                         F.avg(y).alias("mean_load_mw"))
    if kind == "mean":
        return agg
    qn = group_quantile_nearest(b, [fold, "bin_idx"], y, quantile_level, "quantile_of_load_mw")
    return agg.drop("mean_load_mw").join(qn, [fold, "bin_idx"])


def fold_labels(df: DataFrame, fold: str = "fold_idx", time_col: str = "prediction_time",
                base: int = 0) -> DataFrame:
    """``#{fold+base} - {min date} to {max date}`` per fold (#80, #79)."""
    return df.groupBy(fold).agg(F.format_string(
        "#%d - %s to %s", (F.col(fold) + base).cast("int"),
        F.date_format(F.min(time_col), "yyyy-MM-dd"),
        F.date_format(F.max(time_col), "yyyy-MM-dd")).alias("fold_label"))


def residuals_binned(df: DataFrame, by: str = "hour", fold: str = "fold_idx",
                     time_col: str = "prediction_time") -> DataFrame:
    """Residual mean / q25 / q75 (nearest) by UTC hour or month, rounded to
    1 digit half-even (#120)."""
    if by == "hour":
        name, ext = "hour_of_day", F.hour(time_col)
    elif by == "month":
        name, ext = "month_of_year", F.month(time_col)
    else:
        raise ValueError(f"residuals are grouped by hour or month, not by {by!r}")
    r = df.withColumn("residual", F.col("predicted_load_mw") - F.col("load_mw")).withColumn(name, ext)
    m = r.groupBy(fold, name).agg(bround(F.avg("residual"), 1).alias("mean_residual"))
    out = m.join(R.nearest_quantiles(r, [fold, name], "residual", {"q25_residual": 0.25, "q75_residual": 0.75}), [fold, name])
    return out.select(fold, name, "mean_residual", bround("q25_residual", 1).alias("q25_residual"),
                      bround("q75_residual", 1).alias("q75_residual"))


def tail_per_group(df: DataFrame, keys, time_col: str, n: int, step) -> DataFrame:
    """Last ``n`` grid steps per group (#68) — a max per group and a time
    threshold, no per-group sort."""
    from tempora.functions.timecols import shift_time
    ks = _ks(keys)
    mx = df.groupBy(*ks).agg(F.max(time_col).alias("_mx"))
    j = df.join(F.broadcast(mx), ks)
    return j.where(F.col(time_col) > shift_time(F.col("_mx"), -n, step)).drop("_mx")
