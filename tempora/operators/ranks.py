"""Exact order statistics and ranks per group without sorting a group in one
task.

Spark's exact ``percentile`` keeps a value→count map per group and a plain
``Window.partitionBy(group).orderBy(value)`` sorts a whole group in one
task; both break when one group holds a third of all rows.  Here:

1. rows become value counts by ``groupBy(group, value)``: equal values
   combine before the shuffle, and no shuffle is on the group alone;
2. the distinct (group, value) rows are range-partitioned, so every range
   has about as many rows, however rows spread over groups; the range number
   is written with them;
3. counts per (group, range) — at most ranges + groups rows — are summed up
   to the rank at which each range starts;
4. exact work happens inside single (group, range) parts: those that hold a
   requested rank.

Prefix ranks range-partition the rows themselves by (group, order, tie).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.session import materialize, release


def _ks(keys) -> list[str]:
    if keys is None:
        return []
    return [keys] if isinstance(keys, str) else list(keys)


def _grouped(df: DataFrame, keys):
    """Whole-table statistics use a constant group key, so every step is
    the same keyed aggregate / join (no cartesian attach)."""
    ks = _ks(keys)
    if ks:
        return df, ks, False
    return df.withColumn("_all", F.lit(0)), ["_all"], True


def in_ranges(df: DataFrame, order: list[str], n_ranges: int | None, name: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and written, with the range
    number ``_b`` (ascending with ``order``)."""
    n = n_ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *order).withColumn("_b", F.spark_partition_id()), name)


def value_ranges(df: DataFrame, ks: list, col: str, n_ranges: int | None = None) -> DataFrame:
    """Written table (keys, value, ``_c`` rows with that value, ``_b``)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(*ks, col).agg(F.count("*").alias("_c"))
    counts = materialize(counts, "ranks-values")
    out = in_ranges(counts, [*ks, col], n_ranges, "ranks-ranges")
    release(counts)
    return out


def range_offsets(ranges: DataFrame, ks: list, size, y: str | None = None) -> DataFrame:
    """Per (group, range): ``_bn`` rows, ``_off`` rows before it, ``_n`` rows of
    the group; with ``y`` also its sum ``_bs`` and the sum before, ``_yoff``."""
    aggs = [F.sum(size).alias("_bn")] + ([F.sum(y).alias("_bs")] if y else [])
    bt = ranges.groupBy(*ks, "_b").agg(*aggs)
    whole = Window.partitionBy(*ks)
    w = whole.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    bt = bt.withColumn("_off", F.coalesce(F.sum("_bn").over(w), F.lit(0))).withColumn("_n", F.sum("_bn").over(whole))
    if y:
        bt = bt.withColumn("_yoff", F.coalesce(F.sum("_bs").over(w), F.lit(0.0)))
    return bt


def values_at_ranks(df: DataFrame, keys, col: str, ranks: dict, n_buckets: int | None = None) -> DataFrame:
    """Exact values at 1-based ranks.  ``ranks`` maps an output name to a
    Column expression of ``_n`` (the group's non-null count).  Returns one
    row per group with one column per name."""
    out = _values(df, keys, col, ranks, n_buckets).drop("_n")
    return out if _ks(keys) else out.drop("_all")


def _values(df: DataFrame, keys, col: str, ranks: dict, n_buckets: int | None) -> DataFrame:
    df, ks, _ = _grouped(df, keys)
    vals = value_ranges(df, ks, col, n_buckets)
    off = range_offsets(vals, ks, F.col("_c"))
    wanted = F.array(*[F.struct(F.lit(k).alias("name"), v.cast("long").alias("r")) for k, v in ranks.items()])
    # ranks that lie in a range, told on the small table; other ranges aren't sorted
    need = off.withColumn("_q", F.filter(wanted, lambda q: (q["r"] > F.col("_off")) & (q["r"] <= F.col("_off") + F.col("_bn")))) \
              .where(F.size("_q") > 0).select(*ks, "_b", "_off", "_n", "_q")
    w = Window.partitionBy(*ks, "_b").orderBy(col).rowsBetween(Window.unboundedPreceding, 0)
    rows = vals.join(need, ks + ["_b"]).withColumn("_upto", F.col("_off") + F.sum("_c").over(w))
    hit = F.filter("_q", lambda q: (q["r"] <= F.col("_upto")) & (q["r"] > F.col("_upto") - F.col("_c")))
    found = rows.withColumn("_hit", F.transform(hit, lambda q: q["name"])).where(F.size("_hit") > 0)
    return found.groupBy(*ks).agg(F.max("_n").alias("_n"), *[
        F.max(F.when(F.array_contains("_hit", k), F.col(col))).alias(k) for k in ranks])


def nearest_quantiles(df: DataFrame, keys, col: str, qs: dict, n_buckets: int | None = None) -> DataFrame:
    """Nearest-rank quantiles: 0-based index ``round_half_up((n-1)·q)``."""
    return values_at_ranks(df, keys, col, {name: F.floor((F.col("_n") - 1) * F.lit(q) + F.lit(0.5)) + 1
                                           for name, q in qs.items()}, n_buckets)


def linear_quantiles(df: DataFrame, keys, col: str, qs: dict, n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (same weighting as Spark's exact
    ``percentile``): position ``(n-1)·q`` between its floor and ceil ranks."""
    ranks = {}
    for name, q in qs.items():
        pos = (F.col("_n") - 1) * F.lit(float(q))
        ranks[f"{name}__lo"] = F.floor(pos) + 1
        ranks[f"{name}__hi"] = F.ceil(pos) + 1
    v = _values(df, keys, col, ranks, n_buckets)
    outs = []
    for name, q in qs.items():
        pos = (F.col("_n") - 1) * F.lit(float(q))
        lo, hi = F.floor(pos), F.ceil(pos)
        a, b = F.col(f"{name}__lo"), F.col(f"{name}__hi")
        outs.append(F.when(lo == hi, a).otherwise(a * (hi - pos) + b * (pos - lo)).alias(name))
    out = v.select(*_ks(keys), *outs)
    # a table without values still has its one row for the whole
    return out if _ks(keys) else out.groupBy().agg(*[F.max(n).alias(n) for n in qs])


def prefix_ranks(df: DataFrame, keys, order: str, tie: str, y: str, n_buckets: int | None = None) -> DataFrame:
    """Global 1-based rank ``_i`` by ``(order, tie)`` and running sum ``_cum``
    of ``y`` within each group, plus ``_n`` and ``_tot`` — a distributed
    prefix scan: exact order only inside ranges, offsets from the small
    range table."""
    df, ks, tmp = _grouped(df, keys)
    rows = materialize(df.where(F.col(order).isNotNull()), "ranks-rows")
    b = in_ranges(rows, [*ks, order, tie], n_buckets, "ranks-ranges")
    release(rows)
    off = range_offsets(b, ks, F.lit(1), y)
    off = off.withColumn("_tot", F.sum("_bs").over(Window.partitionBy(*ks)))
    j = b.join(off.select(*ks, "_b", "_off", "_yoff", "_n", "_tot"), ks + ["_b"])
    w = Window.partitionBy(*ks, "_b").orderBy(order, tie)
    out = (j.withColumn("_i", F.col("_off") + F.row_number().over(w))
              .withColumn("_cum", F.col("_yoff") + F.sum(y).over(w.rowsBetween(Window.unboundedPreceding, 0)))
              .drop("_b", "_off", "_yoff"))
    return out.drop("_all") if tmp else out
