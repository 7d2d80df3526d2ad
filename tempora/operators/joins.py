"""Joins the reference needs beyond plain equi-joins (#36-#42)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tempora.functions.timecols import micros


def join_renamed_key(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                     how: str = "inner") -> DataFrame:
    """``left_on`` / ``right_on`` join keeping the left key name (#36)."""
    return left.join(right.withColumnRenamed(right_key, left_key), left_key, how)


def concat_by_key(frames: dict, keys) -> DataFrame:
    """Key-based replacement of positional horizontal concat (#39): each
    frame contributes its non-key columns; rows are matched on ``keys``."""
    out = None
    for _, df in frames.items():
        out = df if out is None else out.join(df, keys, "inner")
    return out


def asof_available(grid: DataFrame, events: DataFrame, keys, grid_time: str, event_time: str,
                   value_cols, tie_col: str, system_lag_us: int = 0,
                   block_us: int = 7 * 86_400_000_000, grid_step_us: int | None = None) -> DataFrame:
    """As-of join with a system lag (#42, #105c): for each grid row the last
    event (by ``(available_at, tie_col)``) with ``available_at = event_time +
    lag <= grid_time``.

    With ``grid_step_us`` (grid times are multiples of it since the epoch)
    events are first reduced to the last one per key and grid slot, by an
    aggregate that combines before the shuffle; no later partition then
    grows with the events in a week, only with the grid.

    Union + carried ``last`` over time blocks: the in-block scan is a
    bounded window per (keys, block); the carry across blocks runs on one
    summary row per block, so no series is ever scanned in one task.
    """
    ks = [keys] if isinstance(keys, str) else list(keys)
    vals = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    ev = events.select(*ks, (micros(event_time) + F.lit(system_lag_us)).alias("_t"),
                       F.lit(0).alias("_kind"), F.col(tie_col).alias("_tie"),
                       F.struct((micros(event_time) + F.lit(system_lag_us)).alias("t"),
                                F.col(tie_col).alias("tie"),
                                *[F.col(v).alias(v) for v in vals]).alias("_rec"),
                       F.lit(None).cast("timestamp_ntz").alias(grid_time))
    if grid_step_us:  # the slot ends at the first grid time at which the event is available
        slot = F.ceil(F.col("_t") / F.lit(grid_step_us))
        last = ev.groupBy(*ks, slot.alias("_slot")).agg(F.max("_rec").alias("_rec"))
        ev = last.select(*ks, F.col("_rec.t").alias("_t"), F.lit(0).alias("_kind"), F.col("_rec.tie").alias("_tie"), "_rec",
                         F.lit(None).cast("timestamp_ntz").alias(grid_time))
    gr = grid.select(*ks, micros(grid_time).alias("_t"), F.lit(1).alias("_kind"),
                     F.lit(None).cast(ev.schema["_tie"].dataType).alias("_tie"),
                     F.lit(None).cast(ev.schema["_rec"].dataType).alias("_rec"),
                     F.col(grid_time))
    u = ev.unionByName(gr).withColumn("_blk", F.floor(F.col("_t") / F.lit(block_us)))
    w = Window.partitionBy(*ks, "_blk").orderBy("_t", "_kind", "_tie")
    u = u.withColumn("_in", F.last("_rec", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    summ = u.groupBy(*ks, "_blk").agg(F.max("_rec").alias("_last"))
    ws = Window.partitionBy(*ks).orderBy("_blk")
    carry = summ.select(*ks, "_blk", F.last("_last", ignorenulls=True)
                        .over(ws.rowsBetween(Window.unboundedPreceding, -1)).alias("_carry"))
    g = u.where(F.col("_kind") == 1).join(carry, ks + ["_blk"], "left")
    rec = F.coalesce("_in", "_carry")
    return g.select(*ks, grid_time, F.timestamp_micros(rec["t"]).cast("timestamp_ntz").alias("available_at"),
                    *[rec[v].alias(v) for v in vals])
