"""Structured Streaming forms of the feature operators (#94-#99).

The reference has no streaming runtime; its "system lag" (values arrive
hours late) maps to an event-time watermark.  Sources are file streams
landed from the given tables (a folder per day).  Event streams take as many day
files a micro-batch as fit :data:`BATCH_BYTES`, so that batches grow with the input's
bytes and not with its days; the others take one file a batch.  Sinks write to the shared checkpoint folder, and
every query has its own checkpoint location, so a restarted driver resumes
where it stopped.
"""

from __future__ import annotations

import uuid
from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tempora.functions import calendar as cal
from tempora.session import scratch_path

#: Bytes of landed files that a micro-batch of an event stream takes (one file at least).
BATCH_BYTES = 64 << 20

EVENTS_SCHEMA = "event_id long, ts timestamp_ntz, event_type string, value double, day date"


def land_daily_files(df: DataFrame, path: str, time_col: str = "ts", arrival_col: str | None = None,
                     swap_adjacent: bool = False, rows_per_file: int = 0) -> str:
    """Land a table as the stream's input in one write, a folder for each
    arrival day.  A file source picks files by modification time, so the
    files' times are then set to follow the days (metadata only).
    ``arrival_col`` (a date) overrides the arrival day, e.g. to deliver some
    rows late; ``swap_adjacent`` lets days arrive pairwise swapped (2, 1, 4,
    3, …); ``rows_per_file`` splits large days (0: one file a day)."""
    arr = F.col(arrival_col) if arrival_col else F.to_date(time_col)
    d = df.withColumn("day", arr)
    if rows_per_file:
        d.write.option("maxRecordsPerFile", rows_per_file).partitionBy("day").parquet(path)
    else:
        d.repartition("day").write.partitionBy("day").parquet(path)
    jvm = df.sparkSession._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    days = sorted((s.getPath() for s in fs.listStatus(root) if s.isDirectory()), key=lambda p: p.getName())
    if swap_adjacent:
        days = [x for i in range(0, len(days), 2) for x in reversed(days[i:i + 2])]
    start = max([f.getModificationTime() for p in days for f in fs.listStatus(p)], default=0) - 60_000 * len(days)
    for i, p in enumerate(days):
        for f in fs.listStatus(p):
            fs.setTimes(f.getPath(), start + 60_000 * i, -1)
    return path


def event_stream(spark: SparkSession, path: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Landed events in the order of their files.  Days come in order, so where
    the batches are cut makes no event late."""
    return (spark.readStream.schema(EVENTS_SCHEMA).option("maxBytesPerTrigger", batch_bytes)
            .parquet(path))


def _run(query_df: DataFrame, name: str, mode: str = "append", partition_by=None) -> str:
    """Run a streaming query to completion (availableNow) into Parquet under
    the checkpoint folder; returns the output path.  Every state partition is
    opened and committed in each batch, also when empty, and nothing merges them: there
    are no more of them than cores."""
    spark = query_df.sparkSession
    out = scratch_path(spark, f"stream-{name}-{uuid.uuid4().hex[:8]}")
    w = (query_df.writeStream.format("parquet").outputMode(mode)
         .option("checkpointLocation", out + "/_checkpoint").option("path", out + "/data")
         .trigger(availableNow=True))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", min(int(before), max(spark.sparkContext.defaultParallelism, 1)))
    try:
        q = w.start()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    q.awaitTermination()
    return out + "/data"


def hourly_watermarked(stream: DataFrame, lag: str = "3 hours") -> DataFrame:
    """#94: hourly tumbling sums; a window is final once the watermark
    (max event time − system lag) passes its end."""
    return (stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lag)
            .groupBy(F.window("ts", "1 hour").alias("w"))
            .agg(F.round(F.sum("value"), 6).alias("load_mw"), F.count("*").alias("n_events"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("time"), "load_mw", "n_events"))


def sliding(stream: DataFrame, width: str = "24 hours", lag: str = "3 hours") -> DataFrame:
    """#95: windows of ``width`` sliding by 1 h (streaming form of the rolling
    block; exact percentiles: :mod:`tempora.streaming.panes`).  An hour's events
    become one pane first, and only panes are copied into the windows that they lie in."""
    panes = (stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lag)
             .groupBy(F.window("ts", "1 hour").alias("pane"))
             .agg(F.count("*").alias("n"), F.count("value").alias("n_values"), F.sum("value").alias("total"),
                  F.max("value").alias("top"))
             .select(F.window_time("pane").alias("at"), "n", "n_values", "total", "top"))
    return (panes.groupBy(F.window("at", width, "1 hour").alias("w"))
            .agg(F.sum("n").alias("n_events"), F.sum("total").alias("total"), F.sum("n_values").alias("n_values"),
                 F.max("top").alias("max_value"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"),
                    "n_events", F.when(F.col("n_values") > 0, F.col("total") / F.col("n_values")).alias("mean_value"), "max_value"))


LAG_OUT_SCHEMA = "series_id string, time timestamp_ntz, load_mw double, lag_1h double, lag_24h double"
LAG_STATE_SCHEMA = "times array<timestamp_ntz>, values array<double>"


def _known(times, values) -> pd.Series:
    """Values by time as kept in a group's state."""
    return pd.Series(list(values), index=pd.DatetimeIndex(pd.to_datetime(list(times))), dtype="float64")


def _merged(known: pd.Series, frames: list[pd.DataFrame]) -> pd.Series:
    """State and new rows in time order; of one time the last row holds."""
    new = [pd.Series(f["load_mw"].to_numpy("float64"), index=pd.DatetimeIndex(f["time"])) for f in frames]
    both = pd.concat([s for s in [known, *new] if len(s)] or [known])
    return both[~both.index.duplicated(keep="last")].sort_index()


def _lag(known: pd.Series, times: pd.DatetimeIndex, hours: int):
    return known.reindex(times - pd.Timedelta(hours=hours)).to_numpy()


def lag_state_fn(max_lag_hours: int = 168):
    """#96: per-series buffer of hourly values; lags are clock-based lookups
    over the buffer and the whole micro-batch, and only then is the buffer
    cut to the last ``max_lag_hours``, so that results don't depend on how
    ordered input is cut into batches."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        known = _known(*state.get) if state.exists else _known([], [])
        frames = list(pdfs)
        new = pd.concat(frames).sort_values("time")
        known = _merged(known, frames)
        times = pd.DatetimeIndex(new["time"])
        out = new.assign(lag_1h=_lag(known, times, 1), lag_24h=_lag(known, times, 24))
        known = known[known.index >= known.index[-1] - pd.Timedelta(hours=max_lag_hours)]
        state.update((list(known.index.to_pydatetime()), known.tolist()))
        yield out[["series_id", "time", "load_mw", "lag_1h", "lag_24h"]]
    return fn


def stateful_lags(hourly_stream: DataFrame) -> DataFrame:
    """Apply the per-series lag buffer to a stream of ``(series_id, time,
    load_mw)`` rows (state bounded by 168 values per series)."""
    return hourly_stream.groupBy("series_id").applyInPandasWithState(
        lag_state_fn(), LAG_OUT_SCHEMA, LAG_STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)


AUDIT_SCHEMA = "event_id long, ts timestamp_ntz, event_type string, value double, hours_late long"


def late_audit(stream: DataFrame, lag_hours: int, out_path: str) -> None:
    """#97: per micro-batch, rows older than (max event time of earlier
    batches − lag) go to a side table with their lateness.

    Each batch overwrites its own folder (``late/epoch=N``) and its own
    maximum (``max/epoch=N``), so a batch that is played again after a restart
    leaves the same rows, and the maximum of earlier batches is read from
    the table, not from the driver's memory."""
    spark = stream.sparkSession
    columns = [c.split()[0] for c in AUDIT_SCHEMA.split(", ")][:-1]

    def handle(batch: DataFrame, epoch: int):
        batch = batch.select(*columns)
        batch.agg(F.max("ts").alias("ts")).write.mode("overwrite").parquet(f"{out_path}/max/epoch={epoch}")
        earlier = (spark.read.schema("ts timestamp_ntz, epoch long").parquet(f"{out_path}/max")
                   .where(F.col("epoch") < epoch).agg(F.max("ts")).first()[0])
        mark = F.lit(earlier).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(lag_hours)} HOURS")
        behind = F.unix_micros(mark.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
        late = batch.where(F.col("ts") < mark).withColumn("hours_late", F.floor(behind / F.lit(3_600_000_000)).cast("long"))
        late.write.mode("overwrite").parquet(f"{out_path}/late/epoch={epoch}")

    q = (stream.writeStream.foreachBatch(handle)
         .option("checkpointLocation", out_path + "/checkpoint").trigger(availableNow=True).start())
    q.awaitTermination()


def late_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """The side table of :func:`late_audit`."""
    return spark.read.schema(AUDIT_SCHEMA + ", epoch long").parquet(f"{out_path}/late")


def with_calendar(stream: DataFrame) -> DataFrame:
    """#98: calendar columns and the holiday flag; the flag follows from the
    local date alone, whatever its year."""
    return stream.select("*", *cal.calendar_columns("time"),
                         cal.is_holiday(F.to_date(cal.local_time("time"))).alias("cal_is_holiday"))


ORDERED_STATE_SCHEMA = "times array<timestamp_ntz>, values array<double>, emitted_upto timestamp_ntz"


def ordered_lag_state_fn(max_lag_hours: int = 168):
    """#96 with out-of-order input: rows are held in the per-series state
    until the event-time watermark passes them, then emitted in time order
    with clock-based lags; an event-time timer wakes the group when the
    watermark moves past its oldest pending row.  The open tail (rows newer
    than the final watermark) stays in state, like an open window."""
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        upto, known = None, _known([], [])
        if state.exists:
            times, values, upto = state.get
            known, upto = _known(times, values), pd.Timestamp(upto) if upto is not None else None
        if not state.hasTimedOut:
            known = _merged(known, list(pdfs))
        wm_ms = state.getCurrentWatermarkMs()
        closed = known.index <= pd.Timestamp(wm_ms, unit="ms") if wm_ms and wm_ms > 0 else np.zeros(len(known), bool)
        fresh = known.index > upto if upto is not None else np.ones(len(known), bool)
        ready = known.index[closed & fresh]
        out = pd.DataFrame({"series_id": key[0], "time": ready, "load_mw": known.reindex(ready).to_numpy(),
                            "lag_1h": _lag(known, ready, 1), "lag_24h": _lag(known, ready, 24)})
        if len(ready):
            upto = ready[-1]
        if upto is not None:   # keep what later lags can still need
            known = known[known.index >= upto - pd.Timedelta(hours=max_lag_hours)]
        pending = known.index if upto is None else known.index[known.index > upto]
        if len(pending):
            due = int(pending[0].value // 1_000_000) - 1
            state.setTimeoutTimestamp(max(due, (wm_ms or 0) + 1))
        state.update((list(known.index.to_pydatetime()), known.tolist(), upto.to_pydatetime() if upto is not None else None))
        yield out
    return fn


def ordered_stateful_lags(hourly_stream: DataFrame, lateness: str = "2 days") -> DataFrame:
    """Watermarked, order-insensitive form of :func:`stateful_lags`."""
    s = hourly_stream.withColumn("time", F.col("time").cast("timestamp")).withWatermark("time", lateness)
    out_schema = LAG_OUT_SCHEMA.replace("time timestamp_ntz", "time timestamp")
    return s.groupBy("series_id").applyInPandasWithState(
        ordered_lag_state_fn(), out_schema, ORDERED_STATE_SCHEMA, "append", GroupStateTimeout.EventTimeTimeout)
