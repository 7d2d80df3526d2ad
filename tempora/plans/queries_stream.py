"""Registered streaming queries (#94-#99): each lands a table derived from
the given tables as day files, runs a Structured Streaming query to
completion (``availableNow``) and returns the sink table."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from tempora.plans import common as C
from tempora.session import scratch_path
from tempora.sources import tables as S
from tempora.streaming import panes as PN
from tempora.streaming import stream as ST

LAG = "3 hours"


def _path(spark, name):
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:10]}")


def _events_stream(spark, sf_dir):
    ev = S.read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    path = ST.land_daily_files(ev, _path(spark, "events-landed"))
    return ST.event_stream(spark, path)


def q_stream_hourly_watermark(spark, sf_dir):
    out = ST._run(ST.hourly_watermarked(_events_stream(spark, sf_dir), LAG), "hourly")
    return C.normalize(spark.read.parquet(out))


def q_stream_sliding_24h(spark, sf_dir):
    out = ST._run(ST.sliding(_events_stream(spark, sf_dir), "24 hours", LAG), "sliding")
    return C.normalize(spark.read.parquet(out))


def q_stream_sliding_7d(spark, sf_dir):
    """As above over 7 days; 168 windows for each hour's pane."""
    out = ST._run(ST.sliding(_events_stream(spark, sf_dir), "168 hours", LAG), "sliding-7d")
    return C.normalize(spark.read.parquet(out))


def _sliding_quantiles(spark, sf_dir, hours):
    """Quartiles of windows put together from hourly panes (#95); the second
    stateful operator needs the RocksDB state store."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, PN.ROCKSDB)
    try:
        out = ST._run(PN.sliding_quantiles(_events_stream(spark, sf_dir), hours, lag=LAG), f"panes-{hours}")
    finally:
        spark.conf.set(name, before)
    got = spark.read.parquet(out)
    return C.normalize(got.select("window_start", "window_end", "n_events", F.col("q0").alias("q25"), F.col("q1").alias("median_value"),
                                  F.col("q2").alias("q75"), (F.col("q2") - F.col("q0")).alias("iqr")))


def q_stream_quantiles_24h(spark, sf_dir):
    return _sliding_quantiles(spark, sf_dir, 24)


def q_stream_quantiles_7d(spark, sf_dir):
    return _sliding_quantiles(spark, sf_dir, 168)


def _hourly_panel_stream(spark, sf_dir, swap_adjacent: bool = False):
    obs = S.hourly_events(spark, sf_dir, by="event_type")
    path = ST.land_daily_files(obs, _path(spark, "panel-landed"), "time", swap_adjacent=swap_adjacent)
    schema = "series_id string, time timestamp_ntz, load_mw double, day date"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def q_stream_lag_state(spark, sf_dir):
    out = ST._run(ST.stateful_lags(_hourly_panel_stream(spark, sf_dir)), "lagstate")
    return C.normalize(spark.read.parquet(out))


def q_stream_lag_state_ordered(spark, sf_dir):
    """Lag state over day files arriving pairwise out of order, held until
    the watermark (max time − 2 days) passes each row."""
    out = ST._run(ST.ordered_stateful_lags(_hourly_panel_stream(spark, sf_dir, swap_adjacent=True)),
                  "lagstate-ordered")
    return C.normalize(spark.read.parquet(out).withColumn("time", F.col("time").cast("timestamp_ntz")))


def q_stream_late_audit(spark, sf_dir, delay_every: int = 7):
    """Every ``delay_every``-th event (by id) is delivered with the next
    day's file; the audit records those behind the watermark."""
    ev = S.read_table(spark, sf_dir, "events", ["event_id", "ts", "event_type", "value"])
    arrival = F.when(F.pmod("event_id", F.lit(delay_every)) == 0, F.date_add(F.to_date("ts"), 1)) \
               .otherwise(F.to_date("ts"))
    path = ST.land_daily_files(ev.withColumn("_arr", arrival), _path(spark, "late-landed"), "ts", "_arr")
    schema = ST.EVENTS_SCHEMA.replace(", day date", ", _arr date, day date")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = _path(spark, "late-audit")
    ST.late_audit(stream, 3, out)
    late = ST.late_rows(spark, out)
    return late.groupBy("hours_late").agg(F.count("*").alias("n_late"))


def q_stream_calendar_join(spark, sf_dir):
    h = ST.hourly_watermarked(_events_stream(spark, sf_dir), LAG)
    out = ST._run(ST.with_calendar(h), "calendar")
    return C.normalize(spark.read.parquet(out))


def q_stream_model_scoring(spark, sf_dir):
    """#99: a lag model fitted in batch and saved, loaded and applied to the
    stateful-lag stream."""
    h = C.hourly_panel(spark, sf_dir, interpolate=False)
    from tempora.operators import windows as W
    train = W.apply_specs(h.series, "series_id", "pos", [W.lag_spec("load_mw", 1, "lag_1h"),
                                                          W.lag_spec("load_mw", 24, "lag_24h")]).dropna()
    pipe = Pipeline(stages=[VectorAssembler(inputCols=["lag_1h", "lag_24h"], outputCol="features"),
                            LinearRegression(labelCol="load_mw", regParam=1e-3)])
    model_path = _path(spark, "lag-model")
    pipe.fit(train).write().overwrite().save(model_path)
    model = PipelineModel.load(model_path)
    lags = ST.stateful_lags(_hourly_panel_stream(spark, sf_dir)).dropna(subset=["lag_1h", "lag_24h"])
    out = ST._run(model.transform(lags).select("series_id", "time", "load_mw", "prediction"), "scoring")
    return C.normalize(spark.read.parquet(out))


QUERIES_STREAM = {
    "stream_hourly_watermark": q_stream_hourly_watermark,
    "stream_sliding_24h": q_stream_sliding_24h,
    "stream_sliding_7d": q_stream_sliding_7d,
    "stream_quantiles_24h": q_stream_quantiles_24h,
    "stream_quantiles_7d": q_stream_quantiles_7d,
    "stream_lag_state": q_stream_lag_state,
    "stream_lag_state_ordered": q_stream_lag_state_ordered,
    "stream_late_audit": q_stream_late_audit,
    "stream_calendar_join": q_stream_calendar_join,
    "stream_model_scoring": q_stream_model_scoring,
}
