"""Shared helpers for registered queries: the hourly / daily bindings of the
given tables and output normalisation (stable types, 6-decimal doubles)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.functions.rounding import output_round
from tempora.functions.timecols import truncate
from tempora.plans import features as FT
from tempora.plans.grid_spec import GridSpec
from tempora.session import materialize
from tempora.sources import tables as S

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
RETURN_FLAGS = ["a", "n", "r"]


def normalize(df: DataFrame, digits: int = 6) -> DataFrame:
    """int → bigint, float/double → double rounded to ``digits``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType, T.LongType)):
            cols.append(c.cast("long").alias(f.name))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            cols.append(output_round(c.cast("double"), digits).alias(f.name))
        else:
            cols.append(c)
    return df.select(*cols)


@dataclass
class Hourly:
    """The hourly single-series binding: events → hourly sum → full grid →
    interpolated.  ``series`` has ``time, pos, load_mw, was_null``."""
    obs: DataFrame
    grid: GridSpec
    series: DataFrame


def hourly(spark: SparkSession, sf_dir: str, interpolate: bool = True) -> Hourly:
    obs = materialize(S.hourly_events(spark, sf_dir), "hourly-obs")
    grid = GridSpec.from_data(obs, "time", "1 hour")
    series = FT.target_series(obs, grid, None, "load_mw", interpolate)
    return Hourly(obs, grid, series)


def hourly_grid(spark: SparkSession, sf_dir: str) -> GridSpec:
    """The hourly grid alone: bounds of the one time column, no aggregate and
    nothing written."""
    return _raw_grid(spark, sf_dir, "events", "ts", "1 hour")


def daily_grid(spark: SparkSession, sf_dir: str) -> GridSpec:
    return _raw_grid(spark, sf_dir, "orders", "o_orderdate", "1 day")


def _raw_grid(spark, sf_dir, table: str, time_col: str, step: str) -> GridSpec:
    row = S.read_table(spark, sf_dir, table, [time_col]).agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")) \
        .select(truncate("lo", step).alias("lo"), truncate("hi", step).alias("hi")).first()
    return GridSpec(row["lo"], row["hi"], step)


def hourly_panel(spark: SparkSession, sf_dir: str, interpolate: bool = True) -> Hourly:
    obs = materialize(S.hourly_events(spark, sf_dir, by="event_type"), "panel-obs")
    grid = GridSpec.from_data(obs, "time", "1 hour")
    series = FT.target_series(obs, grid, "series_id", "load_mw", interpolate)
    return Hourly(obs, grid, series)


def daily(spark: SparkSession, sf_dir: str, interpolate: bool = True) -> Hourly:
    obs = materialize(S.daily_orders(spark, sf_dir), "daily-obs")
    grid = GridSpec.from_data(obs, "time", "1 day")
    series = FT.target_series(obs, grid, None, "load_mw", interpolate)
    return Hourly(obs, grid, series)


def events_covariates(spark: SparkSession, sf_dir: str, grid: GridSpec) -> DataFrame:
    """Hourly event counts per event type as wide covariates
    ``weather_n_events_{type}`` (one conditional aggregate, no pivot
    stages).  Hours without any event are absent here and become 0 when the
    covariates are aligned to the grid (``fill=0.0``)."""
    ev = S.read_table(spark, sf_dir, "events", ["ts", "event_type"])
    # a type that isn't listed is an error, not a column less
    ev = ev.where(F.when(F.coalesce(F.col("event_type").isin(EVENT_TYPES), F.lit(False)), F.lit(True)).otherwise(
        F.raise_error(F.concat_ws(" ", F.lit("unlisted event type:"), "event_type")).cast("boolean")))
    return (ev.groupBy(truncate("ts", "1 hour").alias("time"))
              .agg(*[F.count(F.when(F.col("event_type") == e, 1)).cast("double")
                     .alias(f"weather_n_events_{e}") for e in EVENT_TYPES]))
