"""File sources and sinks (#3-#11): multi-token-null CSV scans, landed array
payloads, idempotent Parquet sinks and persisted feature state."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The load CSV layout of the reference.
LOAD_TIME_COL = "Time (UTC)"
LOAD_FORECAST_COL = "Day-ahead Total Load Forecast [MW] - BZN|FR"
LOAD_ACTUAL_COL = "Actual Total Load [MW] - BZN|FR"
LOAD_FILE_PREFIX = "Total Load - Day Ahead"
NULL_TOKENS = ("N/A", "-")
TIME_RANGE_FORMAT = "dd.MM.yyyy HH:mm"


def write_load_csv(series: DataFrame, path: str, time_col: str = "time", value_col: str = "load_mw") -> None:
    """Land a series in the reference's CSV layout, one folder per year
    (``Total Load - Day Ahead … {year}``), null tokens alternating N/A / -."""
    end = F.col(time_col) + F.expr("INTERVAL 1 HOUR")
    text = F.concat_ws(" - ", F.date_format(time_col, TIME_RANGE_FORMAT), F.date_format(end, TIME_RANGE_FORMAT))
    token = F.when(F.hour(time_col) % 2 == 0, F.lit(NULL_TOKENS[0])).otherwise(F.lit(NULL_TOKENS[1]))
    val = F.coalesce(F.format_string("%.6f", F.col(value_col)), token)
    out = series.select(text.alias(LOAD_TIME_COL), token.alias(LOAD_FORECAST_COL), val.alias(LOAD_ACTUAL_COL),
                        F.concat(F.lit(LOAD_FILE_PREFIX + " "), F.year(time_col).cast("string")).alias("file"))
    out.write.mode("overwrite").partitionBy("file").option("header", True).csv(path)


def scan_load_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read every CSV under ``path`` whose folder / file name starts with the
    load prefix (#3), as strings; map several null tokens to null (#4); drop
    the forecast column (#5); parse the interval start (#78)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in
                           (LOAD_TIME_COL, LOAD_FORECAST_COL, LOAD_ACTUAL_COL)])
    def named(c):
        """Starts with the prefix, also behind a partition's column name."""
        c = F.regexp_replace(F.regexp_replace(c, "^[^=]*=", ""), "%20", " ")
        return c.startswith(LOAD_FILE_PREFIX)

    raw = (spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "*.csv").csv(path)
           .where(named(F.col("_metadata.file_name")) | named(F.regexp_extract("_metadata.file_path", r"([^/]*)/[^/]*$", 1))))
    raw = raw.drop(LOAD_FORECAST_COL)
    v = F.col(LOAD_ACTUAL_COL)
    start = F.to_timestamp(F.split(F.col(LOAD_TIME_COL), " - ").getItem(0), TIME_RANGE_FORMAT)
    return raw.select(start.cast("timestamp_ntz").alias("time"),
                      F.when(v.isin(*NULL_TOKENS), F.lit(None)).otherwise(v).try_cast("double").alias("load_mw"))


def list_inputs(df: DataFrame) -> DataFrame:
    """Input files behind a scan (#6)."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).distinct()


def write_idempotent(df: DataFrame, path: str, partition_by=None) -> None:
    """Skip-when-present Parquet sink (#7)."""
    w = df.write.mode("ignore")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def payload_table(hourly: DataFrame, time_col: str = "time", value_col: str = "load_mw") -> DataFrame:
    """Pack an hourly series into one landed payload row per day:
    ``(start, end, interval_s, values array<double>)`` with values aligned
    on the day's half-open hourly grid (null where absent).  Each group is
    one day — at most 24 values."""
    day = F.date_trunc("day", F.col(time_col).cast("timestamp")).cast("timestamp_ntz")
    g = hourly.groupBy(day.alias("start")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.hour(time_col), F.col(value_col)))).alias("_m"))
    return g.select("start", (F.col("start") + F.expr("INTERVAL 1 DAY")).alias("end"),
                    F.lit(3600).alias("interval_s"),
                    F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.col("_m")[i]).alias("values"))


def _hours(name: str):
    return F.transform(F.sequence(F.lit(0), F.lit(23)), lambda i: F.col("_m")[i].getField(name))


def payload_arrays(hourly: DataFrame, value_cols: list[str], time_col: str = "time") -> DataFrame:
    """The same with one array for each of several value columns."""
    day = F.date_trunc("day", F.col(time_col).cast("timestamp")).cast("timestamp_ntz")
    g = hourly.groupBy(day.alias("start")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.hour(time_col), F.struct(*value_cols)))).alias("_m"))
    return g.select("start", (F.col("start") + F.expr("INTERVAL 1 DAY")).alias("end"), F.lit(3600).alias("interval_s"),
                    *[_hours(c).alias(c) for c in value_cols])


def explode_arrays(payload: DataFrame, value_cols: list[str]) -> DataFrame:
    """Payload with parallel arrays → rows (#9, #13) with a column for each;
    a shorter array gives nulls, a null or empty one only nulls."""
    arrays = [F.coalesce(F.col(c), F.array().cast(payload.schema[c].dataType)).alias(c) for c in value_cols]
    rows = payload.select("start", "end", "interval_s", F.posexplode(F.arrays_zip(*arrays)).alias("_k", "_v"))
    return _on_time(rows.select("start", "end", "interval_s", "_k", *[F.col("_v")[c].alias(c) for c in value_cols]), value_cols)


def explode_payload(payload: DataFrame, value_col: str = "load_mw") -> DataFrame:
    """Array payload → rows (#9, #13): times ``start + k·interval`` on the
    half-open range ``[start, end)``."""
    return _on_time(payload.select("start", "end", "interval_s", F.posexplode("values").alias("_k", value_col)), [value_col])


def _on_time(rows: DataFrame, value_cols: list[str]) -> DataFrame:
    t = F.timestamp_micros(F.unix_micros(F.col("start").cast("timestamp"))
                           + F.col("_k").cast("long") * F.col("interval_s").cast("long") * F.lit(1_000_000)).cast("timestamp_ntz")
    return rows.select(t.alias("time"), *value_cols, "end").where(F.col("time") < F.col("end")).drop("end")


def save_feature_state(df: DataFrame, path: str, params: dict) -> None:
    """Persist a feature table + its parameters (#10) — replaces pickling."""
    df.write.mode("overwrite").parquet(path + "/table")
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(params, default=str),)], "params string") \
         .write.mode("overwrite").json(path + "/params")


def load_feature_state(spark: SparkSession, path: str):
    table = spark.read.parquet(path + "/table")
    params = json.loads(spark.read.json(path + "/params").first()["params"])
    return table, params
