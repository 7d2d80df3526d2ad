"""Readers for the given tables and their bindings to the reference's roles
(FIXTURES §2).  Every reader selects only the columns it needs so the Parquet
scan prunes columns; time columns load as ``timestamp_ntz`` (UTC wall clock).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.timecols import truncate

# Bucket sums are rounded to 1e-6: the inputs carry cents, so this removes
# summation-order noise and makes every engine see identical doubles.
SUM_DIGITS = 6


def exact_sum(c):
    return F.round(F.sum(c), SUM_DIGITS)

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns=None) -> DataFrame:
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def scan_parquet(spark: SparkSession, paths, columns=None, source_col: str | None = None) -> DataFrame:
    """One read over many files (#1); ``source_col`` carries the file name
    (the reference's one-file-per-city layout) from ``_metadata``."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    df = spark.read.parquet(*paths)
    cols = [F.col(c) for c in (columns or df.columns)]
    if source_col:
        cols.append(F.col("_metadata.file_name").alias(source_col))
    return df.select(*cols)


# ------------------------------------------------------------------ bindings

def hourly_events(spark: SparkSession, sf_dir: str, by: str | None = None,
                  value: str = "load_mw") -> DataFrame:
    """Target, hourly: ``events`` → hour bucket → ``sum(value)``.
    With ``by='event_type'`` it is a 5-series panel with gaps."""
    ev = read_table(spark, sf_dir, "events", ["ts", "value"] + ([by] if by else []))
    keys = ([F.col(by).alias("series_id")] if by else [])
    return (ev.groupBy(*keys, truncate("ts", "1 hour").alias("time"))
              .agg(exact_sum("value").alias(value)))


def daily_orders(spark: SparkSession, sf_dir: str, value: str = "load_mw") -> DataFrame:
    """Daily target with gaps: ``orders`` → ``sum(o_totalprice)`` per day."""
    o = read_table(spark, sf_dir, "orders", ["o_orderdate", "o_totalprice"])
    return (o.groupBy(truncate("o_orderdate", "1 day").alias("time"))
             .agg(exact_sum("o_totalprice").alias(value)))


EXOGENOUS_VARS = ("l_quantity", "l_discount", "l_tax", "l_extendedprice")


def exogenous_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long covariate table ``(time, city, variable, value)``: lineitem daily
    means by return flag play the reference's per-city weather variables."""
    li = read_table(spark, sf_dir, "lineitem", ["l_shipdate", "l_returnflag", *EXOGENOUS_VARS])
    agg = (li.groupBy(truncate("l_shipdate", "1 day").alias("time"),
                      F.lower("l_returnflag").alias("city"))
             .agg(*[F.avg(v).alias(v.removeprefix("l_")) for v in EXOGENOUS_VARS]))
    return agg.unpivot(["time", "city"], [v.removeprefix("l_") for v in EXOGENOUS_VARS],
                       "variable", "value")


def supplier_daily_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Big panel for the bench: ``lineitem`` daily quantity by supplier."""
    li = read_table(spark, sf_dir, "lineitem", ["l_suppkey", "l_shipdate", "l_quantity"])
    return (li.groupBy(F.col("l_suppkey").alias("series_id"),
                       truncate("l_shipdate", "1 day").alias("time"))
              .agg(exact_sum("l_quantity").alias("load_mw")))
