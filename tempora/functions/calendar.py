"""Calendar fields in local wall-clock time and a public-holiday table (#75,
#76, #29, #101).  The holiday table is generated in Spark from rules, one
small row set per year, so it has a proven size bound (11 rows × years) and
is safe to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LOCAL_TZ = "Europe/Paris"

# French public holidays.  Fixed-date holidays as (month, day)
# and movable ones as day offsets from Easter Sunday.
FIXED_HOLIDAYS = [(1, 1, "New year"), (5, 1, "Labour day"), (5, 8, "Victory in Europe day"),
                  (7, 14, "National day"), (8, 15, "Assumption"), (11, 1, "All Saints"),
                  (11, 11, "Armistice"), (12, 25, "Christmas")]
EASTER_OFFSETS = [(1, "Easter Monday"), (39, "Ascension"), (50, "Whit Monday")]


def local_time(c, tz: str = LOCAL_TZ) -> Column:
    """UTC ``timestamp_ntz`` → local wall clock (DST aware)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.from_utc_timestamp(c.cast("timestamp"), tz)


def iso_weekday(c) -> Column:
    """Monday = 1 … Sunday = 7 (``weekday`` is 0-based from Monday)."""
    return F.weekday(c) + 1


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter Sunday (anonymous algorithm) as integer arithmetic."""
    y = year
    a = F.pmod(y, 19)
    b = (y / 100).cast("int")
    c = F.pmod(y, 100)
    d = (b / 4).cast("int")
    e = F.pmod(b, 4)
    f = ((b + 8) / 25).cast("int")
    g = ((b - f + 1) / 3).cast("int")
    h = F.pmod(19 * a + b - d - g + 15, 30)
    i = (c / 4).cast("int")
    k = F.pmod(c, 4)
    l_ = F.pmod(32 + 2 * e + 2 * i - h - k, 7)
    m = ((a + 11 * h + 22 * l_) / 451).cast("int")
    month = ((h + l_ - 7 * m + 114) / 31).cast("int")
    day = F.pmod(h + l_ - 7 * m + 114, 31) + 1
    return F.make_date(y, month, day)


def holidays(spark: SparkSession, year_from: int, year_to: int) -> DataFrame:
    """``(holiday_date date, name string)`` for the given years (inclusive)."""
    years = spark.range(int(year_from), int(year_to) + 1).select(F.col("id").cast("int").alias("y"))
    fixed = F.array(*[F.struct(F.make_date(F.col("y"), F.lit(m), F.lit(d)).alias("holiday_date"),
                               F.lit(n).alias("name")) for m, d, n in FIXED_HOLIDAYS])
    easter = easter_sunday(F.col("y"))
    movable = F.array(*[F.struct(F.date_add(easter, off).alias("holiday_date"),
                                 F.lit(n).alias("name")) for off, n in EASTER_OFFSETS])
    return years.select(F.inline(F.concat(fixed, movable)))


def is_holiday(day: Column) -> Column:
    """Whether a date is one of the holidays, from the date alone."""
    movable = F.datediff(day, easter_sunday(F.year(day))).isin([off for off, _ in EASTER_OFFSETS])
    fixed = (F.month(day) * 100 + F.dayofmonth(day)).isin([m * 100 + d for m, d, _ in FIXED_HOLIDAYS])
    return F.coalesce(movable | fixed, F.lit(False))


_HOLIDAY_CACHE: dict = {}


def holiday_dates(spark: SparkSession, year_from: int, year_to: int) -> list:
    """Holiday dates as a Python list (≤ 11 per year — a proven bound), for
    ``isin`` membership tests; computed once per session and year range."""
    key = (id(spark), int(year_from), int(year_to))
    if key not in _HOLIDAY_CACHE:
        _HOLIDAY_CACHE[key] = sorted({r["holiday_date"] for r in
                                      holidays(spark, year_from, year_to).select("holiday_date").collect()})
    return _HOLIDAY_CACHE[key]


def calendar_columns(time_col: str = "time", tz: str = LOCAL_TZ, prefix: str = "cal_") -> list[Column]:
    """Local hour, ISO weekday, day of year, year (holiday flag needs a join)."""
    lt = local_time(time_col, tz)
    return [F.hour(lt).alias(f"{prefix}hour_of_day"),
            iso_weekday(lt).alias(f"{prefix}day_of_week"),
            F.dayofyear(lt).alias(f"{prefix}day_of_year"),
            F.year(lt).alias(f"{prefix}year")]


def with_holiday_flag(df: DataFrame, spark: SparkSession, time_col: str = "time",
                      tz: str = LOCAL_TZ, out_col: str = "cal_is_holiday",
                      years: tuple[int, int] | None = None) -> DataFrame:
    """Set membership of the local date in the holiday table (#29): a
    broadcast left join (the table is ≤ 11 rows per year)."""
    if years is None:
        row = df.agg(F.min(F.year(local_time(time_col, tz))).alias("lo"),
                     F.max(F.year(local_time(time_col, tz))).alias("hi")).first()
        years = (row["lo"], row["hi"])
    hol = (holidays(spark, *years).select(F.col("holiday_date").alias("_hd"))
           .distinct().withColumn("_is_hol", F.lit(True)))
    out = df.withColumn("_ld", F.to_date(local_time(time_col, tz)))
    out = out.join(F.broadcast(hol), out["_ld"] == hol["_hd"], "left")
    return out.withColumn(out_col, F.coalesce(F.col("_is_hol"), F.lit(False))).drop("_ld", "_hd", "_is_hol")


def calendar_table(df: DataFrame, spark: SparkSession, time_col: str = "time",
                   tz: str = LOCAL_TZ, years=None) -> DataFrame:
    """``prepare_french_calendar_data`` (#101): time + 5 calendar columns."""
    base = df.select(time_col, *calendar_columns(time_col, tz))
    return with_holiday_flag(base, spark, time_col, tz, years=years)
