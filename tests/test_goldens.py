"""Micro-goldens (FIXTURES §3) and core properties of the operators."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from tempora.functions import calendar as cal
from tempora.operators import windows as W
from tempora.plans import evaluate as EV
from tempora.plans.split import TimeSplit, assign_folds


def test_time_split_bounds():
    s = TimeSplit(36552, 5, 4032, 168, 17472)
    got = [s.bounds(i) for i in range(5)]
    assert got == [(0, 16224, 16392, 20424), (2784, 20256, 20424, 24456),
                   (6816, 24288, 24456, 28488), (10848, 28320, 28488, 32520),
                   (14880, 32352, 32520, 36552)]
    s2 = TimeSplit(36552, 2, 4032, 24, 17472)
    assert [s2.bounds(i) for i in range(2)] == [(10992, 28464, 28488, 32520),
                                                (15024, 32496, 32520, 36552)]


def test_assign_folds_matches_bounds(spark):
    s = TimeSplit(528, 5, 72, 24, 240)
    df = spark.range(528).withColumnRenamed("id", "split_pos")
    rows = assign_folds(df, s).groupBy("fold_idx", "role").agg(
        F.min("split_pos").alias("lo"), F.max("split_pos").alias("hi"), F.count("*").alias("n")).collect()
    got = {(r.fold_idx, r.role): (r.lo, r.hi + 1, r.n) for r in rows}
    for i in range(5):
        a, b, c, d = s.bounds(i)
        assert got[(i, "train")] == (a, b, b - a)
        assert got[(i, "test")] == (c, d, d - c)
    assert [s.bounds(i)[2] for i in range(5)] == [168, 240, 312, 384, 456]


def test_dst_and_weekday(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 10, 31, 0),), (dt.datetime(2021, 10, 31, 1),),
                                (dt.datetime(2021, 10, 31, 2),), (dt.datetime(2021, 3, 22, 12),),
                                (dt.datetime(2021, 3, 23, 12),)], "time timestamp_ntz")
    rows = df.select(*cal.calendar_columns("time")).collect()
    assert [r.cal_hour_of_day for r in rows[:3]] == [2, 2, 3]
    assert [r.cal_day_of_week for r in rows[3:]] == [1, 2]


def test_easter_and_movable_holidays(spark):
    h = cal.holidays(spark, 2021, 2026)
    names = {(r.holiday_date, r.name) for r in h.collect()}
    easter_mondays = sorted(d for d, n in names if n == "Easter Monday")
    assert [d - dt.timedelta(days=1) for d in easter_mondays] == [
        dt.date(2021, 4, 4), dt.date(2022, 4, 17), dt.date(2023, 4, 9), dt.date(2024, 3, 31),
        dt.date(2025, 4, 20), dt.date(2026, 4, 5)]
    mov2021 = sorted(d for d, n in names if d.year == 2021 and n in
                     ("Easter Monday", "Ascension", "Whit Monday"))
    assert mov2021 == [dt.date(2021, 4, 5), dt.date(2021, 5, 13), dt.date(2021, 5, 24)]
    assert h.count() == 6 * 11


@pytest.mark.parametrize("block", [2, 4096])
def test_interpolation(spark, block):
    vals = [None, 10.0, None, None, 40.0, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "pos long, y double")
    out = W.interpolate_linear(df, [], "pos", "y", block_size=block).orderBy("pos").collect()
    assert [r.y for r in out] == [None, 10.0, 20.0, 30.0, 40.0, None]


@pytest.mark.parametrize("block", [25, 30, 4096])
def test_rolling_quantiles(spark, block):
    df = spark.createDataFrame([(i, float(i + 1)) for i in range(24)], "pos long, y double")
    specs = [W.rolling_spec("q25", W.rolling_quantile("y", 0.25, 24, "linear"), 24),
             W.rolling_spec("med", W.rolling_median("y", 24), 24),
             W.rolling_spec("q75", W.rolling_quantile("y", 0.75, 24, "linear"), 24),
             W.rolling_spec("n25", W.rolling_quantile("y", 0.25, 24, "nearest"), 24),
             W.rolling_spec("n75", W.rolling_quantile("y", 0.75, 24, "nearest"), 24),
             W.rolling_spec("iqr_l", W.rolling_iqr("y", 24, "linear"), 24),
             W.rolling_spec("iqr_n", W.rolling_iqr("y", 24, "nearest"), 24)]
    rows = W.apply_specs(df, [], "pos", specs, block).orderBy("pos").collect()
    assert all(r.med is None for r in rows[:23])
    last = rows[23]
    assert (last.q25, last.med, last.q75) == (6.75, 12.5, 18.25)
    assert (last.n25, last.n75, last.iqr_n) == (7.0, 18.0, 11.0)
    assert last.iqr_l == 11.5


def _yp(spark, y, p, extra=None):
    rows = [(0, float(a), float(b)) + tuple(e[i] for e in (extra or [])) for i, (a, b) in enumerate(zip(y, p))]
    cols = "g long, load_mw double, predicted_load_mw double"
    if extra:
        cols += ", lower double, upper double"
    return spark.createDataFrame(rows, cols)


def test_scores(spark):
    df = _yp(spark, [1, 2, 3, 4], [2, 2, 2, 4])
    ps = EV.point_scores(df, ["g"]).first()
    assert ps.mape == pytest.approx(1 / 3, abs=1e-6) and ps.r2 == pytest.approx(0.6)
    dv = EV.deviance_scores(df, ["g"]).first()
    assert dv.d2_poisson == pytest.approx(0.508411, abs=1e-6)
    assert dv.d2_gamma == pytest.approx(0.409409, abs=1e-6)
    pb = EV.pinball_scores(df, ["g"]).first()
    assert pb.d2_pinball_05 == pytest.approx(-1.380952, abs=1e-6)
    assert pb.d2_pinball_50 == pytest.approx(0.5)
    assert pb.d2_pinball_95 == pytest.approx(-1.380952, abs=1e-6)


def test_lorenz_gini(spark):
    df = spark.createDataFrame([(0, i, float(o), float(p)) for i, (o, p) in
                                enumerate(zip([1, 2, 3, 4], [1, 2, 3, 4]))],
                               "g long, prediction_time long, load_mw double, predicted_load_mw double")
    assert EV.gini(EV.lorenz(df, ["g"]), ["g"]).first().gini_index == pytest.approx(0.275)
    df2 = spark.createDataFrame([(0, i, float(o), float(i)) for i, o in enumerate([2, 1, 4, 3])],
                                "g long, prediction_time long, load_mw double, predicted_load_mw double")
    r = EV.lorenz(df2, ["g"])
    assert EV.gini(r, ["g"]).first().gini_index == pytest.approx(0.2)
    grid = [x.cum_observed for x in EV.lorenz_grid(r, ["g"], 5).orderBy("cum_population").collect()]
    assert grid == pytest.approx([0.2, 0.2, 0.3, 0.7, 1.0])


def test_interval_coverage(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0, 2.0), (0, 2.0, 2.0, 2.0), (0, 3.0, 4.0, 5.0), (0, 4.0, 3.0, 5.0)],
                               "g long, load_mw double, lower double, upper double")
    r = EV.coverage_width(df, ["g"]).first()
    assert r.coverage == 0.75 and r.mean_width == 1.2


def test_binned_coverage_bins(spark):
    df = spark.createDataFrame([(0, float(v), float(v) - 1, float(v) + 1) for v in range(10, 20)],
                               "fold_idx long, load_mw double, lower double, upper double")
    rows = EV.binned_coverage(df, 4).orderBy("bin_left").collect()
    assert [(r.bin_left, r.bin_right) for r in rows] == [(10, 12), (13, 14), (15, 16), (17, 19)]
    assert [r.n_samples for r in rows] == [3, 2, 2, 3]


def test_halo_equals_plain_window(spark):
    n = 3000
    df = spark.range(n).select(F.col("id").alias("pos"), (F.sin(F.col("id")) * 100).alias("y"),
                               F.lit(1).alias("s"))
    specs = [W.lag_spec("y", 7, "l7"), W.lead_spec("y", 5, "f5"),
             W.rolling_spec("m", W.rolling_median("y", 50), 50),
             W.rolling_spec("q", W.rolling_iqr("y", 50), 50)]
    halo = W.apply_specs(df, ["s"], "pos", specs, block_size=64)
    plain = W.plain_window(df, ["s"], "pos", specs).select("pos", "l7", "f5", "m", "q")
    a = {r.pos: tuple(r[1:]) for r in halo.select("pos", "l7", "f5", "m", "q").collect()}
    b = {r.pos: tuple(r[1:]) for r in plain.collect()}
    assert a == b and len(a) == n


def test_no_future_leak(spark):
    """Perturbing values after t leaves every feature at t unchanged."""
    from tempora.plans import features as FT
    n, cut = 400, 300
    base = spark.range(n).select(F.col("id").alias("pos"), F.cos(F.col("id")).alias("load_mw"))
    pert = base.withColumn("load_mw", F.when(F.col("pos") > cut, F.col("load_mw") + 1e6)
                           .otherwise(F.col("load_mw")))
    specs = FT.lagged_block_specs()
    names = [s.name for s in specs]
    a = W.apply_specs(base, [], "pos", specs, 128).where(F.col("pos") <= cut).select("pos", *names)
    b = W.apply_specs(pert, [], "pos", specs, 128).where(F.col("pos") <= cut).select("pos", *names)
    assert a.exceptAll(b).count() == 0


def test_nearest_index_rule():
    assert W.nearest_index(24, 0.25) == 6 and W.nearest_index(24, 0.75) == 17
    assert W.nearest_index(168, 0.75) == 125 and W.nearest_index(168, 0.25) == 42
    assert math.isclose(EV.EPS, 2.220446049250313e-16)


def test_split_properties(spark):
    """Every test row appears in exactly one fold; train ends ``gap`` rows
    before its test block; train never exceeds the cap."""
    s = TimeSplit(2000, 5, 150, 24, 600)
    df = spark.range(2000).withColumnRenamed("id", "split_pos")
    a = assign_folds(df, s)
    tests = a.where(F.col("role") == "test").groupBy("split_pos").count()
    assert tests.where(F.col("count") != 1).count() == 0
    assert tests.count() == 5 * 150
    g = a.groupBy("fold_idx", "role").agg(F.min("split_pos").alias("lo"), F.max("split_pos").alias("hi"),
                                          F.count("*").alias("n")).collect()
    by = {(r.fold_idx, r.role): r for r in g}
    for i in range(5):
        assert by[(i, "test")].lo - by[(i, "train")].hi - 1 == 24
        assert by[(i, "train")].n <= 600


def test_quantiles_monotone_and_coverage_bounded(spark):
    rows = [(i % 3, float((i * 37) % 101), float((i * 37) % 101) - 5, float((i * 37) % 101) + 5)
            for i in range(300)]
    df = spark.createDataFrame(rows, "fold_idx long, load_mw double, lower double, upper double")
    q = EV.linear_edges(df, ["fold_idx"], "load_mw", [0.1, 0.3, 0.5, 0.7, 0.9]).collect()
    for r in q:
        assert list(r.edges) == sorted(r.edges)
    cw = EV.binned_coverage(df, 5).collect()
    assert all(0.0 <= r.coverage <= 1.0 for r in cw)
