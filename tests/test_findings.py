"""Cases that once lost rows or crashed: invalid labels and predictions,
null and zero truths, gaps in a history, batch sizes, restarts, storage."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tempora.ml import crossval as CV
from tempora.ml import forecast as FC
from tempora.operators import ranks as R
from tempora.plans import evaluate as EV
from tempora.streaming import stream as ST


def scored(spark, y, p):
    return spark.createDataFrame(list(zip(map(float, y), map(float, p))), "y double, prediction double")


def test_negative_prediction_isnt_dropped(spark):
    s = CV.default_scorer(scored(spark, [1, 2, 3, 4], [1.1, 2.1, -5, 3.5]), "y")
    assert s["d2_poisson"] is None and s["d2_gamma"] is None and s["r2"] < 0


def test_zero_truth(spark):
    s = EV.deviance_scores(scored(spark, [0, 2, 3], [0.5, 2, 3]), [], "y", "prediction").first()
    dev = 2 * 0.5
    base = 2 * sum((v * np.log(v / (5 / 3)) if v else 0) - v + 5 / 3 for v in (0, 2, 3))
    assert s["d2_gamma"] is None and s["d2_poisson"] == pytest.approx(1 - dev / base)
    zero = EV.deviance_scores(scored(spark, [1, 2], [0, 2]), [], "y", "prediction").first()
    assert zero["d2_poisson"] is None and zero["d2_gamma"] is None


@pytest.mark.parametrize("loss, bad", [("poisson", -1.0), ("gamma", 0.0)])
def test_invalid_labels_raise(spark, loss, bad):
    from tempora.ml import histogram as H
    df = spark.createDataFrame([(float(i), bad if i == 3 else 2.0) for i in range(30)], "x double, label double")
    with pytest.raises(ValueError, match="outside the domain"):
        H.fit(df, H.fit_bins(df, ["x"]), ["label"], F.lit(1), [H.Spec(loss=loss, rounds=1)])


def test_null_truth_in_bins(spark):
    rows = [(0, float(i), i - 1.0, i + 1.0) for i in range(20)] + [(0, None, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "fold_idx int, load_mw double, lower double, upper double")
    out = EV.binned_coverage(df, 4).collect()
    assert sum(r["n_samples"] for r in out) == 20 and all(r["coverage"] == 1 for r in out)
    assert EV.coverage_width(df, ["fold_idx"]).first()["n_samples"] == 20


def test_gap_keeps_the_origin(spark):
    y = [float(i % 7) for i in range(400)]
    y[350] = None
    s = spark.createDataFrame([("a", i, v) for i, v in enumerate(y)], "series_id string, pos long, y double")
    o = FC.origins_table(s, 400, test_len=300)
    assert o.count() == 60 and o.where("not _ok").count() == 6
    m = FC.fit_lag_model(FC.lag_matrix(s).where("pos < 100"), rounds=2)
    rec = FC.recursive_forecast(o, m, horizon=2)
    assert rec.count() == 120 and rec.where("y_hat is null").count() == 12


class State:
    """What a group's state does between micro-batches."""

    def __init__(self):
        self.value = None

    exists = property(lambda self: self.value is not None)
    get = property(lambda self: self.value)

    def update(self, value):
        self.value = value


@pytest.mark.parametrize("batches", [1, 3, 30])
def test_lags_dont_depend_on_batches(batches):
    t = pd.date_range("2024-01-01", periods=720, freq="h")
    rows = pd.DataFrame({"series_id": "a", "time": t, "load_mw": np.arange(720.0)})
    state, fn, out = State(), ST.lag_state_fn(), []
    for part in np.array_split(np.arange(720), batches):
        out += list(fn(("a",), iter([rows.iloc[part].sample(frac=1, random_state=1)]), state))
    out = pd.concat(out).sort_values("time")
    assert out["lag_24h"].notna().sum() == 696 and out["lag_1h"].notna().sum() == 719
    assert (out["load_mw"] - out["lag_24h"]).dropna().eq(24).all() and len(state.value[0]) == 169


def test_audit_survives_a_restart(spark, tmp_path):
    """A row 48 h late is recorded also if the query stops before its batch."""
    schema = "event_id long, ts timestamp_ntz, event_type string, value double"
    first = spark.sql("select 1L event_id, timestamp_ntz '2024-01-05 00:00:00' ts, 'a' event_type, 1.0D value")
    late = spark.sql("select 2L event_id, timestamp_ntz '2024-01-03 00:00:00' ts, 'a' event_type, 1.0D value")
    src, out = str(tmp_path / "in"), str(tmp_path / "audit")
    first.write.mode("append").parquet(src)
    ST.late_audit(spark.readStream.schema(schema).parquet(src), 3, out)
    assert ST.late_rows(spark, out).count() == 0
    late.write.mode("append").parquet(src)
    ST.late_audit(spark.readStream.schema(schema).parquet(src), 3, out)
    got = ST.late_rows(spark, out).collect()
    assert [(r["event_id"], r["hours_late"]) for r in got] == [(2, 45)]


def test_mostly_equal_values(spark):
    """90 % of the rows have one value."""
    vals = [5.0] * 900 + [float(i) for i in range(100)]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    q = R.linear_quantiles(df, [], "v", {"a": 0.04, "b": 0.5, "c": 0.99}).first()
    assert (q["a"], q["b"], q["c"]) == pytest.approx(tuple(np.quantile(vals, [0.04, 0.5, 0.99])))
    assert R.linear_quantiles(df.limit(0), [], "v", {"a": 0.5}).collect()[0]["a"] is None


def test_no_shared_folder_is_an_error(monkeypatch):
    from tempora import session

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()
        conf = {}
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_boosting_leaves_no_tables(spark, monkeypatch):
    from tempora.ml import histogram as H
    import os
    from tempora.session import checkpoint_dir
    base = checkpoint_dir(spark).removeprefix("file:") + "/tables"
    df = spark.createDataFrame([(float(i), 1.0 + i % 5) for i in range(60)], "x double, label double")
    count = lambda: len([d for d in os.listdir(base) if d.startswith("packed")]) if os.path.isdir(base) else 0
    before = count()
    monkeypatch.setattr(H, "FOLD_TREES", 2)
    H.fit(df, H.fit_bins(df, ["x"]), ["label"], F.lit(1), [H.Spec(loss="poisson", rounds=5)])
    assert count() == before


def test_holidays_by_date(spark):
    from tempora.functions import calendar as cal
    days = spark.sql("select explode(sequence(date '1999-01-01', date '2031-12-31')) d")
    table = {r[0] for r in cal.holidays(spark, 1999, 2031).select("holiday_date").collect()}
    assert {r["d"] for r in days.where(cal.is_holiday(F.col("d"))).collect()} == table


def test_missing_blocks_differ_by_series(spark):
    from tempora.plans import features as FT
    s = spark.range(2400).selectExpr("id as pos", "1.0D as load_mw").crossJoin(spark.sql("select explode(array('sensor_000', 'sensor_001', 'sensor_002')) series_id"))
    out = FT.inject_missing_blocks(s, "series_id").where("injected").groupBy("series_id").agg(F.sort_array(F.collect_set("pos")).alias("p")).collect()
    assert len({tuple(r["p"]) for r in out}) == 3


def test_parallel_arrays(spark):
    """Six arrays of unequal length, null and empty ones, and one step past the end."""
    from tempora.sources import files as FS
    names = ["a", "b", "c", "d", "e", "f"]
    rows = [("2024-01-01 00:00:00", "2024-01-01 03:00:00", 3600, [1.0, 2.0, 3.0, 4.0], [1.0], None, [], [None, 5.0], [7.0, 8.0, 9.0])]
    df = spark.createDataFrame(rows, "s string, e2 string, interval_s int, " + ", ".join(f"{n} array<double>" for n in names))
    df = df.selectExpr("cast(s as timestamp_ntz) start", "cast(e2 as timestamp_ntz) end", "interval_s", *names)
    got = sorted(map(tuple, FS.explode_arrays(df, names).selectExpr("hour(time) h", *names).collect()))
    assert got == [(0, 1.0, 1.0, None, None, None, 7.0), (1, 2.0, None, None, None, 5.0, 8.0), (2, 3.0, None, None, None, None, 9.0)]
