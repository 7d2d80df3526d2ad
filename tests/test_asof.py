"""As-of join with a system lag against a brute-force pandas reference,
with ties on availability time and gaps longer than one time block."""

import datetime as dt

import numpy as np
import pandas as pd

from tempora.operators.joins import asof_available


def test_asof_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    t0 = dt.datetime(2024, 1, 1)
    ev = []
    for i in range(400):
        s = int(rng.integers(0, 3))
        # minute resolution with repeats → ties on availability time; a 3-day hole for series 2
        minute = int(rng.integers(0, 6 * 24 * 60))
        if s == 2 and 2 * 1440 <= minute < 5 * 1440:
            continue
        ev.append((s, t0 + dt.timedelta(minutes=minute - minute % 30), i, float(rng.normal())))
    events = spark.createDataFrame(ev, "series_id long, ts timestamp_ntz, event_id long, value double")
    grid = spark.createDataFrame([(s, t0 + dt.timedelta(hours=h)) for s in range(3) for h in range(0, 6 * 24, 3)],
                                 "series_id long, prediction_time timestamp_ntz")
    lag_us = 2 * 3_600_000_000
    out = asof_available(grid, events, "series_id", "prediction_time", "ts", ["value", "event_id"], "event_id",
                         system_lag_us=lag_us, block_us=86_400_000_000).toPandas()
    e = pd.DataFrame(ev, columns=["series_id", "ts", "event_id", "value"])
    e["avail"] = e["ts"] + pd.Timedelta(hours=2)
    for r in out.itertuples(index=False):
        cand = e[(e.series_id == r.series_id) & (e.avail <= r.prediction_time)]
        if cand.empty:
            assert pd.isna(r.event_id)
            continue
        best = cand.sort_values(["avail", "event_id"]).iloc[-1]
        assert int(r.event_id) == int(best.event_id) and r.value == best.value
    assert len(out) == grid.count()


def test_interpolation_across_blocks_matches_pandas(spark):
    from tempora.operators import windows as W
    rng = np.random.default_rng(9)
    rows = []
    for s in range(4):
        vals = rng.normal(size=300)
        mask = rng.random(300) < 0.3
        mask[40:160] = s % 2 == 0          # a gap spanning many blocks of 16
        mask[:5] = True                    # leading gap stays null
        for p, (v, m) in enumerate(zip(vals, mask)):
            rows.append((s, p, None if m else float(v)))
    df = spark.createDataFrame(rows, "series_id long, pos long, y double")
    got = W.interpolate_linear(df, "series_id", "pos", "y", block_size=16).toPandas()
    got = got.sort_values(["series_id", "pos"]).reset_index(drop=True)
    ref = pd.DataFrame(rows, columns=["series_id", "pos", "y"]).sort_values(["series_id", "pos"])
    ref["y"] = ref.groupby("series_id")["y"].transform(lambda x: x.interpolate(limit_area="inside"))
    ref = ref.reset_index(drop=True)
    assert np.allclose(got["y"].to_numpy(dtype=float), ref["y"].to_numpy(dtype=float), equal_nan=True)
