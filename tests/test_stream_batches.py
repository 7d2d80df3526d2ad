"""Event streams: batches by bytes, windows from panes, few calls to the state."""

import datetime as dt
import os

import numpy as np
import pandas as pd

from tempora.streaming import panes as P
from tempora.streaming import stream as ST
from tests.test_panes import State


def test_batches_hold_several_days(spark, tmp_path):
    """Ten days with a null value and an hour of nulls alone: one batch or one a day, the same windows."""
    t0 = dt.datetime(2024, 1, 1)
    rows = [(i, t0 + dt.timedelta(hours=7 * i // 2), "a", None if i in (3, 40, 41) else float(i % 9)) for i in range(66)]
    rows.append((99, None, "a", 1.0))
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string, value double")
    path = ST.land_daily_files(events, str(tmp_path / "in"))
    got, batches = [], []
    for stream in (ST.event_stream(spark, path), ST.event_stream(spark, path, 1)):
        out = ST._run(ST.sliding(stream, "5 hours"), "sliding-test")
        got.append(sorted(spark.read.parquet(out).toPandas().itertuples(index=False, name=None), key=lambda r: r[0]))
        commits = out.removeprefix("file:").removesuffix("/data") + "/_checkpoint/commits"
        batches.append(len([f for f in os.listdir(commits) if f.isdigit()]))
    assert batches[0] <= 3 < 10 <= batches[1]
    mark = max(r[1] for r in rows if r[1]) - dt.timedelta(hours=3)
    want = []
    for k in range(-4, 240):
        start = t0 + dt.timedelta(hours=k)
        inside = [r[3] for r in rows if r[1] and start <= r[1] < start + dt.timedelta(hours=5)]
        known = [v for v in inside if v is not None]
        if inside and start + dt.timedelta(hours=5) <= mark:
            want.append((start, start + dt.timedelta(hours=5), len(inside), sum(known) / len(known) if known else np.nan, max(known, default=np.nan)))
    for g in got:
        assert [(r[0].to_pydatetime(), r[1].to_pydatetime(), r[2]) for r in g] == [w[:3] for w in want]
        assert np.allclose([r[3:] for r in g], [w[3:] for w in want], equal_nan=True)


def test_few_calls_to_the_state():
    """30 days in two batches: calls grow with the days, and windows are exact, also with NaN and infinite values."""
    calls, rng, state = [], np.random.default_rng(1), State()

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def __getattr__(self, name):
            calls.append(name)
            return getattr(self.inner, name)

    class Handle:
        def getMapState(self, *a):
            return Counted(state.getMapState(*a))

        def getValueState(self, *a):
            return Counted(state.getValueState(*a))

        def registerTimer(self, at):
            calls.append("timer")
            state.registerTimer(at)

    hours = [h for h in range(720) if h % 100 < 70]
    data = {h: rng.integers(0, 50, 6) / 4 for h in hours}
    data[5][0], data[6][:2], data[9][1] = np.nan, np.inf, np.nan
    w = P.Windows(24, [0.25, 0.5])
    w.init(Handle())
    got, sent = [], set()
    for mark in (333, 800):
        rows = [(h * P.HOUR_MS, v, 1) for h in hours if h < mark and h not in sent for v in data[h]]
        sent |= {h for h in hours if h < mark}
        state.mark = mark * P.HOUR_MS
        frame = pd.DataFrame(rows, columns=["hour_ms", "value", "n"]).sample(frac=1, random_state=2)
        list(w.handleInputRows(("",), iter([frame.iloc[:500], frame.iloc[500:]]), state))
        for at in sorted(t for t in state.timers if t <= state.mark):
            state.timers.discard(at)
            info = type("Info", (), {"getExpiryTimeInMs": staticmethod(lambda at=at: at)})
            for f in w.handleExpiredTimer(("",), state, info):
                got += list(f[["end_ms", "n_events", "q0", "q1"]].itertuples(index=False, name=None))
    want = []
    for end in range(1, 801):
        inside = [data[h] for h in hours if end - 24 <= h < end]
        if inside:
            v, n = np.unique(np.concatenate(inside), return_counts=True)
            want.append((end * P.HOUR_MS, int(n.sum()), *P.linear_quantiles(v, n, [0.25, 0.5])))
    assert [g[:2] for g in got] == [x[:2] for x in want]
    assert np.array_equal([g[2:] for g in got], [x[2:] for x in want], equal_nan=True)
    assert not state.map and len(calls) < 200
