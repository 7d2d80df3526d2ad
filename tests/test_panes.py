"""Pane quantiles: the merge against numpy, and the state machine with a stand-in state."""

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from tempora.streaming import panes as P


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(-5, 5), min_size=1, max_size=9), min_size=1, max_size=6))
def test_merge_and_quantiles(panes):
    packed = [tuple(np.unique(np.array(p, float), return_counts=True)) for p in panes]
    values, counts = P.merged(packed)
    got = P.linear_quantiles(values, counts, [0, 0.25, 0.5, 0.75, 0.9, 1])
    assert np.allclose(got, np.quantile(np.concatenate(panes).astype(float), [0, 0.25, 0.5, 0.75, 0.9, 1]))


class State:
    """What a key's state, timers and watermark do, in memory."""

    def __init__(self):
        self.map, self.value, self.timers, self.mark = {}, None, set(), -1

    def getMapState(self, *a):
        s = self

        class Map:
            containsKey = staticmethod(lambda k: k in s.map)
            updateValue = staticmethod(s.map.__setitem__)
            getValue = staticmethod(lambda k: s.map[k])
            removeKey = staticmethod(s.map.pop)
            keys = staticmethod(lambda: list(s.map))
        return Map

    def getValueState(self, *a):
        s = self

        class Value:
            exists = staticmethod(lambda: s.value is not None)
            get = staticmethod(lambda: s.value)
            update = staticmethod(lambda v: setattr(s, "value", v))
        return Value

    def registerTimer(self, at):
        self.timers.add(at)

    def getCurrentWatermarkInMs(self):
        return self.mark


def test_windows_with_gaps_and_one_pane_a_batch():
    """Events with a gap longer than a window; the watermark moves by uneven steps."""
    rng = np.random.default_rng(3)
    hours = [*range(0, 9), *range(30, 41), 60]
    data = {h: rng.integers(0, 6, rng.integers(1, 8)).astype(float) for h in hours}
    state, w = State(), P.Windows(5, [0.5])
    w.init(state)
    got, sent = [], set()
    for mark in (3, 4, 9, 33, 33, 47, 70, 90):
        rows = [(h * P.HOUR_MS, v, 1) for h in hours if h < mark and h not in sent for v in data[h]]
        sent |= {h for h in hours if h < mark}
        state.mark = mark * P.HOUR_MS
        if rows:
            list(w.handleInputRows(("",), iter([pd.DataFrame(rows, columns=["hour_ms", "value", "n"])]), state))
        for at in sorted(t for t in state.timers if t <= state.mark):
            state.timers.discard(at)
            info = type("Info", (), {"getExpiryTimeInMs": staticmethod(lambda at=at: at)})
            for f in w.handleExpiredTimer(("",), state, info):
                got += list(zip((f["end_ms"] // P.HOUR_MS).tolist(), f["n_events"].tolist(), f["q0"].tolist()))
    want = []
    for end in range(1, 91):
        inside = [data[h] for h in hours if end - 5 <= h < end]
        if inside:
            v = np.concatenate(inside)
            want.append((end, v.size, float(np.median(v))))
    assert got == want and not state.map
