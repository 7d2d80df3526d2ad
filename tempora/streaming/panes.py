"""Sliding percentiles on a stream (#95): windows put together from hourly panes.

A first stateful operator counts equal values of an hour (a pane) until the watermark
closes it.  A second one keeps the panes of the last window, one map entry a day with the hours'
values and counts.  At each full hour it adds the new pane to the window's sum, takes the
old one off and reads exact quantiles.  So no event is
copied for the windows that it lies in, and state grows with panes."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

HOUR_MS = 3_600_000
DAY_MS = 24 * HOUR_MS
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def linear_quantiles(values: np.ndarray, counts: np.ndarray, probs: Sequence[float]) -> list[float]:
    """Linear quantiles of ascending distinct values that occur ``counts`` times."""
    upto = np.cumsum(counts)
    out = []
    for q in probs:
        rank = (upto[-1] - 1) * q
        low = int(np.floor(rank))
        a, b = (values[np.searchsorted(upto, min(i, upto[-1] - 1), side="right")] for i in (low, low + 1))
        out.append(float(a + (b - a) * (rank - low)))
    return out


def merged(panes: Sequence[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values and counts of several panes together, in which counts
    below zero take values out.  The panes are sorted runs, which a stable sort only merges."""
    values, counts = (np.concatenate(x) for x in zip(*panes))
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    new = np.ones(values.size, bool)
    new[1:] = (values[1:] != values[:-1]) & ~(np.isnan(values[1:]) & np.isnan(values[:-1]))
    at = np.flatnonzero(new)
    counts = np.add.reduceat(counts, at)
    return values[at][counts != 0], counts[counts != 0]


class Windows(StatefulProcessor):
    """Of a key's panes: at each hour that the watermark has passed, the
    window that ends there, where it holds an event.  A call to the state costs milliseconds
    whatever it carries, so an entry holds a day's panes and one timer waits for the next window."""

    def __init__(self, hours: int, probs: Sequence[float]):
        self.hours, self.probs = hours, list(probs)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.panes = handle.getMapState("panes", "day long", "hours binary, sizes binary, held binary, counts binary")
        self.done = handle.getValueState("done", "upto long")  # the last window end that was looked at

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(b["hour_ms"].to_numpy(np.int64), b["value"].to_numpy(float), b["n"].to_numpy(np.int64)) for b in rows]
        if not parts:
            return
        hours, values, counts = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(hours, kind="stable")
        hours, values, counts = hours[order], values[order], counts[order]
        held = {k[0] for k in self.panes.keys()}
        first = np.flatnonzero(np.diff(hours, prepend=hours[0] - 1))
        new = {int(hours[i]): (values[i:j], counts[i:j]) for i, j in zip(first, [*first[1:], hours.size])}
        for day in sorted({h // DAY_MS for h in new}):
            panes = self._day(day) if day in held else {}
            for h in [h for h in new if h // DAY_MS == day]:
                panes[h] = merged([panes[h], new[h]] if h in panes else [new[h]])
            self.panes.updateValue((day,), (np.array([*panes], np.int64).tobytes(), np.array([v.size for v, _ in panes.values()], np.int64).tobytes(),
                                            np.concatenate([v for v, _ in panes.values()]).tobytes(), np.concatenate([c for _, c in panes.values()]).tobytes()))
        # a window that has been told is not told again
        end = int(hours[0]) + HOUR_MS
        self.handle.registerTimer(max(end, self.done.get()[0] + HOUR_MS) if self.done.exists() else end)
        yield from ()

    def _day(self, day: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Panes of a day by hour."""
        hours, sizes, held, counts = self.panes.getValue((day,))
        ends = np.cumsum(np.frombuffer(sizes, np.int64))[:-1]
        return dict(zip(np.frombuffer(hours, np.int64).tolist(), zip(np.split(np.frombuffer(held), ends), np.split(np.frombuffer(counts, np.int64), ends))))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        first, mark = expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs()
        end = max(first, self.done.get()[0] + HOUR_MS) if self.done.exists() else first
        if end > mark:  # an earlier timer of the batch told it
            return
        days, left = deque(sorted(k[0] for k in self.panes.keys())), {}

        def gone(hour):
            left[hour // DAY_MS] -= 1
            if not left[hour // DAY_MS]:
                self.panes.removeKey((hour // DAY_MS,))

        # panes not yet reached, those in the window, and their sum, to which a pane is added once
        rows, ahead, inside, window = [], deque(), deque(), None
        while end <= mark:
            low = end - self.hours * HOUR_MS
            while days and days[0] * DAY_MS < end:
                day = days.popleft()
                panes = sorted(self._day(day).items(), key=lambda p: p[0])
                left[day] = len(panes)
                ahead.extend(panes)
            change = [] if window is None else [window]
            while inside and inside[0][0] < low:
                h, (values, counts) = inside.popleft()
                change.append((values, -counts))
                gone(h)
            while ahead and ahead[0][0] < end:
                h, pane = ahead.popleft()
                if h < low:
                    gone(h)
                else:
                    inside.append((h, pane))
                    change.append(pane)
            if inside:
                window = merged(change)
                rows.append((low, end, int(window[1].sum()), linear_quantiles(*window, self.probs)))
            elif ahead or days:
                window = None
            else:
                break
            end += HOUR_MS
        self.done.update((end - HOUR_MS,))
        if inside or ahead or days:
            self.handle.registerTimer(end)
        if rows:
            yield pd.DataFrame({"key": [key[0]] * len(rows), "start_ms": [r[0] for r in rows], "end_ms": [r[1] for r in rows], "n_events": [r[2] for r in rows],
                                **{f"q{i}": [r[3][i] for r in rows] for i in range(len(self.probs))}})

    def close(self) -> None:
        pass


def sliding_quantiles(stream: DataFrame, hours: int, probs: Sequence[float] = (0.25, 0.5, 0.75), lag: str = "3 hours", key: str | None = None) -> DataFrame:
    """Quantiles of ``value`` over windows of ``hours`` that end at each full
    hour, by ``key`` (a string column; all events together, where not given).  The query needs the
    RocksDB state store and append mode.  Windows are told once the watermark has passed their end; null
    values don't count; a window without a value is not told."""
    k = F.coalesce(F.col(key).cast("string"), F.lit("")) if key else F.lit("")
    counted = (stream.where("value is not null").withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", lag)
               .groupBy(F.window("ts", "1 hour").alias("w"), k.alias("key"), "value").agg(F.count("*").alias("n"))
               .select("key", F.window_time("w").alias("at"), F.unix_millis("w.start").alias("hour_ms"), "value", "n"))
    schema = "key string, start_ms long, end_ms long, n_events long, " + ", ".join(f"q{i} double" for i in range(len(probs)))
    out = counted.groupBy("key").transformWithStateInPandas(Windows(hours, probs), schema, "Append", "EventTime")
    return out.select(*(["key"] if key else []), F.timestamp_millis("start_ms").cast("timestamp_ntz").alias("window_start"),
                      F.timestamp_millis("end_ms").cast("timestamp_ntz").alias("window_end"), "n_events", *[f"q{i}" for i in range(len(probs))])
