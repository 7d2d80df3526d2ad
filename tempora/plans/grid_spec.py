"""A regular time grid as a value object: start, end (inclusive), step."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.functions.timecols import (
    from_micros_value, position, shift_time, step_seconds, time_at, to_micros_value,
)
from tempora.operators import grid as G


@dataclass(frozen=True)
class GridSpec:
    start: object
    end: object
    step: object = "1 hour"
    integer_time: bool = False

    @staticmethod
    def from_data(df: DataFrame, time_col: str = "time", step="1 hour",
                  integer_time: bool = False) -> "GridSpec":
        lo, hi = G.time_bounds(df, time_col)
        return GridSpec(lo, hi, step, integer_time)

    @property
    def n(self) -> int:
        return G.n_steps(self.start, self.end, self.step, "both", self.integer_time)

    @property
    def step_hours(self) -> float:
        return step_seconds(self.step) / 3600.0

    def pos(self, time_col: str = "time") -> Column:
        return position(time_col, self.start, self.step, self.integer_time)

    def time(self, pos: Column) -> Column:
        return time_at(pos, self.start, self.step, self.integer_time)

    def shift(self, c, n_steps: int) -> Column:
        if self.integer_time:
            c = F.col(c) if isinstance(c, str) else c
            return c + F.lit(int(n_steps) * int(self.step))
        return shift_time(c, n_steps, self.step)

    def at(self, k: int):
        """Python value of grid point ``k``."""
        if self.integer_time:
            return int(self.start) + k * int(self.step)
        return from_micros_value(to_micros_value(self.start)
                                 + k * step_seconds(self.step) * 1_000_000)

    def frame(self, spark: SparkSession, time_col: str = "time") -> DataFrame:
        return G.time_grid(spark, self.start, self.end, self.step, time_col, "both",
                           self.integer_time)

    def panel(self, series: DataFrame, keys, time_col: str = "time") -> DataFrame:
        return G.panel_grid(series, keys, self.start, self.end, self.step, time_col, "both",
                            self.integer_time)
