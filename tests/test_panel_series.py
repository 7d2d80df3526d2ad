"""The panel fill without a join to the grid."""

import datetime as dt

import pytest

from tempora.plans import features as FT
from tempora.plans.grid_spec import GridSpec


@pytest.mark.parametrize("block", [3, 4096])
def test_same_as_the_join(spark, block):
    """Gaps at both ends, over several blocks and at the first place; a null key, null values and times."""
    held = {"a": {0: 1.0, 5: 4.0, 14: 2.0}, "b": {7: 3.0}, "c": {1: None, 2: 1.0, 3: float("nan"), 16: 9.0}, "d": {4: None}, None: {0: 1.0, 19: 2.0}}
    t0 = dt.datetime(2024, 1, 1)
    rows = [(k, t0 + dt.timedelta(days=p), v) for k, values in held.items() for p, v in values.items()] + [("b", None, 1.0)]
    obs = spark.createDataFrame(rows, "series_id string, time timestamp_ntz, load_mw double")
    grid = GridSpec.from_data(obs, "time", "1 day")
    got, want = (sorted(map(str, f(obs, grid, "series_id", block_size=block).collect())) for f in (FT.panel_series, FT.target_series))
    assert len(got) == 100 and got == want


def test_no_grid_is_shuffled(spark):
    """The plan has no row of the grid before its last shuffle: each Generate lies above all Exchanges."""
    obs = spark.sql("select id % 3 series_id, timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(id) time, 1.0D load_mw from range(30)")
    plan = FT.panel_series(obs, GridSpec(dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 30), "1 day"), "series_id")
    text = plan._jdf.queryExecution().executedPlan().toString().split("\n")
    at = [i for i, line in enumerate(text) if "Generate" in line]
    assert at and all("Exchange" not in line for line in text[:at[0]]) and len(at) == 1
