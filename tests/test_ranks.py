"""Bucketed rank operators equal their single-task definitions, including a
hot group holding a third of the rows and heavy ties."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tempora.operators import ranks as R


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(6000):
        g = 0 if i % 3 == 0 else int(rng.integers(1, 20))     # group 0: a third of all rows
        v = float(np.round(rng.normal(0, 5), 1))                 # many ties
        rows.append((g, i, v, float(rng.uniform(0, 2))))
    return spark.createDataFrame(rows, "g long, t long, v double, y double")


def test_nearest_and_linear_quantiles(spark, skewed):
    got = {r.g: (r.q10, r.q50, r.q90) for r in
           R.nearest_quantiles(skewed, ["g"], "v", {"q10": 0.1, "q50": 0.5, "q90": 0.9}, n_buckets=16).collect()}
    lin = {r.g: (r.a, r.b) for r in R.linear_quantiles(skewed, ["g"], "v", {"a": 0.25, "b": 0.75}, 16).collect()}
    pdf = skewed.toPandas()
    for g, part in pdf.groupby("g"):
        xs = np.sort(part["v"].to_numpy())
        n = len(xs)
        exp = tuple(xs[int(np.floor((n - 1) * q + 0.5))] for q in (0.1, 0.5, 0.9))
        assert got[g] == exp
        assert lin[g] == pytest.approx((np.quantile(xs, 0.25), np.quantile(xs, 0.75)))


def test_prefix_ranks_equal_window(spark, skewed):
    r = R.prefix_ranks(skewed, ["g"], "v", "t", "y", n_buckets=16)
    w = Window.partitionBy("g").orderBy("v", "t")
    ref = skewed.select("g", "t", F.row_number().over(w).alias("i"),
                        F.sum("y").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("c"))
    a = {(x.g, x.t): (x._i, x._cum) for x in r.select("g", "t", "_i", "_cum").collect()}
    b = {(x.g, x.t): (x.i, x.c) for x in ref.collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and a[k][1] == pytest.approx(b[k][1], rel=1e-9)


def test_two_level_top_k_equals_brute_force(spark, skewed):
    from tempora.plans.queries_ops import top_k_per_group
    vc = skewed.groupBy("g", "v").agg(F.count("*").alias("n"))
    got = {(r.g, r.rank): (r.v, r.n) for r in top_k_per_group(vc, "g", "v", "n", 4, n_buckets=8).collect()}
    pdf = vc.toPandas().sort_values(["g", "n", "v"], ascending=[True, False, True])
    exp = {}
    for g, part in pdf.groupby("g"):
        for i, r in enumerate(part.head(4).itertuples(index=False), start=1):
            exp[(g, i)] = (r.v, r.n)
    assert got == exp
