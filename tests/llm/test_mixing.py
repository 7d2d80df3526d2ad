"""Mixing: targets, min-cost flow against brute force, taken words."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from tempora.llm import mixing as M


def test_targets():
    assert M.targets([10, 10, 10], [1, 2, 3], 30) == pytest.approx([5, 10, 15])
    assert M.targets([1, 99], [3, 1], 100) == pytest.approx([3, 97])
    assert M.targets([0, 5], [1, 1], 5) == pytest.approx([0, 5]) and M.targets([], [], 0) == [] and M.targets([0, 0], [1, 2], 0) == [0, 0]
    got = M.targets([1, 2, 50], [3, 3, 1], 53)
    assert got[0] == 3 and got[1] == 6 and got[2] == pytest.approx(44)


def force_cost(capacity, members, quotas, repeats):
    """Least cost of the largest flow, over all integer flows."""
    arcs = [(p, s) for p, ms in enumerate(members) for s in ms]
    best = (0, 0)
    for f in itertools.product(*[range(min(repeats * capacity[p], quotas[s]) + 1) for p, s in arcs]):
        by_p, by_s = [0] * len(capacity), [0] * len(quotas)
        for (p, s), x in zip(arcs, f):
            by_p[p] += x
            by_s[s] += x
        if any(x > q for x, q in zip(by_s, quotas)) or any(x > repeats * c for x, c in zip(by_p, capacity)):
            continue
        best = min(best, (-sum(f), cost_of(by_p, capacity)))
    return best


def cost_of(by_p, capacity):
    return sum(max(0, x - k * c) for x, c in zip(by_p, capacity) for k in range(1, 9))


def test_flow_against_force():
    rng = random.Random(1)
    for _ in range(60):
        capacity = [rng.randint(0, 2) for _ in range(rng.randint(1, 3))]
        members = [sorted(rng.sample(range(2), rng.randint(1, 2))) for _ in capacity]
        quotas = [rng.randint(0, 4), rng.randint(0, 4)]
        flow = M.route(capacity, members, quotas, 2)
        by_p = [sum(f.values()) for f in flow]
        by_s = [sum(f.get(s, 0) for f in flow) for s in range(2)]
        assert all(x <= 2 * c for x, c in zip(by_p, capacity)) and all(x <= q for x, q in zip(by_s, quotas))
        assert all(x >= 0 for f in flow for x in f.values())
        assert (-sum(by_p), cost_of(by_p, capacity)) == force_cost(capacity, members, quotas, 2)


def make(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(["w"] * rng.randint(1, 40)), rng.choice(["a", "b", "b", "b", "c", "é", None]), 7) for i in range(800)]
    rows += [(9000, None, "a", 7), (9001, "", None, 7), (5, rows[5][1], rows[5][2], 7), (None, "no id here", "c", 7)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, size int")


@pytest.mark.parametrize("bucket_rows", [20, 4096])
def test_taken(spark, bucket_rows, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", bucket_rows)
    rows, docs = make(spark)
    out, listed = M.mix(docs, F.array("source"), M.word_count(F.col("text")))
    got = out.collect()
    assert len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        s = r["sources"][0]
        assert 0 <= r["copies"] <= 3 and (r["size"] or not r["copies"])
        sizes[s] = sizes.get(s, 0) + r["size"]
        taken[s] = taken.get(s, 0) + r["size"] * r["copies"]
    weights = dict(zip(["a", "b", "c", "é", None], [1, 2, 3, 1, 2]))
    names = list(weights)
    want = dict(zip(names, M.targets([sizes[s] for s in names], [weights[s] for s in names], sum(sizes.values()))))
    for r in listed.collect():
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert abs(taken[r["source"]] - r["target"]) <= 40
    again, _ = M.mix(docs.repartition(5), F.array("source"), M.word_count(F.col("text")))
    assert sorted(map(str, again.collect())) == sorted(map(str, got))


def test_overlap(spark):
    """Documents of both sources serve the one that lacks tokens."""
    rows = [(i, ["a"] if i < 10 else ["a", "b"] if i < 40 else ["c"], 10) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, s array<string>, n long")
    out, listed = M.mix(docs, F.col("s"), F.col("n"), weigh=lambda names: [1.0] * len(names))
    assert {r["source"]: r["source_size"] for r in listed.collect()} == {"a": 400, "b": 300, "c": 600}
    used = {}
    for r in out.collect():
        used[tuple(r["sources"])] = used.get(tuple(r["sources"]), 0) + r["copies"] * r["size"]
    assert used[("a",)] + used[("a", "b")] == pytest.approx(2000 / 3, abs=20) and used[("c",)] == pytest.approx(1000 / 3, abs=10)


def test_take(spark):
    rows, docs = make(spark)
    out = M.take(docs)
    assert out.columns == docs.columns
    counts = {}
    for r in out.collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + 1
    mixed, _ = M.mix(docs, F.array("source"), M.word_count(F.col("text")), tie=F.xxhash64(F.coalesce("text", F.lit(""))))
    want = {}
    for r in mixed.collect():
        want[r["id"]] = want.get(r["id"], 0) + r["copies"]
    assert counts == {k: v for k, v in want.items() if v}
    assert M.take(docs.limit(0)).count() == 0


@pytest.mark.parametrize("seed", [1])
def test_long_document_in_the_last_bucket(spark, seed):
    """What a very long document leaves open is made up from later buckets."""
    rows = [(i, "a", 200) for i in range(5000)] + [(5000, "a", 500_000), (5001, "b", 1_500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n long")
    for share in (0.15, 0.5, 0.6):  # short documents alone can fill these
        out, listed = M.mix(docs, F.array("source"), F.col("n"), weigh=lambda names: [share, 2 - share], seed=seed)
        want = {r["source"]: r["target"] for r in listed.collect()}
        got = out.collect()
        assert len(got) == len(rows)
        assert want["a"] - 200 < sum(r["size"] * r["copies"] for r in got if r["sources"][0] == "a") <= want["a"] + 1
