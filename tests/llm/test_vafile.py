"""Exact top-k against brute force: ties, hard values, ragged rows."""

import math

import numpy as np
import pytest

from tempora.llm import vafile as V


def force(rows, every, k, scale=256.0):
    ok = [(i, [math.floor(x * scale) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (qi, q) in enumerate(ok):
        if qi % every == 0:
            best = sorted((-sum(x * y for x, y in zip(q, v)), i) for b, (i, v) in enumerate(ok) if b != a and len(v) == len(q))[:k]
            out += [(qi, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 2048])
def test_against_force(spark, block, monkeypatch):
    monkeypatch.setattr(V, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.1, 8).tolist()) for i in range(240)]
    rows += [(i, rows[3][1]) for i in range(300, 330)]  # copies: ties
    rows += [(50, rows[1][1]), (50, rows[1][1]), (400, [0.0] * 8), (401, [1e9] * 8), (450, [-1e9] * 8)]
    rows += [(None, [1.0] * 8), (500, None), (501, [float("nan")] + [0.0] * 7), (550, [None] + [0.0] * 7), (600, [float("inf")] * 8),
             (650, [1.0, 2.0]), (651, [2.0, 1.0]), (700, []), (701, []), (750, [3.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, block int").repartition(3)
    blocks_size, real = block, V.vector_blocks
    monkeypatch.setattr(V, "vector_blocks", lambda *a, **k: real(*a, **{**k, "size": blocks_size}))
    got = sorted(tuple(r) for r in V.top_k(df, "vec_id", "embedding", 50, 5).collect())
    assert got == force(rows, 50, 5)


def test_scan_prunes_and_stays_exact():
    """With a known k-th best only vectors that can still reach it are read."""
    rng = np.random.default_rng(5)
    vecs = [V._integers(rng.normal(0, 0.1, 16), 256.0) for _ in range(500)]
    b = V._pack(1, list(range(500)), vecs, V.BITS)
    q = np.array(vecs[:3], np.int64)
    row = type("R", (), {**b, "qids": np.arange(3).tobytes(), "own": np.array([[1, 0], [1, 1], [9, 9]], np.int64).tobytes(),
                         "qvecs": q.tobytes(), "qn": 3})
    found, kth = V.block_best(row, 5, np.full(3, -np.inf))
    for qi, (_, _, qid, ids, score) in enumerate(found):
        want = sorted((-int(np.dot(q[qi], v)), i) for i, v in enumerate(vecs) if not (qi < 2 and i == qi))[:5]
        assert [(-s, i) for i, s in zip(ids.tolist(), score.tolist())] == want and kth[qi] == -want[-1][0]
    again, _ = V.block_best(row, 5, kth + 1)
    assert sum(len(f[3]) for f in again) < 15


def test_empty(spark):
    assert V.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), "vec_id", "embedding", 50).count() == 0
    one = spark.createDataFrame([(50, [1.0])], "vec_id long, embedding array<float>")
    assert V.top_k(one, "vec_id", "embedding", 50).count() == 0


def test_query_blocks_go_in_bounded_groups(spark, monkeypatch):
    """Query blocks reach the tasks a few at a time and once, not a copy for each partition, and the result is whole."""
    monkeypatch.setattr(V, "GROUP_BYTES", 6000, raising=False)
    plans, sent, real_write, real_broadcast = [], [], V.Scratch.write, V.F.broadcast
    monkeypatch.setattr(V.Scratch, "write", lambda self, df, name: plans.append(df._jdf.queryExecution().toString()) or real_write(self, df, name))
    monkeypatch.setattr(V.F, "broadcast", lambda df: sent.append(df.collect()) or real_broadcast(df))
    real = V.query_blocks
    monkeypatch.setattr(V, "query_blocks", lambda blocks, every: real(blocks, every, 10))
    blocks = V.vector_blocks
    monkeypatch.setattr(V, "vector_blocks", lambda *a: blocks(*a, size=50))
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 0.1, 8 if i % 3 else 4).tolist()) for i in range(600)]
    rows += [(1000 + i, rows[i % 7][1]) for i in range(300)]  # ties over many blocks
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    assert sorted(tuple(r) for r in V.top_k(df, "vec_id", "embedding", 2, 5).collect()) == force(rows, 2, 5)
    assert not any("Generate" in x for x in plans)
    assert len(sent) > 3 and all(sum(len(r["qvecs"]) for r in x) <= 6000 for x in sent)
    assert sum(r["qn"] for x in sent for r in x) == sum(i % 2 == 0 for i, _ in rows)
    assert V._groups([(7, 5), (2, 9), (4, 6), (5, 3), (9, 40), (11, 1)], 10) == [(2, 2), (4, 5), (7, 7), (9, 9), (11, 11)]


def test_scores_at_the_ends_of_long(spark):
    """Equal scores at long's ends go by the id also when they come from several tasks."""
    rows = [(i, [1e18 if i % 2 else -1e18, 1e18]) for i in range(0, 60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    ends = lambda v: [max(-2**63, min(2**63 - 1, math.floor(x * 256))) for x in v]
    want = []
    for a in (0, 30):
        best = sorted((-max(-2**63, min(2**63 - 1, sum(x * y for x, y in zip(ends(rows[a][1]), ends(v))))), i) for i, v in rows if i != a)[:5]
        want += [(a, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in V.top_k(df, "vec_id", "embedding", 30, 5).collect()) == want
