"""Exact top-k inner products with vector-approximation files.

Vectors are packed in blocks, each with an approximation: per dimension the
block's range is cut in 2^bits cells of one integer width, and a vector keeps
one byte of cell number a dimension.  For a query q the middle of a vector's
cells gives its score up to +-e, e = sum |q_j| * half a cell.  A task scans a
block's cells (one matrix product), takes as candidates what can still reach
the k-th best, and reads exact vectors in the order of their upper bounds
until the k-th result is certain.  The best k that a task has seen for a
query block are carried to its next vector blocks, so most blocks end after
the scan, and a task gives its best k only; those of all tasks are merged per query block.

Query blocks (the stated query set, in blocks) are taken a group of bounded size at a
time: a group goes to every task that scans vector blocks, so neither the driver nor a
shuffle holds more than one group, and vector blocks are not moved.  Rows of other lengths never meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import Scratch, col, table

BITS = 6
BLOCK = 2048
LONG = 2**63 - 1
#: Bytes of query blocks that every task holds at once, with their results.
GROUP_BYTES = 16 << 20
#: Bytes of joined rows that reach Python at once.
BATCH_BYTES = 1 << 22
BLOCK_SCHEMA = "block long, dim int, n int, ids binary, wide boolean, vecs binary, lo binary, step binary, cells binary"


def _integers(vec: np.ndarray, scale: float) -> np.ndarray | None:
    """floor(scale * x) per component as int64, limited to long's range."""
    v = np.floor(vec * scale)
    if np.all(np.abs(v) < 2**62):
        return v.astype(np.int64)
    return np.array([min(max(int(x), -LONG - 1), LONG) for x in v.tolist()], np.int64)


def _pack(block: int, ids: list, vecs: list, bits: int) -> dict:
    v = np.array(vecs, np.int64).reshape(len(ids), -1)
    top = max(abs(int(v.max())), abs(int(v.min()))) if v.size else 0
    wide = top * top * max(v.shape[1], 1) >= 2**52  # float64 would not be exact
    lo = v.min(axis=0) if v.size else np.zeros(v.shape[1], np.int64)
    step = np.zeros_like(lo) if wide else np.maximum(1, -(-(v.max(axis=0) - lo + 1) // (1 << bits))) if v.size else np.ones_like(lo)
    cells = np.zeros(0, np.uint8) if wide else ((v - lo) // step).astype(np.uint8)
    return {"block": block, "dim": v.shape[1], "n": len(ids), "ids": np.array(ids, np.int64).tobytes(), "wide": bool(wide),
            "vecs": _narrow(v), "lo": lo.tobytes(), "step": step.tobytes(), "cells": cells.tobytes()}


def _narrow(v: np.ndarray) -> bytes:
    """Vectors in the narrowest of three integer types."""
    top = max(-int(v.min()) - 1, int(v.max())) if v.size else 0
    return v.astype(np.int16 if top < 2**15 else np.int32 if top < 2**31 else np.int64).tobytes()


def _vectors(vecs: bytes, dim: int, n: int) -> np.ndarray:
    return np.frombuffer(vecs, f"i{len(vecs) // (n * dim) if n * dim else 8}").reshape(n, dim)


def vector_blocks(df: DataFrame, id_col: str, vec_col: str, scale: float = 256.0, bits: int = BITS, size: int = BLOCK) -> DataFrame:
    """Blocks of the valid rows: id and vector not null, all components
    finite.  A block holds vectors of one length; its number is unique."""
    x = F.transform(col(vec_col), lambda e: e.cast("double"))
    rows = df.select(col(id_col).cast("long").alias("id"), x.alias("vec")).where("id is not null and vec is not null")
    rows = rows.where(~F.exists("vec", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, tuple[list, list]] = {}
        number = TaskContext.get().partitionId() << 40
        for batch in batches:
            for i, v in zip(batch["id"].tolist(), batch["vec"]):
                ids, vecs = held.setdefault(len(v), ([], []))
                ids.append(i)
                vecs.append(_integers(np.asarray(v, np.float64), scale))
                if len(ids) == size:
                    yield pd.DataFrame([_pack(number, *held.pop(len(v)), bits)])
                    number += 1
        for ids, vecs in held.values():
            yield pd.DataFrame([_pack(number, ids, vecs, bits)])
            number += 1

    return rows.mapInPandas(run, BLOCK_SCHEMA)


def query_blocks(blocks: DataFrame, every: int, size: int = BLOCK) -> DataFrame:
    """The rows with an id divisible by ``every``, packed anew; ``own`` is
    each row's place (block, position), since ids may repeat."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        number = TaskContext.get().partitionId() << 40

        def out(dim: int, parts: list) -> pd.DataFrame:
            nonlocal number
            number += 1
            ids, own, vecs = (np.concatenate(x) for x in zip(*parts))
            return pd.DataFrame([{"qblock": number, "dim": dim, "qn": len(ids), "qids": ids.tobytes(), "own": own.tobytes(), "qvecs": _narrow(vecs)}])

        for batch in batches:
            for r in batch.itertuples():
                ids = np.frombuffer(r.ids, np.int64)
                at = np.flatnonzero(ids % every == 0)
                if at.size:
                    v = _vectors(r.vecs, r.dim, r.n)[at].astype(np.int64)
                    own = np.stack([np.full(at.size, r.block, np.int64), at], axis=1)
                    parts = held.setdefault(r.dim, [])
                    parts.append((ids[at], own, v))
                    if sum(len(p[0]) for p in parts) >= size:
                        yield out(r.dim, held.pop(r.dim))
        for dim, parts in held.items():
            yield out(dim, parts)

    few = blocks.select("block", "dim", "n", "ids", "vecs").repartition("dim", F.floor(F.col("block") / 64))
    return few.mapInPandas(run, "qblock long, dim int, qn int, qids binary, own binary, qvecs binary")


def _exact(q: np.ndarray, v: np.ndarray, wide: bool) -> np.ndarray:
    """Exact scores; beyond long's range they stay at its ends."""
    if wide:
        s = v.astype(object) @ q.astype(object)
        return np.array([min(max(int(x), -LONG - 1), LONG) for x in np.atleast_1d(s)], np.int64)
    return (v.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)


def _candidates(r, k: int, kth: np.ndarray, kth_ids: np.ndarray | None = None, chunk: int = 64) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query's position, ids, scores): the best k of one vector block for each query of one query block,
    without those below ``kth`` (per query, a score that k others are known to reach, the last of them with
    ``kth_ids``); where it is not known yet, it is raised."""
    q = _vectors(r.qvecs, r.dim, r.qn)
    own = np.frombuffer(r.own, np.int64).reshape(-1, 2)
    ids, v = np.frombuffer(r.ids, np.int64), _vectors(r.vecs, r.dim, r.n)
    qtop, vtop = (max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0 for x in (q, v))
    wide = bool(r.wide) or qtop * vtop * max(r.dim, 1) >= 2**52
    live_queries = range(r.qn)
    if not wide:
        lo, step = np.frombuffer(r.lo, np.int64), np.frombuffer(r.step, np.int64)
        cells = np.frombuffer(r.cells, np.uint8).reshape(r.n, r.dim)
        half = (step - 1) / 2
        qf = q.astype(np.float64)
        middle = lo + half + step * cells.astype(np.float64)
        error = np.abs(qf) @ half
        upper = qf @ middle.T + error[:, None]
        live_queries = np.flatnonzero(kth == -np.inf).tolist()
        known = np.flatnonzero((kth > -np.inf) & (upper.max(axis=1) >= kth))
        for part in np.array_split(known, -(-known.size // 256)) if known.size else []:
            i, at = np.nonzero(upper[part] >= kth[part, None])
            i = part[i]
            score = np.concatenate([np.einsum("ij,ij->i", qf[i[x:x + 4096]], v[at[x:x + 4096]].astype(np.float64)) for x in range(0, max(1, i.size), 4096)]).astype(np.int64)
            last = kth[i] if kth_ids is None else np.where(ids[at] < kth_ids[i], kth[i], kth[i] + 1)
            keep = (score >= last) & ((own[i, 0] != r.block) | (own[i, 1] != at))
            i, at, score = i[keep], at[keep], score[keep]
            order = np.lexsort((ids[at], -score, i))
            i, at, score = i[order], at[order], score[order]
            first = np.flatnonzero(np.append(True, i[1:] != i[:-1])).tolist() if i.size else []
            for x, y in zip(first, [*first[1:], i.size]):
                y = min(y, x + k)
                yield int(i[x]), ids[at[x:y]], score[x:y]
    for i in live_queries:
        self_at = int(own[i, 1]) if own[i, 0] == r.block else -1
        if wide:
            at = np.arange(r.n)
            at = at[at != self_at]
            score = _exact(q[i], v[at], True)
        else:
            up = upper[i]
            if self_at >= 0:
                up = up.copy()
                up[self_at] = -np.inf
            live = r.n - (self_at >= 0)
            need = kth[i]
            if live >= k:  # k lower bounds are at least this
                need = max(need, np.partition(up, r.n - k)[r.n - k] - 2 * error[i])
            at = np.flatnonzero(up >= need) if need > -np.inf else np.flatnonzero(up > -np.inf)
            at = at[np.argsort(-up[at], kind="stable")]
            got, score = 0, np.empty(0, np.int64)
            while got < at.size and (score.size < k or up[at[got]] >= max(need, np.partition(score, score.size - k)[score.size - k])):
                score = np.concatenate([score, _exact(q[i], v[at[got:got + chunk]], False)])
                got += chunk
            at = at[:score.size]
        if not at.size:
            continue
        best = np.lexsort((ids[at], -score))[:k] if score.min() > -LONG - 1 else np.array(sorted(range(at.size), key=lambda x: (-int(score[x]), int(ids[at[x]])))[:k])
        if best.size == k:
            kth[i] = max(kth[i], float(score[best[-1]]) if abs(int(score[best[-1]])) < 2**52 else -np.inf)
        best = best[score[best] >= kth[i]] if not wide else best
        yield i, ids[at[best]], score[best]


def block_best(r, k: int, kth: np.ndarray) -> tuple[list, np.ndarray]:
    """``_candidates`` with the query's place and id; and the raised ``kth``."""
    kth = kth.copy()
    qids, own = np.frombuffer(r.qids, np.int64), np.frombuffer(r.own, np.int64).reshape(-1, 2)
    return [(int(own[i, 0]), int(own[i, 1]), int(qids[i]), ids, score) for i, ids, score in _candidates(r, k, kth)], kth


class Best:
    """The best k of each query of a block so far, ties to the smaller id."""

    def __init__(self, qids: bytes, qn: int, k: int):
        self.qids, self.k = qids, k
        self.n, self.kth, self.kth_ids = np.zeros(qn, np.int64), np.full(qn, -np.inf), np.zeros(qn, np.int64)
        self.ids, self.scores = np.zeros((qn, k), np.int64), np.zeros((qn, k), np.int64)

    def add(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        n = self.n[i]
        ids, scores = np.concatenate([self.ids[i, :n], ids]), np.concatenate([self.scores[i, :n], scores])
        best = np.lexsort((ids, ~scores))[:self.k]  # ~x falls as x grows, also at long's ends
        self.n[i] = n = best.size
        self.ids[i, :n], self.scores[i, :n] = ids[best], scores[best]
        last = int(scores[best[-1]])
        if n == self.k and abs(last) < 2**52:
            self.kth[i], self.kth_ids[i] = last, ids[best[-1]]

    def row(self, qblock: int) -> pd.DataFrame:
        has = np.arange(self.k) < self.n[:, None]
        return pd.DataFrame([{"qblock": qblock, "qids": self.qids, "counts": self.n.astype(np.int32).tobytes(), "ids": self.ids[has].tobytes(),
                              "scores": self.scores[has].tobytes()}])


BEST_SCHEMA = "qblock long, qids binary, counts binary, ids binary, scores binary"


def _search(k: int):
    """Vector blocks, each joined with all query blocks of a group: the task's best k of each query."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Best] = {}
        for batch in batches:
            for r in batch.itertuples():
                best = seen.get(r.qblock)
                if best is None:
                    best = seen[r.qblock] = Best(r.qids, r.qn, k)
                for found in _candidates(r, k, best.kth, best.kth_ids):
                    best.add(*found)
        while seen:
            qblock, best = seen.popitem()
            yield best.row(qblock)

    return run


def _merge(k: int):
    """Rows of BEST_SCHEMA sorted by query block: the best k of all."""

    def ranked(best: Best) -> pd.DataFrame:
        has = np.arange(k) < best.n[:, None]
        rank = np.broadcast_to(np.arange(1, k + 1, dtype=np.int32), has.shape)
        qids = np.repeat(np.frombuffer(best.qids, np.int64), best.n)
        return pd.DataFrame({"query_id": qids, "rank": rank[has], "vec_id": best.ids[has], "score": best.scores[has]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, best = None, None
        for batch in batches:
            for r in batch.itertuples():
                counts = np.frombuffer(r.counts, np.int32)
                if r.qblock != key:
                    if best is not None:
                        yield ranked(best)
                    key, best = r.qblock, Best(r.qids, counts.size, k)
                ids, scores, ends = np.frombuffer(r.ids, np.int64), np.frombuffer(r.scores, np.int64), np.cumsum(counts).tolist()
                for i, (lo, hi) in enumerate(zip([0, *ends], ends)):
                    if hi > lo and (best.n[i] < k or scores[lo] >= best.kth[i]):
                        best.add(i, ids[lo:hi], scores[lo:hi])
        if best is not None:
            yield ranked(best)

    return run


def _groups(sizes: list[tuple[int, int]], limit: int) -> list[tuple[int, int]]:
    """First and last number of the query blocks (number, bytes) that are taken together."""
    out: list[list[int]] = []
    room = 0
    for number, size in sorted(sizes):
        if out and size <= room:
            out[-1][1] = number
        else:
            out.append([number, number])
            room = limit
        room -= size
    return [(a, b) for a, b in out]


RESULT_SCHEMA = "query_id long, rank int, vec_id long, score long"


def top_k(df: DataFrame, id_col: str, vec_col: str, every: int, k: int = 5, scale: float = 256.0, bits: int = BITS) -> DataFrame:
    """For each row whose id is divisible by ``every``: its k best other rows
    by the integer inner product of floor(scale * x), ties to the smaller id.

    Returns query_id, rank (from 1), vec_id, score; fewer than k rows if
    there are fewer candidates.  Rows with a null id, a null vector or a null
    or non-finite component take no part; vectors of different lengths don't
    meet; empty vectors meet each other at score 0.  Repeated rows are rows
    of their own, as queries too.  Scores beyond long's range stay at its
    ends."""
    spark = df.sparkSession
    scratch = Scratch(spark, "vafile", free=True, batch_bytes=BATCH_BYTES)
    blocks = scratch.write(vector_blocks(df, id_col, vec_col, scale, bits), "blocks")
    queries = scratch.write(query_blocks(blocks, every), "queries")
    # a row for each query block: its number, and the bytes that a task needs for it and for its results
    sizes = queries.select("qblock", F.length("qvecs") + F.col("qn") * (16 * k + 64)).collect()
    paths = []
    for first, last in _groups([tuple(x) for x in sizes], GROUP_BYTES):
        pairs = blocks.join(F.broadcast(queries.where(F.col("qblock").between(first, last))), "dim")
        near = pairs.mapInPandas(_search(k), BEST_SCHEMA).repartition("qblock").sortWithinPartitions("qblock")
        paths.append(scratch.write(near.mapInPandas(_merge(k), RESULT_SCHEMA), "best")._scratch)
    scratch.drop(blocks, queries)
    return spark.read.schema(RESULT_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], RESULT_SCHEMA)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``embeddings``; queries: vec_id divisible by 50; 5 best each."""
    return top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 50, 5)


OP2_SQL = """
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
           FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.rid <> c.rid AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""
