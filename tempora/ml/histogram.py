"""Histogram trees on Spark: leaf-limited boosting and joint forests (#126-#131, #135).

Many models grow together: every fold, horizon, quantile, search trial or
forest tree is one :class:`Spec`.  Features are binned once and packed into
chunks of rows.  A pass is one Spark job over all chunks; each task
sends its rows down the unfinished trees, adds up gradient histograms of the nodes asked for
and, where a node's rows lie in several chunks, the histograms are
shuffled by (model, node, feature block) and added again.  What comes back
to the driver is the best split of each node.  The driver keeps a queue of gains per model and
grows best-first up to ``max_leaf_nodes``; a model never waits for another one.

Missing values have a bin of their own; each split learns the side on which they go.  With several
targets the gain is summed over them, so that one tree serves them all.

Memory in a task is one chunk and the histograms of one pass
(HISTOGRAM_BYTES); on the driver it is the trees.  Predictions so far are
kept with the chunks, in a table under the checkpoint folder that is written anew after
every FOLD_TREES trees of a model: a lost executor costs one pass."""

from __future__ import annotations

import heapq
import pickle
import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.session import materialize, release

MISSING = 255
#: Rows of a chunk, and bytes of its predictions, at most; a task holds one chunk at a time.
CHUNK_ROWS, CHUNK_BYTES = 1 << 16, 64 << 20
#: Histograms that a task may hold in a pass; further nodes wait for the next one.
HISTOGRAM_BYTES = 256 << 20
#: Features of one block: what is shuffled and added as one row.
BLOCK_FEATURES = 32
#: Trees of a model that passes go through again before they are folded into the chunks' predictions.
FOLD_TREES = 10
#: Levels of a tree that one pass goes down where no exchange lies between them.
LEVELS = 3
#: Values of an exact quantile that may be looked at together; a larger set is narrowed first.
NARROW_TO, NARROW_WAYS = 2048, 1024
NARROW, VALUES, EQUAL = range(3)
LOG_LINK = ("poisson", "gamma")


@dataclass(frozen=True)
class Spec:
    """One model.  ``train_set``: the bit of its training rows; ``targets``:
    positions in the target list (several: joint trees, squared loss only);
    ``features``: positions it may split on (None: all); ``bootstrap``: seed
    of Poisson(1) row counts (None: every row once); ``baseline``: start from the best constant."""
    train_set: int = 0
    targets: tuple[int, ...] = (0,)
    loss: str = "squared"
    quantile: float = 0.5
    rounds: int = 100
    learning_rate: float = 0.1
    max_leaf_nodes: int | None = 31
    max_depth: int | None = None
    min_samples_leaf: int = 20
    l2: float = 0.0
    features: tuple[int, ...] | None = None
    bootstrap: int | None = None
    baseline: bool = True

    def __post_init__(self):
        if self.loss not in ("squared", "quantile", *LOG_LINK):
            raise ValueError(f"unknown loss {self.loss}")
        if len(self.targets) > 1 and self.loss != "squared":
            raise ValueError("several targets need the squared loss")
        if (self.max_leaf_nodes or 2) < 2 or self.rounds < 1:
            raise ValueError("at least two leaves and one round")

    @property
    def kept(self) -> int:
        """Predictions a row that go from round to round."""
        return len(self.targets) if self.rounds > 1 else 0


@dataclass
class Tree:
    """Nodes in arrays; a leaf has left = -1.  Rows with bin <= cut go left."""
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray  # nodes x targets

    def leaves(self, bins: np.ndarray, root: np.ndarray | int = 0) -> np.ndarray:
        """The leaf of each column of ``bins`` (features x rows), from ``root``
        (a column of roots: a row for each)."""
        rows = np.arange(bins.shape[1])
        node = np.zeros(bins.shape[1], np.int32) + np.asarray(root, np.int32)
        while True:
            inner = self.left[node] >= 0
            if not inner.any():
                return node
            b = bins[self.feature[node], rows]
            to = np.where(np.where(b == MISSING, self.missing_left[node], b <= self.cut[node]), self.left[node], self.right[node])
            node = np.where(inner, to, node)


def _side_by_side(trees: list[Tree]) -> tuple[Tree, np.ndarray]:
    """All nodes in one set of arrays, and where each tree's root is."""
    root = np.cumsum([0] + [t.left.size for t in trees[:-1]]).astype(np.int32)
    both = [np.concatenate([np.where(x >= 0, x + r, -1) for x, r in zip(side, root)]) for side in ([t.left for t in trees], [t.right for t in trees])]
    return Tree(*[np.concatenate(x) for x in zip(*[(t.feature, t.cut, t.missing_left) for t in trees])], *both, np.concatenate([t.value for t in trees])), root


def _added(trees: tuple[Tree, np.ndarray] | None, bins: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """``raw`` (targets x rows) and what the trees (side by side) add, in their order."""
    if trees is None or not bins.shape[1]:
        return raw
    all_, root = trees
    wide = max(1, (1 << 20) // bins.shape[1])  # so many trees go through together
    for at in range(0, root.size, wide):
        for node in all_.leaves(bins, root[at:at + wide, None]):
            raw = raw + all_.value[node].T
    return raw


# ------------------------------------------------------------------ binning

@dataclass
class Binning:
    """Ascending cuts per feature (254 at most); a value's bin is the number
    of cuts below it.  Null and NaN are missing."""
    columns: list[str]
    cuts: list[np.ndarray]

    def apply(self, values: np.ndarray) -> np.ndarray:
        """features x rows of doubles (NaN: missing) as bins."""
        out = np.empty(values.shape, np.uint8)
        for f, c in enumerate(self.cuts):
            out[f] = np.searchsorted(c, values[f], side="left")
        out[np.isnan(values)] = MISSING
        return out


def fit_bins(df: DataFrame, columns: Sequence[str], max_bins: int = 255) -> Binning:
    """Cuts midway between the values of features with at most ``max_bins``
    values, at quantiles (``percentile_approx``, at most ``max_bins`` - 1) of
    the others.  Two aggregates; what is collected is bounded by features x bins.

    The cuts see the feature values of all rows, never a target."""
    if not 2 <= max_bins <= 255:
        raise ValueError("2 to 255 bins")
    num = {c: _number(c) for c in columns}
    many = df.agg(*[F.approx_count_distinct(num[c]).alias(c) for c in columns]).first().asDict()
    few = [c for c in columns if many[c] <= 1.3 * max_bins]
    probs = [i / max_bins for i in range(1, max_bins)]
    # a sketch that is off can't make the set larger than the counted bound by much
    row = df.agg(*[F.slice(F.sort_array(F.collect_set(num[c])), 1, 2 * max_bins + 2).alias(c) if c in few
                   else F.percentile_approx(num[c], probs, 100_000).alias(c) for c in columns]).first().asDict()
    cuts = []
    for c in columns:
        v = np.unique(np.array(row[c] or [], float))
        if c in few and v.size <= max_bins:
            cuts.append((v[:-1] + v[1:]) / 2)
        elif c in few:
            cuts.append(np.unique(v[(np.arange(1, max_bins) * v.size) // max_bins]))
        else:
            cuts.append(v)
    return Binning(list(columns), cuts)


def _number(name: str) -> Column:
    x = F.col(f"`{name}`").cast("double")
    return F.when(~F.isnan(x), x)


def _matrix(batch: pa.RecordBatch, first: int, count: int) -> np.ndarray:
    return np.stack([batch.column(first + k).to_numpy(zero_copy_only=False).astype(float) for k in range(count)]) if count else np.zeros((0, batch.num_rows))


# ------------------------------------------------------------- kernels of a task

@dataclass
class _Ask:
    """What a pass asks of one model: ``kind`` init, split or rank, for
    ``nodes`` of the tree as grown so far (rank: node -> (low, high, mode))."""
    model: int
    kind: str
    spec: Spec
    pending: tuple[Tree, np.ndarray] | None
    tree: Tree | None
    nodes: list[int] = field(default_factory=list)
    ranges: dict = field(default_factory=dict)


def _keys(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles."""
    b = (x + 0.0).view(np.int64)
    return b ^ ((b >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))


def _double(key: int) -> float:
    b = np.array([key], np.int64)
    return float((b ^ ((b >> np.int64(63)) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64)[0])


def _row_counts(seed: np.ndarray, bootstrap: int) -> np.ndarray:
    """Poisson(1) counts from the rows' hashes, the same in any layout."""
    z = seed + np.uint64((bootstrap * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % 2**64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
    u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2**53
    steps, p, total = [], np.exp(-1.0), 0.0
    for k in range(12):
        total += p
        steps.append(total)
        p /= k + 1
    return np.searchsorted(np.array(steps), u, side="right").astype(float)


def _gradients(spec: Spec, raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient (targets x rows) and second derivative (rows)."""
    if spec.loss == "squared":
        return raw - y, np.ones(y.shape[1])
    if spec.loss == "quantile":
        return np.where(y < raw, 1 - spec.quantile, -spec.quantile), np.ones(y.shape[1])
    e = np.exp(raw if spec.loss == "poisson" else -raw)
    return (e - y, e[0]) if spec.loss == "poisson" else (1 - y * e, (y * e)[0])


class _Layout:
    """Where the bins of each feature (its missing bin last) lie in a histogram."""

    def __init__(self, sizes: Sequence[int]):
        self.sizes = np.array(sizes, np.int64) + 1
        self.start = np.concatenate([[0], np.cumsum(self.sizes)])[:-1]
        self.total = int(self.sizes.sum())

    def flat(self, bins: np.ndarray) -> np.ndarray:
        """Places in the histogram: features x rows."""
        return self.start[:, None] + np.where(bins == MISSING, (self.sizes - 1)[:, None], bins)

    def histogram(self, flat: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """Sums of each row of ``stats`` (gradients, second derivative, count) per place."""
        at = flat.ravel()
        return np.stack([np.bincount(at, np.broadcast_to(s, flat.shape).ravel(), self.total) for s in stats])

    def blocks(self) -> list[tuple[int, int]]:
        return [(a, min(a + BLOCK_FEATURES, len(self.sizes))) for a in range(0, len(self.sizes), BLOCK_FEATURES)]

    def part(self, first: int, last: int) -> slice:
        return slice(int(self.start[first]), int(self.start[last - 1] + self.sizes[last - 1]))


@lru_cache(maxsize=64)
def _places(sizes: tuple[int, ...]) -> tuple[np.ndarray, ...]:
    """Of features side by side: the bins that aren't missing, their features
    and numbers, where each feature begins among them, and the missing bins."""
    size = np.array(sizes)
    end = np.cumsum(size)
    feature = np.repeat(np.arange(size.size), size - 1)
    start = np.concatenate([[0], np.cumsum(size - 1)])[:-1]
    real = np.setdiff1d(np.arange(end[-1]), end - 1)
    return real, feature, np.arange(real.size) - start[feature], start, end - 1


def best_split(hist: np.ndarray, sizes: np.ndarray, spec: Spec, allowed: np.ndarray) -> np.ndarray:
    """The best split of a node from its histogram (targets + 2 rows; features
    side by side, the missing bin last in each).

    Gives gain, feature, cut, missing_left, number of missing rows, then (gradient sums, second
    derivatives, rows) of the whole node and of the left side.  Ties go to
    the first feature, then the lowest cut, then missing right.  The gain is 0 where no split is allowed."""
    k = hist.shape[0] - 2
    real, feature, place, start, last = _places(tuple(sizes.tolist()))
    total = hist[:, :sizes[0]].sum(axis=1)
    c = np.cumsum(hist[:, real], axis=1)
    before = np.concatenate([np.zeros((k + 2, 1)), c], axis=1)[:, start]
    left = c - before[:, feature]
    lost = hist[:, last]

    def gain(side: np.ndarray) -> np.ndarray:
        other = total[:, None] - side
        fits = (side[-1] >= spec.min_samples_leaf) & (other[-1] >= spec.min_samples_leaf) & (side[-2] >= 1e-3) & (other[-2] >= 1e-3)
        with np.errstate(divide="ignore", invalid="ignore"):
            g = (side[:k] ** 2).sum(axis=0) / (side[-2] + spec.l2) + (other[:k] ** 2).sum(axis=0) / (other[-2] + spec.l2)
        g -= (total[:k] ** 2).sum() / (total[-2] + spec.l2)
        return np.where(fits if allowed.all() else fits & allowed[feature], g, 0.0)

    both, missing_left = gain(left), False
    at = int(both.argmax())
    if lost[-1].any():
        right_way, left_way = both, np.where(lost[-1][feature] > 0, gain(left + lost[:, feature]), 0.0)
        both = np.maximum(right_way, left_way)
        at = int(both.argmax())
        missing_left = bool(left_way[at] > right_way[at])
    lost_at = lost[:, feature[at]]
    side = left[:, at] + (lost_at if missing_left else 0.0)
    # rounding of the sums alone is no gain
    found = both[at] if both[at] > 1e-10 * abs((total[:k] ** 2).sum() / max(total[-2] + spec.l2, 1e-300)) else 0.0
    return np.concatenate([[found, feature[at], place[at], float(missing_left), lost_at[-1]], total, side])


def _chunk_answers(ask: _Ask, layout: _Layout, bins: np.ndarray, flat: np.ndarray, y: np.ndarray, member: np.ndarray, seed: np.ndarray, raw: np.ndarray,
                   whole: bool = False) -> Iterator[tuple]:
    """(node, block, payload) of one chunk: histograms, sums or ranks; of a
    ``whole`` one splits in place of histograms."""
    spec = ask.spec
    y = y[list(spec.targets)]
    rows = ((member >> np.int64(spec.train_set)) & 1).astype(bool) & ~np.isnan(y).any(axis=0)
    weight = None
    if spec.bootstrap is not None:
        weight = _row_counts(seed, spec.bootstrap)
        rows &= weight > 0
    pick = np.flatnonzero(rows)
    y, bins = y[:, pick], bins[:, pick]
    weight = np.ones(pick.size) if weight is None else weight[pick]
    if ask.kind == "init":
        low = y.min() if pick.size else np.inf
        yield 0, 0, np.concatenate([[pick.size, weight.sum(), low], (y * weight).sum(axis=1)])
        return
    raw = _added(ask.pending, bins, raw[:, pick] if len(raw) else np.zeros(y.shape))
    node = ask.tree.leaves(bins) if ask.tree is not None else np.zeros(pick.size, np.int32)
    if ask.kind == "rank":
        rest = y[0] - raw[0]
        for n, (low, high, mode) in ask.ranges.items():
            x = rest[node == n]
            key = _keys(x)
            inside = (key >= low) & (key <= high)
            above = x[key > high]
            nxt = above.min() if above.size else np.inf
            if mode == EQUAL:
                yield n, mode, np.array([nxt, inside.sum()])
            elif mode == NARROW:
                width = (high - low) // NARROW_WAYS + 1
                # differences of keys can pass 63 bits: taken without sign
                steps = ((key[inside].astype(np.uint64) - np.uint64(low % 2**64)) // np.uint64(width)).astype(np.int64)
                yield n, mode, np.concatenate([[nxt], np.bincount(steps, minlength=NARROW_WAYS)])
            else:
                yield n, mode, np.concatenate([[nxt], np.sort(x[inside])])
        return
    g, h = _gradients(spec, raw, y)
    if spec.bootstrap is None and spec.loss in ("squared", "quantile"):
        stats = np.concatenate([g, np.ones((1, pick.size))])
    else:
        stats = np.concatenate([g * weight, (h * weight)[None], np.ones((1, pick.size))])
    if whole:
        yield from _levels(ask, layout, bins, flat, stats, pick, node)
        return
    for n in ask.nodes:
        own = np.flatnonzero(node == n)
        hist = layout.histogram(flat[:, pick[own]], stats[:, own])
        yield n, 0, hist[_counted(spec, len(hist))]


def _levels(ask: _Ask, layout: _Layout, bins: np.ndarray, flat: np.ndarray, stats: np.ndarray, pick: np.ndarray, node: np.ndarray) -> Iterator[tuple]:
    """Where a chunk has all rows, the splits of the nodes asked for and of
    their descendants, LEVELS levels in one pass: (node, path, best split), path being 1 for the
    node itself, 2p and 2p + 1 for the children of p.  The larger child's histogram is the
    parent's without its sibling's."""
    allowed = _allowed(ask.spec, 0, len(layout.sizes))
    for n in ask.nodes:
        own = np.flatnonzero(node == n)
        todo = [(1, own, layout.histogram(flat[:, pick[own]], stats[:, own]))]
        while todo:
            path, own, hist = todo.pop()
            full = hist[_counted(ask.spec, len(hist))]
            got = best_split(full, layout.sizes, ask.spec, allowed)
            yield n, path, got
            if got[0] <= 0 or path >= 1 << (LEVELS - 1):
                continue
            b = bins[int(got[1]), own]
            left = np.where(b == MISSING, bool(got[3]) if got[4] > 0 else False, b <= got[2])
            small, other = (own[left], own[~left]) if 2 * left.sum() <= own.size else (own[~left], own[left])
            first = layout.histogram(flat[:, pick[small]], stats[:, small])
            at = 2 * path + (0 if 2 * left.sum() <= own.size else 1)
            for p, rows, h in ((at, small, first), (at ^ 1, other, hist - first)):
                if rows.size >= 2 * ask.spec.min_samples_leaf:
                    todo.append((p, rows, h))


def _counted(spec: Spec, rows: int) -> slice | list[int]:
    """Histogram rows with counts once more where they are the second derivatives."""
    k = len(spec.targets)
    return [*range(k), k, k] if rows == k + 1 else slice(None)


def _allowed(spec: Spec, first: int, last: int) -> np.ndarray:
    return np.ones(last - first, bool) if spec.features is None else np.isin(np.arange(first, last), spec.features)


def _combined(kind: str, block: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if kind == "init":
        return np.concatenate([a[:2] + b[:2], [min(a[2], b[2])], a[3:] + b[3:]])
    if kind == "rank":
        rest = np.sort(np.concatenate([a[1:], b[1:]])) if block == VALUES else a[1:] + b[1:]
        return np.concatenate([[min(a[0], b[0])], rest])
    return a + b


def _answer(ask: _Ask, layout: _Layout, first: int, last: int, payload: np.ndarray) -> np.ndarray:
    """The best split of a feature block from its added histogram; other
    payloads as they are."""
    if ask.kind != "split":
        return payload
    out = best_split(payload, layout.sizes[first:last], ask.spec, _allowed(ask.spec, first, last))
    out[1] += first
    return out


# ----------------------------------------------------------------- packed rows

CHUNK = "rg long, mg long, n long, bins binary, y binary, member binary, seed binary, raw binary"
PARTS = "model long, node long, block long, payload binary"


def _fields(ddl: str) -> list[str]:
    return [x.split()[0] for x in ddl.split(", ")]


def _emit(ddl: str, rows: Sequence[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary() if x.endswith("binary") else pa.int64() for x in ddl.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], _fields(ddl))


def _by_model(asks: dict[int, list[_Ask]]) -> dict[int, _Ask]:
    return {a.model: a for own in asks.values() for a in own}


class Packed:
    """Binned rows in chunks.  ``members``: a bit mask of the training sets of each
    row (63 sets at most).  With fewer chunks than task slots each chunk is stored once for
    each of several groups of models, so that all slots have work."""

    def __init__(self, df: DataFrame, binning: Binning, targets: Sequence[str], members: Column, n_models: int, widths: Sequence[int],
                 chunk_rows: int | None = None, key: Sequence[str] | None = None):
        chunk_rows = chunk_rows or max(256, min(CHUNK_ROWS, CHUNK_BYTES // (8 * max(1, sum(widths)))))
        spark = df.sparkSession
        n_rows = df.count()
        self.n_chunks = max(1, -(-n_rows // chunk_rows))
        slots = spark.sparkContext.defaultParallelism
        self.groups = max(1, min(n_models, -(-slots // self.n_chunks)))
        widths = [sum(w for m, w in enumerate(widths) if m % self.groups == g) for g in range(self.groups)]
        ids = list(key or binning.columns)
        read = df.select(*[_number(c).alias(f"f{i}") for i, c in enumerate(binning.columns)],
                         *[_number(t).alias(f"t{i}") for i, t in enumerate(targets)],
                         members.cast("long").alias("member"), F.xxhash64(*[F.col(f"`{c}`") for c in ids]).alias("seed"))
        order = read.repartition(self.n_chunks, "seed") if self.n_chunks > 1 else read.coalesce(1)
        n_features, n_targets, groups = len(binning.columns), len(targets), self.groups

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, count = [], 0

            def chunk():
                bins, y, member, seed = (np.concatenate(x, axis=-1) for x in zip(*held))
                # rows go by their hash, so that a rerun packs and adds in one order
                order = np.lexsort((*y, seed))
                bins, y, member, seed = bins[:, order], y[:, order], member[order], seed[order]
                return [_emit(CHUNK, [(int(seed[0]), g, seed.size, np.ascontiguousarray(bins).tobytes(), np.ascontiguousarray(y).tobytes(), member.tobytes(),
                                       seed.tobytes(), np.zeros(widths[g] * seed.size).tobytes())]) for g in range(groups)]

            for b in batches:
                for at in range(0, b.num_rows, chunk_rows):
                    part = b.slice(at, chunk_rows)
                    got = (binning.apply(_matrix(part, 0, n_features)), _matrix(part, n_features, n_targets),
                           part.column(n_features + n_targets).to_numpy(zero_copy_only=False).astype(np.int64),
                           part.column(n_features + n_targets + 1).to_numpy(zero_copy_only=False).astype(np.int64))
                    if held and count + part.num_rows > chunk_rows:
                        yield from chunk()
                        held, count = [], 0
                    held.append(got)
                    count += part.num_rows
            if held:
                yield from chunk()

        packed = order.mapInArrow(pack, CHUNK)
        if self.groups > 1:
            packed = packed.repartitionByRange(self.n_chunks * self.groups, "rg", "mg")
        self.table = materialize(packed, "packed")
        self.whole = self.table.count() == self.groups
        self.layout = _Layout([c.size + 1 for c in binning.cuts])
        self.n_features, self.n_targets = n_features, n_targets


def _open(batches: Iterator[pa.RecordBatch], n_features: int, n_targets: int) -> Iterator[tuple]:
    for b in batches:
        for r in b.to_pylist():
            n = r["n"]
            yield (r, np.frombuffer(r["bins"], np.uint8).reshape(n_features, n), np.frombuffer(r["y"]).reshape(n_targets, n),
                   np.frombuffer(r["member"], np.int64), np.frombuffer(r["seed"], np.uint64), np.frombuffer(r["raw"]).reshape(-1, n))


# --------------------------------------------------------------------- driver

class _Growing:
    """The tree of one round: nodes with the best split known so far, and the queue that
    decides which of them are split."""

    def __init__(self, spec: Spec):
        self.spec = spec
        self.split: dict[int, np.ndarray | None] = {}  # None: can't be split
        self.children: dict[int, tuple[int, int]] = {}
        self.depth, self.stats = {0: 0}, {}

    def _children(self, n: int) -> tuple[int, int]:
        if n not in self.children:
            s, k = self.split[n], len(self.spec.targets)
            whole, left = s[5:5 + k + 2], s[5 + k + 2:]
            pair = (len(self.depth), len(self.depth) + 1)
            for c, stats in zip(pair, (left, whole - left)):
                self.depth[c], self.stats[c] = self.depth[n] + 1, stats
                if stats[-1] < 2 * self.spec.min_samples_leaf or self.depth[c] == self.spec.max_depth:
                    self.split[c] = None
            self.children[n] = pair
        return self.children[n]

    def plan(self) -> tuple[list[int], list[int]]:
        """(nodes split, leaves whose split must be known first).

        Takes leaves by gain; leaves not known yet count as unsplittable.  What
        is known later can only push nodes out of the list, so the list holds all
        that best-first growth splits, and equals it once nothing is open."""
        room = (self.spec.max_leaf_nodes or 1 << 60) - 1
        taken, open_, queue = [], [], []

        def offer(n: int) -> None:
            if n not in self.split:
                open_.append(n)
            elif self.split[n] is not None and self.split[n][0] > 0:
                heapq.heappush(queue, (-self.split[n][0], n))

        offer(0)
        while queue and len(taken) < room:
            _, n = heapq.heappop(queue)
            taken.append(n)
            for c in self._children(n):
                offer(c)
        return taken, open_ if room else []

    def tree(self, taken: list[int]) -> Tree:
        """Arrays by node number in which ``taken`` are split (nodes that no
        row reaches may be among them)."""
        size, k = len(self.depth), len(self.spec.targets)
        feature, cut, missing, left, right = [0] * size, [0] * size, [False] * size, [-1] * size, [-1] * size
        for n in taken:
            s = self.split[n]
            feature[n], cut[n] = int(s[1]), int(s[2])
            # without missing rows in training they go with the larger side
            missing[n] = bool(s[3]) if s[4] > 0 else bool(2 * s[-1] >= s[5 + k + 1])
            left[n], right[n] = self.children[n]
        return Tree(np.array(feature, np.int32), np.array(cut, np.int32), np.array(missing), np.array(left, np.int32), np.array(right, np.int32), np.zeros((size, k)))

    def final(self, taken: list[int]) -> tuple[Tree, list[int]]:
        """The tree with the nodes that rows reach only, and their numbers here."""
        order, inner = [0], set(taken)
        for n in order:
            if n in inner:
                order.extend(self.children[n])
        at, t = {n: i for i, n in enumerate(order)}, self.tree(taken)
        link = lambda x: np.array([at[int(v)] if v >= 0 else -1 for v in x[order]], np.int32)
        return Tree(t.feature[order], t.cut[order], t.missing_left[order], link(t.left), link(t.right), t.value[order]), order


@dataclass
class Booster:
    """A fitted model: raw value = base + all trees' leaf values."""
    spec: Spec
    base: np.ndarray
    trees: list[Tree] = field(default_factory=list)
    seconds: float = 0.0

    def predict(self, bins: np.ndarray) -> np.ndarray:
        """targets x rows."""
        raw = _added(_side_by_side(self.trees), bins, np.repeat(self.base[:, None], bins.shape[1], axis=1))
        return np.exp(raw) if self.spec.loss in LOG_LINK else raw


class _Model:
    """Where one model stands: baseline, split search, leaf ranks, done."""

    def __init__(self, index: int, spec: Spec, whole: bool):
        self.index, self.spec, self.whole = index, spec, whole
        self.k = len(spec.targets)
        self.out = Booster(spec, np.zeros(self.k))
        self.folded = -1  # trees (and the base) already in the chunks
        self.grow: _Growing | None = None
        self.ranks: dict[int, dict] = {}
        self.tree: Tree | None = None
        self.stage = "init"
        self._pending: tuple = (None, None)
        self._planned: tuple | None = None

    @property
    def boosting(self) -> bool:
        """In a round, with its base known, and with predictions to keep."""
        return self.spec.kept > 0 and (self.stage == "split" or (self.stage == "rank" and self.tree is not None))

    def pending(self) -> tuple[Tree, np.ndarray] | None:
        """What the chunks' predictions lack: trees, and at first the base as a leaf."""
        state = (self.folded, len(self.out.trees))
        if state != self._pending[0]:
            base = Tree(*[np.zeros(1, np.int32)] * 2, np.zeros(1, bool), *[np.full(1, -1, np.int32)] * 2, self.out.base[None])
            trees = ([base] if self.folded < 0 else []) + self.out.trees[max(0, self.folded):]
            self._pending = state, _side_by_side(trees) if trees else None
        return self._pending[1]

    def ask(self, room: int) -> _Ask | None:
        if self.stage == "init":
            return _Ask(self.index, "init", self.spec, None, None)
        if self.stage == "rank":
            base = self.tree is None
            return _Ask(self.index, "rank", self.spec, None if base else self.pending(), self.tree,
                        ranges={n: (r["low"], r["high"], EQUAL if r["low"] == r["high"] else NARROW if r["count"] > NARROW_TO else VALUES)
                                for n, r in self.ranks.items() if "value" not in r})
        if self.stage == "split" and room > 0:
            taken, open_ = self._planned or self.grow.plan()
            return _Ask(self.index, "split", self.spec, self.pending(), self.grow.tree(taken), open_[:room])
        return None

    def hear(self, node: int, block: int, payload: np.ndarray) -> None:
        if self.stage == "init":
            rows, weight, low = payload[:3]
            if not rows:
                raise ValueError("a training set has no row with all its targets")
            if (self.spec.loss == "gamma" and low <= 0) or (self.spec.loss == "poisson" and low < 0):
                raise ValueError(f"some labels are outside the domain of the {self.spec.loss} loss")
            mean = payload[3:] / weight
            if self.spec.loss in LOG_LINK and mean[0] <= 0:
                raise ValueError(f"the {self.spec.loss} loss needs a mean label above 0")
            if not self.spec.baseline:
                self._round()
            elif self.spec.loss == "quantile":
                self._rank({0: int(rows)})
            else:
                self.out.base = np.log(mean) if self.spec.loss in LOG_LINK else mean
                self._round()
        elif self.stage == "rank":
            r = self.ranks[node]
            if block == NARROW:
                width, upto = (r["high"] - r["low"]) // NARROW_WAYS + 1, np.cumsum(payload[1:])
                way = int(np.searchsorted(upto, r["rank"], side="right"))
                r["rank"] -= int(upto[way - 1]) if way else 0
                low = r["low"] + way * width
                r.update(low=low, high=min(low + width - 1, r["high"]), count=int(payload[1 + way]))
                return
            i = r["rank"]
            low, n = (_double(r["low"]), payload[1]) if block == EQUAL else (payload[1 + i], payload.size - 1)
            upper = payload[0] if i + 1 >= n else low if block == EQUAL else payload[2 + i]
            r["value"] = float(low + (r["part"] * (upper - low) if r["part"] else 0.0))
        else:
            if self.whole:  # block is the path from the node
                for side in bin(block)[3:]:
                    node = self.grow._children(node)[int(side)]
                self.grow.split.setdefault(node, payload)
                return
            have = self.grow.split.get(node)
            if have is None or payload[0] > have[0] or (payload[0] == have[0] and payload[1] < have[1]):
                self.grow.split[node] = payload

    def step(self) -> None:
        """After all answers of a pass."""
        if self.stage == "rank" and all("value" in r for r in self.ranks.values()):
            values = {n: r["value"] for n, r in self.ranks.items()}
            if self.tree is None:
                self.out.base = np.array([values[0]])
                self._round()
            else:
                self._finish({n: np.array([v]) for n, v in values.items()})
        elif self.stage == "split":
            k = self.k
            if 0 in self.grow.split and 0 not in self.grow.stats:
                self.grow.stats[0] = self.grow.split[0][5:5 + k + 2]
            taken, open_ = self._planned = self.grow.plan()
            if open_:
                return
            self._planned = None
            self.tree, order = self.grow.final(taken)
            leaves = {i: n for i, n in enumerate(order) if self.tree.left[i] < 0}
            if self.spec.loss == "quantile":
                self._rank({i: int(self.grow.stats[n][-1]) for i, n in leaves.items()})
            else:
                self._finish({i: -self.grow.stats[n][:k] / (self.grow.stats[n][-2] + self.spec.l2 + 1e-15) for i, n in leaves.items()})

    def _rank(self, counts: dict[int, int]) -> None:
        self.stage, self.ranks = "rank", {}
        for n, c in counts.items():
            at = (c - 1) * self.spec.quantile
            self.ranks[n] = {"low": -2**63, "high": 2**63 - 1, "count": c, "rank": int(at), "part": at - int(at)}

    def _round(self) -> None:
        self.tree = None
        if len(self.out.trees) >= self.spec.rounds:
            self.stage = "done"
        else:
            self.stage, self.grow = "split", _Growing(self.spec)

    def _finish(self, values: dict[int, np.ndarray]) -> None:
        for n, v in values.items():
            self.tree.value[n] = self.spec.learning_rate * v
        self.out.trees.append(self.tree)
        self._round()


def fit(df: DataFrame, binning: Binning, targets: Sequence[str], members: Column, specs: Sequence[Spec],
        chunk_rows: int | None = None, key: Sequence[str] | None = None, told: Callable[[int, Booster], None] | None = None) -> list[Booster]:
    """All models of ``specs`` in one run.  ``members``: a bit mask (long) of the
    training sets that a row belongs to; rows with a null target of a model are not used by it;
    null masks are no member.  Rows are told apart by ``key`` columns (for the bootstrap and the order of sums).
    ``told(index, booster)`` is called as models end."""
    spark = df.sparkSession
    widths = [s.kept for s in specs]
    packed = Packed(df, binning, targets, F.coalesce(members, F.lit(0)), len(specs), widths, chunk_rows, key)
    if not packed.table.limit(1).collect():
        raise ValueError("no rows to fit")
    models = [_Model(m, s, packed.whole) for m, s in enumerate(specs)]
    began = time.perf_counter()
    # rows of a chunk's predictions where each model's begin
    rows_of = {}
    for g in range(packed.groups):
        at = 0
        for m in range(g, len(specs), packed.groups):
            rows_of[m] = slice(at, at + widths[m])
            at += widths[m]
    state = packed.table.persist()
    layout, nf, nt, groups = packed.layout, packed.n_features, packed.n_targets, packed.groups
    blocks = layout.blocks()

    def answers(asks: dict[int, list[_Ask]]) -> DataFrame:
        plan = pickle.dumps(asks, pickle.HIGHEST_PROTOCOL)

        def add(batches: Iterator[pa.RecordBatch], asks: dict[int, list[_Ask]]) -> Iterator[tuple]:
            by_model, sums = _by_model(asks), {}
            for r, bins, y, member, seed, raw in _open(batches, nf, nt):
                own = asks.get(r["mg"], [])
                flat = layout.flat(bins) if any(a.kind == "split" for a in own) else bins
                for a in own:
                    for node, block, payload in _chunk_answers(a, layout, bins, flat, y, member, seed, raw[rows_of[a.model]]):
                        at = (a.model, node, block)
                        sums[at] = _combined(a.kind, block, sums[at], payload) if at in sums else payload
            for (m, node, block), payload in sums.items():
                if by_model[m].kind != "split":
                    yield m, node, block, payload
                else:
                    for k, (first, last) in enumerate(blocks):
                        yield m, node, k, payload[:, layout.part(first, last)]

        def best(by_model: dict[int, _Ask], m: int, node: int, block: int, payload: np.ndarray) -> tuple:
            a = by_model[m]
            if a.kind == "split":
                payload = _answer(a, layout, *blocks[block], payload.reshape(len(a.spec.targets) + 2, -1))
            return m, node, block, payload.tobytes()

        def together(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
            while held := list(islice(rows, 1000)):
                yield _emit(PARTS, held)

        def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            asks = pickle.loads(plan)

            def rows() -> Iterator[tuple]:
                for r, bins, y, member, seed, raw in _open(batches, nf, nt):
                    own = asks.get(r["mg"], [])
                    flat = layout.flat(bins) if any(a.kind == "split" for a in own) else bins
                    for a in own:
                        for node, block, payload in _chunk_answers(a, layout, bins, flat, y, member, seed, raw[rows_of[a.model]], True):
                            yield a.model, node, block, payload.tobytes()

            yield from together(rows())

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for m, node, block, payload in add(batches, pickle.loads(plan)):
                yield _emit(PARTS, [(m, node, block, np.ascontiguousarray(payload).tobytes())])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def rows() -> Iterator[tuple]:
                by_model, last, total = _by_model(pickle.loads(plan)), None, None
                for b in batches:
                    for r in b.to_pylist():
                        at, payload = (r["model"], r["node"], r["block"]), np.frombuffer(r["payload"])
                        if at == last:
                            total = _combined(by_model[at[0]].kind, at[2], total, payload)
                        else:
                            if last is not None:
                                yield best(by_model, *last, total)
                            last, total = at, payload
                if last is not None:
                    yield best(by_model, *last, total)

            yield from together(rows())

        if packed.whole:  # one chunk has all rows: its sums are whole
            return state.mapInArrow(alone, PARTS)
        keys = ["model", "node", "block"]
        return state.mapInArrow(partial, PARTS).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(added, PARTS)

    def folded() -> DataFrame:
        plan = {g: [(rows_of[m.index], m.pending()) for m in models[g::groups] if m.boosting] for g in range(groups)}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for r, bins, _, _, _, raw in _open(batches, nf, nt):
                raw = raw.copy()
                for rows, trees in plan[r["mg"]]:
                    raw[rows] = _added(trees, bins, raw[rows])
                yield _emit(CHUNK, [tuple({**r, "raw": raw.tobytes()}.values())])

        return materialize(state.mapInArrow(run, CHUNK), "packed")

    try:
        while any(m.stage != "done" for m in models):
            if max((len(m.out.trees) - m.folded for m in models if m.boosting), default=0) > FOLD_TREES:
                last, state = state, folded()
                last.unpersist()
                state.persist()
                release(last)
                for m in models:
                    if m.boosting:
                        m.folded = len(m.out.trees)
            asks: dict[int, list[_Ask]] = {}
            for g in range(groups):
                room = HISTOGRAM_BYTES
                for m in models[g::groups]:
                    bytes_ = 8 * layout.total * (m.k + 2)
                    a = m.ask(max(room // bytes_, 1 if room == HISTOGRAM_BYTES else 0)) if m.stage != "done" else None
                    if a:
                        asks.setdefault(g, []).append(a)
                        room -= bytes_ * len(a.nodes)
            # a path comes after those that lead to it
            for m, node, block, payload in sorted(map(tuple, answers(asks).collect()), key=lambda r: r[:3]):
                models[m].hear(node, block, np.frombuffer(payload))
            for a in (a for own in asks.values() for a in own):
                m = models[a.model]
                m.step()
                if m.stage == "done" and not m.out.seconds:
                    m.out.seconds = time.perf_counter() - began
                    if told:
                        told(m.index, m.out)
    finally:
        state.unpersist()
        release(state)
    return [m.out for m in models]


def predict(df: DataFrame, binning: Binning, ensembles: Sequence[Booster | Sequence[Booster]], keep: Sequence[str], out: str = "predictions") -> DataFrame:
    """``keep`` columns and an array of predictions in the order of the
    ensembles (of each one's targets, where it has several).  An ensemble is a model,
    or several whose mean is its prediction."""
    if out in keep:
        raise ValueError(f"{out} is the name of the result")
    n = len(binning.columns)
    groups = [[e] if isinstance(e, Booster) else list(e) for e in ensembles]
    read = df.select(*[_number(c).alias(f"__f{i}") for i, c in enumerate(binning.columns)], *[F.col(f"`{c}`") for c in keep])
    schema = df.select(*[F.col(f"`{c}`") for c in keep], F.array().cast("array<double>").alias(out)).schema
    width = sum(len(g[0].spec.targets) for g in groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                bins = binning.apply(_matrix(part, 0, n))
                got = np.concatenate([sum(x.predict(bins) for x in g) / len(g) for g in groups])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1) * width, pa.int32()), pa.array(got.T.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[n:], lists], [*part.schema.names[n:], out])

    return read.mapInArrow(run, schema)
