"""Quality classifier: support vectors on naive Bayes features.

A text becomes the set of its hashed n-grams: one to three characters, and one to
three word shapes (case, length, last sign, whether the word repeats an earlier one of
the last two).  Each indicator is scaled by the ratio of its log counts in the two classes, rows
get unit length, and a linear hinge-loss model is fitted on them by dual coordinate descent.
A logistic curve on rows kept apart turns margins into scores.

The model is fitted on a bounded sample of labelled rows; scoring is one pass
over all texts, with two tables of BUCKETS numbers in each task."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import col, table

BUCKETS = 1 << 16
#: The bound of the training sample: about so many labelled rows a class, at most twice as many in all.
ROWS_PER_CLASS = 2500
#: Counts of an n-gram start at this; the hinge loss weighs so much against the margin.
ALPHA, C = 1.0, 1.0
EPOCHS = 30
#: Scores from here on are predicted 1.
CUT = 0.7
#: Characters that go through the arrays at once; words and n-grams over the seams are kept.
PIECE = 1 << 18
_SPACE = np.zeros(128, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def _kinds() -> np.ndarray:
    """Per code point below 2^16: 1 lower or other letter, 2 upper, 4 digit, 8 anything else."""
    return np.array([4 if c.isdigit() else 2 if c.isupper() else 1 if c.isalpha() else 8 for c in map(chr, range(1 << 16))], np.uint8)


_KIND = _kinds()


def _bucket(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX[2]
    return (h >> np.uint64(48)).astype(np.int64)


def _mark(seen: np.ndarray, items: np.ndarray, new: int, family: int) -> None:
    """n-grams of one to three items; the first len(items) - new were marked before."""
    h = items.astype(np.uint64) + np.uint64(family)
    old = items.size - new
    for n in range(1, 4):
        if n > 1:
            if items.size < n:
                return
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * _MIX[1] + items[n - 1:].astype(np.uint64) * _MIX[0]
        seen[_bucket((h[max(0, old - n + 1):] + np.uint64(n)) * _MIX[0])] = True


def _words(points: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shape and hash of each word; ``edge`` marks white space."""
    inside = ~edge
    step = np.diff(inside.astype(np.int8), prepend=0, append=0)
    at, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    if not at.size:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    kind = np.where(edge, 0, _KIND[np.minimum(points, (1 << 16) - 1)]).astype(np.uint8)
    mixed = np.bitwise_or.reduceat(kind, at)  # blanks add nothing
    place = (np.arange(points.size) - np.repeat(at, np.diff(np.append(at, points.size)), axis=0) if at[0] == 0 else
             np.concatenate([np.zeros(at[0], np.int64), np.arange(at[0], points.size) - np.repeat(at, np.diff(np.append(at, points.size)))]))
    word = np.where(edge, np.uint64(0), (points.astype(np.uint64) + np.uint64(1)) * (_MIX[1] * (place.astype(np.uint64) * np.uint64(2) + np.uint64(1)) ^ _MIX[2]))
    last = points[end - 1].astype(np.uint64)
    sign = np.where(_KIND[np.minimum(last, np.uint64((1 << 16) - 1)).astype(np.int64)] == 8, last, np.uint64(0))
    shape = (sign << np.uint64(16)) | (np.minimum(end - at, 15).astype(np.uint64) << np.uint64(4)) | mixed.astype(np.uint64)
    return shape, np.add.reduceat(word, at)


def buckets(text: str | None) -> np.ndarray:
    """The buckets (sorted) of a whole text's n-grams; null or empty: none.  A
    word of more than four PIECEs counts as several."""
    seen = np.zeros(BUCKETS, bool)
    tail, shapes, hashes, rest = np.zeros(0, np.uint32), np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    for at in range(0, len(text or ""), PIECE):
        points = np.frombuffer(text[at:at + PIECE].encode("utf-32-le", "surrogatepass"), "<u4")
        _mark(seen, np.concatenate([tail, points]), points.size, 0)
        tail = np.concatenate([tail, points])[-2:]
        points = np.concatenate([rest, points])  # begins with the word that the last piece cut
        edge = (points < 128) & _SPACE[np.minimum(points, 127)]
        cut = 0 if edge.all() else points.size
        if at + PIECE < len(text) and not edge[-1]:
            gone = np.flatnonzero(edge)
            cut = int(gone[-1]) + 1 if gone.size else 0
            if points.size - cut > 4 * PIECE:  # a word without end goes on as the next word
                cut = points.size
        rest = points[cut:] if not edge.all() else np.zeros(0, np.uint32)
        shape, word = _words(points[:cut], edge[:cut])
        if shape.size:
            known = hashes.size
            hashes = np.concatenate([hashes, word])
            same = np.zeros(hashes.size, np.uint64)
            same[1:] |= (hashes[1:] == hashes[:-1]).astype(np.uint64)
            same[2:] |= (hashes[2:] == hashes[:-2]).astype(np.uint64) << np.uint64(1)
            shapes = np.concatenate([shapes, (shape << np.uint64(2)) | same[known:]])
            _mark(seen, shapes, shape.size, 1 << 40)
            hashes, shapes = hashes[-2:], shapes[-2:]
    return np.flatnonzero(seen)


@dataclass
class Model:
    """``ratio``: log-count ratios; ``weight``: of the scaled features; the
    score is the logistic of ``slope`` * margin + ``shift``."""
    ratio: np.ndarray
    weight: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, at: np.ndarray) -> float:
        r = self.ratio[at]
        return float(r @ self.weight[at] / max(1e-12, float(np.sqrt(r @ r)))) + self.bias

    def score(self, at: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(at) + self.shift, -500, 500))))


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """log of (count of the n-gram + alpha, as a share) in class 1 against class 0."""
    counts = np.full((2, BUCKETS), float(alpha))
    for at, label in zip(rows, y):
        counts[int(label), at] += 1
    share = counts / counts.sum(axis=1, keepdims=True)
    return np.log(share[1] / share[0])


def dual_descent(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, dim: int, c: float = C, epochs: int = EPOCHS, seed: int = 3, tol: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """Minimises |w|^2 / 2 + c * sum of max(0, 1 - y w x) over rows (indices,
    values): one dual variable in [0, c] a row, each set to its own optimum in turn, in a new order each epoch,
    until no projected gradient exceeds ``tol``.  Gives w and the dual variables."""
    w, a = np.zeros(dim), np.zeros(len(x))
    norm = np.array([float(v @ v) for _, v in x])
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(x)):
            at, v = x[i]
            if norm[i] == 0:
                continue
            g = y[i] * float(w[at] @ v) - 1
            pg = min(g, 0.0) if a[i] == 0 else max(g, 0.0) if a[i] == c else g
            worst = max(worst, abs(pg))
            if pg:
                new = min(max(a[i] - g / norm[i], 0.0), c)
                w[at] += (new - a[i]) * y[i] * v
                a[i] = new
        if worst < tol:
            break
    return w, a


def _logistic(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the weighted logistic regression of labels on
    margins, by Newton steps on targets drawn in a little, as small samples need."""
    n1, n0 = float((label == 1).sum()), float((label == 0).sum())
    target = np.where(label == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    z = np.stack([margin, np.ones_like(margin)], axis=1)
    b = np.array([1.0, 0.0])

    def loss(b):
        t = z @ b
        return float(weight @ (np.logaddexp(0, t) - target * t)) + 1e-6 * float(b @ b)

    for _ in range(50):
        p = 1 / (1 + np.exp(-z @ b))
        grad = z.T @ (weight * (p - target)) + 2e-6 * b
        hess = (z * (weight * p * (1 - p))[:, None]).T @ z + 2e-6 * np.eye(2)
        step, size, now = np.linalg.solve(hess, grad), 1.0, loss(b)
        while size > 1e-6 and loss(b - size * step) > now:
            size /= 2
        b = b - size * step
        if np.abs(step).max() < 1e-8:
            break
    return float(b[0]), float(b[1])


def train(rows: list[np.ndarray], labels: list[int], class_sizes: dict[int, int] | None = None) -> Model:
    """``rows``: buckets of each text; ``class_sizes``: labelled rows of each
    class where ``rows`` is a sample.  Every fifth row is for the curve only.  Without rows of both classes
    every score is the share of class 1 (a half if there is no row)."""
    y = np.array(labels, int)
    sizes = {k: float((class_sizes or {}).get(k, (y == k).sum())) for k in (0, 1)}
    if len(set(labels)) < 2:
        share = (sizes[1] + 1) / (sizes[0] + sizes[1] + 2)
        return Model(np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0, float(np.log(share / (1 - share))))
    hold = np.zeros(y.size, bool)
    for k in (0, 1):
        own = np.flatnonzero(y == k)
        hold[own[4::5]] = True

    def model(pick: np.ndarray) -> Model:
        ratio = log_count_ratio([rows[i] for i in pick], y[pick])
        x = []
        for i in pick:
            v = ratio[rows[i]]
            x.append((np.append(rows[i], BUCKETS), np.append(v / max(1e-12, np.sqrt(v @ v)), 1.0)))
        w, _ = dual_descent(x, np.where(y[pick] == 1, 1.0, -1.0), BUCKETS + 1)
        return Model(ratio, w[:BUCKETS], float(w[BUCKETS]))

    # the curve comes from rows that the model did not see
    fitted = model(np.flatnonzero(~hold) if hold.any() else np.arange(y.size))
    check = np.flatnonzero(hold) if len(set(y[hold])) == 2 else np.arange(y.size)
    per = {k: sizes[k] / max(1.0, float((y[check] == k).sum())) for k in (0, 1)}
    weight = np.array([per[k] for k in y[check]])
    fitted.slope, fitted.shift = _logistic(np.array([fitted.margin(rows[i]) for i in check]), y[check], weight / weight.mean())
    return fitted


def fit(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", per_class: int = ROWS_PER_CLASS) -> Model:
    """A model from the labelled rows for which ``learn`` (of ``id``, the row's id as text)
    holds.  Null ids and labels other than 0 and 1 are left out, and so is an id with both labels;
    an id that is labelled more than once counts once, a repeated document each time.
    The sample is drawn by a hash of the id, so a rerun draws the same."""
    told = labels.select(col(id_col).cast("string").alias("id"), col(label_col).cast("int").alias("label")) \
        .where(learn & F.col("id").isNotNull() & F.col("label").isin(0, 1))
    told = told.groupBy("id").agg(F.min("label").alias("label"), F.max("label").alias("most")).where("label = most").drop("most")
    sizes = {r["label"]: r["n"] for r in told.groupBy("label").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id", F.lit(17)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    share = F.when(F.col("label") == 1, min(1.0, per_class / sizes.get(1, 1))).otherwise(min(1.0, per_class / sizes.get(0, 1)))
    sample = told.where(draw < share).orderBy(F.xxhash64("id", F.lit(17)), "id").limit(2 * per_class)
    rows = docs.select(col(id_col).cast("string").alias("id"), col(text_col).cast("string").alias("text")).join(F.broadcast(sample), "id")

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for name, text, label in zip(b["id"], b["text"], b["label"]):
                yield pd.DataFrame([{"id": name, "label": label, "at": buckets(text).astype("<u2").tobytes()}])

    got = rows.mapInPandas(features, "id string, label int, at binary").limit(4 * per_class).toLocalIterator()
    got = sorted((r["id"], r["label"], bytes(r["at"])) for r in got)
    return train([np.frombuffer(r[2], "<u2").astype(np.int64) for r in got], [r[1] for r in got], sizes)


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), cut: float = CUT) -> DataFrame:
    """``keep`` columns (as they are, whatever their names) and score, predicted.

    Null and empty texts have no n-gram and get the score of the bias; very long texts go
    through in pieces, with the same result.  Repeated rows get the same score; an empty table
    gives an empty one.  A kept column named like a result is an error."""
    taken = {c.lower() for c in keep} & {"score", "predicted"}
    if taken:
        raise ValueError(f"rename {sorted(taken)} first")
    held = [f"k{i}" for i in range(len(keep))]
    picked = docs.select(*[col(c).alias(h) for c, h in zip(keep, held)], col(text_col).cast("string").alias("t"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            score = [model.score(buckets(t)) for t in b.pop("t")]
            b["score"] = score
            b["predicted"] = [int(x >= cut) for x in score]
            yield b

    kinds = ", ".join(f"{c} {t}" for c, t in picked.drop("t").dtypes)
    return picked.mapInPandas(run, f"{kinds}, score double, predicted int") \
        .select(*[F.col(h).alias(c) for c, h in zip(keep, held)], "score", "predicted")


def op11_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, held_out, score, predicted.  A row is held
    out if crc32 of its doc_id as text has remainder 2 by 4; a null doc_id is
    neither learned from nor held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), F.crc32(F.col("id").cast("binary")) % 4 != 2)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    return predict(docs.withColumn("held_out", held), model, keep=("doc_id", "held_out"))
