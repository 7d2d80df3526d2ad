"""Language ID: averaged hashed subword embeddings and a linear softmax.

A text's letters (lower case; anything else is a word boundary) give hashed
character n-grams; their embeddings are averaged and go through one linear
layer.  Workers turn a bounded sample of labelled rows into n-gram counts, and the
driver trains on those by stochastic gradient descent in numpy.  As averaging is
linear, embeddings and layer fold into one table of n-gram scores, which is all
that a prediction needs.  A temperature is fitted on rows kept from
training, and the score below which predictions are wrong too often becomes
the rejection threshold."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import col, table

BUCKETS = 1 << 14
SIZES = (2, 3, 4)
DIM = 16
#: The bound of the training sample: about so many labelled rows a language,
#: and never more than twice as many in all.
ROWS_PER_LANGUAGE = 600
MAX_LANGUAGES = 1000
PIECE = 1 << 20
_LETTERS = np.array([chr(c).isalpha() for c in range(1 << 16)])


def _letters(points: np.ndarray) -> np.ndarray:
    low = _LETTERS[np.minimum(points, (1 << 16) - 1)]
    high = points >= 1 << 16
    if high.any():
        low[high] = [chr(c).isalpha() for c in points[high]]
    return low


def ngram_counts(text: str | None) -> np.ndarray | None:
    """Counts per bucket (float32) over the whole text; null or no letter: None.
    A text goes through in pieces, whose last characters are carried on, so that its counts don't depend on them."""
    if text is None:
        return None
    total = np.zeros(BUCKETS, np.int64)
    before = np.array([32], np.uint64)
    words = False

    def add(points: np.ndarray) -> np.ndarray:
        """n-grams that end in ``points``; the last characters go on."""
        whole = np.concatenate([before, points])
        h = whole * np.uint64(0x9E3779B97F4A7C15)
        for n in range(2, max(SIZES) + 1):
            if h.size < 2:
                break
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + whole[n - 1:]
            if n in SIZES:
                new = h[max(0, before.size - n + 1):]
                total[:] += np.bincount(((new * np.uint64(0x94D049BB133111EB)) >> np.uint64(50)).astype(np.int64), minlength=BUCKETS)
        return whole[1 - max(SIZES):]

    for at in range(0, len(text), PIECE):
        points = np.frombuffer(text[at:at + PIECE].lower().encode("utf-32-le", "surrogatepass"), "<u4")
        letter = _letters(points)
        words = words or bool(letter.any())
        points = np.where(letter, points, 32).astype(np.uint64)
        # one boundary for a run of others
        before = add(points[letter | np.concatenate([[before[-1] != 32], letter[:-1]])])
    if not words:
        return None
    if before[-1] != 32:
        add(np.array([32], np.uint64))
    return total.astype(np.float32)


@dataclass
class Model:
    """``scores``: per bucket and language; ``threshold``: scores below it are rejected."""
    languages: list[str]
    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0

    def predict(self, counts: np.ndarray | None) -> tuple[str, float]:
        if counts is None or not self.languages:
            return "und", 0.0
        z = (counts @ self.scores / max(float(counts.sum()), 1.0) + self.bias) / self.temperature
        p = np.exp(z - z.max())
        p /= p.sum()
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def train(x: list[np.ndarray], y: list[str], keep: list[bool], epochs: int = 12, rate: float = 8.0, batch: int = 32, seed: int = 5) -> Model:
    """``x``: counts, or (buckets, their counts); ``y``: labels; ``keep``: rows
    for calibration only.  Rows are held by the buckets they have."""
    x = [v if isinstance(v, tuple) else (np.flatnonzero(v), v[np.flatnonzero(v)]) for v in x]
    languages = sorted(set(y))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0, np.float32))
    target = np.array([languages.index(v) for v in y])
    hold = np.array(keep, bool)
    if hold.all() or len(set(target[~hold])) < len(languages):
        hold[:] = False
    rng = np.random.default_rng(seed)
    emb = rng.normal(0, 0.3, (BUCKETS, DIM)).astype(np.float32)
    layer, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    fit = np.flatnonzero(~hold)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        order = rng.permutation(fit)
        for at in range(0, order.size, batch):
            pick = order[at:at + batch]
            used = np.unique(np.concatenate([x[i][0] for i in pick]))
            f = np.zeros((pick.size, used.size), np.float32)
            for row, i in enumerate(pick):
                f[row, np.searchsorted(used, x[i][0])] = x[i][1] / x[i][1].sum()
            hidden = f @ emb[used]
            z = hidden @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(pick.size), target[pick]] -= 1
            p /= pick.size
            back = f.T @ (p @ layer.T)
            layer -= step * (hidden.T @ p)
            bias -= 0.1 * step * p.sum(axis=0)
            emb[used] -= step * np.minimum(BUCKETS, 50) * back
    model = Model(languages, emb @ layer, bias)
    check = np.flatnonzero(hold) if hold.any() else fit
    z = np.stack([x[i][1] @ model.scores[x[i][0]] / x[i][1].sum() + bias for i in check])
    best = (np.inf, 1.0)
    for t in np.geomspace(0.05, 20, 49):
        p = z / t - (z / t).max(axis=1, keepdims=True)
        loss = float(np.mean(np.log(np.exp(p).sum(axis=1)) - p[np.arange(check.size), target[check]]))
        best = min(best, (loss, float(t)))
    model.temperature = best[1]
    def guess(at: np.ndarray, n: np.ndarray) -> tuple[str, float]:
        counts = np.zeros(BUCKETS, np.float32)
        counts[at] = n
        return model.predict(counts)

    told = sorted((guess(*x[i])[::-1] + (y[i],) for i in check), reverse=True)
    right, least = 0, 1.0
    for n, (score, lang, truth) in enumerate(told, 1):
        right += lang == truth
        if right >= 0.99 * n:
            least = score
    model.threshold = least
    return model


def fit(rows: DataFrame, id_col: str, text_col: str, lang_col: str, learn: Column, per_language: int = ROWS_PER_LANGUAGE) -> Model:
    """A model from the rows where ``learn`` holds and the language and the
    text are not null: a sample by hash, bounded by ``per_language``."""
    known = rows.where(learn & col(lang_col).isNotNull() & col(text_col).isNotNull()) \
        .select(col(id_col).cast("string").alias("id"), col(text_col).alias("text"), col(lang_col).cast("string").alias("lang"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return train([], [], [])
    share = F.create_map(*[c for r in counts for c in (F.lit(r["lang"]), F.lit(min(1.0, per_language / r["n"])))])
    draw = F.pmod(F.xxhash64(F.coalesce("id", F.lit("")), F.lit(11)), F.lit(1_000_003)) / F.lit(1_000_003.0)
    sample = known.where(draw < share[F.col("lang")]).limit(2 * per_language * len(counts))

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for text, lang, name in zip(b["text"], b["lang"], b["id"]):
                c = ngram_counts(text)
                if c is not None:
                    at = np.flatnonzero(c)
                    yield pd.DataFrame([{"id": name, "lang": lang, "at": at.astype("<u2").tobytes(), "n": c[at].astype("<f4").tobytes()}])

    got = sorted(sample.mapInPandas(features, "id string, lang string, at binary, n binary").collect(), key=lambda r: (r["id"] or "", r["lang"], bytes(r["at"])))
    x = [(np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["n"], "<f4")) for r in got]
    return train(x, [r["lang"] for r in got], [i % 5 == 0 for i in range(len(got))])


def predict(rows: DataFrame, text_col: str, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and lang_pred, score, rejected.  Null text or no
    letter: ``und`` with score 0, rejected; so is everything if nothing could be learned.  Very long
    texts count whole; repeated rows get the same; an empty table gives an empty one.  A kept column named
    like a result is an error."""
    taken = {c.lower() for c in keep} & {"lang_pred", "score", "rejected"}
    if taken:
        raise ValueError(f"rename {sorted(taken)} first")
    held = [f"k{i}" for i in range(len(keep))]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            told = [model.predict(ngram_counts(t)) for t in b.pop("t")]
            b["lang_pred"], b["score"] = [t[0] for t in told], [t[1] for t in told]
            b["rejected"] = (b["lang_pred"] == "und") | (b["score"] < model.threshold)
            yield b

    picked = rows.select(*[col(c).alias(h) for c, h in zip(keep, held)], col(text_col).cast("string").alias("t"))
    kinds = ", ".join(f"{c} {t}" for c, t in picked.drop("t").dtypes)
    return picked.mapInPandas(run, f"{kinds}, lang_pred string, score double, rejected boolean") \
        .select(*[F.col(h).alias(c) for c, h in zip(keep, held)], "lang_pred", "score", "rejected")


def op6_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, held_out, lang_pred, score, rejected.  A row
    is held out if crc32 of its doc_id as text has remainder 2 by 4; a null
    doc_id is neither learned from nor held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    rest = F.crc32(F.col("doc_id").cast("string")) % 4
    model = fit(docs, "doc_id", "text", "lang", rest != 2)
    return predict(docs.withColumn("held_out", F.coalesce(rest == 2, F.lit(False))), "text", model, ["doc_id", "held_out"])
