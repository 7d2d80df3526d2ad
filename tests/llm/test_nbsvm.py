"""Quality classifier: the two halves of the method against direct computations, held-out accuracy, edge cases."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tempora.llm import nbsvm as N
from tempora.llm.common import table
from tests_data import SF01


def test_held_out(spark):
    out = N.op11_nbsvm(spark, SF01)
    got = out.join(table(spark, SF01, "labels"), "doc_id").where("held_out").select("quality", "score", "predicted").collect()
    score, label = np.array([r["score"] for r in got]), np.array([r["quality"] for r in got])
    pairs = score[label == 1][:, None] - score[label == 0][None, :]
    assert len(got) > 60 and ((pairs > 0) + 0.5 * (pairs == 0)).mean() > 0.93
    assert np.mean([r["predicted"] == r["quality"] for r in got]) > 0.9
    assert out.count() == 1000 and out.where("not score between 0 and 1 or predicted <> cast(score >= 0.7 as int)").count() == 0


def test_ratio():
    rows = [np.array([1, 2]), np.array([2]), np.array([2, 3])]
    r = N.log_count_ratio(rows, np.array([1, 1, 0]))
    total1, total0 = N.BUCKETS + 3, N.BUCKETS + 2
    assert np.allclose(r[[1, 2, 3, 4]], np.log([2 / total1 / (1 / total0), 3 / total1 / (2 / total0), 1 / total1 / (2 / total0), 1 / total1 / (1 / total0)]))


def test_dual_descent_is_optimal():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 5))
    y = np.where(x @ rng.normal(size=5) + 0.7 * rng.normal(size=60) > 0, 1.0, -1.0)
    w, a = N.dual_descent([(np.arange(5), v) for v in x], y, 5, c=0.5, epochs=5000, tol=1e-9)
    primal = 0.5 * w @ w + 0.5 * np.maximum(0, 1 - y * (x @ w)).sum()
    dual = a.sum() - 0.5 * w @ w
    assert np.allclose(w, (a * y) @ x) and (a >= 0).all() and (a <= 0.5).all()
    assert primal == pytest.approx(dual, abs=1e-5)  # no gap: the optimum


def slow(text):
    """n-grams one by one, as sets of tuples."""
    grams, shapes, words = set(), [], text.translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")
    words = [w for w in words if w]
    for n in (1, 2, 3):
        grams |= {(0, n, text[i:i + n]) for i in range(len(text) - n + 1)}
    for i, w in enumerate(words):
        kinds = frozenset(4 if c.isdigit() else 2 if c.isupper() else 1 if c.isalpha() else 8 for c in w)
        end = w[-1] if not (w[-1].isdigit() or w[-1].isalpha()) else ""
        shapes.append((kinds, min(len(w), 15), end, words[i - 1] == w if i else False, words[i - 2] == w if i > 1 else False))
    for n in (1, 2, 3):
        grams |= {(1, n, tuple(shapes[i:i + n])) for i in range(len(shapes) - n + 1)}
    return grams


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aA1 .é|\n\t😀Ω", max_size=60))
def test_sets(text):
    """As many buckets as n-grams (but for rare collisions), equal for equal sets."""
    n = len(slow(text))
    assert n - 2 <= N.buckets(text).size <= n


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aA1 .é|\n", max_size=200), st.integers(1, 30))
def test_pieces(text, piece):
    whole, kept = N.buckets(text), N.PIECE
    try:
        N.PIECE = piece
        longest = max(map(len, text.split()), default=0)
        parts = N.buckets(text)
    finally:
        N.PIECE = kept
    if longest <= piece:
        assert list(parts) == list(whole)


def test_edges(spark):
    good, bad = "the cat sat on the mat and slept. ", "BUY!! NOW!! $$$ &&& "
    rows = [(i, good * (i % 7 + 3)) for i in range(40)] + [(100 + i, bad * (i % 5 + 3)) for i in range(40)]
    rows += [(500, None), (501, ""), (502, " \n"), (503, "x"), (None, good), (504, good * 40_000), (505, "y" * 600_000), (0, good * 3)]
    docs = spark.createDataFrame([(i, t, 1.5, "k") for i, t in rows], "doc_id long, text string, score double, k0 string")
    labels = [(i, 1) for i in range(40)] + [(100 + i, 0) for i in range(40)] + [(3, 1), (4, 0), (101, None), (None, 1), (9999, 1), (500, 1)]
    told = spark.createDataFrame([(i, q, "z") for i, q in labels], "doc_id long, quality int, text string")
    model = N.fit(docs, told, F.lit(True))
    got = {}
    for r in N.predict(docs, model, keep=("doc_id", "k0")).collect():
        got.setdefault(r["doc_id"], []).append((r["score"], r["predicted"], r["k0"]))
    assert len(got) == len({i for i, _ in rows}) and len(set(got[0])) == 1 and len(got[0]) == 2
    assert all(got[i][0][1] == 1 for i in range(40)) and all(got[100 + i][0][1] == 0 for i in range(40))
    assert got[504][0][1] == 1 and got[None][0][1] == 1 and got[500] == got[501] and 0 <= got[505][0][0] <= 1
    assert N.predict(docs.limit(0), model).count() == 0
    with pytest.raises(ValueError):
        N.predict(docs, model, keep=("Score",))
    again = N.fit(docs.repartition(7), told.repartition(3), F.lit(True))
    assert np.array_equal(again.weight, model.weight)
    # one class or no label
    one = {r["score"] for r in N.predict(docs, N.fit(docs, told.where("quality = 1"), F.lit(True))).collect()}
    assert len(one) == 1 and one.pop() > 0.9
    none = N.predict(docs, N.fit(docs, told.limit(0), F.lit(True))).collect()
    assert {r["score"] for r in none} == {0.5}
