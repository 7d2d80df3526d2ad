"""Language ID: held-out accuracy and edge cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.llm import langid as L
from tempora.llm.common import table
from tests_data import SF01


def test_held_out(spark):
    out = L.op6_langid(spark, SF01)
    truth = table(spark, SF01, "documents").select("doc_id", "lang")
    r = out.join(truth, "doc_id").where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("a"),
                                                        F.count("*").alias("n")).first()
    assert r["n"] > 150 and r["a"] >= 0.98
    assert out.where("score < 0 or score > 1 or lang_pred is null").count() == 0
    assert out.count() == truth.count()


def test_edges(spark):
    model = L.train([L.ngram_counts(t) for t in ["the and of", "der die und"] * 20], ["en", "de"] * 20, [i % 5 == 0 for i in range(40)])
    rows = [(1, "the of and"), (2, "die und der"), (3, None), (4, ""), (5, "123 !?"), (6, "x"), (None, "the " * 200_000), (1, "the of and")]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id long, text string, score double")
    got = {r["doc_id"]: r for r in L.predict(docs, "text", model, ["doc_id"]).collect()}
    assert got[1]["lang_pred"] == "en" and got[2]["lang_pred"] == "de" and got[None]["lang_pred"] == "en"
    for i in (3, 4, 5):
        assert got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"]
    assert got[6]["lang_pred"] in ("en", "de")
    assert L.predict(docs, "text", model, ["doc_id"]).count() == len(rows) and L.predict(docs.limit(0), "text", model, ["doc_id"]).count() == 0
    # nothing to learn from
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    nothing = L.fit(bare, "doc_id", "text", "lang", F.lit(True))
    assert {r["lang_pred"] for r in L.predict(docs, "text", nothing, ["doc_id"]).collect()} == {"und"}


def test_counts_of_pieces(monkeypatch):
    text = "ab, cd  ef\n" * 500 + "É x"
    whole = L.ngram_counts(text)
    for piece in (1, 2, 3, 7, 600):
        monkeypatch.setattr(L, "PIECE", piece)
        assert (L.ngram_counts(text) == whole).all()


def test_many_languages_are_held_sparsely():
    """200 languages with 60 rows each: dense rows would take 786 MB."""
    import tracemalloc
    x = [(np.array([5 * k, 5 * k + 1, 9000 + i], np.int64), np.array([2, 1, 1], np.float32)) for k in range(200) for i in range(60)]
    tracemalloc.start()
    model = L.train(x, [f"l{k:03}" for k in range(200) for _ in range(60)], [i % 5 == 0 for i in range(12_000)], epochs=2)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20 and len(model.languages) == 200
    tracemalloc.stop()


def test_clashing_names(spark):
    model = L.train([L.ngram_counts("the of")] * 4, ["en"] * 4, [False] * 4)
    docs = spark.createDataFrame([(1, "the", "x")], "doc_id long, text string, `t` string")
    assert L.predict(docs, "text", model, ["t", "doc_id"]).columns == ["t", "doc_id", "lang_pred", "score", "rejected"]
    with pytest.raises(ValueError):
        L.predict(docs.withColumnRenamed("t", "score"), "text", model, ["score"])
