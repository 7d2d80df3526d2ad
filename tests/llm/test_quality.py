"""Quality rules against plain Python, and the cascade's order."""

import collections
import re

from pyspark.sql import functions as F

from tempora.llm import quality as Q

TEXTS = [None, "", " ", "a b c", "a b c a b c", "x y z " * 40, "one\none\n\n one\ntwo\none", "#a *b <c> | d & e " * 12,
         "\n".join(["same line of words here"] * 9), " ".join(f"w{i}" for i in range(80)), "BIG LETTERS " + " ".join(f"W{i}AB" for i in range(60)),
         "hey!! you!! " + " ".join(f"so{i}!!" for i in range(60)), "é ü\x0bñ\x0c中\r文 \x1f", "long" * 3000, "a a a a a", "a b a b a b c"]


def force(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {p for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


def test_counts_and_verdict(spark):
    docs = spark.createDataFrame([(i, t, 9) for i, t in enumerate(TEXTS)] + [(None, TEXTS[9], 9), (9, TEXTS[9], 9)],
                                 "doc_id long, text string, n_words int")
    out = Q.assess(docs).collect()
    assert len(out) == len(TEXTS) + 2
    for r in out:
        t = TEXTS[r["doc_id"]] if r["doc_id"] is not None else TEXTS[9]
        n, chars, symbols, dup, rep = force(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, rep)
        assert r["base_failed"] == (n < 50 or 100 * rep > 50 * n)
        assert r["kept"] == (r["rejected_by"] is None)
    by = {r["doc_id"]: r["rejected_by"] for r in out}
    assert by[9] is None and by[10] == "capitals" and by[11] == "exclamation" and by[5] == "base"
    kept = Q.filter_quality(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["9", "9", "None"]
    assert Q.assess(docs.limit(0)).count() == 0 and Q.filter_quality(docs.limit(0)).count() == 0


def test_order_and_short_circuit(spark):
    docs = spark.createDataFrame([(i, "word " * (i % 7)) for i in range(200)], "doc_id long, text string")
    never, often = Q.Rule("never", lambda t: F.length(t) < 0), Q.Rule("often", lambda t: F.length(t) > 5)
    ranked = Q.rank_rules(docs, [never, often])
    assert [r.name for r, _, _ in ranked] == ["often", "never"]
    assert abs(ranked[0][1] - 143 / 200) < 0.02 and ranked[1][1] == 0
    # a rule behind one that rejects everything is never evaluated
    boom = Q.Rule("boom", lambda t: F.raise_error(F.lit("evaluated")).cast("boolean"))
    everything = Q.Rule("all", lambda t: F.length(t) >= 0)
    assert docs.select(Q.rejected_by(F.col("text"), [everything, boom]).alias("by")).distinct().collect()[0]["by"] == "all"


def test_native(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = Q.assess(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
