"""Chat formatting: folding of streams, exact round trip, edge cases."""

import hashlib
import random

from tempora.llm import chat as C


def test_fold(spark):
    e = [("k", 1, "message", None, "system", "be nice"),
         ("k", 2, "start", 10, "user", None), ("k", 4, "delta", 10, None, "lo"), ("k", 3, "delta", 10, None, "hel"),
         ("k", 5, "start", 11, "assistant", None), ("k", 6, "delta", 11, None, "bad"), ("k", 7, "regenerate", 11, None, "ignored"),
         ("k", 8, "delta", 11, None, "good"), ("k", 9, "delta", 11, None, " one"), ("k", 10, "edit", 10, None, "hello"), ("k", 11, "delta", 10, None, "!"),
         ("k", 12, "start", 12, "user", "gone"), ("k", 13, "delete", 12, None, None), (None, 1, "message", None, None, None),
         ("k", 1, "message", None, "system", "be nice"), ("z", 1, "delta", 1, None, "no start")]
    out = C.fold(spark.createDataFrame(e, "conv_id string, seq long, kind string, message_id long, role string, text string"))
    got = sorted(map(str, (tuple(r) for r in out.collect())))
    assert got == sorted(map(str, [("k", 1, "system", "be nice"), ("k", 1, "system", "be nice"), ("k", 2, "user", "hello!"),
                                   ("k", 5, "assistant", "good one"), (None, 1, "", ""), ("z", 1, "", "no start")]))


def test_round_trip(spark):
    rng = random.Random(2)
    bits = ["<|", "|>", "\\", "<", "|", "<|im_end|>\n", "<|im_start|>assistant\n", "\n", "é", "\\|", "\\\\", "n", "中", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "a\nb\\n", "<|x|>"]), "".join(rng.choice(bits) for _ in range(rng.randint(0, 9))))
            for c in range(40) for t in range(rng.randint(1, 6))]
    m = spark.createDataFrame(rows, "conv_id long, position long, role string, text string")
    out = C.render(m)
    for r in C.parse(out).collect():
        want = sorted(x[1:] for x in rows if x[0] == r["conv_id"])
        assert [(t["role"], t["text"]) for t in r["turns"]] == [x[1:] for x in want]
        assert [t["loss_text"] for t in r["turns"]] == [x[2] if x[1] == "assistant" else None for x in want]
    for r in out.collect():
        assert sum(x["chars"] for x in r["mask"]) == len(r["formatted"])


def test_digest_and_edges(spark):
    rows = [(1, 0, "user", None, 3), (1, 1, "assistant", "yes", 3), (1, 1, "assistant", "yes", 3), (2, 0, None, "x", 3), (None, None, "user", "y", 3),
            (3, 0, "assistant", "z" * 200_000, 3)]
    t = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int")
    got = {r["conv_id"]: r for r in C.digest(C.render(C.fold(C.conversation_events(t)))).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert got[1]["n_turns"] == 3 and got[1]["loss_chars"] == 6 and got[1]["loss_sha256"] == sha("yesyes")
    assert got[1]["turns_sha256"] == sha("user\n\nassistant\nyes\nassistant\nyes\n")
    assert got[2]["turns_sha256"] == sha("\nx\n") and got[None]["loss_sha256"] == sha("") and got[3]["loss_chars"] == 200_000
    empty = C.digest(C.render(C.fold(C.conversation_events(t.limit(0)))))
    assert empty.count() == 0
    plan = empty._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
