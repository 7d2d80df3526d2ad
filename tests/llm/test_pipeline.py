"""The corpus pipeline on a small fixture with planted cases, stage by stage."""

import random

import corpus_pipeline
from tempora.llm import pieces
from tempora.llm.common import table
import public_tokenizers

RNG = random.Random(9)


def prose(n):
    return ["".join(RNG.choice("abcdefghijklmnoprstuw") for _ in range(RNG.randint(2, 8))) for _ in range(n)]


def fixture():
    docs, passage = {}, prose(70)
    for i in range(40):
        docs[i] = " ".join(prose(RNG.randint(60, 200)))
    docs[50] = docs[3]  # exact copy
    docs[51] = " ".join(docs[4].split() + ["extra"])  # may be a near copy
    docs[52] = " ".join(prose(60) + passage + prose(30))
    docs[53] = " ".join(prose(80) + passage + prose(60))
    docs[54] = " ".join(w + "###" for w in prose(90))
    docs[55] = "too short"
    docs[56] = None
    docs[57] = "line of words again\n" * 40
    return docs, passage


def test_run(spark, tmp_path):
    docs, passage = fixture()
    rows = [(i, t, "en", f"src{i % 4}" if i % 7 else None, len(t or ""), 1) for i, t in docs.items()]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, size int").write.parquet(path)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    at, columns = table(spark, str(tmp_path), "documents"), None
    columns = at.columns
    seen = []
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, at, str(tmp_path))
        out.write.parquet(str(tmp_path / f"s{n}"))
        at = spark.read.parquet(str(tmp_path / f"s{n}"))
        seen.append(at.collect())
        assert n == 4 or at.columns == columns
    ids = [sorted(r["doc_id"] for r in s) for s in seen]
    assert ids[0] == sorted(set(docs) - {54, 55, 56, 57})
    assert 50 not in ids[1] and 3 in ids[1] and set(ids[0]) - set(ids[1]) <= {50, 51}
    left = {r["doc_id"]: r for r in seen[2]}
    assert " ".join(passage) in left[52]["text"] and " ".join(passage) not in left[53]["text"]
    assert left[53]["n_chars"] == len(left[53]["text"]) and all(left[i]["text"] == docs[i] for i in range(40) if i in left)
    assert set(ids[3]) <= set(ids[2]) and max(ids[3].count(i) for i in set(ids[3])) <= 3
    m = pieces.piece_model(public_tokenizers.path("piece_bpe_32k.model"))
    assert sorted((r["doc_id"], m.decode(r["ids"]).decode()) for r in seen[4]) == sorted((r["doc_id"], r["text"]) for r in seen[3])
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(str, final)) == sorted(map(str, seen[4]))


def test_empty(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
