"""Packed ids: exact round trip through the files."""

import zlib

import numpy as np
import public_tokenizers
import pytest

from tempora.llm import packed as K
from tempora.llm.common import Scratch

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["plain words here", None, "", " lead", "a  b\n c", "trail ", "<|endoftext|> x", "it's we'll", "中文 é\x1c x", "many words " * 9000, "\n\n\n", "tab\t tab"]


@pytest.mark.parametrize("width", [1, 5, 16, 17, 31, 32])
def test_pack(width):
    for n in (0, 1, 63, 64, 65, 1000):
        a = np.random.default_rng(n).integers(0, 2**width, n).astype("<u4")
        b = K.pack(a, width)
        assert len(b) == -(-n // 64) * width * 8
        assert np.array_equal(K.unpack(b, width, n), a)
        assert all(K.one_id(b, width, i) == a[i] for i in range(0, n, 13))
    assert K.width_of(50_257) == 16 and K.width_of(65_536) == 16 and K.width_of(65_537) == 17 and K.width_of(1) == 1


def test_encoder_equals_library():
    e = K.Encoder(PATH)
    assert e.by_word
    texts = [t or "" for t in TEXTS]
    for _ in range(2):
        assert e.encode(texts) == [np.array(e.tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_files(spark):
    rows = [(i * 3 % 11, t, "s") for i, t in enumerate(TEXTS)] + [(None, "null id", "s"), (3, "same id", "s"), (3, "same id", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string").repartition(4)
    path = Scratch(spark, "test-packed").path("ids")
    K.write_ids(docs, path, PATH, block_ids=64)
    out = K.checksums(spark, path).collect()
    e = K.Encoder(PATH)
    ids = lambda t: np.frombuffer(e.encode([t or ""])[0] + np.array([2], "<u4").tobytes(), "<u4")
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in out) == sorted((str(i), ids(t).size, zlib.crc32(ids(t).tobytes())) for i, t, _ in rows)
    order = sorted(out, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((r["doc_id"] for r in out), key=lambda i: (i is not None, i or 0))
    at = 0
    for r in order:
        assert r["start"] == at
        at += r["n_tokens"]
    whole = {(r["start"]): r["ids"] for r in K.read_documents(spark, path).collect()}
    assert all(zlib.crc32(np.array(whole[r["start"]], "<u4").tobytes()) == r["ids_crc32"] for r in out)
    empty = Scratch(spark, "test-packed").path("none")
    K.write_ids(docs.limit(0), empty, PATH)
    assert K.checksums(spark, empty).count() == 0
