"""Piece encoding: brute force, chunk independence and exact round trip."""

import random

import numpy as np
import public_tokenizers
import pytest

from tempora.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SOME = ["", " ", "a", "  two  spaces ", "Grüße, été — naïve 中文字符 \U0001f600\n\ttabs", "the theThe THE", "\x00\x7f", "a" * 70,
        "x" + "中文" * 40, "no" * 100 + " " + "yes " * 30]


@pytest.fixture(scope="module")
def model():
    return pieces.piece_model(MODEL)


def best_by_force(m, text):
    """Plain left-to-right search over the whole text."""
    text = m.prepare(text)
    best, last = [(0.0)] + [float("-inf")] * len(text), [0] * (len(text) + 1)
    for end in range(1, len(text) + 1):
        for start in range(max(0, end - m.longest), end):
            piece = text[start:end]
            if piece in m.table:
                s = best[start] + m.table[piece][0]
            elif end - start == 1:
                s = best[start] + m.unknown
            else:
                continue
            if s > best[end]:
                best[end], last[end] = s, start
    out, at = [], len(text)
    while at:
        piece = text[last[at]:at]
        out = ([m.table[piece][1]] if piece in m.table else [m.bytes[b] for b in piece.encode()]) + out
        at = last[at]
    return out


def random_texts(n, seed=3):
    rng = random.Random(seed)
    letters = ["a", "e", "th", "ing", "on", " ", "  ", "é", "ß", "\n", "中", "\U0001f600", "."]
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 200))) for _ in range(n)]


def test_words_against_force(model):
    for t in SOME + random_texts(60):
        ids = np.frombuffer(model.closed(model.prepare(t)), "<i4").tolist()
        assert ids == best_by_force(model, t)
        assert model.decode(ids).decode() == t


def test_words_together(model):
    """Words of one length in one lattice: ids and scores as one by one."""
    rng = random.Random(13)
    letters = ["a", "e", "t", "h", "i", "n", "g", "o", "s", "é", "ß", "\n", "\x00", "7", "中", "\U0001f600", "\ud800", "."]
    for n in (1, 2, 3, 7, 16, 17, 40):
        words = [pieces.MARK + "".join(rng.choice(letters) for _ in range(n - 1)) for _ in range(30)]
        ids, scores = model.fragments(words)
        assert ids == [model.fragment(w) for w in words]
        assert scores == [model.lattice(w, n, [0.0])[0][-1] for w in words]


def test_learned_words_in_a_small_table(model):
    texts = random_texts(40, 8) + ["one two three " * 5]
    want = [model.closed(model.prepare(t)) for t in texts]
    was, model.words = model.words, pieces.Recent(lambda w: model.fragment(pieces.MARK + w), 20)
    try:
        for i in range(0, len(texts), 9):
            part = [model.prepare(t) for t in texts[i:i + 9]]
            model.learn(part)
            assert [model.closed(t) for t in part] == want[i:i + 9]
    finally:
        model.words = was


@pytest.mark.parametrize("cuts", [True, False])
def test_matrices_against_force(model, cuts):
    """Matrix scan and traces of chunks, with and without word borders."""
    was, model.cuts = model.cuts, cuts
    try:
        for t in SOME + random_texts(20, 5):
            text, size, n = model.prepare(t), 24, model.longest
            if not text:
                continue
            count = max(1, len(text) // size)
            spans = [(c * size, len(text) if c == count - 1 else (c + 1) * size) for c in range(count)]
            parts = [(text[a:b + n - 1], b - a) for a, b in spans]
            entry, entries = np.array([0.0] + [float("-inf")] * (n - 1)), []
            mats = [model.matrix(*p) for p in parts]
            for mat in mats:
                entries.append(entry)
                entry = (entry[:, None] + mat).max(axis=0)
            if count > 2:
                left = pieces.times(pieces.times(mats[0], mats[1]), mats[2])
                right = pieces.times(mats[0], pieces.times(mats[1], mats[2]))
                assert np.array_equal(left, right)
            j, ids = 0, []
            for (p, stop), e in zip(reversed(parts), reversed(entries)):
                ids = np.frombuffer(model.trace(p, stop, e.tolist(), j), "<i4").tolist() + ids
                j = model.back_map(p, stop, e.tolist())[j]
            assert j == 0
            assert ids == best_by_force(model, t)
    finally:
        model.cuts = was


def test_crc_join():
    import zlib
    a, b = b"some bytes", b"and others" * 7
    assert pieces.crc_join(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert pieces.crc_join(zlib.crc32(a), 0, 0) == zlib.crc32(a)


def test_table(spark):
    texts = [None] + SOME + ["word " * 300, "中文" * 400, "word " * 300]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, "null id", "x"), (3, SOME[2], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    m = pieces.piece_model(MODEL)
    for chunk in (64, 100_000):
        encoded = pieces.encode(docs, MODEL, chunk=chunk).collect()
        got = {}
        for r in sorted(encoded, key=lambda r: r["c"]):
            got.setdefault((r["id"], r["uid"]), []).extend(r["ids"])
        want = sorted((str(i), best_by_force(m, t or "")) for i, t, _ in rows)
        assert sorted((str(k[0]), v) for k, v in got.items()) == want
    full = pieces.encode(docs, MODEL, chunk=64)
    back = {}
    for r in sorted(pieces.decode(full, MODEL).collect(), key=lambda r: r["c"]):
        back[r["id"], r["uid"]] = back.get((r["id"], r["uid"]), "") + r["text"]
    assert sorted((str(k[0]), v) for k, v in back.items()) == sorted((str(i), t or "") for i, t, _ in rows)
    import zlib
    out = pieces.digest(docs, MODEL, chunk=64).collect()
    want = {(i, len(best_by_force(m, t or "")), zlib.crc32((t or "").encode())) for i, t, _ in rows}
    assert {(r["doc_id"], r["n_pieces"], r["decoded_crc32"]) for r in out} == want and len(out) == len(rows)
    assert pieces.digest(docs.limit(0), MODEL).count() == 0
