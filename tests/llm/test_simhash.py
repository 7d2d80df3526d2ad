"""SimHash near-duplicates against brute force, and edge cases."""

import random

import numpy as np
import pytest
import xxhash

from tempora.llm import simhash as S
from tempora.llm.common import Scratch
from tempora.llm.components import connected_components


def force_fp(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def force_components(ids, fps, bits=3):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, name in enumerate(ids):
        if name is not None:
            least[root(i)] = min(least.get(root(i), name), name)
    return [least.get(root(i)) for i in range(len(ids))]


def test_fingerprint():
    for t in [None, "", " \n", "one", "One two", "a b c", "A b\tC d É", "x " * 500]:
        assert S.simhash64(t) == force_fp(t)
    assert S.simhash64("Some MORE words Here") == S.simhash64("some more\nwords here ")


@pytest.mark.parametrize("max_group", [8, 2048])
def test_links_of_dense_sets(spark, max_group):
    """Clusters far larger than a group, so that groups are dealt out anew."""
    rng = np.random.default_rng(2)
    fps = set()
    for _ in range(3):
        base = int(rng.integers(0, 2**63))
        fps.add(base)
        for _ in range(25):
            x = base
            for b in rng.choice(20, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b) * 3
            fps.add(x)
    fps = sorted(fps)
    df = spark.createDataFrame([(S.signed(x),) for x in fps], "fp long")
    scratch = Scratch(spark, "test")
    roots = {r["node"]: r["root"] for r in connected_components(S.links(df, scratch, 3, max_group), scratch).collect()}
    got = {}
    for x in fps:
        got.setdefault(roots.get(S.signed(x), S.signed(x)), set()).add(x)
    want = {}
    for x, c in zip(fps, force_components(fps, fps)):
        want.setdefault(c, set()).add(x)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_long_chain(spark):
    n = 60
    edges = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1000), (2000, 2001), (2001, 2000)], "a long, b long")
    out = {r["node"]: r["root"] for r in connected_components(edges, Scratch(spark, "test")).collect()}
    assert len({out[i] for i in range(n + 1)}) == 1 and out[2000] == out[2001] != out[0] and 1000 not in out


def make(spark):
    rng = random.Random(1)
    base = ["w%d" % rng.randint(0, 200) for _ in range(300)]
    texts = {}
    for i in range(30):
        w = list(base if i % 3 else ["v%d" % rng.randint(0, 900) for _ in range(120)])
        if i % 3 == 1:
            w[rng.randint(0, 299)] = "changed"
        texts[i] = " ".join(w)
    rows = [(i, t, 1) for i, t in texts.items()] + [(40, None, 1), (41, "", 2), (42, " \n", 2), (7, texts[7], 1), (None, texts[2], 1), (None, "only null id here", 5),
                                                    (None, "only null id here", 5), (50, "short one", 1), (51, "SHORT  one", 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, fp int")


def test_table(spark):
    rows, docs = make(spark)
    fps = [force_fp(t) for _, t, _ in rows]
    want = sorted(map(str, zip([r[0] for r in rows], [f"{f:016x}" for f in fps], force_components([r[0] for r in rows], fps))))
    out = S.near_duplicates(docs)
    assert out.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted(str(tuple(r)) for r in out.collect()) == want
    one = S.keep_one(docs)
    assert one.columns == docs.columns
    kept = one.collect()
    comps = force_components([r[0] for r in rows], fps)
    named = {c for c in comps if c is not None}
    assert sorted(r["doc_id"] for r in kept if r["doc_id"] is not None) == sorted(named)
    assert [r["text"] for r in kept if r["doc_id"] is None] == ["only null id here"]
    assert S.near_duplicates(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0
