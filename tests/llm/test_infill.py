"""Fill-in-the-middle rows: brute force per text, round trip, edge cases."""

import hashlib
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tempora.llm import infill as I


def expected(doc_id, text, infill_percent=100, spm_percent=50):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    hexes = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexes[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(lines)
    a, b = sorted([h[0] % (n + 1), h[1] % (n + 1)])
    pre, mid, suf = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= infill_percent:
        return n, "plain", None, None, text
    if h[3] % 100 < spm_percent:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def run(rows, **options):
    hexes = [hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest() for i, _ in rows]
    h = [pa.array([int(x[8 * k:8 * k + 8], 16) for x in hexes], pa.int64()) for k in range(4)]
    got = I.infill_batch(pa.array([t or "" for _, t in rows], pa.string()), h, options.get("infill_percent", 100), options.get("spm_percent", 50))
    back = I.restore_batch(got[4], got[1]).to_pylist()
    return list(zip(*[x.to_pylist() for x in got])), back


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(-5, 10**12), st.text(alphabet="ab\n\r é😀<PSM>\x00", max_size=30)), min_size=1, max_size=20),
       st.sampled_from([0, 40, 100]), st.sampled_from([0, 50, 100]))
def test_batch_against_brute_force(rows, infill_percent, spm_percent):
    got, back = run(rows, infill_percent=infill_percent, spm_percent=spm_percent)
    assert got == [expected(i, t, infill_percent, spm_percent) for i, t in rows]
    assert back == [t for _, t in rows]


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(I, "SLICE_BYTES", 50)
    rows = [(1, None), (2, ""), (3, "\n"), (4, "one line"), (5, "a\nb\nc"), (5, "a\nb\nc"), (None, "x\ny\n"), (6, "has <P>\nmark"),
            (7, "\n\n\n\n"), (8, "word " * 50_000 + "\n" + "é\n" * 20_000), (9, "<S"), (10, "M>\n<")]
    docs = spark.createDataFrame([(i, t, 0, "z", 1) for i, t in rows], "doc_id long, text string, n long, output string, id int")
    got = I.restore(I.transform(docs)).collect()
    assert sorted(map(repr, ((r["id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in got))) == \
        sorted(map(repr, ((i, *expected(i, t)) for i, t in rows)))
    assert sorted((r["restored"] for r in got)) == sorted(t or "" for _, t in rows)
    assert I.transform(docs.limit(0)).count() == 0
    strings = docs.selectExpr("concat('doc ', doc_id) as doc_id", "text")
    assert I.restore(I.transform(strings)).count() == len(rows)
