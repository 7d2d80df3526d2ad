"""Conversation repair: brute force over all edit sequences, blocks, edge cases."""

import hashlib
import re
import zlib
from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from tempora.llm import repair as R
from tempora.llm.common import table
from tests_data import SF01

GOAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        bare = text.strip(" \t\n\x0b\x0c\r")
        out.append("b" if not bare else "d" if (role, text) in seen else "-" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def search(rows):
    """Every sequence of edits with at most two Inserts in a gap."""
    found = faults(rows)
    best = None
    gaps = [[]] + [["u"], ["a"]] + [["u", "a"], ["a", "u"]]
    edits = [[("D", None)] if f in "bd" else [("D", None), ("K", role), ("R", "user"), ("R", "assistant")] for (role, _), f in zip(rows, found)]
    for way in product(*edits):
        for ins in product(gaps, repeat=len(rows) + 1):
            audit, cost, out = "", 0, []
            for k in range(len(rows) + 1):
                for x in ins[k]:
                    audit, cost = audit + "I", cost + 5
                    out.append(({"u": "user", "a": "assistant"}[x], ""))
                if k < len(rows):
                    letter, role = way[k]
                    audit += letter
                    cost += {"D": 2, "K": 0, "R": 1}[letter] + (5 if found[k] == "t" and letter != "D" else 0)
                    if letter != "D":
                        out.append((role, rows[k][1]))
            if any(r == "" for r, _ in out) or not GOAL.fullmatch("".join(r[0] for r, _ in out)):
                continue
            if best is None or (cost, audit) < best[:2]:
                best = cost, audit, out
    return best


def slow(rows):
    """The same by a forward table of (cost, audit, rows), without integers."""
    found, at = faults(rows), {0: (0, "", ())}

    def step(table, s, cost, letter, role, text):
        c, a, out = table[s]
        t = R.STATE_OF.get(role[:1])
        if t is not None and (role[0] == R.NEXT_ROLE[s] or (role[0] == "s" and s == 0)):
            return t, (c + cost, a + letter, out + ((role, text),))
        return None

    def grow(table):
        for _ in range(3):
            for s in list(table):
                for role in ("user", "assistant"):
                    got = step(table, s, 5, "I", role, "")
                    if got and (got[0] not in table or got[1][:2] < table[got[0]][:2]):
                        table[got[0]] = got[1]

    for (role, text), f in zip(rows, found):
        grow(at)
        new = {}
        for s, (c, a, out) in at.items():
            ways = [(s, (c + 2, a + "D", out))]
            if f not in "bd":
                more = 5 * (f == "t")
                ways += [step(at, s, more, "K", role, text), step(at, s, 1 + more, "R", "user", text), step(at, s, 1 + more, "R", "assistant", text)]
            for w in ways:
                if w and (w[0] not in new or w[1][:2] < new[w[0]][:2]):
                    new[w[0]] = w[1]
        at = new
    grow(at)
    return min(at[s] for s in (0, 3) if s in at)


def fast(rows, cuts=()):
    found = faults(rows)
    codes = [(r[0] if r[:1] in ("s", "u", "a") and r else "o") + f for (r, _), f in zip(rows, found)]
    edges = [0, *sorted(cuts), len(rows)]
    cost, path = R.choose([R.matrix("".join(codes[a:b])) for a, b in zip(edges, edges[1:])])
    out = []
    for (state, letters), a, b in zip(path, edges, edges[1:]):
        out += R.applied(state, letters, rows[a:b])
    return cost, "".join(x[1] for x in path), tuple(out)


ROW = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), st.sampled_from(["", " ", "a.", "b", "c!", "d?  ", "e"]))


@settings(max_examples=60, deadline=None)
@given(st.lists(ROW, max_size=3))
def test_all_edits(rows):
    best = search(rows)
    assert fast(rows) == (best[0], best[1], tuple(best[2])) == slow(rows)


@settings(max_examples=300, deadline=None)
@given(st.lists(ROW, max_size=24), st.lists(st.integers(0, 24), max_size=4))
def test_blocks(rows, cuts):
    assert fast(rows, [c for c in cuts if c <= len(rows)]) == slow(rows)


def expected(convs):
    """convs: {id: rows (turn, role, text) without damage}"""
    out = []
    for conv, rows in convs.items():
        rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                      key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        said = [(r, x) for _, r, x in rows]
        f, turns = faults(said), [t for t, _, _ in rows if t is not None]
        cost, audit, kept = slow(said)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, f.count("b"), f.count("d"), f.count("t"),
                    sum(a[:1] + b[:1] not in ("su", "ua", "au") for (a, _), (b, _) in zip(said, said[1:])), cost, audit,
                    hashlib.sha256("\n".join(f"{r}:{x}" for r, x in kept).encode()).hexdigest()))
    return out


def same(got, convs):
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected(convs), key=key)


def test_table(spark):
    rows = [tuple(r) for r in table(spark, SF01, "conversations").select("conv_id", "turn", "role", "text").collect()]
    convs = {}
    for c, t, role, text in rows:
        own = convs.setdefault(c, [])
        role, text = " " if role is None else role, " " if text is None else text
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if d == 0:
            continue
        text = "" if d == 1 else re.sub("[.!?]", "", text) if d == 2 else text
        own += [(t, "user" if d == 4 else role, text)] * (2 if d == 3 else 1)
    same(R.op13_repair(spark, SF01).collect(), convs)


def test_edges(spark, monkeypatch):
    monkeypatch.setattr(R, "BLOCK_BITS", 1)
    convs = {
        "a": [(0, "user", "Hi."), (1, "assistant", "Yes."), (5, "user", "And?"), (9, "assistant", "No")],
        None: [(None, "user", None), (None, None, "x."), (3, "assistant", "y.")],
        "ties": [(1, "user", "q."), (1, "user", "q."), (1, "assistant", "a."), (1, "assistant", "a!"), (1, "", "z.")],
        "nulls": [(None, "user", "q."), (None, "user", "q."), (None, "assistant", "r.")],
        "long": [(t, "user" if t % 2 else "assistant", f"{t}" + " word." * (20_000 if t == 7 else t)) for t in range(-40, 60)],
        "copies": [(t, "user", "same.") for t in range(30)] + [(3, "assistant", "ok.")] * 40,
        "gone": [],
    }
    rows = [(c, t, r, x, 1, "k") for c, own in convs.items() for t, r, x in own]
    df = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, block int, kind string").repartition(5)
    ids = spark.createDataFrame([(c, "u") for c in convs] * 2, "conv_id string, role string")
    same(R.repair(df, ids).collect(), convs)
    same(R.repair(df).collect(), {c: x for c, x in convs.items() if x})
    assert R.repair(df.limit(0)).count() == 0
    none = R.repair(df.limit(0), ids).collect()
    assert len(none) == len(convs) and {r["audit"] for r in none} == {""} and {r["cost"] for r in none} == {0}
