"""Conversation structure repair by integer shortest paths.

A conversation's rows form a DAG: node (row, state of the role sequence), edges Keep, Rerole,
Delete and Insert.  A path's weight is one big integer: its high part is the
cost, its low part the audit letters, one fixed-width digit for each, the
first letter in the highest place and zeros after the last.  Smaller integers
are then cheaper paths or, at one cost, paths with the ASCII-least audit, so an ordinary
integer minimum decides everything.

Spark does the rest on rows without texts: faults, counted copies and turn
blocks.  Each block of turns gives a matrix of least weights from state to
state, blocks of a conversation are combined backwards, and the letters go back to
the rows, which are hashed in one sorted pass.  So no step holds a conversation's
texts; its letters (those of its blocks' matrices, 16 at most for each row) are together once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tempora.llm.common import SPACE_CHARS, col, table

#: A block has the turns that are equal but for so many low bits.
BLOCK_BITS = 9
#: Letters as digits of three bits, in ASCII order; 0 is the padding.
LETTERS = "\0DIKR"
BITS = 3
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
TRUNCATED = 5
#: States of the role sequence: nothing yet, after s, after u, after a.
START, S, U, A = range(4)
ACCEPTED = (START, A)
NEXT_ROLE = {START: "u", S: "u", U: "a", A: "u"}
ROLE_NAMES = {"u": "user", "a": "assistant"}
STATE_OF = {"u": U, "a": A, "s": S}


def fits(state: int, role: str) -> bool:
    return NEXT_ROLE[state] == role or (role == "s" and state == START)


class Weights:
    """Integers of ``places`` letters: the cost above, letters below."""

    def __init__(self, places: int):
        self.shift = BITS * places
        self.mask = (1 << self.shift) - 1

    def edge(self, cost: int, letter: int, rest: int) -> int:
        """The path that begins with this edge and goes on with ``rest``."""
        return ((cost + (rest >> self.shift)) << self.shift) | (letter << (self.shift - BITS)) | ((rest & self.mask) >> BITS)

    def prepend(self, cost: int, letters: str, rest: int) -> int:
        """The same for all edges of a block at once."""
        head = 0
        for c in letters:
            head = head << BITS | LETTERS.index(c)
        at = BITS * len(letters)
        return ((cost + (rest >> self.shift)) << self.shift) | (head << (self.shift - at)) | ((rest & self.mask) >> at)

    def read(self, weight: int) -> tuple[int, str]:
        digits, out = weight & self.mask, []
        place = self.shift - BITS
        while place >= 0 and (d := digits >> place & 7):
            out.append(LETTERS[d])
            place -= BITS
        return weight >> self.shift, "".join(out)


def _least(options: Iterable[int | None]) -> int | None:
    return min((x for x in options if x is not None), default=None)


def _inserted(w: Weights, after: list[int | None]) -> list[int | None]:
    """The best of going on from each state with no, one or two Inserts; a
    third would only come back to a state at a cost."""
    nxt = [STATE_OF[NEXT_ROLE[s]] for s in range(4)]
    one = [None if after[t] is None else w.edge(COST[INSERT], INSERT, after[t]) for t in nxt]
    two = [None if one[t] is None else w.edge(COST[INSERT], INSERT, one[t]) for t in nxt]
    return [_least(x) for x in zip(after, one, two)]


def _row(w: Weights, role: str, fault: str, after: list[int | None]) -> list[int | None]:
    """Weights before a row from those after it."""
    out = []
    more = TRUNCATED if fault == "t" else 0
    for s in range(4):
        options = [None if after[s] is None else w.edge(COST[DELETE], DELETE, after[s])]
        if fault not in "bd":
            if fits(s, role) and after[STATE_OF[role]] is not None:
                options.append(w.edge(COST[KEEP] + more, KEEP, after[STATE_OF[role]]))
            t = STATE_OF[NEXT_ROLE[s]]
            if after[t] is not None:
                options.append(w.edge(COST[REROLE] + more, REROLE, after[t]))
        out.append(_least(options))
    return out


@lru_cache(maxsize=4096)
def _matrix(rows: str) -> tuple:
    """Least (cost, audit) from each state to each through rows, given as two
    characters a row: role (s, u, a, or o for any other) and fault (b, d, t or -).  None: no way."""
    n = len(rows) // 2
    w = Weights(3 * n + 2)
    out = []
    for end in range(4):
        weights = [0 if s == end else None for s in range(4)]
        for k in range(n - 1, -1, -1):
            weights = _row(w, rows[2 * k], rows[2 * k + 1], _inserted(w, weights))
        out.append([None if x is None else w.read(x) for x in _inserted(w, weights)])
    return tuple(tuple(out[t][s] for t in range(4)) for s in range(4))


def matrix(rows: str) -> tuple:
    return _matrix(rows) if len(rows) <= 64 else _matrix.__wrapped__(rows)


def choose(blocks: list[tuple]) -> tuple[int, list[tuple[int, str]]]:
    """Cost, and (state before, audit) of each block, of the least path from
    START to an accepted state."""
    w = Weights(sum(max((len(e[1]) for row in m for e in row if e), default=0) for m in blocks) + 1)
    weights: list[int | None] = [0 if s in ACCEPTED else None for s in range(4)]
    steps: list[list[int]] = []
    for m in reversed(blocks):
        best, to = [], []
        for s in range(4):
            ways = [(w.prepend(*m[s][t], weights[t]), t) for t in range(4) if m[s][t] and weights[t] is not None]
            least = min(ways, default=(None, 0))
            best.append(least[0])
            to.append(least[1])
        weights = best
        steps.append(to)
    cost = weights[START] >> w.shift
    state, out = START, []
    for m, to in zip(blocks, reversed(steps)):
        out.append((state, m[state][to[state]][1]))
        state = to[state]
    return cost, out


# ------------------------------------------------------------------- on Spark

def _flags(text: Column) -> Column:
    """b: no character but white space; t: the last other one doesn't end a sentence."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", "b").when(F.substring(bare, -1, 1).isin(".", "!", "?"), "-").otherwise("t")


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows of sorted batches by their first ``keys`` columns."""

    def rows():
        for b in batches:
            for at in range(0, b.num_rows, 256):
                yield from zip(*[c.to_pylist() for c in b.slice(at, 256).columns])

    yield from groupby(rows(), key=lambda r: r[:keys])


def _mapped(df: DataFrame, ddl: str, run, size: int = 256) -> DataFrame:
    """``run`` turns batches into rows of ``ddl``, which leave by ``size``."""
    schema = df.sparkSession.createDataFrame([], ddl).schema
    arrow = to_arrow_schema(schema)

    def batches(own: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = run(own)
        while held := list(islice(made, size)):
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*held), arrow)], schema=arrow)

    return df.mapInArrow(batches, schema)


def legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A row for each block: turns (distinct, least, greatest), faults, illegal
    pairs, first and last initial, and its matrix."""
    for (conv, block), rows in _grouped(batches, 2):
        codes, turns, low, high, illegal, first, last = [], 0, None, None, 0, None, None
        for _, _, turn, initial, fault, copies in rows:
            if turn is not None and turn != high:  # sorted by turn
                turns, low, high = turns + 1, turn if low is None else low, turn
            kind = initial if initial and initial in "sua" else "o"
            # copies after the first are duplicates, or blank like it
            codes.append(kind + fault + (kind + ("b" if fault == "b" else "d")) * (copies - 1))
            illegal += (copies - 1) * (not legal(initial + initial)) + (last is not None and not legal(last + initial))
            first, last = initial if first is None else first, initial
        text = "".join(codes)
        flat = [e for row in matrix(text) for e in row]
        yield (conv, block, turns, low, high, *[text[1::2].count(x) for x in "bdt"], illegal, first, last,
               [e and e[0] for e in flat], [e and e[1] for e in flat])


def _choices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """A row for each block: state before it, its letters, and its share of the counts
    (what belongs to the conversation as a whole goes to the first block)."""
    for (conv,), rows in _grouped(batches, 1):
        rows = list(rows)
        cost, path = choose([tuple(tuple(None if c is None else (c, a) for c, a in zip(r[11][4 * s:4 * s + 4], r[12][4 * s:4 * s + 4]))
                                   for s in range(4)) for r in rows])
        spans = [r for r in rows if r[3] is not None]
        gaps = spans[-1][4] - spans[0][3] + 1 - sum(r[2] for r in spans) if spans else 0
        whole = (gaps, cost, sum(not legal(a[10] + b[9]) for a, b in zip(rows, rows[1:])))
        for r, (state, letters) in zip(rows, path):
            yield (conv, r[1], state, letters, whole[0], *r[5:8], r[8] + whole[2], whole[1])
            whole = (0, 0, 0)


def applied(state: int, letters: str, rows: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """(role, text) that a block's letters make of its rows, from ``state`` on."""
    left = iter(rows)
    for x in letters:
        role, text = (ROLE_NAMES[NEXT_ROLE[state]], "") if x == "I" else next(left)
        if x == "D":
            continue
        if x == "R":
            role = ROLE_NAMES[NEXT_ROLE[state]]
        state = STATE_OF[role[0]]
        yield role, text


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Per conversation, from its id alone, each block's choice and then the
    block's rows: counts, audit and the hash of what is left."""
    for (conv,), rows in _grouped(batches, 1):
        sums, audit, sha, begun = [0] * 6, [], hashlib.sha256(), False
        for _, own in groupby(rows, key=lambda r: r[1]):
            choice = next((r for r in own if r[2] >= 0), None)  # -1: the id alone
            if choice is None:
                continue
            audit.append(choice[9])
            sums = [a + b for a, b in zip(sums, choice[10:])]
            for role, text in applied(choice[8], choice[9], ((r[4], r[6]) for r in own)):
                sha.update(("\n" * begun + role + ":" + text).encode("utf-8", "surrogatepass"))
                begun = True
        yield (conv, *sums, "".join(audit), sha.hexdigest())


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(rows: DataFrame, ids: DataFrame | None = None, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per conversation of ``rows`` (and of ``ids``, a table with
    ``conv_col``, where given): conv_col, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256.

    Null roles and texts are one space.  Rows go by turn, nulls first; rows of
    one turn by role, then by the hash of their text.  A row that occurs more than once is there
    as often as it occurs, side by side.  A null conversation id is a
    conversation of its own.  An empty role has no initial and fits nowhere.
    A conversation without rows has zeros, an empty audit and the hash of the
    empty string; empty tables give an empty one.  Only the named columns are read, so
    others, whatever their names, don't matter.  Long texts are hashed as they pass."""
    conv = dict(rows.dtypes)[conv_col]
    turn = col(turn_col).cast("long")
    text = F.coalesce(col(text_col).cast("string"), F.lit(" "))
    read = rows.select(col(conv_col).alias("conv"), F.shiftright(turn, BLOCK_BITS).alias("block"), turn.alias("turn"),
                       F.coalesce(col(role_col).cast("string"), F.lit(" ")).alias("role"), text.alias("text"),
                       F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"))
    counted = read.select("*", _flags(F.col("text")).alias("flag")).groupBy("conv", "block", "turn", "role", "digest", "flag") \
        .agg(F.count("*").alias("copies"))
    first = counted.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("first"))
    a, b = counted.alias("a"), first.alias("b")
    joined = a.join(b, F.col("a.conv").eqNullSafe(F.col("b.conv")) & (F.col("a.role") == F.col("b.role")) & (F.col("a.digest") == F.col("b.digest")))
    fault = F.when(F.col("flag") == "b", "b").when(~F.col("turn").eqNullSafe(F.col("first.turn")), "d").otherwise(F.col("flag"))
    order = ["turn", "role", "digest"]
    faults = joined.select("a.conv", "block", "turn", "a.role", "a.digest", fault.alias("fault"), "copies") \
        .repartition("conv", "block").sortWithinPartitions("conv", "block", *order) \
        .select("conv", "block", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    whole = "turns long, low long, high long, blank long, duplicate long, truncated long, illegal long, first string, last string"
    blocks = _mapped(faults, f"conv {conv}, block long, {whole}, costs array<long>, audits array<string>", _blocks)
    choices = _mapped(blocks.repartition("conv").sortWithinPartitions("conv", "block"),
                      f"conv {conv}, block long, state long, letters string, " + ", ".join(f"{c} long" for c in COUNTS), _choices)
    names = ["conv", "block", "kind", *order[:2], "digest", "text", "fault", "state", "letters", *COUNTS]
    none = lambda df, kind: df.select(*[F.lit(kind).alias(c) if c == "kind" else F.col(c) if c in df.columns else
                                        F.lit(None).cast({"role": "string", "text": "string", "fault": "string", "letters": "string", "digest": "binary"}.get(c, "long")).alias(c) for c in names])
    parts = none(choices, 0).unionByName(none(read, 1))
    alone = rows.select(col(conv_col).alias("conv")) if ids is None else ids.select(col(conv_col).cast(conv).alias("conv"))
    parts = parts.unionByName(none(alone.distinct(), -1))
    out = _mapped(parts.repartition("conv").sortWithinPartitions("conv", "block", "kind", *order),
                  f"conv {conv}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string", _repaired)
    return out.withColumnRenamed("conv", conv_col)


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text after the check's damage by crc32 of
    ``conv_id:turn`` modulo 20 (nulls: one space): 0 drops the row, 1 empties its text,
    2 takes its sentence ends away, 3 repeats it, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    d = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    return rows.select("conv_id", "turn", F.when(d == 4, "user").otherwise(space("role")).alias("role"),
                       F.when(d == 1, "").when(d == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text")).alias("text"),
                       F.explode(F.array_repeat(F.lit(0), F.when(d == 0, 0).when(d == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations``, damaged: conv_id, gaps, blank, duplicate,
    truncated, illegal, cost, audit, repaired_sha256."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair(damage(rows), rows)


def _sql() -> str:
    """The same by a recursive query over the rows: per state, one text of an
    8-digit cost and the letters so far, so that the least text is the best path."""
    def edge(state: str, cost: str, letter: str) -> str:
        return f"lpad(CAST(CAST(substr({state}, 1, 8) AS BIGINT) + {cost} AS VARCHAR), 8, '0') || substr({state}, 9) || '{letter}'"

    def least(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda v: v IS NOT NULL))"

    def inserted(source: str) -> str:
        one = f"(SELECT *, {least('u', edge('n', '5', 'I'), edge('s', '5', 'I'), edge('a', '5', 'I'))} AS u1, {least('a', edge('u', '5', 'I'))} AS a1 FROM {source})"
        return f"(SELECT * REPLACE ({least('u1', edge('a1', '5', 'I'))} AS u, {least('a1', edge('u1', '5', 'I'))} AS a) FROM {one})"

    grown = inserted("(SELECT p.conv_id, p.i, p.n, p.s, p.u, p.a, r.initial, r.fault FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1)")
    more = "CASE WHEN fault = 't' THEN 5 ELSE 0 END"
    stays = "fault NOT IN ('b', 'd')"
    keep = lambda state, role: f"CASE WHEN {stays} AND initial = '{role}' THEN {edge(state, more, 'K')} END"
    rerole = lambda state: f"CASE WHEN {stays} THEN {edge(state, f'1 + {more}', 'R')} END"
    return rf"""
WITH RECURSIVE src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)) AS k FROM conversations),
crc AS (SELECT *, xor(list_reduce(list_concat([4294967295], flatten(list_transform(k, lambda c: [c, -1, -1, -1, -1, -1, -1, -1, -1]))),
         lambda x, c: CASE WHEN c >= 0 THEN xor(x, c) WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END), 4294967295) % 20 AS d FROM src),
dam AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM crc WHERE d <> 0),
num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen, trim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare FROM dam),
r AS (SELECT *, substr(role, 1, 1) AS initial, CASE WHEN bare = '' THEN 'b' WHEN seen > 1 THEN 'd' WHEN substr(bare, -1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM num),
p AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, '00000000' AS n, CAST(NULL AS VARCHAR) AS s, CAST(NULL AS VARCHAR) AS u, CAST(NULL AS VARCHAR) AS a FROM conversations
  UNION ALL
  SELECT conv_id, i + 1, {edge('n', '2', 'D')}, {least(edge('s', '2', 'D'), keep('n', 's'))},
         {least(edge('u', '2', 'D'), keep('n', 'u'), keep('s', 'u'), keep('a', 'u'), rerole('n'), rerole('s'), rerole('a'))},
         {least(edge('a', '2', 'D'), keep('u', 'a'), rerole('u'))} FROM {grown}),
ends AS (SELECT conv_id, {least('n', 'a')} AS w FROM {inserted('(SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1)')}),
sums AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'b') AS blank,
         count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
         count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM r GROUP BY conv_id),
letters AS (SELECT conv_id, substr(w, 9) AS audit, unnest(range(1, length(w) - 7)) AS k FROM ends),
told AS (SELECT *, substr(audit, k, 1) AS letter, k - length(replace(substr(audit, 1, k), 'I', '')) AS ins FROM letters),
kept AS (SELECT told.conv_id, k, letter, r.role, r.text, row_number() OVER (PARTITION BY told.conv_id ORDER BY k) AS o,
         CASE WHEN first_value(letter || substr(r.role, 1, 1)) OVER (PARTITION BY told.conv_id ORDER BY k) = 'Ks' THEN 1 ELSE 0 END AS sys
  FROM told LEFT JOIN r ON letter <> 'I' AND r.conv_id IS NOT DISTINCT FROM told.conv_id AND r.i = k - ins WHERE letter <> 'D'),
said AS (SELECT conv_id, k, CASE WHEN letter = 'K' THEN role WHEN (o - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END AS x FROM kept),
whole AS (SELECT conv_id, string_agg(x, chr(10) ORDER BY k) AS x FROM said GROUP BY conv_id)
SELECT ends.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(substr(w, 1, 8) AS BIGINT) AS cost, substr(w, 9) AS audit, sha256(coalesce(x, '')) AS repaired_sha256
FROM ends LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM ends.conv_id LEFT JOIN whole ON whole.conv_id IS NOT DISTINCT FROM ends.conv_id"""


OP13_SQL = _sql()
