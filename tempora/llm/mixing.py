"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document
belongs to).  Token capacity flows from patterns to the quotas of their
sources; using a pattern's documents for the r-th time costs r - 1 a token,
so costs are convex and first uses are preferred.  A pattern whose source has no
other pattern is routed in the plan by itself; only patterns and sources
that overlap form the flow network, which is solved by successive shortest
paths on aggregates (rows: patterns, not documents).

The flow of a pattern is then taken from its documents: all of them as many
full times as fit, and the rest from documents in the order of a seeded hash.
Hash buckets are summed first, so that only the bucket per pattern in
which the quota ends is gone through document by document: there, documents that
still fit are taken.  What then is left of the quota goes on to the buckets after
it in further rounds, until no later document is small enough.  Reruns give the
same result."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.common import SPACE_CHARS, Scratch, col, table
from tempora.llm.quality import whole, words

MAX_REPEATS = 3
#: Aggregates of patterns and sources that the driver takes; more is an error.
MAX_PATTERNS = 200_000
BUCKET_ROWS = 4096


def word_count(text: Column) -> Column:
    return F.size(words(whole(text))).cast("long")


def targets(sizes: list[int], weights: list[float], total: int, repeats: int = MAX_REPEATS) -> list[float]:
    """Shares of ``total`` by weight, none above ``repeats`` times its size;
    what exceeds that is shared again by weight, until none is above.  Equal to
    min(limit, level * weight) for the one level that sums to the total."""
    left, open_ = Fraction(total), [i for i, s in enumerate(sizes) if s > 0]
    out = [Fraction(0)] * len(sizes)
    w = [Fraction(x) for x in weights]
    while open_:
        level = left / sum(w[i] for i in open_) if any(w[i] for i in open_) else Fraction(0)
        full = [i for i in open_ if level * w[i] > repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = level * w[i]
            break
        for i in full:
            out[i] = Fraction(repeats * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return [float(x) for x in out]


def route(capacity: list[int], members: list[list[int]], quotas: list[int], repeats: int = MAX_REPEATS) -> list[dict[int, int]]:
    """Min-cost flow: for each pattern, units sent to each of its sources.

    Unit costs are 0, 1, .. for the first, second, .. use of a pattern's
    capacity, up to ``repeats``.  As much as possible of every quota is met, at the least
    total cost.  Successive shortest paths: of the residual paths from the start
    over a pattern's cheapest open use, then source and pattern in turn along
    flow that can be sent elsewhere, to a source that lacks tokens.  Costs lie on
    the first arc alone or (backwards) on a pattern's last use, so a search by
    layers of equal cost finds the cheapest path."""
    flow: list[dict[int, int]] = [dict() for _ in capacity]
    used, lack = [0] * len(capacity), list(quotas)
    by_source: dict[int, list[int]] = {}
    for p, ms in enumerate(members):
        for s in ms:
            by_source.setdefault(s, []).append(p)
    for level in range(repeats):  # the cheapest uses first: level is the cost of the path
        limit = [(level + 1) * c for c in capacity]
        while True:
            # breadth first from all patterns with an open use at this cost
            parent: dict[tuple[str, int], tuple[str, int] | None] = {}
            queue: list[tuple[str, int]] = []
            for p in range(len(capacity)):
                if used[p] < limit[p]:
                    parent[("p", p)] = None
                    queue.append(("p", p))
            goal = None
            for kind, i in queue:
                if kind == "p":
                    for s in members[i]:
                        if ("s", s) not in parent:
                            parent[("s", s)] = (kind, i)
                            if lack[s] > 0:
                                goal = ("s", s)
                                break
                            queue.append(("s", s))
                    if goal:
                        break
                else:  # a full source can give back what another pattern sends it
                    for p in by_source[i]:
                        if flow[p].get(i, 0) > 0 and ("p", p) not in parent:
                            parent[("p", p)] = (kind, i)
                            queue.append(("p", p))
            if goal is None:
                break
            path = [goal]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            path.reverse()
            amount = min(limit[path[0][1]] - used[path[0][1]], lack[goal[1]])
            for a, b in zip(path[1::2], path[2::2]):  # source gives back to pattern
                amount = min(amount, flow[b[1]][a[1]])
            used[path[0][1]] += amount
            lack[goal[1]] -= amount
            for a, b in zip(path, path[1:]):
                if a[0] == "p":
                    flow[a[1]][b[1]] = flow[a[1]].get(b[1], 0) + amount
                else:
                    flow[b[1]][a[1]] -= amount
    return flow


def weights_in_order(sources: list[str | None]) -> list[float]:
    """1, 2, 3, 1, .. over the sources by code point, null last."""
    order = sorted(range(len(sources)), key=lambda i: (sources[i] is None, sources[i] or ""))
    out = [0.0] * len(sources)
    for n, i in enumerate(order):
        out[i] = float(n % 3 + 1)
    return out


def bounded(df: DataFrame, what: str) -> list:
    rows = df.limit(MAX_PATTERNS + 1).collect()
    if len(rows) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} {what}")
    return rows


def plan_mix(patterns: list[tuple[tuple, int]], weigh=weights_in_order, repeats: int = MAX_REPEATS) -> tuple[dict, dict]:
    """From (sources of the pattern, its size in tokens): per source (size, target), and per
    pattern the tokens to take.  A document of several sources counts in the size of each."""
    names = sorted({s for p, _ in patterns for s in p}, key=lambda s: (s is None, s or ""))
    at = {s: i for i, s in enumerate(names)}
    sizes = [0] * len(names)
    for p, n in patterns:
        for s in p:
            sizes[at[s]] += n
    goal = targets(sizes, weigh(names), sum(n for _, n in patterns), repeats)
    degree = [0] * len(names)
    for p, _ in patterns:
        for s in p:
            degree[at[s]] += 1
    quota = [round(g) for g in goal]
    take = {p: min(quota[at[p[0]]], repeats * n) for p, n in patterns if len(p) == 1 and degree[at[p[0]]] == 1}
    shared = [(p, n) for p, n in patterns if p not in take]
    flows = route([n for _, n in shared], [[at[s] for s in p] for p, _ in shared], quota, repeats)
    take |= {p: sum(f.values()) for (p, _), f in zip(shared, flows)}
    return {s: (sizes[i], goal[i]) for s, i in at.items()}, take


def _last_bucket(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of the buckets in which a pattern's quota ends, sorted by
    pattern and hash: each that still fits is taken once more."""
    pattern, left = None, 0
    for b in batches:
        extra = []
        for p, size, room in zip(b["pid"].tolist(), b["size"].tolist(), b["room"].tolist()):
            if p != pattern:
                pattern, left = p, room
            extra.append(int(0 < size <= left))
            left -= size * extra[-1]
        yield b.assign(extra=extra)[["pid", "h", "id", "tie", "size", "extra"]]


def mix(docs: DataFrame, members: Column, size: Column, id_col: str = "doc_id", weigh=weights_in_order,
        repeats: int = MAX_REPEATS, seed: int = 7, tie: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, sources): rows (id, tie, sources, size, copies) has a row for each
    row of ``docs`` and the number of times the mix takes it, 0 to ``repeats``;
    sources (source, source_size, target) a row per source.  ``tie`` (a long)
    tells rows of one id apart.

    ``members`` gives an array of sources (null entries allowed; a null or
    empty array counts as one null source; repeats in it count once), ``size``
    the tokens.  Documents without tokens are never taken.  Rows alike in
    id, tie, sources and size are exchangeable: which of them is taken is not
    defined, how many is."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    sources = F.array_sort(F.array_distinct(F.coalesce(members, F.array(F.lit(None).cast("string"))).cast("array<string>")))
    sources = F.when(F.size(sources) == 0, F.array(F.lit(None).cast("string"))).otherwise(sources)
    rows = docs.select(col(id_col).alias("id"), (F.lit(0) if tie is None else tie).cast("long").alias("tie"), sources.alias("sources"), F.coalesce(size, F.lit(0)).cast("long").alias("size"))
    rows = scratch.write(rows.withColumn("pid", F.xxhash64(F.transform("sources", lambda s: F.coalesce(F.concat(F.lit("="), s), F.lit(""))))), "rows")
    totals = bounded(rows.groupBy("pid").agg(F.first("sources").alias("sources"), F.sum("size").alias("n"), F.count("*").alias("rows"),
                                             F.min("sources").alias("least"), F.max("sources").alias("most")), "membership patterns")
    if any(r["least"] != r["most"] for r in totals):
        raise ValueError("two membership patterns share a hash")
    by_source, take = plan_mix([(tuple(r["sources"]), r["n"]) for r in totals], weigh, repeats)
    plan = []
    for r in totals:
        want = take[tuple(r["sources"])]
        times = min(want // r["n"], repeats) if r["n"] else 0
        bits = max(0, (max(r["rows"], 1) // BUCKET_ROWS).bit_length())
        plan.append((r["pid"], int(times), int(want - times * r["n"]) if times < repeats else 0, 1 << bits))
    todo = F.broadcast(spark.createDataFrame(plan, "pid long, times int, rest long, buckets long"))  # MAX_PATTERNS rows at most
    h = F.xxhash64(F.lit(seed), F.col("id"), F.col("tie"), F.col("size"))
    dealt = rows.join(todo, "pid").withColumn("h", h).withColumn("bucket", F.pmod(F.shiftrightunsigned("h", 20), F.col("buckets")))
    sums = scratch.write(dealt.where("size > 0").groupBy("pid", "bucket").agg(F.sum("size").alias("n"), F.min("size").alias("least")), "sums")
    rooms = todo.select("pid", F.lit(-1).cast("long").alias("after"), F.col("rest").alias("room"))
    before = Window.partitionBy("pid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole_, fine = [], []
    while True:  # a round takes whole buckets up to the first that doesn't fit, and goes through that one
        open_ = sums.join(F.broadcast(rooms), "pid").where("bucket > after and least <= room") \
            .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        step = scratch.write(open_.where("before <= room").select("pid", "bucket", (F.col("room") - F.col("before")).alias("room"), (F.col("before") + F.col("n") <= F.col("room")).alias("fits"))
                             .where("fits or room > 0"), "step")
        if step.isEmpty():
            break
        whole_.append(step.where("fits").select("pid", "bucket"))
        ends = step.where("not fits").select("pid", "bucket", "room")
        taken = (dealt.select("pid", "h", "id", "tie", "size", "bucket").join(F.broadcast(ends), ["pid", "bucket"])
                 .repartition("pid").sortWithinPartitions("pid", "h", "id", "tie", "size")
                 .mapInPandas(_last_bucket, f"pid long, h long, id {rows.schema['id'].dataType.simpleString()}, tie long, size long, extra int"))
        taken = scratch.write(taken.join(F.broadcast(ends), "pid"), "taken")
        fine.append(taken)
        rooms = scratch.write(taken.groupBy("pid", "bucket", "room").agg(F.sum(F.col("size") * F.col("extra")).alias("used"))
                              .select("pid", F.col("bucket").alias("after"), (F.col("room") - F.col("used")).alias("room")).where("room > 0"), "rooms")
    done = reduce(DataFrame.unionByName, [w.withColumn("full", F.lit(1)) for w in whole_] + [f.select("pid", "bucket").distinct().withColumn("full", F.lit(-1)) for f in fine],
                  spark.createDataFrame([], "pid long, bucket long, full int"))
    done = scratch.write(done, "done")
    near = dealt.select("id", "tie", "sources", "size", "pid", "bucket", "times").join(done, ["pid", "bucket"], "left")  # grows with the rows: no hint
    full = F.when(F.col("size") > 0, F.col("times") + F.coalesce(F.col("full"), F.lit(0))).otherwise(0).cast("int")
    out = near.where("full is null or full = 1").select("id", "tie", "sources", "size", full.alias("copies"))
    of_pattern = F.broadcast(todo.join(spark.createDataFrame([(r["pid"], r["sources"]) for r in totals], "pid long, sources array<string>"), "pid").select("pid", "times", "sources"))
    for taken in fine:
        out = out.unionByName(taken.join(of_pattern, "pid").select(
            "id", "tie", "sources", "size", F.when(F.col("size") > 0, F.col("times") + F.col("extra")).otherwise(0).cast("int").alias("copies")))
    out = scratch.write(out, "mixed")
    listed = spark.createDataFrame([(s, n, g) for s, (n, g) in by_source.items()], "source string, source_size long, target double")
    return out, listed


def take(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` as the mix by words and one source a row has it: each row as
    often as it is taken, rows not taken left out; all columns stay.  Null
    texts have no words and are never taken."""
    h = F.xxhash64(whole(col(text_col)))
    rows, _ = mix(docs, F.array(col(source_col).cast("string")), word_count(col(text_col)), id_col, tie=h, **options)
    chosen = rows.groupBy("id", "tie").agg(F.sum("copies").alias("copies"), F.count("*").alias("n")).where("copies > 0")
    chosen = Scratch(docs.sparkSession, "mixing-take").write(chosen, "chosen")
    row = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_col).alias("i"), h.alias("h"))
    joined = row.join(chosen, F.col("i").eqNullSafe(F.col("id")) & (F.col("h") == F.col("tie")))
    once = joined.where("n = 1").select("row", "copies")
    again = joined.where("n > 1").groupBy("id", "tie").agg(F.first("row").alias("row"), F.first("copies").alias("copies")).select("row", "copies")
    each = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return once.unionByName(again).select("row", each.alias("copy")).select("row.*")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` by their source: doc_id, size, source_size, target,
    taken, and copies."""
    docs = table(spark, sf_dir, "documents")
    rows, listed = mix(docs, F.array("source"), word_count(F.col("text")))
    one = rows.select("id", F.col("sources")[0].alias("s"), "size", "copies")
    joined = one.join(F.broadcast(listed), F.col("s").eqNullSafe(F.col("source")))
    return joined.select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                         (F.col("size") * F.col("copies")).alias("taken"), "copies")
