"""Connected components by contraction with random priorities.

Each round every node moves to the neighbour (or itself) with the smallest
hash, edges are rewritten to those targets, and loops and repeats go.  The
expected number of nodes shrinks by a constant factor a round, so rounds grow
with the logarithm of the longest chain, also for chains in sorted order.
Aggregates combine before the shuffle, and both sides of each join are
written tables, so that adaptive execution can split a hot node's edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``edges``: two columns a, b (long), one row or more per link, any
    direction.  Returns a written table (node, root), one row for each node
    that has a link to another node; root is the same for all nodes of a
    component.  Loops are ignored; no edges give no rows."""
    current = scratch.write(edges.select("a", "b").where("a <> b").distinct(), "edges")
    moves: list[DataFrame] = []
    while not current.isEmpty():
        seed = len(moves)
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = F.min(F.struct(F.xxhash64("b", F.lit(seed)).alias("h"), F.col("b").alias("n")))
        own = F.struct(F.xxhash64("a", F.lit(seed)).alias("h"), F.col("a").alias("n"))
        move = (both.groupBy("a").agg(near.alias("near"))
                .select(F.col("a").alias("node"), F.least(own, F.col("near"))["n"].alias("to")))
        move = scratch.write(move, f"move{seed}")
        moves.append(move)
        first = move.select(F.col("node").alias("a"), F.col("to").alias("ta"))
        second = move.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        moved = scratch.write(current.join(first, "a").select("b", "ta"), f"half{seed}")
        nxt = (moved.join(second, "b").where("ta <> tb")
               .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
        nxt = scratch.write(nxt, f"edges{seed}")
        scratch.drop(current, moved)
        current = nxt
    if not moves:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    labels = moves.pop().withColumnRenamed("to", "root")
    while moves:
        move = moves.pop()
        nodes = labels.select(F.col("node").alias("to"), "root")
        older = move.join(nodes, "to", "left").select("node", F.coalesce("root", "to").alias("root"))
        labels = scratch.write(older, "labels")
    return labels
