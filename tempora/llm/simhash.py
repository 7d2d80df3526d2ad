"""SimHash near-duplicates: a self-join of binary tries of fingerprints.

Fingerprints that differ in at most d bits agree on at least one of d + 1
disjoint blocks of bits.  Each distinct fingerprint therefore goes to d + 1
groups, one for each block value; the trie below that value holds the other
bits.  A task walks pairs of trie nodes downwards together, adds one error
where the branches differ, and leaves a pair as soon as it has more than d
errors.  Tries are implicit: a node is a range of a sorted array, and all
pairs of a level move in one vectorised step.

A group with more than ``max_group`` fingerprints isn't walked: its members
are dealt out again by d + 1 blocks of the bits left (the same argument
holds for those), level by level, until groups are small or at most d bits
are left (then all members are linked).  A task gives a spanning star for
each linked set, never all pairs; components are found over these links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import Scratch, col, table
from tempora.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 3
MAX_GROUP = 2048
FULL = (1 << 64) - 1


def simhash64(text: str | None, shingle: int = SHINGLE) -> int:
    """The fingerprint (unsigned): a bit is 1 if more than half of the XXH64
    (seed 42) hashes of the word shingles have it.  Null or no words: 0."""
    if text is None:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        n, shingle = 1, len(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    ends = ends[shingle - 1:].tolist()
    line, h = b" ".join(words), xxhash.xxh64_intdigest
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 32_768):
        hashes = np.array([h(line[a:b], 42) for a, b in zip(starts[at:at + 32_768], ends[at:at + 32_768])], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE) -> DataFrame:
    """(id, fp long with the fingerprint's bits, text_hash long) for each row."""

    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in texts:
            yield pd.Series(np.array([simhash64(t, shingle) for t in s], np.uint64).astype(np.int64))

    fp.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    udf = F.pandas_udf(fp, "long")
    return docs.select(col(id_col).alias("id"), udf(col(text_col).cast("string")).alias("fp"),
                       F.xxhash64(col(text_col).cast("string")).alias("text_hash"))


def split_bits(free: int, parts: int) -> list[int]:
    """``parts`` disjoint masks that cover ``free``, bits dealt in turn."""
    bits = [b for b in range(64) if free >> b & 1]
    return [sum(1 << b for b in bits[i::parts]) for i in range(parts)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def roots(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    p = parent[x]
    while True:
        q = parent[p]
        if np.array_equal(p, q):
            return p
        p = q


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the sets of all pairs; a parent is never larger than its child."""
    while a.size:
        ra, rb = roots(parent, a), roots(parent, b)
        apart = ra != rb
        a, b = np.minimum(ra, rb)[apart], np.maximum(ra, rb)[apart]
        np.minimum.at(parent, b, a)


def trie_links(fp: np.ndarray, mask: int, max_bits: int, step: int = 200_000) -> np.ndarray:
    """Links within all groups of equal ``fp & mask`` of distinct fingerprints
    (uint64): for each position the position of its linked set's first
    member.  The walk goes depth first over blocks of ``step`` node pairs, so
    that memory stays bounded."""
    m = np.uint64(mask)
    order = np.lexsort((fp & ~m, fp & m))
    own = fp[order]
    group = own & m
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    lo, hi = cuts, np.append(cuts[1:], own.size)
    big = hi - lo > 1
    lo, hi = lo[big], hi[big]
    parent = np.arange(own.size)
    free = [b for b in range(63, -1, -1) if not mask >> b & 1]
    ones: dict[int, np.ndarray] = {}
    stack = [(0, lo, hi, lo, hi, np.zeros(lo.size, np.int8))]
    while stack:
        depth, alo, ahi, blo, bhi, err = stack.pop()
        if alo.size > step:
            for at in range(0, alo.size, step):
                stack.append((depth, *(x[at:at + step] for x in (alo, ahi, blo, bhi, err))))
            continue
        single = (ahi - alo == 1) & (bhi - blo == 1)
        a, b = alo[single], blo[single]
        near = (a != b) & (np.bitwise_count(own[a] ^ own[b]) <= max_bits)
        unite(parent, a[near], b[near])
        alo, ahi, blo, bhi, err = (x[~single] for x in (alo, ahi, blo, bhi, err))
        if not alo.size or depth == len(free):
            continue
        if depth not in ones:
            bit = (own >> np.uint64(free[depth])) & np.uint64(1)
            ones[depth] = np.concatenate([[0], np.cumsum(bit, dtype=np.int64)])
        c = ones[depth]
        amid, bmid = ahi - (c[ahi] - c[alo]), bhi - (c[bhi] - c[blo])
        twin = alo == blo
        parts = [(alo, amid, blo, bmid, err), (amid, ahi, bmid, bhi, err), (alo, amid, bmid, bhi, err + 1),
                 tuple(x[~twin] for x in (amid, ahi, blo, bmid, err + 1))]
        alo, ahi, blo, bhi, err = (np.concatenate(x) for x in zip(*parts))
        keep = (ahi > alo) & (bhi > blo) & (err <= max_bits)
        stack.append((depth + 1, *(x[keep] for x in (alo, ahi, blo, bhi, err))))
    first = np.empty(own.size, np.int64)
    first[order] = order[roots(parent, np.arange(own.size))]
    return first


def _walk(max_bits: int, max_group: int, hold: int = 100_000):
    """The task of one level: rows (mask, fp) come sorted by mask and by the
    bits under it.  Small groups give links; members of larger ones go on as
    rows of the next level, without being held."""

    def solve(mask: int, fp: np.ndarray) -> pd.DataFrame:
        first = trie_links(fp, mask & FULL, max_bits)
        linked = first != np.arange(fp.size)
        return pd.DataFrame({"mask": np.int64(0), "a": fp[linked].astype(np.int64), "b": fp[first[linked]].astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ready: list[np.ndarray] = []
        size, at, open_mask, open_val, open_first = 0, [], None, None, None
        over = False

        def settle():
            nonlocal at, over, size
            group = np.concatenate(at) if at else np.empty(0, np.uint64)
            if not over and group.size > 1:
                ready.append(group)
                size += group.size
            at, over = [], False

        for batch in batches:
            masks, fps = batch["mask"].to_numpy(), batch["fp"].to_numpy()
            vals = masks & fps
            cuts = np.flatnonzero(np.concatenate([[True], (masks[1:] != masks[:-1]) | (vals[1:] != vals[:-1])])) if len(fps) else []
            for lo, hi in zip(cuts, [*cuts[1:], len(fps)]):
                mask, val, part = int(masks[lo]), int(vals[lo]), fps[lo:hi].astype(np.uint64)
                if (mask, val) != (open_mask, open_val):
                    settle()
                    if ready and (mask != open_mask or size >= hold):
                        yield solve(open_mask, np.concatenate(ready))
                        ready, size = [], 0
                    open_mask, open_val, open_first = mask, val, part[0]
                free = 64 - (mask & FULL).bit_count()
                if free <= max_bits:  # all members are near enough
                    other = part[part != open_first]
                    yield pd.DataFrame({"mask": np.int64(0), "a": other.astype(np.int64), "b": np.uint64(open_first).astype(np.int64)})
                    continue
                if not over:
                    at.append(part)
                    if sum(x.size for x in at) > max_group:
                        over, held, at = True, np.concatenate(at), []
                        yield pd.DataFrame({"mask": np.int64(mask), "a": held.astype(np.int64), "b": np.int64(0)})
                else:
                    yield pd.DataFrame({"mask": np.int64(mask), "a": part.astype(np.int64), "b": np.int64(0)})
        settle()
        if ready:
            yield solve(open_mask, np.concatenate(ready))

    return run


def links(distinct_fps: DataFrame, scratch: Scratch, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """Spanning links (a, b long) between distinct fingerprints (column fp)
    at ``max_bits`` or fewer differing bits: their components are those of
    all such pairs.  ``max_group`` only sets where a group is dealt out anew."""
    spark = distinct_fps.sparkSession
    blocks = [signed(m) for m in split_bits(FULL, max_bits + 1)]
    rows = distinct_fps.select(F.explode(F.array(*[F.lit(m) for m in blocks])).alias("mask"), "fp")
    out: DataFrame | None = None
    while True:
        dealt = rows.repartition("mask", F.col("fp").bitwiseAND(F.col("mask"))) \
            .sortWithinPartitions("mask", F.col("fp").bitwiseAND(F.col("mask")))
        level = scratch.write(dealt.mapInPandas(_walk(max_bits, max_group), "mask long, a long, b long"), "level")
        found = level.where("mask = 0").select("a", "b")
        out = found if out is None else out.unionByName(found)
        over = level.where("mask <> 0").select("mask", F.col("a").alias("fp"))
        masks = [r["mask"] for r in over.select("mask").distinct().collect()]  # bits of 64: bounded by the depth
        if not masks:
            return out
        finer = {m: [signed(m & FULL | s) for s in split_bits(~m & FULL, max_bits + 1)] for m in masks}
        deal = spark.createDataFrame([(m, x) for m, xs in finer.items() for x in xs], "mask long, finer long")
        rows = over.join(F.broadcast(deal), "mask").select(F.col("finer").alias("mask"), "fp").distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
            max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> tuple[DataFrame, DataFrame]:
    """(rows, labels) as written tables: rows (id, fp, text_hash), one per row of ``docs``;
    labels (fp, component_id, first_hash, copies), one per fingerprint."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, id_col, text_col, shingle), "rows")
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "text_hash")))
    nodes = scratch.write(rows.groupBy("fp").agg(first.alias("first")), "nodes")
    roots_ = connected_components(links(nodes.select("fp"), scratch, max_bits, max_group), scratch)
    rooted = scratch.write(nodes.join(roots_.withColumnRenamed("node", "fp"), "fp", "left")
                           .withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = scratch.write(rooted.groupBy("root").agg(F.min("first").alias("least")), "least")
    labels = scratch.write(rooted.join(least, "root").select(
        "fp", "root", F.col("least.id").alias("component_id"), F.col("least.text_hash").alias("first_hash")), "fp-labels")
    return rows, labels


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hex digits)
    and ``component_id``, the smallest id reachable over links.

    Null text counts as no words: fingerprint zero, linked like any other.
    Rows with a null id keep their component; a component of null ids only
    has a null component_id.  Repeated rows come back as often as given."""
    rows, labels = classes(docs, id_col, text_col, shingle, max_bits)
    return rows.join(labels, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component: the row with the smallest id
    (repeated ids: the smallest text hash; repeated rows: one of them).
    Rows without an id are no candidates unless the whole component has none:
    then one of those rows stays."""
    rows, labels = classes(docs, id_col, text_col, shingle, max_bits)
    scratch = Scratch(docs.sparkSession, "simhash-keep")
    nameless = labels.where("component_id is null").select("fp", "root")
    chosen = labels.where("component_id is not null").select(F.col("component_id").alias("cid"), F.col("first_hash").alias("chash")) \
        .unionByName(rows.where("id is null").join(nameless, "fp").groupBy("root").agg(F.min("text_hash").alias("text_hash"))
                     .select(F.lit(None).cast(rows.schema["id"].dataType).alias("cid"), F.col("text_hash").alias("chash"))).distinct()
    copies = rows.join(chosen, F.col("id").eqNullSafe(F.col("cid")) & (F.col("text_hash") == F.col("chash")), "left_semi") \
        .groupBy("id", "text_hash").agg(F.count("*").alias("copies"))
    copies = scratch.write(copies, "chosen")
    row = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), col(id_col).alias("i"),
                      F.xxhash64(col(text_col).cast("string")).alias("h"))
    kept = row.join(copies, F.col("i").eqNullSafe(F.col("id")) & (F.col("h") == F.col("text_hash")))
    once = kept.where("copies = 1").select("row")
    again = kept.where("copies > 1").groupBy("id", "text_hash").agg(F.first("row").alias("row")).select("row")
    return once.unionByName(again).select("row.*")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, fingerprint, component_id."""
    return near_duplicates(table(spark, sf_dir, "documents"))
