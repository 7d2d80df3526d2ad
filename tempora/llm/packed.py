"""Token ids in fixed-width bit packing.

A dataset is a folder with two Parquet tables, which any store that Spark
reaches can hold:

* ``blocks``: one row per block of whole documents: ``shard``, ``block`` (its
  number in the shard), ``first`` (ids before it in the shard), ``n_ids``,
  ``width`` (bits an id), ``doc_ids``, ``doc_ends`` (per document, where it
  ends in the block) and ``payload``.
* ``shards``: ``shard``, ``first`` (ids of all shards before it), ``n_ids``.

The payload holds 64 ids in ``width`` little-endian 64-bit words: id i of a
group of 64 takes bits i * width and on.  Groups unpack with 64 vectorised
shifts, and any single id is found by arithmetic.  Shards follow the order of
document ids, so ``first`` of a shard, a block and a document add up to the
place in the whole sequence."""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tempora.llm.common import Recent, Scratch, col, table

END_ID = 2
BLOCK_IDS = 1 << 16
#: Pieces of text kept by a worker process (some 200 bytes each).
CACHE_WORDS = 800_000
BLOCK_SCHEMA = ("shard int, block int, first long, n_ids long, width int, doc_ids array<long>, "
                "doc_ends array<long>, payload binary")


def width_of(vocabulary: int) -> int:
    """Bits for ids 0 .. vocabulary - 1 (one at least)."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, width: int) -> bytes:
    n = -(-ids.size // 64)
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes().ljust(8 * width * n, b"\0")
    rows = np.zeros((n, 64), np.uint64)
    rows.reshape(-1)[:ids.size] = ids
    words = np.zeros((n, width), "<u8")
    for i in range(64):
        word, shift = divmod(i * width, 64)
        words[:, word] |= rows[:, i] << np.uint64(shift)
        if shift + width > 64:
            words[:, word + 1] |= rows[:, i] >> np.uint64(64 - shift)
    return words.tobytes()


def unpack(payload: bytes, width: int, n_ids: int) -> np.ndarray:
    if width in (8, 16, 32):  # whole bytes: the groups' words are the ids themselves
        return np.frombuffer(payload, f"<u{width // 8}", n_ids).astype("<u4")
    words = np.frombuffer(payload, "<u8").reshape(-1, width)
    rows = np.empty((words.shape[0], 64), np.uint64)
    for i in range(64):
        word, shift = divmod(i * width, 64)
        rows[:, i] = words[:, word] >> np.uint64(shift)
        if shift + width > 64:
            rows[:, i] |= words[:, word + 1] << np.uint64(64 - shift)
    return (rows & np.uint64((1 << width) - 1)).reshape(-1)[:n_ids].astype("<u4")


def one_id(payload: bytes, width: int, at: int) -> int:
    """Id number ``at`` of a block without unpacking the rest."""
    group, i = divmod(at, 64)
    word, shift = divmod(i * width, 64)
    start = 8 * (group * width + word)
    return int.from_bytes(payload[start:start + 16], "little") >> shift & ((1 << width) - 1)


class Encoder:
    """Whole texts by the tokenizers library, as little-endian uint32 bytes.

    Byte-level pre-tokens never hold white space after another character, so
    a text may be cut before each space that follows a visible character,
    and equal pieces have equal ids: pieces seen before come from a bounded
    table.  Texts with white space before a space, and tokenizers of another
    kind, are encoded in one piece."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        pre = spec.get("pre_tokenizer") or {}
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                        and spec.get("normalizer") is None
                        and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] or t["single_word"]
                                    for t in spec.get("added_tokens", [])))
        self.first = Recent(lambda w: self._word(w, ""), CACHE_WORDS // 8)
        self.later = Recent(lambda w: self._word(w, " "), CACHE_WORDS)
        self.marks = Recent(lambda w: array("I", [t.id for t in self.tokenizer.model.tokenize(w)]).tobytes(), 10_000)
        self.letters = [self.tokenizer.pre_tokenizer.pre_tokenize_str(chr(b))[0][0] for b in range(128)] if self.by_word else []
        #: Whether ASCII letters stand for themselves.
        self.plain = self.letters[65:91] + self.letters[97:123] == [*map(chr, range(65, 91)), *map(chr, range(97, 123))]
        self.tokenize = self.tokenizer.model.tokenize
        if self.by_word:  # bytes beyond ASCII are the rest of the alphabet, in order
            from tokenizers.pre_tokenizers import ByteLevel
            used = set(self.letters)
            low = sorted(c for c in ByteLevel.alphabet() if c not in used)
            shown = [b for b in range(128, 256) if chr(b) in low]
            moved = [b for b in range(128, 256) if chr(b) not in low]
            rest = [c for c in low if ord(c) > 255]
            self.letters += [chr(b) if b in shown else rest[moved.index(b)] for b in range(128, 256)]

    @property
    def vocabulary(self) -> int:
        return self.tokenizer.get_vocab_size(with_added_tokens=True)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _word(self, word: str, lead: str) -> bytes:
        """Ids of a word, with a space before it if ``lead`` has one.  Letters, and
        letters before punctuation, are one and two pre-tokens, which go to the
        model at once; a single line end between words is one by itself."""
        core = word if word.isalpha() else word.rstrip(".,;:!?")
        if core.isalpha():
            if self.plain and core.isascii():
                shown = self.letters[32] + core if lead else core
            else:
                shown = "".join(map(self.letters.__getitem__, (lead + core).encode()))
            ids = array("I", [t.id for t in self.tokenize(shown)]).tobytes()
            return ids + self.marks[word[len(core):]] if len(core) < len(word) else ids
        if "\n" in word:
            lines = word.split("\n")
            if all(lines) and not re.search(r"\s", "".join(lines)):
                line_end = self.marks[self.letters[10]]
                return (self.later if lead else self.first)[lines[0]] + b"".join(line_end + self.first[x] for x in lines[1:])
        return self._ids([lead + word])[0]

    def encode(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        whole = [i for i, t in enumerate(texts) if not self.by_word or re.search(r"\s ", t)]
        for i, ids in zip(whole, self._ids([texts[i] for i in whole])):
            out[i] = ids
        for i in set(range(len(texts))).difference(whole):
            words = texts[i].split(" ")
            out[i] = self.first[words[0]] + b"".join(map(self.later.__getitem__, words[1:]))
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each worker process."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_ids(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
              end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write the dataset at ``path``, documents in ascending order of id
    (nulls first, equal ids by a hash of their text).  Null text is empty; each
    document ends with ``end_id``.  An empty table gives an empty dataset.

    Blocks close after the document that brings them to ``block_ids``, so a
    document is never cut; memory is bounded by a block and its last text."""
    order = [col(id_col).cast("long").alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text")]
    rows = docs.select(*order)
    keys = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoder(tokenizer)
        width = width_of(max(enc.vocabulary, end_id + 1))
        end = np.array([end_id], "<u4").tobytes()
        shard, block, first = TaskContext.get().partitionId(), 0, 0
        ids, doc_ids, doc_ends, n = [], [], [], 0

        def out() -> pd.DataFrame:
            all_ids = np.frombuffer(b"".join(ids), "<u4")
            return pd.DataFrame([{"shard": shard, "block": block, "first": first, "n_ids": n, "width": width, "doc_ids": list(doc_ids),
                                  "doc_ends": list(doc_ends), "payload": pack(all_ids, width)}])

        for batch in batches:
            names, texts = batch["id"].tolist(), batch["text"].tolist()
            for at in range(0, len(texts), 256):
                for name, e in zip(names[at:at + 256], enc.encode(texts[at:at + 256])):
                    ids += [e, end]
                    n += len(e) // 4 + 1
                    doc_ids.append(None if pd.isna(name) else int(name))
                    doc_ends.append(n)
                    if n >= block_ids:
                        yield out()
                        block, first = block + 1, first + n
                        ids, doc_ids, doc_ends, n = [], [], [], 0
        if doc_ids:
            yield out()

    spark = docs.sparkSession
    rows.mapInPandas(run, BLOCK_SCHEMA).write.parquet(f"{path}/blocks")
    totals = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("n_ids").alias("n_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    totals.select("shard", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"), "n_ids").write.parquet(f"{path}/shards")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Blocks with ``start``, the number of ids before each in the dataset."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(f"{path}/blocks")
    shards = spark.read.schema("shard int, first long, n_ids long").parquet(f"{path}/shards")
    base = F.broadcast(shards.select("shard", F.col("first").alias("base")))  # a row for each shard
    return blocks.join(base, "shard").withColumn("start", F.col("base") + F.col("first")).drop("base")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids array<long>) of each document, unpacked."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids = unpack(r.payload, r.width, r.n_ids)
                ends = np.asarray(r.doc_ends, np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                yield pd.DataFrame({"doc_id": pd.array(r.doc_ids, "Int64"), "start": r.start + starts,
                                    "ids": [ids[a:b].astype(np.int64) for a, b in zip(starts, ends)]})

    return read_blocks(spark, path).mapInPandas(run, "doc_id long, start long, ids array<long>")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and the block's place, unpacked from
    the files (crc32 of the ids as little-endian 32-bit integers)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                ids = unpack(r.payload, r.width, r.n_ids)
                ends = np.asarray(r.doc_ends, np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                yield pd.DataFrame({
                    "doc_id": pd.array(r.doc_ids, "Int64"), "start": r.start + starts, "n_tokens": ends - starts,
                    "ids_crc32": [zlib.crc32(ids[a:b]) for a, b in zip(starts, ends)], "shard": r.shard, "block": r.block})

    return read_blocks(spark, path).mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long, shard int, block int")


def op4_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with the public byte-level BPE of 50,257 ids (16
    bits): doc_id, start, n_tokens, ids_crc32, shard, block."""
    import public_tokenizers
    path = Scratch(spark, "packed").path("ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return checksums(spark, path)
