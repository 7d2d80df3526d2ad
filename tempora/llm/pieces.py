"""SentencePiece encoding by a max-plus parallel scan, and decoding.

An encoding is the segmentation of the text (spaces as the piece table's
space mark) with the largest sum of piece scores; of equal sums the one whose
last piece is longest, and so on towards the start.  The public model file gives pieces and scores; characters
outside the table become byte pieces.  (The file's own library merges pairs
instead, so ids can differ from it; both decode to the same text.)

Where no piece of the table has the space mark after another character, each word
is segmented by itself.  Words seen before come from a bounded table; the others of
a batch are taken together, all of one length in one lattice of numpy arrays.

Giant documents are cut in chunks at fixed places, and each chunk is worked on
by itself, wherever it lies:

1. Its transfer matrix holds, for each number i of characters that a piece
   from the chunk before reaches into it, and each number j by which its own
   last piece reaches beyond its end, the best score in between.
2. Matrices of a document are combined in the max-plus algebra, which is
   associative: products of groups of chunks, a scan over the products, and
   a scan within each group.  This gives every chunk the best scores at its start.
3. With those a chunk maps each j to the i it came from; the maps are composed
   backwards in the same two levels, which gives every chunk its j.
4. Each chunk is traced back by itself.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import Recent, Scratch, col, table

MARK = "▁"
CHUNK = 32_768
GROUP = 256
#: Words kept by a worker process (some 250 bytes each).
CACHE_WORDS = 240_000
NONE = float("-inf")
FRAGMENT = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
#: Places of one lattice of numpy arrays, and the fewest words that pay for one.
PLACES, TOGETHER = 1 << 14, 8


class Trie:
    """The table's pieces as a trie whose steps are looked up in numpy: a step's key is
    its node and character, so that equal keys are equal steps.  Node 0 is the root."""

    def __init__(self, pieces: dict[str, tuple[float, int] | None]):
        number = {"": 0}
        for p in sorted(pieces):
            number[p] = len(number)
        self.score = np.full(len(number), NONE)
        self.id = np.full(len(number), -1, np.int32)
        keys = np.empty(len(pieces), np.uint64)
        for i, (p, hit) in enumerate(pieces.items()):
            keys[i] = number[p[:-1]] << 21 | ord(p[-1])
            if hit:
                self.score[number[p]], self.id[number[p]] = hit
        slots = self._slot(keys)
        order = np.argsort(slots, kind="stable")
        self.keys = np.append(keys[order], np.full(1, 2**64 - 1, np.uint64))
        self.nodes = np.append(np.array([number[p] for p in pieces], np.int32)[order], np.int32(-1))
        counts = np.bincount(slots, minlength=1 << 18)
        self.first = (np.cumsum(counts) - counts).astype(np.int32)
        self.tries = int(counts.max(initial=0))

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(46)).astype(np.int64)

    def step(self, nodes: np.ndarray, points: np.ndarray) -> np.ndarray:
        """The node that each character leads to (-1: none)."""
        keys = nodes.astype(np.uint64) << np.uint64(21) | points
        at = self.first[self._slot(keys)]
        out = np.full(keys.size, -1, np.int32)
        last = self.keys.size - 1
        for i in range(self.tries):
            place = np.minimum(at + i, last)
            hit = self.keys[place] == keys
            out[hit] = self.nodes[place[hit]]
        return out


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "Ａ  b "
        if sp.normalize(probe).replace(MARK, " ").lstrip() != probe:
            raise ValueError("only models without text normalisation are supported")
        self.prefix = MARK if sp.normalize("a").startswith(MARK) else ""
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        self.table = {sp.id_to_piece(i): (sp.get_score(i), i) for i in plain}
        self.longest = max(map(len, self.table))
        self.unknown = min(s for s, _ in self.table.values()) - 10
        bytes_ = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if sp.is_byte(i)}
        self.bytes = [bytes_[f"<0x{b:02X}>"] for b in range(256)] if bytes_ else None
        self.unk = sp.unk_id()
        #: Ids of ASCII characters as bytes; -1: of any other.
        self.ascii = np.array([*(self.bytes[:128] if self.bytes else [self.unk] * 128), -1], np.int32)
        self.cuts = not any(MARK in p.lstrip(MARK) for p in self.table)
        size = sp.get_piece_size()
        self.raw = [b""] * size  # what a piece stands for
        self.score_of = np.zeros(size)
        for p, (score, i) in self.table.items():
            self.raw[i] = p.replace(MARK, " ").encode("utf-8", "surrogatepass")
            self.score_of[i] = score
        for b, i in enumerate(self.bytes or []):
            self.raw[i] = bytes([b])
        #: Score and id of pieces, and None for what only begins one.
        self.pieces: dict[str, tuple[float, int] | None] = {p[:i]: None for p in self.table for i in range(1, len(p))}
        self.pieces.update(self.table)
        self.trie = Trie(self.pieces)
        #: Per word (what follows a mark up to the next): its ids as little-endian 32-bit integers.
        self.words = Recent(lambda w: self.fragment(MARK + w), CACHE_WORDS)
        self.points = Recent(lambda w: self.lattice(MARK + w, len(w) + 1, [0.0])[0][-1], CACHE_WORDS // 4)

    def prepare(self, text: str) -> str:
        return self.prefix + text.replace(" ", MARK) if text else ""

    def lattice(self, text: str, stop: int, entries: list[float]) -> tuple[list[float], list[int]]:
        """Best scores and the start of the last piece per place, for pieces
        that start before ``stop``; a place in ``entries`` can be reached from outside with
        that score (start -1, first choice in a tie)."""
        n, begun, other = len(text), self.pieces.get, NONE
        best, start = [other] * (n + 1), [-2] * (n + 1)
        for i, s in enumerate(entries[:n + 1]):
            if s > other:
                best[i], start[i] = s, -1
        for at in range(stop):
            so_far = best[at]
            if so_far == other:
                continue
            end = at + 1
            hit = begun(text[at:end], False)
            if not hit:  # no piece of one character
                s = so_far + self.unknown
                if s > best[end]:
                    best[end], start[end] = s, at
            while hit is not False:
                if hit:
                    s = so_far + hit[0]
                    if s > best[end]:
                        best[end], start[end] = s, at
                end += 1
                if end > n:
                    break
                hit = begun(text[at:end], False)
        return best, start

    def path(self, text: str, start: list[int], at: int) -> tuple[int, list[int]]:
        """(place of entry, ids) of the best way to ``at``."""
        cuts = [at]
        while start[cuts[-1]] >= 0:
            cuts.append(start[cuts[-1]])
        cuts.reverse()
        ids: list[int] = []
        for a, b in zip(cuts, cuts[1:]):
            hit = self.table.get(text[a:b])
            if hit is not None:
                ids.append(hit[1])
            elif self.bytes:
                ids += [self.bytes[x] for x in text[a:b].encode("utf-8", "surrogatepass")]
            else:
                ids.append(self.unk)
        return cuts[0], ids

    def fragment(self, text: str) -> bytes:
        """Ids of a text that is one lattice."""
        n, begun, unknown = len(text), self.pieces.get, self.unknown
        best, back, ids = [0.0] + [NONE] * n, [0] * (n + 1), [-1] * (n + 1)
        for at in range(n):
            so_far, end = best[at], at + 1
            hit = begun(text[at:end], False)
            if not hit and so_far + unknown > best[end]:  # no piece of one character
                best[end], back[end], ids[end] = so_far + unknown, at, -1
            while hit is not False:
                if hit and so_far + hit[0] > best[end]:
                    best[end], back[end], ids[end] = so_far + hit[0], at, hit[1]
                end += 1
                if end > n:
                    break
                hit = begun(text[at:end], False)
        out, at = [], n
        while at:
            if ids[at] >= 0:
                out.append(ids[at])
            elif self.bytes:
                out += [self.bytes[x] for x in reversed(text[back[at]:at].encode("utf-8", "surrogatepass"))]
            else:
                out.append(self.unk)
            at = back[at]
        out.reverse()
        return array("i", out).tobytes()

    def fragments(self, texts: list[str]) -> tuple[list[bytes], list[float]]:
        """Ids and best score of texts of one length that are lattices by
        themselves, as ``fragment`` and ``lattice`` find them."""
        m, n = len(texts), len(texts[0])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        width = min(n, self.longest)
        gain = np.full((width, m * n), NONE)  # by length less 1 and place: a piece's score
        piece = np.full((width, m * n), -1, np.int32)
        at, nodes = np.arange(m * n), np.zeros(m * n, np.int32)
        for length in range(width):
            if length:
                inside = at % n + length < n
                at, nodes = at[inside], nodes[inside]
            nodes = self.trie.step(nodes, points[at + length])
            known = nodes >= 0
            at, nodes = at[known], nodes[known]
            gain[length, at], piece[length, at] = self.trie.score[nodes], self.trie.id[nodes]
        gain[0, piece[0] < 0] = self.unknown  # no piece of one character
        gain, piece = gain.reshape(width, m, n), piece.reshape(width, m, n)
        best = np.full((n + 1, m), NONE)
        back, ids = np.zeros((n + 1, m), np.int64), np.full((n + 1, m), -1, np.int32)
        best[0] = 0.0
        for i in range(n):  # the first start wins a tie: the longest last piece
            reach = min(width, n - i)
            total = best[i] + gain[:reach, :, i]
            better = total > best[i + 1:i + 1 + reach]
            np.copyto(best[i + 1:i + 1 + reach], total, where=better)
            np.copyto(back[i + 1:i + 1 + reach], i, where=better)
            np.copyto(ids[i + 1:i + 1 + reach], piece[:reach, :, i], where=better)
        rows, ends = np.arange(m), np.full(m, n)
        path, count, other = np.zeros((m, n), "<i4"), np.zeros(m, np.int64), np.zeros(m, bool)
        while rows.size:  # backwards from the end, ids from the right
            count[rows] += 1
            found, starts = ids[ends, rows], back[ends, rows]
            lone = np.flatnonzero(found < 0)  # a character outside the table
            if lone.size:
                point = points[rows[lone] * n + starts[lone]].astype(np.int64)
                found[lone] = self.ascii[np.minimum(point, 128)]
                other[rows[lone[found[lone] < 0]]] = True
            path[rows, n - count[rows]] = found
            ends = starts
            rows, ends = rows[ends > 0], ends[ends > 0]
        raw, size = path.tobytes(), 4 * n
        out = [raw[(i + 1) * size - 4 * c:(i + 1) * size] for i, c in enumerate(count.tolist())]
        for i in np.flatnonzero(other).tolist():  # characters of several byte pieces
            out[i] = self.fragment(texts[i])
        return out, best[n].tolist()

    def learn(self, texts: list[str], points: bool = False) -> None:
        """Take the words of prepared texts that the table of words lacks into it, together."""
        if not self.cuts:
            return
        into = self.points if points else self.words
        words: set[str] = set()
        for t in texts:
            if t.startswith(MARK) and MARK + MARK not in t:
                words.update(t[1:].split(MARK))
        by_length: dict[int, list[str]] = {}
        for w in into.lacking(words):
            by_length.setdefault(len(w) + 1, []).append(MARK + w)
        for n, alike in by_length.items():
            if len(alike) < TOGETHER:
                continue  # one by one when asked for
            step = max(1, PLACES // n)
            for i in range(0, len(alike), step):
                part = alike[i:i + step]
                ids, scores = self.fragments(part)
                into.take({w[1:]: x for w, x in zip(part, scores if points else ids)})

    def closed(self, text: str) -> bytes:
        """Ids of text that starts and ends between words."""
        if not self.cuts:
            return self.fragment(text)
        if text.startswith(MARK) and MARK + MARK not in text:
            return b"".join(map(self.words.__getitem__, text[1:].split(MARK)))
        return b"".join(self.fragment(f) for f in FRAGMENT.findall(text))

    def score(self, text: str) -> float:
        """Best score of text that starts and ends between words."""
        if self.cuts and text.startswith(MARK) and MARK + MARK not in text:
            return sum(map(self.points.__getitem__, text[1:].split(MARK)))
        parts = FRAGMENT.findall(text) if self.cuts else [text]
        return sum(self.lattice(p, len(p), [0.0])[0][-1] for p in parts)

    def borders(self, text: str, stop: int) -> tuple[int, int] | None:
        """First and last place where a word starts that no entry lies behind."""
        if not self.cuts:
            return None
        first = self._border(text, self.longest - 1, stop, 1)
        return None if first is None else (first, self._border(text, first, stop, -1) or first)

    def _border(self, text: str, lo: int, hi: int, step: int) -> int | None:
        places = range(max(lo, 1), min(hi, len(text) - 1) + 1)
        for q in places if step > 0 else reversed(places):
            if text[q] == MARK and text[q - 1] != MARK:
                return q
        return None

    def matrix(self, text: str, stop: int) -> np.ndarray:
        """Transfer matrix of a chunk: text up to ``stop``, and what follows
        for pieces that reach over it."""
        n = self.longest
        out = np.full((n, n), NONE)
        cut = self.borders(text, stop)
        if cut is not None:
            first, last = cut
            heads = np.array([self.lattice(text[:first], first, [NONE] * i + [0.0])[0][first] for i in range(n)])
            self.learn([text[first:last]], points=True)
            middle = self.score(text[first:last])
            tail = self.lattice(text[last:], stop - last, [0.0])[0][stop - last:][:n]
            out[:, :len(tail)] = heads[:, None] + middle + np.array(tail)[None, :]
            return out
        best = np.full((len(text) + 1, n), NONE)
        for i in range(min(n, len(text) + 1)):
            best[i, i] = 0.0
        for at in range(stop):
            for end in range(at + 1, min(at + n, len(text)) + 1):
                hit = self.table.get(text[at:end])
                if hit is not None or end == at + 1:
                    np.maximum(best[end], best[at] + (hit[0] if hit else self.unknown), out=best[end])
        tail = best[stop:stop + n]
        out[:, :len(tail)] = tail.T
        return out

    def back_map(self, text: str, stop: int, entries: list[float]) -> list[int]:
        """For each j the entry of the best way to ``stop`` + j (-1: none)."""
        n = self.longest
        cut = self.borders(text, stop)
        if cut is not None:
            _, start = self.lattice(text[:cut[0]], cut[0], entries)
            return [self.path(text[:cut[0]], start, cut[0])[0]] * n
        best, start = self.lattice(text, stop, entries)
        return [self.path(text, start, stop + j)[0] if stop + j < len(best) and best[stop + j] > NONE else -1 for j in range(n)]

    def trace(self, text: str, stop: int, entries: list[float], j: int) -> bytes:
        """Ids of the chunk whose last piece reaches ``j`` beyond its end."""
        def ids(part: str, until: int, at: int, start: list[float]) -> bytes:
            return np.array(self.path(part, self.lattice(part, until, start)[1], at)[1], "<i4").tobytes()

        cut = self.borders(text, stop)
        if cut is None:
            return ids(text, stop, stop + j, entries)
        first, last = cut
        self.learn([text[first:last]])
        return ids(text[:first], first, first, entries) + self.closed(text[first:last]) + ids(text[last:], stop - last, stop - last + j, [0.0])

    def decode(self, ids, first: bool = True) -> bytes:
        """UTF-8 of ids; ``first``: they start the document (and may start
        with the mark that encoding put there)."""
        out = b"".join(map(self.raw.__getitem__, ids))
        return out[1:] if first and self.prefix and out[:1] == b" " else out


_MODELS: dict[str, PieceModel] = {}


def piece_model(path: str) -> PieceModel:
    """One for each worker process."""
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Max-plus product."""
    return (a[:, :, None] + b[None, :, :]).max(axis=1)


def _grouped(df: DataFrame, keys: list[str], fn: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    return df.groupBy(*keys).applyInPandas(fn, schema)


def _matrix(raw: bytes) -> np.ndarray:
    a = np.frombuffer(raw, np.float64)
    return a.reshape(int(len(a) ** 0.5), -1)


#: What a row says of its ids: themselves, or counts and checksums.
AS_IDS = "ids array<int>"
AS_DIGEST = "n long, score double, ids_crc32 long, size long, text_crc32 long"


def _told(m: PieceModel, parts: list[bytes], first: list[bool], form: str) -> dict:
    ids = [np.frombuffer(p, "<i4") for p in parts]
    if form == AS_IDS:
        return {"ids": ids}
    texts = [m.decode(i.tolist(), f) for i, f in zip(ids, first)]
    return {"n": [i.size for i in ids], "score": [float(m.score_of[i].sum()) for i in ids], "ids_crc32": [zlib.crc32(p) for p in parts],
            "size": [len(t) for t in texts], "text_crc32": [zlib.crc32(t) for t in texts]}


def _giant(chunks: DataFrame, model: str, scratch: Scratch, form: str) -> DataFrame:
    """(uid, c, and ``form``) of the chunks (uid, c, g, stop, text) of giant documents."""

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = piece_model(model)
        for b in batches:
            yield pd.DataFrame({"uid": b["uid"], "c": b["c"], "g": b["g"], "m": [m.matrix(t, s).tobytes() for t, s in zip(b["text"], b["stop"])]})

    def product(p: pd.DataFrame) -> pd.DataFrame:
        out = None
        for raw in p.sort_values("c")["m"]:
            out = _matrix(raw) if out is None else times(out, _matrix(raw))
        return pd.DataFrame([{"uid": p["uid"].iloc[0], "g": p["g"].iloc[0], "m": out.tobytes()}])

    def scan(name: str, start: Callable[[pd.DataFrame, int], np.ndarray]):
        def run(p: pd.DataFrame) -> pd.DataFrame:
            p = p.sort_values(name)
            size = _matrix(p["m"].iloc[0]).shape[0]
            at, out = start(p, size), []
            for raw in p["m"]:
                out.append(at.tobytes())
                at = (at[:, None] + _matrix(raw)).max(axis=0)
            return pd.DataFrame({"uid": p["uid"], name: p[name], "entry": out})
        return run

    mats = scratch.write(chunks.mapInPandas(matrices, "uid long, c int, g int, m binary"), "matrices")
    products = _grouped(mats, ["uid", "g"], product, "uid long, g int, m binary")
    groups = _grouped(products, ["uid"], scan("g", lambda p, n: np.array([0.0] + [NONE] * (n - 1))), "uid long, g int, entry binary")
    entries = scratch.write(_grouped(mats.join(groups.withColumnRenamed("entry", "e0"), ["uid", "g"]), ["uid", "g"],
                                     scan("c", lambda p, n: np.frombuffer(p["e0"].iloc[0], np.float64).copy()),
                                     "uid long, c int, entry binary"), "entries")
    full = chunks.join(entries, ["uid", "c"])

    def maps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = piece_model(model)
        for b in batches:
            yield pd.DataFrame({"uid": b["uid"], "c": b["c"], "g": b["g"], "f": [
                m.back_map(t, s, np.frombuffer(e, np.float64).tolist()) for t, s, e in zip(b["text"], b["stop"], b["entry"])]})

    def compose(p: pd.DataFrame) -> pd.DataFrame:
        out = None
        for f in p.sort_values("c", ascending=False)["f"]:
            f = np.asarray(f, np.int64)
            out = f if out is None else np.where(out < 0, -1, f[out])
        return pd.DataFrame([{"uid": p["uid"].iloc[0], "g": p["g"].iloc[0], "f": out.tolist()}])

    def follow(name: str):
        def run(p: pd.DataFrame) -> pd.DataFrame:
            p = p.sort_values(name, ascending=False)
            at, out = int(p["j0"].iloc[0]) if "j0" in p else 0, []
            for f in p["f"]:
                out.append(at)
                at = int(f[at])
            return pd.DataFrame({"uid": p["uid"], name: p[name], "j": out})
        return run

    back = scratch.write(full.mapInPandas(maps, "uid long, c int, g int, f array<int>"), "maps")
    tops = _grouped(_grouped(back, ["uid", "g"], compose, "uid long, g int, f array<int>"), ["uid"], follow("g"), "uid long, g int, j int")
    ends = _grouped(back.join(tops.withColumnRenamed("j", "j0"), ["uid", "g"]), ["uid", "g"], follow("c"), "uid long, c int, j int")

    def traces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = piece_model(model)
        for b in batches:
            ids = [m.trace(t, s, np.frombuffer(e, np.float64).tolist(), j) for t, s, e, j in zip(b["text"], b["stop"], b["entry"], b["j"])]
            yield pd.DataFrame({"uid": b["uid"], "c": b["c"], **_told(m, ids, [c == 0 for c in b["c"]], form)})

    return full.join(ends, ["uid", "c"]).mapInPandas(traces, f"uid long, c int, {form}")


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK, form: str = AS_IDS) -> DataFrame:
    """(id, uid, c, chunks, ids or what ``form`` has of them): a row for each document of at most ``chunk``
    characters, and one for each chunk of longer ones, in the order of c; uid
    tells rows of the table apart.  Null and empty texts have no ids.

    The result doesn't depend on ``chunk``, which must not be below the
    longest piece of the model."""
    scratch = Scratch(docs.sparkSession, "pieces")
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"))

    def short(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = piece_model(model)
        for b in batches:
            for at in range(0, len(b), 512):
                part = b.iloc[at:at + 512]
                texts = [m.prepare(t) for t in part["text"]]
                m.learn(texts)
                ids = [m.closed(t) for t in texts]
                yield pd.DataFrame({"id": part["id"], "uid": part["uid"], "c": 0, "chunks": 1, **_told(m, ids, [True] * len(ids), form)})

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = piece_model(model)
        size = max(chunk, m.longest)
        for b in batches:
            for name, uid, text in zip(b["id"], b["uid"], b["text"]):
                text = m.prepare(text)
                n = max(1, len(text) // size)  # the last chunk takes the rest
                for c in range(n):
                    end = len(text) if c == n - 1 else (c + 1) * size
                    yield pd.DataFrame([{"id": name, "uid": uid, "c": c, "g": c // GROUP, "chunks": n, "stop": end - c * size,
                                         "text": text[c * size:end + m.longest - 1]}])

    known = rows.withColumn("uid", F.monotonically_increasing_id())
    schema = f"id {id_type}, uid long, c int, chunks int, {form}"
    simple = known.where(F.length("text") <= chunk).mapInPandas(short, schema)
    long_ = scratch.write(known.where(F.length("text") > chunk).mapInPandas(
        cut, f"id {id_type}, uid long, c int, g int, chunks int, stop int, text string").repartition("uid", "c"), "chunks")
    if long_.isEmpty():
        return simple
    ids = scratch.write(_giant(long_.select("uid", "c", "g", "stop", "text"), model, scratch, form), "giant-ids")
    return simple.unionByName(long_.select("id", "uid", "c", "chunks").join(ids, ["uid", "c"]).select(simple.columns))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """(id, uid, c, text) of ``encode``'s rows; a document's parts joined in
    the order of c are its text."""
    id_type = encoded.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = piece_model(model)
        for b in batches:
            yield pd.DataFrame({"id": b["id"], "uid": b["uid"], "c": b["c"], "text": [
                m.decode(i.tolist(), first=c == 0).decode("utf-8", "replace") for i, c in zip(b["ids"], b["c"])]})

    return encoded.mapInPandas(run, f"id {id_type}, uid long, c int, text string")


def crc_join(a: int, b: int, length: int) -> int:
    """crc32 of two strings one after the other, the second of ``length`` bytes."""
    def over(mat: list[int], vec: int) -> int:
        out, i = 0, 0
        while vec:
            if vec & 1:
                out ^= mat[i]
            vec >>= 1
            i += 1
        return out

    mat = [0xEDB88320] + [1 << i for i in range(31)]  # shift by one zero bit
    n = length * 8
    while n:
        if n & 1:
            a = over(mat, a)
        n >>= 1
        mat = [over(mat, m) for m in mat]
    return a ^ b


def digest(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """Per row: id, n_pieces, score (sum of piece scores), ids_crc32 (ids as
    little-endian 32-bit integers) and decoded_crc32 (UTF-8 of the decoded text)."""
    parts = encode(docs, model, id_col, text_col, chunk, AS_DIGEST)
    id_type = parts.schema["id"].dataType.simpleString()
    parts = Scratch(docs.sparkSession, "pieces-digest").write(parts, "parts")
    out = f"id {id_type}, n_pieces long, score double, ids_crc32 long, decoded_crc32 long"

    def whole(p: pd.DataFrame) -> pd.DataFrame:
        p = p.sort_values("c")
        ids, text = 0, 0
        for n, i, size, t in zip(p["n"], p["ids_crc32"], p["size"], p["text_crc32"]):
            ids, text = crc_join(ids, int(i), 4 * int(n)), crc_join(text, int(t), int(size))
        return pd.DataFrame([{"id": p["id"].iloc[0], "n_pieces": p["n"].sum(), "score": p["score"].sum(), "ids_crc32": ids, "decoded_crc32": text}])

    single = parts.where("chunks = 1").select("id", F.col("n").alias("n_pieces"), "score", "ids_crc32", F.col("text_crc32").alias("decoded_crc32"))
    joined = single.unionByName(_grouped(parts.where("chunks > 1"), ["uid"], whole, out))
    return joined.withColumnRenamed("id", id_col)


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` with the public table of 32,000 pieces: doc_id,
    n_pieces, score, ids_crc32, decoded_crc32."""
    import public_tokenizers
    return digest(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
