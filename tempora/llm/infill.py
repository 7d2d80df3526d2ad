"""Fill-in-the-middle rows by a pipeline of pyarrow.compute kernels.

A batch of texts is split into list arrays of lines; the lists are flattened with
their parent indices, each line gets its ordinal in its text, lines are
filtered by role (prefix, middle, suffix), the roles' lists are rebuilt from their sizes,
and every piece is joined again by ``binary_join``.  No step goes through rows
one by one.  Cuts and forms come from a seeded hash of the document's id, so
any run, partitioning or retry gives the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import col, table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, INFILL_PERCENT, SPM_PERCENT = 7, 100, 50
#: Texts of about so many bytes go through the kernels together (a longer text alone).
SLICE_BYTES = 4 << 20


def draws(id_text: Column, seed: int = SEED) -> list[Column]:
    """The first four groups of 8 hex digits of sha256(``seed:id``) as longs;
    a null id is the empty string."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def text(value: str) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


def _mod(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _offsets(sizes: pa.Array) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes.to_numpy(zero_copy_only=False))]), pa.int64())


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array, pa.Array, pa.Array]:
    """Lines of a batch, flat: (line with its line feed, parent row, ordinal in
    the row), and the number of lines a row.  What follows the last line feed is a line if not empty."""
    parts = pc.split_pattern(texts, "\n")
    size = pc.cast(pc.list_value_length(parts), pa.int64())
    flat, parent = pc.list_flatten(parts), pc.cast(pc.list_parent_indices(parts), pa.int64())
    first = _offsets(size)[:-1]
    ordinal = pc.subtract(pa.array(np.arange(len(flat))), pc.take(first, parent))
    last = pc.equal(ordinal, pc.subtract(pc.take(size, parent), 1))
    line = pc.binary_join_element_wise(flat, pc.if_else(last, text(""), text("\n")), text(""))
    there = pc.greater(pc.binary_length(line), 0)  # only a last part can be empty
    lost = pc.cast(pc.equal(pc.binary_length(pc.take(flat, pc.subtract(pc.add(first, size), 1))), 0), pa.int64())
    return line.filter(there), parent.filter(there), ordinal.filter(there), pc.subtract(size, lost)


def _joined(lines: pa.Array, mask: pa.Array, sizes: pa.Array) -> pa.Array:
    """The masked lines as one string a row; ``sizes`` says how many a row has."""
    return pc.binary_join(pa.LargeListArray.from_arrays(_offsets(sizes), lines.filter(mask)), text(""))


def infill_batch(texts: pa.Array, h: list[pa.Array], infill_percent: int, spm_percent: int) -> list[pa.Array]:
    """n, form, prefix_chars, middle_chars, output of a batch of texts without nulls."""
    texts = pc.cast(texts, pa.large_string())
    lines, parent, ordinal, n = units(texts)
    cuts = [_mod(x, pc.add(n, 1)) for x in h[:2]]
    low, high = pc.min_element_wise(*cuts), pc.max_element_wise(*cuts)
    before, after = pc.less(ordinal, pc.take(low, parent)), pc.greater_equal(ordinal, pc.take(high, parent))
    prefix = _joined(lines, before, low)
    middle = _joined(lines, pc.invert(pc.or_(before, after)), pc.subtract(high, low))
    suffix = _joined(lines, after, pc.subtract(n, high))
    marked = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(_mod(h[2], hundred), infill_percent))
    spm = pc.less(_mod(h[3], hundred), spm_percent)
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    psm_out = pc.binary_join_element_wise(text(PREFIX), prefix, text(SUFFIX), suffix, text(MIDDLE), middle, text(""))
    spm_out = pc.binary_join_element_wise(text(SUFFIX), suffix, text(PREFIX), prefix, text(MIDDLE), middle, text(""))
    output = pc.if_else(plain, texts, pc.if_else(spm, spm_out, psm_out))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.cast(pc.utf8_length(x), pa.int64())) for x in (prefix, middle)]
    return [n, form, *chars, output]


def restore_batch(output: pa.Array, form: pa.Array) -> pa.Array:
    """The texts again, from output and form alone.  Marks occur once each in
    what isn't plain."""
    output = pc.cast(output, pa.large_string())
    plain = pc.equal(form, "plain")
    parts = pc.split_pattern_regex(pc.if_else(plain, text(PREFIX + SUFFIX + MIDDLE), output), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    one, two, middle = (pc.list_element(parts, k) for k in (1, 2, 3))
    spm = pc.equal(form, "spm")
    whole = pc.binary_join_element_wise(pc.if_else(spm, two, one), middle, pc.if_else(spm, one, two), text(""))
    return pc.if_else(plain, output, whole)


def _slices(texts: pa.Array) -> Iterator[slice]:
    size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = size[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(size, done + SLICE_BYTES, side="right")))
        yield slice(at, end)
        at = end


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED,
              infill_percent: int = INFILL_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """One row per document: id (its type kept), n, form, prefix_chars,
    middle_chars, output.

    A null text is empty; an empty text, one that holds a mark, or one that the
    hash leaves out stays plain, with null piece lengths.  A null id is drawn
    as the empty string.  Rows with the same id are cut by the same draws, each
    in its own text; repeated rows stay repeated; an empty table gives an empty
    one.  Texts are taken whole, in slices of SLICE_BYTES.  Only the two named columns
    are read, so other columns, whatever their names, don't matter."""
    kind = dict(docs.dtypes)[id_col]
    picked = docs.select(col(id_col).alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
                         *[x.alias(f"h{k}") for k, x in enumerate(draws(col(id_col).cast("string"), seed))])
    names = ["id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in _slices(b.column(1)):
                part = b.slice(s.start, s.stop - s.start)
                got = infill_batch(part.column(1), [part.column(k) for k in range(2, 6)], infill_percent, spm_percent)
                got[1], got[4] = got[1].cast(pa.string()), got[4].cast(pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), *got], names)

    return picked.mapInArrow(run, f"id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(rows: DataFrame) -> DataFrame:
    """Rows with ``output`` and ``form`` get ``restored``, the exact text; all
    other columns of :func:`transform` stay.  A null output or form gives null."""
    schema = rows.select("*", F.lit("").alias("restored")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in _slices(pc.fill_null(b.column("output"), "")):
                part = b.slice(s.start, s.stop - s.start)
                whole = restore_batch(part.column("output"), part.column("form")).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns, whole], [*part.schema.names, "restored"])

    return rows.mapInArrow(run, schema)


def op12_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, n, form, prefix_chars, middle_chars, and the
    hashes of the output and of the text restored from it."""
    rows = restore(transform(table(spark, sf_dir, "documents")))
    digest = lambda c: F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256")
    return rows.select(F.col("id").alias("doc_id"), "n", "form", "prefix_chars", "middle_chars", digest("output"), digest("restored"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, t, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u,
             CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
             CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
c AS (SELECT *, CAST(len(u) AS BIGINT) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a,
             greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b FROM u),
p AS (SELECT *, array_to_string(u[1:a], '') AS pre, array_to_string(u[a + 1:b], '') AS mid, array_to_string(u[b + 1:], '') AS suf,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p"""
