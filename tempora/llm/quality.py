"""Quality rules as a short-circuit cascade of column expressions.

Each rule is one boolean expression over the text.  On a bounded sample the
rules' cost (seconds) and rejection rate are measured, and the rules are put
in order of rejection per cost.  The cascade is one CASE expression: a later
rule's expression is not evaluated for a row that an earlier rule rejects.
The order changes the time and the name of the rejecting rule, never which
rows stay."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import SPACE_CHARS, SPACES, Scratch, col, fresh, table

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: The bound of the sample for costs: rows, and characters in each.
SAMPLE_ROWS, SAMPLE_CHARS = 1000, 1 << 16


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once for each row."""
    return F.transform(F.array(value), body)[0]


def whole(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; none: an empty array."""
    return let(F.btrim(text, F.lit(SPACE_CHARS)),
               lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACES)))


def chars_of(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def word_chars(text: Column) -> Column:
    return F.length(F.translate(text, SPACE_CHARS, ""))


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")


def repeated_words(w: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the array ``w``.

    Windows are sorted with their position; equal neighbours give the
    positions; each covers three words, or as many as the next one leaves."""
    def covered(pos: Column) -> Column:
        steps = F.arrays_zip(F.slice(pos, 1, F.size(pos)), F.slice(pos, 2, F.size(pos)))
        # least() skips the null that stands for "no next position"
        return F.aggregate(steps, F.lit(0), lambda n, s: n + F.least(F.lit(3), s["1"] - s["0"]))

    def positions(pairs: Column) -> Column:
        return F.sort_array(F.array_distinct(F.concat(
            F.transform(pairs, lambda p: p["0"]["3"]), F.transform(pairs, lambda p: p["1"]["3"]))))

    def equal(p: Column) -> Column:
        return (p["0"]["0"] == p["1"]["0"]) & (p["0"]["1"] == p["1"]["1"]) & (p["0"]["2"] == p["1"]["2"])

    def pairs(s: Column) -> Column:
        return F.filter(F.arrays_zip(F.slice(s, 1, F.size(s)), F.slice(s, 2, F.size(s))), equal)

    n = F.size(w)
    windows = F.slice(F.arrays_zip(F.slice(w, 1, n), F.slice(w, 2, n), F.slice(w, 3, n), F.sequence(F.lit(0), n - 1)), F.lit(1), n - 2)
    return F.when(n < 4, F.lit(0)).otherwise(
        let(F.sort_array(windows), lambda s: let(pairs(s), lambda p: let(positions(p), covered))))


@dataclass(frozen=True)
class Rule:
    """``fails`` takes the text column (never null) and gives a boolean."""
    name: str
    fails: Callable[[Column], Column]


def _few_words(t: Column) -> Column:
    return F.size(words(t)) < MIN_WORDS


def _repeats(t: Column) -> Column:
    return let(words(t), lambda w: 100 * repeated_words(w) > MAX_REPEAT_PERCENT * F.size(w))


def _symbols(t: Column) -> Column:
    return 50 * chars_of(t, SYMBOLS) > F.length(t)


def _exclamation(t: Column) -> Column:
    return 20 * chars_of(t, "!") > F.length(t)


def _capitals(t: Column) -> Column:
    letters = F.length(F.regexp_replace(t, r"[^\p{L}]+", ""))
    lower = F.length(F.regexp_replace(t, r"[^\p{L}]+|\p{Lu}+", ""))
    return 2 * (letters - lower) > letters


def _same_lines(t: Column) -> Column:
    return let(lines_with_words(t), lambda x: 5 * (F.size(x) - F.size(F.array_distinct(x))) > 2 * F.size(x))


def _long_words(t: Column) -> Column:
    return word_chars(t) > 20 * (chars_of(t, SPACE_CHARS) + 1)


#: Rejected: under 50 words; over half of the words in repeated windows.
BASE_RULES = [Rule("few_words", _few_words), Rule("repeated_windows", _repeats)]
#: Rejected: over 2 % symbols; over 5 % exclamation marks; over half of the
#: letters capital; over 40 % of the lines repeated; over 20 characters a word.
EXTRA_RULES = [Rule("symbols", _symbols), Rule("exclamation", _exclamation), Rule("capitals", _capitals),
               Rule("repeated_lines", _same_lines), Rule("long_words", _long_words)]


def rank_rules(docs: DataFrame, rules: list[Rule], text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """(rule, rejection rate, seconds) in the order of rejection per cost,
    measured on at most ``sample_rows`` rows of at most SAMPLE_CHARS characters,
    from the first partitions that have as many.  Ties: the given order."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "quality")
    few = docs.select(whole(col(text_col)).alias("t")).where(F.length("t") <= SAMPLE_CHARS).limit(sample_rows).collect()
    sample = scratch.write(spark.createDataFrame(few, "t string").coalesce(1), "sample")

    def measure(c: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            began = time.perf_counter()
            share = sample.agg(F.avg(c.cast("int"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - began)
        return best, float(share)

    idle, _ = measure(F.length("t") < 0)
    found = []
    for rule in rules:
        seconds, share = measure(rule.fails(F.col("t")))
        found.append((rule, share, max(seconds - idle, 1e-4)))
    scratch.drop(sample)
    return sorted(found, key=lambda x: -x[1] / x[2])


def rejected_by(text: Column, rules: list[Rule]) -> Column:
    """Name of the first rule that rejects the text; null: none does."""
    out = F.when(rules[0].fails(text), F.lit(rules[0].name))
    for rule in rules[1:]:
        out = out.when(rule.fails(text), F.lit(rule.name))
    return out


def filter_quality(docs: DataFrame, text_col: str = "text", rules: list[Rule] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` without the rows that any rule rejects; all columns stay.
    Null text counts as empty; empty text has too few words; repeated rows
    share their verdict; an empty table stays empty."""
    rules = [r for r, _, _ in rank_rules(docs, rules or BASE_RULES + EXTRA_RULES, text_col, sample_rows)]
    return docs.where(rejected_by(whole(col(text_col)), rules).isNull())


def assess(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per row: id, counts, base_failed, kept, and rejected_by ("base" or a
    rule's name).  Null text counts as empty."""
    extra = [r for r, _, _ in rank_rules(docs, EXTRA_RULES, text_col, sample_rows)]

    def verdict(s: Column, t: Column) -> Column:
        failed = (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])
        return let(F.when(failed, F.lit("base")).otherwise(rejected_by(t, extra)),
                   lambda by: F.struct(s.alias("s"), failed.alias("failed"), by.alias("by")))

    def counts(w: Column, t: Column) -> Column:
        dup = let(lines_with_words(t), lambda x: F.size(x) - F.size(F.array_distinct(x)))
        return F.struct(F.size(w).cast("long").alias("n_words"), word_chars(t).cast("long").alias("word_chars"),
                        chars_of(t, SYMBOLS).cast("long").alias("n_symbols"), dup.cast("long").alias("n_dup_lines"),
                        repeated_words(w).cast("long").alias("n_repeat_words"))

    def row(t: Column) -> Column:
        return let(let(words(t), lambda w: counts(w, t)), lambda s: verdict(s, t))

    v = docs.select(col(id_col).alias("id"), let(whole(col(text_col)), row).alias("v"))
    return v.select(F.col("id").alias(id_col), "v.s.*", F.col("v.failed").alias("base_failed"),
                    F.col("v.by").isNull().alias("kept"), F.col("v.by").alias("rejected_by"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept."""
    return assess(table(spark, sf_dir, "documents")).drop("rejected_by")


_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"
VERDICT_SQL = r"""
       (50 * length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) > length(t)
        OR 20 * length(regexp_replace(t, '[^!]+', '', 'g')) > length(t)
        OR 2 * length(regexp_replace(t, '\P{Lu}+', '', 'g')) > length(regexp_replace(t, '\P{L}+', '', 'g'))
        OR 5 * n_dup_lines > 2 * n_lines
        OR length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))
           > 20 * (length(t) - length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) + 1))"""
SIGNALS_SQL = rf"""
d AS (SELECT row_number() OVER () AS rid, * FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
w AS (SELECT rid, {_WORDS} AS w FROM d),
win AS (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
rep AS (SELECT rid, i FROM (SELECT *, count(*) OVER (PARTITION BY rid, a, b, c) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS x FROM d),
dup AS (SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines FROM ln
        WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY rid),
s AS (SELECT d.*, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, coalesce(n_lines, 0) AS n_lines,
        coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
      FROM d JOIN w USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid))"""
OP3_SQL = rf"""WITH {SIGNALS_SQL}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND NOT {VERDICT_SQL} AS kept
FROM s"""
