"""Rule bitmask ledger: every rule is evaluated once, policies are applied to the bits.

The ledger holds, for each document, its measurements and one bit for each rule that it
fails. A policy is a version name and a mask of the rules that count; applying one, or
counting what each rule alone removes, reads only the ledger and never the text again.

Defined results: a null text counts as an empty one (no words, fails ``few_words``); repeated
rows are separate documents; other columns of the input are not touched and may have any
name, as the ledger selects only what it needs; an empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prairie.llm.columns import let, quoted, whole, words
from prairie.session import table

SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclaim", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[Column], Column]  # of the struct of measurements


#: The place in this tuple is the bit; new rules go to the end, so that old ledgers stay valid.
RULES = (
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_words", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
    Rule("symbols", lambda m: 10 * m.n_symbols > m.n_words),
    Rule("repeated_lines", lambda m: 100 * m.n_dup_lines > 50 * m.n_lines),
    Rule("word_length", lambda m: (m.word_chars < 2 * m.n_words) | (m.word_chars > 40 * m.n_words)),
    Rule("exclamations", lambda m: 10 * m.n_exclaim > 3 * m.n_words),
)


def mask(*names: str) -> int:
    bits = {rule.name: 1 << i for i, rule in enumerate(RULES)}
    return sum(bits[name] for name in names)


POLICIES = {
    "base": mask("few_words", "repeated_words"),
    "v1": mask("few_words", "repeated_words", "symbols", "repeated_lines"),
    "v2": mask(*(rule.name for rule in RULES)),
}


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def _covered(windows: Column, width: int) -> Column:
    """Words inside a window whose hash occurs at least twice in the array ``windows``."""

    def marked(pairs: Column) -> Column:
        def at(s: Column, i: Column) -> Column:
            before, after = F.get(pairs, i - 1), F.get(pairs, i + 1)
            twice = F.coalesce(before.h == s.h, F.lit(False)) | F.coalesce(after.h == s.h, F.lit(False))
            return F.when(twice, s.p)

        return F.sort_array(F.filter(F.transform(pairs, at), lambda p: p.isNotNull()))

    def spread(starts: Column) -> Column:
        gaps = F.transform(
            starts,
            lambda p, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - p, F.lit(width))),
        )
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, x: acc + x)

    pairs = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("p"))))
    return let(let(pairs, marked), spread)


def _repeated(hashes: Column, width: int) -> Column:
    windows = F.when(
        F.size(hashes) >= width,
        F.transform(
            F.sequence(F.lit(1), F.size(hashes) - (width - 1)),
            lambda i: F.xxhash64(F.slice(hashes, i, F.lit(width))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    return let(
        windows,
        # Sorting is for texts that have a repeated window at all.
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("long")).otherwise(
            _covered(w, width)
        ),
    )


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """``key``, the columns ``keep``, and the measurements of every whole text.

    Windows of words are compared by a 64-bit hash, within one text only.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(
        key,
        *keep,
        F.length(body).cast("long").alias("_chars"),
        _count(body, " \t\n\x0b\x0c\r").alias("_blanks"),
        _count(body, SYMBOLS).alias("n_symbols"),
        _count(body, "!").alias("n_exclaim"),
        F.transform(words(body), lambda w: F.xxhash64(w)).alias("_words"),
        F.filter(
            F.split(body, "\n", -1), lambda line: F.length(F.translate(line, " \t\x0b\x0c\r", "")) > 0
        ).alias("_lines"),
    )
    n_lines = F.size("_lines").cast("long")
    return split.select(
        key,
        *keep,
        F.size("_words").cast("long").alias("n_words"),
        (F.col("_chars") - F.col("_blanks")).alias("word_chars"),
        "n_symbols",
        "n_exclaim",
        n_lines.alias("n_lines"),
        (n_lines - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        let(F.col("_words"), lambda w: _repeated(w, WINDOW)).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """The measurements, and ``failed``: the bits of the rules that the text fails."""
    rows = measured(docs, key, text, *keep)
    m = F.struct(*MEASURES)
    bits = let(
        m,
        lambda s: sum(
            (F.when(rule.fails(s), F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(RULES)),
            F.lit(0),
        ),
    )
    return rows.withColumn("failed", bits.cast("long"))


def passes(failed: Column, policy: str) -> Column:
    return failed.bitwiseAND(F.lit(POLICIES[policy])) == 0


def ablation(rows: DataFrame, *policies: str) -> DataFrame:
    """For each policy and each of its rules: documents that fail it, and that fail only it.

    The ledger is first counted by its bits: one shuffled row for each pattern of failures,
    at most 2 to the number of rules, whatever the number of documents.
    """
    patterns = rows.groupBy("failed").agg(F.count("*").alias("docs"))
    cases = [
        F.struct(F.lit(p).alias("policy"), F.lit(POLICIES[p]).alias("mask"), F.lit(rule.name).alias("rule"), F.lit(1 << i).alias("bit"))
        for p in policies or POLICIES
        for i, rule in enumerate(RULES)
        if POLICIES[p] >> i & 1
    ]
    each = patterns.withColumn("c", F.explode(F.array(*cases))).select("failed", "docs", "c.*")
    seen = F.col("failed").bitwiseAND(F.col("mask"))
    n = lambda cond: F.sum(F.when(cond, F.col("docs")).otherwise(0))
    return each.groupBy("policy", "rule").agg(
        n(F.col("failed").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        n(seen == F.col("bit")).alias("n_only"),
        n(seen == 0).alias("n_kept"),
        n(seen.bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"),
    )


def op10_quality(spark, sf_dir: str) -> DataFrame:
    rows = ledger(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (~passes(F.col("failed"), "base")).alias("base_failed"),
        passes(F.col("failed"), "v2").alias("kept"),
        "failed",
    )


def ablation_report(spark, sf_dir: str) -> DataFrame:
    return ablation(ledger(table(spark, sf_dir, "documents")))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the newest policy, with all their columns."""
    named = docs.select(whole(docs).alias("_row"), quoted("text").alias("_text"))
    # A number that is made row by row keeps the filter above the measurements: pushed below,
    # it would make the word list again for each use.
    rows = ledger(named, "_row", "_text").withColumn("_number", F.monotonically_increasing_id())
    return rows.where(passes(F.col("failed"), "v2") & (F.col("_number") >= 0)).select("_row.*")


_LEDGER = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d),
x AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS p FROM w),
g AS (
  SELECT r, p, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' ||
    lead(w, 4) OVER o || ' ' || lead(w, 5) OVER o || ' ' || lead(w, 6) OVER o || ' ' || lead(w, 7) OVER o AS v
  FROM x WINDOW o AS (PARTITION BY r ORDER BY p)),
h AS (SELECT r, p, count(*) OVER (PARTITION BY r, v) AS n FROM g WHERE v IS NOT NULL),
c AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 8)) AS q FROM h WHERE n > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (length(t) - length(replace(t, '!', '')))::BIGINT AS n_exclaim,
    len(ls)::BIGINT AS n_lines,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN c USING (r)),
f AS (
  SELECT *, ((n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT
    + 4 * (10 * n_symbols > n_words)::BIGINT + 8 * (100 * n_dup_lines > 50 * n_lines)::BIGINT
    + 16 * (word_chars < 2 * n_words OR word_chars > 40 * n_words)::BIGINT
    + 32 * (10 * n_exclaim > 3 * n_words)::BIGINT)::BIGINT AS failed
  FROM m)
"""

QUERIES = {"op10_quality": op10_quality, "quality_ablation": ablation_report}
SQL = {
    "op10_quality": _LEDGER
    + """SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (failed & 3) <> 0 AS base_failed, failed = 0 AS kept, failed FROM f""",
    "quality_ablation": _LEDGER
    + """, r AS (SELECT * FROM (VALUES ('few_words', 1), ('repeated_words', 2), ('symbols', 4),
  ('repeated_lines', 8), ('word_length', 16), ('exclamations', 32)) AS v(rule, bit)),
p AS (SELECT * FROM (VALUES ('base', 3), ('v1', 15), ('v2', 63)) AS v(policy, mask)),
b AS (SELECT failed, count(*) AS docs FROM f GROUP BY failed)
SELECT policy, rule, sum(CASE WHEN failed & bit <> 0 THEN docs ELSE 0 END)::BIGINT AS n_failed,
  sum(CASE WHEN failed & mask = bit THEN docs ELSE 0 END)::BIGINT AS n_only,
  sum(CASE WHEN failed & mask = 0 THEN docs ELSE 0 END)::BIGINT AS n_kept,
  sum(CASE WHEN failed & mask & ~bit = 0 THEN docs ELSE 0 END)::BIGINT AS n_kept_without
FROM b, p, r WHERE mask & bit <> 0 GROUP BY policy, rule""",
}
