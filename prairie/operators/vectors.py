"""Vocabulary, count vectors, TF-IDF and scaling.

A vector is one row with ``entries``: array<struct<idx, v>> in ascending order of idx.
The vocabulary size is a parameter and bounds what is sent to the tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prairie.functions.scalars import idf_ln, idf_log10
from prairie.functions.text import run_lengths
from prairie.operators.ranking import numbered
from prairie.session import stored

SIZE = 20_000
COUNTS = "array<struct<idx:bigint,cnt:bigint>>"
VECTOR = "array<struct<idx:bigint,v:double>>"

Entries = Callable[[pa.ListArray, np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]]


def word_count(docs: DataFrame, words: Column) -> DataFrame:
    return docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def vocabulary(counts: DataFrame, size: int = SIZE) -> DataFrame:
    """``word``, ``n``, ``idx`` from 0 of the ``size`` most frequent words (ties by word).

    The window sees ``size`` rows; :func:`all_ranks` numbers every word.
    """
    top = counts.orderBy(F.desc("n"), "word").limit(size)
    return top.withColumn("idx", (F.row_number().over(Window.orderBy(F.desc("n"), "word")) - 1).cast("long"))


def all_ranks(counts: DataFrame) -> DataFrame:
    """``word``, ``n`` and ``idx`` from 0 of all words, the most frequent first (ties by word)."""
    return numbered(counts, F.desc("n"), "word")


def word_ranks(vocab: DataFrame, words: list[str]) -> DataFrame:
    """The index of each given word, -1 if it has none."""
    spark = vocab.sparkSession
    asked = spark.createDataFrame([(w,) for w in words], "word string")
    return asked.join(vocab.select("word", "idx"), "word", "left").select("word", F.coalesce("idx", F.lit(-1).cast("long")).alias("idx"))


def indexed(docs: DataFrame, key: str, words: Column, vocab: DataFrame) -> DataFrame:
    """(key, idx, cnt) in long form; words outside the vocabulary are dropped.

    Words are counted inside the row first, so that one row per distinct word is joined.
    """
    return indexed_bags(docs.select(key, run_lengths(words).alias("bag")), key, vocab)


def indexed_bags(bags: DataFrame, key: str, vocab: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """:func:`indexed` of words that are counted already; ``keep`` names columns that follow, without a join."""
    each = bags.select(key, *keep, F.explode("bag").alias("w")).select(key, *keep, F.col("w.word").alias("word"), F.col("w.cnt").alias("cnt"))
    # The vocabulary has ``size`` rows at most.
    return each.join(F.broadcast(vocab.select("word", "idx")), "word").select(key, "idx", "cnt", *keep)


def bag(words: Column) -> Column:
    """Word counts of a row, none for null."""
    return F.coalesce(run_lengths(words), F.array().cast("array<struct<word:string,cnt:bigint>>"))


def _in_rows(rows: DataFrame, lists: str, keep: tuple[str, ...], kind: str, make: Entries) -> DataFrame:
    """``keep`` and ``entries`` of every row, made of its list in batches; no row leaves its task.

    ``make`` gets the lists and the row of each element, and returns row, idx and value of
    each entry, in order.
    """
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep)
    value = "cnt" if kind == COUNTS else "v"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(lists)
            sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
            row, idx, values = make(column, np.repeat(np.arange(len(column)), sizes))
            ends = np.bincount(row, minlength=len(column)).cumsum()
            inner = pa.StructArray.from_arrays([pa.array(idx, pa.int64()), pa.array(values)], ["idx", value])
            entries = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), inner)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), entries], [*keep, "entries"])

    return rows.select(*dict.fromkeys(keep), lists).mapInArrow(run, f"{schema}, entries {kind}")


def counted(bags: DataFrame, vocab: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``entries`` (idx, cnt) of every ``bag``; words outside the vocabulary are dropped.

    The vocabulary has ``size`` rows at most and is sent to the tasks.
    """
    words = pa.array([r["word"] for r in vocab.select("word", "idx").orderBy("idx").collect()], pa.string())

    def make(lists: pa.ListArray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = lists.flatten()
        place = pc.fill_null(pc.index_in(inner.field("word"), words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        known = place >= 0
        row, place, cnt = row[known], place[known], inner.field("cnt").to_numpy(zero_copy_only=False)[known]
        order = np.argsort(row * max(len(words), 1) + place)
        return row, place[order], cnt[order]

    return _in_rows(bags, "bag", keep, COUNTS, make)


def valued(counts: DataFrame, factors: DataFrame, value: Callable[..., np.ndarray], *keep: str) -> DataFrame:
    """``keep`` and ``entries`` (idx, v) of rows of counts; indices without factors are dropped.

    ``value`` gets the counts, the sums of counts of their rows, and ``factors``' columns other
    than ``idx`` by name. The factors have as many rows as the vocabulary at most.
    """
    names = [c for c in factors.columns if c != "idx"]
    found = factors.select("idx", *names).collect()
    at = np.array([r["idx"] for r in found], np.int64)
    table = {c: np.zeros(int(at.max(initial=-1)) + 1) for c in names}
    known = np.zeros(len(next(iter(table.values()))), bool)
    known[at] = True
    for c in names:
        table[c][at] = [r[c] for r in found]

    def make(lists: pa.ListArray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inner = lists.flatten()
        idx, cnt = (inner.field(c).to_numpy(zero_copy_only=False) for c in ("idx", "cnt"))
        total = np.bincount(row, cnt, len(lists))[row]
        has = np.append(known, False)[np.minimum(idx, len(known))]
        row, idx, cnt, total = (x[has] for x in (row, idx, cnt, total))
        return row, idx, value(cnt, total, **{c: t[idx] for c, t in table.items()})

    return _in_rows(counts, "entries", keep, VECTOR, make)


@dataclass(frozen=True)
class Corpus:
    """Documents over their own vocabulary; all tables are written, the texts were read once."""

    key: str
    bags: DataFrame  # key, bag: array<struct<word, cnt>>, and what was to be kept
    vocab: DataFrame  # word, n, idx
    counts: DataFrame  # key, entries: array<struct<idx, cnt>>, and what was to be kept
    n: int  # documents

    @property
    def long(self) -> DataFrame:
        """key, idx, cnt, and what was to be kept."""
        keep = [c for c in self.counts.columns if c not in (self.key, "entries")]
        each = self.counts.select(self.key, F.explode("entries").alias("e"), *keep)
        return each.select(self.key, "e.idx", "e.cnt", *keep)

    def norm_vectors(self) -> DataFrame:
        """key and ``entries`` of :meth:`tfidf_norm`, a row for each document."""
        idf = self.frequency().select("idx", idf_log10(F.lit(self.n), "df").alias("idf"))
        return valued(self.counts, idf, lambda cnt, total, idf: cnt / total * idf, self.key)

    def frequency(self) -> DataFrame:
        return document_frequency(self.long)

    def tfidf_norm(self) -> DataFrame:
        return tfidf_norm(self.long, self.key, self.frequency(), self.n)

    def tfidf_raw(self) -> DataFrame:
        return tfidf_raw(self.long, self.key, self.frequency(), self.n)


def corpus(docs: DataFrame, key: str, words: Column, size: int = SIZE, keep: tuple[str, ...] = ()) -> Corpus:
    """Word counts of ``docs`` over their ``size`` most frequent words; a null text has no words.

    ``keep`` names columns that stay beside the bags and the counts.
    """
    bags = stored(docs.select(key, *keep, bag(words).alias("bag")), "bags")
    each = bags.select(F.explode("bag").alias("w")).select("w.word", "w.cnt")
    vocab = stored(vocabulary(each.groupBy("word").agg(F.sum("cnt").alias("n")), size), "vocabulary")
    return Corpus(key, bags, vocab, stored(counted(bags, vocab, key, *keep), "counts"), bags.count())


def document_frequency(long: DataFrame) -> DataFrame:
    """Documents that hold each index; ``long`` has an index once per document."""
    return long.groupBy("idx").agg(F.count("*").alias("df"))


def tfidf_norm(long: DataFrame, key: str, df: DataFrame, n: int) -> DataFrame:
    """Share of the document's vocabulary words times log10(n / df)."""
    total = F.sum("cnt").over(Window.partitionBy(key))
    idf = F.broadcast(df.select("idx", idf_log10(F.lit(n), "df").alias("idf")))
    return long.withColumn("tf", F.col("cnt") / total).join(idf, "idx").select(key, "idx", (F.col("tf") * F.col("idf")).alias("v"))


def tfidf_raw(long: DataFrame, key: str, df: DataFrame, n: int) -> DataFrame:
    """Count times ln(n / df); zeros are dropped."""
    idf = F.broadcast(df.select("idx", idf_ln(F.lit(n), "df").alias("idf")))
    return long.join(idf, "idx").select(key, "idx", (F.col("cnt") * F.col("idf")).alias("v")).where("v <> 0")


def moments(long: DataFrame, n: int) -> DataFrame:
    """Mean and population deviation of each index over all ``n`` documents, absent entries as 0."""
    sums = long.groupBy("idx").agg(F.sum("v").alias("s"), F.sum(F.col("v") * F.col("v")).alias("q"))
    mean = F.col("s") / n
    std = F.sqrt(F.greatest(F.col("q") / n - mean * mean, F.lit(0.0)))
    return sums.select("idx", mean.alias("mean"), F.when(std < 1e-12, 0.0).otherwise(std).alias("std"))


def standardised(long: DataFrame, key: str, stats: DataFrame) -> DataFrame:
    """(v - mean) / std of stored entries only; indices without variance are dropped."""
    known = F.broadcast(stats.where("std > 0"))
    return long.join(known, "idx").select(key, "idx", ((F.col("v") - F.col("mean")) / F.col("std")).alias("v"))


def scaled(long: DataFrame, key: str, factors: DataFrame, value: str = "cnt") -> DataFrame:
    """Each entry times the factor (``f``) of its index."""
    return long.join(F.broadcast(factors), "idx").select(key, "idx", (F.col(value) * F.col("f")).alias("v"))


def gathered(long: DataFrame, docs: DataFrame, key: str, value: str = "v") -> DataFrame:
    """One row for each document: ``entries`` in order; empty for documents without any."""
    entries = F.sort_array(F.collect_list(F.struct("idx", F.col(value).alias("v"))))
    rows = long.groupBy(key).agg(entries.alias("entries"))
    return docs.select(key).join(rows, key, "left").select(key, F.coalesce(F.col("entries").cast(VECTOR), F.array().cast(VECTOR)).alias("entries"))
