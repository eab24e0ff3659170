"""Tokens and in-row word counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prairie.functions import as_column


def words_ascii(c) -> Column:
    """Runs of ASCII letters, then lower-cased."""
    return _non_empty(F.split(F.lower(F.regexp_replace(as_column(c), "[^a-zA-Z]+", " ")), " "))


def words_lowered(c) -> Column:
    """Lower-cased first, then runs of ASCII letters.

    Differs from :func:`words_ascii` on letters whose lower case is ASCII (Kelvin sign).
    """
    return _non_empty(F.split(F.regexp_replace(F.lower(as_column(c)), "[^a-z]+", " "), " "))


def _non_empty(words: Column) -> Column:
    return F.array_remove(words, "")


def run_lengths(words) -> Column:
    """``array<struct<word, cnt>>``: the word counts of one row, by word.

    Counting inside the row needs no shuffle, unlike a group by (row, word). The sorted
    array is computed once per row, however often it is looked at.
    """
    ordered = F.array_sort(as_column(words))
    return F.get(F.transform(F.array(ordered), _runs), F.lit(0))


def _runs(s: Column) -> Column:
    n = F.size(s)
    first = F.filter(
        F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)),
    )
    return F.get(F.transform(F.array(first), lambda f: _counts(s, f, n)), F.lit(0))


def _counts(s: Column, first: Column, n: Column) -> Column:
    after = F.when(n > 0, F.concat(F.slice(first, 2, n), F.array(n))).otherwise(first)
    return F.zip_with(
        first, after, lambda a, b: F.struct(F.get(s, a).alias("word"), (b - a).cast("long").alias("cnt"))
    )
