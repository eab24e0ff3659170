"""Set and ranking operators that are more than one DataFrame call."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_scalar(df: DataFrame, one: DataFrame) -> DataFrame:
    """Every row with the columns of a one-row aggregate. One row is all that is sent."""
    return df.crossJoin(F.broadcast(one))


def top_with_ties(df: DataFrame, by: str) -> DataFrame:
    """The rows that hold the largest value, ties and duplicates included.

    By the maximum, not by a rank over everything: no task gathers the ties.
    """
    return with_scalar(df, df.agg(F.max(by).alias("_top"))).where(F.col(by) == F.col("_top")).drop("_top")


def not_in(df: DataFrame, key: str, listed: DataFrame, item: str) -> DataFrame:
    """SQL's ``key NOT IN (listed)`` with its NULL rules.

    An empty list keeps every row; a NULL in the list keeps none; a NULL key is kept only by
    an empty list. The list is not sent whole: its count and its NULLs decide, then an anti-join.
    """
    state = listed.agg(F.count("*").alias("_n"), F.count_if(F.col(item).isNull()).alias("_nulls"))
    known = listed.select(F.col(item).alias(key)).where(F.col(key).isNotNull()).distinct()
    left = with_scalar(df.join(known, key, "left_anti"), state)
    return left.where((F.col("_n") == 0) | ((F.col("_nulls") == 0) & F.col(key).isNotNull())).select(*df.columns)


def _alike(left: DataFrame, right: DataFrame, key: str, how: str) -> DataFrame:
    """A join on ``key`` in which null is a value as in a grouping."""
    other = right.withColumnRenamed(key, "_other")
    return left.join(other, F.col(key).eqNullSafe(F.col("_other")), how).drop("_other")


def divide(pairs: DataFrame, key: str, item: str, divisor: DataFrame, candidates: DataFrame | None = None, mode: str = "forall") -> DataFrame:
    """Keys that are paired with every row of ``divisor`` (a column ``item``).

    With an empty divisor ``forall`` gives all candidates, ``difference`` none. Counting the
    matched items needs no product of keys and items. A null key is a key, a null item an item.
    """
    wanted = divisor.select(item).distinct()
    total = wanted.agg(F.count("*").alias("_total"))
    matched = _alike(pairs.select(key, item).distinct(), wanted, item, "left_semi").groupBy(key).agg(F.count("*").alias("_n"))
    own = (candidates if candidates is not None else pairs).select(key).distinct()
    found = with_scalar(_alike(own, matched, key, "left"), total).where(F.coalesce("_n", F.lit(0)) == F.col("_total"))
    return (found.where("_total > 0") if mode == "difference" else found).select(key)


def jaccard_to(pairs: DataFrame, key: str, item: str, who) -> DataFrame:
    """Similarity of each other key's set of items to that of ``who``; null is a key and an item."""
    sets = pairs.select(key, item).distinct()
    same = F.col(key).eqNullSafe(F.lit(who))
    own, others = sets.where(same).select(item), sets.where(~same)
    sizes = others.groupBy(key).agg(F.count("*").alias("n"))
    shared = _alike(others, own, item, "left_semi").groupBy(key).agg(F.count("*").alias("shared"))
    each = with_scalar(_alike(sizes, shared, key, "left"), own.agg(F.count("*").alias("m")))
    both = F.coalesce("shared", F.lit(0)).cast("double")
    return each.select(key, (both / (F.col("n") + F.col("m") - F.coalesce("shared", F.lit(0)))).alias("similarity"))


def share_of_total(df: DataFrame, *by: str | Column) -> DataFrame:
    """Rows of each group as a fraction of all rows."""
    groups = df.groupBy(*by).agg(F.count("*").alias("n"))
    shared = with_scalar(groups, df.agg(F.count("*").alias("_all")))
    return shared.withColumn("fraction", F.col("n").cast("double") / F.col("_all")).drop("_all")


def two_distinct_counts(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """``n_a`` and ``n_b`` distinct non-null values for each key; each pair is counted apart.

    One aggregate of two distinct counts would expand every row. A null key is a key.
    """
    keys = df.select(key).distinct()
    for name, column in (("n_a", a), ("n_b", b)):
        counted = df.select(key, column).distinct().groupBy(key).agg(F.count(column).alias(name))
        keys = _alike(keys, counted, key, "inner")
    return keys


def having_between(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    """The rows whose key occurs between ``low`` and ``high`` times, both included."""
    groups = df.groupBy(key).agg(F.count("*").alias("_n")).where(F.col("_n").between(low, high))
    return df.join(groups.select(key), key, "left_semi")
