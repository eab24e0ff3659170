"""Top-k and numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prairie.session import stored


def top_k(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; ties in ascending order of ``ties``."""
    return df.orderBy(F.desc(by), *ties).limit(k)


def ranked(df: DataFrame, k: int, by: str, *ties: str) -> DataFrame:
    """:func:`top_k` with ``rank`` from 1. The window sees the k rows only."""
    return top_k(df, k, by, *ties).withColumn("rank", F.row_number().over(Window.orderBy(F.desc(by), *ties)).cast("long"))


def k_best(df: DataFrame, k: int, group: str, *order) -> DataFrame:
    """The first ``k`` rows of each group, with ``rank`` from 1; Spark keeps k per group before the shuffle."""
    number = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return df.withColumn("rank", number).where(F.col("rank") <= k)


def numbered(df: DataFrame, *order, name: str = "idx") -> DataFrame:
    """``df`` with ``name``: each row's place, from 0, in the given order over all rows.

    Ranges of the order are sorted apart and numbered inside; a range begins where those before
    it end. Only the number of rows of each range comes to the driver. Equal rows of the
    order get different places.
    """
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "numbered")
    part, inside = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))  # as Spark lays out these ids
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for r in sizes:
        starts.append((r["part"], total))
        total += r["n"]
    begin = df.sparkSession.createDataFrame(starts, "_part long, _start long")  # a row for each range
    return placed.withColumn("_part", part).join(F.broadcast(begin), "_part").withColumn(name, F.col("_start") + inside).drop("_part", "_start", "_at")
