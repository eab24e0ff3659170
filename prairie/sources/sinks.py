"""Results as text files and named tables, and back; the caller names the place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prairie.sources.lines import scan_key_value


def key_value_lines(rows: DataFrame, key: str, value: str) -> DataFrame:
    return rows.select(F.concat_ws("\t", F.col(key).cast("string"), F.col(value).cast("string")).alias("value"))


def write_key_value(rows: DataFrame, path: str, key: str, value: str, parts: int = 8) -> None:
    """Lines of key, tab, value in ``parts`` files; a key is in one of them."""
    key_value_lines(rows.repartition(parts, key), key, value).write.text(path)


def ranked_lines(top: DataFrame, key: str, value: str) -> DataFrame:
    """Lines of rank, key, value for a top-k result (columns ``rank``, key, value)."""
    return top.select(F.concat_ws("\t", *(F.col(c).cast("string") for c in ("rank", key, value))).alias("value"))


def write_ranked(top: DataFrame, path: str, key: str, value: str) -> None:
    """One file in the order of the ranks; a top-k result is as small as k."""
    ranked_lines(top.coalesce(1).sortWithinPartitions("rank"), key, value).write.text(path)


def read_key_value(spark: SparkSession, path: str) -> DataFrame:
    """``key`` and ``amount`` of all files of a folder that :func:`write_key_value` or another job wrote."""
    return scan_key_value(spark.read.text(path))


def read_ranked(spark: SparkSession, path: str) -> DataFrame:
    """``rank``, ``key`` and ``amount`` of lines of :func:`write_ranked`; other lines are skipped."""
    parts = F.split("value", "\t")
    rows = spark.read.text(path).where(F.size(parts) == 3)
    return rows.select(F.get(parts, F.lit(0)).try_cast("long").alias("rank"), F.get(parts, F.lit(1)).alias("key"), F.get(parts, F.lit(2)).try_cast("double").alias("amount")).where(
        "rank IS NOT NULL AND amount IS NOT NULL"
    )


def save_table(rows: DataFrame, name: str, path: str | None = None, by: tuple[str, ...] = (), mode: str = "error") -> DataFrame:
    """The result as a table of the catalog, read back; ``by`` names the columns of its partitions.

    Without ``path`` it lies in the warehouse. A table of that name is an error unless ``mode`` says otherwise.
    """
    writer = rows.write.mode(mode).partitionBy(*by)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return rows.sparkSession.table(name)


def replace_partitions(rows: DataFrame, name: str) -> DataFrame:
    """The table with those partitions replaced that ``rows`` has; all others stay as they are.

    Without rows nothing is replaced. The columns are found by name.
    """
    spark, setting = rows.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")  # an option of the writer does not reach tables of the catalog
    try:
        rows.select(spark.table(name).columns).write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(setting, before)
    spark.catalog.refreshTable(name)
    return spark.table(name)
