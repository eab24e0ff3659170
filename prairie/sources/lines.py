"""Tables from text lines: delimited, tagged, numeric, key-tab-value and query lists.

Each function takes a DataFrame with a text column and returns typed columns; what a line
must look like to be kept is stated at each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """All lines of a file or of the files of a folder, with where they come from (``place``)."""
    return spark.read.text(path).select(
        "value",
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        ).alias("place"),
    )


def scan_delimited(lines: DataFrame, fields: dict[str, int], sep: str = ",", least: int = 11, value: str = "value") -> DataFrame:
    """Named fields of lines with at least ``least`` of them; trailing empty fields count.

    The parts of a line are a generated row: filters on the fields, also those put on top later,
    stay above it, so that a line is split once.
    """
    parts = F.split(F.col(value), f"\\Q{sep}\\E", -1)
    fitting = F.when(F.size("_f") >= least, F.array(F.struct(*(F.get("_f", F.lit(i)).alias(n) for n, i in fields.items()))))
    kept = [c for c in lines.columns if c != value]
    return lines.where(F.length(value) > 0).select(*kept, F.explode(F.array(parts)).alias("_f")).select(*kept, F.inline(fitting))


def drop_headers(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """Without rows in which any of the columns holds its own name, in any case."""
    header = F.lit(False)
    for column, name in names.items():
        header = header | F.coalesce(F.lower(F.col(column)) == name.lower(), F.lit(False))
    return rows.where(~header)


def drop_dirty(rows: DataFrame, key: str, stamp: str, amount: str) -> DataFrame:
    """Rows with a key, a date of ten characters or more and a number: ``key``, ``day``, ``amount``."""
    day = F.when(F.length(stamp) >= 10, F.substring(stamp, 1, 10))
    made = rows.select(F.col(key).alias("key"), day.alias("day"), F.col(amount).try_cast("double").alias("amount"))
    return made.where((F.length("key") > 0) & F.col("day").isNotNull() & F.col("amount").isNotNull())


def starting_with(rows: DataFrame, column: str, prefix: str | None) -> DataFrame:
    """Rows whose column starts with the prefix; a blank prefix keeps all."""
    prefix = (prefix or "").strip()
    return rows.where(F.startswith(F.col(column), F.lit(prefix))) if prefix else rows


def scan_tagged(lines: DataFrame, mode: str = "regex", value: str = "value") -> DataFrame:
    """``id`` and ``text`` of tagged documents.

    ``position``: lines that hold ``id``; the id lies between ``id="`` and ``" url=``, the text
    after the first ``">``, closing tag included; lines without these marks are dropped.
    ``regex``: the id after ``<doc id="``, the text between ``>`` and the last ``</doc>`` of the
    line; both are empty where the line does not match.
    """
    text = F.col(value)
    if mode == "position":
        start, url, body = F.instr(text, 'id="'), F.instr(text, '" url='), F.instr(text, '">')
        kept = lines.where(F.contains(text, F.lit("id")) & (start > 0) & (url >= start + 4) & (body > 0))
        return kept.select(
            F.substring(text, start + 4, url - start - 4).alias("id"), F.substring(text, body + 2, F.length(text)).alias("text")
        )
    return lines.select(
        F.regexp_extract(text, r'(?d)<doc id="([^"]*)"', 1).alias("id"), F.regexp_extract(text, r"(?d)>(.*)</doc>", 1).alias("text")
    )


def scan_numeric(lines: DataFrame, names: list[str], place: str | Column = "place", value: str = "value") -> DataFrame:
    """Numbers between white space; the first column is a long key, of whose rows the last stays."""
    parts = F.split(F.btrim(F.col(value), F.lit(" \t\r\n")), r"\s+")
    key, *rest = names
    numbers = [F.get(parts, F.lit(0)).try_cast("long").alias(key)]
    numbers += [F.get(parts, F.lit(i + 1)).try_cast("double").alias(n) for i, n in enumerate(rest)]
    rows = lines.select(*numbers, (F.col(place) if isinstance(place, str) else place).alias("_place")).where(F.col(key).isNotNull())
    last = rows.groupBy(key).agg(F.max_by(F.struct(*rest), "_place").alias("_last"))
    return last.select(key, "_last.*")


def scan_key_value(lines: DataFrame, value: str = "value") -> DataFrame:
    """``key`` and ``amount``, split at the last tab; without one, the first and last of the parts
    between white space. Lines with one part, or whose value is no number, are dropped."""
    text = F.btrim(F.col(value), F.lit(" \t\r\n"))
    tab = F.regexp_extract(F.col(value), r"^(.+)\t([^\t]+)$", 1) != ""
    parts = F.split(text, r"\s+")
    key = F.when(tab, F.regexp_extract(F.col(value), r"^(.+)\t([^\t]+)$", 1)).when(F.size(parts) >= 2, F.get(parts, F.lit(0)))
    amount = F.when(tab, F.regexp_extract(F.col(value), r"^(.+)\t([^\t]+)$", 2)).when(F.size(parts) >= 2, F.element_at(parts, -1))
    made = lines.select(F.btrim(key).alias("key"), amount.try_cast("double").alias("amount"))
    return made.where(F.col("key").isNotNull() & F.col("amount").isNotNull())


def scan_queries(lines: DataFrame, value: str = "value") -> DataFrame:
    """``k`` and ``query`` of lines ``predict_label (k, 'text')``; other lines are skipped."""
    pattern = r"""^\s*predict_label\s*\(\s*(\d+)\s*,\s*(['"])(.*)\2\s*\)\s*$"""
    k = F.regexp_extract(F.col(value), pattern, 1)
    return lines.where(k != "").select(k.cast("int").alias("k"), F.regexp_extract(F.col(value), pattern, 3).alias("query"))


def repeated_keys(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that a table holds more than once, with how often."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def load_table(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table by a declared schema; wrong types fail when they are read."""
    return spark.read.schema(schema).parquet(path)
