"""Column helpers that the operators share."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = "\t\n\x0b\x0c\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Runs of characters other than blank and U+0009 to U+000D."""
    return F.array_remove(F.split(F.translate(text, SPACES, " " * 5), " ", -1), "")


def ascii_lower(text: Column) -> Column:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


def held_out(doc_id: Column, parts: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves ``rest``; False for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def quoted(name: str) -> Column:
    """The column of that very name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole(rows: DataFrame) -> Column:
    """All columns of a row as one."""
    return F.struct(*(quoted(c) for c in rows.columns))


def free_name(rows: DataFrame, name: str) -> str:
    """``name``, made longer until ``rows`` has no such column, in any case."""
    taken = {c.lower() for c in rows.columns}
    while name.lower() in taken:
        name += "_"
    return name


def content_hash(rows: DataFrame) -> Column:
    """A hash of all columns; types that Spark does not hash are hashed as JSON."""
    plain = {f.name: not re.search("map<|variant", f.dataType.simpleString()) for f in rows.schema}
    return F.xxhash64(*(quoted(c) if plain[c] else F.to_json(F.struct(quoted(c))) for c in rows.columns))
