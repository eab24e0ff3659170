"""The corpus pipeline: five stages, each written as Parquet and read as the next one's documents.

A stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the
last return the columns of documents; the last returns the pieces of packed sequences.

Defined results: null texts are empty and go with the quality rules; repeated rows go on
until the near duplicates, where one of them stays; columns that the stages do not know
pass through; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from prairie.llm import decontaminate, jaccard, lines, packing, quality
from prairie.session import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality.stage),
    ("line_dedup", lines.stage),
    ("near_duplicates", jaccard.stage),
    ("decontamination", decontaminate.stage),
    ("packing", packing.stage),
]

#: Token ids are beyond SQL; tests hold the whole run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
