"""Benchmark decontamination with an Aho-Corasick automaton over normalised test items.

Words are runs of letters, digits and non-ASCII characters, with A-Z lowered. An item's
windows are its runs of 13 words, or the whole item if it is shorter. The automaton holds
every window once and finds all that occur in a text in one scan; word numbers lead back to
places in the original text.

The windows are a table; about ``BLOCK`` of them at a time are sent to the tasks as one
automaton, which scans all texts, before the next block follows; a usual benchmark is one
block. A window that is found leads to its items by a join.

Defined results: a null text or item has no words; items with the same id are one item, with
the windows of each row; a null item id is written as an empty one; repeated documents are
scanned each; other columns keep out of the way under any name; without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prairie.llm.batches import FEW, add_columns
from prairie.llm.columns import quoted, whole
from prairie.session import stored, table

WIDTH = 13
BLOCK = 200_000  # windows of one automaton

#: Bytes of UTF-8: A-Z lowered; digits, letters and all parts of non-ASCII characters stay; the rest is blank.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def windows(text: str | None, width: int = WIDTH) -> list[bytes]:
    """Windows as bytes: a blank before, between and after the words."""
    own = words(text)
    return [b" " + b" ".join(own[i : i + width]) + b" " for i in range(max(1, len(own) - width + 1))] if own else []


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (code points) of the words in the original text."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    inside = np.concatenate([[0], (np.frombuffer(_FOLD, np.uint8)[raw] != 32).view(np.int8), [0]])
    edge = np.diff(inside)
    points = np.concatenate([[0], ((raw & 0xC0) != 0x80).cumsum()])  # code points before each byte
    return points[np.flatnonzero(edge == 1)], points[np.flatnonzero(edge == -1)]


def window_table(items: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(window, item), each once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(w, k) for k, t in zip(batch["item"], batch["text"]) for w in dict.fromkeys(windows(t, width))]
            yield pd.DataFrame(found, columns=["window", "item"])

    rows = items.select(F.coalesce(quoted(key).cast("string"), F.lit("")).alias("item"), quoted(text).alias("text"))
    return rows.mapInPandas(run, "window binary, item string").distinct()


def _automaton(block: list[bytes]) -> ahocorasick.Automaton:
    made = ahocorasick.Automaton()
    for i, window in enumerate(block):
        made.add_word(window.decode("latin-1"), (i, len(window), window.count(b" ") - 1))
    made.make_automaton()
    return made


def _scan(automaton, norm: str) -> tuple[list[tuple[int, int]], set[int]]:
    """(first word, words) of all windows found, and their numbers."""
    found = list(automaton.iter(norm))
    if not found:
        return [], set()
    blanks = np.flatnonzero(np.frombuffer(norm.encode("latin-1"), np.uint8) == 32)
    starts = np.searchsorted(blanks, [end + 1 - size for end, (_, size, _) in found])
    return [(int(s), n) for s, (_, (_, _, n)) in zip(starts, found)], {i for _, (i, _, _) in found}


def _marked(text: str, n_words: int, runs: list[tuple[int, int]]) -> tuple[int, list[dict]]:
    """Number of hit words, and the places of their runs."""
    if not runs:
        return 0, []
    at = np.array(runs)
    change = np.zeros(n_words + 1, np.int64)
    np.add.at(change, at[:, 0], 1)
    np.add.at(change, at.sum(1), -1)
    inside = np.concatenate([[0], (change.cumsum()[:n_words] > 0).astype(np.int8), [0]])
    first, last = word_places(text)
    edge = np.diff(inside)
    pairs = zip(first[np.flatnonzero(edge == 1)], last[np.flatnonzero(edge == -1) - 1])
    return int(inside.sum()), [{"start": int(a), "end": int(b)} for a, b in pairs]


def _hits(rows: DataFrame, block: list[bytes]) -> tuple[DataFrame, Broadcast]:
    """``rows`` with ``n_words``, the ``runs`` (first word, words) of the block's windows, and the ``windows`` found."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def begin():
        automaton = _automaton(sent.value)

        def make(batch: pa.RecordBatch) -> dict[str, list]:
            norms = [words(t) for t in batch.column("_text").to_pylist()]
            found = [_scan(automaton, (b" " + b" ".join(n) + b" ").decode("latin-1")) if n and len(automaton) else ([], set()) for n in norms]
            return {
                "n_words": [len(n) for n in norms],
                "runs": [[{"first": a, "n": n} for a, n in runs] for runs, _ in found],
                "windows": [[sent.value[i] for i in sorted(ids)] for _, ids in found],
            }

        return make

    return add_columns(rows, "n_words long, runs array<struct<first:long,n:long>>, windows array<binary>", begin, most=FEW), sent


def _spans(rows: DataFrame) -> DataFrame:
    """``n_hit`` and ``spans`` from the text, its number of words and its runs."""

    def begin():
        def make(batch: pa.RecordBatch) -> dict[str, list]:
            made = []
            for text, n, runs in zip(*(batch.column(c).to_pylist() for c in ("_text", "n_words", "runs"))):
                made.append(_marked(text or "", n, [(r["first"], r["n"]) for r in runs]))
            return {"n_hit": [n for n, _ in made], "spans": [s for _, s in made]}

        return make

    return add_columns(rows, "n_hit long, spans array<struct<start:int,end:int>>", begin, drop=("_text", "runs"), most=FEW)


def _found(docs: DataFrame, windows_: DataFrame, key: str, text: str, block: int) -> DataFrame:
    """``_key``, ``n_words``, ``n_hit``, ``spans`` and the ``windows`` found in each row."""
    rows = docs.select(quoted(key).alias("_key"), quoted(text).alias("_text"))
    distinct = windows_.select("window").distinct()
    blocks = max(1, -(-distinct.count() // block))
    part = F.pmod(F.xxhash64("window"), F.lit(blocks))

    def one(k: int) -> list[bytes]:
        return sorted(bytes(r.window) for r in distinct.where(part == k).collect())  # about ``block`` windows

    made, sent = _hits(rows, one(0))
    if blocks == 1:
        return _spans(made)
    # Block by block: all rows once, then of each block what it hits, met with the rows at the end.
    first = stored(made.withColumn("_row", F.monotonically_increasing_id()), "texts")
    sent.unpersist()
    hits = first.select("_row", "runs", "windows")
    for k in range(1, blocks):
        made, sent = _hits(first.select("_row", "_text"), one(k))
        hits = hits.unionByName(stored(made.where(F.size("windows") > 0).select("_row", "runs", "windows"), "hits"))
        sent.unpersist()
    every = hits.groupBy("_row").agg(F.flatten(F.collect_list("runs")).alias("runs"), F.flatten(F.collect_list("windows")).alias("windows"))
    return _spans(first.drop("runs", "windows").join(every, "_row").drop("_row"))


def scan(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", width: int = WIDTH, block: int = BLOCK) -> DataFrame:
    """``key``, ``n_words``, ``n_hit``, ``items`` (sorted ids) and ``spans``: the hit places.

    Spans are code points of the original text, end exclusive, from the first to the last
    word of each run of hit words.
    """
    windows_ = stored(window_table(items, item_key, item_text, width), "windows")
    found = stored(_found(docs, windows_, key, text, block).withColumn("_row", F.monotonically_increasing_id()), "scanned")
    each = found.select("_row", F.explode("windows").alias("window")).join(windows_, "window").select("_row", "item").distinct()
    items_ = each.groupBy("_row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    joined = found.drop("windows").join(items_, "_row", "left").withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    return joined.select(F.col("_key").alias(key), "n_words", "n_hit", "items", "spans")


def contaminated():
    """A document of which a twentieth of the words or more is hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op6_contamination(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated, with all their columns.

    The scan carries each row as its key, so that nothing is joined.
    """
    windows_ = stored(window_table(table(spark, sf_dir, "benchmark"), "item_id", "text", WIDTH), "windows")
    found = _found(docs.select(whole(docs).alias("_whole"), quoted("text").alias("_body")), windows_, "_whole", "_body", BLOCK)
    return found.where(~contaminated()).select("_key.*")


QUERIES = {"op6_contamination": op6_contamination}
SQL = {
    "op6_contamination": r"""
WITH b AS (
  SELECT row_number() OVER () AS q, coalesce(item_id::VARCHAR, '') AS item,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
v AS (SELECT item, ws, unnest(range(1, greatest(1, len(ws) - 12) + 1)) AS p FROM b WHERE len(ws) > 0),
win AS (SELECT DISTINCT item, list_slice(ws, p, p + 12) AS w FROM v),
d AS (
  SELECT row_number() OVER () AS r, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
  FROM documents),
p AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM d),
l AS (SELECT DISTINCT len(w) AS n FROM win),
g AS (SELECT r, i, n, list_slice(ws, i, i + n - 1) AS w FROM p, l WHERE i + n - 1 <= len(ws) AND ws[i] IN (SELECT w[1] FROM win)),
h AS (SELECT g.r, g.i, g.n, win.item FROM g JOIN win ON g.w = win.w),
c AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM h) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM h) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN s USING (r)"""
}
