"""Ranked lexical search: all documents for each item, by dense blocked products of matrices.

Terms are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lowered. A
term's weight and a document's length factor are integers, so the score is one too:
sum over the item's terms of ``w * ((10**9 * tf) div (1000 * tf + 12 * m))``, repeats included.

The items are taken in blocks of bounded text. A block's distinct terms are its compact
vocabulary, which is sent to the tasks. One pass over the texts keeps, of each document,
the number of its terms and its counts of vocabulary terms. The next pass writes the impacts
of a tile of documents and a tile of the vocabulary into a dense matrix and multiplies it
with the tile's weights, in float64 by BLAS. Tiles are cut (a single heavy weight too) so
that no sum of a tile can reach 2**53: each product is exact, whatever order BLAS adds in.
Sums over tiles are int64.

A task keeps the best ``TOP`` of each item over all its tiles, by score and then key, ties at
the edge included until the keys decide; Spark ranks what the tasks send.

Defined results: a null or empty text has no terms, and as an item no answers; each row is a
document of its own, and each row of items an item of its own; equal scores are in ascending
order of the key, null last; other columns do no harm; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from prairie.llm.batches import add_columns
from prairie.llm.columns import quoted
from prairie.session import stored, table

TOP = 20
ITEM_BYTES = 1 << 21  # of item text in a block; bounds its vocabulary and its matrices
ITEMS = 2048  # of a block
DOCS = 512  # of a tile
TERMS = 1024  # of a vocabulary tile
EXACT = 1 << 53
IMPACT = 1_000_000  # above every impact
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return (text or b"").translate(_FOLD).split()


# Items -----------------------------------------------------------------------------

def item_blocks(items: DataFrame, key: str, text: str, item_bytes: int = ITEM_BYTES) -> Iterator[tuple[list, list[Counter]]]:
    """Blocks of items: their keys, and the counts of their terms.

    One partition of items is at the driver at a time.
    """
    keys: list = []
    bags: list[Counter] = []
    size = 0
    for row in items.select(quoted(key), F.encode(quoted(text), "UTF-8")).toLocalIterator():
        bag = Counter(terms(row[1]))
        if not bag:
            continue
        own = sum(map(len, bag))
        if keys and (size + own > item_bytes or len(keys) == ITEMS):
            yield keys, bags
            keys, bags, size = [], [], 0
        keys.append(row[0])
        bags.append(bag)
        size += own
    if keys:
        yield keys, bags


def tiles(weights: np.ndarray, first: int, bound: int = EXACT) -> list[tuple[int, np.ndarray]]:
    """(first term, float64 weights) of tiles in which no item's sum can reach ``bound``."""
    if not weights.any():
        return []
    if int(weights.sum(0).max()) * IMPACT < bound and len(weights) <= TERMS:
        return [(first, weights.astype(np.float64))]
    if len(weights) > 1:
        half = len(weights) // 2
        return tiles(weights[:half], first, bound) + tiles(weights[half:], first + half, bound)
    return tiles(weights // 2, first, bound) + tiles(weights - weights // 2, first, bound)


# Documents -------------------------------------------------------------------------

def counted(docs: DataFrame, key: str, text: str, vocabulary: list[bytes]) -> DataFrame:
    """``_key``, ``n`` (terms), and ``term``, ``tf``: the vocabulary terms of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def begin():
        place = {t: i for i, t in enumerate(sent.value)}

        def make(batch: pa.RecordBatch) -> dict[str, list]:
            sizes, found, times = [], [], []
            for text_ in batch.column("_text").cast(pa.binary()).to_pylist():
                own = terms(text_)
                bag = Counter(map(place.get, own))
                bag.pop(None, None)
                sizes.append(len(own))
                found.append(list(bag))
                times.append(list(bag.values()))
            return {"n": sizes, "term": found, "tf": times}

        return make

    rows = docs.select(quoted(key).alias("_key"), quoted(text).alias("_text"))
    return add_columns(rows, "n long, term array<int>, tf array<long>", begin, drop=("_text",))


def impacts(batch: pa.RecordBatch, n_docs: int, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and impact of all entries of a batch, as integers."""
    term, tf = batch.column("term"), batch.column("tf")
    sizes = pc.list_value_length(term).to_numpy(zero_copy_only=False).astype(np.int64)
    n = batch.column("n").to_numpy(zero_copy_only=False)
    m = 75 + (25 * n * n_docs) // max(n_terms, 1)
    times = tf.flatten().to_numpy(zero_copy_only=False)
    return np.repeat(np.arange(len(n)), sizes), term.flatten().to_numpy(zero_copy_only=False), (10**9 * times) // (1000 * times + 12 * np.repeat(m, sizes))


class Best:
    """The best ``top`` of each item so far: scores and keys, by descending score and ascending key."""

    def __init__(self, items: int, top: int, kind: pa.DataType):
        self.top = top
        self.item = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.key = pa.array([], kind)
        self.least = np.zeros(items, np.int64)  # a score below it is not among the best

    def add(self, item: np.ndarray, score: np.ndarray, key: pa.Array) -> None:
        self.item, self.score = np.concatenate([self.item, item]), np.concatenate([self.score, score])
        self.key = pa.concat_arrays([self.key, key])
        by_key = np.empty(len(self.key), np.int64)
        by_key[pc.sort_indices(self.key, null_placement="at_end").to_numpy()] = np.arange(len(self.key))
        order = np.lexsort((by_key, -self.score, self.item))
        own = self.item[order]
        first = np.searchsorted(own, own)
        kept = order[np.arange(len(own)) - first < self.top]
        self.item, self.score, self.key = self.item[kept], self.score[kept], self.key.take(pa.array(kept))
        full = np.bincount(self.item, minlength=len(self.least)) >= self.top
        last = np.searchsorted(self.item, np.flatnonzero(full), side="right") - 1
        self.least[full] = self.score[last]


def _candidates(scores: np.ndarray, least: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, item) places of a tile that can be among the best: all ties of the last place too."""
    if len(scores) > top:
        least = np.maximum(least, np.partition(scores, len(scores) - top, axis=0)[len(scores) - top])
    return np.nonzero((scores > 0) & (scores >= least))


def best_of(rows: DataFrame, weights: np.ndarray, n_docs: int, n_terms: int, top: int = TOP) -> DataFrame:
    """``item`` (place in the block), ``_key`` and ``score``: the best of each task."""
    sent = rows.sparkSession.sparkContext.broadcast(tiles(weights, 0))
    n_items, width = weights.shape[1], weights.shape[0]
    kind = to_arrow_type(rows.schema["_key"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(n_items, top, kind)
        for batch in batches:
            row, term, impact = impacts(batch, n_docs, n_terms)
            keys = batch.column("_key")
            for first in range(0, batch.num_rows, DOCS):
                n = min(DOCS, batch.num_rows - first)
                lo, hi = np.searchsorted(row, [first, first + n])
                flat = np.zeros((n, width))
                flat[row[lo:hi] - first, term[lo:hi]] = impact[lo:hi]
                scores = np.zeros((n, n_items), np.int64)
                for start, w in sent.value:
                    scores += (flat[:, start : start + len(w)] @ w).astype(np.int64)
                doc, item = _candidates(scores, best.least, top)
                best.add(item, scores[doc, item], keys.slice(first, n).take(pa.array(doc)))
        yield pa.RecordBatch.from_arrays([pa.array(best.item, pa.int32()), best.key, pa.array(best.score, pa.int64())], ["item", "_key", "score"])

    return rows.mapInArrow(run, f"item int, _key {rows.schema['_key'].dataType.simpleString()}, score long")


# Search ----------------------------------------------------------------------------

def term_weights(rows: DataFrame, vocabulary: list[bytes]) -> tuple[np.ndarray, int, int]:
    """Weight of each vocabulary term, documents with terms, and all terms."""
    n_docs, n_terms = rows.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    counts = rows.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect()  # one row a term
    df = np.zeros(len(vocabulary), np.int64)
    for r in counts:
        df[r["term"]] = r["df"]
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64), n_docs, n_terms


def search(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
    top: int = TOP, item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """``item_key``, ``rank`` from 1, ``key`` and ``score`` of the ``top`` best documents of each item."""
    spark = docs.sparkSession
    kind = items.schema[item_key].dataType.simpleString()
    found = None
    for i, (keys, bags) in enumerate(item_blocks(items, item_key, item_text, item_bytes)):
        vocabulary = sorted(set().union(*bags))
        place = {t: k for k, t in enumerate(vocabulary)}
        rows = stored(counted(docs, key, text, vocabulary), "term-counts")
        w, n_docs, n_terms = term_weights(rows, vocabulary)
        weights = np.zeros((len(vocabulary), len(keys)), np.int64)
        for item, bag in enumerate(bags):
            for t, times in bag.items():
                weights[place[t], item] = times * w[place[t]]
        names = spark.createDataFrame([(i, k, v) for k, v in enumerate(keys)], f"block int, item int, item_key {kind}")
        best = best_of(rows, weights, n_docs, n_terms, top).withColumn("block", F.lit(i)).join(F.broadcast(names), ["block", "item"])
        found = best if found is None else found.union(best)
    if found is None:
        schema = f"item_key {kind}, rank int, key {docs.schema[key].dataType.simpleString()}, score long"
        return spark.createDataFrame([], schema).withColumnsRenamed({"item_key": item_key, "key": key})
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("_key"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select(F.col("item_key").alias(item_key), "rank", F.col("_key").alias(key), "score")


def op12_search(spark, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op12_search": op12_search}
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = {
    "op12_search": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS ts FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
s AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM n),
b AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS ts FROM benchmark WHERE text IS NOT NULL),
i AS (SELECT q, item_id, t, count(*) AS times FROM (SELECT q, item_id, unnest(ts) AS t FROM b) GROUP BY ALL),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, s GROUP BY t, docs),
x AS (SELECT r, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms))) AS x FROM tf JOIN w USING (t) JOIN n USING (r), s),
z AS (SELECT q, item_id, r, sum(times * x)::BIGINT AS score FROM i JOIN x USING (t) GROUP BY ALL),
k AS (SELECT q, item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM z JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM k WHERE rank <= {TOP}"""
}
