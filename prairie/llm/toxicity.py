"""Toxicity: a convolutional text classifier in numpy.

Words, and apart from them their first characters, are hashed to embeddings that are added
up; filters of several widths slide over them, the largest answer of each filter over the whole text is pooled, and one dense layer gives a
probability. Filters are linear in the embeddings, so that scoring a text needs, for each
hashed word, only its answer to each row of each filter: a table that is made once.

The classifier is fitted in the driver on at most ``FIT_ROWS`` labelled rows (whole texts),
half of them of either label as far as there are so many, chosen by a hash of the id, and
on at most ``FIT_BYTES`` of text: texts that do not fit in any more are left out, not cut.
Labels come only from rows that are not held out. A threshold for each language
is then calibrated on the scores of all labelled rows that are not held out, whether fitted
or not, from counts by language and bin of the score; the score itself never sees a language.

Defined results: a null text is an empty one and scores as a text without words; several
labels for one id count as the largest; null labels are left out; a language without labels of
both kinds takes the threshold of all rows (0.5 if those lack one, too); without labels of both
kinds every score is the share of toxic labels (0 without any); repeated rows are scored
each; other columns do no harm; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prairie.llm.batches import add_columns
from prairie.llm.columns import held_out, quoted
from prairie.session import stored, table

FIT_ROWS = 4000
FIT_BYTES = 64 << 20
BUCKETS = 1 << 22  # of the word hash; only buckets met while fitting have an embedding
LEAST_ROWS = 2  # fitted rows that a bucket must occur in
STEM = 5  # bytes of a word that are hashed as its stem
EMBEDDING = 16
WIDTHS = (1, 2, 3)
FILTERS = 8  # of each width
EPOCHS = 12
LEAST_STEPS = 600  # small samples get more epochs
BATCH = 64
BINS = 1 << 16  # of scores, when thresholds are sought; a power of two, so that edges are exact
CHECKED_PARTS, CHECKED_REST = 5, 0


def buckets(word: bytes) -> tuple[int, int]:
    """Of the word without punctuation, and of its stem."""
    bare = word.strip(b".,;:!?\"'()")
    return zlib.crc32(bare) % BUCKETS, zlib.crc32(b"\0" + bare[:STEM]) % BUCKETS


class Hasher:
    """Words to two rows of the embedding; row 0 is the gap between texts and any other bucket."""

    def __init__(self, rows: dict[int, int], cached: int = 400_000):
        self.rows, self.cached, self.cache = rows, cached, {}

    def numbers(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()
        cache = self.cache
        for w in set(words).difference(cache):
            whole, stem = buckets(w)
            cache[w] = self.rows.get(whole, 0) << 32 | self.rows.get(stem, 0)
        both = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
        while len(cache) > self.cached:
            cache.popitem()
        return np.stack([both >> 32, both & 0xFFFFFFFF], 1).astype(np.int32)


def joined(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of all texts with a gap after each, and the start of each text."""
    gap = np.zeros((max(WIDTHS), 2), np.int32)
    sizes = np.array([len(n) + len(gap) for n in numbers])
    return np.concatenate([x for n in numbers for x in (n, gap)]), sizes.cumsum() - sizes


@dataclass
class Model:
    rows: dict[int, int]  # bucket -> row of the embedding
    embedding: np.ndarray  # rows x EMBEDDING
    filters: dict[int, np.ndarray]  # width -> width x EMBEDDING x FILTERS
    bias: dict[int, np.ndarray]
    dense: np.ndarray
    offset: float
    constant: float | None = None  # the score, where nothing could be fitted

    def tables(self) -> dict[int, np.ndarray]:
        """width -> width x rows x FILTERS: the answer of each hashed word to each row."""
        return {w: np.einsum("be,wef->wbf", self.embedding, f).astype(np.float32) for w, f in self.filters.items()}

    def pooled(self, flat: np.ndarray, starts: np.ndarray, tables, places: bool = False):
        """Largest answers, texts x filters; with ``places``, where they are."""
        answers, at = [], []
        ends = np.append(starts[1:], len(flat))
        lengths = ends - starts
        owner = np.repeat(np.arange(len(starts)), lengths) if places else None
        for w in WIDTHS:
            n = len(flat) - w + 1
            total = np.zeros((n, FILTERS), np.float32)
            for i in range(w):
                for column in (0, 1):
                    total += tables[w][i][flat[i : n + i, column]]
            # Windows that begin in a text's last places would reach into the next text.
            total[(starts[1:, None] - np.arange(1, w)).ravel()] = -np.inf
            best = np.maximum.reduceat(total, starts, axis=0)
            answers.append(best + self.bias[w])
            if places:
                where = np.zeros_like(best, np.int64)
                for f in range(best.shape[1]):
                    hit = np.flatnonzero(total[:, f] == best[owner[:n], f])
                    first = np.unique(owner[hit], return_index=True)[1]
                    where[:, f] = hit[first]
                at.append(where)
        pooled = np.concatenate(answers, 1)
        return (pooled, at) if places else pooled

    def score(self, pooled: np.ndarray) -> np.ndarray:
        # Row by row: a matrix product may round one row differently in another batch.
        z = (np.maximum(pooled, 0) * self.dense).sum(1) + self.offset
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


@dataclass
class Gradients:
    """Of the mean cross entropy of some texts."""

    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    bias: dict[int, np.ndarray]
    dense: np.ndarray
    offset: float


def gradients(model: Model, flat: np.ndarray, pooled: np.ndarray, places: list[np.ndarray], p: np.ndarray, y: np.ndarray) -> Gradients:
    """Only the pooled places pass the gradient on. The filters of a step see the words before it."""
    dz = (p - y) / len(y)
    d_pooled = np.outer(dz, model.dense) * (pooled > 0)
    out = Gradients(np.zeros_like(model.embedding), {}, {}, np.maximum(pooled, 0).T @ dz, dz.sum())
    for j, w in enumerate(WIDTHS):
        d = d_pooled[:, j * FILTERS : (j + 1) * FILTERS].astype(np.float32)
        out.filters[w] = np.zeros_like(model.filters[w])
        for i in range(w):
            words = flat[np.minimum(places[j] + i, len(flat) - 1)]  # texts x filters x 2
            seen = model.embedding[words].sum(2)  # texts x filters x embedding
            out.filters[w][i] = np.einsum("tf,tfe->ef", d, seen)
            for column in (0, 1):
                np.add.at(out.embedding, words[:, :, column], d[:, :, None] * model.filters[w][i].T[None])
        out.bias[w] = d.sum(0)
    return out


def _blank(constant: float) -> Model:
    return Model({}, np.zeros((1, 1)), {}, {}, np.zeros(1), 0.0, constant)


def fit(texts: list[str], labels: list[int], seed: int = 5) -> Model:
    """Train on whole texts by Adam; gradients flow through the pooled places only."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return _blank(float(y.mean()) if len(y) else 0.0)
    rng = np.random.default_rng(seed)
    met = Counter(
        b for t in texts for b in {b for w in set(t.encode("utf-8", "surrogatepass").lower().split()) for b in buckets(w)}
    )
    rows = {b: i for i, b in enumerate(sorted(b for b, n in met.items() if n >= LEAST_ROWS), 1)}
    model = Model(
        rows,
        rng.normal(0, 0.1, (len(rows) + 1, EMBEDDING)).astype(np.float32),
        {w: rng.normal(0, 0.4 / np.sqrt(w), (w, EMBEDDING, FILTERS)).astype(np.float32) for w in WIDTHS},
        {w: np.zeros(FILTERS, np.float32) for w in WIDTHS},
        rng.normal(0, 0.3, len(WIDTHS) * FILTERS).astype(np.float32),
        0.0,
    )
    model.embedding[0] = 0
    hasher = Hasher(rows)
    numbers = [hasher.numbers(t) for t in texts]
    epochs = max(EPOCHS, -(-LEAST_STEPS * BATCH // len(texts)))
    moments: dict = {}
    step = 0

    def adam(name, value, gradient, rate):
        m, v = moments.get(name, (0.0, 0.0))
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        moments[name] = (m, v)
        return value - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs)
        order = rng.permutation(len(texts))
        for first in range(0, len(order), BATCH):
            some = order[first : first + BATCH]
            step += 1
            flat, starts = joined([numbers[r] for r in some])
            # Only this batch's words: answers are computed from their embeddings.
            used, flat = np.unique(flat, return_inverse=True)
            flat = flat.reshape(-1, 2)
            own = Model(rows, model.embedding[used], model.filters, model.bias, model.dense, model.offset)
            pooled, places = own.pooled(flat, starts, own.tables(), places=True)
            p = own.score(pooled)
            g = gradients(own, flat, pooled, places, p, y[some])
            for w in WIDTHS:
                model.filters[w] = adam(("f", w), model.filters[w], g.filters[w] + 1e-4 * model.filters[w], rate).astype(np.float32)
                model.bias[w] = adam(("b", w), model.bias[w], g.bias[w], rate).astype(np.float32)
            d_dense, d_offset, d_embedding = g.dense + 1e-4 * model.dense, g.offset, g.embedding
            model.dense = adam("d", model.dense, d_dense, rate).astype(np.float32)
            model.offset = float(adam("o", model.offset, d_offset, rate))
            # Embeddings take a normalised step for the words of the batch only.
            norm = np.sqrt((d_embedding**2).mean(1, keepdims=True)) + 1e-8
            touched = norm[:, 0] > 1e-7
            touched[used == 0] = False
            model.embedding[used[touched]] -= (rate * d_embedding / norm)[touched]
    return model


def calibrate(scored: DataFrame, known: DataFrame) -> DataFrame:
    """``_lang``, ``limit``: the threshold with the best F1 over all rows in ``known``; "" is for all.

    Equal F1 takes the larger threshold, half way to the next bin with a score.
    """
    bins = (
        scored.join(known, scored["_key"] == known["_id"])
        .groupBy("_lang", F.floor(F.col("score") * BINS).cast("int").alias("bin"))
        .agg(F.sum("_y").alias("hits"), F.count("*").alias("n"))
    )
    bins = stored(bins, "bins")  # at most BINS + 1 rows a language
    every = bins.groupBy("bin").agg(F.sum("hits").alias("hits"), F.sum("n").alias("n")).select(F.lit("").alias("_lang"), "bin", "hits", "n")
    down, whole = Window.partitionBy("_lang").orderBy(F.desc("bin")), Window.partitionBy("_lang")
    each = bins.where("_lang <> ''").unionByName(every).select(
        "_lang",
        "bin",
        F.sum("hits").over(down).alias("hit"),
        F.sum("n").over(down).alias("taken"),
        F.sum("hits").over(whole).alias("toxic"),
        F.sum("n").over(whole).alias("total"),
        F.lead("bin").over(down).alias("next"),
    )
    f1 = 2 * F.col("hit") / (F.col("taken") + F.col("toxic"))
    best = each.where("toxic > 0 and toxic < total").groupBy("_lang").agg(F.max(F.struct(f1.alias("f1"), "bin", "next")).alias("b"))
    return stored(best.select("_lang", ((F.col("b.bin") + F.coalesce(F.col("b.next") + 1, F.lit(0))) / (2.0 * BINS)).alias("limit")), "limits")


def score(texts: list[str], model: Model, hasher: Hasher, tables) -> np.ndarray:
    """Scores of whole texts, about ``1 << 18`` words at a time."""
    if model.constant is not None:
        return np.full(len(texts), model.constant)
    out, first = [], 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size < 1 << 20):
            size += len(texts[last])
            last += 1
        numbers = [hasher.numbers(t) for t in texts[first:last]]
        out.append(model.score(model.pooled(*joined(numbers), tables)))
        first = last
    return np.concatenate(out) if out else np.zeros(0)


def labelled(labels: DataFrame, key: str, label: str) -> DataFrame:
    """``_id``, ``_y`` of 0 or 1: one row for each labelled id that is not held out."""
    known = labels.where(F.col(label).isNotNull()).groupBy(F.col(key).alias("_id")).agg(F.max(label).alias("_y"))
    return known.where(~held_out(F.col("_id"), CHECKED_PARTS, CHECKED_REST) & F.col("_y").isin(0, 1))


def sample(docs: DataFrame, known: DataFrame, key: str, text: str, rows: int, size: int = FIT_BYTES) -> list:
    """At most ``rows`` of the labelled rows and ``size`` bytes of their texts, up to half of them toxic."""
    picked = None
    for y in (0, 1):
        some = known.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(rows // 2)
        picked = some if picked is None else picked.unionByName(some)
    texts = docs.select(quoted(key).alias("_id"), F.coalesce(quoted(text), F.lit("")).alias("_t"))
    # ``rows`` narrow rows at most: a bounded broadcast.
    joined = texts.join(F.broadcast(picked), "_id").groupBy("_id").agg(F.min(F.struct("_t", "_y")).alias("s"))
    written = stored(joined.select("_id", "s.*", F.xxhash64("_id").alias("_h")), "sample")
    left, taken = size, []
    for r in written.select("_id", "_h", F.octet_length("_t").alias("n")).orderBy("_h", "_id").collect():
        if r["n"] <= left:
            taken.append((r["_id"],))
            left -= r["n"]
    kept = docs.sparkSession.createDataFrame(taken, written.select("_id").schema)
    return written.join(F.broadcast(kept), "_id").orderBy("_id").select("_t", "_y").collect()


def classify(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", label: str = "toxic", fit_rows: int = FIT_ROWS) -> DataFrame:
    """``key``, ``held_out``, ``score``, ``predicted``, ``threshold`` and ``flagged``.

    ``flagged`` compares the score with the language's threshold. Texts are scored once;
    the scores are written, as thresholds need all of them.
    """
    known = labelled(labels, key, label)
    rows = sample(docs, known, key, text, fit_rows)
    model = fit([r["_t"] for r in rows], [int(r["_y"]) for r in rows])
    sent = docs.sparkSession.sparkContext.broadcast((model, model.tables()))

    def begin():
        model, tables = sent.value
        hasher = Hasher(model.rows)

        def make(batch: pa.RecordBatch) -> dict[str, list]:
            return {"score": score([t or "" for t in batch.column("_text").to_pylist()], model, hasher, tables).astype(float)}

        return make

    scored = add_columns(
        docs.select(quoted(key).alias("_key"), quoted(text).alias("_text"), quoted(lang).alias("_lang")), "score double", begin, drop=("_text",)
    )
    scored = stored(scored, "scores")
    limits = calibrate(scored, known)
    general = limits.where("_lang = ''").first()
    limit = F.coalesce("limit", F.lit(general.limit if general else 0.5))
    return scored.join(limits.where("_lang <> ''"), "_lang", "left").select(
        F.col("_key").alias(key),
        held_out(F.col("_key"), CHECKED_PARTS, CHECKED_REST).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        limit.alias("threshold"),
        (F.col("score") >= limit).alias("flagged"),
    )


def op8_toxicity(spark, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op8_toxicity": op8_toxicity}
SQL: dict[str, str] = {}
