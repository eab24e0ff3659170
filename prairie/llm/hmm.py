"""Hidden Markov language model.

Tokens are words with A-Z lowered, and one end for each text. Training counts of all words
give a unigram model. Latent states emit words. Baum-Welch counts come from all training
tokens, in windows of ``WINDOW`` tokens, are summed up over the partitions, and give the next
round's model. In these rounds the ``OWN`` most frequent words have cells of their own and the
others share ``HASHED`` cells by a hash, inside which each has its share of the cell's counts. The
last expectation is kept for every word: a table of words with their counts and their expected counts
in each state, as large as the training vocabulary. A word's emission is its unigram share,
divided over the states as its counts are (``LEAN`` tokens more, as all states are taken). The
scaled forward recursion then runs over each whole text, which gives its exact likelihood.

Words with at least a ``COMMON``-th of all training tokens are at most ``COMMON`` many: they
are sent to the tasks with their counts. The rows of the rarer words reach the documents
by a join on the word, in which no key is frequent. Expected counts are added up as integers, of
a ``UNIT``-th of the largest count that a rare word can have.

Defined results: a null text is an empty one, which is the end alone; a null id counts as
"not held out"; repeated rows are scored (and counted) each; a word never seen has the unigram
share of an unseen word in every state; other columns do no harm; without training rows the
model is the base model; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prairie.llm.batches import add_columns
from prairie.llm.columns import held_out, quoted
from prairie.session import forget, store, stored, table

STATES = 6
ROUNDS = 4
STAY = 0.95  # chance at first to keep the state; it lets states become topics or languages
WINDOW = 256
OWN = 8192
HASHED = 4096
COMMON = 1_000_000
LEAN = 1.0  # tokens added to each word's counts, spread as the states are taken
UNIT = 1 << 30
SHARE = (1 << 21) - 1  # steps of a state's share of a rarer word, as it is sent to texts
PRIOR = 100.0  # tokens spread over the cells by their share, added to each state's counts
BLOCK = 1 << 18  # tokens of windows that are held at a time
HELD_PARTS, HELD_REST = 7, 2
END = b""


def tokens(text: bytes | None) -> list[bytes]:
    """Words between blanks and U+0009 to U+000D, then the end."""
    return [*(text or b"").lower().split(), END]


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("_text").cast(pa.binary()).to_pylist()


# Counts ----------------------------------------------------------------------------

def word_counts(rows: DataFrame) -> DataFrame:
    """(word, n) of all training tokens; each batch is counted before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for text in _texts(batch):
                counts.update(tokens(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
            )

    partial = rows.where(~F.col("held_out")).select("_text").mapInArrow(run, "word binary, n long")
    return partial.groupBy("word").agg(F.sum("n").alias("n"))


class Lexicon:
    """Numbers of the common words, with their cells and counts; others by hash."""

    def __init__(self, common: list[tuple[bytes, int]], cells: dict[int, tuple[int, int]], total: int, distinct: int, own: int, hashed: int, share: int):
        """``cells``: hash cell -> (words, tokens) of all words; ``share``: common words have a share-th of all tokens."""
        common = sorted(common, key=lambda x: (-x[1], x[0]))
        self.total, self.distinct, self.own, self.hashed = total, distinct, own, hashed
        self.words = [w for w, _ in common]
        self.n = np.array([n for _, n in common], np.int64)
        self.numbers = {w: i for i, (w, _) in enumerate(common)}
        self.logs = np.log10(self.n + 1.0)
        self.rare_most = -(-total // share)  # tokens that a rare word can have
        self.cell = np.array([i if i < own else own + self.hash(w) for i, w in enumerate(self.words)], np.int64)
        seen = np.zeros(own + hashed)
        types = np.zeros(own + hashed)
        for c, (words, n) in cells.items():
            types[own + c], seen[own + c] = words, n
        for i, (w, n) in enumerate(common[:own]):
            seen[i], types[i] = n, 1
            seen[own + self.hash(w)] -= n
            types[own + self.hash(w)] -= 1
        types[own:] += 1  # the word never seen
        mass = np.maximum(seen + types, 1.0)
        self.share = mass / mass.sum()

    def hash(self, word: bytes) -> int:
        return zlib.crc32(word) % self.hashed

    def unigram(self, n: np.ndarray) -> np.ndarray:
        """Probability of a word with ``n`` training tokens."""
        return (n + 1.0) / (self.total + self.distinct + 1.0)


class _Numbers(dict):
    """Number of a common word, or minus one minus the cell of any other."""

    def __init__(self, lex: Lexicon):
        super().__init__(lex.numbers)
        self.hash = lex.hash

    def __missing__(self, word: bytes) -> int:
        return -1 - self.hash(word)


def lexicon(counts: DataFrame, own: int = OWN, hashed: int = HASHED, share: int = COMMON) -> Lexicon:
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    common = counts.where(F.col("n") * share >= total).collect()  # at most ``share`` words
    cells = counts.groupBy((F.crc32("word") % hashed).cast("int").alias("cell")).agg(F.count("*").alias("words"), F.sum("n").alias("n"))
    found = {r.cell: (r.words, r.n) for r in cells.collect()}  # at most ``hashed`` rows
    return Lexicon([(bytes(r.word), r.n) for r in common], found, total, distinct, own, hashed, share)


def encoded(rows: DataFrame, lex: Lexicon) -> DataFrame:
    """Each text as cells, with what common words give and the list of the others.

    ``others`` are the tokens without a cell of their own, in order: a common word's number, or
    behind these a place in ``words``, the rarer words of the text, of which ``times`` is the count.
    """
    sent = rows.sparkSession.sparkContext.broadcast(lex)

    def begin():
        lex = sent.value
        get, n_common = _Numbers(lex).__getitem__, len(lex.words)

        def make(batch: pa.RecordBatch) -> dict[str, list]:
            out: dict[str, list] = {k: [] for k in ("n_tokens", "cells", "others", "n_common", "unigram", "words", "times")}
            for text in _texts(batch):
                own = tokens(text)
                numbers = np.fromiter(map(get, own), np.int64, len(own))
                rare = numbers < 0
                common = numbers[~rare]
                cells = lex.own - 1 - numbers
                cells[~rare] = lex.cell[common]
                names = [own[i] for i in np.flatnonzero(rare)]
                rest = Counter(names)
                place = {w: n_common + i for i, w in enumerate(rest)}
                numbers[rare] = [place[w] for w in names]
                out["n_tokens"].append(len(own))
                out["cells"].append(cells.astype("<u2").tobytes())
                out["others"].append(numbers[cells >= lex.own].astype("<u4").tobytes())
                out["n_common"].append(len(common))
                out["unigram"].append(float(lex.logs[common].sum()))
                out["words"].append(list(rest))
                out["times"].append(list(rest.values()))
            return out

        return make

    added = "n_tokens long, cells binary, others binary, n_common long, unigram double, words array<binary>, times array<int>"
    return add_columns(rows, added, begin, drop=("_text",))


def slots(cells: np.ndarray, others: np.ndarray, own: int) -> np.ndarray:
    """Numbers of the words of a text: the cell where it is a word's own, else from ``others``."""
    out = cells.astype(np.int64)
    out[cells >= own] = others
    return out


# The Markov model ------------------------------------------------------------------

@dataclass
class Model:
    start: np.ndarray  # states
    move: np.ndarray  # states x states
    emit: np.ndarray  # cells x states


def first_model(share: np.ndarray, states: int = STATES, seed: int = 3) -> Model:
    emit = share[:, None] * np.exp(0.5 * np.random.default_rng(seed).normal(size=(len(share), states)))
    move = np.full((states, states), (1 - STAY) / max(1, states - 1))
    np.fill_diagonal(move, STAY)
    return Model(np.full(states, 1 / states), move / move.sum(1, keepdims=True), emit / emit.sum(0))


def log_likelihoods(model: Model, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each sequence, by the scaled forward recursion.

    The longest sequences come first, so that those still running are always a prefix.
    """
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    out = np.zeros(len(order))
    running = np.searchsorted(-left, -np.arange(1, (left[0] if len(left) else 0) + 1), "right")
    alpha = np.empty((0, 0))
    for t, n in enumerate(running):
        seen = model.emit[flat[at[:n] + t]]
        alpha = (model.start if t == 0 else alpha[:n] @ model.move) * seen
        scale = alpha.sum(1)
        alpha /= scale[:, None]
        out[:n] += np.log(scale)
    back = np.empty_like(out)
    back[order] = out
    return back


def expected(
    model: Model, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, named: np.ndarray | None = None, names: int = 0
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Baum-Welch counts of some windows: starts, moves, emissions (cells x states).

    With ``named`` (a number below ``names`` for each token) emissions are counted by that.
    """
    order = np.argsort(-lengths, kind="stable")
    at, left = starts[order], lengths[order]
    steps, states = int(left[0]), len(model.start)
    running = np.searchsorted(-left, -np.arange(1, steps + 1), "right")
    rows = np.concatenate([[0], running.cumsum()])
    tokens_ = np.concatenate([at[:n] + t for t, n in enumerate(running)])
    seen = model.emit[flat[tokens_]]
    alpha = np.empty_like(seen)
    scale = np.empty(len(seen))
    for t, n in enumerate(running):
        here = slice(rows[t], rows[t] + n)
        a = (model.start if t == 0 else alpha[rows[t - 1] : rows[t - 1] + n] @ model.move) * seen[here]
        scale[here] = a.sum(1)
        alpha[here] = a / scale[here, None]
    moves = np.zeros((states, states))
    gamma = alpha.copy()
    beta = np.ones((int(running[-1]), states))
    for t in range(steps - 2, -1, -1):
        n, after = running[t], running[t + 1]
        nxt = slice(rows[t + 1], rows[t + 1] + after)
        ahead = seen[nxt] * beta / scale[nxt, None]
        moves += alpha[rows[t] : rows[t] + after].T @ ahead
        beta = np.ones((n, states))
        beta[:after] = ahead @ model.move.T
        gamma[rows[t] : rows[t] + n] *= beta
    moves *= model.move
    by, size = (flat, len(model.emit)) if named is None else (named, names)
    emitted = np.stack([np.bincount(by[tokens_], gamma[:, k], size) for k in range(states)], 1)
    return gamma[: running[0]].sum(0), moves, emitted


def improved(rows: DataFrame, model: Model, share: np.ndarray) -> Model:
    """One round: counts of each task, summed up by place, then the new model."""
    sent = rows.sparkSession.sparkContext.broadcast(model)
    states, cells = len(model.start), len(model.emit)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        total = np.zeros(states + states * states + cells * states)
        for batch in batches:
            starts, lengths, parts, size = [], [], [], 0

            def add() -> None:
                if size:
                    found = expected(model, np.concatenate(parts), np.array(starts), np.array(lengths))
                    total[:] += np.concatenate([x.ravel() for x in found])

            for raw in batch.column("cells").to_pylist():
                own = np.frombuffer(raw, "<u2")
                for first in range(0, len(own), WINDOW):
                    starts.append(size + first)
                    lengths.append(min(WINDOW, len(own) - first))
                parts.append(own)
                size += len(own)
                if size >= BLOCK:
                    add()
                    starts, lengths, parts, size = [], [], [], 0
            add()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at], pa.float64())], ["place", "n"])

    sums = rows.where(~F.col("held_out")).select("cells").mapInArrow(run, "place int, n double").groupBy("place").agg(F.sum("n").alias("n"))
    total = np.zeros(states + states * states + cells * states)
    for r in sums.toLocalIterator():  # as many rows as the model has parameters, at most
        total[r.place] = r.n
    start = total[:states] + 1
    move = total[states : states + states * states].reshape(states, states) + 1
    emit = total[states + states * states :].reshape(cells, states)
    # Each cell is also seen once by all states, as often as they are taken: rare words lean on that.
    emit = emit + PRIOR * share[:, None] + emit.sum(0) / max(emit.sum(), 1.0)
    return Model(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))


# Every word's emission --------------------------------------------------------------

def packed(counts: np.ndarray, unit: np.ndarray | float) -> list[np.ndarray]:
    """Counts (words x states) as integers of ``unit``, two states to a number."""
    whole = np.floor(counts * unit).astype(np.int64)
    whole = np.pad(whole, ((0, 0), (0, whole.shape[1] % 2)))
    return [whole[:, k] + (whole[:, k + 1] << 31) for k in range(0, whole.shape[1], 2)]


def unpacked(parts: list[np.ndarray], unit: np.ndarray | float, states: int) -> np.ndarray:
    pairs = [side for p in parts for side in (p & (2**31 - 1), p >> 31)]
    return np.stack(pairs[:states], 1) / unit


def word_states(rows: DataFrame, model: Model, lex: Lexicon) -> DataFrame:
    """``word``, ``n`` and the packed expected counts of each state, of all training words."""
    sent = rows.sparkSession.sparkContext.broadcast((model, lex))
    states = len(model.start)
    columns = [f"p{i}" for i in range(-(-states // 2))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, lex = sent.value
        n_common = len(lex.words)
        common, common_n = np.zeros((n_common, states)), np.zeros(n_common, np.int64)

        def made(names: list[bytes], n: np.ndarray, counts: np.ndarray, unit: np.ndarray | float) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(n, pa.int64()), *map(pa.array, packed(counts, unit))], ["word", "n", *columns])

        for batch in batches:
            ids: dict[bytes, int] = {}
            rare, rare_n = np.zeros((0, states)), np.zeros(0, np.int64)
            flats, named, starts, lengths, size = [], [], [], [], 0
            raws = zip(*(batch.column(c).to_pylist() for c in ("cells", "others", "words")))
            for i, (raw, others, words) in enumerate(raws):
                own = np.frombuffer(raw, "<u2")
                local = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
                rest = np.frombuffer(others, "<u4").astype(np.int64)
                behind = rest >= n_common
                rest[behind] = n_common + local[rest[behind] - n_common]
                starts += range(size, size + len(own), WINDOW)
                lengths += [min(WINDOW, len(own) - first) for first in range(0, len(own), WINDOW)]
                flats.append(own)
                named.append(slots(own, rest, lex.own))
                size += len(own)
                if size >= BLOCK or i + 1 == batch.num_rows:
                    every = np.concatenate(named)
                    found = expected(model, np.concatenate(flats), np.array(starts), np.array(lengths), every, n_common + len(ids))[2]
                    times = np.bincount(every, minlength=n_common + len(ids))
                    common += found[:n_common]
                    common_n += times[:n_common]
                    found, times = found[n_common:], times[n_common:]
                    found[: len(rare)] += rare
                    times[: len(rare)] += rare_n
                    rare, rare_n = found, times
                    flats, named, starts, lengths, size = [], [], [], [], 0
            if len(ids):
                yield made(list(ids), rare_n, rare, UNIT / lex.rare_most)
        at = np.flatnonzero(common_n)
        yield made([lex.words[i] for i in at], common_n[at], common[at], UNIT / lex.n[at][:, None])

    schema = "word binary, n long, " + ", ".join(f"{c} long" for c in columns)
    parts = rows.where(~F.col("held_out")).select("cells", "others", "words").mapInArrow(run, schema)
    return parts.groupBy("word").agg(*(F.sum(c).alias(c) for c in ("n", *columns)))


def _sides(states: int) -> list[Column]:
    """The packed counts of a table of words, as integers."""
    columns = [f"p{i}" for i in range(-(-states // 2))]
    return [side for c in columns for side in (F.col(c).bitwiseAND(F.lit(2**31 - 1)), F.shiftright(c, 31))][:states]


def shares(lex: Lexicon, states: int) -> list[Column]:
    """What a rarer word sends to a text: its share of each state in steps of a ``SHARE``-th, three to a number."""
    each = [F.floor(x / (UNIT / max(lex.rare_most, 1)) / F.col("n") * SHARE) for x in _sides(states)]
    parts = [each[k : k + 3] for k in range(0, states, 3)]
    return [sum((F.shiftleft(x, 21 * j) for j, x in enumerate(part[1:], 1)), part[0]).alias(f"q{k}") for k, part in enumerate(parts)]


def from_shares(parts: list[np.ndarray], n: np.ndarray, states: int) -> np.ndarray:
    """Counts (words x states) again."""
    each = [p >> 21 * j & SHARE for p in parts for j in range(3)][:states]
    return np.stack(each, 1) / SHARE * n[:, None]


@dataclass
class Emissions:
    """What turns a word's counts into its emission by each state."""

    taken: np.ndarray  # share of all tokens in each state
    scale: np.ndarray  # makes each state's emissions, the unseen word's too, add up to one
    common: np.ndarray  # words x states

    def joint(self, lex: Lexicon, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Unigram share of words, divided over the states."""
        return lex.unigram(n)[:, None] * (counts + LEAN * self.taken) / (n[:, None] + LEAN)

    def of(self, lex: Lexicon, n: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.joint(lex, n, counts) / self.scale

    def unseen(self, lex: Lexicon) -> np.ndarray:
        return lex.unigram(np.zeros(1)) * self.taken / self.scale


def emissions(table_: DataFrame, lex: Lexicon, states: int, share: int) -> Emissions:
    """Emissions of the common words, and the sums over all words that the others need."""
    columns = [f"p{i}" for i in range(-(-states // 2))]
    common = table_.where(F.col("n") * share >= lex.total)
    counts = np.zeros((len(lex.words), states))
    for r in common.collect():  # at most ``share`` words
        i = lex.numbers[bytes(r["word"])]
        counts[i] = unpacked([np.array([r[c]]) for c in columns], UNIT / lex.n[i], states)[0]
    sides = _sides(states)
    unit = UNIT / max(lex.rare_most, 1)
    factor = (F.col("n") + 1.0) / (F.col("n") + LEAN)
    rare = table_.where(F.col("n") * share < lex.total)
    sums = rare.agg(*(F.sum(x / unit) for x in sides), *(F.sum(factor * x / unit) for x in sides), F.sum(factor)).first()
    sums = [x or 0.0 for x in sums]
    made = Emissions(np.array(sums[:states]) + counts.sum(0), np.ones(states), counts)
    made.taken = made.taken / made.taken.sum()
    least = lex.unigram(np.zeros(1))[0]  # a token's share is ``least`` times (n + 1)
    made.scale = least * (np.array(sums[states : 2 * states]) + LEAN * made.taken * sums[-1]) + made.joint(lex, lex.n, counts).sum(0) + least * made.taken
    made.common = made.of(lex, lex.n, counts)
    return made


def likelihood(rows: DataFrame, model: Model, lex: Lexicon, found: Emissions) -> DataFrame:
    """``rows`` with ``score``: log10 probability of the whole text.

    ``rows`` has ``known``: the counts of those of its rarer words that training texts have.
    """
    sent = rows.sparkSession.sparkContext.broadcast((model, lex, found))

    def begin():
        model, lex, found = sent.value
        states, n_common, unseen = len(model.start), len(lex.words), found.unseen(lex)

        def make(batch: pa.RecordBatch) -> dict[str, list]:
            raw, others = batch.column("cells").to_pylist(), batch.column("others").to_pylist()
            n_words = batch.column("n_words").to_numpy()
            first = n_common + n_words.cumsum() - n_words
            flat = []
            for cells, rest, start in zip(raw, others, first.tolist()):
                rest = np.frombuffer(rest, "<u4").astype(np.int64)
                rest[rest >= n_common] += start - n_common
                flat.append(slots(np.frombuffer(cells, "<u2"), rest, lex.own))
            emit = np.concatenate([found.common, np.repeat(unseen[None], int(n_words.sum()), 0)])
            known = batch.column("known")
            items = known.flatten()
            if len(items):
                sizes = pc.fill_null(pc.list_value_length(known), 0).to_numpy(zero_copy_only=False)
                place_and_n = items.field("at").to_numpy()
                at, n = np.repeat(first, sizes) + (place_and_n >> 32), place_and_n & (2**32 - 1)
                emit[at] = found.of(lex, n, from_shares([items.field(f"q{k}").to_numpy() for k in range(-(-states // 3))], n, states))
            lengths = np.array([len(r) // 2 for r in raw])
            whole = Model(model.start, model.move, emit)
            return {"score": log_likelihoods(whole, np.concatenate(flat), lengths.cumsum() - lengths, lengths) / np.log(10)}

        return make

    return add_columns(rows, "score double", begin, drop=("cells", "others", "known"))


def score(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rounds: int = ROUNDS, states: int = STATES, own: int = OWN, hashed: int = HASHED, share: int = COMMON
) -> DataFrame:
    """``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    rows = docs.select(
        quoted(key).alias("_key"), held_out(quoted(key), HELD_PARTS, HELD_REST).alias("held_out"), F.coalesce(quoted(text), F.lit("")).alias("_text")
    )
    counts, counts_path = store(word_counts(rows), "words")
    lex = lexicon(counts, own, hashed, share)
    coded = stored(encoded(rows, lex).withColumn("row", F.monotonically_increasing_id()), "cells")
    per_token = F.lit(float(np.log10(lex.total + lex.distinct + 1)))
    head = [F.col("_key").alias(key), "held_out", "n_tokens"]
    if not lex.total:
        base = -F.col("n_tokens") * per_token
        return coded.select(*head, F.lit(0).cast("long").alias("n_known"), F.lit(0).cast("long").alias("train_tokens"), base.alias("base_score"), base.alias("score"))
    model = first_model(lex.share, states)
    for _ in range(rounds):
        model = improved(coded, model, lex.share)
    table_ = stored(word_states(coded, model, lex), "emissions")
    forget(rows.sparkSession, counts_path)
    found = emissions(table_, lex, states, share)
    # Each pair of a document and one of its rarer words, once.
    pairs = coded.select("row", F.posexplode(F.arrays_zip("words", "times")).alias("i", "w")).select("row", "i", "w.words", "w.times")
    sent = table_.select("word", "n", *shares(lex, states))
    place_and_n = (F.shiftleft(F.col("i").cast("long"), 32) + F.col("n")).alias("at")
    known = pairs.withColumnRenamed("words", "word").join(sent, "word").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("rare"),
        F.sum("times").alias("n_rare"),
        F.collect_list(F.struct(place_and_n, *sent.columns[2:])).alias("known"),
    )
    slim = coded.withColumn("n_words", F.size("words").cast("long")).drop("words", "times")
    each = likelihood(slim.join(known, "row", "left").na.fill({"rare": 0.0, "n_rare": 0}), model, lex, found)
    return each.select(
        *head,
        (F.col("n_common") + F.col("n_rare")).cast("long").alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("unigram") + F.col("rare") - F.col("n_tokens") * per_token).alias("base_score"),
        "score",
    )


def op3_markov(spark, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))


QUERIES = {"op3_markov": op3_markov}
SQL: dict[str, str] = {}
