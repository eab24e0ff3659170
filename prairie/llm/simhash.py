"""Near duplicates by SimHash: a binary trie joined with itself.

A text's words, A-Z lowered, give shingles of ``WIDTH`` words; a bit of the fingerprint is
set if it is set in over half of the shingles' XXH64 values (seed ``SEED``, repeats count).
Distinct fingerprints are the leaves of a binary trie. The join traverses pairs of trie nodes
of equal depth, adds up the bits in which their paths differ, and drops a pair once these are
more than ``BITS``. The upper levels are a table of node pairs that Spark expands by ``STEP``
levels at a time, until both nodes of a pair hold at most ``LEAF`` fingerprints; the
fingerprints of such a pair meet in one task, which goes on from there, bit by bit, with
arrays of node pairs of bounded length.

A task does not list the links it finds: it keeps a label for each fingerprint and returns
one edge for each that is linked, so a dense group gives as many rows as it has members. The
components of these edges are those of all links.

Defined results: a null, empty or blank text has no words and the fingerprint zero, which
links like any other; fewer words than a shingle has are one shingle; equal texts (repeated
rows too) are linked; ids may repeat or be null, and a null id names a component only where
it has no other; other columns do no harm; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prairie.llm.batches import add_columns
from prairie.llm.columns import quoted
from prairie.operators.graph import components
from prairie.session import stored, table

WIDTH = 3
SEED = 42
BITS = 3
LEAF = 1 << 15  # fingerprints of a trie node that one task takes
STEP = 4  # levels of the trie in a round
FRONTIER = 1 << 17  # node pairs that a task expands at a time
DIRECT = 32  # a node pair with at most so many pairs of fingerprints is compared directly
SHINGLES = 1 << 17  # hashes that are counted at a time

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


# Fingerprints ----------------------------------------------------------------------

def shingle_hashes(text: bytes | None, width: int = WIDTH) -> list[int]:
    """XXH64 of each shingle, in order; none without words."""
    words = (text or b"").lower().split()  # of bytes: A-Z, and blank and U+0009 to U+000D, alone
    hash_ = xxhash.xxh64_intdigest
    if len(words) <= width:
        return [hash_(b" ".join(words), SEED)] if words else []
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [hash_(line[a:b], SEED) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())]


def majorities(hashes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of hashes; runs have the given sizes."""
    n = len(sizes)
    owner = np.repeat(np.arange(n), sizes) * 256
    octets = hashes.view(np.uint8).reshape(-1, 8)
    counts = [np.bincount(owner + octets[:, k], minlength=n * 256).reshape(n, 256) @ _BYTE_BITS for k in range(8)]
    over = 2 * np.concatenate(counts, axis=1) > np.asarray(sizes)[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


def fingerprints_of(texts: list[bytes | None], width: int = WIDTH) -> np.ndarray:
    """Fingerprints of the texts, counted some texts at a time."""
    out, held, sizes = [], [], []

    def flush() -> None:
        out.append(majorities(np.array(held, "<u8"), np.array(sizes, np.int64)))
        held.clear()
        sizes.clear()

    for text in texts:
        hashes = shingle_hashes(text, width)
        held += hashes
        sizes.append(len(hashes))
        if len(held) >= SHINGLES or len(sizes) >= 1024:
            flush()
    if sizes:
        flush()
    return np.concatenate(out) if out else np.zeros(0, "<u8")


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``_key`` and ``fp`` (64 bits as a long) of every row."""

    def begin():
        def make(batch: pa.RecordBatch) -> dict[str, list]:
            found = fingerprints_of(batch.column("_text").cast(pa.binary()).to_pylist(), width)
            return {"fp": pa.array(found.view("<i8"), pa.int64())}

        return make

    return add_columns(docs.select(quoted(key).alias("_key"), quoted(text).alias("_text")), "fp long", begin, drop=("_text",))


# The join inside a task ------------------------------------------------------------

def _ranges(lo_a, n_a, lo_b, n_b) -> tuple[np.ndarray, np.ndarray]:
    """All (i, j) of each pair of ranges."""
    sizes = n_a * n_b
    at = np.arange(int(sizes.sum())) - np.repeat(sizes.cumsum() - sizes, sizes)
    width = np.repeat(n_b, sizes)
    return np.repeat(lo_a, sizes) + at // width, np.repeat(lo_b, sizes) + at % width


def close_pairs(a: np.ndarray, b: np.ndarray, same: bool, depth: int = 0, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of fingerprints that differ in at most ``bits`` bits, some pairs at a time.

    ``a`` and ``b`` are sorted, and each shares its first ``depth`` bits. With ``same`` they
    are one array, and each pair comes once (i < j). A node is a range of an array.
    """
    ones: dict[tuple[bool, int], np.ndarray] = {}

    def split(second: bool, shift: int, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Where the ones of bit ``shift`` begin in each node."""
        where = (second and not same, shift)
        if where not in ones:
            bit = ((b if second else a) >> np.uint64(shift)) & np.uint64(1)
            ones[where] = np.concatenate([[0], np.cumsum(bit.astype(np.int32), dtype=np.int32)])
        return hi - (ones[where][hi] - ones[where][lo])

    def errors(depth: int) -> int:
        return int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0

    if not len(a) or not len(b):
        return
    first = tuple(np.array([v], np.int32) for v in (0, len(a), 0, len(b), errors(depth)))
    stack = [(depth, first)]
    while stack:
        depth, nodes = stack.pop()
        n_a, n_b = (nodes[1] - nodes[0]).astype(np.int64), (nodes[3] - nodes[2]).astype(np.int64)
        small = (n_a * n_b <= DIRECT) | (depth == 64)
        if small.any():
            i, j = _ranges(nodes[0][small], n_a[small], nodes[2][small], n_b[small])
            fits = np.bitwise_count(a[i] ^ b[j]) <= bits
            if same:
                fits &= i < j
            if fits.any():
                yield i[fits], j[fits]
        if small.all():
            continue
        la, ha, lb, hb, err = (v[~small] for v in nodes)
        shift = 63 - depth
        ma, mb = split(False, shift, la, ha), split(True, shift, lb, hb)
        twice = (la == lb) & (ha == hb) if same else np.zeros(len(la), bool)
        children = []
        for (x, y), (u, v), more in (((la, ma), (lb, mb), 0), ((ma, ha), (mb, hb), 0), ((la, ma), (mb, hb), 1), ((ma, ha), (lb, mb), 1)):
            live = (x < y) & (u < v) & (err + more <= bits)
            if more and x is ma:
                live &= ~twice  # the pair the other way round
            children.append([c[live] for c in (x, y, u, v, err + more)])
        whole = [np.concatenate(c) for c in zip(*children)]
        for at in range(0, len(whole[0]), FRONTIER):
            stack.append((depth + 1, tuple(c[at : at + FRONTIER] for c in whole)))


def join_labels(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the groups of ``i`` and ``j`` in place; a group's label is its least place."""
    i, j = label[i], label[j]
    while (apart := i != j).any():
        low, high = np.minimum(i[apart], j[apart]), np.maximum(i[apart], j[apart])
        np.minimum.at(label, high, low)
        while (up := label[label]).tobytes() != label.tobytes():
            label[:] = up
        i, j = label[low], label[high]


def linked(a: np.ndarray, b: np.ndarray | None, depth: int = 0, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """One edge for each fingerprint of ``a`` (and ``b``) that is linked and not its group's first."""
    a = np.sort(a)
    b = a if b is None else np.sort(b)
    same = b is a
    both = a if same else np.concatenate([a, b])
    label = np.arange(len(both), dtype=np.int64)
    for i, j in close_pairs(a, b, same, depth, bits):
        join_labels(label, i, j if same else j + len(a))
    moved = np.flatnonzero(label != np.arange(len(label)))
    return both[moved], both[label[moved]]


# The join of the upper levels ------------------------------------------------------

def _node(depth: int, fp: str = "fp") -> Column:
    """The trie node of a fingerprint: its first bits."""
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")


def _compared(pairs: DataFrame, prints: DataFrame, depth: int, bits: int) -> DataFrame:
    """Edges between the fingerprints of node pairs, at most ``LEAF`` a node."""
    wanted = pairs.select(F.col("a").alias("p")).union(pairs.select("b")).distinct()
    blocks = prints.select(_node(depth).alias("p"), "fp").join(wanted, "p", "left_semi").groupBy("p").agg(F.collect_list("fp").alias("fps"))
    left = blocks.select(F.col("p").alias("a"), F.col("fps").alias("fps_a"))
    right = blocks.select(F.col("p").alias("b"), F.col("fps").alias("fps_b"))
    both = pairs.select("a", "b").join(left, "a").join(right, "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = zip(batch.column("a").to_pylist(), batch.column("b").to_pylist())
            for k, (p, q) in enumerate(names):
                a, b = (batch.column(c)[k].values.to_numpy().view("<u8") for c in ("fps_a", "fps_b"))
                x, y = linked(a, None if p == q else b, depth, bits)
                if len(x):
                    yield pa.RecordBatch.from_arrays([pa.array(v.view("<i8"), pa.int64()) for v in (x, y)], ["x", "y"])

    return both.mapInArrow(run, "x long, y long")


def edges(prints: DataFrame, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """Edges (``x``, ``y``) whose components are those of all links of the distinct ``fp``."""
    spark = prints.sparkSession
    found = spark.createDataFrame([], "x long, y long")
    pairs = spark.createDataFrame([(0, 0, 0)], "a long, b long, differing int")
    for depth in range(0, 65, STEP):
        sizes = prints.groupBy(_node(depth).alias("p")).agg(F.count("*").alias("n"))
        left = sizes.select(F.col("p").alias("a"), F.col("n").alias("n_a"))
        right = sizes.select(F.col("p").alias("b"), F.col("n").alias("n_b"))
        sized = stored(pairs.join(left, "a").join(right, "b"), "node-pairs")
        whole = F.greatest("n_a", "n_b") <= leaf
        n_whole, n_open = sized.agg(F.count_if(whole), F.count_if(~whole)).first()
        if n_whole:
            found = found.union(stored(_compared(sized.where(whole), prints, depth, bits), "links"))
        if not n_open:
            break
        below = prints.select(_node(depth + STEP).alias("kid")).distinct().select("kid", F.shiftrightunsigned("kid", STEP).alias("up"))
        kids = stored(below, "nodes")  # a node has at most 2 ** STEP
        first = kids.select(F.col("up").alias("a"), F.col("kid").alias("kid_a"))
        second = kids.select(F.col("up").alias("b"), F.col("kid").alias("kid_b"))
        low = F.lit((1 << STEP) - 1).cast("long")
        errors = F.col("differing") + F.bit_count(F.col("kid_a").bitwiseXOR(F.col("kid_b")).bitwiseAND(low))
        met = sized.where(~whole).join(first, "a").join(second, "b").where("kid_a <= kid_b")
        pairs = met.select(F.col("kid_a").alias("a"), F.col("kid_b").alias("b"), errors.alias("differing")).where(F.col("differing") <= bits)
    return found


def near(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, bits: int = BITS, leaf: int = LEAF) -> DataFrame:
    """``key``, ``fingerprint`` (16 hex digits) and ``component_id`` (the smallest key reachable) of every row."""
    rows = stored(fingerprints(docs, key, text, width), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("_key").alias("least")), "distinct")
    roots = components(edges(prints.select("fp"), bits, leaf), "x", "y").withColumnRenamed("node", "fp")
    named = stored(prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "roots")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    found = named.join(least, "root").select("fp", "component")
    return rows.join(found, "fp").select(
        F.col("_key").alias(key),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op13_simhash(spark, sf_dir: str) -> DataFrame:
    return near(table(spark, sf_dir, "documents"))


QUERIES = {"op13_simhash": op13_simhash}
#: XXH64 is beyond DuckDB's SQL; tests hold the rows against a brute-force version.
SQL: dict[str, str] = {}
