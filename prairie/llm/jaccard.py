"""Near duplicates: a Jaccard join of shingle sets, rare shingles first.

Documents with equal sets are one class, joined by a digest of the set. Classes are joined
by the shingles of their prefixes, in an order that puts frequent shingles last. A pair must
pass the length filter, the positional filter and the suffix filter (the rest of both sets
is cut into ranges; the parities of the ranges' sizes bound the difference from below), is
taken in the first bucket that both classes share, and is verified once, on the whole sets.
64-bit hashes stand for shingles.

What counts is which documents are connected. So first each class is verified against one
hub, the class of its buckets that shares most; then only pairs between different
components of that graph are left. A large bucket is cut into blocks, and a task
compares two blocks: no bucket meets in one task, and no pair leaves it that the filters
exclude. Nothing is capped or sampled: the result is that of comparing all pairs.

Defined results: a null or blank text has no shingles and is linked with nothing; fewer
words than a shingle has are one shingle; rows with equal texts (repeated rows too) are
linked; ids may repeat or be null, null ids are never the component's name while it has
another; other columns do no harm; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prairie.llm.batches import add_columns, give_back
from prairie.llm.columns import content_hash, free_name, quoted
from prairie.operators.graph import components
from prairie.session import forget, store, stored, table

SHINGLE = 5
PERCENT = 80
FREQUENT = 4_000_000  # shingles above this share of all are ordered by their counts; bounds what is broadcast (32 MB)
RANGES = 512  # of the suffix filter in a bucket; a power of two
BLOCK = 256  # classes of a bucket that one side of a comparison holds
MARKS = 1 << 20  # of the bitmap that says which classes need their texts


_BLANK = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_FOLD = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _chained(each: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    n = len(each) - width + 1
    h = np.full(max(n, 0), width, np.uint64)
    for i in range(width if n > 0 else 0):
        h = (h ^ each[i : i + n]) * _MIX
        h ^= h >> np.uint64(29)
    return _mixed(h)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, and where each text's words begin (and the end).

    A word's hash is a sum over its bytes, weighed by their places, for all words at once.
    """
    raw = _FOLD[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    inside = ~_BLANK[raw]
    starts = np.flatnonzero(inside & np.concatenate([[True], ~inside[:-1]]))
    bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    first = np.searchsorted(starts, bounds)
    if not len(starts):
        return np.zeros(0, np.uint64), first
    place = np.arange(starts[0], len(raw)) - np.repeat(starts, np.diff(np.append(starts, len(raw))))
    place[~inside[starts[0] :]] = 0
    powers = np.cumprod(np.full(int(place.max()) + 1, _MIX))
    values = np.where(inside[starts[0] :], _BYTES[raw[starts[0] :]] * powers[place], np.uint64(0))
    return _mixed(np.add.reduceat(values, starts - starts[0])), first


def shingle_sets(texts: list[bytes | None], width: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of the shingles of each text; some megabytes at a time."""
    texts = [t or b"" for t in texts]
    out: list[np.ndarray] = []
    begin = 0
    while begin < len(texts):
        end, size = begin, 0
        while end < len(texts) and (end == begin or size < 1 << 21):
            size += len(texts[end])
            end += 1
        each, first = word_hashes(texts[begin:end])
        whole = _chained(each, width)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            out.append(np.unique(whole[a : b - width + 1] if b - a >= width else _chained(each[a:b], b - a) if b > a else whole[:0]))
        begin = end
    return out


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(a) + len(b) - len(np.union1d(a, b))
    return bool(len(a) and len(b)) and 100 * both >= percent * (len(a) + len(b) - both)


def needed(a, b, percent: int):
    """Least number of common shingles of sets of these sizes that link."""
    return -(-(percent * (a + b)) // (100 + percent))


def prefix_length(size: int, percent: int) -> int:
    """Shingles of which at least one is shared with every set that links."""
    return size - -(-percent * size // 100) + 1 if size else 0


def _digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def _parities(hashes: np.ndarray) -> np.ndarray:
    """Bits that say which ranges hold an odd number of hashes; as many ranges as hashes, or more."""
    ranges = max(RANGES, 1 << int(len(hashes) - 1).bit_length())
    counts = np.bincount((hashes & np.uint64(ranges - 1)).astype(np.int64), minlength=ranges)
    return np.packbits((counts & 1).astype(np.uint8))


def _folded(bits: np.ndarray, size: int) -> np.ndarray:
    """Parities of fewer, wider ranges: ``size`` bytes."""
    while len(bits) > size:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def may_be_near(a: bytes, b: bytes, n: int, m: int, percent: int) -> bool:
    """The suffix filter: the parities that differ are no more than the shingles that may."""
    size = min(len(a), len(b))
    x, y = (_folded(np.frombuffer(c, np.uint8), size) for c in (a, b))
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64)) <= n + m - 2 * needed(n, m, percent)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("_text").cast(pa.binary()).to_pylist()


def digests(rows: DataFrame, width: int) -> DataFrame:
    """``_key``, ``class``, ``size``; and what the batch says about shingles in several texts."""

    def begin():
        def make(batch: pa.RecordBatch) -> dict[str, list]:
            sets = shingle_sets(_texts(batch), width)
            found, times = np.unique(np.concatenate(sets), return_counts=True)
            some = times > 1
            n = len(sets)
            return {
                "class": [_digest(s) for s in sets],
                "size": [len(s) for s in sets],
                "shingles": [found[some].view(np.int64).tolist()] + [[]] * (n - 1),
                "times": [times[some].tolist()] + [[]] * (n - 1),
            }

        return make

    return add_columns(rows, "class binary, size long, shingles array<long>, times array<long>", begin, drop=("_text",))


def frequent(rows: DataFrame) -> np.ndarray:
    """Hashes of shingles with at least a ``FREQUENT``-th of all, the rarest first.

    There are at most ``FREQUENT`` of them. Counts leave out shingles that a batch holds once,
    which changes the order and not the result.
    """
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    each = rows.where(F.size("shingles") > 0).select(F.explode(F.arrays_zip("shingles", "times")).alias("s"))
    counts = each.groupBy(F.col("s.shingles").alias("h")).agg(F.sum("s.times").alias("n"))
    some = counts.where(F.col("n") * FREQUENT >= total).orderBy("n", "h").select("h").toArrow()
    return some["h"].to_numpy().astype(np.int64).view(np.uint64)


def entries(rows: DataFrame, order: np.ndarray, width: int, percent: int) -> DataFrame:
    """``class``, ``size``, ``prefix`` and the parities, of few (``parities``) and of all ranges (``fine``)."""
    sent = rows.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_hash = np.sort(sent.value)
        place = np.argsort(sent.value)  # of the sorted hashes, in the order
        for batch in batches:
            names, sizes, parities, fine, parts = [], [], [], [], []
            seen = set()
            for hashes in shingle_sets(_texts(batch), width):
                name = _digest(hashes)
                if not len(hashes) or name in seen:
                    continue
                seen.add(name)
                rank = np.zeros(len(hashes), np.int64)
                if len(by_hash):
                    at = np.minimum(np.searchsorted(by_hash, hashes), len(by_hash) - 1)
                    rank = np.where(by_hash[at] == hashes, place[at] + 1, 0)
                first = np.lexsort((hashes, rank))[: prefix_length(len(hashes), percent)]
                names.append(name)
                sizes.append(len(hashes))
                bits = _parities(hashes)
                parities.append(_folded(bits, RANGES // 8).tobytes())
                fine.append(bits.tobytes())
                parts.append(hashes[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.binary()), pa.array(sizes, pa.int32()), pa.array(parities, pa.binary()), pa.array(fine, pa.binary()), pa.array(parts, pa.list_(pa.int64()))],
                ["class", "size", "parities", "fine", "prefix"],
            )
        give_back()

    return rows.select("_text").mapInArrow(run, "class binary, size int, parities binary, fine binary, prefix array<long>")


def texts_of(rows: DataFrame, pairs: DataFrame, classes: DataFrame, width: int) -> tuple[DataFrame, str]:
    """(id, text) of the classes that occur in ``pairs``, each once, and where they are written.

    A bitmap of ``MARKS`` bits keeps most other texts out of the shuffle.
    """
    wanted = pairs.select(F.col("x").alias("id")).union(pairs.select("y")).distinct().join(classes.select("id", "class"), "id")
    marks = wanted.select((F.crc32("class") % MARKS).cast("int").alias("m")).distinct().collect()  # at most MARKS
    bitmap = np.zeros(MARKS, bool)
    bitmap[[r.m for r in marks]] = True
    sent = rows.sparkSession.sparkContext.broadcast(np.packbits(bitmap))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.unpackbits(sent.value)
        for batch in batches:
            found = {}
            texts = _texts(batch)
            for text, hashes in zip(texts, shingle_sets(texts, width)):
                name = _digest(hashes)
                if bitmap[zlib.crc32(name) % MARKS] and name not in found:
                    found[name] = text or b""
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.binary())], ["class", "text"])
        give_back()

    each = rows.select("_text").mapInArrow(run, "class binary, text binary")
    return store(each.join(wanted, "class").select("id", "text").dropDuplicates(["id"]), "texts")


def still_near(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that pass the suffix filter over all ranges of their parities."""
    side = lambda n: classes.select(F.col("id").alias(n), F.col("size").alias(f"size_{n}"), F.col("fine").alias(f"fine_{n}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("fine_x", "fine_y", "size_x", "size_y")]
            yield batch.select(["x", "y"]).filter(pa.array([may_be_near(*r, percent) for r in zip(*columns)], pa.bool_()))

    return both.mapInArrow(run, "x long, y long")


def verified(pairs: DataFrame, rows: DataFrame, classes: DataFrame, width: int, percent: int, used: list[str]) -> DataFrame:
    """The (x, y) pairs of classes that link, by their whole sets; few that do not get as far as that.

    ``used`` gets the paths of tables that nothing reads once the result is written.
    """
    pairs, pairs_path = store(still_near(pairs, classes, percent), "pairs")
    texts, texts_path = texts_of(rows, pairs, classes, width)
    used += [pairs_path, texts_path]
    own = pairs.join(texts.select(F.col("id").alias("x"), F.col("text").alias("a")), "x").join(
        texts.select(F.col("id").alias("y"), F.col("text").alias("b")), "y"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_sets(batch.column(c).to_pylist(), width) for c in "ab"]
            yield batch.select(["x", "y"]).filter(pa.array([linked(s, t, percent) for s, t in zip(*sets)], pa.bool_()))

    return own.select("x", "y", "a", "b").mapInArrow(run, "x long, y long")


def _may_link(a: str, b: str, percent: int):
    """Length and positional filter on columns size_a, pos_a, size_b, pos_b."""
    n, m = F.col(f"size_{a}"), F.col(f"size_{b}")
    need = F.ceil(percent * (n + m) / (100 + percent) - 1e-9)
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (F.least(n - F.col(f"pos_{a}"), m - F.col(f"pos_{b}")) >= need)


def hub_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """For each class one partner: of its buckets' hubs, the one that shares most of them.

    A bucket's hub is the class whose buckets hold most entries.
    """
    weights = shared.groupBy("id").agg(F.sum("n").alias("weight"))
    weighed = shared.join(weights, "id")
    hubs = weighed.groupBy("hash").agg(F.max(F.struct("weight", "id", "size", "pos")).alias("hub"))
    both = shared.join(hubs, "hash").where(F.col("id") != F.col("hub.id")).select(
        F.col("id").alias("x"), F.col("size").alias("size_x"), F.col("pos").alias("pos_x"),
        F.col("hub.id").alias("y"), F.col("hub.size").alias("size_y"), F.col("hub.pos").alias("pos_y"),
    )
    counted = both.where(_may_link("x", "y", percent)).groupBy("x", "y").agg(F.count("*").alias("n"))
    best = counted.groupBy("x").agg(F.max(F.struct("n", "y")).alias("best"))
    return best.select(F.least("x", "best.y").alias("x"), F.greatest("x", "best.y").alias("y")).distinct()


def _pairs_of(rows: pa.RecordBatch, percent: int) -> tuple[list[int], list[int]]:
    """Pairs of whole groups (rows sorted by hash, left, right) that pass all filters."""
    column = lambda c: rows.column(c).to_numpy()
    ids, size, pos, root, block = (column(c).astype(np.int64) for c in ("id", "size", "pos", "root", "block"))
    group = _groups(rows)
    mixed = column("left") != column("right")
    bits = np.frombuffer(b"".join(rows.column("parities").to_pylist()), np.uint64).reshape(len(ids), -1)
    before = rows.column("before")
    xs, ys = [], []
    at = np.arange(len(ids))
    for step in range(1, len(ids)):  # each row with the row ``step`` further on in its group
        at = at[: np.searchsorted(at, len(ids) - step)]
        at = at[group[at] == group[at + step]]
        if not len(at):
            break
        i, j = at, at + step
        need = needed(size[i], size[j], percent)
        fits = (root[i] != root[j]) & (100 * np.minimum(size[i], size[j]) >= percent * np.maximum(size[i], size[j]))
        fits &= (np.minimum(size[i] - pos[i], size[j] - pos[j]) >= need) & (~mixed[i] | (block[i] != block[j]))
        i, j, need = i[fits], j[fits], need[fits]
        close = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64) <= size[i] + size[j] - 2 * need
        for a, b in zip(i[close].tolist(), j[close].tolist()):
            if not set(before[a].as_py()) & set(before[b].as_py()):  # else an earlier bucket has the pair
                xs.append(min(ids[a], ids[b]))
                ys.append(max(ids[a], ids[b]))
    return xs, ys


def _groups(rows: pa.RecordBatch) -> np.ndarray:
    """Numbers of the runs of equal (hash, left, right)."""
    change = np.zeros(rows.num_rows, bool)
    for c in ("hash", "left", "right"):
        v = rows.column(c).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return change.cumsum()


def crossing_pairs(shared: DataFrame, classes: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that pass all filters, each once."""
    own = shared.join(roots.select(F.col("node").alias("id"), "root"), "id", "left")
    own = own.select("hash", "id", "size", "pos", "n", F.coalesce("root", "id").alias("root"))
    live = own.groupBy("hash").agg(F.min("root").alias("a"), F.max("root").alias("b")).where("a <> b").select("hash")
    kept = own.join(live, "hash", "left_semi")
    # One row for each class: its entries in order, at most as many as its prefix has.
    each = kept.groupBy("id", "size", "root").agg(F.sort_array(F.collect_list(F.struct("pos", "hash", "n"))).alias("all"))
    each = each.join(classes.select("id", "parities"), "id")
    spread = each.select("id", "size", "root", "parities", F.col("all.hash").alias("hashes"), F.posexplode("all").alias("i", "e")).select(
        "id", "size", "root", "parities", F.slice("hashes", F.lit(1), F.col("i")).alias("before"),
        F.col("e.hash").alias("hash"), F.col("e.pos").alias("pos"), F.ceil(F.col("e.n") / BLOCK).cast("int").alias("blocks"),
    )
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    placed = spread.withColumn("block", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left, right = F.least("block", "other"), F.greatest("block", "other")
    dealt = placed.withColumn("left", left).withColumn("right", right).drop("other", "blocks")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []  # the group that the next batch may go on with

        def found(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
            x, y = _pairs_of(pa.concat_batches(rows), percent) if rows else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["x", "y"])

        for batch in batches:
            if not batch.num_rows:
                continue
            whole = pa.concat_batches([*rest, batch])
            group = _groups(whole)
            cut = int(np.searchsorted(group, group[-1]))
            if cut:
                yield found([whole.slice(0, cut)])
            rest = [whole.slice(cut)]
        yield found(rest)

    # A group has at most two blocks, of about BLOCK rows each.
    return dealt.repartition("hash", "left", "right").sortWithinPartitions("hash", "left", "right").mapInArrow(compare, "x long, y long")


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows (``_key``, ``class``, ``size``), classes (``class``, ``id``), and ``node``, ``root`` of ids that link."""
    rows = docs.select(quoted(key).alias("_key"), F.coalesce(quoted(text), F.lit("")).alias("_text"))
    members = stored(digests(rows, width), "members")
    once = entries(rows, frequent(members), width, percent).dropDuplicates(["class"])
    classes = stored(once.withColumn("id", F.monotonically_increasing_id()), "classes")
    each = classes.select("id", "size", F.posexplode("prefix").alias("pos", "hash"))
    counts = each.groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    shared, path = store(each.join(counts, "hash").select("hash", "id", "size", "pos", "n"), "shared")
    used = [path]
    first, path = store(verified(hub_pairs(shared, percent), rows, classes, width, percent, used), "links")
    roots, roots_path = store(components(first, "x", "y"), "roots")
    used += [path, roots_path]
    second = verified(crossing_pairs(shared, classes, roots, percent), rows, classes, width, percent, used)
    stars = roots.where("node <> root").select(F.col("node").alias("x"), F.col("root").alias("y"))
    found = stored(components(stars.union(second), "x", "y"), "components")
    for path in used:
        forget(docs.sparkSession, path)
    return members.select("_key", "class", "size"), classes.select("class", "id"), found


def near(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``key``, ``n_shingles`` and ``component_id`` (the smallest key reachable) of every row."""
    members, classes, roots = links(docs, key, text, width, percent)
    least = members.where("size > 0").groupBy("class").agg(F.min("_key").alias("least"))
    named = least.join(classes, "class").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    found = named.join(least, "root").select("class", "component")
    return members.join(found, "class", "left").select(
        F.col("_key").alias(key),
        F.col("size").alias("n_shingles"),
        F.when(F.col("size") == 0, F.col("_key")).otherwise(F.col("component")).alias("component_id"),
    )


def op7_jaccard(spark, sf_dir: str) -> DataFrame:
    return near(table(spark, sf_dir, "documents"), width=4, percent=85)


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id."""
    name = free_name(docs, "_name")
    named = docs.withColumn(name, F.struct(quoted("doc_id").alias("id"), content_hash(docs).alias("h")))
    found = near(named.select(name, "text"), name)
    kept = found.where(F.col(name) == F.col("component_id")).select(name).distinct()
    return named.join(kept, name, "left_semi").dropDuplicates([name]).drop(name)


QUERIES = {"op7_jaccard": op7_jaccard}
SQL = {
    "op7_jaccard": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT r, array_to_string(list_slice(ws, p, p + 3), ' ') AS g
  FROM (SELECT r, ws, unnest(range(1, greatest(1, len(ws) - 3) + 1)) AS p FROM d WHERE len(ws) > 0)),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
i AS (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY ALL),
e AS (SELECT a, b FROM i JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
c AS (SELECT a, b FROM e UNION SELECT c.a, e.b FROM c JOIN e ON c.b = e.a),
m AS (SELECT a AS r, min(doc_id) AS low FROM c JOIN d ON d.r = c.b GROUP BY a)
SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)"""
}
