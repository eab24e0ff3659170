"""Prefix trie of conversations: one node for each distinct sequence of first turns.

A turn (role, text) is a 128-bit hash; the digest of a sequence of turns is the sum of
hash times BASE to the power of its place, modulo a prime of 127 bits. Sums can be cut anywhere, so
a long conversation is numbered and summed in several range partitions, each with what the
partitions before it carry over, and a conversation that takes over the first turns of
another one gets its digests by moving the sums along.

The distinct digests are the nodes; Spark counts members before they are shuffled. A shard takes whole
subtrees, so that a node and its parent meet. It holds its nodes in a minimal perfect hash
table: digests get slots without gaps, a lookup compares the slot's digest, and a digest that
is not in the shard has no slot. Counts are scattered into flat arrays by slot, and go up
through an array of parent slots, the deepest nodes first. Subtrees of more than ``SUBTREE``
nodes are cut: their top nodes wait for another round, in which the sums of the subtrees below
come in as one number each. The bound doubles each round up to ``LARGEST``, so that rounds
grow with the logarithm of the trie's depth.

Defined results: a null role or text is an empty one; null turns come first; rows of equal
turn are in the order of their (role, text) hashes, and equal rows are turns of their own;
rows without a conversation id are no conversation; other columns do no harm; an empty table
gives no rows. The digest over the members that end in a node reads their ids in order; the
ids are joined into pieces in parallel, and only these pieces of one node are read in sequence.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prairie.llm.columns import quoted, words
from prairie.session import forget, store, stored, table

PRIME = (1 << 127) - 1
BASE = 0x5DEECE66D1CE4E5B9BF58476D1CE4E5B
SUBTREE = 2048  # nodes of a subtree that is not cut, in the first round
LARGEST = 1 << 20  # and in any round
SHARD = 1024  # nodes of a shard on average, in the first round
PIECE = 1 << 16  # characters of joined ids
ROOT = bytes(16)
GAMMA = 2  # cells for each key on a level of the perfect hash


def _number(raw: bytes) -> int:
    return int.from_bytes(raw, "big")


def _raw(value: int) -> bytes:
    return (value % PRIME).to_bytes(16, "big")


# Prefix digests --------------------------------------------------------------------

def turns(rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``hash`` (16 bytes) and ``words`` of every row with an id."""
    role_, text_ = (F.coalesce(quoted(c), F.lit("")) for c in (role, text))
    said = F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_)
    return rows.where(quoted(key).isNotNull()).select(
        quoted(key).cast("long").alias("conv"),
        quoted(turn).alias("turn"),
        F.unhex(F.substring(F.sha2(said, 256), 1, 32)).alias("hash"),
        F.size(words(text_)).cast("long").alias("words"),
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places and sums inside the partition, for each conversation."""
    part, conv, place, power, total = TaskContext.get().partitionId(), None, 0, 1, 0
    for batch in batches:
        places, before, upto = [], [], []
        for c, raw in zip(batch.column("conv").to_pylist(), batch.column("hash").to_pylist()):
            if c != conv:
                conv, place, power, total = c, 0, 1, 0
            place += 1
            power = power * BASE % PRIME
            before.append(_raw(total))
            total = (total + _number(raw) * power) % PRIME
            places.append(place)
            upto.append(_raw(total))
        new = [pa.array([part] * len(places), pa.int32()), pa.array(places, pa.int64()), pa.array(before, pa.binary()), pa.array(upto, pa.binary())]
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("words"), *new], ["conv", "words", "part", "place", "before", "upto"])


def carried(ends: list) -> dict[int, tuple[int, int, int]]:
    """For partitions that go on with a conversation: its id, its turns so far, and their sum.

    ``ends`` has for each partition, in order, its number, its first conversation, and the
    last one with its last place and sum inside the partition.
    """
    out: dict[int, tuple[int, int, int]] = {}
    last = (None, 0, 0)
    for part, first, conv, place, upto in ends:
        if first == last[0]:
            out[part] = last
        old = last if conv == last[0] else (conv, 0, 0)
        last = (conv, old[1] + place, (old[2] + pow(BASE, old[1], PRIME) * _number(upto)) % PRIME)
    return out


def numbered(rows: DataFrame) -> DataFrame:
    """``conv``, ``place`` from 1, ``words``, and the prefix digests ``before`` and ``upto`` each turn.

    One row for each range partition comes to the driver.
    """
    order = ["conv", "turn", "hash"]
    parts = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(parts.mapInArrow(_summed, "conv long, words long, part int, place long, before binary, upto binary"), "turns")
    last = F.max(F.struct("conv", "place", "upto"))
    ends = placed.groupBy("part").agg(F.min("conv").alias("first"), last.alias("last")).orderBy("part").collect()
    carry = carried([(r["part"], r["first"], *r["last"]) for r in ends])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            convs, parts, places = (batch.column(c).to_pylist() for c in ("conv", "part", "place"))
            sums = [batch.column(c).to_pylist() for c in ("before", "upto")]
            for i, (conv, part) in enumerate(zip(convs, parts)):
                if part in carry and carry[part][0] == conv:
                    _, n, total = carry[part]
                    places[i] += n
                    for s in sums:
                        s[i] = _raw(total + pow(BASE, n, PRIME) * _number(s[i]))
            new = [pa.array(places, pa.int64()), batch.column("words"), *(pa.array(s, pa.binary()) for s in sums)]
            yield pa.RecordBatch.from_arrays([batch.column("conv"), *new], ["conv", "place", "words", "before", "upto"])

    return placed.mapInArrow(run, "conv long, place long, words long, before binary, upto binary")


def conversations(turns_: DataFrame, donor: Column | None = None, head: Column | None = None, most: int = 3) -> DataFrame:
    """One row for each conversation: how many first turns it takes over, and from where.

    ``donor`` and ``head`` are expressions of ``conv``: its first ``head`` turns (``most`` at
    most) are replaced by those of ``donor``. Without them a conversation stays as it is.
    """
    first = F.when(F.col("place") <= most, F.struct("place", "upto", "words"))
    own = turns_.groupBy("conv").agg(F.max("place").alias("n_own"), F.sort_array(F.collect_list(first)).alias("heads"))
    own = stored(own, "conversations")
    given = own.select(F.col("conv").alias("donor"), F.col("heads").alias("given"))
    asked = own.withColumn("donor", F.lit(None).cast("long") if donor is None else donor)
    asked = asked.withColumn("head", F.lit(0).cast("long") if head is None else head.cast("long")).join(given, "donor", "left")
    taken = F.least("head", F.coalesce(F.size("given"), F.lit(0)))
    given_list = F.when(taken > 0, F.slice("given", F.lit(1), taken.cast("int"))).otherwise(F.expr("slice(heads, 1, 0)"))
    at = lambda column, n: F.coalesce(F.try_element_at(column, F.greatest(n, F.lit(1)).cast("int"))["upto"], F.lit(ROOT))
    return asked.select(
        "conv",
        "head",
        taken.cast("long").alias("taken"),
        (taken + F.greatest(F.col("n_own") - F.col("head"), F.lit(0))).alias("length"),
        given_list.alias("given"),
        F.when(taken > 0, at("given", taken)).otherwise(F.lit(ROOT)).alias("start"),
        F.when(F.col("head") > 0, at("heads", F.col("head"))).otherwise(F.lit(ROOT)).alias("left"),
    )


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the turns that a conversation keeps, behind the turns that it takes over."""
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("before", "upto", "head", "taken", "start", "left")]
        up, node = [], []
        for before, upto, head, taken, start, left in zip(*columns):
            factor = pow(BASE, taken - head, PRIME) if taken != head else 1
            start, left = _number(start), _number(left)
            up.append(_raw(start + factor * (_number(before) - left)))
            node.append(_raw(start + factor * (_number(upto) - left)))
        arrays = [*(batch.column(c) for c in ("conv", "depth", "words", "length")), pa.array(up, pa.binary()), pa.array(node, pa.binary())]
        yield pa.RecordBatch.from_arrays(arrays, ["conv", "depth", "words", "length", "up", "node"])


def paths(turns_: DataFrame, convs: DataFrame) -> DataFrame:
    """``conv``, ``depth`` from 1, ``node`` and ``up`` (digests), ``words`` and the conversation's ``length``."""
    order = ["conv", "depth", "words", "length", "up", "node"]
    each = convs.select("conv", "length", "given", F.posexplode("given").alias("i", "turn"))
    up = F.when(F.col("i") > 0, F.try_element_at("given", F.greatest("i", F.lit(1)))["upto"]).otherwise(F.lit(ROOT))
    taken = each.select("conv", (F.col("i") + 1).cast("long").alias("depth"), "turn.words", "length", up.alias("up"), F.col("turn.upto").alias("node"))
    kept = turns_.join(convs.drop("given"), "conv").where(F.col("place") > F.col("head"))
    kept = kept.withColumn("depth", F.col("taken") + F.col("place") - F.col("head"))
    schema = "conv long, depth long, words long, length long, up binary, node binary"
    return taken.select(order).union(kept.mapInArrow(_moved, schema).select(order))


# The table of a shard --------------------------------------------------------------

def _keys(column: pa.Array) -> np.ndarray:
    """Digests as rows of two numbers."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(-1, 2)


class NodeTable:
    """Slots from 0 without gaps for distinct keys, found level by level.

    On each level a key has a cell; keys alone in their cells are done, the others go on to
    the next, smaller level. A cell's slot is the number of taken cells before it.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        self.keys = np.empty_like(keys)
        rest, used = keys, 0
        while len(rest):
            if len(self.levels) == 64:
                raise ValueError("a digest occurs twice")
            cells = self._cells(rest, len(self.levels), max(GAMMA * len(rest), 8))
            alone = np.bincount(cells, minlength=max(GAMMA * len(rest), 8)) == 1
            slots = used + np.cumsum(alone) - 1
            done = alone[cells]
            self.keys[slots[cells[done]]] = rest[done]
            self.levels.append((alone, slots))
            used += int(alone.sum())
            rest = rest[~done]

    @staticmethod
    def _cells(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((level * 0x9E3779B97F4A7C15 + 1) % (1 << 64))
        h = (keys[:, 0] ^ seed) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(31)) ^ keys[:, 1]) * np.uint64(0x94D049BB133111EB)
        return ((h ^ (h >> np.uint64(29))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that are not in the table."""
        out = np.full(len(keys), -1, np.int64)
        at = np.arange(len(keys))
        for level, (alone, slots) in enumerate(self.levels):
            cells = self._cells(keys[at], level, len(alone))
            done = alone[cells]
            out[at[done]] = slots[cells[done]]
            at = at[~done]
        known = out >= 0
        known[known] = (self.keys[out[known]] == keys[known]).all(1)
        return np.where(known, out, -1)


_SHARD = "node binary, up binary, conv long, up_conv long, depth long, top boolean, n_convs long, n_children long, n_leaves long, saved_tokens long"


def accumulate(rows: pa.Table) -> pa.Table:
    """The finished nodes of a shard; ``top`` says whose parent is in no shard of this round."""
    keys = _keys(rows["node"])
    nodes = NodeTable(keys)
    slot, n = nodes.slots(keys), len(keys)

    def scattered(name: str) -> np.ndarray:
        out = np.empty(n, np.int64)
        out[slot] = rows[name].to_numpy()
        return out

    parent, depth = np.empty(n, np.int64), scattered("depth")
    parent[slot] = nodes.slots(_keys(rows["up"]))
    convs, children, leaves = scattered("n_convs"), scattered("n_children"), scattered("n_leaves")
    saved = scattered("saved_tokens") + (convs - 1) * scattered("words")
    inside = parent >= 0
    children += np.bincount(parent[inside], minlength=n)
    leaves += children == 0
    order = np.argsort(-depth, kind="stable")
    for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        level = level[inside[level]]
        np.add.at(leaves, parent[level], leaves[level])
        np.add.at(saved, parent[level], saved[level])
    columns = {"node": rows["node"], "up": rows["up"], "conv": rows["conv"], "up_conv": rows["up_conv"], "depth": rows["depth"], "top": pa.array(~inside[slot])}
    columns |= {"n_convs": rows["n_convs"], "n_children": children[slot], "n_leaves": leaves[slot], "saved_tokens": saved[slot]}
    return pa.table(columns)


# The trie --------------------------------------------------------------------------

def _summed_up(nodes: DataFrame, chains: DataFrame, subtree: int, shard: int) -> DataFrame:
    """All nodes with their sums, by rounds.

    ``chains`` has the path of every conversation that is the smallest member of a node:
    from depth ``first`` on it is that of all nodes of its path.
    """
    spark, found, paths_, bound = nodes.sparkSession, None, [], subtree
    while True:
        own = F.col("last") - F.greatest("first", "depth") + 1  # nodes below, of which this conversation is the smallest member
        sizes = chains.groupBy("node").agg((F.sum(own) > bound).alias("large"))
        marked, path = store(chains.join(sizes, "node"), "chains")
        paths_.append(path)
        small = ~F.col("large")
        home = F.min(F.when(small, F.struct("depth", "node")))["node"]
        homes = marked.groupBy("conv").agg(home.alias("home"), F.max(F.when(F.col("large"), F.col("depth"))).alias("deepest"))
        homes, path = store(homes, "homes")
        paths_.append(path)
        placed = nodes.join(homes, "conv")
        ready = placed.where(F.col("deepest").isNull() | (F.col("depth") > F.col("deepest")))
        ready, path = store(ready.drop("deepest"), "ready")
        paths_.append(path)
        n = ready.count()
        dealt = ready.withColumn("shard", F.pmod(F.xxhash64("home"), F.lit(max(1, -(-n // shard))))).drop("home")
        part = stored(dealt.groupBy("shard").applyInArrow(accumulate, _SHARD), "nodes")
        found = part if found is None else found.union(part)
        left = placed.where(F.col("depth") <= F.col("deepest")).drop("home", "deepest")
        below = part.where("top").groupBy(F.col("up").alias("node")).agg(
            F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")
        )
        zero = F.lit(0).cast("long")
        added = left.join(below, "node", "left").select(
            "conv", "node", "up", "up_conv", "depth", "words", "n_convs", (F.col("n_children") + F.coalesce("c", zero)).alias("n_children"),
            (F.col("n_leaves") + F.coalesce("l", zero)).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("s", zero)).alias("saved_tokens"),
        )
        nodes, path = store(added, "left")
        paths_.append(path)
        if nodes.isEmpty():
            break
        # What is left of the paths, of the smallest members of nodes that are left.
        rest = marked.where("large").drop("large", "last").join(homes.select("conv", F.col("deepest").alias("last")), "conv")
        chains, path = store(rest.where("first <= last"), "chains")
        paths_.append(path)
        bound, shard = min(2 * bound, max(subtree, LARGEST)), min(2 * shard, max(shard, LARGEST))
    for path in paths_:
        forget(spark, path)
    return found


def ends_digest(ends: DataFrame, piece: int = PIECE) -> DataFrame:
    """``node`` and ``ends_sha256``: of its ``conv`` ids in order, as decimals joined by commas."""

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, size, held = None, 0, 0, []
        for batch in batches:
            out: list[tuple] = []
            for n, c in zip(batch.column("node").to_pylist(), batch.column("conv").to_pylist()):
                if held and (n != node or size > piece):
                    out.append((node, first, ",".join(held)))
                    held = []
                if not held:
                    node, first, size = n, c, 0
                held.append(str(c))
                size += len(held[-1]) + 1
            yield pieces(out)
        if held:
            yield pieces([(node, first, ",".join(held))])

    def pieces(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[], [], []]
        kinds = (pa.binary(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["node", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            nodes, hashes = [], []
            for n, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
                if n != node:
                    if state:
                        nodes.append(node)
                        hashes.append(state.hexdigest())
                    node, state = n, hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.binary()), pa.array(hashes, pa.string())], ["node", "ends_sha256"])
        if state:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    parts = ends.repartitionByRange("node", "conv").sortWithinPartitions("node", "conv").mapInArrow(joined, "node binary, first long, ids string")
    return parts.repartition("node").sortWithinPartitions("node", "first").mapInArrow(hashed, "node binary, ends_sha256 string")


def prefix_trie(
    rows: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    donor: Column | None = None, head: Column | None = None, most: int = 3, subtree: int = SUBTREE, shard: int = SHARD,
) -> DataFrame:
    """The nodes: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens`` (words that members share, over the subtree) and ``ends_sha256``.
    """
    numbers = numbered(turns(rows, key, turn, role, text))
    convs = stored(conversations(numbers, donor, head, most), "conversations")
    path = stored(paths(numbers, convs), "paths")
    zero = F.lit(0).cast("long")
    counted = path.groupBy("node", "depth").agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv"), F.min("up").alias("up"), F.min("words").alias("words")
    )
    counted = stored(counted, "counted")
    marked = stored(path.join(counted.select("node", F.col("conv").alias("least")), "node").select("conv", "depth", "node", "length", "least"), "marked")
    mine = F.col("least") == F.col("conv")
    first = F.min(F.when(mine, F.col("depth"))).alias("first")
    above = F.max(F.when(~mine, F.struct("depth", "least")))["least"].alias("above")
    smallest = stored(marked.groupBy("conv").agg(first, above, F.max("length").alias("last")).where("first IS NOT NULL"), "smallest")
    chains = marked.select("conv", "depth", "node").join(smallest.select("conv", "first", "last"), "conv")
    n_all, low = convs.agg(F.count("*"), F.min("conv")).first()
    up_conv = F.when(F.col("depth") > F.col("first"), F.col("conv")).otherwise(F.coalesce("above", F.lit(low).cast("long")))
    nodes = counted.join(smallest.select("conv", "first", "above"), "conv").select(
        "conv", "node", "up", up_conv.alias("up_conv"), "depth", "words", "n_convs",
        zero.alias("n_children"), zero.alias("n_leaves"), zero.alias("saved_tokens"),
    )
    found = _summed_up(nodes, chains, subtree, shard).drop("up", "top")
    ends = path.where("depth = length").select("node", "conv").union(convs.where("length = 0").select(F.lit(ROOT).alias("node"), "conv"))
    top = found.where("depth = 1").agg(
        F.count("*").alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).cast("long").alias("n_leaves"),
        F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens"),
    )
    root = top.where(F.lit(n_all > 0)).select(
        F.lit(ROOT).alias("node"), F.lit(low).cast("long").alias("conv"), F.lit(None).cast("long").alias("up_conv"), zero.alias("depth"),
        F.lit(n_all).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
    )
    whole = found.select(root.columns).union(root).join(ends_digest(ends), "node", "left")
    return whole.select(
        F.col("conv").alias("conv_id"), "depth", F.col("up_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def op11_trie(spark, sf_dir: str) -> DataFrame:
    donor = F.col("conv") - F.col("conv") % 20
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % 4
    return prefix_trie(table(spark, sf_dir, "conversations"), donor=donor, head=head)


QUERIES = {"op11_trie": op11_trie}
_CRC = """list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, len(c::VARCHAR) + 1),
    lambda i: [ascii((c::VARCHAR)[i])::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)"""
SQL = {
    "op11_trie": rf"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(struct_pack(r := r, t := t) ORDER BY turn NULLS FIRST, sha256(concat(len(r), ':', r, t))) AS own FROM t GROUP BY c),
h AS (SELECT c, own, xor({_CRC}, 4294967295) % 4 AS h FROM o),
f AS (SELECT h.c, list_concat(list_slice(coalesce(d.own, []), 1, h.h), list_slice(h.own, h.h + 1, len(h.own))) AS said
  FROM h LEFT JOIN o d ON d.c = h.c - h.c % 20),
p AS (SELECT c, said, unnest(range(0, len(said) + 1)) AS d FROM f),
n AS (SELECT list_slice(said, 1, d) AS k, d, min(c) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN d = len(said) THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends FROM p GROUP BY ALL),
w AS (SELECT *, CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * len(list_filter(regexp_split_to_array(k[d].t, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS own FROM n),
u AS (SELECT list_slice(k, 1, d - 1) AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY ALL),
l AS (SELECT w.*, coalesce(kids, 0) AS kids FROM w LEFT JOIN u USING (k)),
s AS (SELECT list_slice(k, 1, e) AS k, sum((kids = 0)::INT) AS leaves, sum(own) AS saved
  FROM (SELECT k, kids, own, unnest(range(0, d + 1)) AS e FROM l) GROUP BY ALL)
SELECT l.conv_id, l.d::BIGINT AS depth, up.conv_id AS parent_conv_id, l.n_convs::BIGINT AS n_convs, l.kids::BIGINT AS n_children,
  leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, l.ends AS ends_sha256
FROM l JOIN s USING (k) LEFT JOIN n up ON l.d > 0 AND up.k = list_slice(l.k, 1, l.d - 1)"""
}
