"""Nearest neighbours of sparse vectors by postings, and outliers among dense points.

All results are exact. What cannot belong to a result is left out by bounds: of words'
largest weights for sparse vectors, of the triangle inequality for points.

Defined results: a null vector of a sparse table is an empty one; points without a vector, or
with a null in it, are left out; each row is a point of its own, also where ids repeat; empty
tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from prairie.operators.ranking import k_best
from prairie.session import forget, store, stored

BLOCK = 2048  # points of one side of a tile
GROUPS = 48  # tasks that hold points while the others pass
MOST = 1 << 17  # points of such a task, about
PIVOTS = 1024  # groups of points at most; each is a vector that tasks and driver hold
NORMS = 16  # buckets of sparse vectors by their norm
SEEDS = 32  # vectors that are tried first for each query
FEW = 1024  # queries that each task can hold
HELD = 1 << 18  # entries of such queries
PRODUCTS = 1 << 20  # of entries of vectors and queries at a time, about
SLACK = 1e-6  # distances are rounded to six digits

Batches = Iterator[pa.RecordBatch]


# Sparse vectors --------------------------------------------------------------------

def _normed(rows: DataFrame, key: str, name: str) -> DataFrame:
    """``name``, ``entries`` and ``norm`` (the sum of squares)."""
    entries = F.coalesce("entries", F.array().cast("array<struct<idx:bigint,v:double>>"))
    norm = F.aggregate("entries", F.lit(0.0), lambda acc, e: acc + e["v"] * e["v"])
    return rows.select(F.col(key).alias(name), entries.alias("entries")).withColumn("norm", norm)


def _distances(pairs: DataFrame, docs: DataFrame, asked: DataFrame) -> DataFrame:
    """``q``, ``doc`` and ``distance`` of the given pairs."""
    both = pairs.join(docs.select("doc", "entries", "norm"), "doc").join(
        asked.select("q", F.col("entries").alias("q_entries"), F.col("norm").alias("q_norm")), "q"
    )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys, values = [], []
            for name in ("entries", "q_entries"):
                lists = batch.column(name)
                inner = lists.flatten()
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                keys.append((row, inner.field("idx").to_numpy()))
                values.append(inner.field("v").to_numpy())
            width = 1 + max((int(i.max()) for _, i in keys if len(i)), default=0)
            (row, idx), (q_row, q_idx) = keys
            place, q_place = row * width + idx, q_row * width + q_idx  # both ascending
            at = np.minimum(np.searchsorted(place, q_place), max(len(place) - 1, 0))
            hit = place[at] == q_place if len(place) else np.zeros(len(q_place), bool)
            dot = np.bincount(q_row[hit], values[0][at[hit]] * values[1][hit], batch.num_rows)
            squares = batch.column("norm").to_numpy() + batch.column("q_norm").to_numpy() - 2 * dot
            far = np.round(np.sqrt(np.maximum(squares, 0)), 6)
            yield pa.RecordBatch.from_arrays([batch.column("q"), batch.column("doc"), pa.array(far)], ["q", "doc", "distance"])

    kinds = {c: both.schema[c].dataType.simpleString() for c in ("q", "doc")}
    return both.mapInArrow(run, f"q {kinds['q']}, doc {kinds['doc']}, distance double")


def _sparse(corpus: DataFrame, key: str, queries: DataFrame, query: str) -> tuple[DataFrame, DataFrame]:
    """Vectors with their norms and norm buckets, and queries with their norms; both written."""
    docs = stored(_normed(corpus, key, "doc"), "vectors")
    cuts = docs.approxQuantile("norm", [i / NORMS for i in range(1, NORMS)], 0.01)
    levels = F.array(*map(F.lit, sorted(set(cuts)))).cast("array<double>")
    return docs.withColumn("bucket", F.size(F.filter(levels, lambda c: F.col("norm") >= c))), stored(_normed(queries, query, "q"), "queries")


def candidates(docs: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The (``q``, ``doc``) pairs that can be among the k nearest, each once.

    First each query meets the vectors with the smallest norms and those that weigh its
    heaviest word most; its k-th distance to these is a limit. Per norm bucket the limit says how
    large a product must be. The query's words are put in the order of what they can add at
    most; the lightest ones, which together do not reach the product, cannot bring in a vector. Only
    the postings of the others are read. Where even a product of zero is enough, the
    whole bucket is taken.
    """
    postings = docs.select("doc", "bucket", F.explode("entries").alias("e")).select("doc", "bucket", "e.idx", "e.v")
    words = asked.select("q", F.explode("entries").alias("e")).select("q", "e.idx", F.col("e.v").alias("qv"))
    flat = [r["doc"] for r in docs.orderBy("norm", "doc").limit(k).select("doc").collect()]  # k rows
    shortest = asked.select("q", F.explode(F.array(*map(F.lit, flat))).alias("doc")) if flat else None
    heaviest = words.groupBy("q").agg(F.max_by("idx", F.struct(F.abs("qv"), "idx")).alias("idx"))
    holders = k_best(heaviest.join(postings, "idx"), SEEDS, "q", F.desc("v"), "doc").select("q", "doc")
    if shortest is None:
        return holders
    tried = _distances(shortest.union(holders).distinct(), docs, asked)
    limit = k_best(tried, k, "q", "distance", "doc").where(F.col("rank") == k).select("q", F.col("distance").alias("limit"))
    # A row for each norm bucket.
    buckets = [(r["bucket"], r["low"]) for r in docs.groupBy("bucket").agg(F.min("norm").alias("low")).collect()]
    each = F.explode(F.array(*(F.struct(F.lit(b).alias("bucket"), F.lit(low).alias("low")) for b, low in buckets)))
    reach = F.col("limit") + SLACK
    product = F.coalesce((F.col("norm") + F.col("b.low") - reach * reach) / 2 - 1e-9, F.lit(0.0))
    needs = stored(asked.join(limit, "q", "left").withColumn("b", each).select("q", "b.bucket", product.alias("product")), "needs")
    whole = needs.where("product <= 0").join(docs.select("doc", "bucket"), "bucket").select("q", "doc")
    tops = postings.join(words.select("idx").distinct(), "idx", "left_semi").groupBy("idx", "bucket").agg(F.max("v").alias("high"), F.min("v").alias("low"))
    adds = F.greatest(F.lit(0.0), F.col("qv") * F.col("high"), F.col("qv") * F.col("low"))
    bounds = words.join(tops, "idx").withColumn("adds", adds).join(needs.where("product > 0"), ["q", "bucket"])
    order = F.sort_array(F.collect_list(F.struct("adds", "idx")))  # the words of one query
    listed = bounds.groupBy("q", "bucket", "product").agg(order.alias("words"))
    reached = F.transform("words", lambda w, i: F.struct(w["idx"].alias("idx"), F.aggregate(F.slice("words", 1, i + 1), F.lit(0.0), lambda s, x: s + x["adds"]).alias("sum")))
    telling = listed.select("q", "bucket", "product", F.explode(reached).alias("w")).where("w.sum >= product").select("q", "bucket", "w.idx")
    return telling.join(postings, ["idx", "bucket"]).select("q", "doc").union(whole).distinct()


def _met(corpus: DataFrame, key: str, asked: DataFrame, k: int) -> DataFrame:
    """``q``, ``doc`` and ``distance``: the k nearest vectors of each task for each query, and more.

    Every vector meets every query, where it lies: its words lead to the queries that have
    them. For ``FEW`` queries of ``HELD`` entries at most.
    """
    rows = asked.select("q", "norm", "entries").collect()
    words = [(e["idx"], i, e["v"]) for i, r in enumerate(rows) for e in r["entries"]]
    words.sort(key=lambda e: e[:2])
    idx, owner, weight = (np.array([e[j] for e in words], t) for j, t in ((0, np.int64), (1, np.int64), (2, float)))
    n, q_norm = len(rows), np.array([r["norm"] for r in rows], float)
    first = np.searchsorted(idx, np.arange(int(idx.max(initial=-1)) + 2))  # a word's queries; none behind the last
    kinds = {"q": asked.schema["q"].dataType, "doc": corpus.schema[key].dataType}
    ids = pa.array([r["q"] for r in rows], to_arrow_type(kinds["q"]))

    def far(row: np.ndarray, words: np.ndarray, v: np.ndarray, size: int) -> np.ndarray:
        """Distances of ``size`` vectors from all queries."""
        norm = np.bincount(row, v * v, size)
        some = words < len(first) - 1
        row, words, v = row[some], words[some], v[some]
        counts = first[words + 1] - first[words]
        ends, dot = counts.cumsum(), np.zeros(size * n)
        start = 0
        while start < len(row):
            before = int(ends[start - 1]) if start else 0
            end = max(int(np.searchsorted(ends, before + PRODUCTS)), start + 1)
            own, c = slice(start, end), counts[start:end]
            at = np.arange(int(c.sum())) + np.repeat(first[words[own]] - (c.cumsum() - c), c)
            low, high = row[start] * n, (row[end - 1] + 1) * n
            products = np.repeat(v[own], c) * weight[at]
            dot[low:high] += np.bincount(np.repeat(row[own] * n, c) + owner[at] - low, products, high - low)
            start = end
        squares = norm[:, None] + q_norm[None] - 2 * dot.reshape(size, n)
        return np.round(np.sqrt(np.maximum(squares, 0)), 6)

    def best(docs: pa.Array, q: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Places of the k nearest of each query, by distance and key."""
        place = np.empty(len(docs), np.int64)
        place[pc.array_sort_indices(docs).to_numpy()] = np.arange(len(docs))
        order = np.lexsort((place, distance, q))
        asked = q[order]
        return order[np.arange(len(order)) - np.searchsorted(asked, asked) < k]

    def run(batches: Batches) -> Batches:
        held = None
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.slice(start, BLOCK)
                lists, docs = part.column("entries"), part.column("doc")
                inner = lists.flatten()
                row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
                found = far(row, inner.field("idx").to_numpy(), inner.field("v").to_numpy(), len(lists))
                at = np.argpartition(found, k - 1, 0)[:k] if k < len(lists) else np.broadcast_to(np.arange(len(lists))[:, None], found.shape)
                limit = np.take_along_axis(found, at, 0).max(0)
                at, q = np.nonzero(~(found > limit))  # ties of the k-th too
                new = (docs.take(pa.array(at)), q, found[at, q])
                if held:
                    new = (pa.concat_arrays([held[0], new[0]]), *map(np.concatenate, zip(held[1:], new[1:])))
                keep = best(*new)
                held = (new[0].take(pa.array(keep)), new[1][keep], new[2][keep])
        if held:
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(held[1])), held[0], pa.array(held[2])], ["q", "doc", "distance"])

    kind = {c: t.simpleString() for c, t in kinds.items()}
    entries = F.coalesce("entries", F.array().cast("array<struct<idx:bigint,v:double>>")).alias("entries")
    docs = corpus.select(F.col(key).alias("doc"), entries).where("doc IS NOT NULL")
    return docs.mapInArrow(run, f"q {kind['q']}, doc {kind['doc']}, distance double")


def nearest(corpus: DataFrame, key: str, queries: DataFrame, query: str, k: int) -> DataFrame:
    """``query``, ``key``, ``distance``, ``rank``: the k nearest rows of each query (ties by key).

    Both tables have ``entries`` in ascending order of ``idx``; ids are unique. Few queries meet
    all vectors in the tasks that read them; more are led to their candidates by postings.
    """
    asked = stored(_normed(queries, query, "q"), "queries")
    size = asked.agg(F.count("*").alias("n"), F.sum(F.size("entries")).alias("entries")).first()
    if 0 < size["n"] <= FEW and size["entries"] <= HELD:
        found = _met(corpus, key, asked.where("q IS NOT NULL"), k)
    else:
        docs, asked = _sparse(corpus, key, queries, query)
        found = _distances(candidates(docs, asked, k), docs, asked)
    return k_best(found, k, "q", "distance", "doc").select(F.col("q").alias("query"), F.col("doc").alias(key), "distance", "rank")


def majority(neighbours: DataFrame, label: str) -> DataFrame:
    """``query`` and its most frequent label; on a tie the label of the closest neighbour of those."""
    votes = neighbours.groupBy("query", label).agg(F.count("*").alias("n"), F.min("rank").alias("first"))
    best = votes.groupBy("query").agg(F.max(F.struct("n", (-F.col("first")).alias("near"), label)).alias("best"))
    return best.select("query", F.col(f"best.{label}").alias(label), F.col("best.n").alias("votes"))


# Points ----------------------------------------------------------------------------

def _tile(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0))


def _matrix(vectors: pa.Array) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _points(points: DataFrame, key: str, vector: str) -> DataFrame:
    """``row`` (a number of its own), ``key`` and ``vec`` of every point with a vector; written."""
    vec = F.col(vector).cast("array<double>")
    rows = points.select(F.col(key).alias("key"), vec.alias("vec")).where(F.col("vec").isNotNull() & ~F.exists("vec", F.isnull))
    return stored(rows.withColumn("row", F.monotonically_increasing_id()), "points")


def _listed(column: str, *fields: str) -> Column:
    return F.collect_list(F.struct(*fields)).alias(column)


def _grouped(rows: DataFrame, n: int) -> tuple[DataFrame, np.ndarray, dict[int, tuple[int, float]]]:
    """Points with their pivot's number (``g``); the pivots; number and radius of each group."""
    wanted = min(PIVOTS, -(-2 * n // BLOCK))
    pivots = np.array([r["vec"] for r in rows.orderBy(F.xxhash64("row"), "row").limit(wanted).select("vec").collect()])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            vecs = _matrix(batch.column("vec"))
            for first in range(0, len(vecs), BLOCK):
                far = _tile(vecs[first : first + BLOCK], pivots)
                part = batch.slice(first, BLOCK)
                new = [pa.array(far.argmin(1).astype(np.int32)), pa.array(far.min(1))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("row", "key", "vec")), *new], ["row", "key", "vec", "g", "far"])

    kind = rows.schema["key"].dataType.simpleString()
    placed = stored(rows.mapInArrow(run, f"row long, key {kind}, vec array<double>, g int, far double"), "groups")
    stats = placed.groupBy("g").agg(F.count("*").alias("n"), F.max("far").alias("radius")).collect()  # PIVOTS rows at most
    return placed, pivots, {r["g"]: (r["n"], r["radius"] + 1e-9) for r in stats}


def _reach(pivots: np.ndarray, groups: dict[int, tuple[int, float]], k: int) -> np.ndarray:
    """For each group, a distance within which each of its points has k others."""
    own = np.array(sorted(groups))
    n, radius = (np.array([groups[g][i] for g in own], float) for i in (0, 1))
    upper = _tile(pivots[own], pivots[own]) + radius[:, None] + radius[None]
    out = np.full(len(pivots), np.inf)
    for i, g in enumerate(own):
        others = n - (own == g)
        order = np.argsort(upper[i])
        enough = np.flatnonzero(others[order].cumsum() >= k)
        out[g] = upper[i][order[enough[0]]] if len(enough) else np.inf
    return out


def tile_pairs(points: DataFrame, key: str, vector: str, k: int) -> tuple[DataFrame, DataFrame, np.ndarray, dict[int, tuple[int, float]]]:
    """Blocks of points, the pairs of blocks that must meet (``a``, ``b``, ``low``), pivots and groups.

    A block has points of one pivot. Its points' k-th distances are bounded by those inside the
    block and by the geometry of the groups; a group that lies farther off is left out.
    """
    rows = _points(points, key, vector)
    placed, pivots, groups = _grouped(rows, rows.count())
    sizes = F.create_map(*(F.lit(x) for g, (n, _) in sorted(groups.items()) for x in (g, -(-n // BLOCK)))) if groups else F.lit(None)
    part = F.pmod(F.xxhash64("row"), sizes[F.col("g")]).cast("int") if groups else F.lit(0)
    blocks = placed.withColumn("block", F.struct("g", part.alias("part"))).groupBy("block").agg(_listed("points", "row", "key", "vec"))
    blocks = stored(blocks, "blocks")
    if not groups:
        return blocks, points.sparkSession.createDataFrame([], "a struct<g:int,part:int>, b struct<g:int,part:int>, low double"), pivots, groups
    reach = _reach(pivots, groups, k)
    own = np.array(sorted(groups))
    radius = np.array([groups[g][1] for g in own])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for i, block in enumerate(batch.column("block").to_pylist()):
                vecs = _matrix(batch.column("points")[i].values.field("vec"))
                limit = reach[block["g"]]
                if len(vecs) > k:
                    far = _tile(vecs, vecs)
                    np.fill_diagonal(far, np.inf)
                    limit = min(limit, float(np.partition(far, k - 1, 1)[:, k - 1].max()))
                low = np.maximum(_tile(pivots[block["g"]][None], pivots[own])[0] - radius - groups[block["g"]][1], 0)
                met = [(block, {"g": int(g), "part": p}, float(x)) for g, x in zip(own, low) if x <= limit + SLACK for p in range(-(-groups[int(g)][0] // BLOCK))]
                kind = pa.struct([("g", pa.int32()), ("part", pa.int32())])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*met), (kind, kind, pa.float64()))], ["a", "b", "low"])

    pairs = blocks.mapInArrow(run, "a struct<g:int,part:int>, b struct<g:int,part:int>, low double")
    return blocks, pairs, pivots, groups


def _packed(blocks: DataFrame, name: str, single: bool) -> DataFrame:
    """``name``, ``rows`` and ``vecs``: the points of each block as plain bytes; ``single``: vectors are of floats."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows, vecs = [], []
            for points in batch.column("points"):
                rows.append(points.values.field("row").to_numpy().tobytes())
                vecs.append(_matrix(points.values.field("vec")).astype("<f4" if single else "<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(name), pa.array(rows, pa.binary()), pa.array(vecs, pa.binary())], [name, "rows", "vecs"])

    return blocks.select(name, "points").mapInArrow(run, f"{name} {blocks.schema[name].dataType.simpleString()}, rows binary, vecs binary")


def _nearer(best: np.ndarray, far: np.ndarray) -> np.ndarray:
    k = best.shape[1]
    return np.partition(np.concatenate([best, far], 1), k - 1, 1)[:, :k]


class _Own:
    """Points of one group of blocks, and the k smallest distances of each so far."""

    def __init__(self, parts: list[pa.Array], k: int):
        self.keys = pa.concat_arrays([p.field("key") for p in parts])
        self.rows = np.concatenate([p.field("row").to_numpy() for p in parts])
        self.vecs = np.concatenate([_matrix(p.field("vec")) for p in parts])
        self.best = np.full((len(self.rows), k), np.inf)
        for i, near in enumerate(near for p in parts for near in p.field("near").to_pylist()):
            self.best[i, : len(near)] = near
        self.last = self.best.max(1)
        self.squares = (self.vecs**2).sum(1)

    def meet(self, at: np.ndarray, rows: np.ndarray, vecs: np.ndarray) -> None:
        """Bring the points ``at`` up to date by other points."""
        squares = (vecs**2).sum(1)
        other = np.column_stack([-2 * vecs, np.ones(len(vecs)), squares]).T
        for first in range(0, len(at), BLOCK):
            part = at[first : first + BLOCK]
            limit = self.last[part] ** 2
            # One product: squared distance less the limit. What is below is looked at again, exactly.
            gap = np.column_stack([self.vecs[part], self.squares[part] - limit, np.ones(len(part))]) @ other
            near = gap < 1e-9 * (1 + self.squares[part])[:, None]
            if np.count_nonzero(near) > near.size // 16:
                far = _tile(self.vecs[part], vecs)
                far[self.rows[part][:, None] == rows[None]] = np.inf  # not oneself
                self.best[part] = _nearer(self.best[part], far)
                self.last[part] = self.best[part].max(1)
                continue
            i, j = np.nonzero(near)
            others = self.rows[part[i]] != rows[j]
            i, j = i[others], j[others]
            if not len(i):
                continue
            who, start, count = np.unique(i, return_index=True, return_counts=True)
            far = np.full((len(who), count.max()), np.inf)
            place = np.repeat(np.arange(len(who)), count)
            far[place, np.arange(len(i)) - start[place]] = np.sqrt(((self.vecs[part[i]] - vecs[j]) ** 2).sum(1))
            self.best[part[who]] = _nearer(self.best[part[who]], far)
            self.last[part[who]] = self.best[part[who]].max(1)

    def result(self) -> Batches:
        for first in range(0, len(self.rows), BLOCK):
            vecs, best = self.vecs[first : first + BLOCK], np.sort(self.best[first : first + BLOCK], 1)
            made = [pa.array(list(vecs), pa.list_(pa.float64())), pa.array([x[np.isfinite(x)] for x in best], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([pa.array(self.rows[first : first + BLOCK]), self.keys.slice(first, BLOCK), *made], ["row", "key", "vec", "near"])


def _own_groups(n: int) -> int:
    """Groups that ``n`` points meet the others in: a fixed number, so that each point is sent as often whatever ``n``."""
    return max(1, min(GROUPS, -(-n // BLOCK)), -(-n // MOST))


def _nearest_of_blocks(
    own: DataFrame, others: DataFrame, kind: str, k: int, groups: int, single: bool, pivots: np.ndarray | None = None, radii: dict[int, float] | None = None
) -> DataFrame:
    """``row``, ``key``, ``vec`` and ``near`` (the k smallest distances, ascending) of own points.

    ``own`` has ``a`` (the group, from 0) and ``points``, with the ``near`` found before; ``others`` has
    ``a``, ``low`` (a bound from below), ``g`` (the pivot of the others), ``rows`` and ``vecs``. A task has one
    group and reads the others in the order of ``low``; those too far off are passed over.
    """

    def run(batches: Batches) -> Batches:
        parts, mine, group = [], None, None
        for batch in batches:
            lows, gs, names = (batch.column(c).to_pylist() for c in ("low", "g", "a"))
            for i, low in enumerate(lows):
                if names[i] != group:
                    if parts or mine:
                        yield from (mine or _Own(parts, k)).result()
                    parts, mine, group = [], None, names[i]
                if low < 0:
                    parts.append(batch.column("points")[i].values)
                    continue
                if not parts and mine is None:
                    continue  # a group without own points
                if mine is None:
                    mine, parts = _Own(parts, k), []
                at = np.flatnonzero(mine.last >= low - SLACK)
                if pivots is not None and len(at):  # points that the group can still bring a neighbour
                    at = at[_tile(mine.vecs[at], pivots[gs[i]][None])[:, 0] - radii[gs[i]] <= mine.last[at] + SLACK]
                if len(at):
                    rows = np.frombuffer(batch.column("rows")[i].as_py(), "<i8")
                    vecs = np.frombuffer(batch.column("vecs")[i].as_py(), "<f4" if single else "<f8").astype(float)
                    mine.meet(at, rows, vecs.reshape(len(rows), -1))
        if parts or mine:
            yield from (mine or _Own(parts, k)).result()

    first = own.select("a", F.lit(-1.0).alias("low"), F.lit(-1).alias("g"), "points", F.lit(None).cast("binary").alias("rows"), F.lit(None).cast("binary").alias("vecs"))
    points = F.lit(None).cast(own.schema["points"].dataType).alias("points")
    # A group is a partition by its number: what a union of parts that are dealt already looks like to the planner does not matter.
    tiles = first.union(others.select("a", "low", "g", points, "rows", "vecs")).repartitionById(groups, F.col("a")).sortWithinPartitions("a", "low")
    return tiles.mapInArrow(run, f"row long, key {kind}, vec array<double>, near array<double>")


def _single(points: DataFrame, vector: str) -> bool:
    return points.schema[vector].dataType.simpleString() == "array<float>"


def _chain(pivots: np.ndarray) -> list[int]:
    """An order in which each pivot is followed by the nearest one left."""
    left, order = np.ones(len(pivots), bool), [0]
    left[0] = False
    while left.any():
        far = np.where(left, _tile(pivots[order[-1]][None], pivots)[0], np.inf)
        order.append(int(far.argmin()))
        left[order[-1]] = False
    return order


def kth_distances(points: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """``key``, ``n`` (neighbours found, at most k) and ``kth``: the largest of the k smallest distances.

    Blocks that lie near each other are a group. A group of points meets the blocks that can hold
    neighbours of its points, nearest first, and keeps k numbers for each point, never the pairs.
    """
    spark = points.sparkSession
    blocks, pairs, pivots, groups = tile_pairs(points, key, vector, k)
    kind, n = points.schema[key].dataType.simpleString(), sum(size for size, _ in groups.values())
    number, places, at = _own_groups(n), [], 0
    for g in [own for own in _chain(pivots) if own in groups] if groups else []:
        places.append((g, at, groups[g][0] / -(-groups[g][0] // BLOCK)))
        at += groups[g][0]
    placing = F.broadcast(spark.createDataFrame(places, "g int, at long, step double"))  # a row for each pivot
    group = F.least(F.lit(number - 1), F.floor((F.col("at") + F.col("part") * F.col("step")) * number / max(n, 1)).cast("int"))
    none = F.array().cast("array<double>")
    padded = F.transform("points", lambda p: F.struct(p["row"].alias("row"), p["key"].alias("key"), p["vec"].alias("vec"), none.alias("near")))
    own = blocks.select("block.g", "block.part", padded.alias("points")).join(placing, "g").select(group.alias("a"), "points")
    met = pairs.select("a.g", "a.part", "b", "low").join(placing, "g").groupBy(group.alias("a"), "b").agg(F.min("low").alias("low"))
    single = _single(points, vector)
    lists = met.groupBy("b").agg(F.collect_list(F.struct("a", "low")).alias("to"))  # the groups that a block goes to
    sent = _packed(blocks, "block", single).withColumnRenamed("block", "b").join(lists, "b").select("b.g", "rows", "vecs", F.explode("to").alias("t"))
    found = _nearest_of_blocks(own, sent.select("t.a", "t.low", "g", "rows", "vecs"), kind, k, number, single, pivots, {g: r for g, (_, r) in groups.items()})
    return found.select(F.col("key").alias(key), F.size("near").cast("long").alias("n"), F.round(F.try_element_at("near", F.lit(-1)), 6).alias("kth")).where("n > 0")


def outliers(points: DataFrame, key: str, vector: str, k: int = 10, m: int = 5) -> DataFrame:
    """The m points whose k-th neighbour is farthest; with fewer than k others, the farthest found counts."""
    return kth_distances(points, key, vector, k).orderBy(F.desc("kth"), key).limit(m).select(key, "kth")


def _compared(left: DataFrame, part: DataFrame, kind: str, n_left: int, k: int, single: bool) -> DataFrame:
    """``left`` with ``near`` brought up to date by the points of ``part`` (``slot``, row, key, vec)."""
    groups = _own_groups(n_left)
    block = F.pmod(F.xxhash64("row", F.lit(5)), F.lit(max(1, -(-n_left // (groups * BLOCK)))))
    own = left.groupBy(F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("a"), block).agg(_listed("points", "row", "key", "vec", "near"))
    others = _packed(part.groupBy("slot").agg(_listed("points", "row", "vec")), "slot", single)
    sent = others.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("a"), F.lit(0.0).alias("low"), F.lit(0).alias("g"), "rows", "vecs")
    return _nearest_of_blocks(own.select("a", "points"), sent, kind, k, groups, single)


def _exact(rows: DataFrame, some: list[tuple[int, list[float]]], k: int) -> list[float]:
    """The k-th distances of a few points (number and vector) to all, of those that have k others; each task sends k numbers a point."""
    numbers, vecs = np.array([r for r, _ in some]), np.array([v for _, v in some])

    def run(batches: Batches) -> Batches:
        best = np.full((len(some), k), np.inf)
        for batch in batches:
            if batch.num_rows:
                far = _tile(vecs, _matrix(batch.column("vec")))
                far[numbers[:, None] == batch.column("row").to_numpy()[None]] = np.inf
                best = _nearer(best, far)
        i, j = np.nonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(best[i, j])], ["i", "far"])

    found = k_best(rows.select("row", "vec").mapInArrow(run, "i int, far double"), k, "i", "far").where(F.col("rank") == k)
    return [r["far"] for r in found.collect()]


def pruned_outliers(points: DataFrame, key: str, vector: str, k: int = 10, m: int = 5, trace: list | None = None) -> DataFrame:
    """The same points from fewer distances; points with fewer than k others are left out.

    Points are dealt into random blocks. Round by round all candidates meet twice as many
    blocks as in the round before, none of them twice. The k-th distance so far bounds a
    candidate from above. The true k-th distances of the m candidates with the largest bounds are found
    against all points; the m-th of these is the limit, and candidates whose bound is below it are
    dropped. The limit only grows. ``trace`` gets the distances of each round.
    """
    rows = _points(points, key, vector)
    n, kind, single = rows.count(), rows.schema["key"].dataType.simpleString(), _single(points, vector)
    blocks = max(1, -(-n // BLOCK))
    dealt = rows.withColumn("slot", F.pmod(F.xxhash64("row", F.lit(17)), F.lit(blocks)).cast("int"))
    left, path = rows.withColumn("near", F.array().cast("array<double>")), None
    first, width, n_left, limit = 0, 1, n, 0.0
    while first < blocks and n_left:
        part = dealt.where(F.col("slot").between(first, first + width - 1))
        met, met_path = store(_compared(left, part, kind, n_left, k, single), "candidates")
        bound = F.when(F.size("near") == k, F.try_element_at("near", F.lit(-1))).otherwise(float("inf"))
        if trace is not None:
            trace.append(n_left * part.count())
        first, width = first + width, 2 * width
        if path:
            forget(rows.sparkSession, path)
        left, path = met, met_path
        if first < blocks:
            top = met.orderBy(F.desc(bound), "row").limit(m).select("row", "vec").collect()  # m points
            exact = _exact(rows, [tuple(r) for r in top], k) if top else []
            if trace is not None:
                trace.append(m * n)
            limit = max(limit, min(exact)) if len(exact) == m else limit
            left = met.where(bound >= limit - SLACK)
        n_left = left.count()
    found = left.where(F.size("near") == k).select(F.col("key").alias(key), F.round(F.try_element_at("near", F.lit(-1)), 6).alias("kth"))
    return found.orderBy(F.desc("kth"), key).limit(m)
