"""Nearest neighbours, outliers and blocked products against brute force, and what they leave out."""

from __future__ import annotations

from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest

from prairie.operators import neighbours, products

VECTORS = "id long, entries array<struct<idx:long,v:double>>, distance string, norm int"


def sparse(rng, n, negative=False):
    x = rng.random((n, 40)) * (rng.random((n, 40)) < 0.15) * rng.choice([0.2, 1, 3], (n, 1))
    return np.round(x - (0.4 * (x > 0) if negative else 0), 3)


def rows_of(x, first=0):
    return [(first + i, [(j, float(v)) for j, v in enumerate(r) if v] or (None if i % 2 else []), "", 0) for i, r in enumerate(x)]


@pytest.mark.parametrize("negative", [False, True])
def test_nearest_is_that_of_all_pairs(spark, negative):
    rng = np.random.default_rng(5)
    docs, asked = sparse(rng, 400, negative), sparse(rng, 12, negative)
    docs[5], docs[6], docs[200:220] = 0, 0, docs[3]
    asked[0], asked[1] = 0, docs[3]
    corpus = spark.createDataFrame(rows_of(docs), VECTORS).repartition(3)
    queries = spark.createDataFrame(rows_of(asked, 900), VECTORS)
    far = np.round(np.sqrt(((asked[:, None] - docs[None]) ** 2).sum(2)), 6)
    for k in (1, 7, 500):
        want = {(900 + q, int(i), r + 1) for q in range(12) for r, i in enumerate(np.lexsort((np.arange(400), far[q]))[:k])}
        got = neighbours.nearest(corpus, "id", queries, "id", k).collect()
        assert {(r["query"], r["id"], r["rank"]) for r in got} == want
        assert all(abs(r.distance - far[r["query"] - 900, r["id"]]) < 2e-6 for r in got)


def test_nearest_leaves_out_most_of_the_pairs(spark):
    rng = np.random.default_rng(6)
    docs, asked = sparse(rng, 1500), sparse(rng, 10)
    docs[:10] = asked + 0.001 * (asked > 0)
    sides = neighbours._sparse(spark.createDataFrame(rows_of(docs), VECTORS), "id", spark.createDataFrame(rows_of(asked), VECTORS), "id")
    assert 10 <= neighbours.candidates(*sides, 1).count() < 0.4 * 15000


def test_nearest_of_nothing(spark):
    some, none = spark.createDataFrame(rows_of(sparse(np.random.default_rng(1), 5)), VECTORS), spark.createDataFrame([], VECTORS)
    for corpus, queries in ((some, none), (none, some), (none, none)):
        assert neighbours.nearest(corpus, "id", queries, "id", 3).count() == 0


POINTS = "id long, vec array<double>, row int"


def clusters(rng, n, groups=12):
    centre = rng.normal(size=(groups, 6)) * 60
    return centre[np.arange(n) % groups] + rng.normal(size=(n, 6))


def kths(x, k):
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(far, np.inf)
    return np.sort(far, 1)[:, k - 1]


def test_points_meet_near_blocks_only(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    x = clusters(np.random.default_rng(2), 1200)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], POINTS).repartition(4)
    blocks, pairs, *_ = neighbours.tile_pairs(df, "id", "vec", 5)
    assert pairs.count() < 0.4 * blocks.count() ** 2
    got = {r.id: (r.n, r.kth) for r in neighbours.kth_distances(df, "id", "vec", 5).collect()}
    want = kths(x, 5)
    assert all(got[i] == (5, pytest.approx(d, abs=2e-6)) for i, d in enumerate(want)) and len(got) == 1200


def test_limit_tightens(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(1500, 5)), rng.normal(size=(5, 5)) * 40])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], POINTS).repartition(4)
    want = sorted((-round(float(d), 6), i) for i, d in enumerate(kths(x, 10)))[:5]
    trace: list = []
    assert [(-r.kth, r.id) for r in neighbours.pruned_outliers(df, "id", "vec", 10, 5, trace).collect()] == want
    assert [(-r.kth, r.id) for r in neighbours.outliers(df, "id", "vec", 10, 5).collect()] == want
    assert len(trace) > 6 and sum(trace) < 0.25 * len(x) ** 2


def test_points_with_repeated_ids_and_nulls(spark):
    rows = [(1, [0.0], 0), (1, [3.0], 0), (2, [7.0], 0), (None, [8.0], 0), (3, None, 0), (4, [None], 0)]
    df = spark.createDataFrame(rows, POINTS)
    got = sorted((r.id is None, r.id or 0, r.n, r.kth) for r in neighbours.kth_distances(df, "id", "vec", 2).collect())
    assert got == [(False, 1, 2, 4.0), (False, 1, 2, 7.0), (False, 2, 2, 4.0), (True, 0, 2, 5.0)]
    for found in (neighbours.outliers, neighbours.pruned_outliers):
        assert found(df.limit(0), "id", "vec").count() == 0
        assert found(df, "id", "vec", 2, 1).first().kth == 7.0


# Products --------------------------------------------------------------------------

BASKETS = "basket long, item long, left int"


def test_heavy_basket_is_cut(spark):
    rng = np.random.default_rng(8)
    sets = [set(range(300)), *(set(rng.integers(0, 300, 6).tolist()) for _ in range(200))]
    rows = [(b, i, 0) for b, s in enumerate(sets) for i in s]
    df = spark.createDataFrame([*rows, *rows[:50], (None, 1, 0), (3, None, 0)], BASKETS).repartition(4)
    want = Counter(p for s in sets for p in combinations_with_replacement(sorted(s), 2))
    for size in (16, products.BASKET):
        got = {(r.a, r.b): r.n for r in products.co_occurrence(df, "basket", "item", size=size).collect()}
        assert got == want
    blocks = products.basket_blocks(df, "basket", "item", 16).collect()
    assert max(len(r.left) for r in blocks) < 40 and len(blocks) > 200 + 100
    assert products.co_occurrence(df.limit(0), "basket", "item").count() == 0


def test_gram_is_that_of_numpy(spark):
    rng = np.random.default_rng(9)
    x = np.round(rng.normal(size=(90, 37)) * (rng.random((90, 37)) < 0.3), 3)
    x[4] = 1.5  # a row with all columns
    rows = [(int(i), int(j), float(x[i, j]), "") for i, j in zip(*np.nonzero(x))] + [(None, 1, 1.0, ""), (1, None, 1.0, ""), (1, 1, None, "")]
    rows += [(0, 36, 2.0, ""), (0, 36, 1.0, "")]
    x[0, 36] += 3
    df = spark.createDataFrame(rows, "r long, c long, v double, a string").repartition(5)
    want = np.triu(x.T @ x)
    for sizes in ((8, 5), (products.ROWS, products.COLUMNS)):
        got = {(r.a, r.b): r.v for r in products.gram(df, "r", "c", "v", *sizes).collect()}
        assert got == pytest.approx({(int(i), int(j)): want[i, j] for i, j in zip(*np.nonzero(want))}, abs=1e-9)
    assert products.gram(df.limit(0), "r", "c", "v").count() == 0


def test_gram_of_ones_counts_what_occurs_together(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr("l_orderkey", "l_partkey", "1.0D AS one").distinct()
    pairs = {(r.a, r.b): r.v for r in products.gram(lines, "l_orderkey", "l_partkey", "one").collect()}
    assert pairs == {(r.a, r.b): r.n for r in products.co_occurrence(lines, "l_orderkey", "l_partkey").collect()}


def test_products_of_wide_sparse_rows_meet_in_their_rows_only(spark):
    rows = [(i, 1_000_000 * i + j, float(j + 1)) for i in range(300) for j in range(4)]
    df = spark.createDataFrame(rows, "r long, c long, v double").repartition(3)
    got = {(r.a, r.b): r.v for r in products.gram(df, "r", "c", "v", 4, 8).collect()}  # dense column blocks: 300 ** 2 / 2 pairs, a million columns apart
    assert got == {(1_000_000 * i + j, 1_000_000 * i + k): (j + 1.0) * (k + 1) for i in range(300) for j in range(4) for k in range(j, 4)}


def test_tasks_of_products_follow_their_number(spark, monkeypatch):
    monkeypatch.setattr(products, "PAIRS", 64)
    monkeypatch.setattr(products, "ENTRIES", 50)
    rows = [(b, i, 0) for b in range(100) for i in range(b % 9 + 1)]
    df = spark.createDataFrame(rows, BASKETS).coalesce(1)
    want = Counter(p for b in range(100) for p in combinations_with_replacement(range(b % 9 + 1), 2))
    blocks = products.basket_blocks(df, "basket", "item")
    assert blocks.rdd.getNumPartitions() == -(-want.total() // 64)
    assert {(r.a, r.b): r.n for r in products.co_occurrence(df, "basket", "item").collect()} == want


@pytest.mark.parametrize("kind", ["float", "double"])
def test_points_are_sent_a_fixed_number_of_times(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "BLOCK", 20)
    monkeypatch.setattr(neighbours, "GROUPS", 3)
    x = np.random.default_rng(4).normal(size=(900, 8)).astype(np.float32 if kind == "float" else float)
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], f"id long, vec array<{kind}>, row int").repartition(4)
    sent = []
    whole = neighbours._nearest_of_blocks
    monkeypatch.setattr(neighbours, "_nearest_of_blocks", lambda own, others, *a, **b: sent.append(others) or whole(own, others, *a, **b))
    want = kths(x.astype(float), 10)
    got = {r.id: r.kth for r in neighbours.kth_distances(df, "id", "vec", 10).collect()}
    assert got == pytest.approx(dict(enumerate(want)), abs=2e-6)
    assert sum(len(r.rows) for r in sent[0].select("rows").collect()) <= 3 * 8 * 900  # each point once for each group
    best = sorted((-round(float(d), 6), i) for i, d in enumerate(want))[:5]
    assert [(-r.kth, r.id) for r in neighbours.pruned_outliers(df, "id", "vec").collect()] == best


def test_groups_lie_where_their_number_says(spark, monkeypatch):
    """A union of parts that are dealt alike is dealt once more, whatever the planner makes of it."""
    monkeypatch.setattr(neighbours, "BLOCK", 20)
    df = spark.createDataFrame([(i, [float(i)], 0) for i in range(400)], POINTS)
    rows = neighbours._points(df, "id", "vec")
    left = rows.withColumn("near", neighbours.F.array().cast("array<double>"))
    part = rows.withColumn("slot", neighbours.F.lit(0))
    met = neighbours._compared(left, part, "bigint", 400, 1, False)
    assert met.rdd.getNumPartitions() == neighbours._own_groups(400)
    assert {r.near[0] for r in met.collect()} == {1.0}


def test_few_queries_meet_all_vectors_without_postings(spark, monkeypatch):
    rng = np.random.default_rng(8)
    docs, asked = sparse(rng, 300, True), sparse(rng, 9, True)
    docs[40:60] = docs[3]
    corpus = spark.createDataFrame(rows_of(docs) + [(None, [(1, 1.0)], "", 0)], VECTORS).repartition(3)
    queries = spark.createDataFrame(rows_of(asked), VECTORS)
    by_postings = neighbours.candidates
    found = lambda: sorted(tuple(r) for r in neighbours.nearest(corpus, "id", queries, "id", 5).collect())
    monkeypatch.setattr(neighbours, "candidates", None)
    monkeypatch.setattr(neighbours, "BLOCK", 17)
    monkeypatch.setattr(neighbours, "PRODUCTS", 5)
    few = found()
    monkeypatch.setattr(neighbours, "candidates", by_postings)
    monkeypatch.setattr(neighbours, "FEW", 8)
    assert few == found() and len(few) == 45
