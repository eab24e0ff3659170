"""Small hand-made tables for the rules that whole tables do not show."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from prairie.functions import scalars, text
from prairie.operators import graph, models, neighbours, products, ranking, relational, vectors
from prairie.sources import lines, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


# Functions -------------------------------------------------------------------------

@pytest.mark.parametrize("n, k, want", [(5, 2, 10.0), (5, 0, 1.0), (2, 3, 0.0), (5, -1, 0.0), (5, None, None), (None, 1, None), (40, 20, math.comb(40, 20))])
def test_choose(spark, n, k, want):
    got = one(spark, scalars.choose(F.lit(n).cast("int"), F.lit(k).cast("int")))
    assert got == pytest.approx(want) if want is not None else got is None


@pytest.mark.parametrize("k, n, p, want", [(1, 2, 0.5, 0.5), (3, 2, 0.5, 0.0), (-1, 2, 0.5, 0.0), (0, 3, 0.0, 1.0), (1, 3, 0.0, 0.0), (3, 3, 1.0, 1.0), (1000, 2000, 0.5, math.comb(2000, 1000) / 2**2000), (None, 2, 0.5, None)])
def test_binomial_pmf(spark, k, n, p, want):
    got = one(spark, scalars.binomial_pmf(F.lit(k).cast("int"), F.lit(n), p))
    assert got == pytest.approx(want, rel=1e-6) if want is not None else got is None


def test_other_scalars(spark):
    assert one(spark, scalars.idf_log10(F.lit(100), F.lit(0))) == pytest.approx(2.0)
    assert one(spark, scalars.idf_ln(F.lit(100), F.lit(0))) == 0.0
    assert one(spark, scalars.six_decimals(F.lit(None).cast("double"))) is None
    assert one(spark, scalars.six_decimals(F.lit(1.5))) == "1.500000"
    assert one(spark, scalars.logit(F.lit(1.0))) is None
    assert one(spark, scalars.sigmoid(F.lit(-1000.0))) == 0.0 and one(spark, scalars.log1p_exp(F.lit(1000.0))) == 1000.0
    assert one(spark, scalars.safe_double(F.lit("abc"))) is None and one(spark, scalars.safe_double(F.lit(" 2.5 "))) == 2.5
    assert one(spark, scalars.date_text(F.lit("2001"))) is None
    assert [one(spark, scalars.path_part(F.lit(p))) for p in ("a/b/c", "a/b", "")] == ["b", "", ""]
    assert one(spark, scalars.snippet(F.lit("a\nb" * 200))) == ("a b" * 200)[:300]


def test_run_lengths(spark):
    words = ["b", "a", "b", "c", "a", "b"]
    got = one(spark, text.run_lengths(F.array(*map(F.lit, words))))
    assert [(r.word, r.cnt) for r in got] == [("a", 2), ("b", 3), ("c", 1)]
    assert one(spark, text.run_lengths(F.array().cast("array<string>"))) == []
    long = [f"w{i % 700}" for i in range(20000)]
    got = table(spark, [(" ".join(long),)], "t string").select(text.run_lengths(F.split("t", " ")).alias("x")).first().x
    assert len(got) == 700 and sum(r.cnt for r in got) == 20000


def test_kelvin_sign_tells_the_tokenisers_apart(spark):
    assert one(spark, text.words_ascii(F.lit("10 \u212a now"))) == ["now"]
    assert one(spark, text.words_lowered(F.lit("10 \u212a now"))) == ["k", "now"]


# Relations -------------------------------------------------------------------------

def test_top_ties_keep_duplicates(spark):
    got = relational.top_with_ties(table(spark, [(1, 5), (2, 5), (2, 5), (3, 1)], "a int, b int"), "b")
    assert sorted(r.a for r in got.collect()) == [1, 2, 2]


@pytest.mark.parametrize("mode, want", [("forall", [1, 2]), ("difference", [])])
def test_division_by_nothing(spark, mode, want):
    pairs = table(spark, [(1, "x"), (2, "y")], "k int, i string")
    got = relational.divide(pairs, "k", "i", pairs.select("i").limit(0), mode=mode)
    assert sorted(r.k for r in got.collect()) == want


def test_division(spark):
    pairs = table(spark, [(1, "x"), (1, "y"), (1, "x"), (2, "x"), (3, "y"), (3, "z")], "k int, i string")
    for mode in ("forall", "difference"):
        assert [r.k for r in relational.divide(pairs, "k", "i", pairs.where("k = 1"), mode=mode).collect()] == [1]


@pytest.mark.parametrize("listed, want", [([1, None], []), ([], [1, 2, None]), ([1], [2]), ([9], [1, 2])])
def test_not_in_follows_null_rules(spark, listed, want):
    left = table(spark, [(1,), (2,), (None,)], "a int")
    got = relational.not_in(left, "a", table(spark, [(x,) for x in listed], "b int"), "b")
    assert sorted((r.a for r in got.collect()), key=str) == sorted(want, key=str)


def test_plans_stay_distributed(spark):
    df = table(spark, [(1, 2)], "a int, b int")
    plan = lambda x: x._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan(relational.top_with_ties(df, "b"))
    assert "Expand" not in plan(relational.two_distinct_counts(df, "a", "b", "b"))
    assert "TakeOrderedAndProject" in plan(ranking.top_k(df, 3, "b", "a"))


# Lines -----------------------------------------------------------------------------

HEAD = "medallion,hack_license,x,pickup_datetime,4,5,6,7,8,9,total_amount"
FIELDS = {"head": 0, "licence": 1, "stamp": 3, "total": 10}


def test_dirty_lines(spark):
    rows = ["", "a,b,c,d,e,f,g,h,i,j", HEAD, HEAD.replace("total_amount", "3.5"), "m,1,,2001,,,,,,,2.0", "m,1,,2001-01-01 00:00:00,,,,,,,abc", "m,1,,2001-01-01 00:00:00,,,,,,,2.5,extra"]
    scanned = lines.scan_delimited(table(spark, [(r,) for r in rows], "value string"), FIELDS)
    body = lines.drop_headers(scanned, {"head": "MEDALLION", "licence": "hack_license", "total": "total_amount"})
    assert [tuple(r) for r in lines.drop_dirty(body, "licence", "stamp", "total").collect()] == [("1", "2001-01-01", 2.5)]


def test_blank_prefix_is_no_filter(spark):
    df = table(spark, [("2001-01",), ("2002-01",)], "day string")
    assert lines.starting_with(df, "day", "  ").count() == 2 and lines.starting_with(df, "day", " 2001 ").count() == 1


def test_key_value_fallback(spark):
    df = table(spark, [("a\t1",), ("b 2",), ("c",), ("d e 3",), ("f\tg\t4",), ("h\tx",)], "value string")
    assert sorted(tuple(r) for r in lines.scan_key_value(df).collect()) == [("a", 1.0), ("b", 2.0), ("d", 3.0), ("f\tg", 4.0)]


def test_last_row_of_an_id_wins(spark, tmp_path):
    for i, body in enumerate(["1 2.0 3.0\n2\t5 6\n", "1 7.0 8.0\nx 1 2\n"]):
        (tmp_path / f"part-{i}.txt").write_text(body)
    got = lines.scan_numeric(lines.read_lines(spark, str(tmp_path)), ["id", "x", "y"])
    assert sorted(tuple(r) for r in got.collect()) == [(1, 7.0, 8.0), (2, 5.0, 6.0)]


def test_tagged_documents(spark):
    rows = ['<doc id="a/b/1" url="u">text > more</doc></doc>', "plain", 'id="x" and nothing']
    df = table(spark, [(r,) for r in rows], "value string")
    assert [tuple(r) for r in lines.scan_tagged(df).collect()] == [("a/b/1", "text > more</doc>"), ("", ""), ("", "")]
    assert [tuple(r) for r in lines.scan_tagged(df, "position").collect()] == [("a/b/1", "text > more</doc></doc>")]


def test_query_lines(spark):
    df = table(spark, [("predict_label (3, 'it is it')",), ("",), ("x",), ('predict_label(10, "a \'b\'")',)], "value string")
    assert sorted(tuple(r) for r in lines.scan_queries(df).collect()) == [(3, "it is it"), (10, "a 'b'")]


def test_sinks_round_trip(spark, tmp_path):
    df = table(spark, [(f"k{i}", float(i)) for i in range(50)], "k string, v double")
    sinks.write_key_value(df, f"{tmp_path}/kv", "k", "v", 4)
    back = lines.scan_key_value(lines.read_lines(spark, f"{tmp_path}/kv"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    sinks.write_ranked(ranking.ranked(df, 3, "v", "k"), f"{tmp_path}/top", "k", "v")
    assert [r.value for r in spark.read.text(f"{tmp_path}/top").collect()] == ["1\tk49\t49.0", "2\tk48\t48.0", "3\tk47\t47.0"]


# Vectors, graphs, models -----------------------------------------------------------

def test_documents_without_words_keep_a_row(spark):
    docs = table(spark, [(1, "a a b"), (2, "?"), (3, None)], "doc_id long, text string")
    words = F.coalesce(text.words_ascii("text"), F.array().cast("array<string>"))
    vocab = vectors.vocabulary(vectors.word_count(docs, words), 10)
    rows = vectors.gathered(vectors.indexed(docs, "doc_id", words, vocab), docs, "doc_id", "cnt")
    assert {r.doc_id: [tuple(e) for e in r.entries] for r in rows.collect()} == {1: [(0, 2.0), (1, 1.0)], 2: [], 3: []}


def test_features_without_variance_go(spark):
    long = table(spark, [(1, 0, 2.0), (2, 0, 2.0), (1, 1, 1.0)], "doc_id long, idx long, v double")
    got = vectors.standardised(long, "doc_id", vectors.moments(long, 2)).collect()
    assert [(r.doc_id, r.idx, r.v) for r in got] == [(1, 1, 1.0)]


def edges(spark, pairs):
    return table(spark, pairs, "src long, dst long")


def test_pagerank_with_and_without_sinks(spark):
    nodes = table(spark, [(1,), (2,), (3,)], "node long")
    ring = graph.pagerank(nodes, edges(spark, [(1, 2), (2, 3), (3, 1)]), tolerance=1e-9)
    assert all(r["rank"] == pytest.approx(1 / 3) for r in ring.collect())
    sink = graph.pagerank(nodes, edges(spark, [(1, 2), (3, 2), (1, 3)]), tolerance=1e-9)
    rank = np.full(3, 1 / 3)
    for _ in range(200):
        rank = 0.05 + 0.85 * (np.array([0, rank[0] / 2 + rank[2], rank[0] / 2]) + rank[1] / 3)
    assert [r["rank"] for r in sink.orderBy("node").collect()] == pytest.approx(rank.tolist(), abs=1e-6)


def test_components(spark):
    nodes = table(spark, [(i,) for i in range(1, 5)], "node long")
    got = graph.all_components(nodes, edges(spark, [(3, 2)])).collect()
    assert sorted((r.node, r.root) for r in got) == [(1, 1), (2, 2), (3, 2), (4, 4)]
    none = graph.all_components(nodes, edges(spark, [])).collect()
    assert all(r.node == r.root for r in none)


def test_components_of_a_long_path_and_random_edges(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(200)] + [(rng.randrange(300, 600), rng.randrange(300, 600)) for _ in range(200)]
    rng.shuffle(pairs)
    parent = list(range(600))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in pairs:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = {r.node: r.root for r in graph.components(edges(spark, pairs), "src", "dst").collect()}
    assert got == {n: find(n) for n in {x for p in pairs for x in p}}


def test_logistic_regression_is_that_of_numpy(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 4)) * (rng.random((80, 4)) < 0.7)
    y = (x @ [1, -2, 0.5, 0] > 0).astype(int)
    rows = [(i, int(y[i]), [(j, float(v)) for j, v in enumerate(x[i]) if v]) for i in range(80)] + [(80, 1, [])]
    x, y = np.vstack([x, np.zeros(4)]), np.append(y, 1)
    df = table(spark, rows, "id long, label int, entries array<struct<idx:long,v:double>>").repartition(3)
    w, rate, last = np.zeros(4), 0.5, None
    for _ in range(15):
        z = x @ w
        loss = (np.logaddexp(0, z) - y * z).mean() + 0.005 * w @ w
        if last is not None:
            rate *= 1.05 if loss < last else 0.5
            if abs(last - loss) < 1e-4:
                break
        last = loss
        w = w - rate * (x.T @ (1 / (1 + np.exp(-z)) - y) / len(y) + 0.01 * w)
    got = models.train_logistic(df, 4, 15, rate=0.5)
    assert got == pytest.approx(w, rel=1e-9)
    scores = models.scored(df, "id", models.weight_table(spark, got)).collect()
    assert {r.id: r.z for r in scores} == pytest.approx(dict(enumerate(x @ w)), abs=1e-9)


def test_recorded_rates(spark):
    counts = table(spark, [(0.5, 366, 7, 18341, 11)], "threshold double, tp long, fp long, tn long, fn long")
    r = models.rates(counts).first()
    assert [round(v, 6) for v in (r.precision, r.recall, r.f1, r.accuracy)] == [0.981233, 0.970822, 0.976, 0.999039]
    zero = models.rates(table(spark, [(0.5, 0, 0, 0, 0)], counts.schema)).first()
    assert (zero.precision, zero.recall, zero.f1, zero.accuracy) == (0, 0, 0, 0)


def test_first_threshold_wins_a_tie(spark):
    df = table(spark, [(1, 0.9), (0, 0.01)], "label int, p double")
    assert models.best_threshold(models.confusion(df)).first().threshold == 0.05


def test_vote_tie_goes_to_the_nearest(spark):
    df = table(spark, [(1, "a", 2), (1, "b", 1), (1, "c", 3), (2, "a", 1), (2, "b", 2), (2, "b", 3)], "query long, label string, rank int")
    assert {r["query"]: r.label for r in neighbours.majority(df, "label").collect()} == {1: "b", 2: "b"}


def test_outliers_exact_and_pruned(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.default_rng(3)
    points = np.vstack([rng.normal(size=(150, 5)), rng.normal(size=(4, 5)) * 9])
    df = table(spark, [(i, p.tolist()) for i, p in enumerate(points)], "id long, vec array<double>").repartition(3)
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
    kth = np.sort(far, 1)[:, 10]
    want = sorted(((-round(d, 6), i) for i, d in enumerate(kth)))[:5]
    for found in (neighbours.outliers, neighbours.pruned_outliers):
        assert [(-r.kth, r.id) for r in found(df, "id", "vec").collect()] == want


def test_outliers_of_few_points(spark):
    df = table(spark, [(1, [0.0]), (2, [1.0]), (3, [5.0])], "id long, vec array<double>")
    assert [(r.id, r.kth) for r in neighbours.outliers(df, "id", "vec", 10, 5).collect()] == [(1, 5.0), (3, 5.0), (2, 4.0)]
    assert neighbours.pruned_outliers(df, "id", "vec", 10, 5).count() == 0


def test_co_occurrence_diagonal(spark):
    df = table(spark, [(1, "a"), (1, "b"), (1, "a"), (2, "a")], "basket int, item string")
    got = {(r.a, r.b): r.n for r in products.co_occurrence(df, "basket", "item", symmetric=True).collect()}
    assert got == {("a", "a"): 2, ("a", "b"): 1, ("b", "a"): 1, ("b", "b"): 1}


def test_binomial_mixture_is_that_of_numpy(spark):
    rng = np.random.default_rng(4)
    heads = rng.binomial(6, rng.choice([0.2, 0.7], 200))
    df = table(spark, [(int(h), 6) for h in heads], "heads int, flips int")
    a, b = 0.79, 0.51
    for got in models.binomial_em(df, "heads", "flips", rounds=4):
        la, lb = (p**heads * (1 - p) ** (6 - heads) for p in (a, b))
        wa = la / (la + lb)
        a, b = (wa * heads).sum() / (6 * wa.sum()), ((1 - wa) * heads).sum() / (6 * (1 - wa).sum())
        assert got == pytest.approx((a, b), rel=1e-9)


def test_line_conditionals(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(60, 5, 50), 2)
    y = np.round(20 * x + 50 + rng.normal(0, 9, 50), 2)
    df = table(spark, list(zip(x.tolist(), y.tolist())), "x double, y double")
    r = models.line_conditionals(models.line_moments(df, "x", "y"), 19.0, 40.0, 200.0).first()
    assert (r["shape"], r["scale"]) == pytest.approx((10 + 25, 1 + ((40 + 19 * x - y) ** 2).sum() / 2))
    var = 1 / (1 / 100**2 + 50 / 200**2)
    assert (r.c_var, r.c_mean) == pytest.approx((var, var * (50 / 100**2 + (y - 19 * x).sum() / 200**2)))
    var = 1 / (1 / 10**2 + (x**2).sum() / 200**2)
    assert (r.m_var, r.m_mean) == pytest.approx((var, var * (5 / 10**2 + (x * (y - 40)).sum() / 200**2)))
    assert models.line_mse(df, "x", "y", 19.0, 40.0).first().mse == pytest.approx(((40 + 19 * x - y) ** 2).mean())


def test_forall_query_divides_by_brands(spark, sf_dir):
    from prairie.plans import relational as plans

    read = lambda name, *columns: [tuple(r) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns).collect()]
    brand, owner = dict(read("part", "p_partkey", "p_brand")), dict(read("orders", "o_orderkey", "o_custkey"))
    wanted = {b for _, b, size in read("part", "p_partkey", "p_brand", "p_size") if size <= 50}
    bought: dict = {}
    for order, part in read("lineitem", "l_orderkey", "l_partkey"):
        if order in owner and part in brand:
            bought.setdefault(owner[order], set()).add(brand[part])
    everybody = {c for c, in read("customer", "c_custkey")}
    got = sorted(r.o_custkey for r in plans.QUERIES["u5_division_forall_brands"](spark, sf_dir).collect())
    assert wanted and got == sorted(c for c in everybody if wanted <= bought.get(c, set())) and len(got) < len(everybody)
