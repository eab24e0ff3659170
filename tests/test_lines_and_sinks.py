"""Lines split once, odd amounts, files written and read again, tables with replaced partitions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from prairie.operators import graph, models
from prairie.plans import graph as graph_plans
from prairie.plans import revenue
from prairie.session import fresh_path
from prairie.sources import lines, sinks


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("query", [revenue.revenue_by_date, revenue.revenue_by_driver, revenue.month_of, revenue.without_headers, revenue.scanned])
def test_a_line_is_split_once(spark, sf_dir, query):
    assert plan_of(query(spark, sf_dir)).count("split(") == 1


def test_scan_of_odd_lines(spark):
    rows = ["a,b,c", "a,b", "", None, "a,b,", ",,", "a,b,c,d"]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(rows)], "value string, place int")
    got = lines.scan_delimited(df, {"x": 0, "y": 2, "z": 3}, least=3).collect()
    assert sorted((r.place, r.x, r.y, r.z) for r in got) == [(0, "a", "c", None), (4, "a", "", None), (5, "", "", None), (6, "a", "c", "d")]


def test_amounts_beyond_cents_do_not_end_the_job(spark):
    rows = [("a", 1.25), ("a", 1e17), ("a", float("nan")), ("a", float("inf")), ("b", -1e300), ("a", 2.5), ("c", None)]
    df = spark.createDataFrame(rows, "key string, amount double")
    got = {r.key: r.revenue for r in df.groupBy("key").agg(revenue.cents("amount").alias("revenue")).collect()}
    assert got == {"a": 3.75, "b": None, "c": None}
    line = spark.createDataFrame([("m,7,,2000-01-01 00:00:00,,,,,,,1e17",), ("m,7,,2000-01-01 00:00:00,,,,,,,2.5",)], "value string")
    clean = lines.drop_dirty(lines.scan_delimited(line, revenue.FIELDS), "licence", "stamp", "total")
    assert clean.groupBy("day").agg(revenue.cents("amount").alias("r")).first().r == 2.5
    m = models.line_moments(spark.createDataFrame([(1.0, 2.0), (1e17, 1.0), (1.0, None), (float("nan"), 1.0)], "x double, y double"), "x", "y").first()
    assert (m.n, m.sx, m.syy) == (1, 1.0, 4.0)


# Sinks -----------------------------------------------------------------------------


def test_part_files_are_one_relation(spark):
    rows = spark.createDataFrame([(f"k {i % 40}", float(i)) for i in range(40)] + [("no number", None)], "key string, v double")
    path = fresh_path(spark, "kv")
    sinks.write_key_value(rows, path, "key", "v", parts=4)
    files = spark.read.text(path).select(F.input_file_name().alias("f")).distinct().count()
    assert 1 < files <= 4
    got = sorted((r.key, r.amount) for r in sinks.read_key_value(spark, path).collect())
    assert got == sorted((f"k {i}", float(i)) for i in range(40))


def test_ranked_lines_are_read_again(spark):
    path = fresh_path(spark, "ranked")
    sinks.write_ranked(spark.createDataFrame([(2, "b", 1.5), (1, "a", 2.0)], "rank int, key string, v double"), path, "key", "v")
    assert [r.value for r in spark.read.text(path).collect()] == ["1\ta\t2.0", "2\tb\t1.5"]
    assert sorted(tuple(r) for r in sinks.read_ranked(spark, path).collect()) == [(1, "a", 2.0), (2, "b", 1.5)]


def test_partitions_are_replaced_one_by_one(spark):
    path = fresh_path(spark, "parts")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = spark.createDataFrame([(1, "x", 5), (2, "y", 6), (3, "z", None)], "a int, b string, p int")
    assert sorted(r.a for r in sinks.save_table(rows, name, path, ("p",)).collect()) == [1, 2, 3]
    with pytest.raises(Exception, match="exist"):
        sinks.save_table(rows, name, path, ("p",))
    new = spark.createDataFrame([(6, 9, "n"), (7, 9, "n"), (None, 8, "m")], "p int, a int, b string")
    got = sinks.replace_partitions(new, name)
    assert sorted((r.a, r.b, r.p or 0) for r in got.collect()) == [(1, "x", 5), (8, "m", 0), (9, "n", 6), (9, "n", 7)]
    assert sinks.replace_partitions(new.limit(0), name).count() == 4
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


# Graphs ----------------------------------------------------------------------------


def test_nodes_of_edges_only_count(spark):
    nodes = spark.createDataFrame([(1,), (2,), (5,)], "node long")
    edges = spark.createDataFrame([(1, 7), (7, 2), (2, 8), (None, 5)], "src long, dst long")
    found = graph.all_components(nodes, edges)
    assert sorted((r.node, r.root, r.listed) for r in found.collect()) == [(1, 1, True), (2, 1, True), (5, 5, True), (7, 1, False), (8, 1, False)]
    assert sorted((r.node, r["size"]) for r in graph.components_between(found, 2, 9).collect()) == [(1, 4), (2, 4)]


def test_rounds_read_the_edges_where_they_lie(spark, sf_dir, monkeypatch):
    """The edges are computed once; the join of a round does not shuffle them."""
    edges = graph.laid_out(graph_plans.bought_next(spark, sf_dir))
    ranks = graph.start_ranks(graph_plans.parts(spark, sf_dir), edges, 200)
    step = graph.rank_step(ranks, edges, 200, 0.85)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph.rank_step(ranks, edges, 200, 0.85)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "lineitem" not in plan and "Window" not in plan
    joined = plan[plan.index("SortMergeJoin [src") :]
    left = joined[: joined.index("FileScan")]
    assert "Exchange" not in left and "Bucketed: true" in plan
    assert step.count() == 200


def test_null_is_a_key_and_an_item(spark):
    from prairie.operators import relational

    rows = [(1, "a"), (1, None), (None, "a"), (None, None), (2, "a"), (2, "a")]
    df = spark.createDataFrame(rows, "k int, i string")
    assert sorted((r.k or 0, r.n_a, r.n_b) for r in relational.two_distinct_counts(df, "k", "i", "i").collect()) == [(0, 1, 1), (1, 1, 1), (2, 1, 1)]
    assert {r.k for r in relational.divide(df, "k", "i", df.select("i")).collect()} == {1, None}
    assert {(r.k, r.similarity) for r in relational.jaccard_to(df, "k", "i", 1).collect()} == {(None, 1.0), (2, 0.5)}


def test_queries_load_where_only_a_folder_is_left_of_llm(monkeypatch):
    import importlib.util

    import __spark_entry__ as entry

    real = importlib.util.find_spec
    monkeypatch.setattr(entry, "find_spec", lambda n: None if n == "prairie.llm.registry" else real(n))
    assert entry._llm() == [] and "g6_revenue_by_date" in entry.queries()


def test_own_folder_only_where_the_cluster_names_none():
    from prairie import session

    class Conf(dict):
        get, set = dict.get, dict.__setitem__

    class Spark:
        def __init__(self, **conf):
            self.conf = Conf(conf)

    named, bare = Spark(**{"spark.checkpoint.dir": "/shared/"}), Spark()
    for s in (named, bare):
        session.name_shared_dir(s, "/own")
    assert (session.shared_dir(named), session.shared_dir(bare)) == ("/shared", "/own")
    with pytest.raises(RuntimeError):
        session.shared_dir(Spark())
