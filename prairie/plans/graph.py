"""Graphs: the chain of each customer's orders, and parts bought one after the other."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from prairie.operators import graph as g
from prairie.operators import ranking
from prairie.session import table as T


def chain(s, d):
    """Order to the same customer's next order."""
    following = F.lead("o_orderkey").over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    return T(s, d, "orders").select(F.col("o_orderkey").alias("src"), following.alias("dst")).where("dst IS NOT NULL")


def orders(s, d):
    return T(s, d, "orders").select(F.col("o_orderkey").alias("node"))


def bought_next(s, d):
    """Part to the part of the order's next line."""
    following = F.lead("l_partkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    return T(s, d, "lineitem").select(F.col("l_partkey").alias("src"), following.alias("dst")).where("dst IS NOT NULL")


def parts(s, d):
    return T(s, d, "part").select(F.col("p_partkey").alias("node"))


def _titled(ranks, s, d):
    """Titles for a top-k result, which is what is sent."""
    p = T(s, d, "part").select(F.col("p_partkey").alias("node"), "p_name")
    return p.join(F.broadcast(ranks), "node").select("node", "p_name", F.round("rank", 9).alias("rank"))


def top_ranked(s, d):
    return _titled(ranking.top_k(g.pagerank(parts(s, d), bought_next(s, d)), 10, "rank", "node"), s, d)


def chain_ranks(s, d):
    return g.pagerank(orders(s, d), chain(s, d)).select("node", F.round("rank", 9).alias("rank"))


def one_round(s, d):
    n = T(s, d, "part").count()
    edges = bought_next(s, d)
    return g.rank_step(g.start_ranks(parts(s, d), edges, n), edges, n, 0.85)


def rounds(s, d):
    """Five rounds, whatever the change."""
    return g.pagerank(parts(s, d), bought_next(s, d), tolerance=None, rounds=5).select("node", F.round("rank", 12).alias("rank"))


def fixed_top(s, d):
    """The ten parts with the highest rank after five rounds, with their names."""
    ranks = g.pagerank(parts(s, d), bought_next(s, d), tolerance=None, rounds=5)
    return _titled(ranking.top_k(ranks.withColumn("rank", F.round("rank", 9)), 10, "rank", "node"), s, d)


def components(s, d):
    return g.all_components(orders(s, d), chain(s, d))


def few_edges(s, d):
    """An eightieth of the orders' parts one after the other; the graph has branches, circles and lone parts."""
    following = F.lead("l_partkey").over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    lines = T(s, d, "lineitem").where("l_orderkey % 80 = 0")
    return lines.select(F.col("l_partkey").alias("src"), following.alias("dst")).where("dst IS NOT NULL")


def branched(s, d):
    """Components of parts; of the odd parts, only edges tell."""
    return g.all_components(parts(s, d).where("node % 2 = 0"), few_edges(s, d))


def branched_sizes(s, d):
    return branched(s, d).groupBy("root").agg(F.count("*").alias("size"), F.count_if("listed").alias("listed"))


def middling(s, d):
    """Components of five to ten orders, with the orders' dates."""
    found = g.components_between(components(s, d), 5, 10)
    titles = T(s, d, "orders").select(F.col("o_orderkey").alias("node"), "o_orderdate")
    return found.join(titles, "node").select("node", "root", "size", "o_orderdate").orderBy("root", "node")


def sizes(s, d):
    return components(s, d).groupBy("root").agg(F.count("*").alias("size"))


QUERIES = {
    "c11_pagerank_top": top_ranked,
    "c11_pagerank_chain": chain_ranks,
    "c11_one_round": lambda s, d: one_round(s, d).select("node", F.round("rank", 12).alias("rank")),
    "g12_l1_change": lambda s, d: one_round(s, d).agg(F.round(F.sum(F.abs(F.col("rank") - F.col("old"))), 9).alias("change")),
    "g13_out_degree": lambda s, d: g.out_degrees(bought_next(s, d)),
    "u3_symmetric_edges": lambda s, d: g.symmetric(bought_next(s, d)),
    "j10_j20_expand": lambda s, d: g.expand(bought_next(s, d), parts(s, d).where("node < 5")),
    "c11_five_rounds": rounds,
    "o1_c11_top_after_five_rounds": fixed_top,
    "c12_components": lambda s, d: components(s, d).select("node", "root"),
    "c12_g22_branched": branched_sizes,
    "c12_j21_components_between": middling,
    "g22_component_size": sizes,
}
_NEXT = "(SELECT l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS dst FROM lineitem)"
_EDGES = f"e AS (SELECT * FROM {_NEXT} WHERE dst IS NOT NULL)"
_ROUND = f"""WITH {_EDGES}, n AS (SELECT count(*) AS n FROM part), o AS (SELECT src, count(*) AS degree FROM e GROUP BY 1),
got AS (SELECT dst, sum(1.0::DOUBLE / n / degree) AS got FROM e JOIN o USING (src), n GROUP BY 1),
lost AS (SELECT coalesce(sum(1.0::DOUBLE / n), 0) AS lost FROM part, n WHERE p_partkey NOT IN (SELECT src FROM o)),
r AS (SELECT p_partkey AS node, 0.15::DOUBLE / n + 0.85::DOUBLE * (coalesce(got, 0) + lost / n) AS rank, 1.0::DOUBLE / n AS old FROM part LEFT JOIN got ON dst = p_partkey, n, lost) """
_STEP = """r{1} AS MATERIALIZED (SELECT p_partkey AS node, 0.15::DOUBLE / n + 0.85::DOUBLE * (coalesce(got, 0) + lost / n) AS rank FROM part, n
  LEFT JOIN (SELECT dst, sum(rank / degree) AS got FROM e JOIN o USING (src) JOIN r{0} ON r{0}.node = e.src GROUP BY 1) ON dst = p_partkey,
  (SELECT coalesce(sum(rank), 0) AS lost FROM r{0} WHERE node NOT IN (SELECT src FROM o)))"""
_FIVE = f"""WITH {_EDGES.replace('AS (', 'AS MATERIALIZED (', 1)}, n AS (SELECT count(*) AS n FROM part), o AS MATERIALIZED (SELECT src, count(*) AS degree FROM e GROUP BY 1),
r0 AS (SELECT p_partkey AS node, 1.0::DOUBLE / n AS rank FROM part, n), {', '.join(_STEP.format(i, i + 1) for i in range(5))} """
_FEW = f"""WITH RECURSIVE f AS (SELECT src, dst FROM (SELECT l_orderkey, l_partkey AS src, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS dst FROM lineitem)
  WHERE dst IS NOT NULL AND l_orderkey % 80 = 0),
both_ways AS (SELECT src AS a, dst AS b FROM f UNION SELECT dst, src FROM f),
reach AS (SELECT a, b FROM both_ways UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b),
root AS (SELECT a AS node, least(a, min(b)) AS root FROM reach GROUP BY 1),
every AS (SELECT p_partkey AS node FROM part WHERE p_partkey % 2 = 0 UNION SELECT node FROM root) """
_ROOTS = "(SELECT o_orderkey AS node, min(o_orderkey) OVER (PARTITION BY o_custkey) AS root, count(*) OVER (PARTITION BY o_custkey) AS size, o_orderdate FROM orders)"
SQL = {
    "c11_one_round": f"{_ROUND} SELECT node, round(rank, 12) AS rank FROM r",
    "g12_l1_change": f"{_ROUND} SELECT round(sum(abs(rank - old)), 9) AS change FROM r",
    "g13_out_degree": f"WITH {_EDGES} SELECT src, count(*) AS degree FROM e GROUP BY 1",
    "u3_symmetric_edges": f"WITH {_EDGES} SELECT src, dst FROM e UNION SELECT dst, src FROM e",
    "j10_j20_expand": f"WITH {_EDGES} SELECT DISTINCT dst AS node FROM e WHERE src < 5 AND dst >= 5",
    "c11_five_rounds": f"{_FIVE} SELECT node, round(rank, 12) AS rank FROM r5",
    "o1_c11_top_after_five_rounds": f"{_FIVE}, t AS (SELECT node, round(rank, 9) AS rank FROM r5 ORDER BY 2 DESC, 1 LIMIT 10) SELECT node, p_name, rank FROM t JOIN part ON p_partkey = node",
    "c12_g22_branched": f"{_FEW} SELECT coalesce(root, node) AS root, count(*) AS size, count(*) FILTER (WHERE node % 2 = 0 AND node IN (SELECT p_partkey FROM part)) AS listed FROM every LEFT JOIN root USING (node) GROUP BY 1",
    "c12_components": f"SELECT node, root FROM {_ROOTS}",
    "c12_j21_components_between": f"SELECT * FROM {_ROOTS} WHERE size BETWEEN 5 AND 10",
    "g22_component_size": f"SELECT DISTINCT root, size FROM {_ROOTS}",
}
