"""Filters, joins, sets, divisions, groups and ranks over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prairie.operators import relational as ops
from prairie.session import table as T


def _bought(spark, d) -> DataFrame:
    """(o_custkey, p_brand, o_orderdate) of all lines."""
    orders = T(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = T(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    parts = T(spark, d, "part").select("p_partkey", "p_brand")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).join(parts, lines.l_partkey == parts.p_partkey).select("o_custkey", "p_brand", "o_orderdate")


_BOUGHT = "(SELECT o_custkey, p_brand, o_orderdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"
_money = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def p1(spark, d):
    return T(spark, d, "orders").where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey").distinct()


def p2(spark, d):
    return T(spark, d, "part").where(F.col("p_type").isin("ECONOMY", "PROMO") & (F.col("p_size") < 20)).select("p_partkey", "p_size")


def p4(spark, d):
    rows = T(spark, d, "lineitem").where((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.05) & (F.col("l_quantity") < 24))
    return rows.agg(F.count(F.lit(1)).alias("n"))


def p5(spark, d):
    parts = T(spark, d, "part").where((F.col("p_brand") == "Brand#1") | (F.col("p_size") == 7))
    return T(spark, d, "lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey")).select("l_suppkey").distinct()


def p6(spark, d):
    return T(spark, d, "customer").where(F.col("c_custkey") != 1).select("c_custkey", "c_name")


def p7(spark, d):
    return ops.having_between(T(spark, d, "orders"), "o_custkey", 5, 10).select("o_orderkey", "o_custkey")


def j1(spark, d):
    c, o = T(spark, d, "customer"), T(spark, d, "orders")
    return o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "c_name")


def j2(spark, d):
    """Parts and suppliers that occur in both a returned and an open line: a semi-join of one side."""
    lines = T(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag")
    a, b = lines.where("l_returnflag = 'R'"), lines.where("l_returnflag = 'A'").drop("l_returnflag")
    return a.join(b, ["l_partkey", "l_suppkey"], "left_semi").select("l_partkey", "l_suppkey").distinct()


def j3(spark, d):
    lines, o, p, s = (T(spark, d, n) for n in ("lineitem", "orders", "part", "supplier"))
    joined = lines.join(o, lines.l_orderkey == o.o_orderkey).join(p, lines.l_partkey == p.p_partkey).join(s, lines.l_suppkey == s.s_suppkey)
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", "p_brand", "s_name")


def j4(spark, d):
    """Customers and the suppliers' nations that served them, over two many-to-many links."""
    lines = T(spark, d, "lineitem").select("l_orderkey", "l_suppkey")
    orders = T(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    suppliers = T(spark, d, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    served = lines.join(orders, "l_orderkey").select("o_custkey", "l_suppkey").distinct()
    return served.join(suppliers, "l_suppkey").select("o_custkey", "s_nationkey").distinct()


def j5(spark, d):
    o = T(spark, d, "orders").where("o_orderpriority = '1-URGENT'").groupBy("o_custkey").agg(F.count("*").alias("n"))
    c = T(spark, d, "customer")
    return c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", F.coalesce("n", F.lit(0)).alias("n"))


def j6(spark, d):
    o = T(spark, d, "orders")
    counts = o.groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return ops.with_scalar(counts, o.agg(F.count("*").alias("total")))


def j8(spark, d):
    """Suppliers of any line of any order of customer 7: semi-joins all the way."""
    orders = T(spark, d, "orders").where("o_custkey = 7").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = T(spark, d, "lineitem").join(orders, "l_orderkey", "left_semi").select(F.col("l_suppkey").alias("s_suppkey"))
    return T(spark, d, "supplier").join(lines, "s_suppkey", "left_semi").select("s_suppkey", "s_name")


def j9(spark, d):
    seen = _bought(spark, d).where("p_brand = 'Brand#1'").select(F.col("o_custkey").alias("c_custkey"))
    return T(spark, d, "customer").join(seen, "c_custkey", "left_anti").select("c_custkey")


def j11(spark, d):
    """Parts whose key is not among the suppliers' keys of large lines; the list holds no NULL here."""
    listed = T(spark, d, "lineitem").where("l_quantity >= 50").select("l_partkey")
    return ops.not_in(T(spark, d, "part").select("p_partkey"), "p_partkey", listed, "l_partkey")


def j11_null(spark, d):
    """The same with a NULL in the list for every large line: no row is left."""
    listed = T(spark, d, "lineitem").where("l_quantity >= 50").select(F.when(F.col("l_tax") > 0.01, F.col("l_partkey")).alias("k"))
    return ops.not_in(T(spark, d, "part").select("p_partkey"), "p_partkey", listed, "k")


def j12(spark, d):
    """Customers that share no part with customer 7."""
    o = T(spark, d, "orders").select("o_orderkey", "o_custkey")
    lines = T(spark, d, "lineitem").select("l_orderkey", "l_partkey")
    pairs = lines.join(o, lines.l_orderkey == o.o_orderkey).select("o_custkey", "l_partkey")
    own = pairs.where("o_custkey = 7").select("l_partkey").distinct()
    sharing = pairs.join(own, "l_partkey", "left_semi").select(F.col("o_custkey").alias("c_custkey"))
    return T(spark, d, "customer").where("c_custkey <> 7").join(sharing, "c_custkey", "left_anti").select("c_custkey")


def j13(spark, d):
    o = T(spark, d, "orders")
    sums = o.where("o_orderstatus = 'F'").groupBy("o_custkey").agg(_money("o_totalprice").alias("total"))
    c = T(spark, d, "customer")
    return c.join(sums, c.c_custkey == sums.o_custkey, "left").select("c_custkey", F.coalesce("total", F.lit(0.0)).alias("total"))


def j14(spark, d):
    p = T(spark, d, "part")
    return ops.with_scalar(p, p.agg(F.min("p_retailprice").alias("low"))).where("p_retailprice = low").select("p_partkey", "p_retailprice")


def j15(spark, d):
    often = T(spark, d, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).where("n > 12").select(F.col("o_custkey").alias("c_custkey"))
    return T(spark, d, "customer").join(often, "c_custkey", "left_semi").select("c_custkey", "c_name")


def _suppliers_of(spark, d, brand):
    lines = T(spark, d, "lineitem").select("l_partkey", "l_suppkey")
    parts = T(spark, d, "part").where(F.col("p_brand") == brand).select(F.col("p_partkey").alias("l_partkey"))
    return lines.join(parts, "l_partkey", "left_semi").select("l_suppkey")


def u1(spark, d):
    return _suppliers_of(spark, d, "Brand#1").intersect(_suppliers_of(spark, d, "Brand#2"))


def u2(spark, d):
    return T(spark, d, "part").select(F.col("p_partkey").alias("key")).subtract(T(spark, d, "lineitem").where("l_quantity > 45").select("l_partkey"))


def u4(spark, d):
    """Customers that bought every brand, by double difference: none if there is no brand."""
    return ops.divide(_bought(spark, d), "o_custkey", "p_brand", T(spark, d, "part").select("p_brand"), mode="difference")


def _bought_every_brand(spark, d, sizes):
    everybody = T(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"))
    return ops.divide(_bought(spark, d), "o_custkey", "p_brand", T(spark, d, "part").where(sizes).select("p_brand"), everybody)


def u5(spark, d):
    """Customers for whom every brand of a negative size was bought: all, as there is no such brand."""
    return _bought_every_brand(spark, d, "p_size < 0")


def u5_brands(spark, d):
    """Customers for whom every brand of size 50 or less was bought."""
    return _bought_every_brand(spark, d, "p_size <= 50")


def u6(spark, d):
    """Customers with all brands and the day that completed the set."""
    first = _bought(spark, d).groupBy("o_custkey", "p_brand").agg(F.min("o_orderdate").alias("day"))
    total = T(spark, d, "part").agg(F.countDistinct("p_brand").alias("total"))
    done = first.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("day").alias("completed"))
    return ops.with_scalar(done, total).where("n = total").select("o_custkey", "completed")


def u7(spark, d):
    best = ops.jaccard_to(_bought(spark, d), "o_custkey", "p_brand", 7)
    return ops.top_with_ties(best, "similarity")


def g1(spark, d):
    return T(spark, d, "lineitem").agg(F.count(F.lit(1)).alias("n"))


def g2(spark, d):
    return T(spark, d, "part").groupBy("p_name").agg(F.countDistinct("p_brand").alias("brands")).where("brands > 1")


def g3(spark, d):
    c, o = T(spark, d, "customer"), T(spark, d, "orders")
    rows = c.join(o, c.c_custkey == o.o_custkey, "left").select("c_custkey", "o_orderpriority", "o_orderstatus")
    counts = ops.two_distinct_counts(rows, "c_custkey", "o_orderpriority", "o_orderstatus")
    return ops.with_scalar(counts, counts.agg(F.min("n_a").alias("low"))).where("n_a = low").drop("low")


def g4(spark, d):
    first = T(spark, d, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    return first.agg(F.max("first").alias("latest_first"))


def g5(spark, d):
    rows = T(spark, d, "orders").select(F.month("o_orderdate").alias("month"), F.date_format("o_orderdate", "MMMM").alias("name"))
    return ops.share_of_total(rows, "month", "name").orderBy("month")


def g21(spark, d):
    return T(spark, d, "lineitem").select("l_partkey", "l_returnflag").distinct()


def w1(spark, d):
    """Lines of the largest quantity, with ties and duplicates."""
    return ops.top_with_ties(T(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity"), "l_quantity")


def o8(spark, d):
    return T(spark, d, "customer").select("c_nationkey", "c_acctbal", "c_custkey").orderBy("c_nationkey", F.desc("c_acctbal"), "c_custkey")


QUERIES = {
    "p1_equality_distinct": p1, "p2_in_and_range": p2, "p4_count_where": p4, "p5_disjunction": p5, "p6_inequality": p6,
    "p7_having_between": p7, "j1_inner_join": j1, "j2_self_join": j2, "j3_star_join": j3, "j4_join_chain": j4,
    "j5_left_join": j5, "j6_cross_one_row": j6, "j8_nested_exists": j8, "j9_not_exists": j9, "j11_not_in": j11,
    "j11_not_in_null": j11_null, "j12_disjoint": j12, "j13_correlated_sum": j13, "j14_scalar_subquery": j14,
    "j15_in_grouped": j15, "u1_intersect": u1, "u2_except": u2, "u4_division_difference": u4, "u5_division_forall": u5,
    "u5_division_forall_brands": u5_brands,
    "u6_division_count": u6, "u7_jaccard_best": u7, "g1_count": g1, "g2_having_distinct": g2, "g3_two_distincts": g3,
    "g4_min_then_max": g4, "g5_month_fraction": g5, "g21_distinct": g21, "w1_top_with_ties": w1, "o8_multi_key_order": o8,
}
SQL = {
    "p1_equality_distinct": "SELECT DISTINCT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'",
    "p2_in_and_range": "SELECT p_partkey, p_size FROM part WHERE p_type IN ('ECONOMY', 'PROMO') AND p_size < 20",
    "p4_count_where": "SELECT count(*) AS n FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05 AND l_quantity < 24",
    "p5_disjunction": "SELECT DISTINCT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#1' OR p_size = 7",
    "p6_inequality": "SELECT c_custkey, c_name FROM customer WHERE c_custkey <> 1",
    "p7_having_between": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) BETWEEN 5 AND 10)",
    "j1_inner_join": "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
    "j2_self_join": "SELECT DISTINCT a.l_partkey, a.l_suppkey FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey WHERE a.l_returnflag = 'R' AND b.l_returnflag = 'A'",
    "j3_star_join": "SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, p_brand, s_name FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey",
    "j4_join_chain": "SELECT DISTINCT o_custkey, s_nationkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey",
    "j5_left_join": "SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderpriority = '1-URGENT' GROUP BY 1",
    "j6_cross_one_row": "SELECT o_orderstatus, count(*) AS n, (SELECT count(*) FROM orders) AS total FROM orders GROUP BY 1",
    "j8_nested_exists": "SELECT s_suppkey, s_name FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_custkey = 7))",
    "j9_not_exists": f"SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM {_BOUGHT} b WHERE b.o_custkey = c_custkey AND p_brand = 'Brand#1')",
    "j11_not_in": "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50)",
    "j11_not_in_null": "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT CASE WHEN l_tax > 0.01 THEN l_partkey END FROM lineitem WHERE l_quantity >= 50)",
    "j12_disjoint": "SELECT c_custkey FROM customer WHERE c_custkey <> 7 AND c_custkey NOT IN (SELECT o_custkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_partkey IN (SELECT l_partkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_custkey = 7))",
    "j13_correlated_sum": "SELECT c_custkey, coalesce((SELECT sum(o_totalprice::DECIMAL(18,2)) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F'), 0)::DOUBLE AS total FROM customer",
    "j14_scalar_subquery": "SELECT p_partkey, p_retailprice FROM part WHERE p_retailprice = (SELECT min(p_retailprice) FROM part)",
    "j15_in_grouped": "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 12)",
    "u1_intersect": "SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#1' INTERSECT SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_brand = 'Brand#2'",
    "u2_except": "SELECT p_partkey AS key FROM part EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity > 45",
    "u4_division_difference": f"WITH b AS (SELECT DISTINCT o_custkey, p_brand FROM {_BOUGHT}) SELECT o_custkey FROM b EXCEPT SELECT o_custkey FROM (SELECT c.o_custkey, p.p_brand FROM (SELECT DISTINCT o_custkey FROM b) c, (SELECT DISTINCT p_brand FROM part) p EXCEPT SELECT o_custkey, p_brand FROM b)",
    "u5_division_forall": f"SELECT c_custkey AS o_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p_size < 0 AND p.p_brand NOT IN (SELECT b.p_brand FROM {_BOUGHT} b WHERE b.o_custkey = c_custkey))",
    "u5_division_forall_brands": f"SELECT c_custkey AS o_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p_size <= 50 AND p.p_brand NOT IN (SELECT b.p_brand FROM {_BOUGHT} b WHERE b.o_custkey = c_custkey))",
    "u6_division_count": f"WITH f AS (SELECT o_custkey, p_brand, min(o_orderdate) AS day FROM {_BOUGHT} GROUP BY 1, 2) SELECT o_custkey, max(day) AS completed FROM f GROUP BY 1 HAVING count(*) = (SELECT count(DISTINCT p_brand) FROM part)",
    "u7_jaccard_best": f"WITH b AS (SELECT DISTINCT o_custkey, p_brand FROM {_BOUGHT}), m AS (SELECT p_brand FROM b WHERE o_custkey = 7), j AS (SELECT o_custkey, count(*) FILTER (WHERE p_brand IN (SELECT p_brand FROM m)) AS s, count(*) AS n FROM b WHERE o_custkey <> 7 GROUP BY 1), r AS (SELECT o_custkey, s::DOUBLE / (n + (SELECT count(*) FROM m) - s) AS similarity FROM j) SELECT * FROM r WHERE similarity = (SELECT max(similarity) FROM r)",
    "g1_count": "SELECT count(*) AS n FROM lineitem",
    "g2_having_distinct": "SELECT p_name, count(DISTINCT p_brand) AS brands FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1",
    "g3_two_distincts": "WITH c AS (SELECT c_custkey, count(DISTINCT o_orderpriority) AS n_a, count(DISTINCT o_orderstatus) AS n_b FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) SELECT * FROM c WHERE n_a = (SELECT min(n_a) FROM c)",
    "g4_min_then_max": "SELECT max(f) AS latest_first FROM (SELECT min(o_orderdate) AS f FROM orders GROUP BY o_custkey)",
    "g5_month_fraction": "SELECT month(o_orderdate)::INT AS month, monthname(o_orderdate) AS name, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM orders) AS fraction FROM orders GROUP BY 1, 2",
    "g21_distinct": "SELECT DISTINCT l_partkey, l_returnflag FROM lineitem",
    "w1_top_with_ties": "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity = (SELECT max(l_quantity) FROM lineitem)",
    "o8_multi_key_order": "SELECT c_nationkey, c_acctbal, c_custkey FROM customer ORDER BY c_nationkey, c_acctbal DESC, c_custkey",
}
