"""The column functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from prairie.functions import scalars as f
from prairie.functions import text as t
from prairie.session import table


def _over(name, *columns):
    return lambda spark, sf_dir: table(spark, sf_dir, name).select(*columns)


def _orders(name, made):
    return _over("orders", "o_orderkey", made.alias(name))


def _all() -> dict:
    """The queries, made when one is run: columns need a session."""
    z, size = F.col("c_acctbal") / 1000, F.col("p_size")
    return {
        "f1_month": _orders("month", f.month_number("o_orderdate")),
        "f2_month_name": _orders("month_name", f.month_name("o_orderdate")),
        "f3_date_text": _orders("day", f.date_text(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))),
        "f4_safe_double": _orders("number", f.safe_double(F.regexp_replace("o_orderpriority", "-.*[A-Z]", ".5"))),
        "f5_same_text": _orders("same", f.same_text("o_orderpriority", F.lit("1-urgent"))),
        "f6_trim": _orders("name", f.trimmed(F.concat(F.lit(" \t"), F.col("o_orderpriority"), F.lit("\n ")))),
        "f7_words_ascii": _over("documents", "doc_id", F.size(t.words_ascii("text")).cast("long").alias("n"), F.array_join(t.words_ascii("text"), " ").alias("words")),
        "f8_words_lowered": _over("documents", "doc_id", F.size(t.words_lowered("text")).cast("long").alias("n"), F.array_join(t.words_lowered("text"), " ").alias("words")),
        "f9_path_part": _orders("part", f.path_part(F.concat_ws("/", "o_orderstatus", "o_orderpriority", "o_custkey"))),
        "f10_prefix_label": _orders("label", f.prefix_label("o_orderpriority", "1")),
        "f11_zero_if_null": _orders("value", f.zero_if_null(F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")))),
        "f12_cast_before_division": _orders("ratio", F.col("o_custkey").cast("double") / (F.col("o_orderkey") + 1)),
        "f13_abs": _over("customer", "c_custkey", F.abs("c_acctbal").alias("size")),
        "f14_idf_log10": _over("part", "p_partkey", F.round(f.idf_log10(F.lit(1000), size - 1), 9).alias("idf")),
        "f15_idf_ln": _over("part", "p_partkey", F.round(f.idf_ln(F.lit(1000), size - 1), 9).alias("idf")),
        "f16_sigmoid": _over("customer", "c_custkey", F.round(f.sigmoid(z), 9).alias("p")),
        "f17_log1p_exp": _over("customer", "c_custkey", F.round(f.log1p_exp(z), 9).alias("loss")),
        "f18_logit": _over("part", "p_partkey", F.round(f.logit(size / 50), 9).alias("logit")),
        "f19_distance": _over(
            "embeddings", "vec_id", F.round(f.distance("embedding", F.reverse("embedding")), 6).alias("distance")
        ),
        "f20_binomial_pmf": _over("part", "p_partkey", F.round(f.binomial_pmf(size - 2, F.lit(45), 0.4), 9).alias("p")),
        "f21_presence": _over("lineitem", "l_orderkey", "l_linenumber", f.presence(F.col("l_quantity").cast("int") - 20).alias("bit")),
        "f22_snippet": _over("documents", "doc_id", f.snippet("text").alias("snippet")),
        "f23_power": _over("part", "p_partkey", F.round(F.sqrt("p_retailprice"), 9).alias("root"), F.round(F.pow("p_retailprice", F.lit(2)), 4).alias("square")),
        "f24_six_decimals": _over("customer", "c_custkey", f.six_decimals("c_acctbal").alias("text")),
        "p3_month_is": lambda spark, sf_dir: table(spark, sf_dir, "orders").where(f.month_is("o_orderdate", 6)).select("o_orderkey", "o_custkey"),
        "p14_computed_column": _over("lineitem", "l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4).alias("net")),
    }


def _query(name):
    return lambda spark, sf_dir: _all()[name](spark, sf_dir)


_ORDERS = "SELECT o_orderkey, {} FROM orders"
_LOG_CHOOSE = "list_sum(list_transform(range(1, least(k, 45 - k) + 1), lambda i: ln((45 - least(k, 45 - k) + i) / i)))"
SQL = {
    "f1_month": _ORDERS.format("month(o_orderdate)::INT AS month"),
    "f2_month_name": _ORDERS.format("monthname(o_orderdate) AS month_name"),
    "f3_date_text": _ORDERS.format("strftime(o_orderdate, '%Y-%m-%d') AS day"),
    "f4_safe_double": _ORDERS.format("try_cast(regexp_replace(o_orderpriority, '-.*[A-Z]', '.5') AS DOUBLE) AS number"),
    "f5_same_text": _ORDERS.format("lower(o_orderpriority) = '1-urgent' AS same"),
    "f6_trim": _ORDERS.format("o_orderpriority AS name"),
    "f7_words_ascii": "SELECT doc_id, len(w)::BIGINT AS n, array_to_string(w, ' ') AS words FROM (SELECT doc_id, list_transform(regexp_extract_all(text, '[a-zA-Z]+'), lambda x: lower(x)) AS w FROM documents)",
    "f8_words_lowered": "SELECT doc_id, len(w)::BIGINT AS n, array_to_string(w, ' ') AS words FROM (SELECT doc_id, regexp_extract_all(lower(text), '[a-z]+') AS w FROM documents)",
    "f9_path_part": _ORDERS.format("CASE WHEN len(string_split(concat_ws('/', o_orderstatus, o_orderpriority, o_custkey), '/')) >= 3 THEN string_split(concat_ws('/', o_orderstatus, o_orderpriority, o_custkey), '/')[2] ELSE '' END AS part"),
    "f10_prefix_label": _ORDERS.format("starts_with(o_orderpriority, '1')::INT AS label"),
    "f11_zero_if_null": _ORDERS.format("CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE 0 END AS value"),
    "f12_cast_before_division": _ORDERS.format("o_custkey::DOUBLE / (o_orderkey + 1) AS ratio"),
    "f13_abs": "SELECT c_custkey, abs(c_acctbal) AS size FROM customer",
    "f14_idf_log10": "SELECT p_partkey, round(log10(1000.0::DOUBLE / greatest(p_size - 1, 1)), 9) AS idf FROM part",
    "f15_idf_ln": "SELECT p_partkey, CASE WHEN p_size > 1 THEN round(ln(1000.0::DOUBLE / (p_size - 1)), 9) ELSE 0.0::DOUBLE END AS idf FROM part",
    "f16_sigmoid": "SELECT c_custkey, round(1 / (1 + exp(-c_acctbal / 1000)), 9) AS p FROM customer",
    "f17_log1p_exp": "SELECT c_custkey, round(ln(1 + exp(c_acctbal / 1000)), 9) AS loss FROM customer",
    "f18_logit": "SELECT p_partkey, CASE WHEN p_size BETWEEN 1 AND 49 THEN round(ln((p_size / 50) / (1 - p_size / 50)), 9) END AS logit FROM part",
    "f19_distance": "SELECT vec_id, round(sqrt(list_sum(list_transform(range(1, len(embedding) + 1), lambda i: (embedding[i]::DOUBLE - embedding[len(embedding) + 1 - i]::DOUBLE) ** 2))), 6) AS distance FROM embeddings",
    "f20_binomial_pmf": f"SELECT p_partkey, CASE WHEN k < 0 OR k > 45 THEN 0.0::DOUBLE ELSE round(exp(coalesce({_LOG_CHOOSE}, 0) + k * ln(0.4::DOUBLE) + (45 - k) * ln(1 - 0.4::DOUBLE)), 9) END AS p FROM (SELECT p_partkey, p_size - 2 AS k FROM part)",
    "f21_presence": "SELECT l_orderkey, l_linenumber, least(greatest(l_quantity::INT - 20, 0), 1) AS bit FROM lineitem",
    "f22_snippet": "SELECT doc_id, replace(substring(text, 1, 300), chr(10), ' ') AS snippet FROM documents",
    "f23_power": "SELECT p_partkey, round(sqrt(p_retailprice), 9) AS root, round(p_retailprice ** 2, 4) AS square FROM part",
    "f24_six_decimals": "SELECT c_custkey, printf('%.6f', c_acctbal) AS text FROM customer",
    "p3_month_is": "SELECT o_orderkey, o_custkey FROM orders WHERE month(o_orderdate) = 6",
    "p14_computed_column": "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem",
}
QUERIES = {name: _query(name) for name in SQL}
