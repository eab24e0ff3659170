"""Line sources, cleaning, roll-ups and sinks, over lines made from whole tables.

The lines of ``lineitem`` get broken rows added: headers, short lines and bad amounts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prairie.operators import ranking
from prairie.sources import lines as src
from prairie.sources import sinks
from prairie.session import fresh_path
from prairie.session import table as T

FIELDS = {"head": 0, "licence": 1, "stamp": 3, "total": 10}
HEADER = "medallion,hack_license,x,pickup_datetime,4,5,6,7,8,9,total_amount"


def taxi_lines(spark, d) -> DataFrame:
    """A line of eleven fields for each row of lineitem, and broken lines beside some of them."""
    rows = T(spark, d, "lineitem")
    text = lambda c: F.col(c).cast("string")
    good = F.concat_ws(
        ",", F.lit("m"), text("l_suppkey"), F.lit(""), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), text("l_orderkey"),
        text("l_partkey"), F.lit(""), F.lit(""), F.lit(""), F.lit(""), F.format_string("%.2f", "l_extendedprice"),
    )
    cents = F.col("l_linenumber")
    bad = (
        F.when(cents == 1, F.lit(HEADER))
        .when(cents == 2, F.lit("a,b,c"))
        .when(cents == 3, F.lit("m,9,,2000-01-01 00:00:00,,,,,,,abc"))
        .when(cents == 4, F.lit("m,9,,2000,,,,,,,1.0"))
        .when(cents == 5, F.lit(""))
        .otherwise(F.lit("m,,,2000-01-01 00:00:00,,,,,,,1.0"))
    )
    return rows.select(F.explode(F.array(good, bad)).alias("value"))


_SQL_LINES = """(SELECT unnest([concat_ws(',', 'm', l_suppkey, '', strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), l_orderkey, l_partkey, '', '', '', '', printf('%.2f', l_extendedprice)),
  CASE l_linenumber WHEN 1 THEN 'medallion,hack_license,x,pickup_datetime,4,5,6,7,8,9,total_amount' WHEN 2 THEN 'a,b,c' WHEN 3 THEN 'm,9,,2000-01-01 00:00:00,,,,,,,abc'
  WHEN 4 THEN 'm,9,,2000,,,,,,,1.0' WHEN 5 THEN '' ELSE 'm,,,2000-01-01 00:00:00,,,,,,,1.0' END]) AS value FROM lineitem)"""
_SQL_SCAN = f"(SELECT f[1] AS head, f[2] AS licence, f[4] AS stamp, f[11] AS total FROM (SELECT string_split(value, ',') AS f FROM {_SQL_LINES} WHERE value <> '') WHERE len(f) >= 11)"
_SQL_BODY = f"(SELECT * FROM {_SQL_SCAN} WHERE lower(head) <> 'medallion' AND lower(licence) <> 'hack_license' AND lower(total) <> 'total_amount')"
_SQL_CLEAN = f"(SELECT licence AS key, stamp[1:10] AS day, try_cast(total AS DOUBLE) AS amount FROM {_SQL_BODY} WHERE licence <> '' AND length(stamp) >= 10 AND try_cast(total AS DOUBLE) IS NOT NULL)"


HEADS = {"head": "medallion", "licence": "hack_license", "total": "total_amount"}


def clean_of(lines: DataFrame) -> DataFrame:
    """The whole chain from lines to clean rows: fields, headers, dirty rows."""
    return src.drop_dirty(src.drop_headers(src.scan_delimited(lines, FIELDS), HEADS), "licence", "stamp", "total")


def revenue_of(lines: DataFrame) -> DataFrame:
    return clean_of(lines).groupBy("day").agg(cents("amount").alias("revenue"))


def scanned(spark, d):
    return src.scan_delimited(taxi_lines(spark, d), FIELDS)


def without_headers(spark, d):
    return src.drop_headers(scanned(spark, d), HEADS)


def clean(spark, d):
    return clean_of(taxi_lines(spark, d))


def cents(column):
    """Sum in cents; amounts of 1e16 or more, infinite ones and NaN are not counted in."""
    return F.sum(F.col(column).try_cast("decimal(18,2)")).cast("double")


def revenue_by_date(spark, d):
    return revenue_of(taxi_lines(spark, d))


def revenue_by_driver(spark, d):
    return clean(spark, d).groupBy("key").agg(cents("amount").alias("revenue"))


def top_drivers(spark, d):
    return ranking.ranked(revenue_by_driver(spark, d), 10, "revenue", "key")


def month_of(spark, d):
    return src.starting_with(clean(spark, d), "day", " 1997-06 ")


def top_revenue(spark, d):
    """The ten customers with the largest sum of orders, with their names."""
    sums = T(spark, d, "orders").groupBy("o_custkey").agg(cents("o_totalprice").alias("revenue"))
    best = ranking.ranked(sums, 10, "revenue", "o_custkey")
    c = T(spark, d, "customer")
    return F.broadcast(best).join(c, best.o_custkey == c.c_custkey).select("rank", "o_custkey", "c_name", "revenue")


def key_values(spark, d):
    """Revenue per driver as lines, read again; every third line has blanks for the tab."""
    rows = sinks.key_value_lines(revenue_by_driver(spark, d), "key", "revenue")
    third = F.crc32(F.col("value").cast("binary")) % 3 == 0
    return src.scan_key_value(rows.select(F.when(third, F.translate("value", "\t", " ")).otherwise(F.col("value")).alias("value")))


def driver_lines(spark, d):
    rows = revenue_by_driver(spark, d).select("key", F.format_string("%.2f", "revenue").alias("revenue"))
    return sinks.key_value_lines(rows, "key", "revenue")


def ranked_lines(spark, d):
    top = top_drivers(spark, d).select("rank", "key", F.format_string("%.2f", "revenue").alias("revenue"))
    return sinks.ranked_lines(top, "key", "revenue")


def from_folder(spark, d):
    """Revenue per date of lines that lie in the files of a folder, each place of a line counted."""
    path = fresh_path(spark, "lines")
    taxi_lines(spark, d).repartition(6).write.text(path)
    return clean_of(src.read_lines(spark, path)).groupBy("day").agg(F.count("*").alias("lines"), cents("amount").alias("revenue"))


def from_part_files(spark, d):
    """The second job of the roll-up: part files of key, tab, value, read as one relation for the best ten."""
    path = fresh_path(spark, "revenue")
    rows = revenue_by_driver(spark, d).select("key", F.format_string("%.2f", "revenue").alias("revenue"))
    sinks.write_key_value(rows, path, "key", "revenue", parts=5)
    return ranking.ranked(sinks.read_key_value(spark, path), 10, "amount", "key")


def from_ranked_file(spark, d):
    path = fresh_path(spark, "ranked")
    top = top_drivers(spark, d).select("rank", "key", F.format_string("%.2f", "revenue").alias("revenue"))
    sinks.write_ranked(top, path, "key", "revenue")
    return sinks.read_ranked(spark, path)


def replaced(spark, d):
    """Orders as a table with a partition for each status, of which one is written anew."""
    path = fresh_path(spark, "orders")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = T(spark, d, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    sinks.save_table(rows, name, path, ("o_orderstatus",))
    dearer = rows.where("o_orderstatus = 'F'").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    table = sinks.replace_partitions(dearer, name)
    return table.groupBy("o_orderstatus").agg(F.count("*").alias("n"), cents("o_totalprice").alias("total"))


def tagged_lines(spark, d) -> DataFrame:
    """A line for each document; each seventh has no tag."""
    text = F.translate("text", "\n\r", "  ")
    tag = F.concat(F.lit('<doc id="'), F.concat_ws("/", F.col("source"), F.col("lang"), F.col("doc_id")), F.lit('" url="u">'), text, F.lit("</doc>"))
    return T(spark, d, "documents").select(F.when(F.col("doc_id") % 7 == 0, text).otherwise(tag).alias("value"))


_SQL_TAGGED = "(SELECT CASE WHEN doc_id % 7 = 0 THEN t ELSE '<doc id=\"' || source || '/' || lang || '/' || doc_id || '\" url=\"u\">' || t || '</doc>' END AS value FROM (SELECT *, translate(text, chr(10) || chr(13), '  ') AS t FROM documents))"


def numeric_lines(spark, d) -> DataFrame:
    """Orders as lines of customer, price and day number, placed by the order's key."""
    return T(spark, d, "orders").select(
        F.concat(F.lit("  "), F.col("o_custkey").cast("string"), F.lit("\t"), F.format_string("%.2f", "o_totalprice"), F.lit("  "), F.dayofyear("o_orderdate").cast("string")).alias("value"),
        F.col("o_orderkey").alias("place"),
    )


def query_lines(spark, d) -> DataFrame:
    """Benchmark items as query lines, with blank and foreign lines between them."""
    items = T(spark, d, "benchmark")
    line = F.concat(F.lit("predict_label ("), (F.col("item_id") % 9 + 1).cast("string"), F.lit(", '"), F.translate("text", "\n", " "), F.lit("')"))
    other = F.when(F.col("item_id") % 2 == 0, F.lit("")).otherwise(F.lit("print 'x'"))
    return items.select(F.explode(F.array(line, other)).alias("value"))


ORDERS = "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"

QUERIES = {
    "s1_scan_delimited": scanned,
    "s2_drop_headers": without_headers,
    "s3_tagged_by_position": lambda s, d: src.scan_tagged(tagged_lines(s, d), "position"),
    "s4_tagged_by_regex": lambda s, d: src.scan_tagged(tagged_lines(s, d)),
    "s5_numeric_last_wins": lambda s, d: src.scan_numeric(numeric_lines(s, d), ["id", "x", "y"]),
    "s6_typed_table_keys": lambda s, d: src.repeated_keys(src.load_table(s, f"{d}/lineitem.parquet", "l_orderkey LONG, l_linenumber INT"), "l_orderkey", "l_linenumber"),
    "s6_typed_table": lambda s, d: src.load_table(s, f"{d}/orders.parquet", ORDERS),
    "s7_key_value": key_values,
    "s9_query_list": lambda s, d: src.scan_queries(query_lines(s, d)),
    "p8_month_prefix": month_of,
    "p9_drop_dirty": clean,
    "p10_lines_with": lambda s, d: tagged_lines(s, d).where(F.contains(F.col("value"), F.lit("id"))).select(F.md5(F.col("value")).alias("md5")),
    "p11_point_lookup": lambda s, d: T(s, d, "documents").where("doc_id = 42").select("doc_id", "lang", "source"),
    "g6_revenue_by_date": revenue_by_date,
    "g7_revenue_by_driver": revenue_by_driver,
    "o2_top_revenue": top_revenue,
    "w2_ranked_drivers": top_drivers,
    "k1_key_value_lines": driver_lines,
    "k3_ranked_lines": ranked_lines,
    "s8_folder_of_files": from_folder,
    "k1_s8_part_files": from_part_files,
    "k2_replaced_partition": replaced,
    "k3_ranked_file": from_ranked_file,
}
_SQL_REVENUE = f"(SELECT key, try_cast(printf('%.2f', sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE) AS DOUBLE) AS amount FROM {_SQL_CLEAN} GROUP BY 1)"
_SQL_BEST = f"SELECT row_number() OVER (ORDER BY amount DESC, key) AS rank, key, amount FROM {_SQL_REVENUE} ORDER BY 1 LIMIT 10"
SQL = {
    "s8_folder_of_files": f"SELECT day, count(*) AS lines, sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE AS revenue FROM {_SQL_CLEAN} GROUP BY 1",
    "k1_s8_part_files": _SQL_BEST,
    "k3_ranked_file": _SQL_BEST,
    "k2_replaced_partition": "SELECT o_orderstatus, count(*) AS n, sum(CASE WHEN o_orderstatus = 'F' THEN (o_totalprice * 2)::DECIMAL(18,2) ELSE o_totalprice::DECIMAL(18,2) END)::DOUBLE AS total FROM orders GROUP BY 1",
    "s1_scan_delimited": f"SELECT * FROM {_SQL_SCAN}",
    "s2_drop_headers": f"SELECT * FROM {_SQL_BODY}",
    "s3_tagged_by_position": f"SELECT substring(value, instr(value, 'id=\"') + 4, instr(value, '\" url=') - instr(value, 'id=\"') - 4) AS id, substring(value, instr(value, '\">') + 2) AS text FROM {_SQL_TAGGED} WHERE instr(value, 'id=\"') > 0 AND instr(value, '\" url=') >= instr(value, 'id=\"') + 4 AND instr(value, '\">') > 0",
    "s4_tagged_by_regex": f"SELECT regexp_extract(value, '<doc id=\"([^\"]*)\"', 1) AS id, regexp_extract(value, '>(.*)</doc>', 1) AS text FROM {_SQL_TAGGED}",
    "s5_numeric_last_wins": "SELECT o_custkey AS id, arg_max(round(o_totalprice, 2), o_orderkey) AS x, arg_max(dayofyear(o_orderdate), o_orderkey)::DOUBLE AS y FROM orders GROUP BY 1",
    "s6_typed_table_keys": "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "s6_typed_table": "SELECT * FROM orders",
    "s7_key_value": f"SELECT key, sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE AS amount FROM {_SQL_CLEAN} GROUP BY 1",
    "s9_query_list": "SELECT (item_id % 9 + 1)::INT AS k, replace(text, chr(10), ' ') AS query FROM benchmark",
    "p8_month_prefix": f"SELECT * FROM {_SQL_CLEAN} WHERE starts_with(day, '1997-06')",
    "p9_drop_dirty": f"SELECT * FROM {_SQL_CLEAN}",
    "p10_lines_with": f"SELECT md5(value) AS md5 FROM {_SQL_TAGGED} WHERE contains(value, 'id')",
    "p11_point_lookup": "SELECT doc_id, lang, source FROM documents WHERE doc_id = 42",
    "g6_revenue_by_date": f"SELECT day, sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE AS revenue FROM {_SQL_CLEAN} GROUP BY 1",
    "g7_revenue_by_driver": f"SELECT key, sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE AS revenue FROM {_SQL_CLEAN} GROUP BY 1",
    "o2_top_revenue": "WITH s AS (SELECT o_custkey, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS revenue FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10) SELECT row_number() OVER (ORDER BY revenue DESC, o_custkey) AS rank, o_custkey, c_name, revenue FROM s JOIN customer ON c_custkey = o_custkey",
    "w2_ranked_drivers": f"WITH s AS (SELECT key, sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE AS revenue FROM {_SQL_CLEAN} GROUP BY 1) SELECT key, revenue, row_number() OVER (ORDER BY revenue DESC, key) AS rank FROM s ORDER BY rank LIMIT 10",
    "k1_key_value_lines": f"SELECT key || chr(9) || printf('%.2f', sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE) AS value FROM {_SQL_CLEAN} GROUP BY key",
    "k3_ranked_lines": f"WITH s AS (SELECT key, sum(try_cast(amount AS DECIMAL(18,2)))::DOUBLE AS revenue FROM {_SQL_CLEAN} GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY revenue DESC, key) AS rank FROM s) SELECT rank || chr(9) || key || chr(9) || printf('%.2f', revenue) AS value FROM r WHERE rank <= 10",
}
