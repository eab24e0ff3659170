"""Products of a sparse table with itself: items that occur together, and Gram matrices.

Only what shares a row meets. Work is cut into blocks, so that a heavy basket or a dense row is
dealt over many tasks; the number of tasks follows the number of rows and of products, which
bounds the memory of each. Sums are made where the products are before they are shuffled.

Defined results: rows with a null key or item are left out; baskets are sets; entries of the same place
are added; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prairie.session import stored

BASKET = 256  # items of a basket that meet in one row
PAIRS = 1 << 20  # of a task, about
ENTRIES = 1 << 19  # rows of a task that makes the sets
ROWS = 1024  # times COLUMNS: products of a task of a Gram matrix, about
COLUMNS = 512  # entries of a row that meet in one piece


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """``rows`` by their key, about ``ENTRIES`` to a task, however many there are in all."""
    return rows.repartition(max(1, -(-rows.count() // ENTRIES)), key)


def _met(sets: DataFrame, key: str, item: Column, spread: Column, size: int, products: int) -> DataFrame:
    """``left``, ``right`` and ``same``: lists of items of one ``key`` that meet, about ``size`` each at most.

    ``sets`` is dealt by ``key``. ``spread`` deals the items of a larger key into blocks; each pair of its
    blocks is one row. The rows are dealt out so that a task has about ``products`` products.
    """
    n = F.count("*").over(Window.partitionBy(key))
    sized = stored(sets.select(key, item.alias("item"), spread.alias("spread"), n.alias("n")), "sets")
    total = sized.agg(F.coalesce(F.sum((F.col("n") + 1) / 2), F.lit(0.0))).first()[0]
    blocks = F.ceil(F.col("n") / size).cast("int")
    placed = sized.withColumn("mine", F.pmod("spread", blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    sides = placed.select(key, low.alias("p"), high.alias("q"), "mine", "item").repartition(max(1, int(-(-total // products))), key, "p", "q")
    lists = sides.groupBy(key, "p", "q").agg(*(F.collect_list(F.when(F.col("mine") == F.col(side), F.col("item"))).alias(name) for side, name in (("p", "left"), ("q", "right"))))
    return lists.select("left", "right", (F.col("p") == F.col("q")).alias("same"))


def basket_blocks(baskets: DataFrame, key: str, item: str, size: int = BASKET) -> DataFrame:
    """``left`` and ``right``: lists of items that meet, at most about ``size`` each.

    A basket of up to ``size`` items is one row, with the same list on both sides. A larger one
    is cut into blocks by a hash of the item, and each pair of its blocks is one row.
    """
    sets = baskets.select(F.col(key).alias("key"), F.col(item).alias("item")).where("key IS NOT NULL AND item IS NOT NULL")
    return _met(_dealt(sets, "key").distinct(), "key", F.col("item"), F.xxhash64("item"), size, PAIRS)


def co_occurrence(baskets: DataFrame, key: str, item: str, symmetric: bool = False, size: int = BASKET) -> DataFrame:
    """``a``, ``b``, ``n``: baskets that hold both items, a <= b; the diagonal counts the item's baskets.

    With ``symmetric`` each pair stands in both orders.
    """
    met = basket_blocks(baskets, key, item, size)
    pairs = met.select("right", "same", F.explode("left").alias("x")).select("same", "x", F.explode("right").alias("y")).where("NOT same OR x <= y")
    counts = pairs.groupBy(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).agg(F.count("*").alias("n"))
    return counts.union(counts.where("a < b").select(F.col("b").alias("a"), F.col("a").alias("b"), "n")) if symmetric else counts


def gram(entries: DataFrame, row: str, column: str, value: str, rows: int = ROWS, columns: int = COLUMNS) -> DataFrame:
    """``a``, ``b``, ``v``: the product of the transposed matrix with itself, a <= b, zeros left out.

    Only entries that share a row meet, so the work is the sum of the rows' squared lengths, however
    many columns there are. A row of more than ``columns`` entries is cut, and each pair of its cuts
    is work of its own. A task has about ``rows * columns`` products, which it adds up by place.
    """
    own = entries.select(F.col(row).alias("r"), F.col(column).cast("long").alias("c"), F.col(value).cast("double").alias("v"))
    own = _dealt(own.where("r IS NOT NULL AND c IS NOT NULL AND v IS NOT NULL"), "r").groupBy("r", "c").agg(F.sum("v").alias("v"))
    met = _met(own, "r", F.struct("c", "v"), F.xxhash64("c"), columns, rows * columns)
    pairs = met.select("right", "same", F.explode("left").alias("x")).select("same", "x", F.explode("right").alias("y")).where("NOT same OR x.c <= y.c")
    places = pairs.select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b"), (F.col("x.v") * F.col("y.v")).alias("v"))
    return places.groupBy("a", "b").agg(F.sum("v").alias("v")).where("v <> 0")
