"""Graph loops over edge tables; each round is written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prairie.operators.relational import with_scalar
from prairie.session import forget, fresh_path, store


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of all nodes with an edge.

    Alternating large-star and small-star steps, which need a logarithm of the number of
    nodes as rounds, whatever the length of paths.
    """
    spark = edges.sparkSession
    own = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u IS NOT NULL AND v IS NOT NULL")
    ends = own.select("u").union(own.select("v")).distinct().withColumnRenamed("u", "node")
    nodes, nodes_path = store(ends, "nodes")
    now, path = store(own.where("u <> v").distinct(), "edges")
    seen = None
    while True:
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least)
        new, new_path = store(small.where("u <> v").distinct(), "edges")
        mark = new.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        forget(spark, path)
        now, path = new, new_path
        if mark == seen:
            break
        seen = mark
    roots = now.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def symmetric(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Each edge in both directions, without repeats."""
    return edges.select(src, dst).union(edges.select(dst, src)).distinct()


def out_degrees(edges: DataFrame, src: str = "src") -> DataFrame:
    return edges.groupBy(src).agg(F.count("*").alias("degree"))


def expand(edges: DataFrame, frontier: DataFrame, node: str = "node", src: str = "src", dst: str = "dst") -> DataFrame:
    """Nodes one edge away from the frontier that are not in it."""
    seen = frontier.select(F.col(node).alias(dst))
    from_here = edges.join(frontier.select(F.col(node).alias(src)), src, "left_semi")
    return from_here.select(dst).distinct().join(seen, dst, "left_anti").select(F.col(dst).alias(node))


def rank_step(ranks: DataFrame, edges: DataFrame, n: int, damping: float) -> DataFrame:
    """``node``, ``degree``, ``old``, ``rank`` after one round; ranks of nodes without out-edges go to all.

    ``ranks`` has ``node``, ``degree`` (null: no out-edge), ``rank``. Edges from and to other
    nodes give nothing and deliver nothing.
    """
    given = ranks.where("degree IS NOT NULL").select(F.col("node").alias("src"), (F.col("rank") / F.col("degree")).alias("part"))
    got = edges.join(given, "src").groupBy(F.col("dst").alias("node")).agg(F.sum("part").alias("got"))
    sinks = ranks.where("degree IS NULL").agg(F.coalesce(F.sum("rank"), F.lit(0.0)).alias("lost"))
    new = with_scalar(ranks.join(got, "node", "left"), sinks)
    rank = (1 - damping) / n + damping * (F.coalesce("got", F.lit(0.0)) + F.col("lost") / n)
    return new.select("node", "degree", F.col("rank").alias("old"), rank.alias("rank"))


def change(ranks: DataFrame) -> float:
    """L1 distance of the last two rounds."""
    return ranks.agg(F.coalesce(F.sum(F.abs(F.col("rank") - F.col("old"))), F.lit(0.0))).first()[0]


def start_ranks(nodes: DataFrame, edges: DataFrame, n: int) -> DataFrame:
    """Equal ranks, with the out-degree of each node, computed once."""
    degrees = out_degrees(edges).withColumnRenamed("src", "node")
    return nodes.join(degrees, "node", "left").select("node", "degree", F.lit(1.0 / n if n else 0.0).alias("rank"))


def laid_out(edges: DataFrame, src: str = "src", dst: str = "dst", buckets: int | None = None) -> DataFrame:
    """The edges as a table bucketed by their source, which a join on it reads where they lie.

    It stays in the shared folder until the application ends; there are as many buckets as
    shuffle partitions, so that the other side of such a join is dealt out alike.
    """
    spark = edges.sparkSession
    path = fresh_path(spark, "edges")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    rows = edges.select(F.col(src).alias("src"), F.col(dst).alias("dst")).where("src IS NOT NULL")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # One file for each bucket: the rows are dealt out as the buckets are.
    rows.repartition(n, "src").write.bucketBy(n, "src").sortBy("src").option("path", path).saveAsTable(name)
    return spark.table(name)


def pagerank(nodes: DataFrame, edges: DataFrame, damping: float = 0.85, tolerance: float | None = 0.01, rounds: int | None = None) -> DataFrame:
    """``node`` and ``rank``; rounds go on until the ranks change by ``tolerance`` at most in sum.

    ``rounds`` is the largest number of rounds; with ``tolerance`` None it is their number. The
    edges are computed and dealt out once; a round shuffles ranks and what they give.
    """
    spark = nodes.sparkSession
    n = nodes.count()
    fixed = laid_out(edges)
    now, path = store(start_ranks(nodes, fixed, n), "ranks")
    done = 0
    while n and (rounds is None or done < rounds):
        new, new_path = store(rank_step(now, fixed, n, damping), "ranks")
        forget(spark, path)
        now, path, done = new, new_path, done + 1
        if tolerance is not None and change(now) <= tolerance:
            break
    return now.select("node", "rank")


def all_components(nodes: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node``, ``root`` and ``listed`` of every node, of ``nodes`` or of an edge.

    Nodes without edges are components of their own. Nodes that only edges have connect others and
    count as members (``listed`` is false for them); one of them may be the root.
    """
    found = components(edges, src, dst)
    own = nodes.select("node").where("node IS NOT NULL").distinct().withColumn("_own", F.lit(True))
    both = own.join(found, "node", "full")
    return both.select("node", F.coalesce("root", "node").alias("root"), F.coalesce("_own", F.lit(False)).alias("listed"))


def components_between(found: DataFrame, low: int, high: int) -> DataFrame:
    """The listed nodes of components of ``low`` to ``high`` nodes, with the size, which counts all members."""
    sizes = found.groupBy("root").agg(F.count("*").alias("size")).where(F.col("size").between(low, high))
    return found.where("listed").drop("listed").join(sizes, "root")
