"""Logistic regression, threshold evaluation, and the statistics of lines and mixtures."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prairie.functions.scalars import binomial_pmf
from prairie.session import forget, store, stored

ENTRIES = 1 << 18  # of a block of sparse rows
RANGE = 2048  # indices of which a gradient's sums travel together
BLOCK = ("labels", "sizes", "codes", "idx", "v")  # columns of a block
THRESHOLDS = tuple(round(0.05 * i, 2) for i in range(1, 20))


def packed(vectors: DataFrame) -> DataFrame:
    """Labelled sparse rows in blocks of about ``ENTRIES`` entries, one block a row, as plain arrays.

    ``vectors`` has ``label`` and ``entries``; rows without a label are left out. A block has
    ``labels`` (doubles), ``sizes`` (entries of each row, int32), ``codes`` (of each entry, two or four
    bytes), and, by code, ``idx`` (int32) and ``v`` (doubles) of its distinct entries: a word's
    small counts repeat, so most of what a round reads are the codes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = [[], [], [], []]

        def block() -> pa.RecordBatch:
            labels, sizes, idx, v = (np.concatenate(c) for c in held)
            for c in held:
                c.clear()
            order = np.lexsort((v, idx))
            idx, v = idx[order], v[order]
            new = np.ones(len(idx), bool)
            new[1:] = (idx[1:] != idx[:-1]) | (v[1:] != v[:-1])
            codes = np.empty(len(idx), "<u2" if new.sum() <= 1 << 16 else "<u4")
            codes[order] = new.cumsum() - 1
            made = (labels.astype("<f8"), sizes.astype("<i4"), codes, idx[new].astype("<i4"), v[new].astype("<f8"))
            return pa.RecordBatch.from_arrays([pa.array([c.tobytes()], pa.binary()) for c in made], list(BLOCK))

        for batch in batches:
            lists = batch.column("entries")
            inner = lists.flatten()
            parts = [batch.column("label"), pc.list_value_length(lists), inner.field("idx"), inner.field("v")]
            labels, sizes, idx, v = (c.to_numpy(zero_copy_only=False) for c in parts)
            ends = sizes.cumsum()
            first = 0
            while first < len(sizes):
                start = int(ends[first - 1]) if first else 0
                room = ENTRIES - sum(map(len, held[2]))
                last = max(int(np.searchsorted(ends, start + room, side="right")), first + (room >= ENTRIES))
                last = min(last, first + ENTRIES - sum(map(len, held[1])))  # rows without entries count too
                if last > first:
                    end = int(ends[last - 1])
                    for c, part in zip(held, (labels[first:last], sizes[first:last], idx[start:end], v[start:end])):
                        c.append(part)
                    first = last
                if first < len(sizes):
                    yield block()
        if held[0]:
            yield block()

    return vectors.where("label IS NOT NULL").select("label", "entries").mapInArrow(run, ", ".join(f"{c} binary" for c in BLOCK))


def gradient_parts(blocks: DataFrame, weights: np.ndarray) -> DataFrame:
    """``part`` and ``sums`` (doubles): sums of (p - y) v over all rows of :func:`packed` blocks.

    A part has the sums of ``RANGE`` indices, part -1 the number of rows and the sum of the loss.
    A task sends one row for each part it touches, and the parts are added up each by itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = np.append(weights, np.zeros(-len(weights) % RANGE))
        total, rows, loss = np.zeros(len(w)), 0, 0.0
        for batch in batches:
            for block in zip(*(batch.column(c) for c in BLOCK)):
                y, sizes, codes, idx, v = (np.frombuffer(b.as_buffer(), t) for b, t in zip(block, ("<f8", "<i4", "u1", "<i4", "<f8")))
                n = int(sizes.sum(dtype=np.int64))
                codes = codes.view(f"<u{len(codes) // max(n, 1) or 2}").astype(np.intp)
                z, some = np.zeros(len(y)), sizes > 0
                if n:
                    z[some] = np.add.reduceat((w[idx] * v)[codes], (sizes.cumsum(dtype=np.int64) - sizes)[some])
                loss += float((np.logaddexp(0, z) - y * z).sum())
                rows += len(y)
                each = np.bincount(codes, np.repeat(0.5 * (1 + np.tanh(z / 2)) - y, sizes), len(idx))
                total += np.bincount(idx, each * v, len(w))
        parts = total.reshape(-1, RANGE)
        some = np.flatnonzero(parts.any(1))
        sums = [np.array([rows, loss]).tobytes(), *(parts[i].tobytes() for i in some)]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *some.tolist()], pa.int32()), pa.array(sums, pa.binary())], ["part", "sums"])

    def add(parts: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, "<f8") for b in parts["sums"].to_pylist())
        return pa.table({"part": parts["part"].slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    return blocks.mapInArrow(run, "part int, sums binary").groupBy("part").applyInArrow(add, "part int, sums binary")


def _gathered(parts: DataFrame, size: int) -> tuple[np.ndarray, float, float]:
    """Sums, number of rows and loss; ``size`` numbers come to the driver."""
    g, n, loss = np.zeros(size + RANGE), 0.0, 0.0
    for part, sums in parts.collect():
        values = np.frombuffer(sums, "<f8")
        if part < 0:
            n, loss = values
        else:
            g[part * RANGE : part * RANGE + len(values)] = values
    return g[:size], float(n), float(loss)


def gradient(vectors: DataFrame, weights: np.ndarray) -> DataFrame:
    """``idx``, ``total``: sums of (p - y) v over all rows; ``idx`` -1 has the sum of the loss, -2 the rows."""
    g, n, loss = _gathered(gradient_parts(packed(vectors), weights), len(weights))
    at = np.flatnonzero(g)
    return vectors.sparkSession.createDataFrame([(-2, n), (-1, loss), *zip(at.tolist(), g[at].tolist())], "idx long, total double")


def train_logistic(vectors: DataFrame, size: int, rounds: int = 200, rate: float = 0.003, penalty: float = 0.01, tolerance: float = 1e-4) -> np.ndarray:
    """Weights by gradient descent from zero, without intercept; rows without a label are left out.

    Loss: mean of ln(1 + exp z) - y z, plus half the penalty times the squared weights. From the
    second round on the rate grows by a twentieth if the loss fell and is halved if not; a
    worse step is not undone; training ends when the loss changes by less than ``tolerance``,
    before the weights are changed again. The rows are packed once, and each round reads the blocks.
    """
    blocks, path = store(packed(vectors), "blocks")
    w, last = np.zeros(size), None
    for _ in range(rounds):
        g, n, loss = _gathered(gradient_parts(blocks, w), size)
        loss = loss / max(n, 1) + 0.5 * penalty * float(w @ w)
        if last is not None:
            rate *= 1.05 if loss < last else 0.5
            if abs(last - loss) < tolerance:
                break
        last = loss
        w = w - rate * (g / max(n, 1) + penalty * w)
    forget(vectors.sparkSession, path)
    return w


def weight_table(spark, weights: np.ndarray) -> DataFrame:
    return spark.createDataFrame(pa.table({"idx": np.arange(len(weights)), "w": weights}).to_pandas(), "idx long, w double")


def scored(vectors: DataFrame, key: str, weights: DataFrame) -> DataFrame:
    """``key``, ``z``, ``p``: the weighted sum of each row's entries; rows without any have 0.

    The weights have as many rows as the vocabulary.
    """
    each = vectors.select(key, F.explode("entries").alias("e")).select(key, F.col("e.idx").alias("idx"), F.col("e.v").alias("v"))
    sums = each.join(F.broadcast(weights), "idx").groupBy(key).agg(F.sum(F.col("v") * F.col("w")).alias("z"))
    z = F.coalesce("z", F.lit(0.0))
    small = F.exp(-F.abs(z))
    return vectors.select(key, "label").join(sums, key, "left").select(
        key, "label", z.alias("z"), F.when(z >= 0, 1 / (1 + small)).otherwise(small / (1 + small)).alias("p")
    )


def confusion(rows: DataFrame, label: str = "label", p: str = "p", thresholds=THRESHOLDS) -> DataFrame:
    """``threshold``, ``tp``, ``fp``, ``tn``, ``fn``, where p >= threshold says 1.

    A score becomes the number of thresholds it reaches; the counts of (label, number) are
    few, and only they meet the thresholds.
    """
    spark = rows.sparkSession
    levels = F.array(*map(F.lit, thresholds))
    reached = F.size(F.filter(levels, lambda t: F.col(p) >= t))
    counts = rows.groupBy(F.col(label).alias("y"), reached.alias("reached")).agg(F.count("*").alias("n"))
    each = spark.createDataFrame([(t, i + 1) for i, t in enumerate(thresholds)], "threshold double, place int")
    both = counts.crossJoin(F.broadcast(each))  # thresholds times at most two rows for each
    n = lambda y, yes: F.sum(F.when((F.col("y") == y) & ((F.col("reached") >= F.col("place")) == yes), F.col("n")).otherwise(0))
    return both.groupBy("threshold").agg(n(1, True).alias("tp"), n(0, True).alias("fp"), n(0, False).alias("tn"), n(1, False).alias("fn"))


def rates(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and accuracy; 0 where a denominator is 0."""
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    made = counts.withColumn("precision", ratio(tp, tp + fp)).withColumn("recall", ratio(tp, tp + fn))
    pr, re = F.col("precision"), F.col("recall")
    return made.withColumn("f1", ratio(2 * pr * re, pr + re)).withColumn("accuracy", ratio(tp + tn, tp + fp + tn + fn))


def best_threshold(counts: DataFrame) -> DataFrame:
    """The threshold with the largest F1, the smallest of them on a tie."""
    return rates(counts).orderBy(F.desc("f1"), "threshold").limit(1)


def line_moments(df: DataFrame, x: str, y: str, by: list[str] | None = None) -> DataFrame:
    """n, sums of x, y, xx, xy, yy, in one pass; as decimals, so that the order does not matter.

    Rows in which x or y is null, NaN, infinite or 1e14 or more in size are left out, also of n.
    """
    a, b = F.col(x).try_cast("decimal(18,4)"), F.col(y).try_cast("decimal(18,4)")
    df = df.where(a.isNotNull() & b.isNotNull())
    sums = {"sx": a, "sy": b, "sxx": a * a, "sxy": a * b, "syy": b * b}
    return df.groupBy(*(by or [])).agg(F.count("*").alias("n"), *(F.sum(e).cast("double").alias(k) for k, e in sums.items()))


def squared_error(m: float, c: float) -> Column:
    """Sum of (c + m x - y)^2 from the moments."""
    col = F.col
    return c * c * col("n") + m * m * col("sxx") + col("syy") + 2 * c * m * col("sx") - 2 * c * col("sy") - 2 * m * col("sxy")


def line_mse(df: DataFrame, x: str, y: str, m: float, c: float) -> DataFrame:
    gap = F.lit(c) + m * F.col(x) - F.col(y)
    return df.agg(F.avg(gap * gap).alias("mse"))


def line_conditionals(
    moments: DataFrame, m: float, c: float, sigma: float, mean_m=5.0, dev_m=10.0, mean_c=50.0, dev_c=100.0, alpha=10.0, beta=1.0
) -> DataFrame:
    """Conditional distributions of a line's noise (inverse gamma), intercept and slope (normal)."""
    s2 = sigma * sigma
    var_c = 1 / (1 / dev_c**2 + F.col("n") / s2)
    var_m = 1 / (1 / dev_m**2 + F.col("sxx") / s2)
    return (
        moments.withColumn("shape", alpha + F.col("n") / 2)
        .withColumn("scale", beta + squared_error(m, c) / 2)
        .withColumn("c_mean", var_c * (mean_c / dev_c**2 + (F.col("sy") - m * F.col("sx")) / s2))
        .withColumn("c_var", var_c)
        .withColumn("m_mean", var_m * (mean_m / dev_m**2 + (F.col("sxy") - c * F.col("sx")) / s2))
        .withColumn("m_var", var_m)
    )


def mixture_sums(histogram: DataFrame, a: float, b: float) -> DataFrame:
    """Responsibility-weighted heads and flips of two coins over a (heads, flips, n) histogram."""
    la, lb = binomial_pmf("heads", F.col("flips"), a), binomial_pmf("heads", F.col("flips"), b)
    rows = histogram.withColumn("_a", la).withColumn("_b", lb)
    total = F.when(F.col("_a") + F.col("_b") == 0, 1e-12).otherwise(F.col("_a") + F.col("_b"))
    rows = rows.withColumn("_wa", F.col("_a") / total * F.col("n")).withColumn("_wb", F.col("_b") / total * F.col("n"))
    return rows.agg(*(F.sum(F.col(w) * F.col(x)).alias(f"{x}_{k}") for k, w in (("a", "_wa"), ("b", "_wb")) for x in ("heads", "flips")))


def binomial_em(trials: DataFrame, heads: str, flips: str, a: float = 0.79, b: float = 0.51, rounds: int = 20) -> list[tuple[float, float]]:
    """The two coins' probabilities after each round, equal weights; each round reads the histogram only."""
    histogram = stored(trials.groupBy(F.col(heads).alias("heads"), F.col(flips).alias("flips")).agg(F.count("*").alias("n")), "histogram")
    out = []
    for _ in range(rounds):
        r = mixture_sums(histogram, a, b).first()
        a, b = (h / f if f else p for h, f, p in ((r.heads_a, r.flips_a, a), (r.heads_b, r.flips_b, b)))
        out.append((a, b))
    return out
