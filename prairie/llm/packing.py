"""Packing along a space-filling curve.

Each document's token ids are hashed to a short vector, projected to a few dimensions and
given a Hilbert key. The documents are range-sorted by key; in that order their ids form one
stream, which is cut into sequences of ``LENGTH``. Neighbours on the curve share sequences,
and only the last sequence is not full.

Only keys and lengths are sorted. A document's place in the stream is a sum inside its range
partition plus the total of the partitions before, so no task sees more than one partition.

Defined results: a null text is an empty one, which is the end id alone; ties of the key
follow the number given to the row as it was written; repeated rows are packed each; null
ids and other columns do no harm; an empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prairie.llm import tokens
from prairie.llm.batches import add_columns, give_back
from prairie.llm.columns import quoted
from prairie.session import stored, table

LENGTH = 1024
END = 0
DIMENSIONS = 4
BITS = 12  # of the key, for each dimension
BUCKETS = 256  # of the hashed vectors
ROWS = 2048  # texts that are encoded at once, as Arrow holds them


def projection(vocabulary: int, dimensions: int = DIMENSIONS, buckets: int = BUCKETS) -> np.ndarray:
    """For each id, what it adds to the projected vector: its bucket's row, with its sign."""
    ids = np.arange(vocabulary, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = np.random.default_rng(7).normal(size=(buckets, dimensions)).astype(np.float32)
    sign = 1 - 2 * ((ids >> np.uint64(63)).astype(np.float32))
    return rows[((ids >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)] * sign[:, None]


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Key of each row of integer coordinates below ``2 ** bits``, along the Hilbert curve."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # turn each cell back, from the coarsest
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= np.where(high, q - 1, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> bit & 1)
    return key


def curve_keys(raw: list[bytes], width: int, table_: np.ndarray, bits: int = BITS) -> list[int]:
    """Hilbert keys of documents given as id bytes (none empty)."""
    keys: list[int] = []
    first = 0
    while first < len(raw):
        last, size = first, 0
        while last < len(raw) and (last == first or size < 1 << 20):
            size += len(raw[last])
            last += 1
        ids = tokens.numbers(b"".join(raw[first:last]), width)
        lengths = np.fromiter((len(r) // width for r in raw[first:last]), np.int64)
        starts = lengths.cumsum() - lengths
        sums = np.stack([np.add.reduceat(column[ids], starts) for column in table_.T], 1)
        unit = sums / np.maximum(np.linalg.norm(sums, axis=1, keepdims=True), 1e-9)
        keys += hilbert(np.minimum(((unit + 1) / 2 * (1 << bits)).astype(np.int64), (1 << bits) - 1), bits).tolist()
        first = last
    return keys


def encoded(docs: DataFrame, key: str, text: str, vocabulary: str, end: int, curve: bool = True) -> DataFrame:
    """``key``, ``width`` (bytes of an id), ``ids`` and the ``curve`` key of every row."""

    def begin():
        encoder = tokens.Encoder(vocabulary, end)
        width = int(encoder.dtype[2])
        table_ = projection(1 << 8 * width if width == 2 else encoder.size) if curve else None

        def make(batch: pa.RecordBatch) -> dict[str, list]:
            ids = encoder.encode_batch(batch.column("_text"))
            n_ids = pc.divide(pc.binary_length(ids).cast(pa.int64()), width)
            new = {"width": [width] * len(ids), "n_ids": n_ids, "ids": ids}
            return new | ({"curve": curve_keys(ids.to_numpy(zero_copy_only=False).tolist(), width, table_)} if curve else {})

        return make

    rows = docs.select(quoted(key).alias("_key"), quoted(text).alias("_text"))
    added = "width int, n_ids long, ids binary" + ", curve long" * curve
    return add_columns(rows, added, begin, drop=("_text",), most=ROWS).withColumnRenamed("_key", key)


def running(rows: DataFrame, value: str, *order: str) -> DataFrame:
    """``rows`` with ``before``: the sum of ``value`` over all rows before, in the given order.

    The order must be total. One number for each range partition comes to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            values = batch.column(value).to_numpy()
            sums = values.cumsum()
            new = [pa.array([part] * len(values), pa.int32()), pa.array(total + sums - values, pa.int64())]
            total += int(sums[-1]) if len(sums) else 0
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "_part", "_inside"])
        give_back()

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(ordered.mapInArrow(run, f"{fields}, _part int, _inside long"), "running")
    totals = placed.groupBy("_part").agg(F.sum(value).alias("n")).orderBy("_part").collect()
    before, bases = 0, {}
    for r in totals:
        bases[r["_part"]] = before
        before += r["n"]
    spark = rows.sparkSession
    base = spark.createDataFrame(list(bases.items()) or [(0, 0)], "_part int, _base long")
    # As many rows as range partitions.
    return placed.join(F.broadcast(base), "_part").withColumn("before", F.col("_inside") + F.col("_base")).drop("_part", "_inside", "_base")


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end: int = END, length: int = LENGTH) -> DataFrame:
    """Pieces of documents: ``key``, ``start``, ``length``, ``doc_tokens``, ``sequence_id``,
    ``offset`` and ``ids`` (little-endian unsigned 32-bit)."""
    made = encoded(docs, key, text, vocabulary or tokens.vocabulary(), end)
    rows = stored(made.withColumn("row", F.monotonically_increasing_id()), "packing")
    places = running(rows.select("row", "curve", "n_ids"), "n_ids", "curve", "row").select("row", "before")
    kind = rows.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, columns, parts = [], [[], [], [], [], []], []
            widths = batch.column("width").to_pylist()
            for i, (at, raw) in enumerate(zip(batch.column("before").to_pylist(), batch.column("ids").to_pylist())):
                ids = tokens.numbers(raw, widths[i]).astype("<u4")
                first = 0
                while first < len(ids):
                    offset = (at + first) % length
                    n = min(length - offset, len(ids) - first)
                    source.append(i)
                    for column, value in zip(columns, (first, n, len(ids), (at + first) // length, offset)):
                        column.append(value)
                    parts.append(ids[first : first + n].tobytes())
                    first += n
            keys = batch.column("_key").take(pa.array(source, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [keys, *(pa.array(c, pa.int64()) for c in columns), pa.array(parts, pa.binary())],
                ["_key", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )

    placed = rows.select("row", F.col(key).alias("_key"), "width", "ids").join(places, "row").drop("row")
    pieces = placed.mapInArrow(
        cut, f"_key {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
    )
    return pieces.withColumnRenamed("_key", key)


def sequences(pieces: DataFrame) -> DataFrame:
    """``sequence_id`` and ``ids`` (bytes) of whole sequences; one holds ``LENGTH`` ids at most."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id", F.aggregate("_parts", F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids")
    )


def _digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op4_packing(spark, sf_dir: str) -> DataFrame:
    return _digest(pack(table(spark, sf_dir, "documents")))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents; the last stage."""
    return _digest(pack(docs))


QUERIES = {"op4_packing": op4_packing}
SQL: dict[str, str] = {}
