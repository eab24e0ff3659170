"""Token ids in files of blocks, with a byte-aligned variable-length code.

Ids are replaced by their rank of frequency, so that the 256 most frequent take one byte.
A block holds consecutive documents: a header, the document ids and lengths, the control
bytes (two bits for the length of each of four numbers) and, apart from them, the data
bytes. Decoding looks the lengths up in a table of the 256 control bytes.

The files are range partitions in ascending order of the document id: Parquet, written by
Spark's committer so that lost tasks leave nothing behind, with one row for each block
(``shard``, ``block``, ``n_ids``, ``payload``). Beside them lies the table of ranks.

Defined results: a null text is an empty one, which is the end id alone; null ids come
first; rows with the same id are documents of their own, in the order of length, then ids;
other columns do no harm; an empty table gives empty files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prairie.llm import tokens
from prairie.llm.packing import encoded
from prairie.session import forget, fresh_path, store, table

END = 2
BLOCK_IDS = 1 << 17
MAGIC = b"PRT1"
_HEADER = struct.Struct("<4sIqQQ")  # magic, documents, ids before in the shard, ids, data bytes
#: Bytes of each of the four numbers that a control byte describes.
LENGTHS = np.array([[(c >> 2 * i & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit numbers."""
    values = values.astype("<u4")
    width = 2 if values.max(initial=0) <= 0xFFFF else 4  # bytes that are looked at
    kept = np.ones((len(values), width), bool)
    for i in range(1, width):
        kept[:, i] = values >= 1 << 8 * i
    extra = kept.sum(1, dtype=np.uint8) - np.uint8(1) if width > 2 else kept[:, 1].view(np.uint8)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[: len(values)] = extra
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width)[kept]
    return control.tobytes(), data.tobytes()


def decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = sizes.cumsum(dtype=np.int64)
    at = ends - sizes
    raw = np.frombuffer(data, np.uint8)
    out = raw[at].astype(np.uint32)
    for i in range(1, int(sizes.max(initial=1))):
        longer = np.flatnonzero(sizes > i)
        out[longer] |= raw[at[longer] + i].astype(np.uint32) << np.uint32(8 * i)
    return out


def _block(keys: list[int | None], ids: list[np.ndarray], before: int, ranks: np.ndarray) -> bytes:
    values = ranks[np.concatenate(ids)]
    control, data = encode(values)
    known = np.array([k is not None for k in keys], np.uint8).tobytes()
    numbers = np.array([k or 0 for k in keys], "<i8").tobytes()
    lengths = np.array([len(i) for i in ids], "<u4").tobytes()
    return _HEADER.pack(MAGIC, len(keys), before, len(values), len(data)) + known + numbers + lengths + control + data


def _unblock(payload: bytes, names: np.ndarray) -> tuple[list[int | None], np.ndarray, np.ndarray, int]:
    """Document ids, their lengths, the ids of all, and the ids before in the shard."""
    magic, n, before, n_ids, n_data = _HEADER.unpack_from(payload)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    at = _HEADER.size
    known = np.frombuffer(payload, np.uint8, n, at)
    keys = np.frombuffer(payload, "<i8", n, at + n).tolist()
    lengths = np.frombuffer(payload, "<u4", n, at + 9 * n)
    at += 13 * n
    n_control = -(-n_ids // 4)
    values = decode(payload[at : at + n_control], payload[at + n_control : at + n_control + n_data], n_ids)
    return [k if y else None for k, y in zip(keys, known)], lengths, names[values], before


def frequencies(rows: DataFrame) -> np.ndarray:
    """Ids by falling frequency over all rows (ties: smaller id first).

    Each task counts into one array; the rows that meet are bounded by the vocabulary.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            width = batch.column("width")[0].as_py() if batch.num_rows else 2
            ids = tokens.all_numbers(batch.column("ids"), width)
            for first in range(0, len(ids), BLOCK_IDS):
                own = np.bincount(ids[first : first + BLOCK_IDS], minlength=len(counts))
                own[: len(counts)] += counts
                counts = own
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(counts[at], pa.int64())], ["id", "n"])

    totals = rows.select("width", "ids").mapInArrow(run, "id int, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return np.array([r.id for r in totals.orderBy(F.desc("n"), "id").collect()], np.int64)


def write(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, end: int = END) -> None:
    """Files of the ids of all texts under ``path``, in ascending order of ``key``."""
    spark = docs.sparkSession
    rows, place = store(encoded(docs, key, text, vocabulary or tokens.vocabulary(), end, curve=False), "ids")
    names = frequencies(rows)
    spark.createDataFrame([(i, int(n)) for i, n in enumerate(names)], "rank long, id long").write.parquet(f"{path}/ranks")
    ranks = np.zeros(int(names.max(initial=0)) + 1, np.int64)
    ranks[names] = np.arange(len(names))
    sent = spark.sparkContext.broadcast(ranks)  # bounded by the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        keys: list = []
        ids: list[np.ndarray] = []
        size = 0

        def full() -> pa.RecordBatch:
            nonlocal number, before, keys, ids, size
            payload = _block(keys, ids, before, sent.value)
            columns = [pa.array([shard], pa.int32()), pa.array([number], pa.int32()), pa.array([size], pa.int64()), pa.array([payload], pa.binary())]
            number, before, keys, ids, size = number + 1, before + size, [], [], 0
            return pa.RecordBatch.from_arrays(columns, ["shard", "block", "n_ids", "payload"])

        for batch in batches:
            widths = batch.column("width").to_pylist()
            for k, raw, width in zip(batch.column("_key").to_pylist(), batch.column("ids").to_pylist(), widths):
                keys.append(k)
                ids.append(tokens.numbers(raw, width))
                size += len(ids[-1])
                if size >= BLOCK_IDS:
                    yield full()
        if keys:
            yield full()

    order = [F.col("_key").asc_nulls_first(), "n_ids", "_tie"]
    ordered = (
        rows.select(F.col(key).cast("long").alias("_key"), "n_ids", F.xxhash64("ids").alias("_tie"), "width", "ids")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
    )
    ordered.mapInArrow(run, "shard int, block int, n_ids long, payload binary").write.option("compression", "none").parquet(f"{path}/blocks")
    forget(spark, place)


def read(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` and, if asked for, ``ids``."""
    blocks = spark.read.schema("shard int, block int, n_ids long, payload binary").parquet(f"{path}/blocks")
    ranks = spark.read.schema("rank long, id long").parquet(f"{path}/ranks").orderBy("rank").collect()
    names = np.array([r.id for r in ranks], "<u4")
    before, bases = 0, {}
    for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect():  # one row a file
        bases[r.shard] = before
        before += r.n
    sent = spark.sparkContext.broadcast((names, bases))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, bases = sent.value
        for batch in batches:
            for shard, payload in zip(batch.column("shard").to_pylist(), batch.column("payload").to_pylist()):
                keys, lengths, ids, first = _unblock(payload, names)
                ends = lengths.cumsum(dtype=np.int64)
                raw = [memoryview(ids[e - n : e]) for e, n in zip(ends.tolist(), lengths.tolist())]
                columns = [
                    pa.array(keys, pa.int64()),
                    pa.array(bases[shard] + first + ends - lengths, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array([zlib.crc32(r) for r in raw], pa.int64()),
                ]
                named = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([r.tobytes() for r in raw], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, named + ["ids"] * with_ids)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids
    return blocks.select("shard", "payload").mapInArrow(run, schema)


def op9_binary(spark, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "binary")
    write(table(spark, sf_dir, "documents"), path)
    return read(spark, path)


QUERIES = {"op9_binary": op9_binary}
SQL: dict[str, str] = {}
