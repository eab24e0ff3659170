"""Reversible line dedup: exact reference counts with sharded cuckoo filters in front.

The store keeps signed references (line key, document, +1 or -1), appended by each insertion
or deletion of documents. From them come the exact counts, and the *drop set*: keys found in
``least_docs`` documents or more, with the largest document that holds them (the keeper).
One cuckoo filter for each shard of the keys holds the drop set; fingerprints are added when
a key reaches the limit and taken out when deletions bring it below. Most lines are not in
any filter and are settled without meeting the exact table; the others are joined with it.

The filters have a fixed size (``shards`` times ``slots`` times two bytes), which bounds what
is sent to the tasks. A filter that can take no more says "maybe" to every line of its shard:
then more rows meet the exact table, and the result is the same.

Defined results: a null text is one empty line; a null document id counts as one document
that is smaller than all others; rows with the same id are one document, and each of them
keeps or loses its own lines; lines with an empty key are never dropped; other columns pass
through under any name; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prairie.llm.columns import SPACES, ascii_lower, quoted, whole
from prairie.session import fresh_path, stored, table

LEAST_DOCS = 5
LEAST_CHARS = 40
SHARDS = 64
SLOTS = 1 << 15  # of a shard's filter; a power of two
KICKS = 500


class Cuckoo:
    """Buckets of four 16-bit fingerprints; a key has two buckets, each found from the other."""

    def __init__(self, slots: int, blob: bytes | None = None, full: bool = False):
        self.buckets = slots // 4
        self.cells = np.frombuffer(blob, np.uint16).reshape(-1, 4).copy() if blob else np.zeros((self.buckets, 4), np.uint16)
        self.full = full

    def blob(self) -> bytes:
        return self.cells.tobytes()

    def places(self, keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First bucket, second bucket, fingerprint of rows of two unsigned 64-bit numbers."""
        prints = (keys[:, 1] & np.uint64(0xFFFF)).astype(np.int64)
        prints[prints == 0] = 1
        first = ((keys[:, 0] // np.uint64(shards)) % np.uint64(self.buckets)).astype(np.int64)
        return first, self.other(first, prints), prints

    def other(self, bucket, prints):
        return bucket ^ ((prints * 0x5BD1E995 >> 7) & (self.buckets - 1))

    def has(self, first, second, prints) -> np.ndarray:
        if self.full:
            return np.ones(len(prints), bool)
        p = prints.astype(np.uint16)[:, None]
        return (self.cells[first] == p).any(1) | (self.cells[second] == p).any(1)

    def add(self, first: int, second: int, print_: int) -> None:
        for bucket in (first, second):
            for i in range(4):
                if not self.cells[bucket, i]:
                    self.cells[bucket, i] = print_
                    return
        bucket, moves = second, []
        for kick in range(KICKS):
            i = kick & 3
            moves.append((bucket, i, self.cells[bucket, i]))
            print_, self.cells[bucket, i] = int(self.cells[bucket, i]), print_
            bucket = int(self.other(bucket, print_))
            for j in range(4):
                if not self.cells[bucket, j]:
                    self.cells[bucket, j] = print_
                    return
        for at, i, old in reversed(moves):
            self.cells[at, i] = old
        self.full = True

    def remove(self, first: int, second: int, print_: int) -> None:
        for bucket in (first, second):
            for i in range(4):
                if self.cells[bucket, i] == print_:
                    self.cells[bucket, i] = 0
                    return


def _numbers(keys) -> np.ndarray:
    return np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)


def _key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(" " + SPACES)))


def _digest(key: Column) -> Column:
    return F.unhex(F.md5(key))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _doc(key: Column) -> Column:
    """Document ids without null."""
    return F.coalesce(key.cast("long"), F.lit(-(2**63)))


def _kept(lines: Column, drops: Column) -> Column:
    return F.filter(lines, lambda line: ~F.array_contains(drops, _digest(_key(line))))


class LineStore:
    """References, drop set and filters of the documents inserted so far, under ``path``.

    A change writes its references, then the new drop set, then the filters; with these it is
    done. :meth:`open` goes on from the last change that was done, in any later job.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str | None = None,
        least_docs: int = LEAST_DOCS,
        least_chars: int = LEAST_CHARS,
        shards: int = SHARDS,
        slots: int = SLOTS,
    ):
        self.spark, self.path = spark, path or fresh_path(spark, "lines")
        self.least_docs, self.least_chars, self.shards, self.slots = least_docs, least_chars, shards, slots
        self.version = 0  # changes that are done
        self.drops: DataFrame | None = None  # key, n_docs, keeper
        self.filters: dict[int, tuple[bytes, bool]] = {}

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> LineStore:
        """The store at ``path`` as its last change left it."""
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        done = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/filters-*/_SUCCESS"))
        last = max(int(f.getPath().getParent().getName().rsplit("-", 1)[1]) for f in done)
        made = spark.read.parquet(f"{path}/filters-{last}")
        rows = made.collect()  # ``shards`` rows and the settings
        head = next(r for r in rows if r.shard < 0)
        store = cls(spark, path, *head.settings)
        store.version, store.drops = last + 1, spark.read.parquet(f"{path}/drops-{last}")
        store.filters = {r.shard: (bytes(r.cells), r.full) for r in rows if r.shard >= 0}
        return store

    def keys(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(key, doc) of the long lines of each row, each once."""
        lines = F.filter(F.transform(_lines(quoted(text)), _key), lambda k: F.length(k) >= self.least_chars)
        found = F.array_distinct(F.transform(lines, _digest))
        return docs.select(_doc(quoted(key)).alias("doc"), F.explode(found).alias("key")).select("key", "doc")

    def insert(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Add the documents; returns their line keys, as written."""
        return self._change(self.keys(docs, key, text), 1)

    def delete(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """Take out documents that were inserted before, as they were then; others change nothing."""
        return self._change(self.keys(docs, key, text), -1)

    def _refs(self, version: int) -> DataFrame:
        rows = self.spark.read.parquet(f"{self.path}/refs-{version}")
        return rows.withColumn("version", F.lit(version))

    def _change(self, keys: DataFrame, sign: int) -> DataFrame:
        now, path = self.version, f"{self.path}/refs-{self.version}"
        keys.withColumn("n", F.lit(sign)).write.mode("overwrite").option("compression", "zstd").parquet(path)
        delta = self.spark.read.parquet(path)
        if now:  # only keys that this change touches can change their count
            touched = stored(delta.select("key").distinct(), "touched")
            every = reduce(DataFrame.unionByName, (self._refs(v) for v in range(now + 1))).join(touched, "key", "left_semi")
            each = every.groupBy("key", "doc", "version").agg(F.sum("n").alias("n"))
            # In the order of the changes; what is not there cannot be taken out.
            changes = F.sort_array(F.collect_list(F.struct("version", "n")))
            left = F.aggregate(changes, F.lit(0).cast("long"), lambda at, c: F.greatest(F.lit(0).cast("long"), at + c["n"]))
            held = each.groupBy("key", "doc").agg(left.alias("n")).where("n > 0")
        else:
            held = delta.where("n > 0").select("key", "doc").distinct()
        counts = held.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc").alias("keeper"))
        drops = counts.where(F.col("n_docs") >= self.least_docs)
        if now:
            drops = self.drops.join(touched, "key", "left_anti").unionByName(drops)
        drops.write.mode("overwrite").parquet(f"{self.path}/drops-{now}")
        drops = self.spark.read.schema(drops.schema).parquet(f"{self.path}/drops-{now}")
        change = drops.select("key", F.lit(1).alias("sign"))
        if now:
            old = self.drops
            change = change.join(old, "key", "left_anti").unionByName(old.join(drops, "key", "left_anti").select("key", F.lit(-1).alias("sign")))
        self._refilter(change, drops)
        self.drops, self.version = drops, now + 1
        return delta.select("key", "doc")

    def _refilter(self, change: DataFrame, drops: DataFrame) -> None:
        """Bring the filters up to date. A shard's keys are streamed, those to take out first.

        A filter that was full is made anew, as keys may have gone that it never held.
        """
        shards, slots = self.shards, self.slots
        full = [s for s, (_, f) in self.filters.items() if f]
        filters = {s: f for s, f in self.filters.items() if s not in full}

        def numbered(rows: DataFrame) -> DataFrame:
            def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for b in batches:
                    if len(b):
                        yield pd.DataFrame({"shard": (_numbers(b["key"])[:, 0] % np.uint64(shards)).astype(np.int32), "key": b["key"], "sign": b["sign"]})

            return rows.mapInPandas(run, "shard int, key binary, sign int")

        rows = numbered(change)
        if full:
            anew = numbered(drops.select("key", F.lit(1).alias("sign"))).where(F.col("shard").isin(full))
            rows = rows.where(~F.col("shard").isin(full)).unionByName(anew)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            shard, cuckoo = None, None

            def done() -> pd.DataFrame:
                return pd.DataFrame({"shard": [shard], "cells": [cuckoo.blob()], "full": [cuckoo.full]})

            for batch in batches:
                for s, part in batch.groupby("shard", sort=True):
                    if s != shard:
                        if cuckoo:
                            yield done()
                        shard, cuckoo = int(s), Cuckoo(slots, *filters.get(int(s), (None, False)))
                    if cuckoo.full:
                        continue
                    places = np.stack(cuckoo.places(_numbers(part["key"]), shards), 1).tolist()
                    for place, sign in zip(places, part["sign"].tolist()):
                        if sign < 0:
                            cuckoo.remove(*place)
                        elif not cuckoo.full:
                            cuckoo.add(*place)
            if cuckoo:
                yield done()

        ordered = rows.repartition(shards, "shard").sortWithinPartitions("shard", "sign", "key")
        made = ordered.mapInPandas(run, "shard int, cells binary, full boolean")
        # At most ``shards`` rows of ``2 * slots`` bytes.
        empty = (Cuckoo(slots).blob(), False)
        self.filters = filters | {s: empty for s in full} | {r.shard: (bytes(r.cells), r.full) for r in made.collect()}
        settings = [self.least_docs, self.least_chars, shards, slots]
        kept = [(-1, None, None, settings), *((s, cells, f, None) for s, (cells, f) in self.filters.items())]
        table_ = self.spark.createDataFrame(kept, "shard int, cells binary, full boolean, settings array<int>")
        table_.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/filters-{self.version}")

    def candidates(self, keys: DataFrame) -> DataFrame:
        """Those of the (key, doc) rows that a filter does not rule out."""
        shards, slots = self.shards, self.slots
        sent = self.spark.sparkContext.broadcast(self.filters)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            filters = {shard: Cuckoo(slots, *f) for shard, f in sent.value.items()}
            for batch in batches:
                if not len(batch):
                    continue
                numbers = _numbers(batch["key"])
                shard = (numbers[:, 0] % np.uint64(shards)).astype(np.int64)
                order = np.argsort(shard, kind="stable")
                found = np.zeros(len(batch), bool)
                bounds = np.searchsorted(shard[order], np.arange(shards + 1))
                for s, cuckoo in filters.items():
                    own = order[bounds[s] : bounds[s + 1]]
                    if len(own):
                        found[own] = cuckoo.has(*cuckoo.places(numbers[own], shards))
                yield batch[found]

        return keys.mapInPandas(run, keys.schema)

    def lost(self, keys: DataFrame) -> DataFrame:
        """For each document, the digests of the lines that it loses."""
        hits = self.candidates(keys).join(self.drops, "key").where(F.col("doc") != F.col("keeper"))
        return hits.groupBy("doc").agg(F.collect_set("key").alias("drops"))

    def apply(self, docs: DataFrame, key: str = "doc_id", text: str = "text", keys: DataFrame | None = None) -> DataFrame:
        """All columns of ``docs`` as ``row``, with ``n_lines``, ``n_dropped`` and ``kept`` text.

        ``keys`` are the line keys of the same documents, where they are at hand.
        """
        lost = self.lost(self.keys(docs, key, text) if keys is None else keys)
        rows = docs.select(whole(docs).alias("row"), quoted(text).alias("_text"), _doc(quoted(key)).alias("doc"))
        joined = rows.join(lost, "doc", "left").select("row", "_text", "drops")
        lines = F.when(F.col("drops").isNull(), _lines(F.col("_text"))).otherwise(_kept(_lines(F.col("_text")), F.col("drops")))
        n_lines = F.size(_lines(F.col("_text"))).cast("long")
        return joined.select("row", n_lines.alias("n_lines"), lines.alias("_left")).select(
            "row", "n_lines", (F.col("n_lines") - F.size("_left")).alias("n_dropped"), F.array_join("_left", "\n").alias("kept")
        )


def dedup(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One run over a whole table: insert everything, then apply."""
    lines = LineStore(docs.sparkSession)
    keys = lines.insert(docs, key, text)
    return lines.apply(docs, key, text, keys)


def op5_lines(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup(docs).select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def stage(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that the store drops."""
    kept = dedup(docs)
    new = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept")), "n_chars": F.length("kept").cast("long")}
    return kept.select(*((new[c] if c in new else F.col("row").getField(c)).alias(c) for c in docs.columns))


QUERIES = {"op5_lines": op5_lines}
SQL = {
    "op5_lines": """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, doc_id, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM d),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (
  SELECT key, max(coalesce(doc_id, -9223372036854775808)) AS keeper FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -9223372036854775808)) >= 5),
o AS (SELECT k.*, keeper IS NOT NULL AND coalesce(doc_id, -9223372036854775808) <> keeper AS gone FROM k LEFT JOIN s USING (key))
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM o GROUP BY r"""
}
