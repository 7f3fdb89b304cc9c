"""Exact deduplication with an extendible-hash index on shared files.

1. The directory: the distinct 64-bit hashes are counted by their leading bits; one bucket is split, and
   the directory doubled where needed, until no bucket holds more than its capacity or the directory has
   ``MAX_DEPTH`` bits. Leading bits make every bucket a range of keys.
2. Each task collapses the equal texts of a batch, so of a text that fills a third of the table one copy a
   batch is moved, and sends the rest to the owners of their buckets.
3. An owner walks its ranges in order of the hash, chains different texts of one hash and compares bytes.
   It writes one index row per text: hash, digest, the id that stays, the number of rows. The index lies
   in the shared folder.
4. Every row looks its (hash, digest) up in the index; adaptive execution splits a hot key.

Defined results: null text counts as empty, nothing is normalised. Of equal texts the row with the largest
id stays; if that id repeats, each of its rows stays. Null ids are never kept before others; a group of
null ids only keeps all of them with a null keep_id. An empty table gives an empty table. Only the id and
the results come back, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of, written

MAX_DEPTH, CAPACITY = 16, 50_000
BUCKETS_A_TASK = 8


class Directory:
    """Extendible hashing over the leading bits of unsigned 64-bit keys."""

    def __init__(self, counts: dict[int, int], capacity: int, max_depth: int = MAX_DEPTH):
        """counts: keys by their leading max_depth bits."""
        self.depth = 0
        self.slots: list[tuple[int, int]] = [(0, 0)]  # by leading bits: the bucket's (depth, leading bits)
        full = np.zeros(1 << max_depth, np.int64)
        for k, n in counts.items():
            full[k] = n
        sums = np.concatenate([[0], np.cumsum(full)])
        held = lambda d, p: int(sums[(p + 1) << (max_depth - d)] - sums[p << (max_depth - d)])
        todo = [(0, 0)]
        while todo:
            d, p = todo.pop()
            if held(d, p) <= capacity or d == max_depth:
                continue
            if d == self.depth:
                self._double()
            halves = [(d + 1, 2 * p), (d + 1, 2 * p + 1)]
            for half in halves:
                width = self.depth - d - 1
                self.slots[half[1] << width : (half[1] + 1) << width] = [half] * (1 << width)
            todo += halves
        numbers = {b: n for n, b in enumerate(dict.fromkeys(self.slots))}
        self.numbers = np.array([numbers[b] for b in self.slots], np.int32)
        self.buckets = len(numbers)

    def _double(self) -> None:
        self.slots = [b for b in self.slots for _ in range(2)]
        self.depth += 1

    def bucket_of(self, hashes: np.ndarray) -> np.ndarray:
        """For signed 64-bit hashes."""
        if not self.depth:
            return np.zeros(len(hashes), np.int32)
        return self.numbers[(hashes.astype(np.int64).view(np.uint64) >> np.uint64(64 - self.depth)).astype(np.int64)]


def build_directory(hashes: DataFrame, capacity: int | None = None) -> Directory:
    """From a column h; at most 2^MAX_DEPTH counts are collected."""
    lead = F.shiftrightunsigned(F.col("h"), 64 - MAX_DEPTH)
    counts = {int(r.lead): r.n for r in hashes.select("h").distinct().groupBy(lead.alias("lead")).agg(F.count("*").alias("n")).collect()}
    if capacity is None:
        tasks = int(hashes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        capacity = min(CAPACITY, max(64, sum(counts.values()) // (BUCKETS_A_TASK * tasks)))
    return Directory(counts, capacity)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None) -> DataFrame:
    """The index table: h, sha, keep_id, group_size, chain (its place among the texts of its hash)."""
    rows = docs.select(F.col(id_col).cast("long").alias("i"), text_of(text_col).alias("t")).withColumn("h", F.xxhash64("t"))
    directory = build_directory(rows, capacity)

    def collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = pa.table(batch).group_by(["h", "t"]).aggregate([([], "count_all"), ("i", "max")])
            bucket = directory.bucket_of(own.column("h").to_numpy())
            columns = [pa.array(bucket, pa.int32()), own.column("h"), own.column("t"), own.column("count_all"), own.column("i_max")]
            yield from pa.table(columns, names=["bucket", "h", "t", "n", "i"]).combine_chunks().to_batches()

    def owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: int | None = None
        chain: list[list] = []  # text, rows, largest id
        out: list[tuple] = []
        for batch in batches:
            for h, t, n, i in zip(*(batch.column(c).to_pylist() for c in ("h", "t", "n", "i")), strict=True):
                if h != at:
                    flush(at, chain, out)
                    at, chain = h, []
                for link in chain:
                    if link[0] == t:  # byte by byte
                        link[1] += n
                        link[2] = i if link[2] is None else link[2] if i is None else max(i, link[2])
                        break
                else:
                    chain.append([t, n, i])
            yield table(out)
            out = []
        flush(at, chain, out)
        yield table(out)

    def flush(h: int | None, chain: list[list], out: list[tuple]) -> None:
        digests = [hashlib.sha256(t.encode("utf-8")).hexdigest() for t, _, _ in chain]
        if len(set(digests)) < len(digests):
            raise ValueError(f"different texts share a digest: {digests}")
        out += [(h, sha, i, n, k) for k, (sha, (_, n, i)) in enumerate(zip(digests, chain, strict=True))]

    kinds = {"h": pa.int64(), "sha": pa.string(), "keep_id": pa.int64(), "group_size": pa.int64(), "chain": pa.int32()}

    def table(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[] for _ in kinds]
        return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], names=list(kinds))

    sent = rows.mapInArrow(collapsed, "bucket int, h long, t string, n long, i long").repartition("bucket")
    return written(sent.sortWithinPartitions("bucket", "h").mapInArrow(owned, "h long, sha string, keep_id long, group_size long, chain int"), "index")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int | None = None) -> DataFrame:
    """One row per row of docs: id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, id_col, text_col, capacity).drop("chain")
    rows = docs.select(F.col(id_col), text_of(text_col).alias("t")).select(id_col, F.xxhash64("t").alias("h"), F.sha2(F.col("t").cast("binary"), 256).alias("sha"))
    return rows.join(index, ["h", "sha"]).select(id_col, "keep_id", "group_size", F.col(id_col).eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"))
