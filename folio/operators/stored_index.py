"""An index of a corpus on disk that follows its documents: chunks, postings, lengths and vectors in buckets of documents.

An update deletes and inserts the chunks of changed documents and deletes those of documents that are gone; only the buckets
that hold one are written, for all tables under one pointer. A bucket's postings are sorted by term, so that a question reads
the row groups of its terms. Vectors are blocks of unit rows, scored by one matrix product a block; each block hands on its
best k only, which Spark merges.

Defined results: a document is known by its path; of several rows with one path the one with the largest digest counts. A
null text is empty and has no chunks. A chunk's number is a hash of path, page and place in the page. Equal scores are ordered
by number. Zero vectors score 0; null vectors and vectors of another length than the question's are left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folio.storage import BUCKET, BUCKETS, bucket_count, bucket_of, cut, read_buckets, replace_buckets, touched_buckets

from . import pages, search

DOCS = "path string, sha256 string, pages int, chars long, chunks long, indexed long, terms long"
CHUNKS = "path string, cid long, page int, seq int, chars int, dl long, text string"
POSTINGS = "path string, term string, cid long, tf long"
VECTORS = "dim int, ids array<long>, block binary"
#: Rows of a block.
BLOCK = 8192


def vector_blocks(vectors: DataFrame, id_col: str = "cid", vec_col: str = "vector", rows: int = BLOCK, group: Column | None = None) -> DataFrame:
    """(group, dim, ids, block): up to ``rows`` vectors of one length and group each, as float32 rows divided by their
    length plus 1e-9."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[list, list]] = {}
        for batch in batches:
            kinds = np.stack([batch.column("g").to_numpy(zero_copy_only=False), batch.column("v").value_lengths().to_numpy(zero_copy_only=False)], axis=1)
            for kind in map(tuple, np.unique(kinds, axis=0)):
                own = batch.take(pa.array(np.flatnonzero((kinds == kind).all(axis=1))))
                m = own.column("v").flatten().to_numpy(zero_copy_only=False).reshape(len(own), -1)
                unit = (m / (np.linalg.norm(m, axis=1, keepdims=True) + 1e-9)).astype("<f4")
                ids, parts = held.get(kind, ([], []))
                ids, parts = ids + own.column("i").to_pylist(), [*parts, unit]
                while len(ids) >= rows:
                    whole = np.concatenate(parts)
                    yield out(kind, ids[:rows], whole[:rows])
                    ids, parts = ids[rows:], [whole[rows:]]
                held[kind] = ids, parts
        for kind, (ids, parts) in held.items():
            if ids:
                yield out(kind, ids, np.concatenate(parts))

    def out(kind: tuple[int, int], ids: list, m: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([kind[0]], pa.int32()), pa.array([kind[1]], pa.int32()), pa.array([ids], pa.list_(pa.int64())), pa.array([m.tobytes()], pa.binary())]
        return pa.record_batch(columns, names=["g", "dim", "ids", "block"])

    usable = vectors.where(F.col(vec_col).isNotNull() & F.forall(vec_col, lambda x: x.isNotNull()) & (F.size(vec_col) > 0))
    g = F.lit(0) if group is None else group
    return usable.select(g.cast("int").alias("g"), F.col(id_col).cast("long").alias("i"), F.col(vec_col).cast("array<double>").alias("v")).mapInArrow(packed, f"g int, {VECTORS}")


def block_top(blocks: DataFrame, question: list[float], k: int) -> DataFrame:
    """(cid, score, rank from 0): the k vectors nearest to the question by cosine."""
    q = np.asarray(question, np.float64)
    q = (q / (float(q @ q) ** 0.5 or 1.0)).astype(np.float64)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, block in zip(batch.column("ids"), batch.column("block"), strict=True):
                i = ids.values.to_numpy(zero_copy_only=False)
                s = np.frombuffer(block.as_buffer(), "<f4").reshape(len(i), -1) @ q
                if len(i) > k:
                    least = np.partition(s, len(s) - k)[len(s) - k]
                    keep = np.flatnonzero(s >= least)  # all that tie with the k-th
                    keep = keep[np.lexsort((i[keep], -s[keep]))][:k]
                else:
                    keep = np.arange(len(i))
                yield pa.record_batch([pa.array(i[keep]), pa.array(s[keep].astype(np.float64))], names=["cid", "score"])

    return search.top(blocks.where(F.col("dim") == len(question)).select("ids", "block").mapInArrow(scored, "cid long, score double"), k)


def _current(documents: DataFrame, path_col: str, text_col: str) -> DataFrame:
    rows = documents.select(F.col(path_col).alias("path"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.withColumn("sha256", F.sha2(F.col("text").cast("binary"), 256))


def _chunks(rows: DataFrame) -> DataFrame:
    cut_up = pages.chunk_pages(pages.split_pages(rows.select("path", "text")))
    cid = F.xxhash64("path", "page", "seq")
    return cut_up.select("path", cid.alias("cid"), "page", "seq", F.col("chars").cast("int").alias("chars"), F.size(search.tx.index_words(F.col("text"))).cast("long").alias("dl"), "text")


def update(spark: SparkSession, path: str, documents: DataFrame, embed: Callable[[Column], Column] | None = None, whole: bool = True, buckets: int = BUCKETS, path_col: str = "path", text_col: str = "text") -> dict[str, int]:
    """Brings the index up to the documents: how many were written, how many went and how many buckets that took.

    whole: the documents are the whole corpus, so that those not among them are gone; else only changed ones are looked for.
    """
    buckets = bucket_count(spark, path, buckets)
    now = _current(documents, path_col, text_col)
    last = now.groupBy("path").agg(F.max("sha256").alias("sha256"))
    known = read_buckets(spark, path, DOCS, "docs")
    new = cut(search.changed_documents(last, known))
    gone = cut(search.gone_documents(last, known).select("path")) if whole else new.select("path").limit(0)
    touched = touched_buckets(new.select("path").unionByName(gone), "path", buckets)
    rows = cut(now.join(new, ["path", "sha256"], "left_semi").dropDuplicates(["path"]))
    stale = cut(new.select("path").unionByName(gone))
    kept = lambda schema, table: read_buckets(spark, path, schema, table, touched).join(stale, "path", "left_anti")
    fresh = cut(_chunks(rows))
    size = fresh.groupBy("path").agg(F.count("*").alias("chunks"), F.count(F.when(F.col("dl") > 0, 1)).alias("indexed"), F.sum("dl").alias("terms"))
    marks = F.size(F.regexp_extract_all("text", F.lit(pages.MARK), F.lit(1))).cast("int")
    docs = rows.select("path", "sha256", marks.alias("pages"), F.length("text").cast("long").alias("chars")).join(size, "path", "left").na.fill(0, ["chunks", "indexed", "terms"])
    chunks = cut(kept(CHUNKS, "chunks").unionByName(fresh))
    own = fresh.select("path", "cid").join(search.postings(fresh), "cid").select("path", "term", "cid", "tf")
    tables = {"docs": (kept(DOCS, "docs").unionByName(docs), "path"), "chunks": (chunks, "path", "cid"), "postings": (kept(POSTINGS, "postings").unionByName(own), "path", "term", "cid")}
    if embed is not None:
        place = bucket_of(F.col("path"), buckets)
        vectors = chunks.select("path", "cid", embed(search.tx.for_model(F.col("text"), "passage")).alias("vector"))
        blocks = vector_blocks(vectors.repartition(place).sortWithinPartitions("path"), group=place)
        tables["vectors"] = (blocks.withColumnRenamed("g", BUCKET), None)
    counts = {"written": new.count(), "gone": gone.count()}
    return counts | {"buckets": replace_buckets(spark, path, tables, touched, buckets)}


def ask(spark: SparkSession, path: str, question: str) -> DataFrame:
    """(cid, score): BM25 of the chunks that hold a word of the question."""
    totals = read_buckets(spark, path, DOCS, "docs").agg(F.sum("indexed").alias("docs"), (F.sum("terms") / F.sum("indexed")).alias("avgdl"))
    lengths = read_buckets(spark, path, CHUNKS, "chunks").select("cid", "dl")
    return search.bm25(read_buckets(spark, path, POSTINGS, "postings"), question, lengths, totals)


def nearest(spark: SparkSession, path: str, question: list[float], k: int) -> DataFrame:
    """(cid, score, rank): the chunks whose vectors are nearest."""
    return block_top(read_buckets(spark, path, VECTORS, "vectors"), question, k)


def passages(spark: SparkSession, path: str, hits: DataFrame) -> DataFrame:
    """The hits with the path, page and text of their chunks."""
    return read_buckets(spark, path, CHUNKS, "chunks").select("path", "page", "cid", "text").join(F.broadcast(hits), "cid")  # a question's hits
