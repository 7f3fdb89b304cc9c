"""Repeated passages: a De Bruijn graph of sampled word k-mers, compacted, and verified at the source.

1. Nodes. Of a document's k-mers of words those are nodes whose least pair of words (by hash) is their first or last:
   whether a k-mer is one depends on its own words only, and each window holds one at least. Edges are the words from
   one node to the next of the document, both included.
2. Graph. A node is repeated if it occurs twice, and plain if all its occurrences have one and the same edge before and one
   and the same edge behind them; where a document begins or ends it isn't. Both are told by one aggregation of nodes.
3. Compaction. Repeated and plain nodes in a row make a nonbranching path: wherever one of them occurs, all of the path
   does. So the nodes' marks are joined back to the documents, and a path is a run of marked nodes with the node before
   and behind it. Windows inside a path are repeated without further ado.
4. Verification. Other windows whose nodes are all repeated are looked up at their source coordinates: digests of 128
   bits of their words are counted. The first and last window of a path are counted too, since they may have equal ones
   outside; an equal of any other window of a path holds a plain node of it, and so lies in it as well.

A node's hash that two k-mers share, or a wrong mark, makes a window a candidate at most; a path needs two hashes of its
edges to agree besides. Documents are told apart by two hashes of their text, so equal texts get equal results.

Defined results: words are runs of other than ASCII white space, unchanged. A null text has no words; fewer words than a
window: nothing is removed. Rows that repeat an id, or have none, are documents of their own, and repeat each other's
passages. Very long texts are whole. An empty table gives an empty table. Only the id and results come back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker, portions_of, remove, text_of, written

WINDOW = 35
MAX_WORDS = 300_000
U64 = np.uint64
#: Odd multipliers of the two word hashes, and their inverses modulo 2**64.
BASES = (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15)
INVERSE = tuple(pow(b, -1, 1 << 64) for b in BASES)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class Passages:
    """The words of texts as hashes, and hashes of their runs of words."""

    def __init__(self, window: int):
        self.window = window
        self.s = 2 if window > 3 else 1
        self.span = max(1, (window - self.s + 3) // 2)  # units of s words in a node
        self.k = self.span + self.s - 1
        self.known: dict[bytes, int] = {}
        self.power = [np.empty(0, U64)] * 2
        self.inverse = [np.empty(0, U64)] * 2

    def words(self, text: str) -> np.ndarray:
        words, known = text.encode("utf-8").split(), self.known
        if len(known) > MAX_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([known[w] for w in words], U64)

    def sums(self, w: np.ndarray, lane: int) -> np.ndarray:
        """Prefix sums from which ``runs`` takes the hash of any run of words."""
        n = len(w)
        if n > len(self.power[lane]):
            self.power[lane], self.inverse[lane] = _powers(BASES[lane], 2 * n), _powers(INVERSE[lane], 2 * n)
        out = np.zeros(n + 1, U64)
        np.cumsum((_mixed(w + U64(1)) if lane else w) * self.power[lane][:n], out=out[1:])
        return out

    def runs(self, sums: np.ndarray, lane: int, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return _mixed((sums[stop] - sums[start]) * self.inverse[lane][start] + (stop - start).astype(U64))

    def nodes(self, w: np.ndarray, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the nodes, and their hashes with the last bit cleared."""
        if len(w) < self.window:
            return np.empty(0, np.int64), np.empty(0, U64)
        unit = _mixed(w[:-1] * U64(BASES[0]) + w[1:]) if self.s == 2 else _mixed(w)
        least, have = unit, 1
        while have < self.span:
            step = min(have, self.span - have)
            least = np.minimum(least[:-step], least[step:])
            have += step
        at = np.flatnonzero((unit[: len(least)] == least) | (unit[self.span - 1 :] == least))
        return at, self.runs(sums, 0, at, at + self.k) & U64(0xFFFFFFFFFFFFFFFE)

    def contexts(self, at: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """For each node one hash of the edges before and behind it; 0 for the first and the last."""
        out = np.zeros(len(at), U64)
        if len(at) > 2:
            edges = self.runs(sums, 0, at[:-1], at[1:] + self.k)
            out[1:-1] = _mixed(edges[:-1] * U64(BASES[1]) + edges[1:]) | U64(1)
        return out

    def judged(self, text: str, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Spans of paths (start, stop), starts of the windows to be counted, and their digests in two lanes. The start
        is -1 for the first and last window of a path, which need not be looked up.
        marks: the repeated nodes, with the last bit set for plain ones, sorted."""
        none = np.empty(0, np.int64)
        w = self.words(text)
        sums = self.sums(w, 0)
        at, h = self.nodes(w, sums)
        if not len(at) or not len(marks):
            return np.empty((0, 2), np.int64), none, none.astype(U64), none.astype(U64)
        place = np.minimum(np.searchsorted(marks, h), len(marks) - 1)
        found = marks[place] & U64(0xFFFFFFFFFFFFFFFE) == h
        plain = found & (marks[place] & U64(1) == 1)
        starts = len(w) - self.window + 1
        lo, hi = np.searchsorted(at, np.arange(starts)), np.searchsorted(at, np.arange(starts) + self.window - self.k, "right")
        odd = np.concatenate([[0], np.cumsum(~found)])
        open_ = odd[hi] == odd[lo]
        turn = np.diff(np.concatenate([[0], plain.astype(np.int8), [0]]))
        first, last = np.flatnonzero(turn == 1) - 1, np.flatnonzero(turn == -1)
        spans = np.stack([at[first], at[last] + self.k], axis=1) if len(first) else np.empty((0, 2), np.int64)
        spans = spans[spans[:, 1] - spans[:, 0] >= self.window]
        step = np.zeros(starts + 1, np.int64)
        np.add.at(step, spans[:, 0], 1)
        np.add.at(step, spans[:, 1] - self.window + 1, -1)
        inside = np.cumsum(step[:-1]) > 0
        open_ &= ~inside
        open_[spans[:, 0]] = True
        open_[spans[:, 1] - self.window] = True
        p = np.flatnonzero(open_)
        return spans, np.where(inside[p], -1, p), self.runs(sums, 0, p, p + self.window), self.runs(self.sums(w, 1), 1, p, p + self.window)


def _passages(window: int) -> Passages:
    return held_by_worker(("passages", window), lambda: Passages(window))


def _key(text: Column) -> list[Column]:
    return [F.xxhash64(text).alias("k"), F.crc32(text.cast("binary")).alias("c")]


def _lists(rows: list[np.ndarray], kind: str) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
    flat = np.concatenate(rows) if rows else np.empty(0, kind)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(kind) if flat.dtype == U64 else flat.astype(kind)))


def graph_nodes(docs: DataFrame, window: int, text_col: str) -> DataFrame:
    """k (of the text), h and ctx: hashes and contexts of the text's nodes, for texts that have any."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = _passages(window)
        for batch in batches:
            at = 0
            for texts in portions_of(batch.column("t"), 4_000_000):
                keys, hs, cs = [], [], []
                for k, text in zip(batch.column("k").slice(at, len(texts)).to_pylist(), texts.to_pylist(), strict=True):
                    w = passages.words(text)
                    sums = passages.sums(w, 0)
                    places, h = passages.nodes(w, sums)
                    if len(places):
                        keys.append(k)
                        hs.append(h)
                        cs.append(passages.contexts(places, sums))
                at += len(texts)
                yield pa.record_batch([pa.array(keys, pa.int64()), _lists(hs, "<i8"), _lists(cs, "<i8")], names=["k", "h", "ctx"])

    text = text_of(text_col)
    return docs.select(_key(text)[0], text.alias("t")).mapInArrow(found, "k long, h array<long>, ctx array<long>")


JUDGED = "k long, c long, spans array<int>, starts array<int>, d1 array<long>, d2 array<long>"


def judged_windows(docs: DataFrame, marks: DataFrame, window: int, text_col: str) -> DataFrame:
    """For texts with repeated nodes: spans of paths (start, stop, start, ...), and the windows to be counted."""

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passages = _passages(window)
        for batch in batches:
            at = 0
            for texts in portions_of(batch.column("t"), 4_000_000):
                part = batch.slice(at, len(texts))
                at += len(texts)
                rows = [passages.judged(text, np.sort(np.array(m, np.int64).view(U64))) for text, m in zip(texts.to_pylist(), part.column("marks").to_pylist(), strict=True)]
                spans, starts, d1, d2 = (list(c) for c in zip(*rows, strict=True))
                yield pa.record_batch([part.column("k"), part.column("c"), _lists([s.ravel() for s in spans], "<i4"), _lists(starts, "<i4"), _lists(d1, "<i8"), _lists(d2, "<i8")], names=[x.split()[0] for x in JUDGED.split(", ")])

    text = text_of(text_col)
    return docs.select(*_key(text), text.alias("t")).join(marks, "k").select("k", "c", "t", "marks").mapInArrow(judged, JUDGED)


def repeated_places(docs: DataFrame, window: int = WINDOW, text_col: str = "text") -> DataFrame:
    """k, c (of the text), places: sorted starts and stops of the text's repeated passages, which may touch or overlap."""
    spark = docs.sparkSession
    nodes = written(graph_nodes(docs, window, text_col), "nodes")
    pairs = nodes.select(F.explode(F.arrays_zip("h", "ctx")).alias("x"))
    seen = pairs.groupBy(F.col("x.h").alias("h")).agg(F.count("*").alias("n"), F.min("x.ctx").alias("lo"), F.max("x.ctx").alias("hi")).where("n > 1")
    repeated = seen.select("h", F.when((F.col("lo") == F.col("hi")) & (F.col("lo") != 0), F.col("h").bitwiseOR(F.lit(1))).otherwise(F.col("h")).alias("mark"))
    marks = nodes.select("k", F.explode(F.array_distinct("h")).alias("h")).join(repeated, "h").groupBy("k").agg(F.collect_set("mark").alias("marks"))
    judged = written(judged_windows(docs, marks, window, text_col), "windows")
    remove(spark, nodes)
    counted = judged.select("k", "c", F.explode(F.arrays_zip("d1", "d2", "starts")).alias("x")).select("k", "c", F.col("x.d1").alias("d1"), F.col("x.d2").alias("d2"), F.col("x.starts").alias("p"))
    again = counted.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.max("p").alias("p")).where("n > 1 and p >= 0").select("d1", "d2")
    again = written(again, "again")  # so that the join's other side can be split where a window is frequent
    windows = counted.where("p >= 0").join(again, ["d1", "d2"], "left_semi").select("k", "c", F.col("p").alias("start"), (F.col("p") + window).alias("stop"))
    ends = F.transform(F.sequence(F.lit(0), (F.size("spans") / 2).cast("int") - 1), lambda i: F.struct(F.col("spans")[2 * i].alias("start"), F.col("spans")[2 * i + 1].alias("stop")))
    paths = judged.where(F.size("spans") > 0).select("k", "c", F.explode(ends).alias("x")).select("k", "c", "x.start", "x.stop")
    return paths.unionByName(windows).groupBy("k", "c").agg(F.array_sort(F.collect_set(F.struct("start", "stop"))).alias("places"))


def drop_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, n_removed, spans (start and stop of the removed words, from 0) and text (kept words, one space between)."""

    def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for texts in portions_of(batch.column("t"), 4_000_000):
                part = batch.slice(at, len(texts))
                at += len(texts)
                n, gone, spans, kept = [], [], [], []
                for text, places in zip(texts.to_pylist(), part.column("places").to_pylist(), strict=True):
                    words, out, left, to = text.encode("utf-8").split(), [], [], 0
                    for place in places or ():
                        if out and place["start"] <= out[-1]["stop"]:
                            out[-1]["stop"] = max(out[-1]["stop"], place["stop"])
                        else:
                            out.append(place)
                    for place in out:
                        left += words[to : place["start"]]
                        to = place["stop"]
                    left += words[to:]
                    n.append(len(words))
                    gone.append(len(words) - len(left))
                    spans.append(out)
                    kept.append(b" ".join(left))
                yield pa.record_batch([part.column("i"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, SPANS), pa.array(kept, pa.binary()).cast(pa.string())], names=["i", "n_words", "n_removed", "spans", "text"])

    SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
    text = text_of(text_col)
    places = repeated_places(docs, window, text_col)
    rows = docs.select(F.col(id_col).alias("i"), *_key(text), text.alias("t")).join(places, ["k", "c"], "left").select("i", "t", "places")
    schema = f"i {docs.schema[id_col].dataType.simpleString()}, n_words long, n_removed long, spans array<struct<start:int,stop:int>>, text string"
    return rows.mapInArrow(cut_out, schema).withColumnRenamed("i", id_col)
