"""Near-duplicates by MinHash with sequential Bayesian verification.

1. Signatures. Each document's distinct word shingles are hashed and reduced to minima under many hash
   functions, grouped into bands. Rows and bands follow from the threshold and the chosen miss probability.
2. Equal sets. Documents with one set are one class, represented by its smallest id; only
   representatives go on, so thousands of copies cost one.
3. Buckets. Representatives that share a band's minima are candidates of each other, if their sizes and parity
   sketches (which of 1,024 bits an odd number of their shingles fall on) allow for the similarity: the bits in
   which two sketches differ are at most the shingles that only one of the sets holds, so no link is lost. This is a
   condition of the join, so that such pairs are never made. First one member of each bucket meets the others, then
   about ``HUBS``, then what is left meets each other; before each step verified links join components, and
   members of one component need no test of each other. No candidate is left out.
4. Verification. A pair's signatures are compared batch by batch; it is pruned as soon as the posterior
   probability of reaching the threshold falls below the miss probability. Survivors are verified exactly on
   the full shingle sets of their texts.
5. Components. Verified links join components by their smallest label, with pointer jumping.

Defined results: A-Z are lower-cased, words are runs of other than ASCII white space. With fewer words than
a shingle has the whole sequence is one shingle; without words (null or empty text) the set is empty, linked
with nothing, and the document its own component. Very long texts are whole. Rows that repeat an id are one
document as far as links go, each with its own n_shingles. Rows with a null id have a null component and are
kept. An empty table gives an empty table. Only id and results come back, so extra columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_by_worker, remove, text_of, written

MISS = 1e-6
BATCH = 32
#: So many members of a bucket, about, meet the others in the second step.
HUBS = 8
#: Of a parity sketch. With sets of more than about 2,000 shingles it tells less, and more pairs go on to their signatures.
SKETCH_BITS = 1024
MAX_WORDS = 300_000
SEED = 20_240_229
U64 = np.uint64


def rows_and_bands(similarity: float, miss: float = MISS) -> tuple[int, int]:
    """Rows so that a pair at the threshold shares a band with about 1/4; bands for the miss probability."""
    rows = max(1, int(math.log(0.25) / math.log(similarity)))
    return rows, math.ceil(math.log(miss) / math.log1p(-(similarity**rows)))


def least_matches(similarity: float, n: int, miss: float) -> int:
    """The fewest of n equal minima that keep a pair: under a flat prior the posterior of reaching the
    similarity with m of n is P(Binomial(n + 1, similarity) <= m)."""
    total = 0.0
    for m in range(n + 1):
        total += math.exp(math.lgamma(n + 2) - math.lgamma(m + 1) - math.lgamma(n + 2 - m) + m * math.log(similarity) + (n + 1 - m) * math.log1p(-similarity))
        if total >= miss:
            return m
    return n


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(31))) * U64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U64(29))) * U64(0xBF58476D1CE4E5B9)
    return x ^ (x >> U64(32))


class Shingler:
    """Distinct shingles of texts as sorted 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        self.known: dict[bytes, int] = {}

    def words(self, text: str) -> np.ndarray:
        words, known = text.encode("utf-8").lower().split(), self.known
        if len(known) > MAX_WORDS:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.array([known[w] for w in words], U64)

    def shingles(self, text: str) -> np.ndarray:
        w = self.words(text)
        if not len(w):
            return w
        width = min(self.width, len(w))
        n = len(w) - width + 1
        h = np.full(n, width, U64)
        for k in range(width):
            h = _mixed(h * U64(0xD6E8FEB86659FD93) + w[k : k + n])
        return np.unique(h)


class Signer:
    def __init__(self, rows: int, bands: int):
        self.rows, self.bands = rows, bands
        random = np.random.default_rng(SEED)
        n = rows * bands
        self.times = random.integers(0, 2**32, n, np.uint32) | np.uint32(1)
        self.flip = random.integers(0, 2**32, n, np.uint32)
        self.salt = random.integers(0, 2**63, bands, np.int64).view(U64)

    def minima(self, shingles: np.ndarray) -> np.ndarray:
        h = (shingles >> U64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
        least = np.full(len(self.times), 0xFFFFFFFF, np.uint32)
        for k in range(0, len(h), 512):  # what stays in a core's cache
            x = h[k : k + 512, None] ^ self.flip
            x *= self.times
            x ^= x >> np.uint32(15)
            np.minimum(least, x.min(axis=0), out=least)
        return least

    def buckets(self, minima: np.ndarray) -> np.ndarray:
        """For minima of several documents, one row each."""
        parts = minima.reshape(len(minima), self.bands, self.rows)
        key = np.broadcast_to(self.salt, parts.shape[:2])
        for k in range(self.rows):
            key = _mixed(key * U64(0xD6E8FEB86659FD93) + parts[:, :, k].astype(U64))
        return key.view(np.int64)


def sketch(shingles: np.ndarray) -> bytes:
    """The parity sketch of a set."""
    odd = np.bincount((shingles >> U64(40)).astype(np.int64) % SKETCH_BITS, minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(bool)).tobytes()


def _shingler(width: int) -> Shingler:
    return held_by_worker(("shingles", width), lambda: Shingler(width))


SIGNED = "i long, n long, set_key binary, signature binary, buckets array<long>, sketch array<long>"


def signatures(docs: DataFrame, width: int, rows: int, bands: int, id_col: str, text_col: str) -> DataFrame:
    """i, n (set size), set_key, signature (16 bits a minimum), buckets and sketch; null ids stay null."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, signer = _shingler(width).shingles, Signer(rows, bands)
        names = [c.split()[0] for c in SIGNED.split(", ")]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.slice(at, 500)
                sets = [shingles(t) for t in part.column("t").to_pylist()]
                full = [s for s in sets if len(s)]
                minima = np.stack([signer.minima(s) for s in full]) if full else np.empty((0, rows * bands), np.uint32)
                found = zip(full, minima.astype("<u2"), signer.buckets(minima), strict=True)
                out = []
                for s in sets:
                    if len(s):
                        own, m, buckets = next(found)
                        out.append((len(own), hashlib.blake2b(own.tobytes(), digest_size=16).digest(), m.tobytes(), buckets, np.frombuffer(sketch(own), "<i8")))
                    else:
                        out.append((0, None, None, None, None))
                yield pa.record_batch([part.column("i"), *(pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True))], names=names)

    rows_in = docs.select(F.col(id_col).cast("long").alias("i"), text_of(text_col).alias("t"))
    return rows_in.mapInArrow(signed, SIGNED)


def surviving(pairs: DataFrame, signs: DataFrame, similarity: float, miss: float, n: int) -> DataFrame:
    """The pairs (a, b) that the batches of their signatures don't prune."""
    steps = [(k, min(k + BATCH, n)) for k in range(0, n, BATCH)]
    least = [least_matches(similarity, hi, miss) for _, hi in steps]

    def pruned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 2000):
                part = batch.iloc[at : at + 2000]
                left = np.frombuffer(b"".join(part["sa"]), "<u2").reshape(-1, n)
                right = np.frombuffer(b"".join(part["sb"]), "<u2").reshape(-1, n)
                alive = np.arange(len(part))
                same = np.zeros(len(part), np.int64)
                for (lo, hi), m in zip(steps, least, strict=True):
                    same[alive] += (left[alive, lo:hi] == right[alive, lo:hi]).sum(axis=1)
                    alive = alive[same[alive] >= m]
                yield part.iloc[alive][["a", "b"]]

    both = pairs.join(signs.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a").join(signs.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInPandas(pruned, "a long, b long").distinct()


def verified(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles = _shingler(width).shingles
        hub, own = None, None
        for batch in batches:
            kept = []
            for k, (a, ta, tb) in enumerate(zip(batch["a"], batch["ta"], batch["tb"], strict=True)):
                if a != hub:
                    hub, own = a, shingles(ta)
                other = shingles(tb)
                both = len(np.intersect1d(own, other, assume_unique=True))
                if both and 100 * both >= percent * (len(own) + len(other) - both):
                    kept.append(k)
            yield batch.iloc[kept][["a", "b"]]

    both = pairs.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b").join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    return both.select("a", "b", "ta", "tb").mapInPandas(linked, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in links (a, b): root is the smallest node that it reaches."""
    edges = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    edges = written(edges, "edges")
    roots = written(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "roots")
    while True:
        near = edges.join(roots.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        hooked = roots.join(near, "node").select("node", "root", F.least("root", "near").alias("next"))
        jump = roots.select(F.col("node").alias("next"), F.col("root").alias("far"))
        new = written(hooked.join(jump, "next").select("node", F.least("next", "far").alias("root"), (F.least("next", "far") != F.col("root")).alias("moved")), "roots")
        done = not new.where("moved").limit(1).count()
        remove(roots.sparkSession, roots)
        roots = new.select("node", "root")
        if done:
            remove(roots.sparkSession, edges)
            return roots


def _active(members: DataFrame) -> DataFrame:
    """members with all, low (the least turn): of buckets with several components. Turns are shuffled node numbers."""
    sizes = members.groupBy("bucket").agg(F.count("*").alias("all"), F.min("turn").alias("low"), F.min("comp").alias("first"), F.max("comp").alias("last"))
    return members.join(sizes.where("first < last").select("bucket", "all", "low"), "bucket")


def _pairs(active: DataFrame, hubs: int | None, percent: int) -> DataFrame:
    """(a, b): hubs with members of other components of their buckets, where sizes and sketches allow for the
    similarity. hubs: how many of a bucket, about; None: all members."""
    first = F.lit(True) if hubs is None else F.col("turn") == F.col("low")
    if hubs and hubs > 1:
        first = first | (F.col("turn") < hubs * F.lit(float(1 << 63)) / F.col("all"))
    chosen = active.where(first).select("bucket", F.col("node").alias("hub"), F.col("comp").alias("hub_comp"), F.col("n").alias("hub_n"), F.col("sketch").alias("hub_sketch"))
    apart = F.abs(F.col("n") - F.col("hub_n"))
    differ = sum((F.bit_count(F.col("sketch")[k].bitwiseXOR(F.col("hub_sketch")[k])) for k in range(SKETCH_BITS // 64)), F.lit(0))
    # 100 * both >= percent * either, told by the sizes' sum and the number of shingles that only one set holds
    able = lambda only: only * (100 + percent) <= (F.col("n") + F.col("hub_n")) * (100 - percent)
    order = F.col("node") > F.col("hub") if hubs is None else F.col("node") != F.col("hub")
    met = active.join(chosen, (active["bucket"] == chosen["bucket"]) & (F.col("comp") != F.col("hub_comp")) & order & able(apart) & able(differ))
    return met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()


def link_nodes(signs: DataFrame, texts_of, width: int, percent: int, miss: float, n: int) -> DataFrame | None:
    """(node, comp) of the nodes that share a bucket; None if none do. signs: node, n, signature, buckets, sketch."""
    banded = signs.select("node", F.explode("buckets").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1").select("bucket")
    turn = F.xxhash64("node").bitwiseAND(F.lit((1 << 63) - 1))
    members = banded.join(shared, "bucket").distinct().join(signs.select("node", "n", "sketch"), "node")
    members = written(members.select("bucket", "node", "n", "sketch", F.col("node").alias("comp"), turn.alias("turn")), "buckets")
    comps = written(members.select("node").distinct().withColumn("comp", F.col("node")), "comps")
    if not comps.limit(1).count():
        return None
    texts, tested, left = texts_of(comps.select("node")), None, [members]
    for hubs in (1, HUBS, None):
        active = written(_active(members), "active")
        left.append(active)
        if not active.limit(1).count():
            break
        if hubs == HUBS:  # most nodes are done by now; the rest needs no more than its own signatures and texts
            live = written(active.select("node").distinct(), "live")
            left += [live, texts]
            signs = written(signs.join(live, "node", "left_semi"), "signs")
            texts = written(texts.join(live, "node", "left_semi"), "texts")
            left.append(signs)
        pairs = _pairs(active, hubs, percent)
        pairs = written(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        links = written(verified(surviving(pairs, signs, percent / 100, miss, n), texts, width, percent), "links")
        left += [pairs, links]
        members = active.drop("all", "low")
        if links.limit(1).count():
            ends = links.join(comps.select(F.col("node").alias("a"), F.col("comp").alias("ca")), "a").join(comps.select(F.col("node").alias("b"), F.col("comp").alias("cb")), "b")
            roots = components(ends.select(F.col("ca").alias("a"), F.col("cb").alias("b")).where("a != b").distinct()).select(F.col("node").alias("comp"), "root")
            joined = lambda rows: rows.join(roots, "comp", "left").withColumn("comp", F.coalesce("root", "comp")).drop("root")
            left += [comps, roots]
            comps, members = written(joined(comps), "comps"), joined(members)
    for df in [*left, texts]:
        remove(df.sparkSession, df)
    return comps


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, miss: float = MISS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: id, n_shingles, component_id, kept. Links have at least ``percent`` similarity."""
    rows, bands = rows_and_bands(percent / 100, miss)
    signed = written(signatures(docs, width, rows, bands, id_col, text_col), "signatures")
    classes = signed.where("n > 0 and i is not null").groupBy("set_key").agg(F.min("i").alias("node"))
    own = written(signed.select("i", "n", "set_key").join(classes, "set_key", "left").select("i", "n", F.when(F.col("n") > 0, F.coalesce("node", "i")).otherwise(F.col("i")).alias("node")), "classes")
    first = classes.select("set_key", F.col("node").alias("i"))
    signs = written(signed.where("n > 0").join(first, ["set_key", "i"], "left_semi").dropDuplicates(["set_key", "i"]).select(F.col("i").alias("node"), "n", "signature", "buckets", "sketch"), "signs")
    remove(signed.sparkSession, signed)

    def texts_of(nodes: DataFrame) -> DataFrame:
        rows_in = docs.select(F.col(id_col).cast("long").alias("node"), text_of(text_col).alias("t"))
        return written(rows_in.join(nodes, "node", "left_semi"), "texts")

    comps = link_nodes(signs, texts_of, width, percent, miss, rows * bands)
    if comps is None:
        out = own.select("i", "n", F.col("node").alias("component_id"))
    else:
        out = own.join(comps, "node", "left").select("i", "n", F.coalesce("comp", "node").alias("component_id"))
    return out.select(F.col("i").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("i").eqNullSafe(F.col("component_id")).alias("kept"))
