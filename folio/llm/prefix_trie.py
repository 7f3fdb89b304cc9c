"""The prefix trie of conversations, from partial tries that are merged by their nodes' hashes.

1. Turns are numbered in their conversation by ``numbering``, so that a conversation of any length spans several tasks. A
   prefix's key is its depth and two 64-bit exclusive-or sums of hashes of (position, role, text): such sums are put
   together from ranges in any order, and a turn taken out gives the parent's key. Texts are never moved.
2. Partial tries. Every task combines the nodes of its own members (count, smallest member, words); these node tables are
   merged in rounds, first within ``LANES`` lanes of members, then over the lanes, so that the root and other hot nodes are
   put together in pieces. The conversations that end at a node are merged likewise, as sorted lists for aligned
   blocks of 65,536 ids, which bounds each list; their digest runs over the lists in order.
3. Rollup. The smallest member of a node is the smallest of all nodes below it that it passes, so that each conversation
   owns one chain of nodes, from where it leaves others to its end. Bottom-up sums run along the chains (again by
   ``numbering``); then each chain adds its total to the nodes above it. Nodes with one member need neither.

Defined results: a null turn comes first; turns that tie are ordered by role, then by the digest of the text. Null role or
text: empty. Rows without a conversation id belong to none and are left out. Repeated rows are turns of their own. An empty
table gives an empty table (no root, as there is no member). Extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.operators.numbering import RANGE, ranged, running

from .common import remove, written

LANES = 32
BLOCK_BITS = 16
NODE = ["depth", "k1", "k2"]
WORDS = r"[^\x20\x09-\x0D]+"


def _place(d: Column, a: Column, lane: int) -> Column:
    return F.xxhash64(F.lit(lane), d.cast("long"), a)


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv, r (from 1), a and b (hashes of role and text), words, and the range of the row; a table."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(text.cast("binary"))
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", role.alias("role"), digest.alias("digest"),
        F.xxhash64(F.lit(1), role, text).alias("a"), F.xxhash64(F.lit(2), digest, role).alias("b"),
        F.size(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0))).cast("long").alias("words"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    placed = ranged(rows, ["conv"], order)
    out = written(running(placed, ["conv"], order, {"r": ("sum", F.lit(1).cast("long"))}).select("conv", "r", "a", "b", "words", RANGE), "turns")
    remove(turns.sparkSession, placed)
    return out


def members(turns: DataFrame, family: int = 0, most: int = 4) -> DataFrame:
    """A row per conversation and prefix: conv, depth, k1, k2, p1, p2 (the parent's), words (of the last turn), ends.

    With a family, conversation c is rebuilt: the first h turns of c - c % family, then its own behind its first h, with
    h = crc32(c in decimal) % most. Without, conversations are as they stand.
    """
    rows = numbered_turns(turns)
    heads = [F.max(F.when(F.col("r") == i, F.struct("a", "b", "words"))).alias(f"t{i}") for i in range(1, most)]
    convs = rows.groupBy("conv").agg(F.max("r").alias("size"), *heads)
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most if family else F.lit(0).cast("long")
    base = convs.select(F.col("conv").alias("base"), F.col("size").alias("base_size"), *(F.col(f"t{i}") for i in range(1, most)))
    plans = convs.select("conv", "size", h.alias("h"), (F.col("conv") - F.col("conv") % family if family else F.col("conv")).alias("base")).join(base, "base", "left")
    shared = F.least("h", F.coalesce("base_size", F.lit(0).cast("long")))
    plans = plans.withColumn("shared", shared).withColumn("length", F.col("shared") + F.greatest(F.col("size") - F.col("h"), F.lit(0)))
    k1 = k2 = F.lit(0).cast("long")
    nodes = [F.struct(F.lit(0).cast("long").alias("depth"), k1.alias("k1"), k2.alias("k2"), k1.alias("p1"), k2.alias("p2"), F.lit(0).cast("long").alias("words"))]
    for i in range(1, most):
        p1, p2, taken = k1, k2, F.col("shared") >= i
        k1 = F.when(taken, p1.bitwiseXOR(_place(F.lit(i), F.col(f"t{i}.a"), 1))).otherwise(p1)
        k2 = F.when(taken, p2.bitwiseXOR(_place(F.lit(i), F.col(f"t{i}.b"), 2))).otherwise(p2)
        nodes.append(F.when(taken, F.struct(F.lit(i).cast("long").alias("depth"), k1.alias("k1"), k2.alias("k2"), p1.alias("p1"), p2.alias("p2"), F.col(f"t{i}.words").alias("words"))))
    plans = written(plans.select("conv", "h", "shared", "length", k1.alias("s1"), k2.alias("s2"), F.filter(F.array(*nodes), lambda x: x.isNotNull()).alias("nodes")), "plans")
    head = plans.select("conv", "length", F.explode("nodes").alias("x")).select("conv", "x.*", "length")
    own = rows.join(plans.drop("nodes"), "conv").where("r > h").withColumn("depth", F.col("r") - F.col("h") + F.col("shared"))
    own = own.withColumn("x1", _place(F.col("depth"), F.col("a"), 1)).withColumn("x2", _place(F.col("depth"), F.col("b"), 2))
    own = running(own, ["conv"], [F.col("r")], {"o1": ("bit_xor", F.col("x1")), "o2": ("bit_xor", F.col("x2"))})
    own = own.withColumn("k1", F.col("o1").bitwiseXOR(F.col("s1"))).withColumn("k2", F.col("o2").bitwiseXOR(F.col("s2")))
    own = own.select("conv", *NODE, F.col("k1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("x2")).alias("p2"), "words", "length")
    out = written(head.unionByName(own).withColumn("ends", F.col("depth") == F.col("length")).drop("length"), "members")
    for df in (rows, plans):
        remove(df.sparkSession, df)
    return out


def node_table(rows: DataFrame) -> DataFrame:
    """A row per node: n, conv (smallest member), words, the parent's key, kids."""
    parts = rows.withColumns({"n": F.lit(1).cast("long"), "lane": F.pmod(F.xxhash64("conv"), F.lit(LANES))})
    for lanes in (["lane"], []):
        parts = parts.groupBy(*NODE, *lanes).agg(F.sum("n").alias("n"), F.min("conv").alias("conv"), *(F.max(c).alias(c) for c in ("words", "p1", "p2")))
    nodes = written(parts, "trie")
    kids = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("kids"))
    out = written(nodes.join(kids, NODE, "left").na.fill(0, ["kids"]), "trie")
    remove(rows.sparkSession, nodes)
    return out


def end_lists(rows: DataFrame) -> DataFrame:
    """Of each node and block of ids, the sorted conversations that end there."""
    ends = rows.where("ends").withColumn("block", F.shiftright("conv", BLOCK_BITS))
    return ends.groupBy(*NODE, "block").agg(F.array_sort(F.collect_list("conv")).alias("ids"))


def end_digests(rows: DataFrame) -> DataFrame:
    """Of each node at which conversations end, the SHA-256 of their ids, ascending, in decimal, comma-joined."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*NODE, "ids")), strict=True):
                if key == node:
                    sha.update(b",")
                else:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256()
                sha.update(",".join(map(str, ids)).encode())
            if done:
                yield out(done)
        if node:
            yield out([(*node, sha.hexdigest())])

    def out(done: list) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*done, strict=True), kinds, strict=True)], names=[*NODE, "ends_sha256"])

    lists = end_lists(rows).repartition(*NODE).sortWithinPartitions(*NODE, "block")
    return lists.select(*NODE, "ids").mapInArrow(hashed, "depth long, k1 long, k2 long, ends_sha256 string")


def rolled_up(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Per node with several members: n_leaves and saved, over its subtree."""
    worth = (F.col("n") - 1) * F.col("words")
    order = [F.col("depth").desc()]
    placed = ranged(nodes.where("n > 1").select("conv", *NODE, worth.alias("worth"), (F.col("kids") == 0).cast("long").alias("leaf")), ["conv"], order)
    along = running(placed, ["conv"], order, {"saved": ("sum", F.col("worth")), "n_leaves": ("sum", F.col("leaf"))}).select("conv", *NODE, "saved", "n_leaves")
    single = nodes.where("n = 1").groupBy("conv").agg(F.min("depth").alias("top"))  # a chain's end that only its owner passes has a leaf
    chains = placed.groupBy("conv").agg(F.min("depth").alias("top"), F.sum("worth").alias("saved"), F.sum("leaf").alias("n_leaves"))
    tails = single.select("conv", "top", F.lit(0).cast("long").alias("saved"), F.lit(1).cast("long").alias("n_leaves"))
    chains = chains.unionByName(tails).groupBy("conv").agg(F.min("top").alias("top"), F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves"))
    # a tail counts for its owner's own nodes as well
    lifted = rows.join(chains.where("saved > 0 or n_leaves > 0"), "conv").where(F.col("depth") < F.col("top")).select(*NODE, "saved", "n_leaves")
    below = nodes.where("n > 1").join(tails.select("conv", "n_leaves"), "conv").select(*NODE, F.lit(0).cast("long").alias("saved"), "n_leaves")
    return along.drop("conv").unionByName(lifted).unionByName(below).groupBy(*NODE).agg(F.sum("saved").alias("saved"), F.sum("n_leaves").alias("n_leaves"))


def conversation_trie(turns: DataFrame, family: int = 0, most: int = 4) -> DataFrame:
    """A row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    rows = members(turns, family, most)
    nodes = node_table(rows)
    sums, ends = rolled_up(nodes, rows), end_digests(rows)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent_conv_id"))
    out = nodes.join(sums, NODE, "left").join(ends, NODE, "left").join(parents, ["depth", "p1", "p2"], "left")
    return out.select(
        F.col("conv").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"), F.col("kids").alias("n_children"),
        F.coalesce("n_leaves", F.lit(1).cast("long")).alias("n_leaves"), F.coalesce("saved", F.lit(0).cast("long")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
