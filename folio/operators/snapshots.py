"""Library snapshots: deltas against a common base, classification, union, trash and trees."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folio.storage import cut

KIND, KEY, OP, PAYLOAD = "kind", "key", "op", "payload"


def keyed(df: DataFrame, kind: str, key: Column, payload: list[str]) -> DataFrame:
    """(kind, key, payload): a section of a snapshot; the payload is canonical text, null kept apart from empty."""
    cells = [F.coalesce(F.to_json(F.struct(F.col(c).alias("v")), {"ignoreNullFields": "false"}), F.lit("")) for c in payload]
    return df.select(F.lit(kind).alias(KIND), key.cast("string").alias(KEY), F.concat_ws("|", *cells).alias(PAYLOAD))


def delta(base: DataFrame, current: DataFrame) -> DataFrame:
    """(kind, key, op, payload): add and change carry the new payload, remove none."""
    b, c = base.select(KIND, KEY, F.col(PAYLOAD).alias("old"), F.lit(True).alias("was")), current.select(KIND, KEY, F.col(PAYLOAD).alias("new"), F.lit(True).alias("now"))
    both = b.join(c, [KIND, KEY], "full_outer").where(F.col("was").isNull() | F.col("now").isNull() | ~F.col("old").eqNullSafe(F.col("new")))
    op = F.when(F.col("was").isNull(), "add").when(F.col("now").isNull(), "remove").otherwise("change")
    return both.select(KIND, KEY, op.alias(OP), F.when(F.col("now").isNotNull(), F.col("new")).alias(PAYLOAD))


def compare_keys(left: DataFrame, right: DataFrame) -> DataFrame:
    """(kind, key, side): origin_only, replica_only or changed."""
    d = delta(left, right)
    side = F.when(F.col(OP) == "add", "replica_only").when(F.col(OP) == "remove", "origin_only").otherwise("changed")
    return d.select(KIND, KEY, side.alias("side"))


def changed_aspects(left: DataFrame, right: DataFrame, key: str, aspects: list[str]) -> DataFrame:
    """(key, aspects) of the keys in both whose named columns differ."""
    r = right.select(F.col(key), *[F.col(c).alias(f"_{c}") for c in aspects])
    out = left.join(r, key).select(key, F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in aspects])).alias("aspects"))
    return out.where(F.size("aspects") > 0)


def missing_operations(left: DataFrame, right: DataFrame) -> DataFrame:
    """Operations of the left delta that the right one doesn't hold."""
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in (KIND, KEY, OP, PAYLOAD)]
    return left.alias("l").join(right.alias("r"), reduce(lambda a, b: a & b, same), "left_anti")


def classify(origin: DataFrame, replica: DataFrame, base: DataFrame | None = None) -> DataFrame:
    """One row: mode and reason. The order of the tests is part of the result."""
    between = delta(origin, replica)
    n = lambda df: df.agg(F.count("*").alias("n"))
    if base is None:
        return n(between).select(F.when(F.col("n") == 0, "equal").otherwise("conflict").alias("mode"), F.when(F.col("n") == 0, "the same state").otherwise("no last-common base").alias("reason"))
    by_origin, by_replica = delta(base, origin), delta(base, replica)
    facts = None
    for name, df in (("apart", between), ("o", by_origin), ("r", by_replica), ("o_more", missing_operations(by_origin, by_replica)), ("r_more", missing_operations(by_replica, by_origin))):
        one = n(df).select(F.col("n").alias(name))
        facts = one if facts is None else facts.crossJoin(one)  # one row each
    mode = (
        F.when(F.col("apart") == 0, "equal")
        .when(F.col("o") == 0, "replica_fast_forward")
        .when(F.col("r") == 0, "origin_fast_forward")
        .when(F.col("o_more") == 0, "replica_fast_forward")
        .when(F.col("r_more") == 0, "origin_fast_forward")
        .otherwise("conflict")
    )
    reason = F.when(F.col("apart") == 0, "the same state").when(mode == "conflict", "both changed").otherwise("one side holds the other's changes")
    return facts.select(mode.alias("mode"), reason.alias("reason"))


def additive_extras(base: DataFrame, origin: DataFrame, replica: DataFrame) -> DataFrame:
    """What the replica adds beyond the origin. Raises when evaluated if the two are no disjoint union: the
    replica's other operations must be additions, and no operation of both may differ."""
    by_origin, by_replica = delta(base, origin), delta(base, replica)
    o = by_origin.select(KIND, KEY, F.col(OP).alias("_op"), F.col(PAYLOAD).alias("_payload"))
    both = by_replica.join(o, [KIND, KEY], "left")
    same = F.col(OP).eqNullSafe(F.col("_op")) & F.col(PAYLOAD).eqNullSafe(F.col("_payload"))
    bad = F.when(F.col("_op").isNotNull(), ~same).otherwise(F.col(OP) != "add")
    kept = both.withColumn(KEY, F.when(bad, F.raise_error(F.concat(F.lit("not a disjoint union: "), F.col(KIND), F.lit(" "), F.col(KEY))).cast("string")).otherwise(F.col(KEY)))
    return kept.where(F.col("_op").isNull()).select(KIND, KEY, PAYLOAD)


def union(base: DataFrame, origin: DataFrame, replica: DataFrame) -> DataFrame:
    """Origin and the replica's additions."""
    return origin.select(KIND, KEY, PAYLOAD).unionByName(additive_extras(base, origin, replica))


def remap_lookup(extras: DataFrame, own: DataFrame, theirs: DataFrame, id_col: str, natural: list[str]) -> DataFrame:
    """(old_id, new_id, inserted): lookup ids of the replica in the origin, by natural key (nulls equal).

    Missing entries get new ids after the origin's largest. extras: the ids in use.
    """
    used = theirs.join(extras.select(id_col).distinct(), id_col, "left_semi")
    cond = reduce(lambda a, b: a & b, [F.col(f"t.{c}").eqNullSafe(F.col(f"o.{c}")) for c in natural])
    matched = used.alias("t").join(own.alias("o"), cond, "left").groupBy(F.col(f"t.{id_col}").alias("old_id")).agg(F.min(f"o.{id_col}").alias("known"))
    top = own.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top"))  # one row
    # new ids count within hash parts first, so no task has to number all of them
    new = matched.where("known is null").select("old_id").withColumn("part", F.pmod(F.xxhash64("old_id"), F.lit(256)))
    sizes = new.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n"))  # 256 rows
    numbered = new.withColumn("k", F.row_number().over(Window.partitionBy("part").orderBy("old_id"))).join(F.broadcast(sizes.select("part", "before")), "part")
    fresh = numbered.crossJoin(F.broadcast(top)).select("old_id", (F.col("top") + F.col("before") + F.col("k")).cast("long").alias("new_id"), F.lit(True).alias("inserted"))
    return matched.where("known is not null").select("old_id", F.col("known").cast("long").alias("new_id"), F.lit(False).alias("inserted")).unionByName(fresh)


def closure(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(key, depth): seeds and everything below them; edges (key, parent). Ends although edges may form cycles."""
    found = cut(seeds.select("key").distinct().withColumn("depth", F.lit(0)))
    step, depth = found, 0
    while True:
        depth += 1
        step = cut(edges.join(step.select(F.col("key").alias("parent")), "parent", "left_semi").select("key").distinct().join(found, "key", "left_anti").withColumn("depth", F.lit(depth)))
        if step.isEmpty():
            return found
        found = cut(found.unionByName(step))


def insertion_order(nodes: DataFrame) -> DataFrame:
    """(key, depth, reachable): parents before children; a key that no root reaches lies on or below a cycle. nodes (key, parent)."""
    roots = nodes.join(nodes.select(F.col("key").alias("parent"), F.lit(True).alias("in")), "parent", "left").where(F.col("in").isNull()).select("key")
    depth = closure(nodes, roots)
    return nodes.select("key").join(depth, "key", "left").withColumn("reachable", F.col("depth").isNotNull())


def paths(nodes: DataFrame, sep: str = " / ") -> DataFrame:
    """(key, path): names from the root down; nodes (key, parent, name)."""
    done = cut(nodes.where("parent is null").select("key", F.col("name").alias("path")))
    step = done
    while True:
        up = step.select(F.col("key").alias("parent"), F.col("path").alias("_above"))
        step = cut(nodes.join(up, "parent").select("key", F.concat("_above", F.lit(sep), "name").alias("path")).join(done.select("key"), "key", "left_anti"))
        if step.isEmpty():
            return done
        done = cut(done.unionByName(step))


def dangling(rows: DataFrame, column: str, targets: DataFrame, target: str) -> DataFrame:
    """Rows that refer to nothing."""
    t = targets.select(F.col(target).alias("_t")).distinct()
    return rows.where(F.col(column).isNotNull()).join(t, F.col(column) == F.col("_t"), "left_anti")


def orphans(lookup: DataFrame, column: str, uses: DataFrame) -> DataFrame:
    """Lookup rows that nothing uses any longer."""
    return lookup.join(uses.select(column).distinct(), column, "left_anti")


def unexpected_after_purge(before: DataFrame, after: DataFrame, purged: DataFrame) -> DataFrame:
    """Operations of the purge beyond the removal of the listed (kind, key)."""
    d = delta(before, after)
    allowed = purged.select(KIND, KEY).distinct().withColumn("_ok", F.lit(True))
    return d.join(allowed, [KIND, KEY], "left").where((F.col(OP) != "remove") | F.col("_ok").isNull()).select(KIND, KEY, OP)


def advance_base(base: DataFrame, proposed: DataFrame, votes: DataFrame) -> DataFrame:
    """The new common base: the proposed state once every peer has accepted it, else the old one. votes: peer, accepted.

    Of several votes of a peer one refusal counts; a null vote is none yet. Without any peer nothing moves.
    """
    told = votes.groupBy("peer").agg(F.bool_and(F.coalesce("accepted", F.lit(False))).alias("yes"))
    agreed = F.broadcast(told.agg(F.coalesce(F.bool_and("yes"), F.lit(False)).alias("_moves")))  # one row
    return proposed.crossJoin(agreed).where("_moves").drop("_moves").unionByName(base.crossJoin(agreed).where("not _moves").drop("_moves"))


def same_state(left: DataFrame, right: DataFrame) -> DataFrame:
    """(same): one row, whether two states are equal, that is, their delta is empty."""
    return delta(left, right).agg((F.count("*") == 0).alias("same"))


def collection_payload(collections: DataFrame, relations: DataFrame) -> DataFrame:
    """(key, payload): name, parent and the sorted distinct relations of a collection as one comparable text."""
    own = relations.groupBy("key").agg(F.array_sort(F.collect_set("relation")).alias("relations"))
    rows = collections.join(own, "key", "left").withColumn("relations", F.coalesce("relations", F.expr("cast(array() as array<string>)")))
    return rows.select("key", F.to_json(F.struct("name", "parent", "relations")).alias("payload"))


def note_keys(notes: DataFrame, items: DataFrame, parent_key: str) -> DataFrame:
    """(key) of the notes below an item; notes: item, parent; items: id, key."""
    parent = items.where(F.col("key") == parent_key).select(F.col("id").alias("parent"))
    return notes.join(parent, "parent", "left_semi").join(items.select(F.col("id").alias("item"), "key"), "item").select("key")


def empty_trash(nodes: DataFrame, trashed: DataFrame, memberships: DataFrame, lookups: dict[str, tuple[DataFrame, DataFrame, str]]) -> dict[str, DataFrame]:
    """What is left once the trash is emptied, and proof of it.

    nodes: key, parent; trashed: key; memberships: coll, key; lookups by name: (rows, uses with a column key, column). With the
    trashed nodes all below them go, their memberships and uses, and lookup rows that nothing uses any longer.
    Result: nodes, memberships, removed, a table per lookup, and problems (kind, key): what refers to something gone.
    """
    gone = cut(closure(nodes, trashed).select("key"))
    left = nodes.join(gone, "key", "left_anti")
    members = memberships.join(gone, "key", "left_anti").select(*memberships.columns)
    out = {"nodes": left, "memberships": members, "removed": gone}
    problems = dangling(left, "parent", left, "key").select(F.lit("parent").alias("kind"), F.col("key").cast("string").alias("key"))
    problems = problems.unionByName(dangling(members, "key", left, "key").select(F.lit("membership").alias("kind"), F.col("key").cast("string").alias("key")))
    for name, (rows, uses, column) in lookups.items():
        own = uses.join(gone, "key", "left_anti")
        out[name] = rows.join(own.select(column).distinct(), column, "left_semi")
        problems = problems.unionByName(dangling(own, column, out[name], column).select(F.lit(name).alias("kind"), F.col("key").cast("string").alias("key")))
    return out | {"problems": problems}
