"""Queries on library snapshots: joins, deltas, classification, union, trash, trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.operators import snapshots as sn

from .lifts import table
from .registry import query

#: base, origin and replica states of (kind, key, payload) from customers and their nations.
STATES = """rows_t AS (SELECT c_custkey AS k, c_name AS name, c_mktsegment AS seg, c_nationkey AS nat FROM customer),
base_i AS (SELECT k, name, seg, nat FROM rows_t WHERE k % 10 <> 0),
origin_i AS (SELECT k, CASE WHEN k % 7 = 0 THEN name || ' x' ELSE name END AS name, seg, nat FROM rows_t WHERE (k % 10 <> 0 AND k % 11 <> 0) OR k % 20 = 0),
replica_i AS (SELECT k, CASE WHEN k % 14 = 0 THEN name || ' x' ELSE name END AS name, CASE WHEN k % 13 = 0 THEN 'EDIT' ELSE seg END AS seg, nat FROM rows_t WHERE (k % 10 <> 0 AND k % 17 <> 0) OR k % 30 = 0),
base AS (SELECT 'item' AS kind, CAST(k AS VARCHAR) AS key, name || '|' || seg AS payload FROM base_i UNION ALL SELECT 'membership', nat || ':' || k, '' FROM base_i),
origin AS (SELECT 'item' AS kind, CAST(k AS VARCHAR) AS key, name || '|' || seg AS payload FROM origin_i UNION ALL SELECT 'membership', nat || ':' || k, '' FROM origin_i),
replica AS (SELECT 'item' AS kind, CAST(k AS VARCHAR) AS key, name || '|' || seg AS payload FROM replica_i UNION ALL SELECT 'membership', nat || ':' || k, '' FROM replica_i)"""


def delta_sql(name: str, a: str, b: str) -> str:
    return f"""{name} AS (SELECT coalesce(x.kind, y.kind) AS kind, coalesce(x.key, y.key) AS key,
CASE WHEN x.key IS NULL THEN 'add' WHEN y.key IS NULL THEN 'remove' ELSE 'change' END AS op, y.payload AS payload
FROM {a} x FULL JOIN {b} y ON x.kind = y.kind AND x.key = y.key WHERE x.payload IS DISTINCT FROM y.payload OR x.key IS NULL OR y.key IS NULL)"""


def sections(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("seg"), F.col("c_nationkey").alias("nat"))
    k = F.col("k")
    base = c.where(k % 10 != 0)
    origin = c.where(((k % 10 != 0) & (k % 11 != 0)) | (k % 20 == 0)).withColumn("name", F.when(k % 7 == 0, F.concat("name", F.lit(" x"))).otherwise(F.col("name")))
    replica = c.where(((k % 10 != 0) & (k % 17 != 0)) | (k % 30 == 0)).withColumns({"name": F.when(k % 14 == 0, F.concat("name", F.lit(" x"))).otherwise(F.col("name")), "seg": F.when(k % 13 == 0, F.lit("EDIT")).otherwise(F.col("seg"))})
    return base, origin, replica


def state(items):
    members = items.select(F.lit("membership").alias("kind"), F.concat_ws(":", "nat", "k").alias("key"), F.lit("").alias("payload"))
    return items.select(F.lit("item").alias("kind"), F.col("k").cast("string").alias("key"), F.concat_ws("|", "name", "seg").alias("payload")).unionByName(members)


def states(spark, sf):
    return [state(x) for x in sections(spark, sf)]


@query("u02_delta", f"WITH {STATES}, {delta_sql('d', 'base', 'origin')} SELECT kind, key, op, payload FROM d")
def u02_delta(spark, sf):
    base, origin, _ = states(spark, sf)
    return sn.delta(base, origin).select("kind", "key", "op", "payload")


@query("j07_compare_keys", f"WITH {STATES}, {delta_sql('d', 'origin', 'replica')} SELECT kind, key, CASE op WHEN 'add' THEN 'replica_only' WHEN 'remove' THEN 'origin_only' ELSE 'changed' END AS side FROM d")
def j07_compare_keys(spark, sf):
    _, origin, replica = states(spark, sf)
    return sn.compare_keys(origin, replica)


@query("u01_key_sets", f"WITH {STATES} SELECT 'both' AS part, count(*) AS n FROM (SELECT kind, key FROM origin INTERSECT SELECT kind, key FROM replica) UNION ALL SELECT 'origin', count(*) FROM (SELECT kind, key FROM origin EXCEPT SELECT kind, key FROM replica) UNION ALL SELECT 'either', count(*) FROM (SELECT kind, key FROM origin UNION SELECT kind, key FROM replica)")
def u01_key_sets(spark, sf):
    _, origin, replica = (s.select("kind", "key") for s in states(spark, sf))
    parts = {"both": origin.intersect(replica), "origin": origin.subtract(replica), "either": origin.union(replica).distinct()}
    out = None
    for name, df in parts.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("u03_missing_operations", f"WITH {STATES}, {delta_sql('o', 'base', 'origin')}, {delta_sql('r', 'base', 'replica')} SELECT kind, key, op, payload FROM o WHERE NOT EXISTS (SELECT 1 FROM r WHERE r.kind = o.kind AND r.key = o.key AND r.op = o.op AND r.payload IS NOT DISTINCT FROM o.payload)")
def u03_missing_operations(spark, sf):
    base, origin, replica = states(spark, sf)
    return sn.missing_operations(sn.delta(base, origin), sn.delta(base, replica)).select("kind", "key", "op", "payload")


@query("a21_changed_aspects", f"WITH {STATES} SELECT o.k, concat_ws(',', CASE WHEN o.name IS DISTINCT FROM r.name THEN 'name' END, CASE WHEN o.seg IS DISTINCT FROM r.seg THEN 'seg' END) AS aspects FROM origin_i o JOIN replica_i r ON o.k = r.k WHERE o.name IS DISTINCT FROM r.name OR o.seg IS DISTINCT FROM r.seg")
def a21_changed_aspects(spark, sf):
    _, origin, replica = sections(spark, sf)
    return sn.changed_aspects(origin, replica, "k", ["name", "seg"]).select("k", F.array_join("aspects", ",").alias("aspects"))


def classified_sql(name: str, origin: str, replica: str, base: str | None) -> str:
    """The modes by counts of differences, in the order that the tests have."""
    apart = lambda a, b: f"(SELECT count(*) FROM ((SELECT * FROM {a} EXCEPT SELECT * FROM {b}) UNION ALL (SELECT * FROM {b} EXCEPT SELECT * FROM {a})))"
    if base is None:
        return f"SELECT '{name}' AS \"case\", CASE WHEN {apart(origin, replica)} = 0 THEN 'equal' ELSE 'conflict' END AS mode"
    ops = lambda state: f"(SELECT * FROM ({delta_sql('x', base, state)[6:-1]}))"
    more = lambda a, b: f"(SELECT count(*) FROM (SELECT * FROM {ops(a)} EXCEPT SELECT * FROM {ops(b)}))"
    return f"""SELECT '{name}', CASE WHEN {apart(origin, replica)} = 0 THEN 'equal' WHEN {apart(base, origin)} = 0 THEN 'replica_fast_forward' WHEN {apart(base, replica)} = 0 THEN 'origin_fast_forward'
WHEN {more(origin, replica)} = 0 THEN 'replica_fast_forward' WHEN {more(replica, origin)} = 0 THEN 'origin_fast_forward' ELSE 'conflict' END"""


CASES = {"conflict": ("origin", "replica", "base"), "equal": ("origin", "origin", "base"), "ahead": ("base", "replica", "base"), "behind": ("origin", "base", "base"), "no base": ("origin", "replica", None), "equal, no base": ("replica", "replica", None), "subset": ("origin", "more", "base"), "superset": ("more", "origin", "base")}


@query("u15_classify", f"WITH {STATES}, more AS (SELECT * FROM origin UNION ALL SELECT 'item', 'new', 'payload') " + " UNION ALL ".join(classified_sql(n, *c) for n, c in sorted(CASES.items(), key=lambda x: x[1][2] is not None)))
def u15_classify(spark, sf):
    known = dict(zip(("base", "origin", "replica"), states(spark, sf), strict=True))
    known["more"] = known["origin"].unionByName(spark.createDataFrame([("item", "new", "payload")], "kind string, key string, payload string"))
    out = None
    for name, (o, r, b) in CASES.items():
        one = sn.classify(known[o], known[r], known[b] if b else None).select(F.lit(name).alias("case"), "mode")
        out = one if out is None else out.unionByName(one)
    return out


EXTRAS = STATES + ", added AS (SELECT kind, key, payload FROM origin UNION ALL SELECT 'item', CAST(k AS VARCHAR), name || '|' || seg FROM rows_t WHERE k % 10 = 0 AND k % 20 <> 0)"


def replica_with_additions(spark, sf):
    base, origin, _ = states(spark, sf)
    c = table(spark, sf, "customer").where("c_custkey % 10 = 0 and c_custkey % 20 <> 0")
    extra = c.select(F.lit("item").alias("kind"), F.col("c_custkey").cast("string").alias("key"), F.concat_ws("|", "c_name", "c_mktsegment").alias("payload"))
    return base, origin, base.unionByName(extra)


@query("u04_additive_extras", f"WITH {EXTRAS} SELECT kind, key, payload FROM added EXCEPT SELECT kind, key, payload FROM origin")
def u04_additive_extras(spark, sf):
    return sn.additive_extras(*replica_with_additions(spark, sf))


@query("k12_union", f"WITH {EXTRAS} SELECT kind, key, payload FROM added")
def k12_union(spark, sf):
    return sn.union(*replica_with_additions(spark, sf))


@query("t01_advance_base", f"WITH {STATES}, votes AS (SELECT 'accepted' AS \"case\", n_nationkey < 1000 AS yes FROM nation UNION ALL SELECT 'refused', n_name <> 'NATION_7' FROM nation), told AS (SELECT \"case\", bool_and(yes) AS moves FROM votes GROUP BY ALL) SELECT \"case\", kind, key, payload FROM told, origin WHERE moves UNION ALL SELECT \"case\", kind, key, payload FROM told, base WHERE NOT moves")
def t01_advance_base(spark, sf):
    """Nations as peers: all accept the one proposal, one refuses the other."""
    base, origin, _ = states(spark, sf)
    peers = table(spark, sf, "nation").select(F.col("n_nationkey").alias("peer"), "n_name")
    out = None
    for name, vote in (("accepted", F.col("peer") < 1000), ("refused", F.col("n_name") != "NATION_7")):
        one = sn.advance_base(base, origin, peers.select("peer", vote.alias("accepted"))).select(F.lit(name).alias("case"), "kind", "key", "payload")
        out = one if out is None else out.unionByName(one)
    return out


@query("j31_remap_lookup", """WITH own AS (SELECT n_nationkey AS id, n_name AS name FROM nation WHERE n_nationkey % 3 <> 0), theirs AS (SELECT n_nationkey + 100 AS id, n_name AS name FROM nation),
used AS (SELECT DISTINCT c_nationkey + 100 AS id FROM customer WHERE c_custkey % 2 = 0), m AS (SELECT t.id AS old_id, min(o.id) AS known FROM theirs t SEMI JOIN used USING (id) LEFT JOIN own o ON t.name IS NOT DISTINCT FROM o.name GROUP BY ALL)
SELECT count(*) AS n, count(*) FILTER (known IS NULL) AS inserted, CAST(coalesce(sum(known), 0) AS BIGINT) AS known_sum, (SELECT max(id) FROM own) + count(*) FILTER (known IS NULL) AS top FROM m""")
def j31_remap_lookup(spark, sf):
    nation = table(spark, sf, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    theirs = nation.withColumn("id", F.col("id") + 100)
    used = table(spark, sf, "customer").where("c_custkey % 2 = 0").select((F.col("c_nationkey") + 100).cast("long").alias("id"))
    m = sn.remap_lookup(used, nation.where("id % 3 <> 0"), theirs, "id", ["name"])
    known = F.coalesce(F.sum(F.when(~F.col("inserted"), F.col("new_id"))), F.lit(0))
    return m.agg(F.count("*").alias("n"), F.sum(F.col("inserted").cast("long")).alias("inserted"), known.alias("known_sum"), F.max("new_id").alias("top"))


#: A library: regions and nations are collections, suppliers their items, customers attachments of suppliers.
@query("u06_trash_closure", "WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS key, CASE WHEN c_custkey % 4 = 0 THEN 'c' || (c_custkey // 4) ELSE 's' || (c_custkey % 10) END AS parent FROM customer), r AS (SELECT 's1' AS key UNION SELECT e.key FROM e JOIN r ON e.parent = r.key) SELECT key FROM r")
def u06_trash_closure(spark, sf):
    parent = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("c"), F.expr("c_custkey div 4"))).otherwise(F.concat(F.lit("s"), F.col("c_custkey") % 10))
    edges = table(spark, sf, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("key"), parent.alias("parent"))
    return sn.closure(edges, spark.createDataFrame([("s1",)], "key string")).select("key")


@query("u07_insertion_order", """WITH RECURSIVE e AS (SELECT c_custkey AS key, CASE WHEN c_custkey = 5 THEN 10 WHEN c_custkey = 10 THEN 5 WHEN c_custkey > 1 THEN c_custkey // 2 END AS parent FROM customer),
r AS (SELECT key, 0 AS depth FROM e WHERE parent IS NULL UNION ALL SELECT e.key, r.depth + 1 FROM e JOIN r ON e.parent = r.key) SELECT e.key, CAST(depth AS BIGINT) AS depth, depth IS NOT NULL AS reachable FROM e LEFT JOIN r USING (key)""")
def u07_insertion_order(spark, sf):
    k = F.col("c_custkey")
    nodes = table(spark, sf, "customer").select(k.alias("key"), F.when(k == 5, F.lit(10)).when(k == 10, F.lit(5)).when(k > 1, F.expr("c_custkey div 2")).alias("parent"))
    return sn.insertion_order(nodes).select("key", F.col("depth").cast("long").alias("depth"), "reachable")


@query("u08_collection_paths", "SELECT 'r' || r_regionkey AS key, r_name AS path FROM region UNION ALL SELECT 'n' || n_nationkey, r_name || ' / ' || n_name FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 's' || s_suppkey, r_name || ' / ' || n_name || ' / ' || s_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def u08_collection_paths(spark, sf):
    none = F.lit(None).cast("string")
    r = table(spark, sf, "region").select(F.concat(F.lit("r"), "r_regionkey").alias("key"), none.alias("parent"), F.col("r_name").alias("name"))
    n = table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("key"), F.concat(F.lit("r"), "n_regionkey").alias("parent"), F.col("n_name").alias("name"))
    s = table(spark, sf, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("key"), F.concat(F.lit("n"), "s_nationkey").alias("parent"), F.col("s_name").alias("name"))
    return sn.paths(r.unionByName(n).unionByName(s))


@query("u10_dangling", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 <> 0)")
def u10_dangling(spark, sf):
    return sn.dangling(table(spark, sf, "orders").select("o_orderkey", "o_custkey"), "o_custkey", table(spark, sf, "customer").where("c_custkey % 3 <> 0"), "c_custkey")


@query("j04_orphan_purge", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)")
def j04_orphan_purge(spark, sf):
    used = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return sn.orphans(table(spark, sf, "customer").select("c_custkey"), "c_custkey", used)


@query("u05_children_union", "SELECT s_nationkey AS key, 'supplier' AS kind FROM supplier UNION SELECT c_nationkey, 'customer' FROM customer UNION SELECT n_nationkey, 'nation' FROM nation")
def u05_children_union(spark, sf):
    s = table(spark, sf, "supplier").select(F.col("s_nationkey").alias("key"), F.lit("supplier").alias("kind"))
    c = table(spark, sf, "customer").select(F.col("c_nationkey").alias("key"), F.lit("customer").alias("kind"))
    n = table(spark, sf, "nation").select(F.col("n_nationkey").alias("key"), F.lit("nation").alias("kind"))
    return s.union(c).union(n).distinct()


@query("u11_unexpected_after_purge", f"WITH {STATES}, {delta_sql('d', 'base', 'origin')} SELECT kind, key, op FROM d WHERE op <> 'remove' OR kind <> 'item'")
def u11_unexpected_after_purge(spark, sf):
    base, origin, _ = states(spark, sf)
    purged = sections(spark, sf)[0].where("k % 11 = 0").select(F.lit("item").alias("kind"), F.col("k").cast("string").alias("key"))
    return sn.unexpected_after_purge(base, origin, purged)


@query("j01_inner_lookup", "SELECT c_custkey, c_name, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def j01_inner_lookup(spark, sf):
    out = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return out.select("c_custkey", "c_name", "n_name", "r_name")


@query("j02_trashed_flag", "SELECT c_custkey, d.o_custkey IS NOT NULL AS trashed FROM customer LEFT JOIN (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F') d ON c_custkey = o_custkey")
def j02_trashed_flag(spark, sf):
    gone = table(spark, sf, "orders").where("o_orderstatus = 'F'").select("o_custkey").distinct()
    return table(spark, sf, "customer").join(gone, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", F.col("o_custkey").isNotNull().alias("trashed"))


@query("j03_title_and_exists", "SELECT c_custkey, (SELECT min(o_orderpriority) FROM orders WHERE o_custkey = c_custkey) AS title, EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS trashed FROM customer")
def j03_title_and_exists(spark, sf):
    for name in ("customer", "orders"):
        table(spark, sf, name).createOrReplaceTempView(f"_j03_{name}")
    return spark.sql("SELECT c_custkey, (SELECT min(o_orderpriority) FROM _j03_orders WHERE o_custkey = c_custkey) AS title, EXISTS (SELECT 1 FROM _j03_orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') AS trashed FROM _j03_customer")


@query("j05_in_list", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT unnest(CAST(json('[1, 5, 9, 700, 100000]') AS BIGINT[])))")
def j05_in_list(spark, sf):
    keys = spark.sql("SELECT explode(from_json('[1, 5, 9, 700, 100000]', 'array<bigint>')) AS c_custkey")
    return table(spark, sf, "customer").join(keys, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("j06_stable_keys", "SELECT 'O' || o_orderkey AS key, 'C' || c_custkey AS parent FROM orders JOIN customer o ON true AND o.c_custkey = o_custkey WHERE o_orderkey % 5 = 0 UNION ALL SELECT 'O' || o_orderkey, 'C' || c_custkey FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) ON c_custkey = o_custkey WHERE o_orderkey % 5 <> 0")
def j06_stable_keys(spark, sf):
    orders, customer = table(spark, sf, "orders").select("o_orderkey", "o_custkey"), table(spark, sf, "customer").select("c_custkey")
    named = [F.concat(F.lit("O"), "o_orderkey").alias("key"), F.concat(F.lit("C"), "c_custkey").alias("parent")]
    on = F.col("c_custkey") == F.col("o_custkey")
    return orders.where("o_orderkey % 5 = 0").join(customer, on).select(*named).unionByName(orders.where("coalesce(o_orderkey % 5, 1) <> 0").join(customer.where("c_custkey % 2 = 0"), on, "left").select(*named))
