"""Streams of answers, calls with their failures, and resumed ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from folio.sources import calls
from folio.storage import cut, new_path, read_buckets
from folio.streaming import ingest, relay

from .lifts import table
from .registry import query


def event_pieces(spark, sf):
    """Users as conversations whose events are pieces, twenty rounds each by the hour; a round's last piece has its end beside it."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("conv"), (F.hour("ts") % 20).cast("int").alias("round"), (F.col("event_id") % 3 - 1).cast("int").alias("index"), F.col("event_id").alias("seq"), "event_type", "props", "ts")
    e = e.select("conv", "round", "index", "seq", F.when((F.col("event_type") != "view") & (F.col("index") >= 0), F.col("event_type")).alias("name"), F.when(F.col("index") >= 0, F.col("props")).alias("arguments"), F.when(F.col("index") < 0, F.col("event_type")).alias("content"), F.lit(False).alias("ended"), F.col("ts").alias("at"))
    null = F.lit(None).cast("string")
    ends = e.groupBy("conv", "round").agg(F.max("seq").alias("seq"), F.max("at").alias("at")).where("round <> 7").select("conv", "round", F.lit(-1).alias("index"), (F.col("seq") + 1).alias("seq"), null.alias("name"), null.alias("arguments"), null.alias("content"), F.lit(True).alias("ended"), "at")
    return e.unionByName(ends)


RELAYED = """WITH e AS (SELECT user_id AS conv, CAST(hour(ts) % 20 AS INTEGER) AS round, CAST(event_id % 3 - 1 AS INTEGER) AS index, event_id AS seq, event_type, props FROM events)
SELECT conv, round, index, 'call' AS state, arg_max(event_type, seq) FILTER (event_type <> 'view' AND index >= 0) AS name, string_agg(CASE WHEN index < 0 THEN event_type ELSE props END, '' ORDER BY seq) AS arguments
FROM e WHERE round <> 7 AND (index = -1 OR round < 16) GROUP BY conv, round, index"""


@query("t06_assembled_calls", RELAYED)
def t06_assembled_calls(spark, sf):
    return relay.assembled(event_pieces(spark, sf))


@query("t06_relayed_calls", RELAYED)
def t06_relayed_calls(spark, sf):
    """The same as a stream of three batches of pieces and a last one of the ends."""
    source, out = new_path(spark, "pieces"), new_path(spark, "relayed")
    rows = event_pieces(spark, sf)
    for k in range(4):
        part = rows.where("ended") if k == 3 else rows.where((~F.col("ended")) & (F.pmod(F.xxhash64("seq"), F.lit(3)) == k))
        part.coalesce(1).write.parquet(f"{source}/{k}")
    stream = spark.readStream.schema(relay.PIECES).option("maxFilesPerTrigger", 1).parquet(f"{source}/*")
    run = relay.relay(stream, silence_ms=10**12).writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-check").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(relay.CALLS).parquet(out)


ATTEMPTS = """att AS (SELECT user_id AS id, event_id AS o, CASE event_type WHEN 'purchase' THEN 200 WHEN 'error' THEN 400 WHEN 'view' THEN 0 ELSE 429 END AS status, CASE WHEN value > 40 THEN 'x -32700' ELSE props END AS body, CASE WHEN value > 60 THEN value END AS ra FROM events)"""


@query("s17_replayed_calls", f"""WITH {ATTEMPTS}, r AS (SELECT id, list_reduce(list_prepend({{'over': false, 'ok': false, 'value': NULL::VARCHAR, 'error': NULL::VARCHAR, 'n': 0, 'waited': 0.0::DOUBLE, 'delay': 2.0::DOUBLE, 'status': 0, 'body': '', 'ra': 0.0::DOUBLE}},
 list({{'over': false, 'ok': false, 'value': NULL::VARCHAR, 'error': NULL::VARCHAR, 'n': 0, 'waited': 0.0::DOUBLE, 'delay': 2.0::DOUBLE, 'status': status, 'body': body, 'ra': ra::DOUBLE}} ORDER BY o)),
 lambda s, a: CASE WHEN s.over THEN s
  WHEN a.status = 200 THEN {{'over': true, 'ok': true, 'value': a.body, 'error': NULL, 'n': s.n + 1, 'waited': s.waited + 1.3, 'delay': s.delay, 'status': 0, 'body': '', 'ra': 0.0}}
  WHEN a.status = 429 AND s.n < 6 THEN {{'over': false, 'ok': false, 'value': NULL, 'error': NULL, 'n': s.n + 1, 'waited': s.waited + 1.3 + greatest(coalesce(a.ra, 0), s.delay), 'delay': least(2 * s.delay, 40.0), 'status': 0, 'body': '', 'ra': 0.0}}
  WHEN a.status = 0 AND s.n < 2 THEN {{'over': false, 'ok': false, 'value': NULL, 'error': NULL, 'n': s.n + 1, 'waited': s.waited + 1.3 + s.delay, 'delay': least(2 * s.delay, 40.0), 'status': 0, 'body': '', 'ra': 0.0}}
  WHEN a.status = 400 AND contains(a.body, '-32700') AND s.n < 2 THEN {{'over': false, 'ok': false, 'value': NULL, 'error': NULL, 'n': s.n + 1, 'waited': s.waited + 1.3 + s.delay, 'delay': s.delay, 'status': 0, 'body': '', 'ra': 0.0}}
  ELSE {{'over': true, 'ok': false, 'value': NULL, 'error': CASE a.status WHEN 0 THEN 'network' ELSE 'HTTP ' || a.status END, 'n': s.n + 1, 'waited': s.waited + 1.3, 'delay': s.delay, 'status': 0, 'body': '', 'ra': 0.0}} END) AS s FROM att GROUP BY id)
SELECT id, s.ok AS ok, s.value AS value, CASE WHEN NOT s.over THEN 'network' ELSE s.error END AS error, s.n AS attempts, round(s.waited, 6) AS waited FROM r""")  # fmt: skip
def s17_replayed_calls(spark, sf):
    status = F.when(F.col("event_type") == "purchase", 200).when(F.col("event_type") == "error", 400).when(F.col("event_type") == "view", 0).otherwise(429)
    rows = table(spark, sf, "events").select(F.col("user_id").alias("id"), F.col("event_id").alias("attempt"), status.alias("status"), F.when(F.col("value") > 40, "x -32700").otherwise(F.col("props")).alias("body"), F.when(F.col("value") > 60, F.col("value")).alias("retry_after"))
    return calls.replayed(rows).withColumn("waited", F.round("waited", 6))


def recorded(ok, value, error):
    """A worker that gives what is recorded in columns of the entry."""
    return lambda rows: rows.select("id", ok.alias("ok"), F.when(ok, value).alias("value"), F.when(~ok, error).alias("error"))


@query("s39_resumed_ingest", """WITH m AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS k, CASE o_orderpriority[1] WHEN '1' THEN 'arxiv' WHEN '2' THEN 'pdfurl' WHEN '3' THEN 'localfile' WHEN '4' THEN 'meta' ELSE 'paper' END AS kind, o_orderstatus AS s, o_totalprice AS p FROM orders),
f AS (SELECT *, kind = 'arxiv' AND p < 100000 AS no_meta, kind <> 'paper' AND NOT (kind = 'arxiv' AND p < 100000) AS has_key FROM m),
g AS (SELECT *, has_key AND NOT (kind = 'localfile' AND s = 'O') AS goes_on FROM f)
SELECT id, kind, CASE WHEN has_key THEN 'K' || k END AS key, CASE WHEN has_key AND kind IN ('arxiv', 'pdfurl') AND s <> 'P' THEN 'attached' WHEN goes_on AND kind = 'localfile' THEN 'verified' END AS file,
 CASE WHEN goes_on AND kind <> 'meta' THEN 'K' || k || '.md' END AS md, CASE WHEN goes_on AND kind <> 'meta' THEN 'ok' END AS note,
 CASE WHEN kind = 'paper' THEN 'unknown kind paper' WHEN no_meta THEN 'arxiv meta not found' WHEN kind IN ('arxiv', 'pdfurl') AND s = 'P' THEN 'no-pdf' WHEN kind = 'localfile' AND s = 'O' THEN 'local import failed' END AS error,
 coalesce(has_key AND (kind = 'meta' OR goes_on), false) AS complete FROM g""")  # fmt: skip
def s39_resumed_ingest(spark, sf):
    """Orders as a manifest of five kinds; the first run loses its network before notes are written, the second goes on."""
    kind = F.element_at(F.create_map(*[F.lit(x) for x in ("1", "arxiv", "2", "pdfurl", "3", "localfile", "4", "meta", "5", "paper")]), F.substring("o_orderpriority", 1, 1))
    manifest = cut(table(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("id"), kind.alias("kind"), "o_orderstatus", "o_totalprice"))
    yes, status = F.lit(True), F.col("o_orderstatus")
    workers = {
        "metadata": recorded(F.col("o_totalprice") >= 100000, F.lit("found"), F.lit("arxiv meta not found")),
        "item": recorded(yes, F.concat(F.lit("K"), "id"), F.lit("")),
        "file": recorded(status != "P", F.lit("attached"), F.lit("no-pdf")),
        "attachment": recorded(status != "O", F.lit("verified"), F.lit("local import failed")),
        "text": recorded(yes, F.concat(F.col("done")["item"], F.lit(".md")), F.lit("")),
        "note": recorded(yes, F.lit("ok"), F.lit("")),
    }
    path = new_path(spark, "ingest")
    ingest.advance(spark, path, manifest, {k: w for k, w in workers.items() if k != "note"}, buckets=8)
    ingest.advance(spark, path, manifest, workers)
    return ingest.summary(manifest, read_buckets(spark, path, ingest.STATE))


@query("t05_page_texts", """WITH l AS (SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderkey AS page, o_totalprice AS p, o_orderstatus AS s FROM orders),
b AS (SELECT id, page, CASE WHEN s <> 'P' AND p < 180000 THEN 'text of ' || page END AS v FROM l)
SELECT id, string_agg('{' || page || '}' || repeat('-', 48) || chr(10) || chr(10) || coalesce(v, '*[OCR FAILED FOR THIS PAGE]*'), chr(10) || chr(10) ORDER BY page) AS text, count(*) FILTER (v IS NULL) AS failed FROM b GROUP BY id""")
def t05_page_texts(spark, sf):
    """Customers as documents whose orders are pages: dear ones are refused unless they are shrunk enough, open ones have no endpoint."""
    pages = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderkey").cast("int").alias("page"), "o_totalprice", "o_orderstatus")

    def read(rows):
        down = F.col("o_orderstatus") == "P"
        ok = ~down & (F.col("o_totalprice") * F.col("shrink") < 180000 * 0.65)
        return rows.select("id", "page", ok.alias("ok"), F.when(ok, F.concat(F.lit("text of "), "page")).alias("value"), F.when(~ok, "refused").alias("error"), down.alias("down"))

    path = new_path(spark, "pages")
    ingest.read_pages(spark, path, pages, read, buckets=8)
    return ingest.page_texts(pages, read_buckets(spark, path, ingest.STATE))
