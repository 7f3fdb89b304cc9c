"""Streamed calls cut at any batch border, calls that fail as rows, and ingest that goes on where it was killed."""

import datetime
import itertools
import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from folio.sources import calls
from folio.storage import read_buckets
from folio.streaming import ingest, relay

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import the tests
T0 = datetime.datetime(2026, 1, 1)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def piece(conv, number, index, seq, name=None, arguments=None, content=None, ended=False, at=0):
    return (conv, number, index, seq, name, arguments, content, ended, T0 + datetime.timedelta(seconds=at))


def streamed(spark, tmp_path, batches, silence_ms=10**11):
    source = tmp_path / "in"
    out = []
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        for k, batch in enumerate(batches):
            spark.createDataFrame(batch, relay.PIECES).coalesce(1).write.parquet(str(source / f"{k:02}"))
            stream = spark.readStream.schema(relay.PIECES).parquet(str(source / "*"))
            run = relay.relay(stream, silence_ms).writeStream.foreachBatch(lambda df, _: out.extend(map(tuple, df.collect())))
            run.option("checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination(60)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    return sorted(out, key=str)


PIECES = [
    piece(1, 0, relay.TEXT, 1, content="Hel"), piece(1, 0, relay.TEXT, 2, content="lo"), piece(1, 0, 0, 3, name="find"), piece(1, 0, 0, 4, arguments='{"q":'), piece(1, 0, 1, 5, name="fetch", arguments="{}"),
    piece(1, 0, 0, 6, arguments='"x"}'), piece(1, 0, 0, 7, name="search", arguments=None), piece(1, 16, 0, 1, name="too late", arguments="{}"), piece(1, 16, relay.TEXT, 2, content="end"), piece(2, 0, 0, 1, name="open"),
]
ENDS = [piece(1, 0, relay.TEXT, 8, ended=True), piece(1, 16, relay.TEXT, 3, ended=True)]
WANT = sorted([(1, 0, -1, "call", None, "Hello"), (1, 0, 0, "call", "search", '{"q":"x"}'), (1, 0, 1, "call", "fetch", "{}"), (1, 16, -1, "call", None, "end")], key=str)


def test_one_batch(spark):
    df = spark.createDataFrame(PIECES + ENDS, relay.PIECES)
    assert rows(relay.assembled(df)) == WANT and rows(relay.assembled(df.limit(0))) == []


@pytest.mark.parametrize("cut", [(3, 8), (1, 5)])
def test_any_batches(spark, tmp_path, cut):
    borders = [0, *cut, len(PIECES)]
    batches = [PIECES[a:b] for a, b in itertools.pairwise(borders)]
    batches[-1] = batches[-1] + ENDS + PIECES[:2]  # repeated pieces change nothing
    assert streamed(spark, tmp_path, batches) == WANT


def test_late_pieces_and_silence(spark, tmp_path):
    late = piece(1, 0, 0, 9, name="x", arguments="late", at=1)
    far = [piece(9, 0, 0, 1, name="other", at=5000)]
    got = streamed(spark, tmp_path, [PIECES + ENDS, [late], far, [piece(9, 0, 0, 2, arguments="", at=9000)]], silence_ms=60_000)
    assert [g for g in got if g[3] == "call"] == WANT
    assert [g for g in got if g[3] == "late"] == [(1, 0, 0, "late", "x", "late")]
    assert (2, 0, 0, "open", "open", "") in got


def test_lines_of_an_event_stream(spark):
    delta = lambda d: "data: " + json.dumps({"choices": [{"delta": d}]})
    lines = [delta({"content": "Hi"}), ": ping", delta({"tool_calls": [{"index": 1, "function": {"name": "f", "arguments": "{"}}]}), "data: {broken", delta({"tool_calls": [{"index": 1, "function": {"arguments": "}"}}]}), "data: [DONE]", ""]
    df = spark.createDataFrame([(5, 0, i, T0, x) for i, x in enumerate(lines)], "conv long, round int, seq long, at timestamp, line string")
    assert rows(relay.assembled(relay.pieces(df))) == [(5, 0, -1, "call", None, "Hi"), (5, 0, 1, "call", "f", "{}")]


def attempts(*answers):
    """Recorded answers and a live service that gives them."""
    left = list(answers)

    def ask(tool, args):
        if not left:
            raise ConnectionError("gone")
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return a

    return ask


A = calls.Answer
CASES = [
    ([A(200, "fine")], (True, "fine", None, 1, 1.3)),
    ([A(429), A(429, retry_after=9.0), A(200, "ok")], (True, "ok", None, 3, 3.9 + 2 + 9)),
    ([A(429)] * 9, (False, None, "HTTP 429", 7, 7 * 1.3 + 2 + 4 + 8 + 16 + 32 + 40)),
    ([A(0), A(0), A(200, "back")], (True, "back", None, 3, 3.9 + 2 + 4)),
    ([A(0)] * 5, (False, None, "network", 3, 3.9 + 2 + 4)),
    ([A(400, "error -32700"), A(200, "x")], (True, "x", None, 2, 2.6 + 2)),
    ([A(400, "bad")], (False, None, "HTTP 400", 1, 1.3)),
    ([A(500, "bad")], (False, None, "HTTP 500", 1, 1.3)),
]


def test_calls_are_rows(spark):
    recorded = [(i, k, a.status, a.body, a.retry_after) for i, (answers, _) in enumerate(CASES) for k, a in enumerate(answers)]
    df = spark.createDataFrame(recorded, "id int, attempt int, status int, body string, retry_after double").repartition(3)
    got = {r.id: (r.ok, r.value, r.error, r.attempts, round(r.waited, 6)) for r in calls.replayed(df).collect()}
    assert got == {i: (*want[:4], round(want[4], 6)) for i, (_, want) in enumerate(CASES)}
    asked = spark.createDataFrame([(i, "t", str(i)) for i in range(len(CASES))] + [(99, "t", "boom")], "id int, tool string, args string")
    script = [answers for answers, _ in CASES]
    served: dict[str, object] = {}

    def ask(tool, args):
        if args == "boom":
            raise ValueError("not the network's fault")
        return served.setdefault(args, attempts(*script[int(args)]))(tool, args)

    live = {r.id: (r.ok, r.value, r.error, r.attempts, round(r.waited, 6)) for r in calls.called(asked, ask, sleep=lambda s: None).collect()}
    assert live.pop(99)[:3] == (False, None, "ValueError(\"not the network's fault\")") and live == got


MANIFEST = "id string, kind string, text_path string"
ENTRIES = [("a", "arxiv", None), ("b", "meta", None), ("c", "localfile", "c.md"), ("d", "odd", None), ("e", "pdfurl", None), ("e", "pdfurl", "x"), (None, "meta", None)]


def test_ingest_goes_on_where_it_was_killed(spark, tmp_path):
    path, asked = str(tmp_path / "state"), []
    manifest = spark.createDataFrame(ENTRIES, MANIFEST)

    def worker(step, fail=()):
        def work(df):
            asked.append((step, sorted(r.id for r in df.collect())))
            ok = ~F.col("id").isin(list(fail)) if fail else F.lit(True)
            return df.select("id", ok.alias("ok"), F.when(ok, F.concat(F.lit(f"{step} of "), "id")).alias("value"), F.when(~ok, F.lit("failed")).alias("error"))

        return work

    def killed(df):
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        ingest.advance(spark, path, manifest, {"metadata": worker("metadata"), "item": worker("item"), "file": killed}, buckets=4)
    assert asked == [("metadata", ["a"]), ("item", ["a", "b", "c", "e"])]
    asked.clear()
    steps = {s: worker(s, fail={"file": ["e"], "attachment": ["c"]}.get(s, ())) for s in ingest.STEPS}
    ingest.advance(spark, path, manifest, steps)
    assert asked == [("metadata", []), ("item", []), ("file", ["a", "e"]), ("attachment", ["c"]), ("text", ["a", "e"]), ("note", ["a", "e"])]
    facts = {r.id: r for r in ingest.summary(manifest, read_buckets(spark, path, ingest.STATE)).collect()}
    assert {i for i, r in facts.items() if r.complete} == {"a", "b", "e"}
    assert facts["d"].error == "unknown kind odd" and facts["c"].error == "failed" and facts["e"].file is None and facts["a"].key == "item of a"
    asked.clear()
    ingest.advance(spark, path, manifest, {s: worker(s) for s in ingest.STEPS})
    assert asked[3:] == [("attachment", ["c"]), ("text", ["c"]), ("note", ["c"])]
    state = {(r.id, r.step): r.tries for r in read_buckets(spark, path, ingest.STATE).collect()}
    assert state["c", "attachment"] == 2 and state["a", "item"] == 1


def test_pages_are_read_once(spark, tmp_path):
    path, seen = str(tmp_path / "pages"), []
    pages = spark.createDataFrame([("x", p) for p in range(5)], "id string, page int")

    def read(down, size):
        def work(df):
            seen.append(sorted((r.page, r.shrink) for r in df.collect()))
            bad, refused = F.col("page").isin(down), F.col("page") * F.col("shrink") > size
            ok = ~bad & ~refused
            return df.select("id", "page", ok.alias("ok"), F.when(ok, F.concat(F.lit("p"), "page")).alias("value"), F.when(~ok, "no").alias("error"), bad.alias("down"))

        return work

    assert ingest.read_pages(spark, path, pages, read([1], 3), buckets=2) == {"read": 4, "refused": 0, "down": 1}
    assert seen == [[(p, 1.0) for p in range(5)], [(4, 0.8)], [(4, 0.65)]] and seen.clear() is None
    text = ingest.page_texts(pages, read_buckets(spark, path, ingest.STATE)).head()
    assert text.failed == 1 and text.text.count(ingest.FAILED_PAGE) == 1 and text.text.endswith("p4")
    ingest.read_pages(spark, path, pages, read([], 3))
    assert seen == [[(1, 1.0)]]
    assert ingest.page_texts(pages, read_buckets(spark, path, ingest.STATE)).head().failed == 0
