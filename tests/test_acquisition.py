"""Acquisition lists, scanned sheets and small predicates, with nulls, ties and nothing at all."""

import pytest
from pyspark.sql import functions as F

from folio.functions import records as rc
from folio.operators import acquisition as aq
from folio.operators import search, sheets, snapshots, verify


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def one(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


def test_lists(spark):
    src = one(spark, "path string, stem string", ("a/x.docx", "s"), ("a/y.doc", "s"), (None, "s"))
    assert rows(aq.work_list(src, one(spark, "path string", ("a/x.md",), ("b/y.md",), (None,)))) == [("a/x.docx", "s", True), ("a/y.doc", "s", False), (None, "s", False)]
    hits = one(spark, "q int, url string, title string", (2, "u", "b"), (1, "u", "a"), (3, None, "c"), (5, "v", None))
    assert rows(aq.first_hits(hits, "url", "q")) == [(1, "u", "a"), (5, "v", None)]
    asked, first, second = one(spark, "k int", (1,), (2,), (2,), (3,)), one(spark, "k int, hit int", (1, 10), (1, 11)), one(spark, "k int, hit int", (1, 99), (2, 20))
    assert rows(aq.with_fallback(asked, first, second, "k")) == [(1, 10), (1, 11), (2, 20)]
    names = one(spark, "g int, name string, k int", *((1, n, i) for i, n in enumerate("hgfedcba")), (2, "z", 1), (2, "z", 2))
    assert rows(aq.first_names(names, "g", ["name", "k"], "name")) == [(1, "a; b; c; d; e; f"), (2, "z; z")]
    assert rows(aq.refreshed(one(spark, "k int, v int", (1, 1)), one(spark, "k int, v int", (1, 0), (2, 0)), "k")) == [(1, 1), (2, 0)]
    items = one(spark, "key string, kind string", ("a", "book"), ("b", "note"), ("c", None))
    assert rows(aq.live_items(items, one(spark, "key string", ("a",), ("a",)), "key")) == [("a", True), ("c", False)]


def test_identifiers(spark):
    wanted = one(spark, "k int, doi string, arxiv string", (1, "10.1/A", "x"), (2, None, "2101.1v2"), (3, "", None), (4, "10.1/none", "2101.2V3"), (5, None, None))
    items = one(spark, "item int, doi string, arxiv string", (10, "10.1/a", None), (11, "10.1/a", "x"), (12, None, "2101.1v2"), (13, None, "2101.1"), (14, "", "2101.2"), (15, None, None))
    assert rows(aq.by_identifier(wanted, items)) == [(1, 10), (2, 12), (3, None), (4, 14), (5, None)]


def test_counts(spark):
    df = one(spark, "k int, n int, t string", (1, 5, "OK a"), (1, None, "skip"), (2, 0, None), (2, 5, "OK"))
    assert rows(aq.flow_counts(df, F.col("n") > 0)) == [(4, 2, 2)] and rows(aq.flow_counts(df.limit(0), F.col("n") > 0)) == [(0, 0, 0)]
    assert rows(aq.flow_numbers(df, {"all of it": F.lit(True), "with n": F.col("n") > 0})) == [("all of it", 4), ("with n", 2)]
    assert rows(aq.gross_and_distinct(df, "k", "n")) == [(1, 2, 1), (2, 2, 2)]
    assert rows(aq.log_rollup(df, "t", {"ok": "OK", "failed": "FAIL"})) == [(2, 0)]
    assert rows(aq.first_of_equal(df, "t", "n")) == [(0, 1), (5, 1), (5, 1), (None, 1)]
    assert rows(aq.canonical_sets(df, "k", "t").select("members")) == [(["OK a", "skip"],), (["OK"],)]
    logs = one(spark, "log int, path string, key int", (1, "b", 1), (1, None, 0), (1, "a", 3), (1, "a", 2))
    assert rows(aq.in_log_order(logs, "log", "path", "key").select("place", "path", "key")) == [(1, "a", 2), (2, "a", 3), (3, "b", 1), (4, None, 0)]
    urls = one(spark, "item int, best boolean, key int", (1, False, 1), (1, True, 2), (1, None, 0))
    assert rows(aq.in_url_order(urls, "item", "best", "key").select("place", "key")) == [(1, 2), (2, 0), (3, 1)]
    texts = one(spark, "k int, n int", *((i, 1500) for i in range(3)), (3, 1501), (4, 10), (5, None))
    assert rows(aq.text_audit(texts, "k", "n", more={"odd": F.col("k") == 3})) == [(0, ["same length"]), (1, ["same length"]), (2, ["same length"]), (3, ["odd"]), (4, ["short"])]


def test_conversations(spark):
    turns = one(spark, "conv_id int, turn int, role string, text string", (1, 1, "user", "hi"), (1, 0, "system", None), (2, 0, "user", "long text"))
    assert rows(aq.conversation_shapes(turns)) == [(1, "system user:2"), (2, "user:9")]
    assert rows(aq.any_turn(turns, F.length("text") > 5, "x")) == [(1, False), (2, True)]


def test_sheets(spark):
    lines = one(spark, "page int, x double, w double, conf double", (1, 1.0, 3.0, 0.2), (1, 6.0, 3.0, None), (2, 1.0, 6.0, None), (3, 6.0, 1.0, 0.9))
    x, r = F.col("x"), F.col("x") + F.col("w")
    assert rows(sheets.mean_confidence(lines, "page", F.col("conf"))) == [(1, 0.2), (2, None), (3, 0.9)]
    assert rows(sheets.doubtful_pages(sheets.mean_confidence(lines, "page", F.col("conf")), 0.5)) == [(1, 0.2)]
    assert rows(sheets.spreads(lines, "page", x, r, F.lit(10.0))) == [(1, True), (2, False), (3, False)]
    assert rows(sheets.spreads(lines, "page", x, r, F.lit(10.0), F.lit(9.0))) == [(1, False), (2, False), (3, False)]
    assert rows(sheets.worst_sheets(sheets.cut_lines(lines, "page", x, r, F.lit(5.0)), "page")) == [(2, 1)]
    refs = one(spark, "ref int, doc int", (1, 1), (1, 1), (1, 2), (2, 1), (3, None))
    assert rows(sheets.furniture_references(refs, "ref", "doc", 2)) == [(1, 2)]


def test_predicates(spark):
    df = one(spark, "t string", ("Article 1. x Article 2. signed by me",), ("",), (None,))
    n, first, last = rc.inventory(F.col("t"), r"Article \d")
    assert rows(df.select(n, first, last)) == [(0, None, None), (0, None, None), (2, "Article 1", "Article 2")]
    assert rows(df.select(rc.signed_end(F.col("t"), "signed", 12))) == [(False,), (False,), (True,)] and rows(df.select(rc.signed_end(F.col("t"), "Article 1", 12))) == [(False,)] * 3
    bodies = one(spark, "b string", ('{"metadata":{"count":7},"data":[1]}',), ('{"data":[1,2]}',), ("[1,2,3]",), ("{}",), (None,), ('{"0": {"key": "ABCD2345"}}',))
    assert [r[0] for r in bodies.select(rc.collection_size(F.col("b"))).collect()] == [7, 2, 3, -1, -1, -1]
    assert [r[0] for r in bodies.select(rc.item_key(F.col("b"))).collect()][-2:] == ["", "ABCD2345"]
    sizes = one(spark, "s double", (10.25,), (10.5,), (10.0,), (10.3,))
    assert [r[0] for r in sizes.where(rc.quarter_size(F.col("s"))).collect()] == [10.25]
    assert one(spark, "a int, b int", (None, 1)).select(rc.first_source({"a": F.col("a") == 1, "b": F.col("b") == 1}), rc.reasons({"no": F.col("a") == 1, "yes": F.col("b") == 1})).head()[:] == ("b", ["yes"])
    assert rows(df.where("t <> ''").select(rc.failed_render(F.concat("t", F.lit(" Just a moment"), F.repeat(F.lit("."), 300))), rc.failed_render(F.repeat(F.lit("."), 300)))) == [(True, False)]


def test_guards_votes_and_questions(spark):
    quotes = one(spark, "id int, n int", (1, 0), (1, 1))
    assert rows(verify.anchor_guard(one(spark, "id int, declared long", (1, 2)), quotes)) == [(1, 2, 2)]
    for declared in ((1, 3), (2, 1)):
        with pytest.raises(Exception, match="anchors without quotes"):
            verify.anchor_guard(one(spark, "id int, declared long", declared), quotes).collect()
    base, new = one(spark, "x int", (0,)), one(spark, "x int", (1,))
    vote = lambda *v: snapshots.advance_base(base, new, one(spark, "peer int, accepted boolean", *v)).head()[0]
    assert vote((1, True), (2, True)) == 1 and vote((1, True), (2, None)) == 0 and vote((1, True), (1, False)) == 0
    assert snapshots.advance_base(base, new, one(spark, "peer int, accepted boolean")).head()[0] == 0
    q = "Longer Question the the lónger straße"
    asked = one(spark, "q string", (q,), (None,)).select(search.question_terms(F.col("q"))).collect()
    assert [tuple(x) for x in asked[0][0]] == search.query_terms(q) and asked[1][0] == []
