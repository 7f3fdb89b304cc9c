"""Steps that must not meet in one task, or be done twice, as tables grow."""

from __future__ import annotations

import glob

from pyspark.sql import functions as F

from folio.functions import text as tx
from folio.operators import acts, align, audit, deck, verify
from folio.storage import read_buckets, replace_buckets


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_citation_problems_stay_with_their_text(spark):
    texts = spark.createDataFrame([(1, [3, 9, 9], [1, 2, 4, 4, 4]), (2, None, [7]), (3, [5], None), (4, [], []), (None, [1], [1])], "doc int, cited array<int>, listed array<int>")
    found = verify.problem_sets(texts)
    assert "Exchange" not in plan(found)
    got = sorted((r.doc or 0, r.problem, sorted(r.ns)) for r in found.collect())
    assert got == [(1, "DANGLING", [3, 9]), (1, "DUPLICATE", [4]), (1, "GAP", [3]), (1, "UNCITED", [1, 2, 4]), (2, "GAP", [1, 2, 3, 4, 5, 6]), (2, "UNCITED", [7]), (3, "DANGLING", [5])]


def test_files_without_key_are_not_joined(spark):
    files = spark.createDataFrame([("a", "K1"), ("b", None), ("c", "K2"), ("d", "K3"), ("e", None)], "path string, key string")
    items = spark.createDataFrame([("K1", False), ("K2", True), (None, True)], "key string, trashed boolean")
    out = audit.mirror_state(files, items)
    assert sorted((r.path, r.state) for r in out.collect()) == [("a", "live"), ("b", "absent"), ("c", "trash"), ("d", "absent"), ("e", "absent")]
    assert "Union" in plan(out) and "isnull(key" in plan(out)


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 40000, 1, 8).select(F.concat(F.lit("same"), F.lit("")).alias("key"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    known = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        replace_buckets(spark, str(tmp_path / "t"), {"rows": (rows, "key", "v")}, list(range(4)), 4)
    finally:
        for k, v in known.items():
            spark.conf.set(k, v)
    assert len(glob.glob(f"{tmp_path}/t/v-*/rows/_bucket=*/*.parquet")) > 1
    assert read_buckets(spark, str(tmp_path / "t"), "key string, v string").distinct().count() == 40000


def test_gate_counts_without_findings(spark):
    from tests.test_deck import SCHEMA, shape

    own = spark.createDataFrame([shape(1, 1.0, 1.0, 2.0, 1.0, "a"), shape(2, 1.0, 1.0, 2.0, 1.0, "b", autofit=True), shape(1, 9.0, 1.0, 2.0, 1.0, "c", slide=2), shape(3, 1.0, None, 2.0, None, kind="card")], SCHEMA)
    counts = deck.lint_counts(own, 10.0, 5.6)
    assert "Generate inline" not in plan(counts)
    assert sorted(map(tuple, deck.deck_gate(own, counts).collect())) == sorted(map(tuple, deck.deck_gate(own, deck.lint(own, 10.0, 5.6)).collect())) == [(7, 2, 1, False)]


def test_attempts_are_cleaned_once(spark):
    links = spark.createDataFrame([(1, 1, "a", "u"), (1, 2, "b", "v"), (1, 3, "c", "w")], "id int, k int, label string, url string")
    long = "{1}---\nkept [x](http://y.z) " + "text " * 60 + "\n\n\n\nend \t\n"
    tries = spark.createDataFrame([("u", 0, "ERR_TIMED_OUT"), ("u", 1, long), ("u", 2, "later " * 90), ("v", 0, "Just a moment" + "." * 300), ("v", 1, None), ("w", 3, long)], "url string, attempt int, text string")
    out = acts.rendered(links, tries)
    assert {r.url: (r.state, r.text) for r in out.collect()} == {"u": ("kept", "kept x " + "text " * 60 + "\n\nend"), "v": ("missing", None), "w": ("missing", None)}
    assert not any("Filter" in x and "regexp_replace" in x for x in plan(out).splitlines())


def test_documents_are_aligned_in_batches(spark):
    rows = spark.createDataFrame([(1, "a", 5, "one two three"), (1, "a", 7, "gone"), (1, "b", 2, "one two threes"), (1, "b", 9, "new words here"), (2, "b", 1, "x"), (3, "a", 4, "same"), (3, "b", 4, "same")], "doc long, side string, pos long, text string")
    out = align.align_documents(rows)
    assert {tuple(r) for r in out.collect()} == {(1, 5, 2), (1, 7, None), (1, None, 9), (2, None, 1), (3, 4, 4)}
    assert "FlatMapGroupsInPandas" not in plan(out)


def test_plain_texts_are_not_translated(spark):
    texts = ["Plain TEXT 1", "Ünïcode Ёж ﬁne", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(tx.fold(F.col("t"))).collect()] == ["plain text 1", "unicode еж fine", "", ""]
    assert "octet_length" in plan(df.select(tx.fold(F.col("t"))))


def test_works_are_folded_once(spark):
    cited = spark.createDataFrame([(1, 1, "10.1/a", "Smith Title words here // Venue name")], "id int, n int, doi string, context string")
    works = spark.createDataFrame([("10.1/A", None, "Title words here", "Venue name", ["Smith"])], "doi string, error string, title string, venue string, families array<string>")
    out = verify.verify_citations(cited, works)
    assert [r.status for r in out.collect()] == ["OK"]
    above = plan(out).split("Join")[0]
    assert "wt#" in above and ".title" not in above


def test_state_of_a_union_without_its_sections(spark):
    from folio.plans import q_states
    from folio.sources import library

    raw = q_states.raw_tables(spark, "/root/testdata/sf0.001")
    raw["items"] = raw["items"].where("itemID < 300")
    even = F.col("itemID") % 20 < 10
    sides = [library.sections(raw | {"items": raw["items"].where(keep)}) for keep in (F.lit(False), even, ~even)]
    want = library.state(library.union(*sides))
    assert sorted(map(tuple, library.union_state(*sides).collect())) == sorted(map(tuple, want.collect())) and not want.isEmpty()


def test_pages_are_split_once(spark):
    from folio.operators import pages
    from folio.plans import lifts

    paginated = lifts.paginated(spark, "/root/testdata/sf0.001")
    assert plan(paginated).count("split(text") == 1
    docs = spark.createDataFrame([(1, "lost\n{3}" + "-" * 48 + "\none\n{4}" + "-" * 48 + "\ntwo"), (2, "no marks"), (3, None), (4, "{5}" + "-" * 48)], "id int, text string")
    for keep in (True, False):
        whole, arrays = pages.split_pages(docs, keep_unmarked=keep), pages.page_arrays(docs, keep_unmarked=keep)
        assert plan(whole).count("regexp_extract_all") == plan(arrays).count("regexp_extract_all") == 1
        assert sorted(map(str, whole.collect())) == sorted(map(str, arrays.select("id", F.inline("pages")).collect()))
    assert sorted(map(tuple, pages.split_pages(docs).where("id <> 3").collect())) == [(1, 3, "\none\n"), (1, 4, "\ntwo"), (2, 0, "no marks"), (4, 5, "")]


def test_quotes_elsewhere_stay_with_their_source(spark):
    from folio.plans import q_checks

    pages = [(0, "The quick brown\nfox jumps over it all"), (1, "so «The quick *brown* fox» jumps over it all — twice"), (2, "the quick brown fox"), (3, None), (4, "fox jumps over it all. The quick brown fox")]
    quotes = [(0, "The quick brown fox … fox jumps over it", [0]), (1, "The quick brown fox", [0, 1]), (2, "too short", [0]), (3, "it stands nowhere at all", [2]), (4, "The quick brown fox", []), (5, None, [0]), (6, "jumps over it all - twice", [1])]
    rows = spark.createDataFrame([(i, *q) for i in (1, 2, None) for q in quotes], "id int, n int, quote string, pages array<int>")
    kept = spark.createDataFrame([(1, pages), (2, pages[:1]), (None, pages)], "id int, source array<struct<page:int,body:string>>")
    carried = rows.join(kept, rows.id.eqNullSafe(kept.id)).select(rows.id, "n", "quote", "pages", verify.plain_bodies(F.col("source")).alias("source"))
    got = sorted(map(tuple, verify.elsewhere_in(carried).collect()))
    assert got == sorted(map(tuple, verify.elsewhere(rows, kept.select("id", F.inline("source"))).collect()))
    assert got == [(1, 0, 1), (1, 0, 4), (1, 1, 4), (1, 4, 0), (1, 4, 1), (1, 4, 4), (2, 4, 0)]

    sf = "/root/testdata/sf0.01"
    out = q_checks.j18_quotes_elsewhere(spark, sf)
    assert not any(x in plan(out) for x in ("Exchange", "Join", "Aggregate")) and plan(out).count("FileScan") == 1
    want = verify.elsewhere(q_checks.quotes(spark, sf), q_checks.pages(spark, sf))
    assert sorted(map(tuple, out.collect())) == sorted(map(tuple, want.collect())) and not want.isEmpty()


def test_alignment_is_dealt_to_all_partitions(spark):
    rows = spark.createDataFrame([(d, s, p, f"{d} text {p}") for d in range(20) for s in "ab" for p in range(3)], "doc int, side string, pos long, text string")
    out = align.align_documents(rows)
    assert "REPARTITION_BY_NUM" in plan(out)
    assert sorted(map(tuple, out.collect())) == [(d, p, p) for d in range(20) for p in range(3)]
