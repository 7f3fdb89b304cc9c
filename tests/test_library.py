"""Operators on hand-made cases with known outcomes."""

import json
import sqlite3

import pytest
from pyspark.sql import functions as F

from folio.functions import text as tx
from folio.operators import align, discovery, geometry, lint, markup, overlap, pages, search, snapshots, verify
from folio.sources import readers, sinks
from folio.storage import current_version, read_buckets, read_table, swap_table
from folio.streaming import jobs


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_fold_keeps_cyrillic(spark):
    df = spark.createDataFrame([("Чёрный ЙОД, Übermaß №5 naïve",), (None,)], "t string")
    assert [r[0] for r in df.select(tx.words("t")).collect()] == [["черныи", "иод", "uberma", "5", "naive"], []]
    assert spark.createDataFrame([("Ångström ﬂuß",)], "t string").select(tx.fold_exact("t")).head()[0] == "angstrom fluß"


def test_runs_merge_when_they_touch(spark):
    h = [(1, p, 100 + p) for p in (0, 1, 2, 3, 4, 5, 13, 22)] + [(2, p, 100 + p) for p in (0, 1, 2, 3, 4, 5, 13, 22)]
    sides = spark.createDataFrame([(1, 2)], "src long, dst long")
    got = overlap.shared_runs(spark.createDataFrame(h, "id long, pos int, h long"), sides, k=8, min_run=1)
    assert rows(got.select("start", "end")) == [(0, 21), (22, 30)]  # 13 - 5 = 8 merges, 22 - 13 = 9 splits


@pytest.mark.parametrize(
    ("paras", "want"),
    [
        (["a" * 60, "b" * 900], ["a" * 60, "b" * 900]),
        (["a" * 59, "b" * 70], ["a" * 59 + "\n\n" + "b" * 70]),
        (["b" * 901], ["b" * 901]),
        (["b" * 880, "h" * 59, "c" * 100], ["b" * 880, "h" * 59 + "\n\n" + "c" * 100]),
        (["b" * 100, "tail"], ["b" * 100 + "\n\ntail"]),
        (["only"], ["only"]),
        ([], []),
    ],
)
def test_chunks(spark, paras, want):
    df = spark.createDataFrame([("\n\n".join(paras),)], "body string")
    assert df.select(pages.chunks_of(F.col("body"))).head()[0] == want


def test_pages_drop_what_precedes_the_first_mark(spark):
    mark = lambda n: "{%d}%s" % (n, "-" * 48)
    df = spark.createDataFrame([(1, f"lost\n{mark(3)}\none\n{mark(4)}\ntwo"), (2, "no marks")], "id long, text string")
    assert rows(pages.split_pages(df)) == [(1, 3, "\none\n"), (1, 4, "\ntwo"), (2, 0, "no marks")]


def test_bm25_agrees_with_fts5(spark):
    texts = {1: "red fox and a dog", 2: "the quick red fox jumps", 3: "nothing here", 4: "foxes foxglove red red", 5: "a dog", 6: "blue sea"}
    con = sqlite3.connect(":memory:")
    try:
        con.execute("create virtual table t using fts5(x)")
    except sqlite3.OperationalError:
        pytest.skip("no fts5")
    con.executemany("insert into t(rowid, x) values (?, ?)", texts.items())
    want = dict(con.execute("select rowid, -bm25(t) from t where t match '\"red\" OR \"foxglo\"*'").fetchall())
    df = spark.createDataFrame(list(texts.items()), "cid long, text string")
    got = {r.cid: r.score for r in search.bm25(search.postings(df), "red foxglove").collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


def test_fusion_order(spark):
    lists = [spark.createDataFrame([(c, 1.0, k) for k, c in enumerate(x)], "cid string, score double, rank int") for x in ("abc", "bd")]
    got = search.fuse(lists).orderBy(F.desc("rrf_score"), "first").collect()
    assert [r.cid for r in got] == ["b", "a", "d", "c"] and abs(got[1].rrf_score - 1 / 61) < 1e-12


def state(spark, **items):
    return spark.createDataFrame([("item", k, v) for k, v in items.items()] or [], "kind string, key string, payload string")


def test_classifier(spark):
    base, more, other = state(spark, A="1"), state(spark, A="1", B="2"), state(spark, A="x")
    mode = lambda *x: snapshots.classify(*x).head()["mode"]
    assert mode(base, base) == "equal" and mode(base, more) == "conflict"
    assert mode(base, more, base) == "replica_fast_forward" and mode(more, base, base) == "origin_fast_forward"
    assert mode(other, state(spark, A="y"), base) == "conflict" and mode(more, state(spark, A="1", C="3"), base) == "conflict"
    assert mode(base, state(spark), base) == "replica_fast_forward"


def test_union_refuses_changes(spark):
    base = state(spark, A="1")
    got = snapshots.union(base, state(spark, A="1", O="o"), state(spark, A="1", R="r"))
    assert rows(got.select("key")) == [("A",), ("O",), ("R",)]
    with pytest.raises(Exception, match="not a disjoint union"):
        snapshots.union(base, base, state(spark, A="changed")).collect()


def test_trees_with_a_cycle(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("x", "y"), ("y", "x")], "key string, parent string")
    got = {r.key: (r.depth, r.reachable) for r in snapshots.insertion_order(nodes).collect()}
    assert got == {"a": (0, True), "b": (1, True), "c": (2, True), "x": (None, False), "y": (None, False)}
    assert rows(snapshots.closure(nodes, spark.createDataFrame([("x",)], "key string")).select("key")) == [("x",), ("y",)]


def test_resolution_needs_a_year(spark):
    wanted = spark.createDataFrame([("1", "A history of banks", "Bölte", None), ("2", "A history of banks", "Bölte", 2001)], "id string, title string, author string, year int")
    cand = spark.createDataFrame([(i, k, f"d{k}", t, "Bolte", 2000) for i in "12" for k, t in enumerate(["Other", "A history of banks"])], "id string, pos int, doi string, title string, family string, year int")
    got = {r.id: (r.doi, r.overlap, r.resolved) for r in discovery.best_candidates(wanted, cand).collect()}
    assert got == {"1": ("d1", 1.0, False), "2": ("d1", 1.0, True)}


def test_citations(spark):
    df = spark.createDataFrame([("15–17; 21",), ("28-26",), ("5",)], "g string")
    assert [r[0] for r in df.select(verify.expand_citations(F.col("g"))).collect()] == [[15, 16, 17, 21], [26, 27, 28], [5]]
    cited = spark.createDataFrame([(1, 1), (1, 9)], "doc int, n int")
    listed = spark.createDataFrame([(1, n) for n in (1, 2, 4, 4)], "doc int, n int")
    assert rows(verify.citation_problems(cited, listed)) == [(1, "DANGLING", 9), (1, "DUPLICATE", 4), (1, "GAP", 3), (1, "UNCITED", 2), (1, "UNCITED", 4)]


def test_stable_keys_of_all_orders(spark, tmp_path):
    from folio.plans import q_snapshots

    spark.createDataFrame([(k, 1 + k % 4) for k in range(1, 21)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(k,) for k in range(1, 5)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    got = q_snapshots.j06_stable_keys(spark, str(tmp_path)).collect()
    want = {f"O{k}": f"C{1 + k % 4}" if k % 5 == 0 or k % 2 else None for k in range(1, 21)}
    assert len(got) == 20 and {r.key: r.parent for r in got} == want


def test_citations_of_all_customers(spark, tmp_path):
    from folio.plans import q_checks

    orders = [(k, 1 + k * 7 % 23) for k in range(1, 200)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    cited, want = {(c, n) for k, c in orders for n in ([k % 50, k % 50 + 1, k % 50 + 2] if k % 3 == 0 else [k % 50])}, []
    for c in {c for _, c in orders}:
        own, entries = {n for d, n in cited if d == c}, {n for n in range(1, 46) if n % 9}
        want += [(c, "DANGLING", n) for n in own - entries] + [(c, "UNCITED", n) for n in entries - own] + [(c, "GAP", n) for n in (9, 18, 27, 36)] + [(c, "DUPLICATE", 7)]
    told = lambda *kinds: sorted(x for x in want if x[1] in kinds)
    short = lambda found: [(c, n) for c, _, n in found]
    sf = str(tmp_path)
    assert rows(q_checks.u13_expand_citations(spark, sf)) == sorted(cited)
    assert rows(q_checks.j19_dangling_and_uncited(spark, sf)) == told("DANGLING", "UNCITED")
    assert rows(q_checks.j20_gaps(spark, sf)) == short(told("GAP"))
    assert rows(q_checks.w13_duplicate_entries(spark, sf)) == short(told("DUPLICATE"))
    kinds = {(c, p) for c, p, _ in want}
    assert rows(q_checks.g15_citation_integrity(spark, sf)) == sorted((c, p, sum(x[:2] == (c, p) for x in want)) for c, p in kinds)


def test_quotes_and_their_negative_control(spark):
    pages_ = spark.createDataFrame([(1, 5, "The quick brown fox jumps"), (1, 6, "over the lazy dog and sleeps")], "id int, page int, body string")
    draft = spark.createDataFrame([(1, "> «The quick *brown* fox jumps over the lazy dog»\n> — p. 5–6\n\n> another that is not there at all — p. 5\n")], "id int, text string")
    quotes = verify.quote_rows(draft)
    assert rows(verify.check_quotes(quotes, pages_).select("n", "ok")) == [(0, True), (1, False)]
    bad = quotes.where("n = 0").withColumn("quote", verify.corrupted(F.col("quote")))
    assert rows(verify.check_quotes(bad, pages_).select("ok")) == [(False,)]


def test_participle_rate(spark):
    df = spark.createDataFrame([("running text was Walking past a king with nothing",)], "t string")
    assert df.select(lint.matching_forms(F.col("t"), ["ing$"], ["^(king|nothing)$"])).head()[0] == ["running", "Walking"]


def test_sentences_respect_abbreviations(spark):
    df = spark.createDataFrame([("See fig. Two is here. A. Smith agrees! Yes.",)], "t string")
    assert df.select(lint.sentences(F.col("t"), ["fig"])).head()[0] == ["See fig. Two is here.", "A. Smith agrees!", "Yes."]


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<ol><li>first<ol><li>inner a<li>inner b</ol></li><li>second</ol>", "1. first\n\n   1. inner a\n\n   2. inner b\n\n2. second"),
        ("<ol start=7><li>seven</li><li>eight</li></ol><p>after</p>", "7. seven\n\n8. eight\n\nafter"),
        ("<div>lead<ul><li>dot</li></ul>tail</div>", "lead\n\n- dot\n\ntail"),
        ("<h3>A  <i>slanted</i>\nhead</h3><p>one<br>two  three</p>", "### A *slanted* head\n\none  \ntwo three"),
        ("<p><b>bold</b><b>er</b> and <a href='u'>link</a> <b> </b></p>", "**bolder** and [link](u)"),
        ("<p>x<sup>2</sup> &amp; y</p><script>no</script>", "x^2^ & y"),
    ],
)
def test_html_to_markdown(html, want):
    assert markup.to_markdown(html) == want


def test_only_tables_are_converted():
    md = "## H\n\nFirst.\n\n<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>\n\nSecond."
    assert markup.tables_to_pipes(md) == "## H\n\nFirst.\n\n| a | b |\n| --- | --- |\n| 1 | 2 |\n\nSecond."
    assert markup.tables_to_pipes("- x\n  y\n\nz") == "- x\n  y\n\nz"


def test_similarity_is_no_edit_distance():
    assert align.similarity("tide", "diet") == 0.25 and align.similarity("diet", "tide") == 0.5


def test_all_verdicts(spark):
    texts = lambda *t: spark.createDataFrame([(1, k, x) for k, x in enumerate(t)], "doc long, pos long, text string")
    sent = texts("alpha beta gamma delta", "one two three four", "red green blue black", "north south east west", "up down left right")
    returned = texts("alpha beta gamma delta!", "one two three four", "red green blue grey", "north south east west 1", "added by the editor", "up down left right")
    master = texts("alpha beta gamma delta", "one two three four 2", "red green blue grey", "north south east west 2", "up down left right", "wholly new paragraph")
    got = {(r.verdict, r.pos) for r in align.three_way(sent, returned, master).collect()}
    assert got == {("ACCEPT", 0), ("MINE", 1), ("CONVERGED", 2), ("CONFLICT", 3), ("ADDED", 4), ("NEW", 5)}


def test_clusters_and_gaps(spark):
    df = spark.createDataFrame([([1.0, 1.04, 1.2, 1.23, 3.0],)], "v array<double>")
    got = df.select(geometry.greedy_clusters(F.col("v"), 0.05)).head()[0]
    assert [(c.rep, c.n) for c in got] == [(1.0, 2), (1.2, 2), (3.0, 1)]


def test_sqlite_source(spark, tmp_path):
    path = str(tmp_path / "lib.sqlite")
    con = sqlite3.connect(path)
    con.execute("create table items(id int, name text)")
    con.executemany("insert into items values (?, ?)", [(1, "a"), (2, None)])
    con.commit()
    con.close()
    assert rows(readers.library_section(spark, path, "select id, name from items where id = 1", "id long, name string")) == [(1, "a")]


def test_corpus_walk(spark, tmp_path):
    for name, text in (("topic/A8NY6TA6_x.md", "# Title\nbody"), ("topic/a b Юг.md", "# T\n"), ("README.md", "no"), ("storage/x.md", "no"), ("a.txt", "no")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    got = pages.document_rows(readers.corpus(spark, str(tmp_path))).collect()
    assert [(r.path, r.title) for r in got if r.key != "A8NY6TA6"] == [("topic/a b Юг.md", "T")]
    assert [(r.path, r.key, r.title) for r in got if r.key == "A8NY6TA6"] == [("topic/A8NY6TA6_x.md", "A8NY6TA6", "Title")]
    assert {r.path for r in got} < {r.path for r in readers.listing(spark, str(tmp_path)).collect()}


def test_byte_budget(spark):
    df = spark.createDataFrame([("é" * 3000,), ("short",)], "t string")
    got = [r[0] for r in df.select(sinks.byte_budget(F.col("t"), F.lit(100))).collect()]
    assert len(got[0].encode()) + 100 <= 3500 and len(got[0]) == 1600 and got[1] == "short"


def test_streamed_log_equals_the_batch_result(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    records = [(1, 1, "new", ["a"]), (2, 2, "", None), (1, 3, "", ["b"]), (1, 4, "done", None), (2, 5, "x", ["d", "c", "c"])]
    schema = "id long, seq long, status string, attempts array<string>"
    table, check = str(tmp_path / "log"), str(tmp_path / "check")
    for k in range(0, len(records), 2):
        (source / f"{k}.json").write_text("\n".join(json.dumps(dict(zip(("id", "seq", "status", "attempts"), r, strict=True))) for r in records[k : k + 2]))
        stream = spark.readStream.schema(schema).json(str(source))
        jobs.upsert_log(stream, table, check, "id", "seq", ["status"], "attempts").awaitTermination()
    got = rows(jobs.log_rows(spark, table, "id", ["status"], "attempts"))
    want = rows(discovery.merge_log(spark.createDataFrame(records, schema), "id", "seq", ["status"], "attempts"))
    assert got == want == [(1, "done", ["a", "b"]), (2, "x", ["d", "c", "c"])]


def test_streamed_index_skips_the_unchanged(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    table, check = str(tmp_path / "index"), str(tmp_path / "check")
    for k, docs in enumerate(([("a", "1"), ("b", "1")], [("a", "1"), ("b", "2"), ("c", "1")])):
        (source / f"{k}.json").write_text("\n".join(json.dumps({"path": p, "sha256": s}) for p, s in docs))
        jobs.index_changes(spark.readStream.schema("path string, sha256 string").json(str(source)), table, check).awaitTermination()
    assert [(r.path, r.sha256, r.batch == 0) for r in read_buckets(spark, table, jobs.INDEXED).orderBy("path").collect()] == [("a", "1", True), ("b", "2", False), ("c", "1", False)]


def test_a_killed_swap_leaves_the_table(spark, tmp_path):
    table = str(tmp_path / "t")
    swap_table(spark, spark.createDataFrame([(1,)], "x int"), table)
    with pytest.raises(Exception, match="boom"):
        swap_table(spark, spark.range(1).select(F.raise_error(F.lit("boom")).cast("int").alias("x")), table)
    assert rows(read_table(spark, table, "x int")) == [(1,)]
    for k in (2, 3, 4):  # reading what it replaces
        swap_table(spark, read_table(spark, table, "x int").select((F.col("x") * 0 + k).alias("x")), table)
    assert rows(read_table(spark, table, "x int")) == [(4,)]
    assert len(list((tmp_path / "t").glob("v-*"))) <= 3 and current_version(spark, str(tmp_path / "none")) is None


def test_search_in_any_script(spark):
    texts = {1: "La oración y las canciones", 2: "قال القرآن كلمة", 3: "der Straßenbau ﬁnanziert", 4: "nothing"}
    index = search.postings(spark.createDataFrame(list(texts.items()), "cid long, text string"))
    found = lambda q: sorted(r.cid for r in search.bm25(index, q).collect())
    assert found("oración") == found("ORACION") == [1] and found("canciónes") == [1]
    assert found("القرآن") == [2] and found("Straßenbau finanz") == [3] and found("?") == []


def test_a_stored_index_answers_alike(spark, tmp_path):
    docs = spark.createDataFrame([(k, f"word{k % 5} common term{k % 3}") for k in range(40)], "cid long, text string")
    search.write_index(docs, str(tmp_path / "ix"))
    round_ = lambda df: sorted((r.cid, round(r.score, 9)) for r in df.collect())
    assert round_(search.ask_index(spark, str(tmp_path / "ix"), "word2 termin")) == round_(search.bm25(search.postings(docs), "word2 termin")) != []


def test_rerank_by_another_model(spark):
    letters = lambda t: F.transform(F.split(F.lit("a b c"), " "), lambda c: F.regexp_count(t, c).cast("double"))
    passages = spark.createDataFrame([(1, "aaab"), (2, "ccc"), (3, "abab")], "cid long, text string")
    hits = spark.createDataFrame([(1, 1.0), (2, 3.0), (3, 2.0)], "cid long, score double")
    got = search.rerank(hits, passages, "bbb", letters, candidates=2, n=2)
    assert [r.cid for r in got.collect()] == [3, 2]


def test_entry_and_keys():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_texts_against_their_manifest(spark):
    from folio.operators import audit

    mark = lambda n: f"{{{n}}}{'-' * 48}\n"
    long = mark(1) + "x" * 1200
    texts = [("A", mark(1) + "word wоrd"), ("B", "flat"), ("C", "flat"), ("D", long), ("E", long), ("F", long), ("G", None), ("H", mark(1) + mark(2) + "ok")]
    entries = [("A", None, 2, 500, None, False, ["thin", "excerpt"]), ("B", "html", None, 9, True, False, ["excerpt", "thin"]), ("C", "ocr", 3, 9, None, None, None), ("H", "pdftotext", 2, 10, False, True, ["thin"])]
    manifest = spark.createDataFrame(entries, "key string, src string, pages int, size int, truncated boolean, complete boolean, flags array<string>").withColumn("text", F.lit("other"))
    got = {r.key: r for r in audit.text_check(spark.createDataFrame(texts, "key string, text string"), manifest).collect()}
    n = len(long)
    assert {k: r.why for k, r in got.items()} == {"A": "1/2 pages; thin; excerpt", "B": "4 < manifest 9 chars; excerpt; thin", "C": "", "G": "no page marks", "H": ""} | {k: f"3 files share length {n}" for k in "DEF"}
    assert (got["A"].mixed, got["H"].pages, got["B"].pages, got["D"].per_page, got["G"].chars) == ("50.0", 2, None, n, 0)
