"""Headings, reconciliation, recorded services, audits and reports on hand-made cases."""

import pytest
from pyspark.sql import functions as F

from folio.functions import records as rc
from folio.functions import text as tx
from folio.operators import audit, geometry, headings, lint, markup, reconcile, snapshots, verify
from folio.sources import readers, services


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_headings_outside_fences_and_their_pages(spark):
    text = "# *One*\n```\n# not one\n```\ntext\n## Two <b>x</b>  \n#tag\n### Three\n"
    docs = spark.createDataFrame([(1, text)], "id int, text string")
    assert rows(headings.headings(docs)) == [(1, 0, 1, "One"), (1, 5, 2, "Two x"), (1, 7, 3, "Three")]
    assert rows(headings.headings(docs, [2])) == [(1, 5, 2, "Two x")]
    assert [r.line for r in headings.heading_map(docs).orderBy("line").collect()] == [1, 3, 6, 8]
    pages = spark.createDataFrame([(1, 0, "Contents two x three"), (1, 1, "here is ONE"), (1, 2, "and\nTwo  x")], "id int, page int, body string")
    paged = headings.heading_pages(headings.headings(docs), pages)
    # the first pages hold later headings too, but a heading never goes back; three isn't found and moves nothing
    assert [tuple(r) for r in paged.select("title", "page").orderBy("line").collect()] == [("One", 1), ("Two x", 2), ("Three", None)]
    marked = spark.createDataFrame([(1, f"a\n{headings.TOC_START}\nold\n{headings.TOC_END}\nz"), (2, "none")], "id int, text string")
    out = {r.id: r.text for r in headings.with_toc(marked, headings.toc_block(paged, (1, 2, 3))).collect()}
    cell = '</td><td style="text-align:right;vertical-align:bottom;padding-left:1em">'
    assert out[2] == "none" and "old" not in out[1] and f'padding:1px 0 1px 1.5em">Two x{cell}3</td></tr>\n' in out[1] and f'1px 3.0em">Three{cell}</td>' in out[1] and out[1].endswith(f"{headings.TOC_END}\nz")


def test_contents_do_not_hold_their_own_headings(spark):
    text = f"## Preface\nx\n# Contents\n## Contents\n{headings.TOC_START}\n## Old\n```\n{headings.TOC_END}\n## Alpha\ntext\n### Beta & <c>\n#### deep\n## Gone"
    docs = spark.createDataFrame([(1, text), (2, "## A\nno marks"), (3, f"{headings.TOC_START}\n{headings.TOC_END}\n## A")], "id int, text string")
    listed = headings.contents_headings(docs)
    assert rows(listed.select("id", "title", "part")) == [(1, "Alpha", 2), (1, "Beta &", 2), (1, "Contents", 1), (1, "Gone", 2), (1, "Preface", 0)]
    bodies = ["preface", "of all", "Contents Preface 1 Alpha 4 Beta & 5", "alpha", "beta &"]
    pages = spark.createDataFrame([(1, k, b) for k, b in enumerate(bodies)], "id int, page int, body string")
    paged = headings.heading_pages(listed, pages)
    assert [tuple(r) for r in paged.orderBy("line").select("title", "page").collect()] == [("Preface", 0), ("Contents", 2), ("Alpha", 3), ("Beta &", 4), ("Gone", None)]
    assert "Contents" not in headings.toc_block(paged).head().toc


def test_heading_pages_against_a_plain_loop(spark):
    import random

    rng = random.Random(4)
    heads, pages, want = [], [], []
    for doc in range(30):
        titles = [rng.choice("abcdefg") * 2 for _ in range(rng.randrange(1, 8))]
        bodies = ["".join(rng.choices("abcdefg", k=9)) for _ in range(rng.randrange(0, 6))]
        heads += [(doc, k, 1, t) for k, t in enumerate(titles)]
        pages += [(doc, k, b) for k, b in enumerate(bodies)]
        at = 0
        for k, t in enumerate(titles):
            hit = next((p for p in range(at, len(bodies)) if t in bodies[p]), None)
            at = at if hit is None else hit
            want.append((doc, k, hit))
    got = headings.heading_pages(spark.createDataFrame(heads, "id int, line int, level int, title string"), spark.createDataFrame(pages, "id int, page int, body string"))
    assert [tuple(r) for r in got.select("id", "line", "page").orderBy("id", "line").collect()] == want


def test_levels_follow_the_reference(spark):
    docs = spark.createDataFrame([(1, "# Intro\n## A *note*\n### Other\nplain")], "id int, text string")
    refs = spark.createDataFrame([(1, "### intro\n## Intro\n**A note**\n")], "id int, text string")
    got = [tuple(r)[1:] for r in headings.relevelled(docs, refs).orderBy("line").collect()]
    assert got == [(0, "## Intro", "relevel"), (1, "A *note*", "demote"), (2, "### Other", ""), (3, "plain", "")]


@pytest.mark.parametrize(
    ("word", "other", "safe"),
    [
        ("same", "same", False), ("Case", "case", False), ("a", "б", False),
        ("домeн", "домен", True),  # mixed scripts
        ("ТСР", "TCP", True), ("pecypc", "ресурс", True), ("XXX", "ХХХ", False),
        ("finance", "nance", False), ("нако", "Однако", True), ("12", "121", False), ("a1b2c3d4e5f6", "a1b2c3d4e5f7", False),
        ("слелки", "сделки", True), ("table", "other", False), ("rn", "modern", False),
    ],
)
def test_safe_fixes(word, other, safe):
    assert reconcile.safe_fix(word, other) is safe


def test_reconciliation_keeps_all_else(spark):
    text = "The **bаnk** of _Englаnd_ has 12 branches."
    assert "".join(p for p, _ in reconcile.pieces(text)) == text and reconcile.composed("внешней̆") == "внешней"
    said, done = reconcile.reconciled(text, "The bank of England has 13 branches today.")
    assert said == "The **bank** of _England_ has 12 branches."
    assert [d[0] for d in done] == ["replace", "replace", "skip-word", "skip-insert"]
    assert reconcile.reconciled("a new home", "a brand new home", most_new=1)[0] == "a brand new home"
    assert reconcile.reconciled("one two three", "one three")[0] == "one two three"
    got = spark.createDataFrame([(text, "The bank"), (None, None)], "a string, b string").select(reconcile.reconcile(F.col("a"), F.col("b")).alias("x"))
    assert {r.x.text for r in got.collect()} == {"The **bаnk** of _Englаnd_ has 12 branches.".replace("bаnk", r.x.text[6:10]) if r.x.text else "" for r in got.collect()}


def test_accepted_lines_need_one_place(spark):
    lines = spark.createDataFrame([(1, 0, "a "), (1, 1, "b"), (1, 2, "b"), (1, 3, "c")], "doc int, line int, text string")
    accepted = spark.createDataFrame([(1, "a", "A", True), (1, "b", "B", True), (1, "c", "C", False), (1, "x", "X", True)], "doc int, old string, new string, plain boolean")
    out, skipped = reconcile.apply_accepted(lines, accepted)
    assert [r.text for r in out.orderBy("line").collect()] == ["A", "b", "b", "c"]
    assert rows(skipped) == [(1, "b", "2 matching lines"), (1, "c", "not a plain body paragraph"), (1, "x", "0 matching lines")]


def test_quotes_by_printed_pages(spark):
    pages = spark.createDataFrame([(1, 0, "no number"), (1, 1, "# Head\nThe quick brown fox jumps over it all\n 15 \n"), (1, 2, "3\nand sleeps until the next bright morning comes\n16"), (1, 3, "again the quick brown fox jumps over it all\n17")], "id int, page int, body string")
    printed = verify.source_pages(pages)
    assert rows(printed.select("page")) == [(15,), (16,), (17,)] and not printed.where("body like '%#%' or body like '%15%'").count()
    assert rows(verify.source_pages(pages, last=False).select("page")) == [(3,), (15,), (17,)]
    draft = "> «quick brown fox jumps over it all … and sleeps until the next»\n> — p. 15–16\n"
    report = lambda t: verify.verify_quotes(spark.createDataFrame([(1, t)], "id int, text string"), printed).head()
    assert tuple(report(draft))[1:] == (1, 1, 0, 0, "ok", True)
    assert tuple(report("> quick brown fox jumps\n> — p. 15\n"))[1:] == (1, 1, 0, 1, "not run", True)
    assert report("> never written there at all\n> — p. 15\n").passed is False and report("no quotes").passed is False


def test_glossing_and_the_strict_gate(spark):
    paras = spark.createDataFrame([(1, "A CBDC (central bank digital currency) exists."), (2, "The cbdc exists without it."), (3, "none")], "doc int, text string")
    got = lint.unglossed(paras, ["CBDC"])
    assert rows(got) == [(2, "CBDC", 4)]
    checks = {"glossing": lambda p: lint.unglossed(p, ["CBDC"]).select("doc", F.col("term").alias("note")), "soft": lambda p: p.select("doc", F.lit("x").alias("note"))}
    assert rows(lint.strict_gate(lint.prose_report(paras, checks))) == [(1, 1, 0, True), (2, 2, 1, False), (3, 1, 0, True)]
    assert rows(lint.prose_report(paras, checks, ["glossing"]).select("check")) == [("glossing",)]
    with pytest.raises(ValueError, match="unknown"):
        lint.prose_report(paras, checks, ["nothing"])


def test_similar_sentences(spark):
    words = "markets settle payments through ledgers held by several banks".split()
    texts = [" ".join(words), " ".join([*words[:-1], "firms"]), "wholly different words are standing here", "others again stand there for nothing"]
    items = spark.createDataFrame([(1, k, t, t.split()) for k, t in enumerate(texts)], "doc int, i int, key string, w array<string>")
    got = lint.similar_sentences(items).collect()
    assert [(r.i, r.j) for r in got] == [(0, 1)] and got[0].ratio > 0.9


def test_small_functions(spark):
    one = lambda c: spark.range(1).select(c).head()[0]
    assert one(rc.rounded(F.lit(2.25), 1)) == 2.2 and one(rc.rounded(F.lit(2.675), 2)) == round(2.675, 2) and one(rc.rounded(F.lit(0.35), 1)) == round(0.35, 1)
    assert one(rc.partial_date(F.expr("array(2020, null, 5)"))) == "2020" and one(rc.partial_date(F.expr("array(2020, 3)"))) == "2020-3"
    assert one(rc.citation_context(F.lit("abcdefghij"), F.lit(2), F.lit(4), 5, 3)) == "abcdefg"
    assert one(verify.dois(F.lit("see DOI 10.1000/ABC.1). x210.1000/no"))) == ["10.1000/ABC.1"]
    assert one(tx.fold(F.lit("eﬃcient ﬁnance Ǆ"))) == tx.folded("eﬃcient ﬁnance Ǆ") == "efficient finance dz"
    assert one(rc.flat_facts(F.lit("  "), 5))["flags"] == ["empty"] and one(rc.flat_facts(F.lit("abcdefgh"), 5))["text"] == "abcde"
    assert one(rc.latinised(F.lit("ТУк"))) == "TYk"


def test_clusters_with_spread_against_a_plain_loop(spark):
    import random

    rng = random.Random(2)
    for _ in range(5):
        values, want = [float(rng.randrange(40)) for _ in range(12)], []
        for v in sorted(values):
            for c in want:
                if abs(c[0] - v) <= 3:
                    c[1], c[2] = c[1] + 1, max(c[2], v - c[0])
                    break
            else:
                want.append([v, 1, 0.0])
        got = spark.createDataFrame([(values,)], "v array<double>").select(geometry.spread_clusters(F.col("v"), 3.0)).head()[0]
        assert [[c.rep, c.n, c.spread] for c in got] == want


def test_recorded_services(spark):
    body = '{"results": [{"id": "W1", "doi": "https://doi.org/10.1/a", "title": null, "abstract_inverted_index": {"b": [1], "a": [0, 2], "c": [1]}, "authorships": null}]}'
    got = services.openalex_search(spark.createDataFrame([("q", body), ("none", None)], "request string, body string")).collect()
    assert len(got) == 1 and (got[0].doi, got[0].title, got[0].abstract, got[0].authors, got[0].oa_status) == ("10.1/a", "", "a c a", [], "closed")
    feed = '<feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://arxiv.org/abs/cs/9901001v3</id><title>A\n B</title><published>99</published><link title="doi" href="http://dx.doi.org/10.5/x"/><author><name>Solo</name></author><author><name>Jo van Dam</name></author></entry><entry><id>odd</id></entry></feed>'
    a, b = services.arxiv_entries(spark.createDataFrame([("q", feed)], "request string, body string")).orderBy("place").collect()
    assert (a.id, a.title, a.doi, a.year, [tuple(c) for c in a.creators]) == ("cs/9901001", "A B", "10.5/x", None, [("Solo", ""), ("Dam", "Jo van")])
    assert (b.id, b.oa_url, b.authors) == ("odd", "odd", [])
    probes = spark.createDataFrame([("s", 15, "x"), ("s", 17, "y" * 9), ("s", 16, "no " + "z" * 9)], "request string, try int, body string")
    assert rows(services.first_acceptable(probes, 9, "no", 3)) == [("s", 17, "y" * 9)]
    chain = spark.createDataFrame([("a", 1, "one", [1, 3, 4]), ("a", 2, "skipped", [3]), ("a", 3, "three", [3, 4]), ("a", 4, " one ", [9]), ("a", 9, "nine", None), ("b", 1, "only", [])], "act string, n int, text string, links array<int>")
    assert rows(services.page_chain(chain)) == [("a", 1, "one"), ("a", 3, "three"), ("b", 1, "only")]


def test_listings(spark):
    files = spark.createDataFrame([("a/x.MD", 1), ("a/.git/x.md", 1), ("b/y.md", 1), ("c.txt", 1), ("storage/K1/b.pdf", 5), ("storage/K1/a.pdf", 5), ("storage/K2/.zotero-ft-cache", 0)], "path string, length long")
    assert rows(readers.collect_files(files, ["md"], ["b/*"]).select("path")) == [("a/x.MD",)]
    assert rows(readers.attachments(files)) == [("K1", "storage/K1/a.pdf", None, None)]


def test_emptied_trash_reports_what_dangles(spark):
    nodes = spark.createDataFrame([("a", None), ("b", "a"), ("c", None), ("d", "lost")], "key string, parent string")
    uses = spark.createDataFrame([("b", "t1"), ("c", "t2")], "key string, tag string")
    left = snapshots.empty_trash(nodes, spark.createDataFrame([("a",)], "key string"), spark.createDataFrame([("m", "b"), ("m", "c")], "coll string, key string"), {"tags": (spark.createDataFrame([("t1",), ("t2",)], "tag string"), uses, "tag")})
    assert rows(left["nodes"].select("key")) == [("c",), ("d",)] and rows(left["tags"]) == [("t2",)] and rows(left["memberships"]) == [("m", "c")]
    assert rows(left["problems"]) == [("parent", "d")]
    same = lambda a, b: snapshots.same_state(a, b).head()[0]
    state = spark.createDataFrame([("item", "a", "1")], "kind string, key string, payload string")
    assert same(state, state) and not same(state, state.where("false"))


def test_audit_sections(spark):
    files = spark.createDataFrame([("t/A2345678_x.md",), ("t/B2345678_x.md",), ("u/C2345678_y.md",), ("README.md",)], "path string")
    items = spark.createDataFrame([("A2345678", False), ("B2345678", True)], "key string, trashed boolean")
    pointers = spark.createDataFrame([("gone/x.md — lost",)], "pointer string")
    members = spark.createDataFrame([("c", "A2345678"), ("c", "Z2345678")], "coll string, key string")
    report = audit.mirror_audit(files, pointers, items, members)
    assert rows(report) == [("folder", "u", "1"), ("gap", "c", "1 of 2"), ("missing", "gone/x.md — lost", "gone/x.md"), ("orphan", "t/B2345678_x.md", "trash"), ("orphan", "u/C2345678_y.md", "absent"), ("uncovered", "t/B2345678_x.md", ""), ("uncovered", "u/C2345678_y.md", "")]
    assert tuple(audit.audit_passes(report).head()) == (7, False) and audit.audit_passes(report.where("section = 'gap'")).head().passed


def test_tables_have_one_width():
    assert markup.pipe_table([["a"], [], ["b", "c"], ["", ""]]) == "| a |  |\n| --- | --- |\n| b | c |" and markup.pipe_table([[""]]) == ""


def test_links_are_absolute(spark):
    html = '<p>see <a class="x" href="../b?q=1">here</a> and <a href="https://y.org/z">there</a></p><table><tr><td>1</td><td>2</td></tr></table>'
    df = spark.createDataFrame([(html, "http://x.org/d/e/f")], "h string, u string")
    assert df.select(markup.links_text(F.col("h"), F.col("u"))).head()[0] == "see here [http://x.org/d/b?q=1] and there [https://y.org/z]\n1 | 2"
