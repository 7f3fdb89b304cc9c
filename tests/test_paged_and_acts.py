"""Paged listings, recorded and asked for, and acts in sections."""

import json

from folio.operators import acts
from folio.sources import paged

FETCH = '''
import json
ASKED = []
def fetch(listing, limit, start):
    rows = [{"key": f"{listing}{i}", "n": i, "note": "x" * 50} for i in range(int(listing[1:]))][start : start + limit]
    return json.dumps(rows if start % (2 * limit) else {"data": rows})
'''


def test_asking_page_by_page(spark, tmp_path, monkeypatch):
    import sys

    (tmp_path / "fetcher_of_pages.py").write_text(FETCH)
    spark.sparkContext.addPyFile(str(tmp_path / "fetcher_of_pages.py"))
    monkeypatch.syspath_prepend(str(tmp_path))
    for listing, parts in (("a0", 1), ("a7", 1), ("a20", 2), ("a23", 3), ("a5", 4)):
        got = paged.scan(spark, listing, "fetcher_of_pages:fetch", "key string, n long", partitions=parts, limit=5)
        assert sorted(r.n for r in got.collect()) == list(range(int(listing[1:]))) and got.columns == ["key", "n"]
    sys.modules.pop("fetcher_of_pages", None)


def test_recorded_pages(spark):
    page = lambda *keys: json.dumps([{"key": k} for k in keys])
    pages = [("whole", 0, page("a", "b")), ("whole", 2, page("c")), ("whole", 4, page("never")), ("exact", 0, page("a", "b")), ("exact", 2, "[]"), ("lost", 0, page("a", "b")), ("lost", 4, page("x", "y")), ("late", 2, page("b")), ("broken", 0, "<html>"), ("twice", 0, page("a")), ("twice", 0, page("a")), ("none", 0, None)]
    df = spark.createDataFrame(pages, "listing string, start int, body string")
    got = paged.paged_rows(df, "struct<key:string,more:int>", limit=2).collect()
    assert sorted((r.listing, r.place, r.key, r.more) for r in got) == [("exact", 0, "a", None), ("exact", 1, "b", None), ("lost", 0, "a", None), ("lost", 1, "b", None), ("twice", 0, "a", None), ("whole", 0, "a", None), ("whole", 1, "b", None), ("whole", 2, "c", None)]


def test_sections_of_an_act(spark):
    u = lambda k: f"https://x/{k}/"
    toc = f"[Article 2]({u(2)}) [article 1]({u(1)})\n[Annex]({u(9)}) [again]({u(2)}) [Article 3]({u(3)}) [Article 4]({u(4)}) [elsewhere](https://y/5/)"
    contents = spark.createDataFrame([(1, toc), (2, "no links"), (3, None)], "id int, text string")
    by_label = acts.contents_links(contents, r"https://x/\d+/", "^article")
    assert [(r.k, r.url) for r in by_label.orderBy("k").collect()] == [(1, u(2)), (2, u(1)), (3, u(3)), (4, u(4))]
    assert [r.url for r in acts.contents_links(contents, r"https://x/\d+/").orderBy("k").collect()] == [u(k) for k in (1, 2, 3, 4, 9)]
    long = lambda t: t + " law" * 100
    tries = [(u(2), 0, long("two [a](http://b/c)")), (u(1), 0, "checking your browser" + " x" * 200), (u(1), 1, "short"), (u(1), 2, long("one")), (u(3), 0, "ERR_TIMED_OUT"), (u(3), 3, long("too late")), (u(4), 0, "wanted" + " not" * 100)]
    sections = acts.rendered(by_label, spark.createDataFrame(tries, "url string, attempt int, text string"), "law")
    assert {r.url: r.state for r in sections.collect()} == {u(2): "kept", u(1): "kept", u(3): "missing", u(4): "other"}
    from pyspark.sql import functions as F

    act = acts.act_texts(sections, F.lit("x")).collect()
    assert [(r.id, r.kept, r.chosen, r.status, r.missing) for r in act] == [(1, 2, 4, "PARTIAL", [u(3)])]
    assert act[0].text.startswith("*Source: x — 2 of 4 sections*\n\n\n{1}") and act[0].text.index("two a") < act[0].text.index("{2}") < act[0].text.index("one")
