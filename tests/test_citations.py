"""Citations against the works that services know."""

from folio.operators import verify


def test_first_occurrences_and_their_context(spark):
    text = "Smith, J. A theory of maps // Journal of Maps. doi:10.1000/ABC-1.\nsee (10.1000/abc-1), and 10.2000/x;" + " z" * 400
    df = spark.createDataFrame([(1, text), (2, None), (3, "no identifier")], "id int, text string")
    got = sorted((r.id, r.doi, r.context) for r in verify.cited_dois(df).collect())
    assert [(i, d) for i, d, _ in got] == [(1, "10.1000/ABC-1"), (1, "10.2000/x")]
    assert got[0][2] == text[: text.index("10.1000") + len("10.1000/ABC-1.") + 64]
    lines = sorted((r.doi, r.context) for r in verify.cited_dois(df, per_line=True).collect())
    assert lines[0] == ("10.1000/ABC-1", "Smith, J. A theory of maps // Journal of Maps. doi: ") and lines[1][1].startswith("see ( ), and")


def test_every_verdict(spark):
    cite = lambda doi, text: (f"{text} {doi}",)
    lines = [
        cite("10.1000/ok", "Bölte, K. Maps of snow and ice // Polar Letters."), cite("10.1000/author", "Nobody, N. Maps of snow and ice // Polar Letters."),
        cite("10.1000/title", "Bolte, K. Something else altogether // Polar Letters."), cite("10.1000/venue", "Bolte, K. Maps of snow and ice // Other Place Weekly."),
        cite("10.1000/all", "Nobody Something else // Other place"), cite("10.1000/gone", "Bolte"), cite("10.1000/error", "Bolte"), cite("10.1000/bare", "no names here"),
    ]
    df = spark.createDataFrame([(1, "\n".join(x for (x,) in lines))], "id int, text string")
    work = lambda doi, error=None: (doi.upper(), error, "<b>Maps</b> of snow and ice", "Polar Letters", [" ", "Bölte-Krag"])
    works = [work(f"10.1000/{k}") for k in ("ok", "author", "title", "venue", "all")] + [work("10.1000/error", "HTTP 500"), ("10.1000/bare", None, None, None, None), work("10.1000/ok", "HTTP 500")]
    known = spark.createDataFrame(works, "doi string, error string, title string, venue string, families array<string>")
    got = {r.doi.split("/")[1]: r.status for r in verify.verify_citations(verify.cited_dois(df, per_line=True), known).collect()}
    assert got == {"ok": "OK", "author": "AUTHORS", "title": "TITLE", "venue": "VENUE", "all": "AUTHORS/TITLE/VENUE", "gone": "NOTFOUND", "error": "ERROR", "bare": "OK"}
