"""Archives, word and slide packages, and tables from word boxes."""

import io
import zipfile

from folio.operators import wordboxes
from folio.sources import packages, readers


def packed(files):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, body in files.items():
            z.writestr(name, body)
    return out.getvalue()


def test_nested_archives_and_damaged_ones(spark, tmp_path):
    inner = packed({"a.txt": b"inner", "deep/b.txt": b"x" * 1000})
    outer = packed({"one.txt": b"1", "in.zip": inner, "folder/": b""})
    damaged = bytearray(packed({"c.txt": b"hello hello hello"}))
    damaged[40] ^= 255
    for name, body in {"outer.zip": outer, "bad.zip": b"no archive", "sub/damaged.zip": bytes(damaged), "other.txt": b""}.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    rows = packages.entries(packages.archive_files(spark, str(tmp_path)))
    got = {(r.archive.split(f"{tmp_path.name}/")[1], r.entry): (r.size, r.error is None) for r in rows.collect()}
    assert got == {("outer.zip", "one.txt"): (1, True), ("outer.zip", "in.zip"): (len(inner), True), ("outer.zip!in.zip", "a.txt"): (5, True), ("outer.zip!in.zip", "deep/b.txt"): (1000, True), ("bad.zip", None): (None, False), ("sub/damaged.zip", "c.txt"): (17, False)}
    declared, present = rows.where("entry is not null"), rows.where("error is null")
    missing = readers.missing_entries(*(df.select("archive", "entry", "size") for df in (declared, present)))
    assert [r.entry for r in missing.collect()] == ["c.txt"]
    assert packages.entries(spark.createDataFrame([("x", None)], "path string, content binary")).head().error


WORD = """<w:document><w:body><w:p><w:pPr><w:b/></w:pPr><w:r><w:t>A &lt;tag&gt; &amp;amp; </w:t></w:r><w:r><w:t xml:space="preserve">more</w:t></w:r></w:p><w:p/>
<w:p w:rsid="1"><w:r><w:drawing/></w:r></w:p><w:p><w:t>– item</w:t></w:p><w:p><w:t>cell</w:t></w:p></w:body></w:document>"""


def test_word_paragraphs_and_the_export_check(spark):
    parts = packages.entries(spark.createDataFrame([("d", packed({packages.WORD_PART: WORD, "x.xml": "<w:p><w:t>no</w:t></w:p>"}))], "path string, content binary"))
    made = packages.paragraphs(parts)
    assert [tuple(r)[1:] for r in made.orderBy("n").collect()] == [(0, "A <tag> &amp; more", False), (1, "", True), (2, "– item", False), (3, "cell", False)]
    draft = lambda text: spark.createDataFrame([("d", text)], "archive string, text string")
    same = "## **A <tag> &amp; more**\n\n*Scientific adviser: X*\n![p](x.png)\n- item\n| cell |\n| --- |\n"
    assert packages.export_differences(made, draft(same)).collect() == []
    diff = {(r.side, r.text, r.n) for r in packages.export_differences(made, draft(same.replace("item", "thing") + "cell")).collect()}
    assert diff == {("package", "– item", 1), ("draft", "– thing", 1), ("draft", "cell", 1)}


def test_slides_in_their_order(spark):
    shape = lambda t, kind="": f"<p:sp><p:nvPr>{kind}</p:nvPr><a:p><a:t>{t}</a:t></a:p></p:sp>"
    files = {
        "ppt/presentation.xml": '<p:sldIdLst><p:sldId id="9" r:id="rA"/><p:sldId id="8" r:id="rB"/></p:sldIdLst>',
        "ppt/_rels/presentation.xml.rels": '<Relationship Id="rB" Target="slides/slide1.xml"/><Relationship Id="rA" Target="slides/slide2.xml"/><Relationship Id="rC" Target="slides/slide3.xml"/>',
        "ppt/slides/slide1.xml": f"<p:grpSp>{shape('in a group')}</p:grpSp>" + shape("  "),
        "ppt/slides/slide2.xml": shape("first &amp; best") + "<a:tbl><a:tr><a:tc><a:p><a:t>a|b</a:t></a:p></a:tc><a:tc/><a:tc><a:p><a:t>c</a:t></a:p></a:tc></a:tr></a:tbl>",
        "ppt/slides/slide3.xml": shape("not named"),
        "ppt/slides/_rels/slide1.xml.rels": '<Relationship Id="r1" Target="../notesSlides/notesSlide7.xml"/>',
        "ppt/notesSlides/notesSlide7.xml": shape("3", '<p:ph type="sldNum"/>') + shape("say it", '<p:ph type="body" idx="1"/>'),
    }
    parts = packages.entries(spark.createDataFrame([("s.pptx", packed(files))], "path string, content binary"))
    got = {r.page: r.text for r in packages.slides(parts).collect()}
    assert got == {1: "first & best\n\n| a\\|b | c |\n|---|---|", 2: "in a group\n\nSpeaker notes:\n\nsay it"}


def test_tables_from_boxes(spark):
    word = lambda x, y, t, w=10.0, page=1: ("d", page, float(x), float(y), float(x + w), float(y + 8), t)
    words = [word(0, 0, "A title over all", 120)] + [word(x, 40 + 12 * r + (x % 3), f"{r}{x}") for r in range(4) for x in (0, 50, 100) if (r, x) != (2, 50)] + [word(14, 52, "more"), word(0, 0, None), word(0, 0, "alone", page=2), ("d", 2, None, 1.0, 2.0, 3.0, "no place")]
    df = spark.createDataFrame(words, "doc string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    table = wordboxes.tables(wordboxes.cells(df)).collect()
    assert [(r.page, r.block, r.header, r.rows, r.n_rows) for r in table] == [(1, 1, ["00", "050", "0100"], [["10 more", "150", "1100"], ["20", "", "2100"], ["30", "350", "3100"]], 3)]
    assert wordboxes.cells(df.limit(0)).collect() == []
