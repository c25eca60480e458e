import zipfile

import pytest
from pyspark.sql import functions as F

from quillstone.operators import ordered as O
from quillstone.operators import text as T
from quillstone.sources import office


def test_two_people_decide(spark):
    e = [("a", 1, "propose", "x", None), ("a", 2, "confirm", "x", None), ("a", 3, "confirm", "y", None), ("a", 4, "reject", "y", "n"), ("b", 1, "reject", "x", " "), ("b", 2, "defer", "x", None), ("b", 3, "propose", "y", None), ("b", 4, "reopen", "z", None), ("b", 5, "fly", "z", None)]
    df = spark.createDataFrame(e, "item string, seq long, action string, person string, note string")
    got = {(r["item"], r["seq"]): (r["status"], r["proposer"], r["refused"]) for r in O.decide(df).collect()}
    assert got == {
        ("a", 1): ("proposed", "x", None), ("a", 2): ("proposed", "x", "same person"), ("a", 3): ("accepted", "x", None), ("a", 4): ("accepted", "x", "state"),
        ("b", 1): ("new", None, "no note"), ("b", 2): ("deferred", None, None), ("b", 3): ("proposed", "y", None), ("b", 4): ("new", None, None), ("b", 5): ("new", None, "state"),
    }
    assert O.decide(df.where("false")).count() == 0


def test_lines_are_anchored_at_their_first_word(spark):
    w = spark.createDataFrame([("d", 1, 10.0, 5.0, "b"), ("d", 1, 11.5, 1.0, "a"), ("d", 1, 13.0, 1.0, "c"), ("d", 2, 10.0, 0.0, "e")], "doc string, page int, top double, x0 double, text string")
    assert sorted((r["page"], r["line"], r["top"], r["text"]) for r in O.anchored_lines(w).collect()) == [(1, 0, 10.0, "a b"), (1, 1, 13.0, "c"), (2, 0, 10.0, "e")]


def test_running_lines_go(spark):
    rows = [("d", p, t, m) for p in range(1, 5) for t, m in ((f"Page {p} of 4", True), (f"{p}", True), (f"body {p}", False), ("Head", p < 3))]
    out = O.running_lines(spark.createDataFrame(rows, "doc string, page int, text string, in_margin boolean"))
    assert sorted({r["text"] for r in out.collect()}) == ["Head", "body 1", "body 2", "body 3", "body 4"]


@pytest.mark.parametrize(
    "page, lines",
    [
        ("<head><title>x</title></head><p>a <b>b</b>&amp;c</p>d<script>no</script>", "a b&c\nd"), (None, ""), ("", ""),
        ("<table><tr><th>h</th><td><p>1</p><p>2</p></td></tr><tr><td></td></tr></table><li>z", "h | 1; 2\nz"),
        ("<table><tr><td>o<table><tr><td>i</td><td>j</td></tr></table></td><td>k", "o; i | j | k"),
    ],
)
def test_page_lines(page, lines):
    assert T.page_lines(page) == lines


def test_contexts_and_similarity(spark):
    text = "word " * 100 + "podle zákona č. 458/2000 Sb., o podmínkách " + "konec " * 100
    c = spark.createDataFrame([(text,)], "t string").select(T.context(F.col("t"), F.lit(text.index("458"))).alias("c")).first()["c"]
    assert c["cited"] == "458/2000 Sb." and c["before"].endswith("zákona č. ") and len(c["before"]) <= 300 and c["after"].startswith(", o") and c["after"].endswith("konec")
    df = spark.createDataFrame([("A  b", "a B", "Á\xa0x"), (None, "x", None)], "a string, b string, q string")
    rows = df.select(T.title_similarity(F.col("a"), F.col("b")).alias("s"), T.query_form(F.col("q")).alias("q")).collect()
    assert [(r["s"], r["q"]) for r in rows] == [(1.0, "á x"), (0.0, "")]
    (row,) = spark.createDataFrame([("1/2000 Sb. " * 5,)], "t string").select(T.contexts(F.col("t")).alias("c")).collect()
    assert [x["place"] for x in row["c"]] == [1, 2, 3]


def test_workbooks_and_documents(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cell = lambda r, v: f'<c r="{r}" t="inlineStr"><is><t>{v}</t></is></c>'
    with zipfile.ZipFile(tmp_path / "a.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="S" sheetId="1" r:id="r1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>Typ</t></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f'<worksheet {ns}><sheetData><row>{cell("A1", "x")}</row><row><c r="B3" t="s"><v>0</v></c>{cell("C3", "Pozn")}</row><row>{cell("B4", "law")}<c r="C4"><v>5</v></c></row><row>{cell("A5", "out")}</row></sheetData></worksheet>')
    out = office.anchored_table(office.cells(spark, str(tmp_path)), "Typ", "Pozn", ["kind", "note"]).collect()
    assert [(r["row"], r["kind"], r["note"]) for r in out] == [(4, "law", "5")]
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.docx", "w") as z:
        z.writestr("word/document.xml", f'<w:document {w}><w:body><w:p><w:pPr><w:pStyle w:val="Heading1"/></w:pPr><w:r><w:t>H</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>1</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>2</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>')
    assert [(r["kind"], r["text"]) for r in office.parts(spark, str(tmp_path)).orderBy("position").collect()] == [("Heading1", "H"), ("row", "1 | 2")]
