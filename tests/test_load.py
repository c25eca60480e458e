import pytest
from pyspark.sql import functions as F

from quillstone.functions import bodies as B
from quillstone.operators import load as O


def values(spark, rows, schema, column):
    return [r["y"] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", column.alias("y")).orderBy("i").collect()]


def test_designations_in_titles(spark):
    cases = {
        "TECHNICKÉ POŽADAVKY [2019/0795] ": "[2019/0795]",
        "(EÚ)  2021/55 o plynech": "(EU) 2021/55",
        "ES 765/2008 o akreditaci": "ES 765/2008",
        "2009/73/EÚ\nSMERNICA": "2009/73/EU",
        "(EU) 2020/852 - TAXONOMIE": "(EU) 2020/852",
        "TPG 304 02 - Plnicí stanice": "TPG 304 02",
        "Úvod - bez čísla, ale dlouhý název, který žádné číslo v sobě nemá": "",
        "Zákon o metrologii (č. 505 / 1990 sb.)": "505/1990 Sb.",
        "Vyhláška č. 508/2009 Z. z., ktorou": "508/2009 Z. z.",
        "Prováděcí nařízení Komise (ES) 2017/1151 o emisích": "(EU) 2017/1151",
        "Směrnice Rady 1999/92 /ES o výbuchu a ochraně zaměstnanců": "1999/92 /ES",
        "ČSN EN ISO 19880-1": "ČSN EN ISO 19880-1",
        "Velmi dlouhý název dokumentu o vodíku z roku 2021 bez značky": "",
        "": "",
        None: "",
    }
    assert values(spark, [(t,) for t in cases], "t string", B.designation_in_title(F.col("t"))) == list(cases.values())


def test_bodies_and_jurisdictions(spark):
    rows = [("  ČSN EN 1",), ("iso 22734:2019",), ("ZP-5101",), ("zp-1",), ("EN 17124 – 2022.05",), ("XYZ 1",), ("",), (None,), ("CSA/ANSI HGV 2",)]
    found = values(spark, rows, "d string", B.issuing_body(F.col("d")))
    assert found == [B.CZECH, B.BODIES["ISO"], B.BODIES["ZP"], B.BODIES["ZP"], B.BODIES["EN"], None, None, None, B.BODIES["CSA"]]
    assert set(B.JURISDICTIONS) == set(B.BODIES.values())
    cases = [
        ("CZ", "Směrnice EU", "", "", "", "CZ"), ("neurčeno", "Směrnice EU", "", "", "", "EU"), (" ", "Norma", "DIN 1", "", "", "DE"), (None, "Norma", "QQ 7", "", "", "XX"),
        ("", "Zákon", "1/2000 Sb.", "", "https://www.zakonyprolidi.cz/cs/2000-1", "CZ"), ("", "Smlouva", "ADR 2025", "", "", "mezinárodní"), ("", "Smlouva", "", "RID - C", None, "mezinárodní"),
        ("neurčeno", "Zákon", "x", "y", "", "neurčeno"), (None, None, None, None, None, None),
    ]
    columns = {c: F.col(c) for c in ("kind", "designation", "title", "address")}
    filled = B.filled_jurisdiction(F.col("jurisdiction"), **columns, verified={"QQ 7": "XX"})
    assert values(spark, [c[:5] for c in cases], "jurisdiction string, kind string, designation string, title string, address string", filled) == [c[5] for c in cases]
    names = [(["", "a\nb", " MPO "],), (["Úřad"],), (["x" * 101],), ([],), (None,)]
    assert values(spark, names, "n array<string>", B.responsible(F.col("n"))) == ["Ministerstvo průmyslu a obchodu", "Úřad", None, None, None]


@pytest.fixture(scope="module")
def records(spark):
    listed = spark.createDataFrame(
        [(2, " Vodík ", "ČSN EN 1 ", "plyn, paliva, plyn"), (1, "Hydrogen", "ČSN EN 1", None), (3, "", "ČSN 3", ""), (4, "Nádrže", "x" * 101, None)],
        "n int, name string, mark string, words string",
    )
    acts = spark.createDataFrame([(1, "Zákon č. 5/2001 Sb., o vodách", ["", "MPO"], "u1"), (2, "(EU) 2020/1 - ŘÁD", None, "u2"), (3, "(EU) 2020/2 - ŘÁD", None, "u3")], "row int, t string, by array<string>, u string")
    sources = {
        "listed": O.Source(listed, {"title_cz": F.col("name"), "designation": F.col("mark"), "kind": F.lit("Norma"), "keywords": F.split("words", ","), "section": F.lit("plyn"), "jurisdiction": F.lit("CZ"), "language": F.lit("Čeština"), "description": F.lit("p")}, row="n"),
        "absent": None,
        "acts": O.Source(acts, {
            "title_cz": F.col("t"), "designation": B.designation_in_title(F.col("t")), "kind": F.when(F.col("row") == 1, "12").otherwise("Nařízení EU"), "responsible": F.col("by"), "url_main": F.col("u"), "description": F.lit("p"),
            "jurisdiction": F.when(F.col("row") == 1, "CZ").otherwise("EU"), "slug": F.when(F.col("row") == 2, "csn-en-1"), "validity": F.lit("Návrh"),
            "versions": F.when(F.col("row") == 3, F.array(F.struct(F.lit("a").alias("edition_label"), F.lit("").alias("effective_date"), F.lit(False).alias("is_current")), F.struct(F.lit("b").alias("edition_label"), F.lit("2020").alias("effective_date"), F.lit(True).alias("is_current")))),
        }),
    }
    out, missing = O.source_records(sources)
    assert missing == ["absent"]
    return out


def test_full_load(spark, records):
    eu = spark.createDataFrame([("u2", "DG X"), ("u9", "DG Y")], "url string, body string")
    tables = O.catalogue(records, eu)
    docs = {r["title"]: r for r in tables["document"].collect()}
    assert set(docs) == {"Vodík", "ČSN EN 1 — Hydrogen", "Nádrže", "Zákon č. 5/2001 Sb., o vodách", "(EU) 2020/1 - ŘÁD", "(EU) 2020/2 - ŘÁD"}  # no title, no document
    first, second, law, x, y = (docs[t] for t in ("ČSN EN 1 — Hydrogen", "Vodík", "Zákon č. 5/2001 Sb., o vodách", "(EU) 2020/1 - ŘÁD", "(EU) 2020/2 - ŘÁD"))
    assert first["identifier"] == "ČSN EN 1" and second["identifier"] is None and docs["Nádrže"]["identifier"] is None
    assert x["slug"] == "csn-en-1" and first["slug"] == "csn-en-1-2" and law["slug"] == "5-2001-sb" and second["slug"].startswith("doc-")
    assert len({r["slug"] for r in docs.values()}) == 6
    assert not first["needs_review"] and law["review_reason"] == O.GUESSED.format("CS")
    assert y["review_reason"].endswith(O.NO_BODY) and O.NO_BODY not in x["review_reason"]
    sources = {r["id"]: (r["name"], r["jurisdiction"]) for r in tables["source"].collect()}
    assert sources[first["source_id"]] == (B.CZECH, None) and second["source_id"] is None  # no identifier, no body
    assert sources[law["source_id"]] == ("Ministerstvo průmyslu a obchodu", "CZ") and sources[x["source_id"]] == ("DG X", None) and y["source_id"] is None
    kinds = {r["id"]: (r["name"], r["restricted"]) for r in tables["type"].collect()}
    assert kinds[first["type_id"]] == ("Norma", True) and kinds[law["type_id"]] == ("Nezařazeno", False)
    versions = {(r["document_id"], r["version"]): (r["edition_label"], r["effective_date"], r["is_current"], r["lifecycle_state"]) for r in tables["version"].collect()}
    assert versions[(first["id"], 1)] == (None, None, True, "active") and versions[(law["id"], 1)] == (None, None, True, "draft")
    assert versions[(y["id"], 1)] == ("a", None, False, "superseded") and versions[(y["id"], 2)] == ("b", "2020", True, "active") and len(versions) == 7
    words = {r["id"]: r["keyword"] for r in tables["keyword"].collect()}
    held = sorted(words[r["keyword_id"]] for r in tables["document_keyword"].where(F.col("document_id") == second["id"]).collect())
    assert held == ["paliva", "plyn"]


def test_load_of_nothing(spark, records):
    assert {n: t.count() for n, t in O.catalogue(records.limit(0)).items()} == dict.fromkeys(("document", "version", "keyword", "document_keyword", "type", "source"), 0)
    with pytest.raises(ValueError):
        O.source_records({"a": None})
    with pytest.raises(ValueError):
        O.Source(records, {"colour": F.lit(1)}).records()
