import pytest
from pyspark.sql import functions as F

from quillstone.functions import prose as N
from quillstone.operators import queue as K


def values(spark, rows, schema, column):
    return [r["y"] for r in spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"i int, {schema}").select("i", column.alias("y")).orderBy("i").collect()]


def test_titles_and_names(spark):
    rows = [("Sdílení (ISO/TR 62351-13: 2016)", "ISO/TR 62351-13"), ("Vodík, EN 17124", "EN 17124"), ("EN 17124 – Vodík", "EN 17124 - 2018.05"), ("en 17124", "EN 17124"), (" Leták ", "bez čísla"), ("x", None), ("A (b) EN 5", "EN 5"), (None, "EN 1.1")]
    shown = values(spark, rows, "t string, d string", N.norm_title(F.col("t"), F.col("d")))
    assert shown == ["ISO/TR 62351-13 — Sdílení", "EN 17124 — Vodík", "EN 17124 — Vodík", "EN 17124 — en 17124", "Leták", "x", "EN 5 — A (b)", "EN 1.1 — "]
    ways = values(spark, [("Norma", "ČSN EN 1", ""), ("Norma", "STN 2", "x"), ("Norma", "prEN IEC 3", ""), ("Norma", "G 260", "https://dvgw.de/x"), ("Zákon", "EN 1", "")], "k string, d string, u string", N.looked_up_in(F.col("k"), F.col("d"), F.col("u")))
    assert ways == [["csn"], ["stn"], ["iec"], ["dvgw"], ["law"]]
    assert values(spark, [("ISO 5",), ("EN ISO 5",), ("prEN 7",), ("5",)], "d string", N.listed_jurisdiction(F.col("d"))) == ["mezinárodní", "EU", "EU", "CZ"]
    assert values(spark, [("DRAFT-EU:1", ""), ("NORM:x", "ČSN 1"), ("NORM:x", "EN"), (None, None)], "k string, d string", N.guessed_jurisdiction(F.col("k"), F.col("d"))) == ["EU", "CZ", "mezinárodní", None]
    assert values(spark, [("https://eur-lex.europa.eu/legal-content/EN/TXT", "čeština"), ("x", " Čeština"), (None, None)], "u string, r string", N.row_language(F.col("u"), F.col("r"), {"čeština": "CS"})) == ["EN", "CS", None]
    assert values(spark, [("https://www.zakonyprolidi.cz/cs/1",), ("https://x.org",), (None,)], "u string", N.source_of(F.col("u"))) == ["zakonyprolidi", None, None]


def test_prose(spark):
    found = values(spark, [("dle zákona č. 1/2000 Sb. a (EU) č. 2/2001, ČSN EN 1514-1, EN 17124:2022 a EN ISO 5",), (None,)], "t string", N.prose_citations(F.col("t")))
    assert found == [["2/2001", "ČSN EN 1514-1", "EN ISO 5", "EN 17124"], []]
    assert values(spark, [("viz [6] a [12]",)], "t string", N.bracket_refs(F.col("t"))) == [[6, 12]]
    assert values(spark, [("→ U2 (režim)",), ("U22",)], "t string", N.edge_target(F.col("t"))) == ["U2", None]
    assert [tuple(x) for x in values(spark, [("Titul — popis",), ("bez",)], "t string", N.problem(F.col("t")))] == [("Titul", "Titul — popis"), (None, "bez")]
    assert [tuple(x) for x in values(spark, [("HZS (Sbor)",), ("Investor",)], "t string", N.subject(F.col("t")))] == [("HZS (Sbor)", "HZS"), ("Investor", None)]
    assert values(spark, [("[3] Zákon",), ("Zákony",)], "t string", N.bibliography(F.col("t"))) == [(3, "Zákon"), None]
    assert values(spark, [("VČS (čerpací stanice)",), ("x",)], "t string", N.installation(F.col("t"))) == ["VCS", None]
    assert values(spark, [("a\nb", "u\nv"), ("a", "u\nv")], "t string, u string", N.aligned(F.col("t"), F.col("u"))) == [[("a", "u"), ("b", "v")], None]
    parts = values(spark, [("EN 1\nEN 2", "Spolu\nČást 1\nČást 2"), ("EN 1\nEN 2", "a\nb"), ("EN 1", "a"), ("EN 1\nEN 2", "a")], "d string, t string", N.parts_of_row(F.col("d"), F.col("t"), "^Část"))
    assert parts == [[("EN 1", "Spolu Část 1"), ("EN 2", "Spolu Část 2")], [("EN 1", "a"), ("EN 2", "b")], None, None]
    assert values(spark, [("Příloha\n text\nPŘÍLOHA II\nANNEX 1a.",)], "t string", N.annex_count(F.col("t"))) == [3]
    assert values(spark, [("32001L0042", "o 2001/42 x"), ("32001L0042", "x"), ("52001PC1", ""), ("31998L0034", "34/98")], "c string, t string", N.number_in_title(F.col("c"), F.col("t"))) == [True, False, True, True]


def test_pages_and_feeds(spark):
    assert values(spark, [("Wed, 04 Nov 2026 07:38:00 GMT",), ("Wed, 11/04/2026 - 07:38",), ("?",), (None,)], "t string", N.feed_date(F.col("t"))) == ["2026-11-04", "2026-11-04", None, None]
    page = "<nav>1.1.2020 x</nav>Aktuality:&nbsp;1.11.2026 Nové <b>1.1.2025</b> věci&nbsp; &nbsp;nic 2.3.2026 - Další"
    assert values(spark, [(page,)], "p string", N.dated_blocks(F.col("p"))) == [[("2026-11-01", "Nové 1.1.2025 věci"), ("2026-03-02", "Další")]]
    rows = "<table><tr><td>CZ</td><td><a href='/x'>2026/12/CZ</a></td></tr><tr><td>x</td></tr><tr><td>h</td><td>no</td></tr></table>"
    assert values(spark, [(rows,)], "p string", N.table_rows(F.col("p"), r"^20\d\d/\d+/[A-Z]{2}")) == [[["CZ", "2026/12/CZ"]]]
    tokens = [([('{"recommendation": "', 0.0), ("acc", -0.5), ("ept", -9.0)],), ([("x", -1.0)],), ([],)]
    got = values(spark, tokens, "t array<struct<token:string,logprob:double>>", N.token_probability(F.col("t")))
    assert got == [pytest.approx(0.6065306597), None, None]
    assert values(spark, [("", 1), ("0000-00-00", 1), ("2026-01-02T0", 1), ("2025-12-31", 1), (None, 1)], "e string, x int", N.in_effect(F.col("e"), F.lit("2026-01-01"))) == [True, True, True, False, True]
    assert values(spark, [("Sazebník cel",), ("nic",)], "t string", N.first_pattern(F.col("t"), ["dohod", "sazebník"])) == ["sazebník", None]


def test_merges_of_maps(spark):
    df = spark.createDataFrame([({"a": {"seen": 1, "first_seen": 1}}, "a", {"seen": 5, "first_seen": None}), ({"a": {"seen": 1, "first_seen": 1}}, "b", {"seen": 5, "first_seen": None})], "m map<string,struct<seen:int,first_seen:int>>, s string, f struct<seen:int,first_seen:int>")
    got = [{k: tuple(v) for k, v in r["y"].items()} for r in df.select(K.with_finding(F.col("m"), F.col("s"), F.col("f")).alias("y")).collect()]
    assert got == [{"a": (5, 1)}, {"a": (1, 1), "b": (5, 5)}]
    row = spark.createDataFrame([(1, None, "x", "y")], "a int, b string, c string, d string")
    assert row.select(K.image("a", "b").alias("j")).first()["j"] == '{"a":1,"b":null}'
    changes = K.field_changes({"b": (F.col("b"), F.lit("")), "c": (F.col("c"), F.col("d"))})
    assert [tuple(x) for x in row.select(changes.alias("y")).first()["y"]] == [("c", "x", "y")]


def test_acts_enter_the_queue(spark):
    rows = [("deny", True, False, ["CZ:1"]), (None, False, True, ["CZ:1"]), (None, True, False, ["CZ:2", "CZ:1"]), (None, True, False, ["CZ:9"]), (None, True, False, ["CZ:5"]), (None, False, False, [])]
    col = K.act_action(reason=F.col("r"), amending=F.col("a"), full_text=F.col("f"), targets=F.col("t"), known=F.array(F.lit("CZ:1"), F.lit("CZ:2")), others=F.array(F.lit("CZ:9")), in_scope=F.lit(True))
    got = values(spark, rows, "r string, a boolean, f boolean, t array<string>", col)
    assert [tuple(x) for x in got] == [("exclude", None, None), ("exclude", None, "CZ:1"), ("amendment", 1, "CZ:1,CZ:2"), ("attach", None, "CZ:9"), ("candidate", 2, None), ("candidate", 1, None)]


def test_pages_samples_and_sources(spark):
    assert K.page_numbers(1, 1) == [] and K.page_numbers(6, 20) == [1, None, 4, 5, 6, 7, 8, None, 20] and K.page_numbers(2, 4) == [1, 2, 3, 4]
    q = spark.range(100).toDF("id")
    one, other = ([r["id"] for r in K.seeded_sample(q.repartition(n), "id", 7, 5).collect()] for n in (1, 6))
    assert one == other and len(set(one)) == 5 and one != [r["id"] for r in K.seeded_sample(q, "id", 8, 5).collect()]
    written = {}
    done = K.run_sources({"good": lambda: q, "bad": lambda: 1 / 0}, lambda name, df: written.update({name: df.count()}))
    assert written == {"good": 100} and done["good"] == "ok" and done["bad"].startswith("ZeroDivisionError")
    assert {r["name"]: r["n"] for r in K.row_counts({"a": q, "b": q.limit(3)}).collect()} == {"a": 100, "b": 3}
    d = spark.createDataFrame([(0.5, None), (0.9, 0.2)], "a double, b double").select(N.confidence(F.col("a"), F.col("b")).alias("c"))
    assert [r["c"] for r in d.collect()] == [0.5, 0.2]


def test_repeals_of_documents_with_several_keys(spark):
    """Repeated identifiers, several keys, checks said twice: each edge once."""
    docs = [("a", [1, 2], False), ("a", [2], False), ("b", [2, 3], False), ("b-en", [3], True), ("c-en", [4], True), ("d-en", [4], True), ("", [3], False), (None, [3], False), ("e", None, False), ("f", [None, 1], False)]
    checks = [(1, "zrušený", [2, 3]), (1, "zrušený", [3, 3, None]), (2, "zrušený", [4, 1]), (3, "účinný", [1]), (9, "zrušený", [1])]
    d = spark.createDataFrame(docs, "identifier string, keys array<int>, is_variant boolean")
    got = [tuple(r) for r in K.repeals(d, spark.createDataFrame(checks, "key int, status string, repealed_by array<int>")).collect()]
    has = lambda k: [(i, v) for i, ks, v in docs if i and k in (ks or [])]
    wanted = set()
    for key, by in ((1, 2), (1, 3), (2, 4), (2, 1)):
        originals = [i for i, v in has(by) if not v] or [min(i for i, _ in has(by))]
        wanted |= {(s, g, "REPEALS") for g, _ in has(key) for s in originals if s != g}
    assert len(got) == len(wanted) and set(got) == wanted
