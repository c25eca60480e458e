import datetime
import math

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from quillstone.functions import designation as D
from quillstone.operators import relational as R
from quillstone.operators import text as T
from quillstone.plans import catalogue, identity, queue, upkeep  # noqa: F401
from quillstone.plans.fixtures import TABLES
from quillstone.sources import readers, sinks
from quillstone.streaming import harvest

SF = "/root/testdata/sf0.001"


def one(spark, column, value):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "given, wanted",
    [("  ČSN   EN  17127 ", "čsn en 17127"), (None, ""), ("STN EN ISO 11114-1/ – 2020.12", "stn en iso 11114-1"), ("ISO 16111/ - 2018.08", "iso 16111"), ("ADR 2025", "adr 2025"), ("CSA / ANSI HGV 2", "csaansi hgv 2"), ("IGC Doc 121/14", "121/14")],
)
def test_normalise(spark, given, wanted):
    assert one(spark, D.normalise, given) == wanted


def test_cores_and_dates(spark):
    assert one(spark, D.international_core, "STN EN ISO 11114-4/ - 2017.10") == "iso 11114-4"
    assert one(spark, D.international_core, "DIN EN 1717") == "en 1717" != one(spark, D.international_core, "1717")
    assert [one(spark, D.tier, x) for x in ("mezinárodní", "EU", "SK", "neurčeno", None)] == ["international", "EU", "national", None, None]
    assert one(spark, D.iso_date, "01.01.2027") == "2027-01-01" and one(spark, D.iso_date, "") is None
    assert one(spark, D.number_orders, "2119/98") == ["2119/98", "98/2119", "2119/1998", "1998/2119"]
    assert one(spark, D.slugify, "ČSN EN 17124") == "csn-en-17124"
    assert one(spark, D.packed_list, "4, 7,x") == [4, 7]
    assert one(spark, D.amendment_level, "EN 1+A2") == 2 and one(spark, D.amendment_level, "EN 1/AC") == 1


@pytest.mark.parametrize(
    "text, keys",
    [
        ("zákona č. 458/2000 Sb., a 12/2020 Sb.", ["CZ:458/2000", "CZ:12/2020"]), ("102/2011 Sb. m. s.", ["CZ-MS:102/2011"]), ("124/2006 Z. z.", ["SK:124/2006"]),
        ("(EU) 2019/943", ["EU:2019/943"]), ("(ES) č. 1907/2006", ["EU:2006/1907"]), ("98/34/ES", ["EU:1998/34"]), ("(EHS) č. 1408/71", ["EU:1971/1408"]),
        ("ČSN EN ISO 19880-1 a IEC 60079-10-1 a ČSN EN 17124", ["NORM:EN ISO 19880-1", "NORM:IEC 60079-10-1", "NORM:EN 17124"]),
    ],
)
def test_citations(spark, text, keys):
    assert [c["key"] for c in one(spark, T.citations, text)] == keys


def test_kinds_places_and_amendments(spark):
    text = "Podle směrnice 2014/68/EU a nařízení (ES) č. 1907/2006, ve znění zákona č. 1/2000 Sb., zákona č. 2/2001 Sb.; zákona č. 3/2001 Sb., zaveden zákonem č. 4/2002 Sb."
    found = one(spark, T.citations, text)
    assert [(c["key"], c["kind"], c["amendment"]) for c in found] == [
        ("EU:2014/68", "directive", False), ("EU:2006/1907", "regulation", False), ("CZ:1/2000", None, True), ("CZ:2/2001", None, True), ("CZ:3/2001", None, False), ("CZ:4/2002", None, False)]
    assert all(text[c["position"] :].startswith(c["display"].split(" ")[0]) or c["family"] == "EU" for c in found)
    long = "ve znění " + ", ".join(f"zákona č. {i}/2001 Sb." for i in range(1, 30))
    flags = spark.createDataFrame([(long,)], "t string").select(T.listed_amendments(F.col("t"), T.citations(F.col("t"))).alias("f")).first()["f"]
    assert flags == [True] * 29 and not all(c["amendment"] for c in one(spark, T.citations, long))


def test_contexts(spark):
    text = "a" * 10 + " " + "slovo " * 80 + "podle 12/2020  Sb. " + "dále " * 120
    (c,) = one(spark, T.contexts, text)
    assert c["cited"] == "12/2020 Sb." and c["before"].startswith("slovo ") and c["before"].endswith("podle ") and c["after"].endswith("dále")
    assert 290 <= len(c["before"]) <= 300 and 370 <= len(c["after"]) <= 400
    many = one(spark, T.contexts, "1/2000 Sb. " * 5 + "2/2000 Sb.")
    assert [(c["key"], c["place"]) for c in many] == [("CZ:1/2000", 1), ("CZ:1/2000", 2), ("CZ:1/2000", 3), ("CZ:2/2000", 1)]
    assert one(spark, T.contexts, None) == [] and one(spark, T.contexts, "") == []


def test_contexts_search_each_pattern_once(spark):
    """Five patterns and the two families' kinds: no search is written out again for each citation or field."""
    df = spark.createDataFrame([("x",)], "t string").select(T.contexts(F.col("t")).alias("c"))
    assert df._jdf.queryExecution().analyzed().toString().count("regexp_extract_all(") == 7


def test_own_keys(spark):
    rows = [("2014/68/EU [EN]", ""), ("Nařízení vlády 133/2005", ""), (None, "Vodíková strategie"), ("", "Zákon č. 1/2000 Sb. a 2/2000 Sb."), ("bez čísla", "Zákon č. 1/2000 Sb.")]
    out = spark.createDataFrame(rows, "d string, t string").select(T.own_keys(F.col("d"), F.col("t")).alias("k")).collect()
    assert [r["k"] for r in out] == [["EU:2014/68"], ["CZ:133/2005"], [], ["CZ:1/2000"], []]


def test_merged_records_and_kinds(spark):
    r = spark.createDataFrame([(1, 1, "ab", None, "S1, S2", "EN 5"), (1, 2, "abc", "x", "S2,  S3", "ČSN EN 5"), (1, 3, "abd", None, None, "")], "c int, seq int, title string, issuer string, src string, d string")
    m = R.merge_records(r, "c", ["issuer"], [], packed=["src"], designation="d").first()
    assert (m["title"], m["issuer"], m["src"], m["d"], m["members"]) == ("abc", "x", "S1, S2, S3", "ČSN EN 5", 3)
    k = spark.createDataFrame([(1, "", "u", "CZ"), (1, "", "u", None), (2, "a", "", "CZ"), (2, "b", "", "CZ"), (3, "a", "", "CZ"), (4, "a", "", "CZ"), (4, "a", "", "SK")], "c int, core string, url string, jurisdiction string")
    assert {x["c"]: (x["kind"], x["pure"]) for x in R.cluster_kind(k, "c").collect()} == {1: ("deterministic", True), 2: ("semantic", False), 3: ("none", True), 4: ("deterministic", False)}


def test_pinned_slugs_and_versions(spark):
    r = spark.createDataFrame([(1, "a", "x", 1), (2, "a", "y", 2), (3, "b", "z", 3)], "id int, base string, designation string, seq int").withColumn("title", F.lit(""))
    pinned = spark.createDataFrame([("a-2",)], "slug string")
    assert {x["id"]: x["slug"] for x in R.assign_slugs(r, pinned).collect()} == {1: "a", 2: "a-3", 3: "b"}
    v = spark.createDataFrame([("en 1", "CZ", 0, False, 1, "EN 1"), ("en 1", "CZ", 1, False, 2, "EN 1+A1"), ("en 2", "CZ", 0, False, 3, "EN 2")], "version_key string, jurisdiction string, level int, renumbered boolean, seq int, designation string")
    (g,) = R.version_groups(v, F.col("level") > 0).collect()
    assert [(x["version"], x["designation"], x["is_current"]) for x in g["versions"]] == [(1, "EN 1", False), (2, "EN 1+A1", True)]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"a": {"v": "1"}, "b": {"v": "2"}}')
    assert {r["key"]: r["entry"]["v"] for r in readers.json_map(spark, str(tmp_path / "m.json"), "struct<v:string>").collect()} == {"a": "1", "b": "2"}
    (tmp_path / "r.json").write_text('[{"id": 1}, {"id": 2}]')
    assert [r["id"] for r in readers.json_records(spark, str(tmp_path / "r.json"), "id int").orderBy("seq").collect()] == [1, 2]
    (tmp_path / "c.csv").write_text("﻿id;name\n1;x\n", encoding="utf-8")
    row = readers.delimited(spark, str(tmp_path / "c.csv")).first()
    assert (row["id"], row["name"], row["file"]) == ("1", "x", "c.csv")
    (tmp_path / "f.xml").write_text("<rss><channel><item><title>t</title><link>l</link></item></channel></rss>")
    assert readers.rss_items(spark, str(tmp_path / "f.xml")).first()["title"] == "t"
    lines = spark.createDataFrame([("f", i, v) for i, v in enumerate(["head", "- a", "more", "- b"])], "file string, line int, value string")
    assert [r["text"] for r in readers.marked_list(lines, "^- ").orderBy("record").collect()] == ["- a\nmore", "- b"]
    both, missing = readers.union_sources({"x": spark.range(1), "y": None})
    assert both.count() == 1 and missing == ["y"]
    df = sinks.export_projection(spark.createDataFrame([(None, ["p", "q"])], "a string, k array<string>"), ["a", "k"])
    for kind in ("csv", "json", "xml"):
        sinks.export(df, str(tmp_path / f"out-{kind}"), kind)
    assert spark.read.json(str(tmp_path / "out-json")).first()["k"] == "p, q"


def test_intake_is_repeatable(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.json").write_text('{"key": "a", "title": "A", "seen": 1}\n{"key": "b", "title": "B", "seen": 1}\n')
    run = lambda: harvest.intake(spark, str(tmp_path / "in"), str(tmp_path / "q"), str(tmp_path / "cp"))
    run()
    (tmp_path / "in/2.json").write_text('{"key": "a", "title": "", "seen": 5}\n{"key": "c", "title": "C", "seen": 5}\n')
    run()
    run()
    rows = {r["key"]: r for r in spark.read.parquet(str(tmp_path / "q/v1")).collect()}
    assert set(rows) == {"a", "b", "c"} and (rows["a"]["title"], rows["a"]["seen"], rows["a"]["first_seen"]) == ("A", 5, 1)


def plain(v):
    if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, datetime.date | pd.Timestamp):
        return str(v)
    return round(float(v), 6) if isinstance(v, int | float) or hasattr(v, "dtype") else str(v)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, wanted = catalogue.QUERIES[name](spark, SF).toPandas(), con.sql(catalogue.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(wanted.columns)
    cols = sorted(got.columns)
    rows = lambda df: sorted(repr([plain(v) for v in r]) for r in df[cols].itertuples(index=False))
    assert rows(got) == rows(wanted)
