import zipfile

import pytest
from pyspark.sql import functions as F

from quillstone.operators import filters as P
from quillstone.sources import archives

DOCS = "id int, title string, description string, designation string, type_id int, subtype string, source_id int, jurisdiction string"


def test_filters_narrow_and_agree(spark):
    d = spark.createDataFrame(
        [(1, "Energetický zákon", None, "458/2000 Sb.", 1, None, 1, "CZ"), (2, "Hydrogen 100%", "fuel", "ISO 1", 2, None, 2, "mezinárodní"), (3, "x", None, None, 1, "delegated", 1, None), (4, "zákon", None, "1/1 [SK]", 1, None, 1, "SK"), (5, "x_y", None, "EN 5", 1, None, 1, "DE")],
        DOCS,
    )
    k = spark.createDataFrame([(1, 7), (1, 7), (2, 8)], "document_id int, keyword_id int")
    syn = [P.Synonym(("vodík", "fuel cell"), ("hydrogen",), ("EN 5",))]
    ids = lambda **args: sorted(r["id"] for r in P.Filter.parse(args, syn).apply(d, k).collect())
    assert ids() == [1, 2, 3, 5]
    assert ids(include_sk="1") == [1, 2, 3, 4, 5]
    assert ids(q="ZÁKON") == [1] and ids(q="%") == [2] and ids(q="_") == [5]
    assert ids(q="Vodík ") == [2, 5] and ids(q="vodíkový") == []
    assert ids(type_id="1") == [1, 3, 5] and ids(type_id="podtyp-delegated") == [3] and ids(type_id="x") == [1, 2, 3, 5]
    assert ids(jurisdikce="others") == [3, 5] and ids(jurisdikce="SK") == [1, 2, 3, 5] and ids(keyword_id="7") == [1]


def test_rules_are_compiled(spark):
    c = spark.createDataFrame([(1, "norm", "Vodík a", 1), (2, "law", "x", 2), (3, None, None, None), (4, "norm", "y", 2)], "id int, kind string, title string, tier int")
    rules = [{"id": "a", "action": "propose", "when": {"kind": ["norm"], "title_regex": "(?iu)^VODÍK"}}, {"id": "b", "action": "reject", "when": {"any": [{"tier": 2, "kind": ["law"]}, {"known": True}]}}, {"id": "z", "action": "model", "when": {}}]
    got = {r["id"]: (r["rule"], r["action"]) for r in P.decided(c, rules, {"known": F.col("id") == 4}).collect()}
    assert got == {1: ("a", "propose"), 2: ("b", "reject"), 3: ("z", "model"), 4: ("b", "reject")}
    with pytest.raises(ValueError):
        P.decided(c, rules[:1])


def test_patterns_and_defaults_of_rules(spark):
    c = spark.createDataFrame([(1, "ABC", "Zákon", None), (2, "abc", "Nezařazeno", 1), (3, None, None, 2), (4, "xabc", "", 2)], "id int, t string, document_type string, tier int")
    ids = lambda when: [r["id"] for r in c.where(P.compiled(when)).orderBy("id").collect()]
    assert ids({"t_regex": "abc"}) == [2, 4] and ids({"t_regex": "(?i)^abc"}) == [1, 2]
    assert ids({"has_document_type": True}) == [1] and ids({"has_document_type": False}) == [2, 3, 4]
    assert ids({"tier": [1]}) == [1, 2] and ids({"tier": 2}) == [3, 4]


def test_model_answers_act_by_threshold(spark):
    rows = [("reject", "funds", 0.9, False), ("accept", "funds", 0.9, False), ("accept", "in_scope", 0.8, False), ("accept", "in_scope", 0.6, False), ("defer", "general", 0.9, True), ("defer", "general", 0.9, None)]
    df = spark.createDataFrame(rows, "r string, c string, p double, h boolean")
    act = P.model_action(F.col("r"), F.col("c"), F.col("p"), automatic={"funds": "reject", "general": "defer"}, related=F.col("h"), needs_relation=["general"], decline=0.7, accept=0.75)
    assert [r["a"] for r in df.select(act.alias("a")).collect()] == ["reject", "recommend", "propose", "recommend", "defer", "recommend"]


def test_duplicates_and_acceptance(spark):
    c = spark.createDataFrame([(1, ["EU:1"], "EN", "a"), (2, ["EU:1"], None, "a"), (3, [], "CS", "n"), (4, ["CZ:9"], "", "")], "id int, keys array<string>, language string, norm string")
    d = spark.createDataFrame([(10, ["EU:1"], "CS", "a"), (11, ["CZ:2"], None, "n")], "document int, keys array<string>, language string, norm string")
    assert sorted(tuple(r) for r in P.duplicates(c, d).collect()) == [(2, 10), (3, 11)]
    a = spark.createDataFrame([("k", "accepted", "", "t", "CS", "u", [1, 1, 2], ["x"]), ("l", "new", "d", "t", "CS", "u", [1], [])], "key string, status string, designation string, title string, language string, url string, areas array<int>, repeals array<string>")
    out = {k: v.count() for k, v in P.accepted_rows(a).items()}
    assert out == {"document": 1, "version": 1, "area": 2, "relation": 1}
    f = spark.createDataFrame([("t", "Norma", "CS", [1], False), (" ", "?", None, [], True), ("t", "Norma", "CS", None, None)], "title string, document_type string, language string, areas array<int>, had boolean")
    assert [r["f"] for r in f.select(P.proposal_faults(["Norma"], ["CS"], F.col("had")).alias("f")).collect()] == [[], ["title", "type", "language", "areas", "designation"], ["areas"]]


def test_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("t.unl", "1|žluť|\r\n\r\n2|b|c\n".encode("cp1250"))
    rows = archives.zipped_rows(spark, str(tmp_path), "t.unl").orderBy("line").collect()
    assert [(r["line"], r["fields"]) for r in rows] == [(0, ["1", "žluť", ""]), (1, ["2", "b", "c"])]
    assert archives.zipped_rows(spark, str(tmp_path), "no").count() == 0
    (tmp_path / "s.json").write_text('{"results": {"bindings": [{"a": {"value": "1"}}, {"a": {"value": "2"}, "b": {"value": "x"}}]}}')
    assert [tuple(r) for r in archives.bindings(spark, str(tmp_path / "s.json"), ["a", "b"]).collect()] == [("1", None), ("2", "x")]
    batches = archives.batched_values(spark.createDataFrame([(str(i % 90),) for i in range(200)], "key string"), 40).collect()
    assert sorted(t for r in batches for t in r["terms"].split()) == sorted(map(str, range(90))) and all(len(r["terms"].split()) <= 40 for r in batches)
    assert archives.whole(spark.range(3), 4, 3).count() == 3
    for limit, total in ((3, None), (10, 5)):
        with pytest.raises(ValueError):
            archives.whole(spark.range(3), limit, total)
