import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillstone.operators import resolution as S

RECORD = "seq long, core string, url string, jurisdiction string, hand_verified boolean, vector array<double>"


def greedy(rows, threshold):
    """All passes over single records, as stated."""
    known = [r[3] if r[3] not in (None, "", "neurčeno") else None for r in rows]
    group = {i: {i} for i in range(len(rows))}

    def join(a, b):
        if group[a] is group[b]:
            return True
        both = group[a] | group[b]
        if len({known[i] for i in both} - {None}) > 1:
            return False
        for i in both:
            group[i] = both
        return True

    for field in (1, 2):
        for i, r in enumerate(rows):
            if (r[field] or "").strip():
                for k in range(i):
                    if (rows[k][field] or "").strip() == r[field].strip() and join(i, k):
                        break
    for a, b in itertools.combinations(range(len(rows)), 2):
        ra, rb = rows[a], rows[b]
        if ra[4] or rb[4] or (ra[1] and rb[1] and ra[1] != rb[1]) or ra[5] is None or rb[5] is None:
            continue
        x, y = np.array(ra[5]), np.array(rb[5])
        size = np.linalg.norm(x) * np.linalg.norm(y)
        if size and x @ y / size > threshold:
            join(a, b)
    return {rows[i][0]: min(rows[k][0] for k in group[i]) for i in range(len(rows))}


@pytest.mark.parametrize("seed", range(4))
def test_clusters_equal_the_greedy_passes(spark, seed):
    rnd = random.Random(seed)
    vectors = [None, [0.0, 0.0, 0.0]] + [[rnd.gauss(0, 1) for _ in range(3)] for _ in range(12)]
    pick = lambda *xs: rnd.choice(xs)
    rows = [
        (i, pick("", None, "", "a", "b", "c", "d"), pick("", None, "", "u", "v", "w"), pick("", None, "neurčeno", "CZ", "SK", "EU"), pick(True, False, False, None), rnd.choice(vectors))
        for i in range(60)
    ]
    shuffled = rows[:]
    rnd.shuffle(shuffled)
    got = {r["seq"]: r["cluster"] for r in S.clusters(spark.createDataFrame(shuffled, RECORD), 0.9).collect()}
    assert got == greedy(rows, 0.9)


def test_clusters_of_nothing_and_of_singles(spark):
    assert S.clusters(spark.createDataFrame([], RECORD)).count() == 0
    out = S.clusters(spark.createDataFrame([(1, None, None, None, None, None), (2, "", " ", "", False, [1.0])], RECORD)).collect()
    assert sorted(tuple(r) for r in out) == [(1, 1), (2, 2)]


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (7, 7)], "u long, v long")
    assert {r["component"] for r in S.components(edges).where("node < 100").collect()} == {1}


def test_routing_and_faults(spark):
    r = spark.createDataFrame([(1, "a", "", "CZ"), (1, "a", "", ""), (2, "a", "", "CZ"), (2, "a", "", "SK"), (3, "", "u", "CZ"), (3, "", "u", None), (4, "x", "", "")], "c int, core string, url string, jurisdiction string")
    assert {x["c"]: x["route"] for x in S.route(r, "c").collect()} == {1: "merge", 2: "judge", 3: "merge", 4: "single"}
    given = spark.createDataFrame([(1, "a"), (1, "b")], "cluster int, designation string")
    out = spark.createDataFrame([(1, "a"), (1, "a"), (1, "z"), (1, ""), (1, "b")], "cluster int, designation string")
    assert {(x["designation"], x["fault"]) for x in S.merge_faults(given, out).collect()} == {("a", "repeated"), ("z", "invented")}


def test_variants_are_idempotent(spark):
    r = spark.createDataFrame([(1, "2014/68/EU", "x"), (2, "ISO 1", "y"), (3, None, "z")], "id int, designation string, title string")
    p = spark.createDataFrame([("2014/68/EU", "cs", "en")], "designation string, title_cs string, title_en string")
    once = S.split_variants(r, p).drop("rank")
    assert {tuple(x) for x in once.collect()} == {(1, "2014/68/EU", "cs"), (1, "2014/68/EU [EN]", "en"), (2, "ISO 1", "y"), (3, None, "z")}
    assert sorted(map(str, S.split_variants(once, p).drop("rank").collect())) == sorted(map(str, once.collect()))
    assert [(x["src"], x["dst"]) for x in S.translations(once).collect()] == [("2014/68/EU [EN]", "2014/68/EU")]


def test_registry_answers_and_hand_verified(spark):
    r = spark.createDataFrame([("1", "iso 1", "ISO 1", ""), ("1", "en iso 1", "ČSN EN ISO 1", "CZ"), ("2", "iso 2", "ISO 2", ""), ("2", "en iso 2", "EN ISO 2", "SK")], "digits string, core string, designation string, jurisdiction string")
    a = spark.createDataFrame([("1", "ČSN EN ISO 1", True), ("1", "ČSN ISO 1", False)], "digits string, designation string, is_valid boolean")
    assert [tuple(x) for x in S.ambiguous_groups(r, a).collect()] == [("1", 2, "ČSN EN ISO 1", "merged")]
    v = spark.createDataFrame([("A, B",), ("A",), ("",), (None,)], "s string").select(S.is_hand_verified(F.col("s"), ["A"]).alias("v"))
    assert [x["v"] for x in v.collect()] == [False, True, False, False]


def test_amendments_outside_groups_are_orphans(spark):
    r = spark.createDataFrame([(1, "en 1", "CZ", 1), (2, "en 1", None, 1), (3, "en 2", None, 2), (4, "en 3", "CZ", 0)], "id int, version_key string, jurisdiction string, level int")
    g = spark.createDataFrame([("en 1", "CZ"), ("en 2", None)], "version_key string, jurisdiction string")
    assert [x["id"] for x in S.orphan_amendments(r, g).collect()] == [2]
