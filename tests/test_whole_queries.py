"""Queries over all rows of small tables, against worked examples."""

from quillstone.plans import catalogue, identity, queue  # noqa: F401  (the last two add to the first)


def table(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")


def rows(spark, folder, query):
    return sorted(tuple(r) for r in catalogue.QUERIES[query](spark, str(folder)).collect())


def moved(df):
    """Rows that all exchanges of a plan write when it runs."""
    run = df._jdf.queryExecution()
    run.toRdd().count()

    def of(p):
        kind = p.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            return of(p.executedPlan())
        if kind.endswith("QueryStageExec"):
            return of(p.plan())
        own = p.metrics().get("shuffleRecordsWritten")
        return (own.get().value() if own.isDefined() else 0) + sum(of(p.children().apply(i)) for i in range(p.children().size()))

    return of(run.executedPlan())


def test_citation_keys_of_long_numbers(spark, tmp_path):
    table(spark, tmp_path, "part", [(5, "a", "b", 1), (10004, "a", "b", 1)], "p_partkey long, p_name string, p_brand string, p_size int")
    assert 10004 % 9 == 5
    assert rows(spark, tmp_path, "t3_citation_keys") == [(5, "CZ:5/1991,EU:2014/15:directive,CZ:6/2020,SK:7/2011,NORM:EN 1005"), (10004, "EU:2014/14:directive,CZ:105/2020,SK:7/2011,NORM:EN 1004")]


def test_references_to_the_whole_table(spark, tmp_path):
    keys = [3, 30, 31, 402, 5000, 5001]
    table(spark, tmp_path, "part", [(k,) for k in keys], "p_partkey long")
    refs = {*keys, *(k // 10 for k in keys)}
    exact = {(r, r) for r in refs if r % 3 == 0 and r in keys}
    series = {(r, k) for r in refs for k in keys if k // 10 == r and (r, r) not in exact}
    assert rows(spark, tmp_path, "j23_series_or_parts") == sorted(exact | series)
    assert (402, 402) in exact and (500, 5000) in series


def test_shared_keys_of_all_acts(spark, tmp_path):
    lines = [(1, 7, 1), (2, 7, 1), (13, 7, 1), (13, 8, 1), (20, 8, 1), (20, 9, 1), (5, 9, 2), (99, 8, 1)]
    table(spark, tmp_path, "lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long")
    table(spark, tmp_path, "orders", [(k,) for k in (1, 2, 13, 20, 5)], "o_orderkey long")
    wanted = {(a[0], b[0]) for a in lines for b in lines if a[1:] == b[1:] and a[0] != b[0] and b[0] != 99}
    assert rows(spark, tmp_path, "j22_shared_keys") == sorted(wanted)


def test_titles_of_all_parts(spark, tmp_path):
    parts = [(1, "A", "red green"), (2, "A", "red"), (3, "A", "red green"), (4, "B", "blue"), (5, "A", "reddish"), (6, "A", "grey"), (80, "A", "grey blue")]
    table(spark, tmp_path, "part", parts, "p_partkey long, p_brand string, p_name string")
    wanted = {(4, 4, "designation")} | {(a, b, "title") for a, x, t in parts for b, _, u in parts if x == "A" and (t.startswith(u) or u.startswith(t))}
    assert rows(spark, tmp_path, "j19_prefix_fallback") == sorted(wanted)


def test_titles_of_odd_parts(spark, tmp_path):
    """Repeated ids, ids of several titles, nulls, an empty title."""
    parts = [(1, "A", "red"), (1, "A", "red green"), (1, "A", "red"), (2, "A", "red green"), (2, "A", "red g"), (None, "A", "red"), (3, "A", ""), (4, "A", None), (5, None, "blue"), (6, "B", "blues"), (None, "A", "blu")]
    table(spark, tmp_path, "part", parts, "p_partkey long, p_brand string, p_name string")
    wanted = {(6, 6, "designation")} | {(a, b, "title") for a, x, t in parts for b, _, u in parts if x != "B" and t is not None and u is not None and (t.startswith(u) or u.startswith(t))}
    got = [tuple(r) for r in catalogue.QUERIES["j19_prefix_fallback"](spark, str(tmp_path)).collect()]
    assert len(got) == len(wanted) and set(got) == wanted


def test_pairs_of_equal_titles_are_not_moved(spark, tmp_path):
    """600 parts of one title are 360,000 pairs: the parts are sent, the pairs are made where they meet."""
    table(spark, tmp_path, "part", [(i, "A", "red") for i in range(600)], "p_partkey long, p_brand string, p_name string")
    df = catalogue.QUERIES["j19_prefix_fallback"](spark, str(tmp_path))
    assert df.count() == 360_000 and moved(df) < 10_000


def test_repeals_of_many_documents_are_not_moved(spark, tmp_path):
    """Three checks say the same of 300 documents with 300 successors: 90,000 edges, made where the documents meet."""
    table(spark, tmp_path, "part", [(k + 500 * i,) for k in (1, 7) for i in range(300)], "p_partkey long")
    table(spark, tmp_path, "supplier", [(1, 1), (501, 1), (1001, 1)], "s_suppkey long, s_nationkey int")
    df = catalogue.QUERIES["g6_repeals"](spark, str(tmp_path))
    assert df.count() == df.distinct().count() == 90_000 and moved(df) < 10_000
