"""Which records are one document: clusters under a jurisdiction rule, routing, merges, registry answers, variants.

Rows carry seq, their unique position in the input, which decides every tie.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.storage import written

UNKNOWN = ("", "neurčeno")


def known(jurisdiction: Column) -> Column:
    """The jurisdiction, or null where it is not known."""
    return F.when(~F.coalesce(jurisdiction, F.lit("")).isin(*UNKNOWN), jurisdiction)


def is_hand_verified(sources: Column, verified: Sequence[str]) -> Column:
    """All sources of a comma-joined list are verified ones, and there is one at least."""
    parts = F.filter(F.transform(F.split(F.coalesce(sources, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return (F.size(parts) > 0) & F.forall(parts, lambda x: x.isin(*verified))


def similar_pairs(vectors: DataFrame, least: float, strict: bool = False, apart: bool = False, per_block: int = 2048) -> DataFrame:
    """a < b, similarity of rows (id long, veto string, vector) whose cosine is `least` or more (more, if strict) and whose
    vetoes are not two different non-null ones; with `apart`, only those with two different ones (null is one). Packed blocks meet in pairs; rows with a null or zero vector take no part."""
    blocks = max(1, -(-vectors.count() // per_block))
    rows = vectors.where("vector is not null").select("id", "veto", "vector", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("block"))

    def pack(t: pa.Table) -> pa.Table:
        flat = [[float(x or 0) for v in t.column("vector").to_pylist() for x in v]]
        lists = {n: pa.array([t.column(n).to_pylist()], pa.list_(k)) for n, k in (("id", pa.int64()), ("veto", pa.string()))}
        return pa.table({"block": t.column("block")[:1], "ids": lists["id"], "vetoes": lists["veto"], "flat": pa.array(flat, pa.list_(pa.float64()))})

    packed = rows.groupBy("block").applyInArrow(pack, "block int, ids array<long>, vetoes array<string>, flat array<double>")
    left = packed.withColumn("other", F.explode(F.sequence("block", F.lit(blocks - 1))))
    right = packed.select(F.col("block").alias("other"), F.col("ids").alias("ids2"), F.col("vetoes").alias("vetoes2"), F.col("flat").alias("flat2"))

    def unit(flat, n: int) -> np.ndarray:
        m = np.array(flat).reshape(n, -1)
        size = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, size, out=np.zeros_like(m), where=size > 0)

    def codes(a, b) -> tuple[np.ndarray, np.ndarray]:
        both, _ = pd.factorize(np.array(list(a) + list(b), dtype=object))
        return both[: len(a)], both[len(a) :]

    def run(batches):
        for batch in batches:
            for same, i, v, x, i2, v2, x2 in zip(*(batch.column(k).to_pylist() for k in range(7)), strict=True):
                sim = unit(x, len(i)) @ unit(x2, len(i2)).T
                p, q = np.nonzero(sim > least if strict else sim >= least)
                c, c2 = codes(v, v2)
                i, i2 = np.array(i), np.array(i2)
                fits = c[p] != c2[q] if apart else (c[p] == c2[q]) | (c[p] < 0) | (c2[q] < 0)
                ok = fits & ((i[p] < i2[q]) | (not same)) & (i[p] != i2[q])
                p, q = p[ok], q[ok]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i[p], i2[q])), pa.array(np.maximum(i[p], i2[q])), pa.array(sim[p, q])], ["a", "b", "similarity"])

    pairs = left.join(right, "other").select((F.col("block") == F.col("other")).alias("same"), "ids", "vetoes", "flat", "ids2", "vetoes2", "flat2")
    return pairs.mapInArrow(run, "a long, b long, similarity double")


def components(edges: DataFrame) -> DataFrame:
    """node, component (its least node) of edges u, v, by rounds of least neighbours with pointer jumps until none changes."""
    both = written(edges.select("u", "v").union(edges.select("v", "u")).where("u <> v").distinct(), "edges")
    labels = written(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy(F.col("u").alias("node")).agg(F.min("component").alias("least"))
        step = labels.join(near, "node").select("node", "component", F.least("component", "least").alias("to"))
        jump = labels.select(F.col("node").alias("to"), F.col("component").alias("far"))
        after = written(step.join(jump, "to").select("node", F.least("to", "far").alias("component"), (F.least("to", "far") < F.col("component")).alias("moved")), "labels")
        labels = after.select("node", "component")
        if not after.where("moved").limit(1).count():
            return labels


def clusters(records: DataFrame, threshold: float = 0.85) -> DataFrame:
    """seq, cluster (least seq of the records taken to be one document).

    records: seq long, core, url, jurisdiction strings, hand_verified boolean, vector. Three passes in the order of seq join
    records of one core, then of one url, then with cosine over the threshold (not with two different cores, nor where one
    is hand-verified); each record of a core or url joins the first earlier one that it can, and nothing is joined that
    would hold two known jurisdictions.

    The greedy order matters only between identities, never between records that are bound to stay together: those of a
    core with one jurisdiction (unknown ones go with the first known one of the core), coreless ones of a url and
    jurisdiction, and coreless ones without url of equal vectors and jurisdiction. So these are contracted by aggregates
    first, and only identities that compete with others are replayed, component by component. Blank or null cores, urls
    and jurisdictions count as unknown; a null hand_verified is false; null and zero vectors are like nothing.
    """
    text = lambda c: F.nullif(F.trim(F.coalesce(F.col(c), F.lit(""))), F.lit(""))
    r = records.select("seq", text("core").alias("core"), text("url").alias("url"), known(F.col("jurisdiction")).alias("j"), F.coalesce("hand_verified", F.lit(False)).alias("hand"), "vector")
    first = r.where("core is not null and j is not null").groupBy("core").agg(F.min_by("j", "seq").alias("_j"))
    r = r.join(first, "core", "left").withColumn("j", F.coalesce("j", "_j")).drop("_j")
    some = F.exists(F.coalesce("vector", F.array().cast("array<double>")), lambda x: x != 0)
    like = F.when(F.col("core").isNull() & F.col("url").isNull() & ~F.col("hand") & some, F.to_json(F.struct("vector")))
    alone = F.when(F.coalesce("core", "url", like).isNull(), F.col("seq"))
    key = F.sha2(F.to_json(F.struct("core", F.when(F.col("core").isNull(), F.col("url")).alias("url"), like.alias("like"), alone.alias("alone"), "j")), 256)
    r = r.withColumn("key", key)
    nodes = r.groupBy("key").agg(F.min("seq").alias("node"))
    r = written(r.join(nodes, "key").drop("key"), "records")

    by_url = r.where("url is not null").groupBy("url", "node", "j").agg(F.min("seq").alias("i"))
    shared = by_url.groupBy("url").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).where("n > 1")
    by_url = by_url.join(shared, "url")
    # one row for each vector of an identity is enough: equal ones give the same links
    vectors = r.where("not hand and vector is not null").groupBy("node", "core", "vector").agg(F.min("seq").alias("id"))
    pairs = similar_pairs(vectors.select("id", F.col("core").alias("veto"), "vector"), threshold, strict=True)
    of = r.select("seq", "node", "j")
    by_text = pairs.join(of.toDF("a", "na", "ja"), "a").join(of.toDF("b", "nb", "jb"), "b").where("na <> nb")
    by_text = by_text.groupBy(F.least("na", "nb").alias("na"), F.greatest("na", "nb").alias("nb"), F.when(F.col("na") < F.col("nb"), F.col("ja")).otherwise(F.col("jb")).alias("ja"), F.when(F.col("na") < F.col("nb"), F.col("jb")).otherwise(F.col("ja")).alias("jb")).agg(F.min(F.struct("a", "b")).alias("at"))

    steps = by_url.select(F.lit(2).alias("phase"), "i", F.lit(0).cast("long").alias("k"), "url", F.col("node").alias("x"), F.col("j").alias("jx"), F.col("hub").alias("y"), F.lit(None).cast("string").alias("jy"))
    steps = steps.union(by_text.select(F.lit(3), F.col("at.a"), F.col("at.b"), F.lit(None).cast("string"), "na", "ja", "nb", "jb"))
    steps = written(steps, "steps")
    comp = components(steps.select(F.col("x").alias("u"), F.col("y").alias("v")))
    merged = steps.join(comp.withColumnRenamed("node", "x"), "x").groupBy("component").applyInPandas(_replay, "node long, cluster long")
    out = r.select("seq", "node").join(merged, "node", "left")
    return out.select("seq", F.coalesce("cluster", "node").alias("cluster"))


def _replay(steps: pd.DataFrame) -> pd.DataFrame:
    """Joins of one component in their order; an island holds one known jurisdiction at most."""
    up: dict[int, int] = {}
    place: dict[int, str] = {}

    def root(n: int) -> int:
        up.setdefault(n, n)
        while up[n] != n:
            up[n] = up[up[n]]
            n = up[n]
        return n

    def join(a: int, b: int) -> bool:
        a, b = sorted((root(a), root(b)))
        if a != b:
            if place.get(a) and place.get(b) and place[a] != place[b]:
                return False
            up[b] = a
            if place.get(b):
                place[a] = place[b]
        return True

    steps = steps.sort_values(["phase", "i", "k"], kind="stable")
    for n, j in [*zip(steps["x"], steps["jx"], strict=True), *zip(steps["y"], steps["jy"], strict=True)]:
        root(n)
        if isinstance(j, str):
            place[n] = j
    # earlier members of a url matter only as far as they stand in different islands
    seen: dict[str, list[int]] = {}
    for phase, url, x, y in zip(steps["phase"], steps["url"], steps["x"], steps["y"], strict=True):
        if phase == 3:
            join(x, y)
            continue
        heads = seen.setdefault(url, [])
        if not any(join(x, h) for h in heads):
            heads.append(x)
    return pd.DataFrame({"node": list(up), "cluster": [root(n) for n in up]})


def route(records: DataFrame, cluster: str) -> DataFrame:
    """cluster, members, route: single, merge (one known core or one url for all, one known jurisdiction at most) or judge."""
    blank = lambda c: F.coalesce(F.trim(F.col(c)), F.lit(""))
    one = lambda c: F.bool_and(blank(c) != "") & (F.min(blank(c)) == F.max(blank(c)))
    j = known(F.col("jurisdiction"))
    clear = F.min(j).isNull() | (F.min(j) == F.max(j))
    n = F.count(F.lit(1))
    return records.groupBy(cluster).agg(n.alias("members"), F.when(n == 1, "single").when((one("core") | one("url")) & clear, "merge").otherwise("judge").alias("route"))


def merge_faults(given: DataFrame, merged: DataFrame) -> DataFrame:
    """cluster, designation, fault of merged records: `invented` (not among those given) or `repeated`; blanks are fine."""
    out = merged.where(F.coalesce("designation", F.lit("")) != "").groupBy("cluster", "designation").agg(F.count(F.lit(1)).alias("n"))
    had = given.select("cluster", "designation", F.lit(True).alias("had")).distinct()
    fault = F.when(F.col("had").isNull(), "invented").when(F.col("n") > 1, "repeated")
    return out.join(had, ["cluster", "designation"], "left").select("cluster", "designation", fault.alias("fault")).where("fault is not null")


def ambiguous_groups(records: DataFrame, answers: DataFrame) -> DataFrame:
    """digits, members, canonical, action of groups that only a registry can tell apart.

    records: digits, core, designation, jurisdiction. A group has one digits value, two cores at least, ISO in the
    designations, and Czech or unknown members only. answers: digits, designation, is_valid. One valid designation merges
    the group under it; none or several leave it.
    """
    j = known(F.col("jurisdiction"))
    r = records.where((F.col("digits") != "") & F.contains(F.lower("designation"), F.lit("iso")) & (j.isNull() | (j == "CZ")))
    g = r.groupBy("digits").agg(F.count(F.lit(1)).alias("members"), F.min("core").alias("lo"), F.max("core").alias("hi")).where("lo <> hi")
    valid = answers.where("is_valid").where(F.trim("designation") != "")
    a = valid.groupBy("digits").agg(F.min(F.trim("designation")).alias("lo2"), F.max(F.trim("designation")).alias("hi2"))
    one = F.col("lo2") == F.col("hi2")
    return g.join(a, "digits", "left").select("digits", "members", F.when(one, F.col("lo2")).alias("canonical"), F.when(one, "merged").otherwise("inconclusive").alias("action"))


def orphan_amendments(records: DataFrame, grouped: DataFrame) -> DataFrame:
    """Amendments (level above 0) that no group of versions took in."""
    return records.where("level > 0").join(grouped.select("version_key", "jurisdiction").distinct().withColumnRenamed("jurisdiction", "_j").withColumnRenamed("version_key", "_k"), (F.col("version_key") == F.col("_k")) & F.col("jurisdiction").eqNullSafe(F.col("_j")), "left_anti")


def move_links(links: DataFrame, moves: DataFrame, ends: Sequence[str]) -> DataFrame:
    """Links after documents merge (moves: old, new): ends follow, self-links and repeats go."""
    out, columns = links, links.columns
    for end in ends:
        m = moves.select(F.col("old").alias(end), F.col("new").alias("_qs_new"))
        out = out.join(m, end, "left").withColumn(end, F.coalesce("_qs_new", end)).drop("_qs_new")
    if len(ends) == 2:
        out = out.where(F.col(ends[0]) != F.col(ends[1]))
    return out.select(*columns).distinct()


def missing_parents(records: DataFrame) -> DataFrame:
    """core, designation of the first national record, for cores without an international or EU record."""
    r = records.where((F.col("core") != "") & F.col("tier").isNotNull())
    has = F.bool_or(F.col("tier") != "national")
    return r.groupBy("core").agg(F.min_by("designation", "seq").alias("designation"), has.alias("has")).where("not has").drop("has")


# Suffixes of language variants
VARIANTS = (" [EN]", " [SK]")


def base_designation(designation: Column) -> Column:
    return F.regexp_replace(F.trim(F.coalesce(designation, F.lit(""))), r" \[(?:EN|SK)\]$", "")


def is_variant(designation: Column) -> Column:
    return F.coalesce(designation, F.lit("")).rlike(r" \[(?:EN|SK)\]$")


def split_variants(records: DataFrame, pairs: DataFrame) -> DataFrame:
    """Records with the merged row of each Czech and English pair as two: rank 0 keeps the designation, rank 1 has the
    English suffix. pairs: designation, title_cs, title_en. Applied again it changes nothing."""
    name = F.trim(F.coalesce("designation", F.lit("")))
    present = records.select(F.regexp_replace(name, r" \[EN\]$", "").alias("_qs_had"), name.rlike(r" \[EN\]$").alias("_qs_en")).where("_qs_en").select("_qs_had").distinct()
    p = pairs.select(F.trim("designation").alias("_qs_name"), "title_cs", "title_en").join(present, F.col("_qs_name") == F.col("_qs_had"), "left_anti")
    both = records.join(p, name == F.col("_qs_name"), "left")
    own = F.struct(F.lit(0).alias("rank"), F.col("designation").alias("d"), F.coalesce("title_cs", "title").alias("t"))
    english = F.when(F.col("_qs_name").isNotNull(), F.struct(F.lit(1).alias("rank"), F.concat(name, F.lit(" [EN]")).alias("d"), F.col("title_en").alias("t")))
    out = both.withColumn("v", F.explode(F.array_compact(F.array(own, english))))
    rest = [c for c in records.columns if c not in ("designation", "title")]
    return out.select(*rest, F.col("v.rank").alias("rank"), F.col("v.d").alias("designation"), F.col("v.t").alias("title"))


def translations(records: DataFrame) -> DataFrame:
    """src, dst, kind TRANSLATION_OF from each variant to its original, where that is present."""
    d = F.trim(F.coalesce("designation", F.lit("")))
    originals = records.select(d.alias("dst")).distinct()
    variants = records.where(is_variant(d)).select(d.alias("src"), base_designation(d).alias("dst")).distinct()
    return variants.join(originals, "dst", "left_semi").select("src", "dst", F.lit("TRANSLATION_OF").alias("kind"))
