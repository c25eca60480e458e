"""Operators on tables: filters, joins, merges, versions, rules and queues, each a plan of built-in operators.

Order of input decides ties and is an explicit column. What an operator cannot resolve comes back as rows, not guesses.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

KNOWN = ("CZ", "SK", "EU", "mezinárodní")
BLOCK = 256  # items of a class that travel together: two blocks make some 65,000 pairs, which a task holds at once


def contains_any(columns: Sequence[Column], words: Sequence[str]) -> Column:
    """Case-insensitive substring search; % and _ are ordinary characters."""
    tests = [F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(w.lower())) for c in columns for w in words]
    return reduce(Column.__or__, tests)


def in_jurisdiction(c: Column, choice: str, known: Sequence[str] = KNOWN) -> Column:
    """`others` is unknown or none of the known ones."""
    return c.isNull() | ~c.isin(*known) if choice == "others" else F.lit(True) if choice == "all" else c == choice


def is_public(jurisdiction: Column, designation: Column, hidden: str = "SK") -> Column:
    return ~((F.coalesce(jurisdiction, F.lit("")) == hidden) | F.endswith(F.coalesce(designation, F.lit("")), F.lit(f"[{hidden}]")))


def page(df: DataFrame, order: list[Column], number: int, size: int = 50) -> DataFrame:
    return df.orderBy(*order).offset((max(1, number) - 1) * size).limit(size)


def first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_qs_rn", F.row_number().over(w)).where(F.col("_qs_rn") <= n).drop("_qs_rn")


def lookup_ends(edges: DataFrame, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edges (src, dst designations) with ids of both ends by exact designation, and those with an end unknown."""
    a = documents.select(F.col("designation").alias("src"), F.col("id").alias("src_id"))
    b = documents.select(F.col("designation").alias("dst"), F.col("id").alias("dst_id"))
    both = edges.join(a, "src", "left").join(b, "dst", "left")
    known = F.col("src_id").isNotNull() & F.col("dst_id").isNotNull()
    return both.where(known), both.where(~known)


def neighbours(edges: DataFrame) -> DataFrame:
    """id, other, direction: each edge seen from both of its ends."""
    out = edges.select(F.col("src").alias("id"), F.col("dst").alias("other"), F.lit("out").alias("direction"))
    return out.unionByName(edges.select(F.col("dst").alias("id"), F.col("src").alias("other"), F.lit("in").alias("direction")))


def band_join(points: DataFrame, bands: DataFrame, *, at: str, low: str, high: str, width: int) -> DataFrame:
    """Points with each band low <= at < high, by an equi-join on cells of `width`; no nested loop."""
    cells = F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width)))
    b = bands.where(F.col(low) < F.col(high)).withColumn("_qs_cell", cells)
    p = points.withColumn("_qs_cell", F.floor(F.col(at) / width))
    return p.join(b, "_qs_cell").where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop("_qs_cell")


def linked_pairs(left: DataFrame, right: DataFrame, links: DataFrame, block: int = BLOCK) -> DataFrame:
    """item, other: each pair of an item of left and one of right (both: item, class) whose classes are linked (links: a, b), once.

    Items of a class travel in blocks and are paired in the task that two blocks are dealt to: a class that very many share is
    spread over all tasks, and what is moved is a small part of the pairs. Only pairs of which an item has several classes can
    come twice; only they are made distinct.
    """
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def packed(items: DataFrame, side: str) -> DataFrame:
        classes = items.groupBy("item").agg(F.collect_set("class").alias("classes"))
        each = classes.select("item", (F.size("classes") > 1).alias(f"many_{side}"), F.explode("classes").alias(side))
        parts = each.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / block).alias("parts"))
        part = F.when(F.col("item").isNull(), -1).otherwise(F.pmod(F.xxhash64("item"), "parts"))  # lists hold no null: it is a block of its own
        held = F.when(F.count("item") == 0, F.array(F.first("item"))).otherwise(F.collect_list("item"))
        return each.join(parts, side).groupBy(side, f"many_{side}", part.alias(f"part_{side}")).agg(held.alias(f"items_{side}"))

    met = links.select("a", "b").distinct().join(packed(left, "a"), "a").join(packed(right, "b"), "b")

    def pairs(of: DataFrame) -> DataFrame:
        dealt = of.repartition(tasks, "a", "b", "part_a", "part_b", "many_a", "many_b")
        return dealt.select(F.explode("items_a").alias("item"), "items_b").select("item", F.explode("items_b").alias("other"))

    several = F.col("many_a") | F.col("many_b")
    return pairs(met.where(~several)).union(pairs(met.where(several)).distinct())


def adoptions(records: DataFrame) -> DataFrame:
    """child, parent, kind of edges from national records to EU or international ones with the same core."""
    r = records.where((F.col("core") != "") & F.col("tier").isNotNull())
    child = r.where("tier = 'national'").select("core", F.col("designation").alias("child"))
    parent = r.where("tier <> 'national'").select("core", F.col("designation").alias("parent"))
    return child.join(parent, "core").where("child <> parent").select("child", "parent", F.lit("ADOPTS").alias("kind")).distinct()


def first_candidate(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """ref, target: of a reference's spellings (array `keys`, in order) the first that is a target's key; ties by seq."""
    keyed = refs.select("ref", F.posexplode("keys").alias("rank", "key"))
    return keyed.join(targets, "key").groupBy("ref").agg(F.min_by("target", F.struct("rank", "seq")).alias("target"))


def unknown(found: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of found none of whose keys is known."""
    known = known.select(F.col("key")).distinct()
    hits = found.select("id", F.explode(F.array_compact(F.array(*[F.col(k) for k in keys]))).alias("key")).join(known, "key", "left_semi")
    return found.join(hits.select("id").distinct(), "id", "left_anti")


def as_of(versions: DataFrame, key: str, date: str, asof: Column) -> DataFrame:
    """key, current (latest date <= asof), upcoming (earliest later date)."""
    d = F.col(date)
    return versions.groupBy(key).agg(F.max(F.when(d <= asof, d)).alias("current"), F.min(F.when(d > asof, d)).alias("upcoming"))


def merge_records(records: DataFrame, cluster: str, scalars: Sequence[str], lists: Sequence[str], *, packed: Sequence[str] = (), designation: str | None = None, preferred: str = "čsn ") -> DataFrame:
    """One record for each cluster: longest title (ties: first) with its own scalars, which the first non-blank ones of
    others complete; ordered unions of lists, and of the parts of packed (comma-joined) texts; the first designation that
    begins with `preferred`, else the first there is."""
    seq = F.col("seq")
    best = F.struct(F.length(F.coalesce("title", F.lit(""))), -seq)
    filled = lambda c: F.trim(F.coalesce(c, F.lit(""))) != ""
    some = [F.coalesce(F.max_by(F.when(filled(c), F.col(c)), best), F.min_by(c, F.when(filled(c), seq))).alias(c) for c in scalars]
    parts = {c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ", "), lambda x: F.trim(x)), lambda x: x != "") for c in packed}
    values = {c: F.coalesce(F.col(c), F.array().cast("array<string>")) for c in lists} | parts
    ordered = [F.array_sort(F.collect_list(F.struct("seq", v.alias("v")))).alias(c) for c, v in values.items()]
    named = []
    if designation is not None:
        d = F.trim(F.coalesce(F.col(designation), F.lit("")))
        one = lambda ok: F.min_by(d, F.when(ok, seq))
        named = [F.coalesce(one(F.lower(d).startswith(preferred)), one(d != ""), F.lit("")).alias(designation)]
    out = records.groupBy(cluster).agg(F.max_by("title", best).alias("title"), *some, *ordered, *named, F.count(F.lit(1)).alias("members"))
    union = {c: F.array_distinct(F.flatten(F.transform(c, lambda x: x["v"]))) for c in values}
    return out.withColumns(union | {c: F.array_join(union[c], ", ") for c in packed})


def cluster_kind(records: DataFrame, cluster: str) -> DataFrame:
    """cluster, members, kind, pure of records with core, jurisdiction and url (an authoritative address; may be absent).

    kind: none (one member), deterministic (members share a core or a url), semantic. pure: all cores known and equal, or
    all urls, and one known jurisdiction at most.
    """
    url = F.coalesce(F.col("url"), F.lit("")) if "url" in records.columns else F.lit("")
    known = F.when(~F.coalesce("jurisdiction", F.lit("")).isin("", "neurčeno"), F.col("jurisdiction"))
    rows = records.select(cluster, F.coalesce("core", F.lit("")).alias("core"), url.alias("url"), known.alias("known"))
    # keys are counted apart, so that no set of a large cluster is held at once
    keys = rows.select(cluster, F.explode(F.array(F.struct(F.lit("core").alias("what"), F.col("core").alias("key")), F.struct(F.lit("url").alias("what"), F.col("url").alias("key")))).alias("k"))
    counted = keys.groupBy(cluster, "k").agg(F.count(F.lit(1)).alias("n")).groupBy(cluster).agg(
        F.max(F.when(F.col("k.key") != "", F.col("n"))).alias("most"),
        F.sum(F.when(F.col("k.what") == "core", F.col("n"))).alias("members"),
        F.bool_or((F.col("k.what") == "core") & (F.col("k.key") == "")).alias("no_core"), F.count_if(F.col("k.what") == "core").alias("cores"),
        F.bool_or((F.col("k.what") == "url") & (F.col("k.key") == "")).alias("no_url"), F.count_if(F.col("k.what") == "url").alias("urls"),
    )
    places = rows.select(cluster, "known").distinct().groupBy(cluster).agg(F.count("known").alias("js"))
    one = (~F.col("no_core") & (F.col("cores") == 1)) | (~F.col("no_url") & (F.col("urls") == 1))
    kind = F.when(F.col("members") == 1, "none").when(F.coalesce("most", F.lit(0)) > 1, "deterministic").otherwise("semantic")
    return counted.join(places, cluster).select(cluster, "members", kind.alias("kind"), (one & (F.col("js") <= 1)).alias("pure"))


def version_groups(records: DataFrame, evidence: Column) -> DataFrame:
    """Groups of two or more records of one version_key and jurisdiction with evidence, as arrays of versions in order."""
    g = records.groupBy("version_key", "jurisdiction").agg(
        F.array_sort(F.collect_list(F.struct("level", "renumbered", "seq", "designation"))).alias("v"), F.bool_or(evidence).alias("ok"), F.count(F.lit(1)).alias("n")
    )
    g = g.where("ok and n >= 2 and version_key <> ''")
    return g.select("version_key", "jurisdiction", F.transform("v", lambda x, i: F.struct((i + 1).alias("version"), x["designation"].alias("designation"), (i == F.size("v") - 1).alias("is_current"))).alias("versions"))


def assign_slugs(records: DataFrame, pinned: DataFrame | None = None) -> DataFrame:
    """Adds slug: the first of a base (by designation, title, seq) gets it, others base-2, base-3; pinned ones are passed over."""
    w = Window.partitionBy("base").orderBy("designation", "title", "seq")
    ranked = records.withColumn("_qs_n", F.row_number().over(w))
    if pinned is not None:
        # a pinned slug may be a base itself or a base with a number that would be handed out
        number = F.nullif(F.regexp_extract("slug", r"-([1-9]\d{0,8})$", 1), F.lit("")).cast("int")
        ways = F.array(F.struct(F.col("slug").alias("base"), F.lit(1).alias("n")), F.when(number >= 2, F.struct(F.regexp_replace("slug", r"-\d+$", "").alias("base"), number.alias("n"))))
        taken = pinned.select(F.explode(F.array_compact(ways)).alias("w")).select("w.*")
        taken = taken.groupBy("base").agg(F.array_sort(F.collect_set("n")).alias("_qs_taken"))
        free = F.aggregate(F.coalesce("_qs_taken", F.array().cast("array<int>")), F.col("_qs_n"), lambda at, t: F.when(t <= at, at + 1).otherwise(at))
        ranked = ranked.join(taken, "base", "left").withColumn("_qs_n", free).drop("_qs_taken")
    return ranked.withColumn("slug", F.when(F.col("_qs_n") == 1, F.col("base")).otherwise(F.concat("base", F.lit("-"), F.col("_qs_n").cast("string")))).drop("_qs_n")


def islands(df: DataFrame, keys: list[str], at: str, far: Column) -> DataFrame:
    """Adds island: runs of rows in the order of `at`, cut where `far` holds (it may use gap, the step from the row before)."""
    w = Window.partitionBy(*keys).orderBy(at)
    gap = F.col(at) - F.lag(at).over(w)
    return df.withColumn("gap", gap).withColumn("island", F.sum(F.when(F.col("gap").isNull() | far, 1).otherwise(0)).over(w))


def first_rule(rules: Sequence[tuple[str, Column]], otherwise: str) -> Column:
    """Id of the first rule whose condition holds; a null condition does not."""
    out = F.lit(otherwise)
    for name, when in reversed(rules):
        out = F.when(F.coalesce(when, F.lit(False)), F.lit(name)).otherwise(out)
    return out


def address_outcome(code: Column, body: Column, blocked: Sequence[str], challenge: Sequence[str]) -> Column:
    """What an answer says of an address: its code, and marks of block pages (in the first 4000 characters) and challenges."""
    holds = lambda c, words: reduce(Column.__or__, [F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(w.lower())) for w in words])
    rules = [
        ("unreachable", code.isNull()), ("blocked", code.between(200, 299) & holds(F.left(body, F.lit(4000)), blocked)), ("ok", code.between(200, 299)),
        ("auth", code == 401), ("blocked", code.isin(403, 429) | ((code == 503) & holds(body, challenge))), ("missing", code.isin(404, 410)), ("server_error", code >= 500),
    ]
    return first_rule(rules, "reachable")


def activated(rules: DataFrame, params: DataFrame) -> DataFrame:
    """Nodes with a group of rules all of which hold: and within a group, or between groups.

    rules: node, grp, name, cmp, value; params: name, actual. Comparators on numbers: = <> < <= > >=; on lists: in, not_in;
    and set. A missing parameter holds for none.
    """
    a, v = F.col("actual").cast("double"), F.col("value").cast("double")
    parts = F.split("value", ",")
    ok = (
        F.when(F.col("cmp") == "=", F.col("actual") == F.col("value")).when(F.col("cmp") == "<>", F.col("actual") != F.col("value"))
        .when(F.col("cmp") == "<", a < v).when(F.col("cmp") == "<=", a <= v).when(F.col("cmp") == ">", a > v).when(F.col("cmp") == ">=", a >= v)
        .when(F.col("cmp") == "in", F.array_contains(parts, F.col("actual"))).when(F.col("cmp") == "not_in", ~F.array_contains(parts, F.col("actual")))
        .when(F.col("cmp") == "set", F.col("actual").isNotNull())
    )
    joined = rules.join(params, "name", "left").withColumn("ok", F.coalesce(ok, F.lit(False)))
    return joined.groupBy("node", "grp").agg(F.bool_and("ok").alias("ok")).groupBy("node").agg(F.bool_or("ok").alias("active"))


def upsert(queue: DataFrame, found: DataFrame) -> DataFrame:
    """Queue after the found rows, one row for each key, with outcome: inserted, refreshed, evidence, kept.

    queue: key, title, status, seen, first_seen; found: key, title, seen (unique keys). Decided rows take new evidence
    only; proposed ones are refreshed; first_seen never changes; a blank title does not replace one.
    """
    q, f = queue.alias("q"), found.alias("f")
    new, old = F.col("q.key").isNull(), F.col("f.key").isNull()
    decided = F.col("q.status").isin("accepted", "rejected")
    outcome = F.when(new, "inserted").when(old, "kept").when(decided, "evidence").otherwise("refreshed")
    title = F.when(outcome == "refreshed", F.coalesce(F.nullif(F.trim("f.title"), F.lit("")), F.col("q.title"))).when(new, F.col("f.title")).otherwise(F.col("q.title"))
    return q.join(f, F.col("q.key") == F.col("f.key"), "full_outer").select(
        F.coalesce("q.key", "f.key").alias("key"), title.alias("title"), F.coalesce("q.status", F.lit("proposed")).alias("status"),
        F.greatest("q.seen", "f.seen").alias("seen"), F.coalesce("q.first_seen", "f.seen").alias("first_seen"), outcome.alias("outcome"),
    )


def plan_changes(existing: DataFrame, desired: DataFrame, key: str, value: str) -> DataFrame:
    """key, action (add, drop, update), old, new: what turns existing into desired; equal rows need nothing."""
    e, d = existing.select(key, F.col(value).alias("old"), F.lit(True).alias("_e")), desired.select(key, F.col(value).alias("new"), F.lit(True).alias("_d"))
    action = F.when(F.col("_e").isNull(), "add").when(F.col("_d").isNull(), "drop").when(~F.col("old").eqNullSafe(F.col("new")), "update")
    return e.join(d, key, "full_outer").select(key, action.alias("action"), "old", "new").where("action is not null")


def rename_ends(edges: DataFrame, renamed: DataFrame) -> DataFrame:
    """Edges with replaced ends (renamed: old, new), without self-loops and repeats."""
    out = edges
    for end in ("src", "dst"):
        r = renamed.select(F.col("old").alias(end), F.col("new").alias("_qs_new"))
        out = out.join(r, end, "left").withColumn(end, F.coalesce("_qs_new", end)).drop("_qs_new")
    return out.where("src <> dst").select("src", "dst", "kind").distinct()


def get_or_create(rows: DataFrame, name: str, extra: str) -> DataFrame:
    """Dimension: name, extra of its first row, id as a hash that any run gives again."""
    return rows.where(F.col(name).isNotNull()).groupBy(name).agg(F.min_by(extra, "seq").alias(extra)).withColumn("id", F.xxhash64(name))


def closure(citations: DataFrame) -> DataFrame:
    """Cited keys (key, family, cited_by, documents, occurrences, amendment_share, first_doc) of doc, unit, key, family, amendment, position."""
    return citations.groupBy("key", "family").agg(
        F.countDistinct("unit").alias("cited_by"), F.countDistinct("doc").alias("documents"), F.count(F.lit(1)).alias("occurrences"),
        F.round(F.avg(F.col("amendment").cast("double")), 2).alias("amendment_share"), F.min("doc").alias("first_doc"),
    )


def closure_summary(closed: DataFrame, present: DataFrame, thresholds: Sequence[int]) -> DataFrame:
    """family (and `all`), threshold, keys, present, share of keys cited by threshold units at least."""
    marked = closed.join(present.select("key").distinct().withColumn("here", F.lit(1)), "key", "left")
    levels = marked.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in thresholds]))).where("cited_by >= threshold")
    out = levels.rollup("threshold", "family").agg(F.count(F.lit(1)).alias("keys"), F.count("here").alias("present"), F.grouping_id().alias("g")).where("g <= 1")
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.col("family")).alias("family"), "threshold", "keys", "present", F.round(F.col("present") / F.col("keys"), 3).alias("share"))
