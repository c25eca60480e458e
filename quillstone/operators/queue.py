"""Queues of candidates and drafts: filters, counts, merges of findings, relations that follow, checks, scheduled changes."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.operators import relational as R

OPEN = ("new", "proposed", "deferred")
DECIDED = ("accepted", "rejected")
INCONCLUSIVE = ("", "nezjištěno")  # fixed values: outcomes of a check that say nothing


def queue_condition(*, states: Sequence[str] = OPEN, tier: str = "1", source: str = "", family: str = "", q: str = "", recommendation: str = "", least: float | None = None) -> Column:
    """Filter of the queue on status, tier, source, candidate_key, title, designation, recommendation, confidence.

    No tier is the first; a family's drafts have keys of their own; blanks choose nothing.
    """
    out = F.col("status").isin(*states)
    if tier != "all":
        out = out & (F.coalesce("tier", F.lit(1)) == int(tier))
    if source:
        out = out & (F.col("source") == source)
    if family:
        out = out & (F.col("candidate_key").startswith(f"{family}:") | F.col("candidate_key").startswith(f"DRAFT-{family}:"))
    if q:
        out = out & R.contains_any([F.col("title"), F.col("designation")], [q])
    if recommendation:
        out = out & (F.col("recommendation") == recommendation)
    if least is not None:
        out = out & (F.col("confidence") >= least)
    return out


def queue_order() -> list[Column]:
    """Proposals first, then by tier, citing documents, occurrences, key."""
    return [F.desc(F.col("status") == "proposed"), F.coalesce("tier", F.lit(1)), F.desc("cited_by"), F.desc(F.coalesce("occurrences", F.lit(0))), F.col("candidate_key")]


def queue_counts(queue: DataFrame, states: Sequence[str] = OPEN) -> DataFrame:
    """what (status, tier), name, n: all candidates by status, the open ones by tier; one pass."""
    tier = F.when(F.col("status").isin(*states), F.coalesce("tier", F.lit(1)).cast("string"))
    both = F.array(F.struct(F.lit("status").alias("what"), F.col("status").alias("name")), F.struct(F.lit("tier").alias("what"), tier.alias("name")))
    return queue.select(F.explode(both).alias("x")).select("x.*").where("name is not null").groupBy("what", "name").agg(F.count(F.lit(1)).alias("n"))


def drafts(documents: DataFrame, versions: DataFrame, types: DataFrame, states: Sequence[str], q: str = "") -> DataFrame:
    """Documents whose current version is in one of the states, with the name of their type."""
    now = versions.where(F.col("is_current") & F.col("lifecycle_state").isin(*states)).select("document_id")
    out = documents.join(now, F.col("id") == F.col("document_id"), "left_semi")
    out = out.where(R.contains_any([F.col("title"), F.col("identifier")], [q])) if q else out
    return out.join(types.select(F.col("id").alias("type_id"), F.col("name").alias("type_name")), "type_id", "left")


def missing_acts(closed: DataFrame, checks: DataFrame, *, families: Sequence[str] = ("CZ", "EU"), least: int = 2, present: str = "in_database") -> DataFrame:
    """Rows of a closure that become candidates: acts not in the catalogue, cited by `least` documents, not mainly for their
    amendments, and not known to be repealed (checks: key, status)."""
    wanted = closed.where(F.col("family").isin(*families) & ~F.col(present) & (F.col("cited_by") >= least) & (F.col("amendment_share") < 0.5))
    gone = checks.where("status = 'zrušený'").select("key").distinct()
    return wanted.join(gone, "key", "left_anti")


def sheet(closed: DataFrame, least: int = 2, present: str = "in_database") -> DataFrame:
    """What a person decides on: missing documents with an empty column for the decision."""
    rows = closed.where(~F.col(present) & (F.col("cited_by") >= least) & (F.col("amendment_share") < 0.5))
    return rows.withColumn("decision", F.lit(""))


def translation_links(new: DataFrame, others: DataFrame) -> DataFrame:
    """src, dst, kind of links from new language versions to all other versions of their act (act, id, language).

    A link goes to the Czech text, between two others from the new one; a text of the same language has none.
    """
    o = others.select("act", F.col("id").alias("other"), F.col("language").alias("other_language"))
    both = new.select("act", "id", "language").join(o, "act").where((F.col("id") != F.col("other")) & (F.col("language") != F.col("other_language")))
    czech = F.col("language") == "CS"
    return both.select(F.when(czech, F.col("other")).otherwise(F.col("id")).alias("src"), F.when(czech, F.col("id")).otherwise(F.col("other")).alias("dst"), F.lit("TRANSLATION_OF").alias("kind")).distinct()


def successors(candidates: DataFrame, checks: DataFrame) -> DataFrame:
    """id, successors of candidates (id, keys, repealed_by): their own evidence first, then the checks (key, repealed_by) of
    their keys in order; each once."""
    of_key = candidates.select("id", F.explode("keys").alias("key")).join(checks.select("key", F.col("repealed_by").alias("more")), "key")
    listed = of_key.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("key", "more"))).alias("m"))
    none = F.array().cast("array<string>")
    more = F.flatten(F.transform("m", lambda x: F.coalesce(x["more"], none)))
    return candidates.join(listed, "id", "left").select("id", F.array_distinct(F.concat(F.coalesce("repealed_by", none), F.coalesce(more, none))).alias("successors"))


def merge_source(queue: DataFrame, found: DataFrame, source: str) -> DataFrame:
    """Queue after one source's findings (unique keys), with outcome: inserted, refreshed, evidence or kept.

    queue: key, source, status, issuer, proposed_issuer, evidence (map); found: key, issuer, evidence. The source's own
    open rows are refreshed; another's get its evidence and an issuer if they have none; decided and proposed rows stay.
    An issuer that an editor changed (it differs from the one proposed) survives.
    """
    q, f = queue.alias("q"), found.alias("f")
    c = F.col
    there = c("q.key").isNotNull() & c("f.key").isNotNull()
    fixed = c("q.status").isin(*DECIDED, "proposed")
    kind = F.when(c("q.key").isNull(), "inserted").when(~there | fixed, "kept").when(c("q.source") == source, "refreshed").otherwise("evidence")
    joined = q.join(f, c("q.key") == c("f.key"), "full_outer").withColumn("kind", kind)
    none = F.create_map().cast("map<string,string>")
    merged = F.map_concat(F.map_filter(F.coalesce("q.evidence", none), lambda k, _: ~F.map_contains_key(F.coalesce("f.evidence", none), k)), F.coalesce("f.evidence", none))
    edited = c("q.issuer").isNotNull() & ~c("q.issuer").eqNullSafe(c("q.proposed_issuer"))
    takes = c("kind").isin("refreshed", "evidence")
    issuer = F.when(c("kind") == "inserted", c("f.issuer")).when(c("kind") == "refreshed", F.when(edited, c("q.issuer")).otherwise(c("f.issuer")))
    issuer = issuer.when(c("kind") == "evidence", F.coalesce("q.issuer", "f.issuer")).otherwise(c("q.issuer"))
    evidence = F.when(c("kind") == "inserted", c("f.evidence")).when(takes, merged).otherwise(c("q.evidence"))
    sorted_entries = lambda m: F.array_sort(F.map_entries(F.coalesce(m, none)))
    same = takes & issuer.eqNullSafe(c("q.issuer")) & (sorted_entries(evidence) == sorted_entries(c("q.evidence")))
    return joined.select(
        F.coalesce("q.key", "f.key").alias("key"), F.coalesce(c("q.source"), F.lit(source)).alias("source"), F.coalesce(c("q.status"), F.lit("new")).alias("status"),
        issuer.alias("issuer"), F.when(c("kind").isin("inserted", "refreshed"), c("f.issuer")).otherwise(c("q.proposed_issuer")).alias("proposed_issuer"),
        evidence.alias("evidence"), F.when(same, "kept").otherwise(c("kind")).alias("outcome"),
    )


def with_finding(findings: Column, source: Column, finding: Column) -> Column:
    """Findings by source (map of structs with first_seen) with one source's replaced; its first_seen stays."""
    before = findings[source]["first_seen"]
    new = finding.withField("first_seen", F.coalesce(before, finding["seen"]))
    others = F.map_filter(findings, lambda k, _: k != source)
    return F.map_concat(others, F.create_map(source, new))


def overlaid(old: Column, new: Column) -> Column:
    """Map of both, the new values where both have a key."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.map_contains_key(new, k)), new)


def image(*columns: str) -> Column:
    """A row as JSON, nulls included, for a log of changes."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def field_changes(pairs: Mapping[str, tuple[Column, Column]]) -> Column:
    """Fields whose value changes, as (field, old, new) texts; null and blank are one."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    rows = [F.when(text(a) != text(b), F.struct(F.lit(name).alias("field"), text(a).alias("old"), text(b).alias("new"))) for name, (a, b) in pairs.items()]
    return F.array_compact(F.array(*rows))


def state_updates(cache: DataFrame, found: DataFrame, today: Column) -> DataFrame:
    """key, state (map), outcome (state_changed, state_unchanged, null for keys without news) of a cache of checks.

    found: key, state. Acts (CZ, EU) get the new state alone, standards have it laid over the old one.
    """
    c, f = cache.alias("c"), found.alias("f")
    none = F.create_map().cast("map<string,string>")
    act = F.split("f.key", ":")[0].isin("CZ", "EU")
    old, new = F.coalesce("c.state", none), F.col("f.state")
    state = overlaid(overlaid(F.when(act, none).otherwise(old), new), F.create_map(F.lit("checked_at"), today))
    changed = (F.map_contains_key(new, "status") & ~old["status"].eqNullSafe(new["status"])) | (F.size(old) == 0)
    has = F.col("f.key").isNotNull()
    outcome = F.when(has, F.when(changed, "state_changed").otherwise("state_unchanged"))
    return c.join(f, F.col("c.key") == F.col("f.key"), "full_outer").select(F.coalesce("c.key", "f.key").alias("key"), F.when(has, state).otherwise(old).alias("state"), outcome.alias("outcome"))


def act_action(*, reason: Column, amending: Column, full_text: Column, targets: Column, known: Column, others: Column, in_scope: Column) -> Column:
    """action, tier, target of a found act: excluded by its title, attached to another found act, an amendment of a
    document, or a candidate. targets: keys that its title changes; known, others: those in the catalogue, in the find."""
    struct = lambda action, tier, target: F.struct(F.lit(action).alias("action"), F.lit(tier).cast("int").alias("tier"), target.cast("string").alias("target"))
    none, changes = F.lit(None), amending | full_text
    here, found = F.array_sort(F.array_intersect(targets, known)), F.array_sort(F.array_intersect(targets, others))
    first = lambda a: F.get(a, F.lit(0))
    return (
        F.when(reason.isNotNull(), struct("exclude", None, none)).when(changes & full_text & (F.size(here) > 0), struct("exclude", None, first(here)))
        .when(changes & amending & (F.size(here) > 0), struct("amendment", 1, F.array_join(here, ","))).when(changes & (F.size(found) > 0), struct("attach", None, first(found)))
        .when(changes, struct("candidate", 2, none)).when(in_scope, struct("candidate", 1, none)).otherwise(struct("candidate", 2, none))
    )


def draft_tier(amends_known: Column, named: Column, in_scope: Column) -> Column:
    """1 for drafts that amend a document or name the subject, 2 within its scope, else null."""
    return F.when(amends_known | named, 1).when(in_scope, 2)


def last_check(documents: DataFrame, checks: DataFrame) -> DataFrame:
    """id, checked_at, source of the latest conclusive check of any of a document's keys (array); ties: the first key."""
    ok = checks.where(~F.coalesce("status", F.lit("")).isin(*INCONCLUSIVE) & (F.coalesce("checked_at", F.lit("")) != ""))
    each = documents.select("id", F.posexplode("keys").alias("place", "key")).join(ok, "key")
    best = F.max_by(F.struct("checked_at", "source"), F.struct("checked_at", -F.col("place"))).alias("b")
    return documents.select("id").join(each.groupBy("id").agg(best), "id", "left").select("id", "b.checked_at", "b.source")


def key_index(documents: DataFrame) -> DataFrame:
    """key, documents (ids in order, unvaried ones alone where there are such), first of documents (id, keys, is_variant)."""
    each = documents.select("id", "is_variant", F.explode("keys").alias("key"))
    plain = F.array_sort(F.collect_set(F.when(~F.col("is_variant"), F.col("id"))))
    out = each.groupBy("key").agg(plain.alias("plain"), F.min("id").alias("any"))
    return out.select("key", F.when(F.size("plain") > 0, F.col("plain")).otherwise(F.array("any")).alias("documents"))


def unseen(found: DataFrame, known: DataFrame, key: str, spellings: str, order: str) -> DataFrame:
    """Found rows, each key once (the first), none of whose spellings is known (known: spelling)."""
    once = R.first_rows(found, [key], [F.col(order)])
    hits = once.select(key, F.explode(spellings).alias("spelling")).join(known.select("spelling").distinct(), "spelling", "left_semi")
    return once.join(hits.select(key).distinct(), key, "left_anti")


def by_slug(documents: DataFrame, records: DataFrame) -> DataFrame:
    """id, record of documents (id, slug, url) found by their slug, or by it without a number at its end where the whole is
    no record's; of several records (record, slug, url) the only one with the document's address."""
    bases = records.select("slug").distinct()
    cut = F.regexp_replace("slug", r"-\d+$", "")
    whole = documents.join(bases, "slug", "left_semi")
    rest = documents.join(bases, "slug", "left_anti").withColumn("slug", cut)
    both = whole.unionByName(rest).join(records.select("slug", "record", F.col("url").alias("own")), "slug")
    same = F.coalesce("own", F.lit("")) == F.coalesce("url", F.lit(""))
    out = both.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_if(same).alias("m"), F.min("record").alias("any"), F.min(F.when(same, F.col("record"))).alias("one"))
    return out.where("n = 1 or m = 1").select("id", F.when(F.col("n") == 1, F.col("any")).otherwise(F.col("one")).alias("record"))


def first_kept(rows: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Rows without repeats of their keys; the first by `order` stays."""
    return R.first_rows(rows, list(keys), [F.col(order)])


def shown_version(versions: DataFrame, documents: DataFrame) -> DataFrame:
    """document_id, version of versions that hold their document's file; the current one before others, then the newest."""
    v = versions.join(documents.select(F.col("id").alias("document_id"), F.col("file").alias("own")), "document_id").where("file = own")
    return v.groupBy("document_id").agg(F.max_by("version", F.struct("is_current", "version")).alias("version"))


def relations_of(relations: DataFrame, documents: DataFrame, versions: DataFrame) -> DataFrame:
    """id, direction, kind, other, identifier, state: each relation from both ends with the other document's current state."""
    now = versions.where("is_current").groupBy("document_id").agg(F.min("lifecycle_state").alias("state"))
    named = documents.select(F.col("id").alias("other"), "identifier").join(now, F.col("other") == F.col("document_id"), "left").drop("document_id")
    ends = F.array(F.struct(F.col("src").alias("id"), F.col("dst").alias("other"), F.lit("from").alias("direction")), F.struct(F.col("dst").alias("id"), F.col("src").alias("other"), F.lit("to").alias("direction")))
    return relations.select("kind", F.explode(ends).alias("e")).select("kind", "e.*").join(named, "other").select("id", "direction", "kind", "other", "identifier", "state")


def replaced(relations: DataFrame, documents: DataFrame, versions: DataFrame, type_name: str, states: Sequence[str] = ("active", "promulgated")) -> DataFrame:
    """src, id, version of documents of one type that are replaced (REPEALS) and whose current version is in effect."""
    d = documents.where(F.col("type_name") == type_name).select("id")
    v = versions.where(F.col("is_current") & F.col("lifecycle_state").isin(*states)).select(F.col("document_id").alias("id"), "version")
    return relations.where("kind = 'REPEALS'").select("src", F.col("dst").alias("id")).join(d, "id").join(v, "id").select("src", "id", "version").distinct()


def act_ids(documents: DataFrame, relations: DataFrame) -> DataFrame:
    """id, act: the document that a language version is a translation of, else itself."""
    t = relations.where("kind = 'TRANSLATION_OF'").groupBy(F.col("src").alias("id")).agg(F.min("dst").alias("to"))
    return documents.select("id").join(t, "id", "left").select("id", F.coalesce("to", "id").alias("act"))


def implements(records: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """IMPLEMENTS edges and missing references of records (id, own, refs: spellings of each reference in order) by the first
    spelling that is a target's core (core, target, seq). References to oneself are none, repeated ones count once."""
    each = records.select("id", F.coalesce("own", F.lit("")).alias("own"), F.posexplode(F.array_distinct("refs")).alias("place", "spellings"))
    each = each.where(~F.array_contains("spellings", F.col("own"))).withColumn("ref", F.struct("id", "place"))
    first = targets.groupBy(F.col("core").alias("key")).agg(F.min_by("target", "seq").alias("target"), F.min("seq").alias("seq"))
    found = R.first_candidate(each.select("ref", F.col("spellings").alias("keys")), first)
    hit = found.select(F.col("ref.id").alias("src"), F.col("target").alias("dst")).where("src <> dst").select("src", "dst", F.lit("IMPLEMENTS").alias("kind")).distinct()
    missing = each.join(found.where(F.col("ref.id") != F.col("target")).select("ref"), "ref", "left_anti").select("id", F.col("spellings")[0].alias("ref"))
    return hit, missing


def repeals(documents: DataFrame, checks: DataFrame) -> DataFrame:
    """src, dst, kind REPEALS from successors that are in the catalogue to repealed documents (identifier, keys, is_variant).

    checks: key, status, repealed_by. Where a successor's original is there its language versions are left out.
    """
    d = documents.where(F.coalesce("identifier", F.lit("")) != "")
    links = checks.where("status = 'zrušený'").select(F.col("key").alias("a"), F.explode("repealed_by").alias("b"))
    names = d.select("identifier", "is_variant", F.explode("keys").alias("by"))
    original = names.groupBy("by").agg(F.bool_or(~F.col("is_variant")).alias("has"), F.min("identifier").alias("least"))
    chosen = names.join(original, "by").where((F.col("has") & ~F.col("is_variant")) | (~F.col("has") & (F.col("identifier") == F.col("least"))))
    pairs = R.linked_pairs(names.select(F.col("identifier").alias("item"), F.col("by").alias("class")), chosen.select(F.col("identifier").alias("item"), F.col("by").alias("class")), links)
    return pairs.where("item <> other").select(F.col("other").alias("src"), F.col("item").alias("dst"), F.lit("REPEALS").alias("kind"))


def due_switches(versions: DataFrame, today: Column) -> DataFrame:
    """document_id, from_version, to_version where a promulgated version has come into effect by today.

    The newest due one becomes current, unless the current one's date of effect is later.
    """
    due = (F.col("lifecycle_state") == "promulgated") & (F.col("effective_date") <= today)
    own = F.struct("version", "effective_date")
    out = versions.groupBy("document_id").agg(
        F.max_by(own, F.when(due, F.struct("effective_date", "version"))).alias("new"), F.max(F.when(F.col("is_current"), own)).alias("now"),
    )
    earlier = F.col("now").isNull() | F.col("now.effective_date").isNull() | (F.col("now.effective_date") <= F.col("new.effective_date"))
    same = F.col("now.version").eqNullSafe(F.col("new.version"))
    return out.where(F.col("new").isNotNull() & (same | earlier)).select("document_id", F.when(~same, F.col("now.version")).alias("from_version"), F.col("new.version").alias("to_version"))


def ranked_closure(closed: DataFrame) -> DataFrame:
    return closed.orderBy(F.desc("cited_by"), "family", "key")


def seeded_sample(queue: DataFrame, key: str, seed: int, n: int) -> DataFrame:
    """n rows in an order that key and seed decide, whatever the partitions."""
    return queue.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def page_numbers(page: int, pages: int, window: int = 2) -> list[int | None]:
    """Pages to link to: the first, the last and those around; None for a gap."""
    if pages <= 1:
        return []
    around = set(range(max(1, page - window), min(pages, page + window) + 1)) | {1, pages}
    out: list[int | None] = []
    for p in sorted(around):
        if out and out[-1] is not None and p > out[-1] + 1:
            out.append(None)
        out.append(p)
    return out


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """name, n of each table, in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def run_sources(sources: Mapping[str, Callable[[], DataFrame]], write: Callable[[str, DataFrame], None]) -> dict[str, str]:
    """Runs each registered source on its own; one that fails leaves its error, the others go on."""
    out = {}
    for name, load in sources.items():
        try:
            write(name, load())
            out[name] = "ok"
        except Exception as error:  # noqa: BLE001  the error is the result
            out[name] = f"{type(error).__name__}: {error}".splitlines()[0]
    return out
