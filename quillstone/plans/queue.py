"""Queries of queues, relations and prose; each goes through its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import prose as N
from quillstone.operators import queue as K
from quillstone.plans.catalogue import REC, customer, documents, events, lineitem, orders, pages, part, query, supplier
from quillstone.plans.fixtures import records

# Candidates: one for each order; both engines run this text
CANDIDATES = """SELECT o_orderkey AS id, concat(CASE o_orderkey % 4 WHEN 0 THEN 'CZ:' WHEN 1 THEN 'EU:' WHEN 2 THEN 'DRAFT-EU:' ELSE 'NORM:' END, cast(o_orderkey AS varchar(20))) AS candidate_key,
 CASE o_orderkey % 5 WHEN 0 THEN 'new' WHEN 1 THEN 'proposed' WHEN 2 THEN 'deferred' WHEN 3 THEN 'accepted' ELSE 'rejected' END AS status,
 CASE WHEN o_orderkey % 7 < 3 THEN 1 WHEN o_orderkey % 7 < 5 THEN 2 END AS tier, o_orderpriority AS title, CASE WHEN o_custkey % 3 = 0 THEN concat('N', cast(o_custkey AS varchar(20))) END AS designation,
 CASE WHEN o_custkey % 2 = 0 THEN 'citation' ELSE 'harvest' END AS source, CASE WHEN o_custkey % 4 = 0 THEN 'accept' END AS recommendation, (o_custkey % 100) / 100.0 AS confidence, o_custkey % 9 AS cited_by FROM orders"""
CAND = f"WITH c AS ({CANDIDATES}) "


def candidates(s, d) -> DataFrame:
    return s.sql(CANDIDATES.replace("FROM orders", "FROM {orders}"), orders=orders(s, d))


@query(CAND + "SELECT id, candidate_key FROM c WHERE status IN ('new', 'proposed', 'deferred') AND coalesce(tier, 1) = 1 AND (candidate_key LIKE 'EU:%' OR candidate_key LIKE 'DRAFT-EU:%') AND (contains(lower(title), 'high') OR contains(lower(coalesce(designation, '')), 'high')) AND confidence >= 0.2")
def p11_queue_filter(s, d):
    return candidates(s, d).where(K.queue_condition(family="EU", q="High", least=0.2)).select("id", "candidate_key")


@query(CAND + "SELECT 'status' AS what, status AS name, count(*) AS n FROM c GROUP BY 2 UNION ALL SELECT 'tier', cast(coalesce(tier, 1) AS varchar), count(*) FROM c WHERE status IN ('new', 'proposed', 'deferred') GROUP BY 2")
def a9_queue_counts(s, d):
    return K.queue_counts(candidates(s, d))


@query(CAND + "SELECT id, cited_by FROM c ORDER BY status = 'proposed' DESC, coalesce(tier, 1), cited_by DESC, candidate_key LIMIT 1000")
def o1_queue_order(s, d):
    """The first 1000 of the queue, as its page shows them."""
    return candidates(s, d).withColumn("occurrences", F.lit(None).cast("int")).orderBy(*K.queue_order()).limit(1000).select("id", "cited_by")


VERSIONS = "SELECT l_orderkey AS document_id, l_linenumber AS version, l_linenumber = max(l_linenumber) OVER (PARTITION BY l_orderkey) AS is_current, CASE l_returnflag WHEN 'A' THEN 'active' WHEN 'N' THEN 'promulgated' ELSE 'draft' END AS lifecycle_state, strftime(l_shipdate, '%Y-%m-%d') AS effective_date, l_shipmode AS file FROM lineitem"


def versions(s, d) -> DataFrame:
    last = lineitem(s, d).groupBy("l_orderkey").agg(F.max("l_linenumber").alias("last"))
    state = F.when(F.col("l_returnflag") == "A", "active").when(F.col("l_returnflag") == "N", "promulgated").otherwise("draft")
    return lineitem(s, d).join(last, "l_orderkey").select(
        F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("version"), (F.col("l_linenumber") == F.col("last")).alias("is_current"),
        state.alias("lifecycle_state"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("effective_date"),
    )


VER = "WITH v AS (" + VERSIONS.replace(", l_shipmode AS file", "") + ")"


@query(VER + " SELECT o_orderkey AS id, n_name AS type_name FROM orders LEFT JOIN nation ON n_nationkey = o_custkey % 30 WHERE contains(lower(o_orderpriority), 'low') AND o_orderkey IN (SELECT document_id FROM v WHERE is_current AND lifecycle_state = 'draft')")
def p12_drafts(s, d):
    o = orders(s, d).select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("title"), F.lit("").alias("identifier"), (F.col("o_custkey") % 30).alias("type_id"))
    types = s.read.parquet(f"{d}/nation.parquet").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return K.drafts(o, versions(s, d), types, ["draft"], "low").select("id", "type_name")


@query(VER + ", n AS (SELECT document_id, min(lifecycle_state) AS state FROM v WHERE is_current GROUP BY 1), r AS (SELECT DISTINCT l_orderkey AS src, l_partkey AS dst, l_linestatus AS kind FROM lineitem), e AS (SELECT src AS id, 'from' AS direction, kind, dst AS other FROM r UNION ALL SELECT dst, 'to', kind, src FROM r) SELECT e.*, o_orderpriority AS identifier, state FROM e JOIN orders ON o_orderkey = other LEFT JOIN n ON document_id = other")
def q6_relations_with_states(s, d):
    r = lineitem(s, d).select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_linestatus").alias("kind")).distinct()
    return K.relations_of(r, orders(s, d).select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("identifier")), versions(s, d))


@query(VER + " SELECT DISTINCT l_partkey AS src, o_orderkey AS id, version FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN v ON document_id = o_orderkey AND is_current WHERE o_orderpriority = '1-URGENT' AND lifecycle_state IN ('active', 'promulgated')")
def j33_replaced(s, d):
    r = lineitem(s, d).select(F.col("l_partkey").alias("src"), F.col("l_orderkey").alias("dst"), F.lit("REPEALS").alias("kind")).distinct()
    return K.replaced(r, orders(s, d).select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("type_name")), versions(s, d), "1-URGENT")


@query("WITH t AS (SELECT l_orderkey AS id, min(l_partkey) AS act FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) SELECT o_orderkey AS id, coalesce(act, o_orderkey) AS act FROM orders LEFT JOIN t ON t.id = o_orderkey")
def j3_act_ids(s, d):
    kind = F.when(F.col("l_returnflag") == "R", "TRANSLATION_OF").otherwise("AMENDS")
    r = lineitem(s, d).select(F.col("l_orderkey").alias("src"), F.col("l_partkey").alias("dst"), kind.alias("kind"))
    return K.act_ids(orders(s, d).select(F.col("o_orderkey").alias("id")), r)


LANGUAGE = "CASE {k} % 3 WHEN 0 THEN 'CS' WHEN 1 THEN 'EN' ELSE 'SK' END"


@query("WITH n AS (SELECT s_suppkey AS id, s_suppkey % 200 AS act, " + LANGUAGE.format(k="s_suppkey") + " AS l FROM supplier), o AS (SELECT p_partkey + 1000000 AS id, p_partkey % 200 AS act, " + LANGUAGE.format(k="p_size") + " AS l FROM part) SELECT DISTINCT CASE WHEN n.l = 'CS' THEN o.id ELSE n.id END AS src, CASE WHEN n.l = 'CS' THEN n.id ELSE o.id END AS dst, 'TRANSLATION_OF' AS kind FROM n JOIN o USING (act) WHERE n.l <> o.l")
def g12_translation_links(s, d):
    new = supplier(s, d).select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 200).alias("act"), F.expr(LANGUAGE.format(k="s_suppkey")).alias("language"))
    others = part(s, d).select((F.col("p_partkey") + 1000000).alias("id"), (F.col("p_partkey") % 200).alias("act"), F.expr(LANGUAGE.format(k="p_size")).alias("language"))
    return K.translation_links(new, others)


@query("WITH c AS (SELECT o_orderkey AS id, o_custkey AS k FROM orders), h AS (SELECT c_custkey AS k, c_name AS a, c_phone AS b FROM customer WHERE c_acctbal > 0), x AS (SELECT id, 0 AS o, 'own' AS v FROM c WHERE id % 2 = 0 UNION ALL SELECT id, 1, a FROM c JOIN h USING (k) UNION ALL SELECT id, 2, b FROM c JOIN h USING (k)) SELECT id, coalesce(string_agg(v, ',' ORDER BY o), '') AS successors FROM c LEFT JOIN x USING (id) GROUP BY 1".replace("c_phone", "c_mktsegment"))
def g13_successors(s, d):
    c = orders(s, d).select(F.col("o_orderkey").alias("id"), F.array(F.col("o_custkey").cast("string")).alias("keys"), F.when(F.col("o_orderkey") % 2 == 0, F.array(F.lit("own"))).alias("repealed_by"))
    h = customer(s, d).where("c_acctbal > 0").select(F.col("c_custkey").cast("string").alias("key"), F.array("c_name", "c_mktsegment").alias("repealed_by"))
    return K.successors(c, h).select("id", F.array_join("successors", ",").alias("successors"))


@query("""WITH q AS (SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN 'MPO' ELSE 'web' END AS source, CASE c_custkey % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN 'proposed' ELSE 'new' END AS status, CASE WHEN c_custkey % 3 = 0 THEN 'edited' WHEN c_custkey % 3 = 1 THEN 'first' END AS issuer FROM customer WHERE c_acctbal > 0),
 f AS (SELECT DISTINCT o_custkey AS key FROM orders)
 SELECT coalesce(q.key, f.key) AS key, coalesce(source, 'MPO') AS source, CASE WHEN q.key IS NULL THEN 'found' WHEN f.key IS NULL OR status <> 'new' THEN issuer WHEN source = 'MPO' THEN CASE WHEN issuer = 'edited' THEN issuer ELSE 'found' END ELSE coalesce(issuer, 'found') END AS issuer,
  CASE WHEN q.key IS NULL THEN 'inserted' WHEN f.key IS NULL OR status <> 'new' THEN 'kept' WHEN source = 'MPO' THEN 'refreshed' ELSE 'evidence' END AS outcome FROM q FULL JOIN f ON q.key = f.key""")  # fmt: skip
def c21_source_merge(s, d):
    k = F.col("c_custkey")
    status = F.when(k % 5 == 0, "accepted").when(k % 5 == 1, "proposed").otherwise("new")
    issuer = F.when(k % 3 == 0, "edited").when(k % 3 == 1, "first")
    q = customer(s, d).where("c_acctbal > 0").select(k.alias("key"), F.when(k % 2 == 0, "MPO").otherwise("web").alias("source"), status.alias("status"), issuer.alias("issuer"), F.lit("first").alias("proposed_issuer"), F.create_map(F.lit("old"), F.lit("1")).alias("evidence"))
    f = orders(s, d).select(F.col("o_custkey").alias("key")).distinct().select("key", F.lit("found").alias("issuer"), F.create_map(F.lit("rows"), F.lit("2")).alias("evidence"))
    return K.merge_source(q, f, "MPO").select("key", "source", "issuer", "outcome")


@query("WITH c AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 2 = 0 THEN 'valid' ELSE 'open' END AS status FROM customer WHERE c_acctbal > 0), f AS (SELECT o_custkey AS k, CASE WHEN max(o_orderkey) % 3 = 0 THEN 'valid' ELSE 'gone' END AS status FROM orders GROUP BY 1) SELECT coalesce(c.k, f.k) AS k, coalesce(f.status, c.status) AS status, CASE WHEN c.k % 4 < 2 OR f.k IS NULL THEN 'x' END AS extra, CASE WHEN f.k IS NULL THEN NULL WHEN c.status IS DISTINCT FROM f.status THEN 'state_changed' ELSE 'state_unchanged' END AS outcome FROM c FULL JOIN f ON c.k = f.k".replace("CASE WHEN c.k % 4 < 2 OR f.k IS NULL THEN 'x' END", "CASE WHEN c.k IS NOT NULL AND (c.k % 4 < 2 OR f.k IS NULL) THEN 'x' END"))
def c5_state_updates(s, d):
    key = lambda c: F.concat(F.when(c % 4 < 2, "ČSN ").otherwise("CZ:"), c.cast("string"))
    c = customer(s, d).where("c_acctbal > 0").select(key(F.col("c_custkey")).alias("key"), F.create_map(F.lit("status"), F.when(F.col("c_custkey") % 2 == 0, "valid").otherwise("open"), F.lit("extra"), F.lit("x")).alias("state"))
    last = orders(s, d).groupBy("o_custkey").agg(F.max("o_orderkey").alias("m"))
    f = last.select(key(F.col("o_custkey")).alias("key"), F.create_map(F.lit("status"), F.when(F.col("m") % 3 == 0, "valid").otherwise("gone")).alias("state"))
    out = K.state_updates(c, f, F.lit("2026-01-01"))
    return out.select(F.regexp_extract("key", r"(\d+)$", 1).cast("long").alias("k"), F.col("state")["status"].alias("status"), F.col("state")["extra"].alias("extra"), "outcome")


@query("WITH x AS (SELECT o_orderkey AS id, c_custkey AS k, c_mktsegment AS status, strftime(DATE '2020-01-01' + CAST(c_custkey % 50 AS INT), '%Y-%m-%d') AS day, CASE WHEN c_custkey = o_custkey THEN 0 ELSE 1 END AS place FROM orders JOIN customer ON c_custkey IN (o_custkey, o_custkey + 1) WHERE c_mktsegment <> 'BUILDING') SELECT o_orderkey AS id, arg_max(day, (day, -place)) AS checked_at, arg_max(k, (day, -place)) AS source FROM orders LEFT JOIN x ON id = o_orderkey GROUP BY 1")
def w15_last_check(s, d):
    docs = orders(s, d).select(F.col("o_orderkey").alias("id"), F.array("o_custkey", F.col("o_custkey") + 1).alias("keys"))
    at = F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (F.col("c_custkey") % 50).cast("int")), "yyyy-MM-dd")
    checks = customer(s, d).select(F.col("c_custkey").alias("key"), F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("nezjištěno").alias("status"), at.alias("checked_at"), F.col("c_custkey").alias("source"))
    return K.last_check(docs, checks)


@query("WITH d AS (SELECT p_partkey AS id, p_partkey % 3 = 0 AS v, p_size AS key FROM part UNION ALL SELECT p_partkey, p_partkey % 3 = 0, 100 + p_partkey % 5000 FROM part) SELECT key, coalesce(string_agg(DISTINCT cast(id AS varchar), ',' ORDER BY cast(id AS varchar)) FILTER (NOT v), cast(min(id) AS varchar)) AS documents FROM d GROUP BY 1")
def a29_key_index(s, d):
    docs = part(s, d).select(F.col("p_partkey").alias("id"), (F.col("p_partkey") % 3 == 0).alias("is_variant"), F.array(F.col("p_size").cast("long"), F.lit(100) + F.col("p_partkey") % 5000).alias("keys"))
    return K.key_index(docs).select("key", F.array_join(F.array_sort(F.transform("documents", lambda x: x.cast("string"))), ",").alias("documents"))


@query("WITH f AS (SELECT user_id, min(event_id) AS event_id FROM events GROUP BY 1) SELECT user_id, event_id FROM f WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND user_id + 7 NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def j21_unseen(s, d):
    found = events(s, d).select("user_id", "event_id", F.array("user_id", F.col("user_id") + 7).alias("spellings"))
    return K.unseen(found, customer(s, d).where("c_acctbal > 0").select(F.col("c_custkey").alias("spelling")), "user_id", "spellings", "event_id").select("user_id", "event_id")


@query("WITH r AS (SELECT concat('s', p_partkey % 900) AS slug, p_partkey AS record, concat('u', p_size) AS own FROM part), d AS (SELECT o_orderkey AS id, concat('s', o_custkey % 1000, CASE WHEN o_orderkey % 2 = 0 THEN '-2' ELSE '' END) AS slug, concat('u', o_orderkey % 60) AS url FROM orders), x AS (SELECT id, record, own = url AS same FROM d JOIN r ON regexp_replace(d.slug, '-\\d+$', '') = r.slug) SELECT id, CASE WHEN count(*) = 1 THEN min(record) ELSE min(record) FILTER (same) END AS record FROM x GROUP BY 1 HAVING count(*) = 1 OR count(*) FILTER (same) = 1")
def j40_by_slug(s, d):
    text = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    r = part(s, d).select(text("s", F.col("p_partkey") % 900).alias("slug"), F.col("p_partkey").alias("record"), text("u", F.col("p_size")).alias("url"))
    slug = F.concat(text("s", F.col("o_custkey") % 1000), F.when(F.col("o_orderkey") % 2 == 0, "-2").otherwise(""))
    return K.by_slug(orders(s, d).select(F.col("o_orderkey").alias("id"), slug.alias("slug"), text("u", F.col("o_orderkey") % 60).alias("url")), r)


@query("SELECT l_suppkey AS src, l_partkey AS dst, l_returnflag AS kind, min(l_orderkey * 10 + l_linenumber) AS seq FROM lineitem GROUP BY 1, 2, 3")
def u4_first_kept(s, d):
    rows = lineitem(s, d).select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("kind"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq"))
    return K.first_kept(rows, ["src", "dst", "kind"], "seq")


@query(VER.replace("strftime(l_shipdate, '%Y-%m-%d') AS effective_date", "l_linestatus AS file") + " SELECT document_id, arg_max(version, (is_current, version)) AS version FROM v JOIN orders ON o_orderkey = document_id AND file = o_orderstatus GROUP BY 1")
def w8_shown_version(s, d):
    v = versions(s, d).join(lineitem(s, d).select(F.col("l_orderkey").alias("document_id"), F.col("l_linenumber").alias("version"), F.col("l_linestatus").alias("file")), ["document_id", "version"])
    return K.shown_version(v, orders(s, d).select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("file")))


@query(VER + ", n AS (SELECT document_id, max(version) FILTER (is_current) AS now, max(effective_date) FILTER (is_current) AS now_date, arg_max(version, (effective_date, version)) FILTER (lifecycle_state = 'promulgated' AND effective_date <= '1996-06-01') AS new, max(effective_date) FILTER (lifecycle_state = 'promulgated' AND effective_date <= '1996-06-01') AS new_date FROM v GROUP BY 1) SELECT document_id, CASE WHEN now <> new THEN now END AS from_version, new AS to_version FROM n WHERE new IS NOT NULL AND (now = new OR now_date <= new_date)")
def i6_due_switches(s, d):
    return K.due_switches(versions(s, d), F.lit("1996-06-01"))


@query("WITH r AS (SELECT l_orderkey AS id, l_linenumber AS place, l_partkey AS a, l_suppkey AS b FROM lineitem), u AS (SELECT id, a, b, min(place) AS place FROM r GROUP BY 1, 2, 3), t AS (SELECT p_size * 100 + p_partkey % 37 AS core, min(p_partkey) AS target FROM part GROUP BY 1) SELECT DISTINCT id AS src, coalesce(x.target, y.target) AS dst, 'IMPLEMENTS' AS kind FROM u LEFT JOIN t x ON x.core = a LEFT JOIN t y ON y.core = b WHERE coalesce(x.target, y.target) IS NOT NULL AND id <> coalesce(x.target, y.target)")
def g6_implements(s, d):
    refs = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey"))), lambda x: F.array(x["l_partkey"].cast("string"), x["l_suppkey"].cast("string")))
    r = lineitem(s, d).groupBy(F.col("l_orderkey").alias("id")).agg(refs.alias("refs")).withColumn("own", F.lit(""))
    t = part(s, d).select((F.col("p_size") * 100 + F.col("p_partkey") % 37).cast("string").alias("core"), F.col("p_partkey").alias("target"), F.col("p_partkey").alias("seq"))
    return K.implements(r, t)[0]


@query("WITH d AS (SELECT concat('D', p_partkey) AS identifier, p_partkey % 500 AS key, p_partkey % 2 = 0 AS v FROM part), c AS (SELECT s_suppkey % 500 AS key, s_nationkey * 7 AS by_key FROM supplier), n AS (SELECT key, bool_or(NOT v) AS has, min(identifier) AS least FROM d GROUP BY 1) SELECT DISTINCT s.identifier AS src, g.identifier AS dst, 'REPEALS' AS kind FROM d g JOIN c ON c.key = g.key JOIN d s ON s.key = c.by_key JOIN n ON n.key = s.key WHERE ((has AND NOT s.v) OR (NOT has AND s.identifier = least)) AND s.identifier <> g.identifier")
def g6_repeals(s, d):
    docs = part(s, d).select(F.concat(F.lit("D"), F.col("p_partkey").cast("string")).alias("identifier"), F.array(F.col("p_partkey") % 500).alias("keys"), (F.col("p_partkey") % 2 == 0).alias("is_variant"))
    checks = supplier(s, d).select((F.col("s_suppkey") % 500).alias("key"), F.lit("zrušený").alias("status"), F.array(F.col("s_nationkey").cast("long") * 7).alias("repealed_by"))
    return K.repeals(docs, checks)


@query(CAND + ", x AS (SELECT cited_by * 3 + 1 AS cited_by, id % 3 = 0 AS here, id AS key, split_part(candidate_key, ':', 1) AS family, confidence AS amendment_share FROM c) SELECT key FROM x WHERE family IN ('CZ', 'EU') AND NOT here AND cited_by >= 2 AND amendment_share < 0.5 AND key NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def p15_missing_acts(s, d):
    c = candidates(s, d).select((F.col("cited_by") * 3 + 1).alias("cited_by"), (F.col("id") % 3 == 0).alias("in_database"), F.col("id").alias("key"), F.split("candidate_key", ":")[0].alias("family"), F.col("confidence").alias("amendment_share"))
    checks = lineitem(s, d).select(F.col("l_orderkey").alias("key"), F.when(F.col("l_returnflag") == "R", "zrušený").otherwise("účinný").alias("status"))
    return K.missing_acts(c, checks).select("key")


@query(REC + r"SELECT id, trim(regexp_replace(designation, '\s*/?\s*[-–—]\s*(19|20)\d{2}(\.\d{2})?\s*$', '')) AS core, concat(trim(regexp_replace(trim(designation), '\s*/?\s*[-–—]\s*(19|20)\d{2}(\.\d{2})?\s*$', '')), ' — ', title) AS shown FROM records")
def f10_norm_titles(s, d):
    """Titles with the designation at either end or in brackets get it once, before the title."""
    core = N.designation_core(F.col("designation"))
    k = F.col("id") % 4
    t = F.when(k == 0, F.concat(core, F.lit(" – "), "title")).when(k == 1, F.concat("title", F.lit(" ("), core, F.lit(": 2020)"))).when(k == 2, F.concat("title", F.lit(", "), core)).otherwise(F.col("title"))
    return records(s, d).select("id", core.alias("core"), N.norm_title(t, F.col("designation")).alias("shown"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 5 = 1 THEN concat('N ', event_id) WHEN event_id % 5 = 2 THEN concat('url-', substr(sha256(concat('http://x/', user_id)), 1, 8)) ELSE concat('title-', substr(sha256(concat('t ', user_id)), 1, 8)) END AS filed FROM events")
def f25_filed_under(s, d):
    k, u = F.col("event_id") % 5, F.col("user_id").cast("string")
    named = F.when(k == 1, F.concat(F.lit(" N "), F.col("event_id").cast("string")))
    url = F.when(k == 2, F.concat(F.lit("http://x/"), u, F.lit("\nhttp://y/")))
    return events(s, d).select("event_id", N.filed_under(named, url, F.when(k > 2, F.concat(F.lit(" t   "), u))).alias("filed"))


@query("SELECT page_id, regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host, regexp_matches(html, '(?i)hydrogen|vodík|wasserstoff|rfnbo') AS named FROM pages".replace(", regexp_extract(lower(url), '^[a-z]+://([^/:?#]+)', 1) AS host", ""))
def p19_names_hydrogen(s, d):
    return pages(s, d).select("page_id", N.names_hydrogen(F.array("url", F.regexp_replace("html", r"(?i)fuel[ -]cell|\bh2\b", ""))).alias("named"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)[áčďéěíňóřšťúůýž]') THEN 'CS' ELSE 'EN' END AS guessed, len(regexp_extract_all(text, '\\[(\\d+)\\]')) AS refs, CAST(contains(lower(text), 'license') AS INT) * 1 + CAST(contains(lower(text), 'secur') AS INT) * 2 AS areas FROM documents")
def f32_guesses(s, d):
    areas = N.keyword_areas(F.col("text"), {2: ["secur"], 1: ["License"]})
    return documents(s, d).select("doc_id", N.guessed_language(F.col("text")).alias("guessed"), F.size(N.bracket_refs(F.col("text"))).cast("long").alias("refs"), F.aggregate(areas, F.lit(0), lambda a, x: a + x).alias("areas"))
