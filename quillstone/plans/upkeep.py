"""Queries of upkeep: decisions, rules, planned changes, health of a load, reports."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.operators import filters as P
from quillstone.operators import ordered as O
from quillstone.operators import relational as R
from quillstone.plans.catalogue import conv, customer, documents, events, lineitem, nation, orders, pages, part, query, region, supplier


@query()
def c8_two_person_decisions(s, d):
    """Events as steps: users decide on items, five kinds of events are five steps."""
    step = F.create_map(*[F.lit(x) for kv in zip(("view", "click", "signup", "purchase", "error"), ("propose", "confirm", "defer", "reopen", "reject"), strict=True) for x in kv])
    e = events(s, d).select((F.col("user_id") % 40).alias("item"), F.col("event_id").alias("seq"), step[F.col("event_type")].alias("action"), F.col("user_id").cast("string").alias("person"), F.col("props").alias("note"))
    return O.decide(e)


CHANGED = "CASE WHEN o_orderkey % 7 = 0 THEN 'X' WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END"


@query(f"SELECT o_orderkey, o_orderstatus AS old, {CHANGED} AS new FROM orders WHERE o_orderstatus IS DISTINCT FROM {CHANGED}")
def c15_backfill_plan(s, d):
    new = F.when(F.col("o_orderkey") % 7 == 0, "X").when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus"))
    out = orders(s, d).select("o_orderkey", F.col("o_orderstatus").alias("old"), new.alias("new"))
    return out.where(~F.col("old").eqNullSafe(F.col("new")))


@query("WITH v AS (SELECT conv_id, turn, role = 'assistant' AS is_current FROM conversations) SELECT conv_id, 'current versions' AS broken, CAST(count(*) FILTER (is_current) AS BIGINT) AS n FROM v GROUP BY 1 HAVING count(*) FILTER (is_current) <> 1 UNION ALL SELECT o_custkey, 'repeated slug', count(*) FROM orders GROUP BY 1 HAVING count(*) > 1")
def c17_broken_invariants(s, d):
    n = F.count_if(F.col("role") == "assistant")
    versions = conv(s, d).groupBy("conv_id").agg(n.alias("n")).where("n <> 1").select("conv_id", F.lit("current versions").alias("broken"), "n")
    slugs = orders(s, d).groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("o_custkey", F.lit("repeated slug"), "n")
    return versions.union(slugs)


@query("SELECT source AS name, count(DISTINCT sha256(text)) AS contents, count(*) AS files FROM documents GROUP BY 1 HAVING count(DISTINCT sha256(text)) > 1")
def c20_name_conflicts(s, d):
    h = F.sha2("text", 256)
    return documents(s, d).groupBy(F.col("source").alias("name")).agg(F.countDistinct(h).alias("contents"), F.count(F.lit(1)).alias("files")).where("contents > 1")


@query("SELECT s_suppkey FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal < -900 AND c_nationkey IS NOT NULL)")
def c13_without_orphans(s, d):
    gone = customer(s, d).where("c_acctbal < -900").select("c_nationkey").where("c_nationkey is not null")
    return supplier(s, d).join(gone, F.col("s_nationkey") == F.col("c_nationkey"), "left_anti").select("s_suppkey")


@query("SELECT c_custkey AS key, 'kept' AS origin FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT DISTINCT o_custkey, 'inserted' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0)")
def c11_insert_if_absent(s, d):
    kept = customer(s, d).where("c_custkey % 3 = 0").select(F.col("c_custkey").alias("key"))
    new = orders(s, d).select(F.col("o_custkey").alias("key")).distinct().join(kept, "key", "left_anti")
    return kept.withColumn("origin", F.lit("kept")).union(new.withColumn("origin", F.lit("inserted")))


@query("""WITH v AS (SELECT o_custkey AS doc, 'original' AS label, DATE '1990-01-01' AS effective, 0 AS k FROM orders GROUP BY 1 UNION ALL SELECT o_custkey, cast(o_orderkey AS varchar), o_orderdate::date, o_orderkey FROM orders WHERE o_orderstatus = 'F')
 SELECT doc, label, row_number() OVER (PARTITION BY doc ORDER BY effective, k) AS version, k = arg_max(k, (effective, k)) FILTER (effective <= DATE '2023-06-01') OVER (PARTITION BY doc) AS is_current FROM v""")  # fmt: skip
def c7_desired_versions(s, d):
    """The original and all consolidations in order; the last in effect on the day is current."""
    o = orders(s, d)
    first = o.select(F.col("o_custkey").alias("doc")).distinct().select("doc", F.lit("original").alias("label"), F.lit("1990-01-01").cast("date").alias("effective"), F.lit(0).cast("long").alias("k"))
    v = first.union(o.where("o_orderstatus = 'F'").select("o_custkey", F.col("o_orderkey").cast("string"), F.to_date("o_orderdate"), "o_orderkey"))
    w = Window.partitionBy("doc")
    in_effect = F.when(F.col("effective") <= F.lit("2023-06-01").cast("date"), F.struct("effective", "k"))
    return v.select("doc", "label", F.row_number().over(w.orderBy("effective", "k")).alias("version"), (F.col("k") == F.max_by("k", in_effect).over(w)).alias("is_current"))


@query("SELECT p_type AS reason, count(*) AS n FROM part GROUP BY 1 ORDER BY n DESC, reason LIMIT 10")
def a7_top_reasons(s, d):
    return part(s, d).groupBy(F.col("p_type").alias("reason")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason").limit(10)


@query("SELECT p_brand AS issuer, arg_min(p_size, p_partkey) FILTER (p_size > 25) AS jurisdiction FROM part GROUP BY 1")
def a13_first_known(s, d):
    return part(s, d).groupBy(F.col("p_brand").alias("issuer")).agg(F.min_by("p_size", F.when(F.col("p_size") > 25, F.col("p_partkey"))).alias("jurisdiction"))


@query("SELECT l_suppkey AS key, count(*) AS items, CASE WHEN l_suppkey % 2 = 0 THEN 'state_change' ELSE 'new' END AS signal, max(l_orderkey) FILTER (l_returnflag = 'N') AS last_open FROM lineitem GROUP BY l_suppkey HAVING l_suppkey % 2 = 0 OR bool_or(l_returnflag = 'N')")
def a31_listed_standards(s, d):
    """Known keys are state changes; unknown ones are new if a row is open."""
    open_ = F.when(F.col("l_returnflag") == "N", F.col("l_orderkey"))
    out = lineitem(s, d).groupBy(F.col("l_suppkey").alias("key")).agg(F.count(F.lit(1)).alias("items"), F.max(open_).alias("last_open"))
    signal = F.when(F.col("key") % 2 == 0, "state_change").when(F.col("last_open").isNotNull(), "new")
    return out.select("key", "items", signal.alias("signal"), "last_open").where("signal is not null")


@query("WITH last AS (SELECT o_custkey, max(o_orderkey) AS v FROM orders GROUP BY 1) SELECT last.o_custkey AS act, v AS version, count(*) AS occurrences FROM last JOIN orders ON o_orderkey = v JOIN lineitem ON l_orderkey = v WHERE o_orderstatus <> 'P' GROUP BY 1, 2")
def a32_hits_of_last_version(s, d):
    last = orders(s, d).groupBy(F.col("o_custkey").alias("act")).agg(F.max_by(F.struct("o_orderkey", "o_orderstatus"), "o_orderkey").alias("v"))
    last = last.where("v.o_orderstatus <> 'P'").select("act", F.col("v.o_orderkey").alias("version"))
    return last.join(lineitem(s, d), F.col("version") == F.col("l_orderkey")).groupBy("act", "version").agg(F.count(F.lit(1)).alias("occurrences"))


@query("SELECT user_id, max(ts) AS last_activity, bool_or(event_type = 'purchase') OR date_diff('day', max(ts)::date, DATE '2024-07-20') > 180 AS over FROM events GROUP BY 1")
def a33_quiet_procedures(s, d):
    last = F.max("ts")
    over = F.bool_or(F.col("event_type") == "purchase") | (F.datediff(F.lit("2024-07-20").cast("date"), last.cast("date")) > 180)
    return events(s, d).groupBy("user_id").agg(last.alias("last_activity"), over.alias("over"))


@query("SELECT event_type AS term, user_id AS native, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_type, event_id) AS n FROM events) WHERE n = 1")
def u10_hits_once(s, d):
    """Hits of several search terms, each native id with its first term."""
    hit = F.min(F.struct("event_type", "event_id")).alias("h")
    return events(s, d).groupBy(F.col("user_id").alias("native")).agg(hit).select(F.col("h.event_type").alias("term"), "native", "h.event_id")


@query("WITH m AS (SELECT user_id, max(ts) AS since FROM events WHERE ts < TIMESTAMP '2024-01-15' AND user_id % 2 = 0 GROUP BY 1) SELECT event_id FROM events JOIN m USING (user_id) WHERE ts > since")
def i9_rows_after_baseline(s, d):
    marks = events(s, d).where("ts < timestamp'2024-01-15' and user_id % 2 = 0").groupBy("user_id").agg(F.max("ts").alias("since"))
    return events(s, d).join(marks, "user_id").where("ts > since").select("event_id")


@query("SELECT event_id FROM events WHERE ts::date >= DATE '2024-01-30' - 7")
def i10_look_back(s, d):
    return events(s, d).where(F.col("ts") >= F.date_sub(F.lit("2024-01-30").cast("date"), 7).cast("timestamp")).select("event_id")


@query("SELECT s_suppkey FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 49)")
def u6_unreferenced(s, d):
    used = lineitem(s, d).where("l_returnflag = 'R' and l_quantity > 49").select("l_suppkey")
    return supplier(s, d).join(used, F.col("s_suppkey") == F.col("l_suppkey"), "left_anti").select("s_suppkey")


CODE = "CASE WHEN event_type = 'error' THEN 503 WHEN event_type = 'click' THEN 404 WHEN event_type = 'signup' THEN 403 WHEN event_type = 'purchase' THEN NULL ELSE 200 END"


@query(f"SELECT event_id, CASE WHEN c IS NULL THEN 'unreachable' WHEN c BETWEEN 200 AND 299 THEN CASE WHEN contains(props, '7') THEN 'blocked' ELSE 'ok' END WHEN c = 401 THEN 'auth' WHEN c IN (403, 429) OR (c = 503 AND contains(props, '1')) THEN 'blocked' WHEN c IN (404, 410) THEN 'missing' WHEN c >= 500 THEN 'server_error' ELSE 'reachable' END AS outcome FROM (SELECT event_id, props, {CODE} AS c FROM events)")
def r10_address_outcomes(s, d):
    e = events(s, d).withColumn("code", F.expr(CODE))
    return e.select("event_id", R.address_outcome(F.col("code"), F.col("props"), ["7"], ["1"]).alias("outcome"))


@query("SELECT s_suppkey AS id, CASE WHEN s_suppkey % 5 = 0 THEN 'not harvested' WHEN s_nationkey = 3 THEN 'by hand' WHEN s_suppkey % 4 = 1 THEN 'on demand' WHEN s_nationkey < 10 THEN 'run' WHEN s_nationkey < 15 THEN 'deferred' ELSE 'no adapter' END AS plan FROM supplier")
def r9_source_plan(s, d):
    k, n = F.col("s_suppkey"), F.col("s_nationkey")
    rules = [("not harvested", k % 5 == 0), ("by hand", n == 3), ("on demand", k % 4 == 1), ("run", n < 10), ("deferred", n < 15)]
    return supplier(s, d).select(k.alias("id"), R.first_rule(rules, "no adapter").alias("plan"))


@query("SELECT n_name, coalesce(CASE WHEN n_nationkey % 4 = 0 THEN 'own' END, CASE WHEN r_name <> 'ASIA' THEN r_name END, 'rest') AS grp FROM nation JOIN region ON n_regionkey = r_regionkey")
def r11_source_groups(s, d):
    grp = F.coalesce(F.when(F.col("n_nationkey") % 4 == 0, "own"), F.when(F.col("r_name") != "ASIA", F.col("r_name")), F.lit("rest"))
    return nation(s, d).join(region(s, d), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", grp.alias("grp"))


@query("SELECT a.o_orderkey AS amendment, CASE WHEN b.o_orderstatus = 'P' THEN 'excluded' WHEN b.o_orderkey IS NOT NULL THEN 'attached' ELSE 'own' END AS decision FROM orders a LEFT JOIN orders b ON b.o_orderkey = a.o_orderkey // 2 AND b.o_orderkey % 3 <> 0 WHERE a.o_orderkey % 2 = 0")
def r13_amendments_follow(s, d):
    """An amendment goes with the act it changes, and is excluded where that act is."""
    base = orders(s, d).where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("base"), F.col("o_orderstatus").alias("status"))
    a = orders(s, d).where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("amendment"), F.expr("o_orderkey div 2").alias("base"))
    decision = F.when(F.col("status") == "P", "excluded").when(F.col("status").isNotNull(), "attached").otherwise("own")
    return a.join(base, "base", "left").select("amendment", decision.alias("decision"))


@query("SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_size NOT BETWEEN 5 AND 45 THEN 'size' END, CASE WHEN p_retailprice > 1500 THEN 'price' END, CASE WHEN count(*) OVER (PARTITION BY p_name) > 1 THEN 'repeated' END], lambda x: x IS NOT NULL), '; ') AS problems FROM part")
def r12_registry_problems(s, d):
    faults = F.array_compact(F.array(F.when(~F.col("p_size").between(5, 45), "size"), F.when(F.col("p_retailprice") > 1500, "price"), F.when(F.count(F.lit(1)).over(Window.partitionBy("p_name")) > 1, "repeated")))
    return part(s, d).select("p_partkey", F.array_join(faults, "; ").alias("problems"))


@query(r"SELECT doc_id, regexp_matches(regexp_replace(lower(text), '\b(the|and)\b', ' ', 'g'), '\b(licen|secur)') AS relevant, CASE WHEN contains(lower(text), 'license') THEN 'license' WHEN contains(text, '@') THEN '@' END AS denied FROM documents")
def p16_relevance_and_denial(s, d):
    t = F.lower("text")
    denied = F.when(F.contains(t, F.lit("license")), "license").when(F.contains("text", F.lit("@")), "@")
    return documents(s, d).select("doc_id", F.regexp_replace(t, r"\b(the|and)\b", " ").rlike(r"\b(licen|secur)").alias("relevant"), denied.alias("denied"))


@query("SELECT o_custkey % 10 AS topic, count(*) AS rows_due, count(*) FILTER (c_custkey IS NOT NULL) AS covered, count(*) FILTER (c_custkey IS NULL AND o_orderstatus = 'P') AS queued FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 2000 GROUP BY 1")
def q20_table_coverage(s, d):
    c = customer(s, d).where("c_acctbal > 2000").select("c_custkey")
    here = F.col("c_custkey").isNotNull()
    out = orders(s, d).join(c, F.col("o_custkey") == F.col("c_custkey"), "left").groupBy((F.col("o_custkey") % 10).alias("topic"))
    return out.agg(F.count(F.lit(1)).alias("rows_due"), F.count_if(here).alias("covered"), F.count_if(~here & (F.col("o_orderstatus") == "P")).alias("queued"))


@query("SELECT 'process' AS part, o_orderpriority AS name, count(*) AS documents FROM orders GROUP BY 2 UNION ALL SELECT 'type', p_type, count(*) FROM part JOIN lineitem ON l_partkey = p_partkey AND l_returnflag = 'R' GROUP BY 2")
def q9_process_node(s, d):
    a = orders(s, d).groupBy(F.col("o_orderpriority").alias("name")).agg(F.count(F.lit(1)).alias("documents")).select(F.lit("process").alias("part"), "name", "documents")
    r = lineitem(s, d).where("l_returnflag = 'R'").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    b = part(s, d).join(r, F.col("l_partkey") == F.col("p_partkey")).groupBy(F.col("p_type").alias("name")).agg(F.sum("n").alias("documents"))
    return a.union(b.select(F.lit("type"), "name", "documents"))


@query("SELECT event_id, event_type, c_name FROM events LEFT JOIN customer ON c_custkey = user_id AND event_type = 'purchase' ORDER BY event_id DESC LIMIT 200")
def q11_audit_log(s, d):
    """The last 200 entries; only entries on documents name one. The report's size is 200."""
    last = events(s, d).orderBy(F.desc("event_id")).limit(200)
    return last.join(customer(s, d), (F.col("user_id") == F.col("c_custkey")) & (F.col("event_type") == "purchase"), "left").select("event_id", "event_type", "c_name")


@query("SELECT o_orderkey AS change, o_orderstatus AS status, c.c_name AS proposer, e.c_name AS confirmer FROM orders LEFT JOIN customer c ON c.c_custkey = o_custkey LEFT JOIN customer e ON e.c_custkey = o_custkey + 1 WHERE o_orderstatus <> 'O'")
def q14_state_changes(s, d):
    people = lambda role: customer(s, d).select(F.col("c_custkey").alias(f"{role}_key"), F.col("c_name").alias(role))
    o = orders(s, d).where("o_orderstatus <> 'O'")
    o = o.join(people("proposer"), F.col("o_custkey") == F.col("proposer_key"), "left").join(people("confirmer"), F.col("o_custkey") + 1 == F.col("confirmer_key"), "left")
    return o.select(F.col("o_orderkey").alias("change"), F.col("o_orderstatus").alias("status"), "proposer", "confirmer")


@query(r"SELECT page_id, len(regexp_extract_all(html, '(?i)<a\s')) AS links, len(regexp_extract_all(html, '(?i)<li[\s>]')) AS items FROM pages")
def t14_page_parts(s, d):
    n = lambda p: F.size(F.regexp_extract_all("html", F.lit(p), F.lit(0))).cast("long")
    return pages(s, d).select("page_id", n(r"(?i)<a\s").alias("links"), n(r"(?i)<li[\s>]").alias("items"))


FOUND = """(contains(lower(p_name), 'azure') OR contains(lower(p_type), 'azure') OR contains(lower(p_brand), 'azure') OR contains(lower(p_name), 'steel') OR contains(lower(p_type), 'steel') OR p_brand IN ('Brand#12'))"""


@query(f"SELECT p_partkey AS id FROM part WHERE {FOUND} AND p_size % 3 = 1 AND (j IS NULL OR j NOT IN ('CZ', 'SK', 'EU', 'mezinárodní')) AND EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_suppkey % 5 = 2)".replace("FROM part", "FROM (SELECT *, CASE p_partkey % 4 WHEN 0 THEN 'CZ' WHEN 1 THEN 'DE' WHEN 2 THEN 'SK' END AS j FROM part) p"))
def p2_catalogue_filter(s, d):
    """Search with a synonym, type, other jurisdictions and a keyword, as one condition and a semi-join."""
    j = F.when(F.col("p_partkey") % 4 == 0, "CZ").when(F.col("p_partkey") % 4 == 1, "DE").when(F.col("p_partkey") % 4 == 2, "SK")
    docs = part(s, d).select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_type").alias("description"), F.col("p_brand").alias("designation"), (F.col("p_size") % 3).alias("type_id"), F.lit("").alias("subtype"), F.lit(1).alias("source_id"), j.alias("jurisdiction"))
    words = lineitem(s, d).select(F.col("l_partkey").alias("document_id"), (F.col("l_suppkey") % 5).alias("keyword_id"))
    chosen = P.Filter.parse({"q": "azure", "type_id": "1", "keyword_id": "2", "jurisdikce": "others"}, [P.Synonym(("azure",), ("steel",), ("Brand#12",))])
    return chosen.apply(docs, words).select("id")


TRIAGE = (
    {"id": "known", "action": "reject", "when": {"known": True}},
    {"id": "standard", "action": "propose", "when": {"event_type": ["purchase", "signup"], "props_regex": "[5-9]"}},
    {"id": "noise", "action": "defer", "when": {"any": [{"event_type": ["error"]}, {"event_type": ["view"], "props_regex": "1"}]}},
    {"id": "rest", "action": "model", "when": {}},
)


@query("SELECT event_id, rule, CASE rule WHEN 'known' THEN 'reject' WHEN 'standard' THEN 'propose' WHEN 'noise' THEN 'defer' ELSE 'model' END AS action FROM (SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 'known' WHEN event_type IN ('purchase', 'signup') AND regexp_matches(props, '[5-9]') THEN 'standard' WHEN event_type = 'error' OR (event_type = 'view' AND regexp_matches(props, '1')) THEN 'noise' ELSE 'rest' END AS rule FROM events)")
def r2_triage(s, d):
    return P.decided(events(s, d), TRIAGE, {"known": F.col("user_id") % 10 == 0}).select("event_id", "rule", "action")


@query("WITH c AS (SELECT o_orderkey AS id, o_custkey AS k, CASE WHEN o_orderkey % 2 = 0 THEN 'CS' ELSE 'EN' END AS l FROM orders), d AS (SELECT c_custkey AS document, c_custkey % 1000 AS k, CASE WHEN c_custkey % 3 = 0 THEN 'EN' ELSE 'CS' END AS l FROM customer) SELECT id, min(document) FILTER (c.l = d.l) AS document FROM c JOIN d USING (k) GROUP BY 1 HAVING count(*) FILTER (c.l = d.l) > 0")
def r5_duplicates(s, d):
    none = F.lit(None).cast("string")
    c = orders(s, d).select(F.col("o_orderkey").alias("id"), F.array("o_custkey").alias("keys"), F.when(F.col("o_orderkey") % 2 == 1, "EN").alias("language"), none.alias("norm"))
    k = customer(s, d).select(F.col("c_custkey").alias("document"), F.array(F.col("c_custkey") % 1000).alias("keys"), F.when(F.col("c_custkey") % 3 == 0, "EN").otherwise("").alias("language"), none.alias("norm"))
    return P.duplicates(c, k)


@query("SELECT p_partkey, array_to_string(list_filter([CASE WHEN p_partkey % 7 = 0 THEN 'title' END, CASE WHEN p_type NOT IN ('ECONOMY', 'MEDIUM', 'SMALL') THEN 'type' END, CASE WHEN p_size < 5 THEN 'areas' END], lambda x: x IS NOT NULL), ',') AS faults FROM part")
def r8_proposal_faults(s, d):
    p = part(s, d).select("p_partkey", F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("title"), F.col("p_type").alias("document_type"), F.lit("CS").alias("language"), F.when(F.col("p_size") >= 5, F.array("p_size")).alias("areas"))
    return p.select("p_partkey", F.array_join(P.proposal_faults(["ECONOMY", "MEDIUM", "SMALL"], ["CS"], F.lit(False)), ",").alias("faults"))


@query("SELECT 'area' AS part, count(DISTINCT (o_orderkey, o_custkey % 4)) AS n FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'document', count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'relation', count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'version', count(*) FROM orders WHERE o_orderstatus = 'F'")
def c10_accepted_candidates(s, d):
    status = F.when(F.col("o_orderstatus") == "F", "accepted").otherwise("new")
    key = F.col("o_orderkey").cast("string")
    c = orders(s, d).select(key.alias("key"), status.alias("status"), key.alias("designation"), F.col("o_orderpriority").alias("title"), F.lit("CS").alias("language"), F.lit("").alias("url"), F.array(F.col("o_custkey") % 4, F.col("o_custkey") % 4).alias("areas"), F.array(F.concat(F.lit("x"), key)).alias("repeals"))
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in P.accepted_rows(c).items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


@query("WITH r AS (SELECT event_id, user_id, ts, CASE WHEN event_type IN ('view', 'click') THEN 1 ELSE 0 END AS good FROM events) SELECT user_id AS source, max(ts) FILTER (good = 1) AS since, count(*) AS runs FROM r GROUP BY 1")
def i1_high_water_marks(s, d):
    good = F.col("event_type").isin("view", "click")
    return events(s, d).groupBy(F.col("user_id").alias("source")).agg(F.max(F.when(good, F.col("ts"))).alias("since"), F.count(F.lit(1)).alias("runs"))


@query("SELECT n_name AS scenario, r_name AS node, count(c_custkey) AS bases FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey AND c_mktsegment = 'BUILDING' GROUP BY 1, 2")
def j34_pathways(s, d):
    """Scenario, node and the number of documents that are its legal base, none included."""
    base = customer(s, d).where("c_mktsegment = 'BUILDING'").groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    out = nation(s, d).join(region(s, d), F.col("n_regionkey") == F.col("r_regionkey")).join(base, F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return out.select(F.col("n_name").alias("scenario"), F.col("r_name").alias("node"), F.coalesce("n", F.lit(0)).alias("bases"))


@query("WITH e AS (SELECT DISTINCT least(l_suppkey, l_partkey % 100 + 1) AS a, greatest(l_suppkey, l_partkey % 100 + 1) AS b FROM lineitem WHERE l_suppkey <> l_partkey % 100 + 1) SELECT a, b FROM e")
def j27_edges_either_way(s, d):
    e = lineitem(s, d).select(F.col("l_suppkey").alias("x"), (F.col("l_partkey") % 100 + 1).alias("y")).where("x <> y")
    return e.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
