"""All queries of the library with the DuckDB SQL of each. SQL is left out where an operator has none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.functions import designation as D
from quillstone.operators import relational as R
from quillstone.operators import resolution as S
from quillstone.operators import text as T
from quillstone.plans.fixtures import RECORDS, records, table

QUERIES: dict = {}
ORACLES: dict = {}
REC = f"WITH records AS ({RECORDS}) "
# Normal form of a designation in DuckDB
NORM = r"""lower(trim(regexp_replace(regexp_replace(regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
 designation, '(?i)\b(CSA)\s*/?\s*(ANSI)\b', '\1\2', 'g'), '(?i)^(?:EIGA\s+Doc\s+|EIGA\s+|IGC\s+Doc\s+)', ''), '[‐-―−]', '-', 'g'), '\s+', ' ', 'g')),
 '/\s*-\s*\d{4}\.\d{2}\s*$', ''), '\s*:\s*\d{4}-\d{2}\s*$', ''), '\s*:\s*\d{4}\s*$', '')))"""
ICORE = r"regexp_replace(regexp_replace(norm, '^(?:stn|čsn|csn|tni|din|vde|nf|bs|nen)\s+', ''), '^en\s+(iso|iec)\b', '\1')"
TIER = "CASE WHEN jurisdiction = 'mezinárodní' THEN 'international' WHEN jurisdiction = 'EU' THEN 'EU' WHEN coalesce(jurisdiction, '') IN ('', 'neurčeno') THEN NULL ELSE 'national' END"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def L(name):  # noqa: N802
    return lambda s, d: table(s, d, name)


orders, customer, nation, region, lineitem, part, supplier, events, documents, labels, pages, conv, bench, emb = (
    L(n) for n in ("orders", "customer", "nation", "region", "lineitem", "part", "supplier", "events", "documents", "labels", "pages", "conversations", "benchmark", "embeddings")
)

ACTS = """SELECT o_orderkey, o_custkey, o_totalprice, c_mktsegment, n_name, r_name FROM orders JOIN customer ON o_custkey = c_custkey
 LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
 WHERE contains(lower(o_orderpriority), 'high') AND (r_name IS NULL OR r_name NOT IN ('ASIA', 'AFRICA'))
 AND o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 5)"""


def matching_acts(s, d) -> DataFrame:
    """One predicate for page and count: search, jurisdiction `others`, keyword by a semi-join."""
    o = orders(s, d).where(R.contains_any([F.col("o_orderpriority")], ["HIGH"]))
    small = lineitem(s, d).join(part(s, d).where("p_size <= 5").select("p_partkey"), F.col("l_partkey") == F.col("p_partkey"), "left_semi").select("l_orderkey")
    dims = nation(s, d).join(region(s, d), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    out = o.join(customer(s, d), F.col("o_custkey") == F.col("c_custkey")).join(dims, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.where(R.in_jurisdiction(F.col("r_name"), "others", ("ASIA", "AFRICA"))).join(small, F.col("o_orderkey") == F.col("l_orderkey"), "left_semi")


@query(f"SELECT o_orderkey, c_mktsegment, n_name, o_totalprice FROM ({ACTS}) ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 50")
def q1_catalogue_page(s, d):
    return R.page(matching_acts(s, d), [F.desc("o_totalprice"), F.col("o_orderkey")], 2).select("o_orderkey", "c_mktsegment", "n_name", "o_totalprice")


@query(f"SELECT count(*) AS acts, count(DISTINCT o_custkey) AS customers FROM ({ACTS})")
def q2_catalogue_count(s, d):
    return matching_acts(s, d).agg(F.count(F.lit(1)).alias("acts"), F.countDistinct("o_custkey").alias("customers"))


@query("SELECT count(*) AS acts, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS active, CAST(sum(CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END) AS BIGINT) AS inactive, max(o_orderdate) AS updated FROM orders")
def q3_headline_totals(s, d):
    n = F.count(F.lit(1))
    return orders(s, d).agg(n.alias("acts"), F.count_if(F.col("o_orderstatus") == "O").alias("active"), (n - F.count_if(F.col("o_orderstatus") == "O")).alias("inactive"), F.max("o_orderdate").alias("updated"))


@query("SELECT n_name, coalesce(r_name, 'rest') AS grp FROM nation LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'EUROPE' WHERE EXISTS (SELECT 1 FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 0)")
def q4_menu_of_sources(s, d):
    groups = region(s, d).where("r_name <> 'EUROPE'")
    out = nation(s, d).join(groups, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return out.join(customer(s, d).where("c_acctbal > 0"), F.col("n_nationkey") == F.col("c_nationkey"), "left_semi").select("n_name", F.coalesce("r_name", F.lit("rest")).alias("grp"))


@query("SELECT o_orderkey, coalesce(nullif(o_orderpriority, '5-LOW'), '') AS priority, coalesce(k.tags, '') AS tags FROM orders LEFT JOIN (SELECT l_orderkey, string_agg(p_brand, ', ' ORDER BY p_brand) AS tags FROM (SELECT DISTINCT l_orderkey, p_brand FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1) k ON o_orderkey = l_orderkey")
def q5_export_rows(s, d):
    tags = lineitem(s, d).join(part(s, d), F.col("l_partkey") == F.col("p_partkey")).groupBy("l_orderkey").agg(F.array_join(F.array_sort(F.collect_set("p_brand")), ", ").alias("tags"))
    return orders(s, d).join(tags, F.col("o_orderkey") == F.col("l_orderkey"), "left").select("o_orderkey", F.coalesce(F.nullif("o_orderpriority", F.lit("5-LOW")), F.lit("")).alias("priority"), F.coalesce("tags", F.lit("")).alias("tags"))


@query("WITH e AS (SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey WHERE l_returnflag = 'R') SELECT src AS id, dst AS other, 'out' AS direction FROM e UNION ALL SELECT dst, src, 'in' FROM e")
def q6_relations_both_ways(s, d):
    e = lineitem(s, d).where("l_returnflag = 'R'").join(orders(s, d), F.col("o_orderkey") == F.col("l_orderkey")).select(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst")).distinct()
    return R.neighbours(e)


@query("SELECT conv_id, turn, turn = max(turn) OVER (PARTITION BY conv_id) AS is_current, count(*) OVER (PARTITION BY conv_id) > 4 AND turn <> min(turn) OVER (PARTITION BY conv_id) AND turn <> max(turn) OVER (PARTITION BY conv_id) AS folded FROM conversations")
def q7_versions_shown_and_folded(s, d):
    w = Window.partitionBy("conv_id")
    last, first = F.max("turn").over(w), F.min("turn").over(w)
    return conv(s, d).select("conv_id", "turn", (F.col("turn") == last).alias("is_current"), ((F.count(F.lit(1)).over(w) > 4) & (F.col("turn") != first) & (F.col("turn") != last)).alias("folded"))


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS f, count(*) FILTER (o_orderstatus = 'O') AS o, count(*) FILTER (o_orderstatus = 'P') AS p FROM orders GROUP BY 1")
def q8_process_matrix(s, d):
    out = orders(s, d).groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).count()
    return out.select("o_orderpriority", *[F.coalesce(c, F.lit(0)).alias(c.lower()) for c in ("F", "O", "P")])


@query("SELECT c_custkey, c_name, o.o_orderkey AS latest_open FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) o ON c_custkey = o_custkey")
def q10_latest_open_item(s, d):
    latest = orders(s, d).where("o_orderstatus = 'O'").groupBy("o_custkey").agg(F.max("o_orderkey").alias("latest_open"))
    return customer(s, d).join(latest, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_name", "latest_open")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus = 'P' DESC, o_totalprice DESC, o_orderkey LIMIT 1000")
def q12_candidate_queue(s, d):
    return orders(s, d).orderBy(F.desc(F.col("o_orderstatus") == "P"), F.desc("o_totalprice"), "o_orderkey").limit(1000).select("o_orderkey", "o_orderstatus", "o_totalprice")


RULES = [("n1", "a", "size", ">=", "10"), ("n1", "a", "kind", "=", "x"), ("n1", "b", "kind", "in", "y,z"), ("n2", "a", "size", "<", "5"), ("n3", "a", "absent", "set", "")]


@query("""WITH r AS (SELECT * FROM (VALUES ('n1','a','size','>=','10'),('n1','a','kind','=','x'),('n1','b','kind','in','y,z'),('n2','a','size','<','5'),('n3','a','absent','set','')) t(node, grp, name, cmp, value)),
 p AS (SELECT * FROM (VALUES ('size','12'),('kind','x')) t(name, actual)),
 k AS (SELECT node, grp, bool_and(coalesce(CASE cmp WHEN '>=' THEN try_cast(actual AS DOUBLE) >= try_cast(value AS DOUBLE) WHEN '<' THEN try_cast(actual AS DOUBLE) < try_cast(value AS DOUBLE) WHEN '=' THEN actual = value WHEN 'in' THEN list_contains(string_split(value, ','), actual) WHEN 'set' THEN actual IS NOT NULL END, false)) AS ok FROM r LEFT JOIN p USING (name) GROUP BY 1, 2)
 SELECT node, bool_or(ok) AS active FROM k GROUP BY 1""")  # fmt: skip
def q15_rule_selection(s, d):
    rules = s.createDataFrame(RULES, "node string, grp string, name string, cmp string, value string")
    with_try = rules.withColumn("value", F.col("value"))
    return R.activated(with_try, s.createDataFrame([("size", "12"), ("kind", "x")], "name string, actual string"))


@query("SELECT lang, source, count(*) AS docs, count(nullif(trim(coalesce(text, '')), '')) AS with_text, CAST(sum(CASE WHEN n_chars > 2000 THEN 1 ELSE 0 END) AS BIGINT) AS long_docs FROM documents GROUP BY 1, 2")
def q16_requirement_coverage(s, d):
    return documents(s, d).groupBy("lang", "source").agg(F.count(F.lit(1)).alias("docs"), F.count(F.nullif(F.trim(F.coalesce("text", F.lit(""))), F.lit(""))).alias("with_text"), F.count_if(F.col("n_chars") > 2000).alias("long_docs"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def q17_repeated_keys(s, d):
    return lineitem(s, d).groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


CITES = "SELECT l_orderkey AS doc, o_custkey AS unit, concat('P', cast(l_partkey % 300 AS varchar(20))) AS key, CASE WHEN l_partkey % 300 < 100 THEN 'CZ' ELSE 'EU' END AS family, l_returnflag = 'R' AS amendment FROM lineitem JOIN orders ON l_orderkey = o_orderkey"
CLOSED = f"SELECT key, family, count(DISTINCT unit) AS cited_by, count(DISTINCT doc) AS documents, count(*) AS occurrences, round(avg(CAST(amendment AS INT)), 2) AS amendment_share, min(doc) AS first_doc FROM ({CITES}) GROUP BY 1, 2"


def _closed(s, d):
    return R.closure(s.sql(CITES.replace("FROM lineitem", "FROM {l}").replace("JOIN orders", "JOIN {o}"), l=lineitem(s, d), o=orders(s, d)))


@query(CLOSED)
def q18_citation_closure(s, d):
    return _closed(s, d)


@query(f"""WITH c AS ({CLOSED}), p AS (SELECT concat('P', cast(p_partkey AS varchar(20))) AS key FROM part WHERE p_partkey % 2 = 0), t AS (SELECT unnest([1, 40, 80]) AS threshold),
 m AS (SELECT c.family, threshold, p.key AS here FROM c LEFT JOIN p USING (key) JOIN t ON cited_by >= threshold)
 SELECT family, threshold, count(*) AS keys, count(here) AS present, round(count(here) / count(*), 3) AS share FROM m GROUP BY 1, 2
 UNION ALL SELECT 'all', threshold, count(*), count(here), round(count(here) / count(*), 3) FROM m GROUP BY threshold""")
def q18_closure_summary(s, d):
    present = part(s, d).where("p_partkey % 2 = 0").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("key"))
    return R.closure_summary(_closed(s, d), present, [1, 40, 80])


@query("WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings) SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.v, b.v), 6) AS similarity FROM e a JOIN e b ON a.vec_id < b.vec_id AND a.label <> b.label WHERE list_cosine_similarity(a.v, b.v) >= 0.45")
def q19_grey_zone_pairs(s, d):
    v = emb(s, d).select(F.col("vec_id").alias("id"), F.col("label").cast("string").alias("veto"), F.col("embedding").alias("vector"))
    return S.similar_pairs(v, 0.45, apart=True).select("a", "b", F.round("similarity", 6).alias("similarity"))


def _keyed(s, d):
    c = F.col("designation")
    return records(s, d).withColumns({"norm": D.normalise(c), "core": D.international_core(c), "tier": D.tier(F.col("jurisdiction"))})


@query(REC + rf"""SELECT id, {NORM} AS norm, regexp_replace({NORM}, '^čsn ', '') AS core, {ICORE.replace("norm", "(" + NORM + ")")} AS international,
 array_to_string(regexp_extract_all(designation, '\d+'), ' ') AS digits, {TIER} AS tier, regexp_matches(designation, '(?i)^\((?:EU|ES|EC|EÚ|EEC|EHS)\)|/(?:EU|ES|EC|EÚ|EEC|EHS)\s*$') AS eu_act,
 coalesce(nullif(regexp_extract(designation, '\d+/\d{{4}}'), ''), nullif(regexp_extract(designation, '\d{{4}}/\d+'), '')) AS number_year FROM records""")
def f1_designation_keys(s, d):
    c = F.col("designation")
    return records(s, d).select("id", D.normalise(c).alias("norm"), D.core(c).alias("core"), D.international_core(c).alias("international"), D.digit_tokens(c).alias("digits"), D.tier(F.col("jurisdiction")).alias("tier"), D.is_eu_act(c).alias("eu_act"), D.number_year(c).alias("number_year"))


@query(REC + r"""SELECT id, CASE WHEN regexp_extract(designation, '(?i)[/+]\s*(?:A\d+|AC\d*)') = '' THEN 0 ELSE coalesce(try_cast(regexp_extract(regexp_extract(designation, '(?i)[/+]\s*(?:A\d+|AC\d*)'), '\d+') AS INT), 1) END AS level,
 regexp_matches(designation, '(?i)\bEN\s+IEC\b') AS renumbered, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(designation, '[‐-―−]', '-', 'g'), '(?i)[/+]\s*(?:A\d+|AC\d*)', '', 'g'), '[/\s]*-\s*\d{4}[.\-]\d{2}\s*$', ''), '(?i)\bEN\s+IEC\b', 'EN', 'g'), '\s+', ' ', 'g'))) AS version_key FROM records""")
def f8_version_keys(s, d):
    c = F.col("designation")
    return records(s, d).select("id", D.amendment_level(c).alias("level"), D.is_renumbered(c).alias("renumbered"), D.version_key(c, True).alias("version_key"))


SLUG = "regexp_replace(regexp_replace(lower(translate(designation, 'Č', 'C')), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')"


@query(REC + f"SELECT id, CASE WHEN n = 1 THEN base ELSE concat(base, '-', n) END AS slug FROM (SELECT id, base, row_number() OVER (PARTITION BY base ORDER BY designation, title, seq) AS n FROM (SELECT *, {SLUG} AS base FROM records))")
def w1_slug_assignment(s, d):
    return R.assign_slugs(records(s, d).withColumn("base", D.base_slug(F.col("designation"), F.col("title")))).select("id", "slug")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS iso, date_diff('day', o_orderdate::date, DATE '2024-01-01') > 30 AS stale FROM orders")
def f40_dates(s, d):
    text = F.when(F.col("o_orderkey") % 5 == 0, "").otherwise(F.date_format("o_orderdate", "d.M.yyyy"))
    return orders(s, d).select("o_orderkey", D.iso_date(text).alias("iso"), (F.datediff(F.lit("2024-01-01").cast("date"), F.col("o_orderdate").cast("date")) > 30).alias("stale"))


@query("SELECT doc_id, coalesce(nullif(trim(CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE source END), ''), lang) AS shown, array_to_string(list_filter([CASE WHEN n_chars < 200 THEN 'fragment' END, CASE WHEN doc_id % 3 = 0 THEN 'no source' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM documents")
def f17_precedence_and_flags(s, d):
    src = F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("source"))
    why = F.array_compact(F.array(F.when(F.col("n_chars") < 200, "fragment"), F.when(F.col("doc_id") % 3 == 0, "no source")))
    return documents(s, d).select("doc_id", D.first_known(src, F.col("lang")).alias("shown"), F.array_join(why, "; ").alias("reasons"))


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT) AS k, concat('url:', substr(sha256(props), 1, 12)) AS key FROM events")
def f52_json_and_keys(s, d):
    return events(s, d).select("event_id", F.from_json("props", "k int")["k"].alias("k"), D.fallback_key(F.lit(""), F.col("props")).alias("key"))


CITED = "concat('podle ', designation, ', směrnice 2014/', 10 + id % 80, '/EU a zákona č. ', 1 + id % 900, '/2020 Sb., nariadenie 7/2011 Z. z. a EN ', 1000 + id % 50)"


@query(REC + rf"""SELECT id, concat_ws(',', CASE WHEN id % 9 = 2 THEN concat('NORM:', regexp_extract(designation, 'EN ISO \d+-\d')) WHEN id % 9 = 3 THEN concat('NORM:', designation) WHEN id % 9 IN (0, 1) THEN concat('NORM:EN ', regexp_extract(designation, '\d+'))
  WHEN id % 9 = 8 THEN concat('NORM:EN IEC ', regexp_extract(designation, '60079-\d+')) WHEN id % 9 = 4 AND id < 10000 THEN concat('EU:', regexp_extract(designation, '20\d+'), '/', id) WHEN id % 9 = 5 AND id < 10000 THEN concat('CZ:', regexp_extract(designation, '\d+/\d+')) END,
  concat('EU:2014/', 10 + id % 80, ':directive'), concat('CZ:', 1 + id % 900, '/2020'), 'SK:7/2011', concat('NORM:EN ', 1000 + id % 50)) AS keys FROM records""")  # fmt: skip
def t3_citation_keys(s, d):
    """Keys of all families with their kinds, in the order of their places; of every record."""
    c = T.citations(F.expr(CITED))
    return records(s, d).select("id", F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["key"], x["kind"])), ",").alias("keys"))


@query("SELECT page_id, regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1) AS host, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)\\b.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g')) AS text FROM pages".replace("\\\\", "\\"))
def t1_page_text(s, d):
    return pages(s, d).select("page_id", F.parse_url("url", F.lit("HOST")).alias("host"), D.strip_tags(F.col("html")).alias("text"))


@query(REC + "SELECT a.title AS src, b.designation AS dst, a.id AS src_id, b.id AS dst_id FROM records a LEFT JOIN records b ON b.id = a.id * 2".replace("SELECT a.title AS src, b.designation AS dst, a.id AS src_id, b.id AS dst_id FROM", "SELECT a.id AS src_id, b.id AS dst_id FROM").replace("LEFT JOIN", "JOIN"))
def j10_resolved_edges(s, d):
    r = records(s, d).select("id", F.concat("designation", F.lit("#"), F.col("id").cast("string")).alias("designation"))
    edges = r.select(F.col("designation").alias("src"), (F.col("id") * 2).alias("k")).join(r.select(F.col("id").alias("k"), F.col("designation").alias("dst")), "k", "left").drop("k")
    return R.lookup_ends(edges, r)[0].select("src_id", "dst_id")


@query("SELECT p_partkey, n_nationkey FROM part JOIN nation ON p_size >= n_nationkey * 2 AND p_size < n_nationkey * 2 + 5")
def j12_band_join(s, d):
    bands = nation(s, d).select("n_nationkey", (F.col("n_nationkey") * 2).alias("low"), (F.col("n_nationkey") * 2 + 5).alias("high"))
    return R.band_join(part(s, d).select("p_partkey", "p_size"), bands, at="p_size", low="low", high="high", width=5).select("p_partkey", "n_nationkey")


@query(REC + f", k AS (SELECT designation, {TIER} AS tier, {NORM} AS norm FROM records), r AS (SELECT designation, tier, {ICORE} AS core FROM k WHERE tier IS NOT NULL) SELECT DISTINCT a.designation AS child, b.designation AS parent, 'ADOPTS' AS kind FROM r a JOIN r b USING (core) WHERE a.tier = 'national' AND b.tier <> 'national' AND core <> '' AND a.designation <> b.designation")
def j13_adoptions(s, d):
    return R.adoptions(_keyed(s, d))


@query("SELECT s_suppkey AS ref, coalesce(a.p_partkey, b.p_partkey) AS target FROM supplier LEFT JOIN part a ON a.p_partkey = s_suppkey * 3 AND a.p_size % 2 = 0 LEFT JOIN part b ON b.p_partkey = s_suppkey * 5 AND b.p_size % 2 = 0 WHERE coalesce(a.p_partkey, b.p_partkey) IS NOT NULL")
def j15_first_candidate(s, d):
    refs = supplier(s, d).select(F.col("s_suppkey").alias("ref"), F.array(F.col("s_suppkey") * 3, F.col("s_suppkey") * 5).alias("keys"))
    targets = part(s, d).where("p_size % 2 = 0").select(F.col("p_partkey").alias("key"), F.col("p_partkey").alias("target"), F.col("p_partkey").alias("seq"))
    return R.first_candidate(refs, targets)


@query("SELECT event_id AS id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) AND event_id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0)")
def j20_unknown_findings(s, d):
    found = events(s, d).select(F.col("event_id").alias("id"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("k1"), F.concat(F.lit("o"), F.col("event_id").cast("string")).alias("k2"))
    known = customer(s, d).where("c_acctbal > 0").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("key")).union(orders(s, d).where("o_orderkey % 2 = 0").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string"))))
    return R.unknown(found, known, ["k1", "k2"]).select("id")


@query("SELECT o_custkey, max(o_orderdate) FILTER (o_orderdate <= TIMESTAMP '1995-06-01') AS current, min(o_orderdate) FILTER (o_orderdate > TIMESTAMP '1995-06-01') AS upcoming FROM orders GROUP BY 1")
def j24_as_of(s, d):
    return R.as_of(orders(s, d), "o_custkey", "o_orderdate", F.lit("1995-06-01").cast("timestamp"))


@query("""WITH r AS (SELECT p_size AS cluster, p_name AS title, p_partkey AS seq, CASE WHEN p_brand = 'Brand#11' THEN ' ' ELSE p_brand END AS issuer, concat(p_type, ', ', p_brand) AS sources,
  CASE WHEN p_partkey % 7 = 0 THEN '' WHEN p_partkey % 5 = 0 THEN concat('ČSN ', p_partkey) ELSE concat('EN ', p_partkey) END AS designation FROM part),
 s AS (SELECT cluster, unnest(string_split(sources, ', ')) AS v, seq FROM r), u AS (SELECT cluster, v, min(seq) AS seq FROM s GROUP BY 1, 2)
 SELECT cluster, arg_max(title, length(title) * 100000000 - seq) AS title, coalesce(nullif(trim(arg_max(issuer, length(title) * 100000000 - seq)), ''), arg_min(issuer, seq) FILTER (trim(issuer) <> '')) AS issuer,
  (SELECT string_agg(v, '|' ORDER BY v) FROM u WHERE u.cluster = r.cluster) AS sources, (SELECT string_agg(DISTINCT substr(title, 1, 5), '|' ORDER BY substr(title, 1, 5)) FROM r x WHERE x.cluster = r.cluster) AS words,
  coalesce(arg_min(designation, seq) FILTER (designation LIKE 'ČSN%'), arg_min(designation, seq) FILTER (designation <> ''), '') AS designation, count(*) AS members FROM r GROUP BY cluster""")  # fmt: skip
def a11_record_merge(s, d):
    k = F.col("p_partkey")
    named = F.when(k % 7 == 0, "").when(k % 5 == 0, F.concat(F.lit("ČSN "), k.cast("string"))).otherwise(F.concat(F.lit("EN "), k.cast("string")))
    r = part(s, d).select(
        F.col("p_size").alias("cluster"), F.col("p_name").alias("title"), F.when(F.col("p_brand") == "Brand#11", " ").otherwise(F.col("p_brand")).alias("issuer"),
        F.concat("p_type", F.lit(", "), "p_brand").alias("sources"), F.array(F.substring("p_name", 1, 5)).alias("words"), named.alias("designation"), k.alias("seq"),
    )
    out = R.merge_records(r, "cluster", ["issuer"], ["words"], packed=["sources"], designation="designation")
    listed = lambda c: F.array_join(F.array_sort(c), "|")
    return out.select("cluster", "title", "issuer", listed(F.split("sources", ", ")).alias("sources"), listed("words").alias("words"), "designation", "members")


@query(REC + f"""SELECT cluster, members, CASE WHEN members = 1 THEN 'none' WHEN most > 1 OR most_urls > 1 THEN 'deterministic' ELSE 'semantic' END AS kind, (cores = 1 OR (urls = 1 AND all_urls)) AND js <= 1 AS pure FROM (
 SELECT cluster, count(*) AS members, count(DISTINCT core) AS cores, count(DISTINCT j) AS js, max(n) AS most, max(CASE WHEN url <> '' THEN m END) AS most_urls, count(DISTINCT url) AS urls, bool_and(url <> '') AS all_urls FROM (
  SELECT *, count(*) OVER (PARTITION BY cluster, core) AS n, count(*) OVER (PARTITION BY cluster, url) AS m FROM (SELECT id % 300 AS cluster, {NORM} AS core, CASE WHEN id % 3 = 0 THEN '' ELSE concat('u', id % 7) END AS url, CASE WHEN coalesce(jurisdiction, '') IN ('', 'neurčeno') THEN NULL ELSE jurisdiction END AS j FROM records)) GROUP BY 1)""")  # fmt: skip
def a14_cluster_kind(s, d):
    url = F.when(F.col("id") % 3 == 0, "").otherwise(F.concat(F.lit("u"), (F.col("id") % 7).cast("string")))
    r = records(s, d).select((F.col("id") % 300).alias("cluster"), D.normalise(F.col("designation")).alias("core"), url.alias("url"), "jurisdiction")
    return R.cluster_kind(r, "cluster")


@query("SELECT user_id, event_type, arg_max(value, ts) AS newest, min(ts) AS first_seen, count(*) AS n FROM events GROUP BY 1, 2")
def a18_newest_wins(s, d):
    return events(s, d).groupBy("user_id", "event_type").agg(F.max_by("value", "ts").alias("newest"), F.min("ts").alias("first_seen"), F.count(F.lit(1)).alias("n"))


@query("WITH w AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) SELECT l_suppkey, arg_max(l_returnflag, q * 10 - ascii(l_returnflag) / 1000) AS common FROM w GROUP BY 1")
def a23_weighted_mode(s, d):
    w = lineitem(s, d).groupBy("l_suppkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return w.groupBy("l_suppkey").agg(F.max_by("l_returnflag", F.struct("q", -F.ascii("l_returnflag"))).alias("common"))


@query("SELECT p_brand, list_sort(list(p_size))[CAST(floor(count(*) * 0.9) AS INT) + 1] AS edge FROM part GROUP BY 1")
def a24_index_percentile(s, d):
    return part(s, d).groupBy("p_brand").agg(F.expr("array_sort(collect_list(p_size))[cast(floor(count(1) * 0.9) as int)]").alias("edge"))


@query(REC + "SELECT id, CASE WHEN row_number() OVER (PARTITION BY designation ORDER BY seq) = 1 THEN designation END AS designation FROM records")
def w2_unique_designation(s, d):
    first = F.row_number().over(Window.partitionBy("designation").orderBy("seq")) == 1
    return records(s, d).select("id", F.when(first, F.col("designation")).alias("designation"))


@query("SELECT event_id, sum(CASE WHEN g IS NULL OR g > 45000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM (SELECT event_id, user_id, event_id * 100 - lag(event_id * 100) OVER (PARTITION BY user_id ORDER BY event_id) AS g FROM events)".replace("sum(", "CAST(sum(").replace("ORDER BY event_id) AS island", "ORDER BY event_id) AS BIGINT) AS island"))
def w5_islands(s, d):
    e = events(s, d).select("event_id", "user_id", (F.col("event_id") * 100).alias("at"))
    return R.islands(e, ["user_id"], "at", F.col("gap") > 45000).select("event_id", "island")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n FROM events) WHERE n <= 3")
def w6_first_three(s, d):
    return R.first_rows(events(s, d), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")], 3).select("user_id", "event_type", "event_id")


@query("SELECT doc_id, CASE WHEN a = 0 AND b = 0 THEN NULL WHEN b = 0 OR (a > 0 AND a <= b) THEN 'license' ELSE 'table' END AS label FROM (SELECT doc_id, strpos(text, 'icense') AS a, strpos(text, ' | ') AS b FROM documents)")
def w10_earliest_keyword(s, d):
    return documents(s, d).select("doc_id", D.earliest(F.col("text"), {"icense": "license", " | ": "table"}).alias("label"))


@query("SELECT conv_id, turn, lead(turn, 1, 999) OVER (PARTITION BY conv_id ORDER BY turn) AS bottom FROM conversations")
def w12_next_bottom(s, d):
    return conv(s, d).select("conv_id", "turn", F.lead("turn", 1, 999).over(Window.partitionBy("conv_id").orderBy("turn")).alias("bottom"))


@query("WITH e AS (SELECT DISTINCT CASE WHEN l_suppkey % 7 = 0 THEN l_suppkey + 1 ELSE l_suppkey END AS src, CASE WHEN l_partkey % 7 = 0 THEN l_partkey + 1 ELSE l_partkey END AS dst, l_returnflag AS kind FROM lineitem) SELECT * FROM e WHERE src <> dst")
def g10_renamed_ends(s, d):
    e = lineitem(s, d).select(F.col("l_suppkey").alias("src"), F.col("l_partkey").alias("dst"), F.col("l_returnflag").alias("kind"))
    renamed = part(s, d).where("p_partkey % 7 = 0").select(F.col("p_partkey").alias("old"), (F.col("p_partkey") + 1).alias("new"))
    return R.rename_ends(e, renamed)


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 300000 AND o_orderstatus IN ('O', 'P') THEN 'review' WHEN regexp_matches(o_orderpriority, '^[12]') THEN 'urgent' WHEN o_custkey % 10 = 0 THEN 'known' ELSE 'rest' END AS rule FROM orders")
def r1_first_rule(s, d):
    rules = [("review", (F.col("o_totalprice") > 300000) & F.col("o_orderstatus").isin("O", "P")), ("urgent", F.col("o_orderpriority").rlike("^[12]")), ("known", F.col("o_custkey") % 10 == 0)]
    return orders(s, d).select("o_orderkey", R.first_rule(rules, "rest").alias("rule"))


@query("WITH q AS (SELECT c_custkey AS key, CASE c_custkey % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'rejected' ELSE 'proposed' END AS status, c_name AS title FROM customer WHERE c_custkey % 2 = 0), f AS (SELECT o_custkey AS key, max(o_orderkey) AS seen FROM orders GROUP BY 1) SELECT coalesce(q.key, f.key) AS key, coalesce(status, 'proposed') AS status, coalesce(greatest(0, f.seen), 0) AS seen, CASE WHEN q.key IS NULL THEN f.seen ELSE 0 END AS first_seen, CASE WHEN q.key IS NULL THEN 'inserted' WHEN f.key IS NULL THEN 'kept' WHEN status IN ('accepted', 'rejected') THEN 'evidence' ELSE 'refreshed' END AS outcome FROM q FULL JOIN f ON q.key = f.key")
def c3_candidate_upsert(s, d):
    status = F.when(F.col("c_custkey") % 3 == 0, "accepted").when(F.col("c_custkey") % 3 == 1, "rejected").otherwise("proposed")
    q = customer(s, d).where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("title"), status.alias("status"), F.lit(0).cast("long").alias("seen"), F.lit(0).cast("long").alias("first_seen"))
    f = orders(s, d).groupBy(F.col("o_custkey").alias("key")).agg(F.max("o_orderkey").alias("seen"), F.lit("").alias("title"))
    return R.upsert(q, f).select("key", "status", "seen", "first_seen", "outcome")


@query("WITH e AS (SELECT s_suppkey AS k, s_nationkey AS v FROM supplier WHERE s_suppkey % 4 <> 0), d AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 6 = 1 THEN 99 ELSE s_nationkey END AS v FROM supplier WHERE s_suppkey % 5 <> 0) SELECT coalesce(e.k, d.k) AS k, CASE WHEN e.k IS NULL THEN 'add' WHEN d.k IS NULL THEN 'drop' ELSE 'update' END AS action, e.v AS old, d.v AS new FROM e FULL JOIN d ON e.k = d.k WHERE e.k IS NULL OR d.k IS NULL OR e.v <> d.v")
def c6_planned_changes(s, d):
    e = supplier(s, d).where("s_suppkey % 4 <> 0").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("v"))
    w = supplier(s, d).where("s_suppkey % 5 <> 0").select(F.col("s_suppkey").alias("k"), F.when(F.col("s_suppkey") % 6 == 1, 99).otherwise(F.col("s_nationkey")).alias("v"))
    return R.plan_changes(e, w, "k", "v")


@query("SELECT p_brand, arg_min(p_type, p_partkey) AS kind FROM part GROUP BY 1")
def c1_get_or_create(s, d):
    return R.get_or_create(part(s, d).select("p_brand", F.col("p_type").alias("kind"), F.col("p_partkey").alias("seq")), "p_brand", "kind").select("p_brand", "kind")


@query("SELECT n_nationkey, part_kind FROM nation, (VALUES ('cz'), ('sk'), ('eu')) t(part_kind) WHERE part_kind = 'cz' OR (part_kind = 'sk' AND n_nationkey % 2 = 0) OR (part_kind = 'eu' AND n_nationkey % 3 = 0)")
def u7_split_records(s, d):
    kinds = F.array(F.lit("cz"), F.when(F.col("n_nationkey") % 2 == 0, "sk"), F.when(F.col("n_nationkey") % 3 == 0, "eu"))
    return nation(s, d).select("n_nationkey", F.explode(F.array_compact(kinds)).alias("part_kind"))
