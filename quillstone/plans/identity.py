"""Queries on the identity of records: clusters, registry answers, variants, matches by several keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.functions import acts as A
from quillstone.functions import designation as D
from quillstone.operators import ordered as O
from quillstone.operators import relational as R
from quillstone.operators import resolution as S
from quillstone.operators import text as T
from quillstone.plans.catalogue import ICORE, NORM, REC, TIER, conv, customer, documents, emb, events, labels, lineitem, orders, pages, part, query, supplier
from quillstone.plans.fixtures import records

UNKNOWN = "coalesce(jurisdiction, '') NOT IN ('', 'neurčeno')"
CORE = f"regexp_replace({NORM}, '^čsn ', '')"
# Addresses that some records share; cores of a few records only
URL = "CASE WHEN id % 11 = 0 THEN concat('u', cast(id % 40 AS varchar(20))) ELSE '' END"


def _identities(s, d) -> DataFrame:
    url = F.when(F.col("id") % 11 == 0, F.concat(F.lit("u"), (F.col("id") % 40).cast("string"))).otherwise("")
    return records(s, d).withColumns({"core": D.core(F.col("designation")), "url": url})


@query()
def g1_constrained_clusters(s, d):
    r = _identities(s, d).select("seq", "core", "url", "jurisdiction", (F.col("id") % 13 == 0).alias("hand_verified"), "id")
    v = emb(s, d).select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vector"))
    return S.clusters(r.join(v, "id", "left"), 0.45)


@query(REC + f""", r AS (SELECT id % 200 AS cluster, {CORE} AS core, {URL} AS url, CASE WHEN {UNKNOWN} THEN jurisdiction END AS j FROM records)
 SELECT cluster, count(*) AS members, CASE WHEN count(*) = 1 THEN 'single'
  WHEN ((bool_and(core <> '') AND count(DISTINCT core) = 1) OR (bool_and(url <> '') AND count(DISTINCT url) = 1)) AND count(DISTINCT j) <= 1 THEN 'merge' ELSE 'judge' END AS route FROM r GROUP BY 1""")  # fmt: skip
def g3_cluster_routes(s, d):
    return S.route(_identities(s, d).withColumn("cluster", F.col("id") % 200), "cluster")


@query("WITH g AS (SELECT DISTINCT p_size AS cluster, p_brand AS designation FROM part WHERE p_partkey % 3 = 0), m AS (SELECT p_size AS cluster, p_brand AS designation, count(*) AS n FROM part WHERE p_partkey % 5 = 0 GROUP BY 1, 2) SELECT m.cluster, m.designation, CASE WHEN g.cluster IS NULL THEN 'invented' ELSE 'repeated' END AS fault FROM m LEFT JOIN g ON m.cluster = g.cluster AND m.designation = g.designation WHERE g.cluster IS NULL OR n > 1")
def g4_merge_faults(s, d):
    p = part(s, d).select(F.col("p_size").alias("cluster"), F.col("p_brand").alias("designation"), "p_partkey")
    return S.merge_faults(p.where("p_partkey % 3 = 0"), p.where("p_partkey % 5 = 0"))


DIGITS = rf"array_to_string(regexp_extract_all({NORM}, '\d+'), ' ')"


@query(REC + f""", x AS (SELECT {DIGITS} AS digits, {CORE} AS core, CASE WHEN id % 2 = 0 THEN NULL ELSE jurisdiction END AS j FROM records WHERE contains(lower(designation), 'iso')),
 g AS (SELECT digits, count(*) AS members FROM x WHERE digits <> '' AND (j IS NULL OR j IN ('', 'neurčeno', 'CZ')) GROUP BY 1 HAVING count(DISTINCT core) > 1),
 a AS (SELECT {DIGITS} AS digits, count(DISTINCT trim(designation)) AS n, min(trim(designation)) AS one FROM records WHERE id % 4 <> 0 AND trim(designation) <> '' GROUP BY 1)
 SELECT digits, members, CASE WHEN n = 1 THEN one END AS canonical, CASE WHEN n = 1 THEN 'merged' ELSE 'inconclusive' END AS action FROM g LEFT JOIN a USING (digits)""")  # fmt: skip
def g5_registry_answers(s, d):
    r = _identities(s, d).withColumn("digits", D.digit_tokens(D.normalise(F.col("designation"))))
    a = r.select("digits", "designation", (F.col("id") % 4 != 0).alias("is_valid"))
    return S.ambiguous_groups(r.withColumn("jurisdiction", F.when(F.col("id") % 2 == 1, F.col("jurisdiction"))), a)


@query("WITH l AS (SELECT l_orderkey, l_partkey FROM lineitem), m AS (SELECT CASE WHEN l_orderkey % 10 = 0 THEN l_orderkey // 10 ELSE l_orderkey END AS a, CASE WHEN l_partkey % 10 = 0 THEN l_partkey // 10 ELSE l_partkey END AS b FROM l) SELECT DISTINCT a, b FROM m WHERE a <> b")
def g11_moved_links(s, d):
    links = lineitem(s, d).select(F.col("l_orderkey").alias("a"), F.col("l_partkey").alias("b"))
    keys = links.select("a").union(links.select("b")).distinct().where("a % 10 = 0")
    return S.move_links(links, keys.select(F.col("a").alias("old"), F.expr("a div 10").alias("new")), ["a", "b"])


@query(REC + f", k AS (SELECT seq, designation, {TIER} AS tier, {NORM} AS norm FROM records), r AS (SELECT seq, designation, tier, {ICORE} AS core FROM k WHERE tier IS NOT NULL) SELECT core, arg_min(designation, seq) AS designation FROM r WHERE core <> '' GROUP BY 1 HAVING bool_and(tier = 'national')")
def g14_missing_parents(s, d):
    c = F.col("designation")
    return S.missing_parents(records(s, d).withColumns({"core": D.international_core(c), "tier": D.tier(F.col("jurisdiction"))}))


PAIRED = "id % 9 = 4 AND id % 2 = 0"


@query(REC + f"SELECT id, designation, CASE WHEN {PAIRED} THEN concat('cs ', title) ELSE title END AS title, 0 AS rank FROM records UNION ALL SELECT id, concat(trim(designation), ' [EN]'), concat('en ', title), 1 FROM records WHERE {PAIRED}")
def u8_language_variants(s, d):
    r = records(s, d).select("id", "designation", "title")
    p = r.where(PAIRED).select("designation", F.concat(F.lit("cs "), "title").alias("title_cs"), F.concat(F.lit("en "), "title").alias("title_en"))
    return S.split_variants(r, p)


@query(REC + f"SELECT DISTINCT concat(trim(designation), ' [EN]') AS src, trim(designation) AS dst, 'TRANSLATION_OF' AS kind FROM records WHERE {PAIRED}")
def g6_translations(s, d):
    return S.translations(u8_language_variants(s, d))


@query("SELECT s_suppkey AS ref, p_partkey AS target FROM supplier JOIN part ON s_suppkey % 2 = 0 AND p_size = s_suppkey % 50 UNION ALL SELECT s_suppkey, p_partkey FROM supplier JOIN part ON s_suppkey % 2 = 1 AND p_partkey = s_suppkey")
def j16_fan_out(s, d):
    """Bare references go to all adoptions, national ones to the one that is equal."""
    ref, p = supplier(s, d).select(F.col("s_suppkey").alias("ref")), part(s, d)
    every = ref.where("ref % 2 = 0").join(p, F.col("ref") % 50 == F.col("p_size"))
    exact = ref.where("ref % 2 = 1").join(p, F.col("ref") == F.col("p_partkey"))
    return every.union(exact).select("ref", F.col("p_partkey").alias("target"))


def _prefix_fallback(p: DataFrame, t: DataFrame) -> DataFrame:
    """By a designation that is unique, else by titles one of which begins with the other."""
    t = t.select(F.col("id").alias("target"), F.col("p_brand").alias("b"), F.col("p_name").alias("t"))
    one = t.groupBy("b").agg(F.count(F.lit(1)).alias("n"), F.min("target").alias("target")).where("n = 1")
    first = p.join(one, F.col("p_brand") == F.col("b")).select("id", "target", F.lit("designation").alias("way"))
    rest = p.join(one, F.col("p_brand") == F.col("b"), "left_anti").select("id", "p_name")

    own, other = rest.select(F.col("p_name").alias("a")).distinct(), t.select(F.col("t").alias("b")).distinct()

    def begin(long: DataFrame, title: str, short: DataFrame, start: str) -> DataFrame:
        """Titles that begin with one of `short`: their beginnings of the lengths in use, joined as equal texts."""
        lengths = F.broadcast(short.select(F.length(start).alias("n")).where("n is not null").distinct())
        cut = long.join(lengths, F.col("n") <= F.length(title)).withColumn("h", F.expr(f"substring({title}, 1, n)"))
        return cut.join(short.withColumn("h", F.col(start)), "h").select("a", "b")

    titles = begin(other, "b", own, "a").union(begin(own, "a", other, "b"))
    alike = R.linked_pairs(rest.toDF("item", "class"), t.select(F.col("target").alias("item"), F.col("t").alias("class")), titles)
    return first.union(alike.select("item", "other", F.lit("title")))


@query("WITH one AS (SELECT p_brand, min(p_partkey) AS target FROM part WHERE p_brand IS NOT NULL GROUP BY 1 HAVING count(*) = 1) SELECT p.p_partkey AS id, one.target, 'designation' AS way FROM part p JOIN one ON p.p_brand = one.p_brand UNION ALL SELECT DISTINCT p.p_partkey, t.p_partkey, 'title' FROM part p JOIN part t ON starts_with(t.p_name, p.p_name) OR starts_with(p.p_name, t.p_name) WHERE NOT EXISTS (SELECT 1 FROM one WHERE one.p_brand = p.p_brand)")
def j19_prefix_fallback(s, d):
    titled = part(s, d).select(F.col("p_partkey").alias("id"), "p_brand", "p_name")
    return _prefix_fallback(titled, titled)


@query("WITH k AS (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem) SELECT DISTINCT a.l_orderkey AS id, b.l_orderkey AS other FROM k a JOIN k b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey WHERE a.l_orderkey <> b.l_orderkey AND b.l_orderkey IN (SELECT o_orderkey FROM orders)")
def j22_shared_keys(s, d):
    """Other acts that share a key with an act."""
    a = lineitem(s, d).select(F.col("l_orderkey").alias("id"), "l_partkey", "l_suppkey").distinct()
    b = lineitem(s, d).join(orders(s, d), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi").select(F.col("l_orderkey").alias("other"), "l_partkey", "l_suppkey").distinct()
    return a.join(b, ["l_partkey", "l_suppkey"]).where("id <> other").select("id", "other").distinct()


@query("WITH r AS (SELECT p_partkey AS ref FROM part WHERE p_partkey IS NOT NULL UNION SELECT p_partkey // 10 FROM part WHERE p_partkey IS NOT NULL), e AS (SELECT ref FROM r JOIN part ON p_partkey = ref WHERE ref % 3 = 0) SELECT ref, p_partkey AS target FROM e JOIN part ON p_partkey = ref UNION ALL SELECT ref, p_partkey FROM r JOIN part ON p_partkey // 10 = ref WHERE ref NOT IN (SELECT ref FROM e)")
def j23_series_or_parts(s, d):
    """The number itself, else all parts of its series; references to every part and every series of the table."""
    p = part(s, d)
    known = p.where("p_partkey is not null")
    ref = known.selectExpr("p_partkey as ref").union(known.selectExpr("p_partkey div 10")).distinct()
    exact = ref.where("ref % 3 = 0").join(p, F.col("ref") == F.col("p_partkey")).select("ref", F.col("p_partkey").alias("target"))
    rest = ref.join(exact.select("ref").distinct(), "ref", "left_anti")
    return exact.union(rest.join(p, F.expr("p_partkey div 10") == F.col("ref")).select("ref", "p_partkey"))


@query("SELECT o_orderkey AS id, CASE WHEN a.c_custkey IS NOT NULL THEN 'consolidation' WHEN b.c_custkey IS NOT NULL THEN 'main' END AS field, coalesce(a.c_name, b.c_name) AS path FROM orders LEFT JOIN customer a ON a.c_custkey = o_custkey * 2 AND a.c_acctbal > 0 LEFT JOIN customer b ON b.c_custkey = o_custkey AND b.c_acctbal > 0")
def j36_manifest_lookup(s, d):
    """The first of a record's addresses, consolidations first, that a stored file has."""
    at = F.array(F.struct(F.lit(0).alias("rank"), F.lit("consolidation").alias("field"), (F.col("o_custkey") * 2).alias("k")), F.struct(F.lit(1).alias("rank"), F.lit("main").alias("field"), F.col("o_custkey").alias("k")))
    files = customer(s, d).where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("path"))
    targets = orders(s, d).select(F.col("o_orderkey").alias("id"), F.explode(at).alias("t")).select("id", "t.*")
    best = targets.join(files, "k").groupBy("id").agg(F.min_by(F.struct("field", "path"), "rank").alias("b"))
    return orders(s, d).select(F.col("o_orderkey").alias("id")).join(best, "id", "left").select("id", "b.field", "b.path")


@query("SELECT o_custkey, arg_min(o_orderkey, (CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1000000000 END) - o_orderkey) AS best FROM orders GROUP BY 1")
def j38_edition_in_force(s, d):
    """An edition in force before others, then the newest."""
    return orders(s, d).groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct(F.col("o_orderstatus") == "F", "o_orderkey")).alias("best"))


@query("SELECT l_orderkey, CASE WHEN count(*) = 1 THEN min(l_partkey) ELSE min(l_partkey) FILTER (l_returnflag = 'A') END AS hit FROM lineitem GROUP BY 1 HAVING count(*) = 1 OR count(*) FILTER (l_returnflag = 'A') = 1")
def j39_only_match(s, d):
    """The only result, or the only one of several that carries the code."""
    exact, n = F.col("l_returnflag") == "A", F.count(F.lit(1))
    out = lineitem(s, d).groupBy("l_orderkey").agg(n.alias("n"), F.count_if(exact).alias("m"), F.min("l_partkey").alias("any"), F.min(F.when(exact, F.col("l_partkey"))).alias("one"))
    return out.where("n = 1 or m = 1").select("l_orderkey", F.when(F.col("n") == 1, F.col("any")).otherwise(F.col("one")).alias("hit"))


@query("SELECT o_custkey, arg_max(o_orderkey, (CASE WHEN o_orderpriority LIKE '1%' THEN 4000000000000 ELSE 0 END) + (CASE WHEN o_orderstatus = 'O' THEN 2000000000000 ELSE 0 END) + date_diff('day', DATE '1970-01-01', o_orderdate::date) * 10000000 + (9999999 - o_orderkey)) AS best FROM orders GROUP BY 1")
def w9_best_registry_row(s, d):
    """A real edition before amendments, a valid one before others, the latest issue; ties: the first."""
    order = F.struct(F.startswith("o_orderpriority", F.lit("1")), F.col("o_orderstatus") == "O", F.to_date("o_orderdate"), -F.col("o_orderkey"))
    return orders(s, d).groupBy("o_custkey").agg(F.max_by("o_orderkey", order).alias("best"))


@query("WITH m AS (SELECT conv_id, turn, text, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS record FROM conversations) SELECT conv_id, record, string_agg(text, ' ' ORDER BY turn) AS merged FROM m WHERE record > 0 GROUP BY 1, 2")
def w11_wrapped_lines(s, d):
    w = Window.partitionBy("conv_id").orderBy("turn")
    m = conv(s, d).withColumn("record", F.sum((F.col("role") == "user").cast("long")).over(w)).where("record > 0")
    texts = F.transform(F.array_sort(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"])
    return m.groupBy("conv_id", "record").agg(F.array_join(texts, " ").alias("merged"))


@query()
def w13_anchored_lines(s, d):
    """Words of an event stream as if on pages: users are documents, types pages, values places."""
    w = events(s, d).select(F.col("user_id").alias("doc"), F.col("event_type").alias("page"), F.col("value").cast("double").alias("top"), F.col("event_id").cast("double").alias("x0"), F.col("event_id").cast("string").alias("text"))
    return O.anchored_lines(w, 2.0)


@query()
def t1_page_lines(s, d):
    return pages(s, d).select("page_id", T.html_lines(F.col("html")).alias("lines"))


@query()
def t6_citation_contexts(s, d):
    text = F.concat(F.col("text"), F.lit(" podle zákona č. 458/2000 Sb., ve znění zákona č. 12/2020 Sb., a nařízení (EU) 2019/943 "), F.col("text"))
    # texts are dealt out, as a small file is one task; the outer form, as the optimizer puts a filter on the array before the
    # plain one, for which contexts would be found again
    dealt = documents(s, d).select("doc_id", "text").repartition(int(s.conf.get("spark.sql.shuffle.partitions")), "doc_id", "text")
    c = dealt.select("doc_id", F.explode_outer(T.contexts(text)).alias("c"))
    return c.where("c is not null").select("doc_id", "c.*")


@query()
def f47_title_similarity(s, d):
    """Each document's beginning against that of the document before it in its source."""
    w = Window.partitionBy("source").orderBy("doc_id")
    near = documents(s, d).select("doc_id", "source", F.substring("text", 1, 400).alias("a")).withColumn("b", F.lag("a").over(w))
    return near.where("b is not null").select("doc_id", T.title_similarity(F.col("a"), F.col("b")).alias("similarity"))


@query("SELECT doc_id, l.quality, coalesce(l.quality = 1 AND lang IN ('en', 'fr') AND n_chars >= 300, false) AS relevant FROM documents LEFT JOIN labels l USING (doc_id)")
def r4_confident_action(s, d):
    ok = (F.col("quality") == 1) & F.col("lang").isin("en", "fr") & (F.col("n_chars") >= 300)
    return documents(s, d).join(labels(s, d), "doc_id", "left").select("doc_id", "quality", F.coalesce(ok, F.lit(False)).alias("relevant"))


@query("SELECT conv_id, string_agg(DISTINCT role, ',' ORDER BY role) AS roles, count(*) AS turns FROM conversations GROUP BY 1")
def a20_sets_of_a_group(s, d):
    return conv(s, d).groupBy("conv_id").agg(F.array_join(F.array_sort(F.collect_set("role")), ",").alias("roles"), F.count(F.lit(1)).alias("turns"))


def version_history(s, d) -> DataFrame:
    c = F.col("designation")
    r = records(s, d).withColumns({"version_key": D.version_key(c, True), "level": D.amendment_level(c), "renumbered": D.is_renumbered(c)})
    return r.withColumn("version_key", F.concat("version_key", F.lit("|"), (F.col("id") % 40).cast("string")))


@query()
def g8_orphan_amendments(s, d):
    r = version_history(s, d)
    return S.orphan_amendments(r, R.version_groups(r, F.col("level") > 1)).select("id", "level")


KEYED = "WITH k AS (SELECT p_partkey, 1970 + p_size AS y, p_partkey AS n, ['regulation', 'directive', 'decision'][p_partkey % 3 + 1] AS kind FROM part) "


@query(KEYED + """SELECT p_partkey, CASE WHEN kind = 'regulation' THEN CASE WHEN y >= 2015 THEN concat('(EU) ', y, '/', n) ELSE concat('(', CASE WHEN y >= 2010 THEN 'EU' WHEN y >= 1993 THEN 'ES' ELSE 'EHS' END, ') č. ', n, '/', y) END
 ELSE concat(y, '/', n, '/', CASE WHEN y >= 2010 THEN 'EU' WHEN y >= 1993 THEN 'ES' ELSE 'EHS' END) END AS designation, concat('3', y, ['R', 'L', 'D'][p_partkey % 3 + 1], CASE WHEN n < 10000 THEN lpad(cast(n AS varchar), 4, '0') ELSE cast(n AS varchar) END) AS celex FROM k""")  # fmt: skip
def f27_keys_written(s, d):
    kind = F.element_at(F.array(*map(F.lit, ("regulation", "directive", "decision"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    key = F.concat(F.lit("EU:"), (F.lit(1970) + F.col("p_size")).cast("string"), F.lit("/"), F.col("p_partkey").cast("string"))
    return part(s, d).select("p_partkey", A.written(key, kind).alias("designation"), A.celex(key, kind).alias("celex"))


@query(r"SELECT doc_id, array_to_string(list_filter([CASE WHEN regexp_matches(trim(text), '^([-–—:]|\d+(-\d+)*\s*:)') OR (regexp_matches(trim(text), '^[a-záčďéěíňóřšťúůýž]') AND NOT regexp_matches(trim(text), '(?i)^(zákon|vyhlášk|nařízení|nariaden|smernic|směrnic|usnesení|sdělení|vykonávacie|opatrenie)')) THEN 'název vypadá jako useknutý fragment textu' END, CASE WHEN n_chars < 300 THEN 'chybí popis/anotace dokumentu' END], lambda x: x IS NOT NULL), '; ') AS reasons FROM documents")
def f20_review_reasons(s, d):
    return documents(s, d).select("doc_id", A.review_reasons(F.col("source"), F.col("text"), F.when(F.col("n_chars") >= 300, F.col("text"))).alias("reasons"))


@query("SELECT event_id, concat(day(ts), '. ', month(ts), '. ', year(ts)) AS shown, greatest(strftime(ts, '%Y-%m-%d'), '2024-01-15') AS checked FROM events")
def f42_dates_shown(s, d):
    iso = F.date_format("ts", "yyyy-MM-dd")
    return events(s, d).select("event_id", A.czech_date(iso).alias("shown"), A.later(F.lit("2024-01-15"), iso).alias("checked"))


@query("SELECT doc_id, length(text) * 10 // 28 + 1 AS tokens FROM documents")
def f48_token_estimates(s, d):
    return documents(s, d).select("doc_id", A.token_estimate(F.col("text")).alias("tokens"))
