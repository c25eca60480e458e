"""Queries of the record build and the full load; each goes through its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.functions import bodies as B
from quillstone.operators import load as O
from quillstone.plans.catalogue import REC, SLUG, part, query, supplier
from quillstone.plans.fixtures import records

# Titles that hold designations; both engines run this text
TITLES = """SELECT p_partkey AS id, CASE p_partkey % 9
 WHEN 0 THEN concat(p_name, ' [2019/', cast(p_partkey AS varchar(20)), '] ')
 WHEN 1 THEN concat('(EÚ)  2021/', cast(p_partkey AS varchar(20)), ' ', p_name)
 WHEN 2 THEN concat('2014/', cast(p_partkey AS varchar(20)), '/ES ', p_name)
 WHEN 3 THEN concat('TPG 304 ', cast(p_size AS varchar(20)), ' - ', p_name)
 WHEN 4 THEN concat('Zákon (č. ', cast(p_size AS varchar(20)), ' / 2001 Sb.) ', p_name)
 WHEN 5 THEN concat('Vyhláška č. ', cast(p_size AS varchar(20)), '/2004 Z. z. ', p_name)
 WHEN 6 THEN concat('Nařízení Rady (ES) 2017/', cast(p_partkey AS varchar(20)), ' ', p_name)
 WHEN 7 THEN concat(' EN  ', cast(10000 + p_partkey AS varchar(20)), '-1')
 ELSE concat('Směrnice 1999/', cast(p_size AS varchar(20)), ' / EU ', p_name) END AS title FROM part"""


def _first(pattern: str, group: int = 0, of: str = "t") -> str:
    return f"nullif(regexp_extract({of}, '{pattern}', {group}), '')"


def _one_blank(c: str) -> str:
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


FOUND = ", ".join([
    _first(r"(\[\d{3,4}/\d+\])\s*$", 1),
    *[f"replace({_one_blank(_first(p))}, 'EÚ', 'EU')" for p in (r"^\(?\s*(?:EU|EÚ|ES)\s*\)?\s*\d{3,5}/\d+", r"^\d{3,5}/\d+/(?:EU|ES|EÚ)")],
    rf"CASE WHEN regexp_matches({_first(r'^(.{1,60}?)\s+-\s+\S', 1)}, '\d') THEN {_one_blank(_first(r'^(.{1,60}?)\s+-\s+\S', 1))} END",
    rf"replace({_first(r'č\.?\s*(\d{1,4}\s*/\s*\d{4})\s*Sb\.', 1)}, ' ', '') || ' Sb.'",
    rf"replace({_first(r'č\.?\s*(\d{1,4}\s*/\s*\d{4})\s*Z\s*\.?\s*z', 1)}, ' ', '') || ' Z. z.'",
    f"replace(replace({_one_blank(_first(r'\(\s*(?:EU|EÚ|ES)\s*\)\s*\d{3,5}/\d+'))}, 'EÚ', 'EU'), 'ES', 'EU')",
    f"replace({_one_blank(_first(r'\d{3,5}/\d+\s*/\s*(?:EU|ES|EÚ)'))}, 'EÚ', 'EU')",
    rf"CASE WHEN length({_one_blank('t')}) <= 40 AND regexp_matches(t, '\d') THEN {_one_blank('t')} END",
])


@query(f"SELECT id, coalesce({FOUND}, '') AS designation FROM (SELECT id, trim(title) AS t FROM ({TITLES}))")
def f11_title_designation(s, d):
    return s.sql(TITLES.replace("FROM part", "FROM {part}"), part=part(s, d)).select("id", B.designation_in_title(F.col("title")).alias("designation"))


def _rows(values: dict[str, str], columns: str) -> str:
    quoted = ", ".join("('" + "', '".join(x.replace("'", "''") for x in kv) + "')" for kv in values.items())
    return f"(VALUES {quoted}) AS t({columns})"


TABLES = f", b AS (SELECT * FROM {_rows(B.BODIES, 'word, body')}), lower_b AS (SELECT lower(word) AS word, body FROM b), j AS (SELECT * FROM {_rows(B.JURISDICTIONS, 'body, place')})"
BODY = "coalesce(b1.body, l1.body, b2.body, l2.body)"


def _with_body(rows: str) -> str:
    """Joins the body of column `first`, the first word of a designation."""
    letters = "regexp_extract(first, '^[A-Za-zÁ-Žá-ž]+')"
    return (
        f"{rows} LEFT JOIN b b1 ON b1.word = first LEFT JOIN lower_b l1 ON l1.word = lower(first)"
        f" LEFT JOIN b b2 ON b2.word = {letters} LEFT JOIN lower_b l2 ON l2.word = lower({letters})"
    )


@query(REC + TABLES + rf", w AS (SELECT *, regexp_extract(trim(designation), '^\S+') AS first FROM records) SELECT id, {BODY} AS body, CASE WHEN coalesce(jurisdiction, 'neurčeno') <> 'neurčeno' THEN jurisdiction ELSE coalesce(place, jurisdiction) END AS jurisdiction FROM " + _with_body("w") + f" LEFT JOIN j ON j.body = {BODY}")
def f16_issuing_bodies(s, d):
    """Issuing bodies of all records, and jurisdictions filled by them."""
    blank = F.lit("")
    place = B.filled_jurisdiction(F.col("jurisdiction"), kind=F.lit(B.NORM), designation=F.col("designation"), title=blank, address=blank)
    return records(s, d).select("id", B.issuing_body(F.col("designation")).alias("body"), place.alias("jurisdiction"))


def source_rows(s, d) -> DataFrame:
    """Records of two sources: a list of norms and EU acts (parts), and acts whose designation stands in the title (suppliers)."""
    parts = part(s, d).select("p_partkey", "p_size", "p_brand", "p_type").join(records(s, d), F.col("id") == F.col("p_partkey"))
    k = F.col("p_partkey") % 9
    listed = O.Source(parts, {
        "title_cz": F.when(F.col("id") % 11 == 0, "").otherwise(F.concat(F.when(F.col("id") % 2 == 0, "Part ").otherwise("Díl "), F.col("title"))),
        "title_eu": F.when(F.col("id") % 11 == 0, F.concat(F.lit("Item "), F.col("title"))), "designation": F.col("designation"), "kind": F.when(k == 4, "Nařízení EU").when(k == 5, "17").otherwise("Norma"),
        "section": F.col("p_brand"), "keywords": F.split("p_type", " "), "jurisdiction": F.col("jurisdiction"), "language": F.when(F.col("id") % 5 == 0, "Němčina"),
        "description": F.when(F.col("id") % 7 > 0, "x"), "validity": F.when(F.col("id") % 13 == 0, "Entwurf"), "url_eu": F.when(k == 4, F.concat(F.lit("u"), F.col("p_size"))),
    }, row="p_partkey")
    title = F.concat(F.lit("Zákon č. "), F.col("s_suppkey"), F.lit("/"), F.col("s_nationkey") + 1990, F.lit(" Sb., o "), F.col("s_name"))
    versions = F.transform(F.sequence(F.lit(0), F.col("s_nationkey") % 3), lambda i: F.struct(F.concat(F.lit("e"), i).alias("edition_label"), F.concat(i + 2000, F.lit("-01-01")).alias("effective_date"), (i == F.col("s_nationkey") % 3).alias("is_current")))
    acts = O.Source(supplier(s, d), {
        "title_cz": title, "designation": B.designation_in_title(title), "kind": F.lit("Zákon"), "responsible": F.array(F.lit(" "), F.concat(F.lit("Úřad "), F.col("s_nationkey"))), "jurisdiction": F.when(F.col("s_suppkey") % 2 == 0, "CZ").otherwise("neurčeno"),
        "url_main": F.lit("https://www.E-sbirka.gov.cz/1"), "description": F.lit("y"), "versions": versions,
    }, row="s_suppkey")
    return O.source_records({"listed": listed, "gone": None, "acts": acts})[0]


def loaded(s, d) -> dict[str, DataFrame]:
    eu = part(s, d).where("p_size % 2 = 0").select(F.concat(F.lit("u"), F.col("p_size")).alias("url"), F.concat(F.lit("DG "), F.col("p_size")).alias("body"))
    return O.catalogue(source_rows(s, d), eu)


# The same rows for the SQL
SOURCES = (
    REC + TABLES + rf""", a AS (SELECT id, p_size, trim(designation) AS designation, CASE WHEN id % 11 = 0 THEN concat('Item ', title) ELSE concat(CASE WHEN id % 2 = 0 THEN 'Part ' ELSE 'Díl ' END, title) END AS raw,
 CASE id % 9 WHEN 4 THEN 'Nařízení EU' WHEN 5 THEN 'Nezařazeno' ELSE 'Norma' END AS type_name, CASE WHEN id % 9 = 4 THEN concat('u', p_size) ELSE '' END AS url, CASE WHEN id % 5 = 0 THEN 'DE' END AS known,
 CASE WHEN id % 7 > 0 THEN 'x' ELSE '' END AS description, jurisdiction, NULL AS office, p_brand AS section, p_type AS words, CASE WHEN id % 13 = 0 THEN 'draft' ELSE 'active' END AS state, 0 AS editions FROM records JOIN part ON p_partkey = id
 UNION ALL SELECT {O.ROWS} * 2 + s_suppkey, 0, CASE WHEN s_suppkey < 10000 THEN concat(s_suppkey, '/', 1990 + s_nationkey, ' Sb.') ELSE '' END, concat('Zákon č. ', s_suppkey, '/', 1990 + s_nationkey, ' Sb., o ', s_name), 'Zákon',
 'https://www.E-sbirka.gov.cz/1', 'CS', 'y', CASE WHEN s_suppkey % 2 = 0 THEN 'CZ' ELSE 'neurčeno' END, concat('Úřad ', s_nationkey), '', '', 'active', s_nationkey % 3 + 1 FROM supplier),
 firsts AS (SELECT min(id) AS id, designation AS identifier FROM a WHERE designation <> '' GROUP BY 2),
 n AS (SELECT a.*, identifier, coalesce(regexp_extract(identifier, '^\S+'), '') AS first, trim(regexp_replace(coalesce(identifier, ''), '\s*/?\s*[-–—]\s*(19|20)\d{{2}}(\.\d{{2}})?\s*$', '')) AS core FROM a LEFT JOIN firsts USING (id)),
 m AS (SELECT n.*, CASE WHEN type_name = 'Norma' AND identifier IS NOT NULL THEN concat(core, ' — ', raw) ELSE raw END AS title,
  CASE type_name WHEN 'Norma' THEN {BODY} WHEN 'Nařízení EU' THEN CASE WHEN p_size % 2 = 0 THEN concat('DG ', p_size) END ELSE office END AS source_name,
  coalesce(known, CASE WHEN regexp_matches(raw, '(?i)[áčďéěíňóřšťúůýž]') THEN 'CS' ELSE 'EN' END) AS language FROM {_with_body("n")})"""
)
REASON = "nullif(concat_ws('; ', CASE WHEN description = '' THEN 'chybí popis/anotace dokumentu' END, CASE WHEN known IS NULL THEN concat('jazyk dokumentu byl automaticky odhadnut, ověřte (', language, ')') END, CASE WHEN type_name = 'Nařízení EU' AND source_name IS NULL THEN '" + O.NO_BODY + "' END), '')"
BASE = SLUG.replace("designation", "identifier")


@query(SOURCES + f", s AS (SELECT *, coalesce(nullif({BASE}, ''), concat('doc-', left(sha1(title), 8))) AS base FROM m), r AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY coalesce(identifier, ''), title, id) AS k FROM s) "
       f"SELECT id, identifier, title, type_name, source_name, language, jurisdiction, {REASON} AS review_reason, CASE WHEN k = 1 THEN base ELSE concat(base, '-', k) END AS slug FROM r")  # fmt: skip
def c2_documents(s, d):
    """The documents of a full load with the names of their types and sources."""
    t = loaded(s, d)
    kinds, sources = t["type"].select(F.col("id").alias("type_id"), F.col("name").alias("type_name")), t["source"].select(F.col("id").alias("source_id"), F.col("name").alias("source_name"))
    return t["document"].join(kinds, "type_id").join(sources, "source_id", "left").select("id", "identifier", "title", "type_name", "source_name", "language", "jurisdiction", "review_reason", "slug")


@query(SOURCES + " SELECT id AS document_id, i AS version, CASE WHEN editions > 0 THEN concat('e', i - 1) END AS edition_label, CASE WHEN editions > 0 THEN concat(1999 + i, '-01-01') END AS effective_date, i = greatest(editions, 1) AS is_current, CASE WHEN i < editions THEN 'superseded' ELSE state END AS lifecycle_state FROM a, (VALUES (1), (2), (3)) v(i) WHERE i <= greatest(editions, 1)")
def c2_versions(s, d):
    return loaded(s, d)["version"]


@query(SOURCES + " SELECT DISTINCT id AS document_id, keyword FROM (SELECT id, unnest(list_concat(string_split(words, ' '), [section])) AS keyword FROM a) WHERE trim(keyword) <> ''")
def c2_keywords(s, d):
    t = loaded(s, d)
    return t["document_keyword"].join(t["keyword"], F.col("keyword_id") == F.col("id")).select("document_id", "keyword")


@query(SOURCES + ", p AS (SELECT office, arg_min(jurisdiction, id) FILTER (jurisdiction <> 'neurčeno') AS jurisdiction FROM a WHERE office IS NOT NULL GROUP BY 1) SELECT DISTINCT source_name AS name, p.jurisdiction FROM m LEFT JOIN p ON p.office = source_name WHERE source_name IS NOT NULL")
def c2_sources(s, d):
    return loaded(s, d)["source"].select("name", "jurisdiction")
