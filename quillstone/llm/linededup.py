"""Cross-site boilerplate lines: HyperLogLog sketches of each line's sites, exact counts near the threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstone.llm.common import materialise

MIN_SITES = 10
PRECISION = 12  # 2 ** PRECISION registers of a sketch at most; sketches of few sites are short lists
ERRORS = 6.0  # relative standard errors of the sketch on either side of the threshold that are counted exactly


def _lines(docs: DataFrame, id_col: str, text_col: str, site_col: str, min_chars: int) -> DataFrame:
    """One row for each line of min_chars characters or more of a document: doc, th (hash of the text), site, pos, key, check.

    key and check are hashes of the line by two functions; lines are told apart by both.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    each = docs.select(
        docs[id_col].alias("doc"), F.xxhash64(text).alias("th"), F.coalesce(docs[site_col].cast("string"), F.lit("")).alias("site"), F.posexplode(F.split(text, "\n")).alias("pos", "line")
    ).withColumn("line", F.trim(F.col("line"), F.lit(" \t\r")))
    return each.where(F.length("line") >= max(1, min_chars)).select("doc", "th", "site", "pos", F.xxhash64("line").alias("key"), F.hash("line").alias("check"))


def sketches(lines: DataFrame, precision: int = PRECISION) -> DataFrame:
    """key, check, sketch (HyperLogLog of the line's sites), first_doc (smallest id with the line); merged by aggregation."""
    return lines.groupBy("key", "check").agg(F.hll_sketch_agg("site", precision).alias("sketch"), F.min("doc").alias("first_doc"))


def band(min_sites: int, precision: int = PRECISION) -> tuple[float, float]:
    """Estimates between which a line is near the threshold: ERRORS standard errors of the sketch, one site at least."""
    share = ERRORS * 1.04 / 2 ** (precision / 2)
    return min(min_sites - 1.0, min_sites * (1 - share)), max(min_sites + 1.0, min_sites * (1 + share))


def boilerplate(lines: DataFrame, *, min_sites: int = MIN_SITES, precision: int = PRECISION) -> DataFrame:
    """key, check, first_doc of every line of _lines() on min_sites distinct sites or more.

    The estimate of its sketch tells whether a line is far below the threshold, far above it or near; lines near it get
    exact distinct counts. An estimate is that far off with a chance below 1e-8 a line.
    """
    low, high = band(min_sites, precision)
    merged = sketches(lines, precision).select("key", "check", "first_doc", F.hll_sketch_estimate("sketch").alias("sites"))
    merged = materialise(merged.where(F.col("sites") >= low), "sketches")
    near = merged.where(F.col("sites") < high)
    pairs = lines.join(near.select("key", "check"), ["key", "check"], "left_semi").select("key", "check", "site").distinct()
    exact = pairs.groupBy("key", "check").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_sites)
    sure = merged.where(F.col("sites") >= high).select("key", "check", "first_doc")
    return materialise(sure.unionByName(near.join(exact, ["key", "check"], "left_semi").select("key", "check", "first_doc")), "boilerplate")


def without_boilerplate(docs: DataFrame, *, min_sites: int = MIN_SITES, min_chars: int = 1, precision: int = PRECISION, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source") -> DataFrame:
    """docs with boilerplate lines taken out of text_col, and _qs_lines, _qs_removed (counts of lines).

    A line is split at newlines and compared without the spaces, tabs and carriage returns around it; blank lines and
    those shorter than min_chars are never touched. The document with the smallest id that holds a boilerplate line keeps it, so nothing is
    lost altogether. Cases: null text stays null with no lines; a null site is one site; rows with equal ids keep or lose
    a line together, and a null id never keeps one; an empty table stays empty; a document all of whose lines go becomes
    an empty text. Other columns are kept.
    """
    text = docs[text_col].cast("string")
    if min_sites < 2:
        raise ValueError("min_sites of 2 or more")
    every = materialise(_lines(docs, id_col, text_col, site_col, min_chars), "lines")
    dropped = boilerplate(every, min_sites=min_sites, precision=precision)
    hits = every.join(dropped, ["key", "check"]).where(~F.col("doc").eqNullSafe(F.col("first_doc")))
    of_doc = hits.groupBy(F.col("doc").alias("_qs_doc"), F.col("th").alias("_qs_th")).agg(F.collect_list("pos").alias("_qs_gone"))
    same = docs[id_col].eqNullSafe(F.col("_qs_doc")) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col("_qs_th"))
    joined = docs.join(of_doc, same, "left").withColumn("_qs_split", F.split(text, "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_qs_split") - 1), "_qs_gone")
    out = joined.withColumn("_qs_kept", F.when(F.col("_qs_gone").isNotNull(), kept))
    joined_lines = F.array_join(F.transform("_qs_kept", lambda i: F.col("_qs_split")[i]), "\n")
    new = F.when(F.col("_qs_kept").isNull(), text).otherwise(joined_lines)
    lines = F.when(text.isNull(), F.lit(0)).otherwise(F.size("_qs_split"))
    removed = F.when(F.col("_qs_kept").isNull(), F.lit(0)).otherwise(F.size("_qs_split") - F.size("_qs_kept"))
    return out.select(
        *[(new.alias(c) if c == text_col else docs[c]) for c in docs.columns], lines.cast("long").alias("_qs_lines"), removed.cast("long").alias("_qs_removed")
    )


OP2_SQL = f"""
WITH l AS (
  SELECT doc_id, coalesce(source, '') AS site, i, line, trim(line, ' ' || chr(9) || chr(13)) AS t
  FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents)
),
b AS (
  SELECT t, min(doc_id) AS first_doc FROM l WHERE length(t) >= 1 GROUP BY t HAVING count(DISTINCT site) >= {MIN_SITES}
),
m AS (SELECT l.*, coalesce(l.doc_id <> b.first_doc, false) AS gone FROM l LEFT JOIN b ON l.t = b.t)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text
FROM m GROUP BY doc_id
"""


def op2_cross_site_line_dedup(spark, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_removed, text of every document, by every line that is not blank; cases as without_boilerplate()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    out = without_boilerplate(docs)
    return out.select("doc_id", F.col("_qs_lines").alias("n_lines"), F.col("_qs_removed").alias("n_removed"), "text")
