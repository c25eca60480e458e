"""Full load: records of all sources in one form, and the catalogue's tables made of them.

Nothing is looked up row by row and no number is handed out in turn: places in the input are (source_rank, row) packed in
one long, ids of dimensions are hashes of their names, so that any run gives the same tables. Only identifiers, slugs
and the dimensions shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillstone.functions import bodies as B
from quillstone.functions.acts import eu_subtype, lifecycle, review_reasons
from quillstone.functions.designation import base_slug, first_known
from quillstone.functions.prose import guessed_language, norm_title
from quillstone.operators import relational as R
from quillstone.sources.readers import union_sources

VERSION = "array<struct<edition_label: string, effective_date: string, is_current: boolean>>"
TEXTS = (
    "designation", "kind", "title_authoritative", "title_cz", "title_sk", "title_eu", "section", "category", "url_authoritative",
    "url_main", "url_eu", "url_sk", "validity", "language", "description_authoritative", "description", "jurisdiction", "provenance", "slug",
)
LISTS = {"keywords": "array<string>", "responsible": "array<string>", "versions": VERSION}
ROWS = 1 << 40  # rows of a source at most
# Names of languages, longest identifier, kinds whose texts are not free, reasons for a review
LANGUAGES = {
    "en": "EN", "eng": "EN", "angličtina": "EN", "anglictina": "EN", "cs": "CS", "cz": "CS", "čeština": "CS", "cestina": "CS",
    "sk": "SK", "slovenština": "SK", "slovencina": "SK", "de": "DE", "němčina": "DE", "nemcina": "DE",
}
LONGEST_IDENTIFIER = 100
RESTRICTED = (B.NORM,)
GUESSED = "jazyk dokumentu byl automaticky odhadnut, ověřte ({})"
NO_BODY = "EU akt: autoritativní gestor (DG/instituce) se v EUR-Lex/Cellar nepodařilo dohledat"


@dataclass(frozen=True)
class Source:
    """Rows with their place `row`, and for each column of a record an expression over them; other columns are blank."""

    rows: DataFrame
    columns: Mapping[str, Column]
    row: str = "row"

    def records(self) -> DataFrame:
        unknown = set(self.columns) - set(TEXTS) - set(LISTS)
        if unknown:
            raise ValueError(f"no columns of a record: {sorted(unknown)}")
        texts = [F.trim(F.coalesce(self.columns.get(c, F.lit("")).cast("string"), F.lit(""))).alias(c) for c in TEXTS]
        lists = [F.coalesce(self.columns.get(c, F.lit(None)).cast(t), F.array().cast(t)).alias(c) for c, t in LISTS.items()]
        return self.rows.select(F.col(self.row).cast("long").alias("row"), *texts, *lists)


def source_records(sources: Mapping[str, Source | None]) -> tuple[DataFrame, list[str]]:
    """Records of all sources with source and seq (their place: sources in order, then rows), and the names of missing ones."""
    out, missing = union_sources({name: s and s.records() for name, s in sources.items()})
    if out is None:
        raise ValueError("no source is there")
    return out.withColumn("seq", F.col("source_rank").cast("long") * ROWS + F.col("row")).drop("source_rank", "row"), missing


def identifiers(records: DataFrame, longest: int = LONGEST_IDENTIFIER) -> DataFrame:
    """Adds identifier: the designation, for the first record that has it and only up to `longest` signs; else null.

    First records are found by an aggregate and joined by seq, so a designation that very many records share is no hot key.
    """
    named = records.where((F.col("designation") != "") & (F.length("designation") <= longest))
    first = named.groupBy("designation").agg(F.min("seq").alias("seq")).select("seq", F.col("designation").alias("identifier"))
    return records.join(first, "seq", "left")


def resolved(records: DataFrame, eu_bodies: DataFrame | None = None, languages: Mapping[str, str] = LANGUAGES) -> DataFrame:
    """Records with a title as documents with all their columns (id is seq), and with what their other tables need.

    eu_bodies: url, body of EU acts. Columns: id, title, description, type_name, source_name, language, url,
    effective_date, identifier, jurisdiction, needs_review, review_reason, provenance, subtype, and as given designation,
    versions, keywords, section, category, validity, slug.
    """
    c = {x: F.col(x) for x in TEXTS}
    rows = identifiers(records.withColumn("title", B.first_title(c)).where(F.col("title").isNotNull()))
    rows = rows.withColumns({
        "type_name": B.document_kind(c["kind"]),
        "url": F.coalesce(first_known(*[c[u] for u in ("url_authoritative", "url_main", "url_eu", "url_sk")]), F.lit("")),
        "text": F.coalesce(first_known(c["description_authoritative"], c["description"]), F.lit("")),
    })
    is_eu = F.col("type_name").isin(*B.EU_ACTS)
    if eu_bodies is None:
        rows = rows.withColumn("eu_body", F.lit(None).cast("string"))
    else:  # a url that very many records share meets one row
        rows = rows.join(eu_bodies.groupBy("url").agg(F.min("body").alias("eu_body")), "url", "left")
    body = F.when(is_eu, F.col("eu_body")).when(F.col("type_name") == B.NORM, B.issuing_body(F.col("identifier"))).otherwise(B.responsible(F.col("responsible")))
    rows = rows.withColumn("source_name", body).withColumn("spoken", B.document_language(F.col("url"), c["language"], guessed_language(F.col("title")), languages))
    reasons = F.array(
        F.nullif(review_reasons(c["designation"], F.col("title"), F.col("text")), F.lit("")),
        F.when(~F.col("spoken.sure"), F.concat(*[F.lit(x) if x else F.col("spoken.code") for x in (GUESSED.split("{}")[0], "", GUESSED.split("{}")[1])])),
        F.when(is_eu & F.col("eu_body").isNull(), NO_BODY),
    )
    reason = F.nullif(F.array_join(F.array_compact(reasons), "; "), F.lit(""))
    return rows.select(
        F.col("seq").alias("id"), F.when(F.col("type_name") == B.NORM, norm_title(F.col("title"), F.col("identifier"))).otherwise(F.col("title")).alias("title"),
        F.col("text").alias("description"), "type_name", "source_name", F.col("spoken.code").alias("language"), "url", F.col("validity").alias("effective_date"), "identifier",
        F.nullif(c["jurisdiction"], F.lit("")).alias("jurisdiction"), reason.isNotNull().alias("needs_review"), reason.alias("review_reason"),
        F.nullif(c["provenance"], F.lit("")).alias("provenance"), eu_subtype(F.col("title"), F.col("url"), c["jurisdiction"]).alias("subtype"),
        "designation", "responsible", "versions", "keywords", "section", "category", "validity", F.col("slug").alias("own_slug"),
    )


def catalogue(records: DataFrame, eu_bodies: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables document, version, keyword, document_keyword, type, source of records (see source_records())."""
    documents = resolved(records, eu_bodies)
    # an address given beforehand is kept; others take the first free one of their base
    free = documents.where("own_slug = ''").select("id", F.coalesce("identifier", F.lit("")).alias("designation"), "title", F.col("id").alias("seq"), base_slug(F.col("identifier"), F.col("title")).alias("base"))
    pinned = documents.where("own_slug <> ''").select("id", F.col("own_slug").alias("slug"))
    slugs = R.assign_slugs(free, pinned.select("slug")).select("id", "slug").unionByName(pinned)
    plain = F.struct(F.lit(None).cast("string").alias("edition_label"), F.lit(None).cast("string").alias("effective_date"), F.lit(True).alias("is_current"))
    own = F.size("versions") > 0
    each = documents.select("id", "validity", own.alias("own"), F.posexplode(F.when(own, F.col("versions")).otherwise(F.array(plain))).alias("at", "v"))
    current = F.coalesce("v.is_current", F.lit(False))
    versions = each.select(
        F.col("id").alias("document_id"), (F.col("at") + 1).alias("version"), F.nullif("v.edition_label", F.lit("")).alias("edition_label"), F.nullif("v.effective_date", F.lit("")).alias("effective_date"),
        current.alias("is_current"), lifecycle(F.when(F.col("own"), F.col("v.effective_date")).otherwise(F.col("validity")), current).alias("lifecycle_state"),
    )
    words = F.transform(F.concat("keywords", F.array("section", "category")), lambda w: F.trim(w))
    links = documents.select(F.col("id").alias("document_id"), F.explode(F.array_distinct(F.filter(words, lambda w: F.coalesce(w, F.lit("")) != ""))).alias("keyword"))
    known = ~F.coalesce("jurisdiction", F.lit("")).isin(*B.UNKNOWN)
    places = documents.groupBy(B.responsible(F.col("responsible")).alias("name")).agg(F.min_by("jurisdiction", F.when(known, F.col("id"))).alias("jurisdiction"))
    names = documents.where("source_name <> ''").select(F.col("source_name").alias("name")).distinct()
    number = lambda c: F.xxhash64(F.col(c))
    kept = ("id", "title", "description", "language", "url", "effective_date", "identifier", "jurisdiction", "needs_review", "review_reason", "provenance", "subtype")
    return {
        "document": documents.select(*kept, number("type_name").alias("type_id"), F.when(F.col("source_name") != "", number("source_name")).alias("source_id")).join(slugs, "id"),
        "version": versions,
        "keyword": links.select("keyword").distinct().withColumn("id", number("keyword")),
        "document_keyword": links.select("document_id", number("keyword").alias("keyword_id")),
        "type": documents.select(F.col("type_name").alias("name")).distinct().withColumns({"restricted": F.col("name").isin(*RESTRICTED), "id": number("name")}),
        "source": names.join(places, "name", "left").withColumn("id", number("name")),
    }
