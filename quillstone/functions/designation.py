"""Column functions on designations of documents: normal forms, cores, classes. Null counts as blank."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes, suffixes and series whose spelling varies
DASHES = "[\\u2010-\\u2015\\u2212]"
EDITION_MONTH = r"/\s*-\s*\d{4}\.\d{2}\s*$"
EDITION_COLON_MONTH = r"\s*:\s*\d{4}-\d{2}\s*$"
EDITION_COLON_YEAR = r"\s*:\s*\d{4}\s*$"
NATIONAL = r"(?iu)^(?:STN|ČSN|CSN|TNI|DIN|VDE|NF|BS|NEN)\s+"
GASES = r"(?i)^(?:EIGA\s+Doc\s+|EIGA\s+|IGC\s+Doc\s+)"
AMENDMENT = r"(?i)[/+]\s*(?:A\d+|AC\d*)"
EU_ACT = r"(?iu)^\((?:EU|ES|EC|EÚ|EEC|EHS)\)|/(?:EU|ES|EC|EÚ|EEC|EHS)\s*$"


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


def _folded(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    c = F.regexp_replace(c, r"(?i)\b(CSA)\s*/?\s*(ANSI)\b", "$1$2")
    c = F.regexp_replace(c, r"(?i)\b(IGEM)\s*/?\s*(TD)\s*/?\s*(1)\b", "$1$2$3")
    c = F.regexp_replace(c, GASES, "")
    c = squeeze(F.regexp_replace(c, DASHES, "-"))
    for suffix in (EDITION_MONTH, EDITION_COLON_MONTH, EDITION_COLON_YEAR):
        c = F.regexp_replace(c, suffix, "")
    return c


def normalise(c: Column) -> Column:
    """Folds series spellings, organisation aliases, dashes and blanks, drops an edition date, lower-cases."""
    return F.lower(F.trim(_folded(c)))


def core(c: Column) -> Column:
    return F.regexp_replace(normalise(c), "^čsn ", "")


def international_core(c: Column) -> Column:
    """Without a national prefix, and without EN where ISO or IEC follows."""
    c = F.trim(F.regexp_replace(_folded(c), NATIONAL, ""))
    return F.lower(F.trim(F.regexp_replace(c, r"(?i)^EN\s+(ISO|IEC)\b", "$1")))


def digit_tokens(c: Column) -> Column:
    return F.array_join(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"\d+"), F.lit(0)), " ")


def number_year(c: Column) -> Column:
    """The first N/YYYY, else the first YYYY/N, else null."""
    c = F.coalesce(c, F.lit(""))
    first = lambda p: F.nullif(F.regexp_extract(c, p, 0), F.lit(""))
    return F.coalesce(first(r"\d+/\d{4}"), first(r"\d{4}/\d+"))


def number_orders(c: Column) -> Column:
    """Spellings of a number pair a/b in the order to try them: a/b, b/a, then with two-digit years as 19yy."""
    a, b = F.regexp_extract(c, r"^(\d+)/(\d+)", 1), F.regexp_extract(c, r"^(\d+)/(\d+)", 2)
    cat = lambda *x: F.concat(*[F.lit(y) if isinstance(y, str) else y for y in x])
    some = F.array(
        cat(a, "/", b), cat(b, "/", a),
        F.when(F.length(a) == 2, cat("19", a, "/", b)), F.when(F.length(a) == 2, cat(b, "/19", a)),
        F.when(F.length(b) == 2, cat(a, "/19", b)), F.when(F.length(b) == 2, cat("19", b, "/", a)),
    )
    return F.when(a == "", F.array(c)).otherwise(F.array_distinct(F.array_compact(some)))


def is_eu_act(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(EU_ACT)


def version_key(c: Column, fold_renumbering: bool = False) -> Column:
    """Designation without amendment mark and edition date, to group editions."""
    c = F.regexp_replace(F.coalesce(c, F.lit("")), DASHES, "-")
    c = F.regexp_replace(F.regexp_replace(c, AMENDMENT, ""), r"[/\s]*-\s*\d{4}[.\-]\d{2}\s*$", "")
    if fold_renumbering:
        c = F.regexp_replace(c, r"(?i)\bEN\s+IEC\b", "EN")
    return F.lower(squeeze(c))


def amendment_level(c: Column) -> Column:
    mark = F.regexp_extract(F.coalesce(c, F.lit("")), AMENDMENT, 0)
    digits = F.regexp_extract(mark, r"\d+", 0)
    return F.when(mark == "", 0).when(digits == "", 1).otherwise(digits.cast("int"))


def is_renumbered(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?i)\bEN\s+IEC\b")


def tier(jurisdiction: Column) -> Column:
    j = F.trim(F.coalesce(jurisdiction, F.lit("")))
    return F.when(j == "mezinárodní", "international").when(j == "EU", "EU").when(j.isin("", "neurčeno"), None).otherwise("national")


# Letters with marks and their plain forms
MARKED = "áäčďéěëíľĺňńóöőôřŕšśťúůüűýžźçñàèùâêîûÁÄČĎÉĚÍĽĹŇÓÖÔŘŔŠŤÚŮÜÝŽÇÑ"
PLAIN = "aacdeeeillnnoooorrsstuuuuyzzcnaeuaeiuAACDEEILLNOOORRSTUUUYZCN"


def slugify(c: Column, most: int = 120) -> Column:
    c = F.translate(F.coalesce(c, F.lit("")), MARKED, PLAIN)
    c = F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-")
    return F.substring(F.regexp_replace(c, "^-+|-+$", ""), 1, most)


def base_slug(designation: Column, title: Column) -> Column:
    own = slugify(designation)
    return F.when(own != "", own).otherwise(F.concat(F.lit("doc-"), F.substring(F.sha1(F.coalesce(title, F.lit("")).cast("binary")), 1, 8)))


def fallback_key(key: Column, url: Column) -> Column:
    return F.left(F.coalesce(F.nullif(key, F.lit("")), F.concat(F.lit("url:"), F.substring(F.sha2(url, 256), 1, 12))), F.lit(120))


def first_known(*cs: Column) -> Column:
    """The first that is not blank, trimmed; null if none is."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in cs])


def iso_date(c: Column) -> Column:
    """D.M.YYYY as an ISO date, else null."""
    p = r"^\s*(\d{1,2})\.\s*(\d{1,2})\.\s*(\d{4})\s*$"
    part = lambda i: F.regexp_extract(c, p, i)
    return F.when(c.rlike(p), F.concat(part(3), F.lit("-"), F.lpad(part(2), 2, "0"), F.lit("-"), F.lpad(part(1), 2, "0")))


def earliest(c: Column, words: dict[str, str]) -> Column:
    """Label of the word that occurs first in the text; null if none does."""
    places = F.array(*[F.struct(F.locate(w, c).alias("at"), F.lit(label).alias("label")) for w, label in words.items()])
    return F.array_min(F.filter(places, lambda x: x["at"] > 0))["label"]


def packed_list(c: Column) -> Column:
    """Numbers of a comma-packed list; other parts are left out."""
    return F.transform(F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x.rlike(r"^\d+$")), lambda x: x.cast("int"))


def strip_tags(c: Column) -> Column:
    c = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<(script|style)\b.*?</(script|style)>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), r"[ \t\r\n]+", " "))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays in double precision; 0 with a zero vector."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, y: s + y)
    dot = total(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))
    size = lambda v: F.sqrt(total(F.transform(v, lambda x: x.cast("double") * x.cast("double"))))
    return F.when((size(a) == 0) | (size(b) == 0), 0.0).otherwise(dot / (size(a) * size(b)))
