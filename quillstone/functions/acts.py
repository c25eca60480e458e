"""Column functions on legal acts: types, keys and addresses, states, quality of records, dates. Null counts as blank."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstone.functions.designation import first_known

# Words by which acts are told apart, in the languages of the catalogue
NORM_START = r"(?iu)^(?:ČSN|CSN|STN|TNI|DIN|VDE|NF|BS|NEN|ISO|IEC|EN)(?U)\b"
EU_BODY = r"(?iuU)\((?:EU|EÚ)\)|evropsk[ée]ho parlamentu|evropskej? rady|\bkomis[ei]|evropsk[ée] centráln[íí] banky|european parliament|european central bank|\bof the council\b|\bcommission\b"
EU_TYPES = {
    "Směrnice EU": r"(?iuU)směrnice|smernica|\bdirective\b",
    "Rozhodnutí EU": r"(?iuU)rozhodnutí|rozhodnutie|\bdecision\b",
    "Nařízení EU": r"(?iuU)nařízení|nariadenie|\bregulation\b",
}
LAW, DECREE, ORDER = r"(?iuU)\bzákon(?:a|[íi]?k)?\b", r"(?iuU)^\s*vyhlá[šs]", r"(?iuU)^\s*(?:nařízení|nariadenie)\s+vlády"
ACT = r"(?:nařízení|rozhodnutí|směrnice|nariadenie|rozhodnutie|smernica|regulation|decision|directive)"
DELEGATED = rf"(?iuU)v\s+přenesené\s+pravomoci|delegovan[éá]\s+{ACT}|delegated\s+{ACT}"
IMPLEMENTING = rf"(?iuU)(?:prováděcí|vykonávacie|vykonávacia)\s+{ACT}|(?:commission|council)\s+implementing\s+{ACT}"
DRAFT = r"(?iuU)entwurf|návrh|navrh|arbeitsdokument|pracovn[ýy] dokument|\bpwi\b|work item"
EDITION_ONLY, COMMITTEE = r"^[-–—]\s*\d{4}(\.\d{2}|-\d{2})?$", r"(?i)\b(CEN|CENELEC|ISO|IEC)/TC\b"
FRAGMENT, LOWER = r"^([-–—:]|\d+(-\d+)*\s*:)", r"^[a-záčďéěíňóřšťúůýž]"
LOWER_TITLES = r"(?iuU)^(zákon|vyhlášk|nařízení|nariaden|smernic|směrnic|usnesení|sdělení|vykonávacie|opatrenie)\w*\b"
LETTERS = {"regulation": "R", "directive": "L", "decision": "D"}
TYPE_LETTERS = {"Nařízení EU": "R", "Směrnice EU": "L", "Rozhodnutí EU": "D"}
TYPE_PATHS = {"Nařízení EU": "reg", "Směrnice EU": "dir", "Rozhodnutí EU": "dec"}
REASONS = ("značka není platné označení dokumentu", "název vypadá jako useknutý fragment textu", "chybí popis/anotace dokumentu")
DEFECTS = (*REASONS[:2], "autoritativní gestor")
EURLEX, CZECH_LAW, CELLAR = "https://eur-lex.europa.eu/legal-content/CS/TXT/?uri=CELEX:", "https://www.zakonyprolidi.cz/cs/", "http://publications.europa.eu/resource/"
FIRST_YEAR, LAST_YEAR = 1957, 2035
MONTHS = {
    "januára": "ledna", "februára": "února", "marca": "března", "apríla": "dubna", "mája": "května", "júna": "června",
    "júla": "července", "augusta": "srpna", "septembra": "září", "októbra": "října", "novembra": "listopadu", "decembra": "prosince",
}


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def _cat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _map(values: Mapping[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[key]


def earliest_pattern(c: Column, patterns: Mapping[str, str]) -> Column:
    """Label of the pattern that matches first in the text (ties: the first label by order); null if none does."""
    places = [F.struct(F.regexp_instr(c, F.lit(p)).alias("at"), F.lit(i).alias("rank"), F.lit(label).alias("label")) for i, (label, p) in enumerate(patterns.items())]
    return F.array_min(F.filter(F.array(*places), lambda x: x["at"] > 0))["label"]


def act_type(title: Column) -> Column:
    """Type of an act from its title; of an EU act the type named first; blank if none fits."""
    t = _text(title)
    rules = F.when(t == "", "").when(t.rlike(NORM_START), "Norma").when(t.rlike(EU_BODY), F.coalesce(earliest_pattern(t, EU_TYPES), F.lit("")))
    return rules.when(t.rlike(LAW), "Zákon").when(t.rlike(DECREE), "Vyhláška").when(t.rlike(ORDER), "Nařízení vlády").otherwise("")


def eu_subtype(title: Column, url: Column, jurisdiction: Column) -> Column:
    """delegated, implementing or null: by the address, else by what the title names first; EU acts only."""
    u = F.lower(_text(url))
    path = F.regexp_extract(u, r"/eli/(?:reg|dir|dec)_(del|impl)/", 1)
    words = earliest_pattern(_text(title), {"delegated": DELEGATED, "implementing": IMPLEMENTING})
    is_eu = (_text(jurisdiction) == "EU") | F.contains(u, F.lit("eur-lex.europa.eu"))
    return F.when(is_eu, F.when(path == "del", "delegated").when(path == "impl", "implementing").otherwise(words))


def lifecycle(validity: Column, is_current: Column) -> Column:
    return F.when(~is_current, "superseded").when(_text(validity).rlike(DRAFT), "draft").otherwise("active")


def is_garbled(designation: Column) -> Column:
    """No designation at all, but an edition's date or a committee."""
    d = _text(designation)
    return d.rlike(EDITION_ONLY) | d.rlike(COMMITTEE)


def is_fragment(title: Column) -> Column:
    """A continued line rather than a title."""
    t = _text(title)
    return (t != "") & (t.rlike(FRAGMENT) | (t.rlike(LOWER) & ~t.rlike(LOWER_TITLES)))


def review_reasons(designation: Column, title: Column, description: Column) -> Column:
    """Reasons for a review, joined; blank if there are none."""
    found = (is_garbled(designation), is_fragment(title), _text(description) == "")
    return F.array_join(F.array_compact(F.array(*[F.when(c, r) for c, r in zip(found, REASONS, strict=True)])), "; ")


def severity(needs_review: Column, reasons: Column, approximate: Column, description: Column) -> Column:
    """defect, approximate, incomplete, or null where no review is due."""
    defect = F.exists(F.array(*[F.lit(d) for d in DEFECTS]), lambda d: F.contains(_text(reasons), d))
    rough = (_text(approximate) != "") & (_text(description) == "")
    return F.when(F.coalesce(needs_review, F.lit(False)), F.when(defect, "defect").when(rough, "approximate").otherwise("incomplete"))


def with_reason(reasons: Column, reason: str) -> Column:
    parts = F.filter(F.split(_text(reasons), "; "), lambda x: x != "")
    return F.array_join(F.array_union(parts, F.array(F.lit(reason))), "; ")


def without_reason(reasons: Column, reason: str) -> Column:
    return F.array_join(F.array_remove(F.split(_text(reasons), "; "), reason), "; ")


def _year_number(key: Column) -> tuple[Column, Column]:
    p = r"^EU:(\d+)/(\d+)$"
    return F.regexp_extract(key, p, 1).try_cast("int"), F.regexp_extract(key, p, 2).try_cast("int")


def written(key: Column, kind: Column) -> Column:
    """Designation of a key as the catalogue writes it, so that it is read back as the same key."""
    y, n = _year_number(key)
    body = F.when(y >= 2010, "EU").when(y >= 1993, "ES").otherwise("EHS")
    rest = F.regexp_replace(key, "^[^:]*:", "")
    regulation = F.when(y >= 2015, _cat("(EU) ", y, "/", n)).otherwise(_cat("(", body, ") č. ", n, "/", y))
    eu = F.when(F.coalesce(kind, F.lit("")) == "regulation", regulation).otherwise(_cat(y, "/", n, "/", body))
    return F.when(key.startswith("CZ:"), _cat(rest, " Sb.")).when(key.startswith("EU:"), eu).otherwise(rest)


def celex(key: Column, kind: Column) -> Column:
    y, n = _year_number(key)
    return _cat("3", y, _map(LETTERS, kind), F.format_string("%04d", n))


def kind_of_celex(number: Column) -> Column:
    return _map({v: k for k, v in LETTERS.items()}, F.regexp_extract(F.coalesce(number, F.lit("")), r"^3\d{4}([RLD])\d{4}$", 1))


def address(key: Column, kind: Column) -> Column:
    """Where an act is read; null if its key names no page."""
    p = r"^CZ:(\d+)/(\d+)$"
    czech = _cat(CZECH_LAW, F.regexp_extract(key, p, 2), "-", F.regexp_extract(key, p, 1))
    return F.when(key.startswith("CZ:"), czech).otherwise(_cat(EURLEX, celex(key, kind)))


def celex_pairs(number: Column) -> Column:
    """Year and number of a CELEX number in both orders; empty if it is none."""
    p = r"^\d(\d{4})[A-Z](\d{4,})"
    y, n = F.regexp_extract(number, p, 1), F.regexp_replace(F.regexp_extract(number, p, 2), "^0+(?=.)", "")
    return F.when(F.coalesce(number, F.lit("")).rlike(p), F.array(_cat(y, "/", n), _cat(n, "/", y))).otherwise(F.array().cast("array<string>"))


def resource_candidates(text: Column, type_name: Column, eli: bool = False) -> Column:
    """Addresses under which an act of this designation and type may be stored, for each reading with a possible year."""
    p = r"(\d{2,4})\s*/\s*(\d{1,4})"
    a, b = (F.regexp_extract(_text(text), p, i).try_cast("int") for i in (1, 2))
    fits = lambda y: y.between(FIRST_YEAR, LAST_YEAR)
    code = _map(TYPE_PATHS if eli else TYPE_LETTERS, type_name)
    if eli:
        url = lambda y, n: _cat(CELLAR, "eli/", code, "/", y, "/", n, "/oj")
    else:
        url = lambda y, n: _cat(CELLAR, "celex/3", y, code, F.format_string("%04d", n))
    second = fits(b) if eli else fits(b) & (a != b)
    return F.array_compact(F.array(F.when(fits(a), url(a, b)), F.when(second, url(b, a))))


def era(year: Column) -> Column:
    """Suffix of the Community or Union in the year of an act."""
    return F.when(year < 1993, "EHS").when(year < 2009, "ES").otherwise("EU")


def full_years(text: Column) -> Column:
    """The first two-digit year of an old act's designation as 19yy, where it leads and where it ends a pair."""
    tail = r"/(?:EHS|ES|EEC|ECSC|Euratom))\b"
    t = F.coalesce(text, F.lit(""))
    lead, pair = rf"\b(\d{{2}})(/\d{{1,4}}{tail}", rf"\b(\d{{3,4}})(/)(\d{{2}})({tail[1:]}".replace("((?:", "(/(?:")
    once = lambda c, p, new: F.regexp_replace(c, rf"(?s)^(.*?){p}", new)
    t = once(t, lead, "$119$2$3")
    number = F.regexp_extract(t, pair, 1).try_cast("int")
    return F.when(number.between(FIRST_YEAR, LAST_YEAR), t).otherwise(once(t, pair, "$1$2$319$4$5"))


def czech_date(iso: Column) -> Column:
    """2026-07-01 as `1. 7. 2026`; null if it is no date."""
    p = r"^(\d{4})-(\d{2})-(\d{2})$"
    part = lambda i: F.regexp_extract(iso, p, i).try_cast("int")
    return _cat(part(3), ". ", part(2), ". ", part(1))


def issued(text: Column) -> Column:
    """M.YYYY as year and month, zeros where it is none; sorts by time."""
    p = r"^\s*(\d+)\s*\.\s*(\d+)\s*$"
    part = lambda i: F.coalesce(F.regexp_extract(F.coalesce(text, F.lit("")), p, i).try_cast("int"), F.lit(0))
    return F.struct(part(2).alias("year"), part(1).alias("month"))


def date_signal(text: Column) -> Column:
    """`D. month YYYY` in a citation with Slovak months in Czech; null if there is none."""
    p = r"(?iuU)\b(\d{1,2})\.\s*([a-záäčďéíľĺňóôŕšťúýž]+)\s*(\d{4})\b"
    part = lambda i: F.regexp_extract(F.coalesce(text, F.lit("")), p, i)
    month = F.lower(part(2))
    return F.when(part(3) != "", _cat(F.regexp_replace(part(1), "^0(?=.)", ""), ". ", F.coalesce(_map(MONTHS, month), month), " ", part(3)))


def later(stored: Column, found: Column) -> Column:
    """A date that never moves back (ISO texts)."""
    return F.greatest(stored, found)


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(F.coalesce(text, F.lit(""))) * 10 / 28) + 1


def comparison_faults(old_language: Column, language: Column, old_length: Column, length: Column, old_annexes: Column, annexes: Column, number_in_title: Column, similarity: Column, least: float = 0.97) -> Column:
    """What speaks against a text as another's replacement; empty if it is complete."""
    known = (F.coalesce(old_language, F.lit("")) != "") & (F.coalesce(language, F.lit("")) != "")
    tests = (
        ("language", known & (old_language != language)), ("shorter", (old_length > 0) & (length < old_length * least)), ("annexes", annexes < old_annexes),
        ("number", ~number_in_title), ("beginning", similarity < 0.8),
    )
    return F.array_compact(F.array(*[F.when(c, n) for n, c in tests]))


def joined_lines(before: Column, after: Column) -> Column:
    """Two lines as one run: a hyphen after a letter, before lower case, is dropped."""
    broken = before.rlike(r"(?U)\p{L}-$") & after.rlike(r"^\p{Ll}")
    return F.when(broken, F.concat(F.regexp_replace(before, "-$", ""), after)).otherwise(F.concat(before, F.lit(" "), after))


def file_name(designation: Column, sha256: Column, extension: str) -> Column:
    safe = F.regexp_replace(F.regexp_replace(_text(designation), "[^A-Za-z0-9._-]+", "_"), "^_+|_+$", "")
    return _cat(F.coalesce(F.nullif(safe, F.lit("")), F.lit("unnamed")), "__", F.left(sha256, F.lit(8)), f".{extension}")


def longest_prefix(c: Column, values: Mapping[str, str]) -> Column:
    """Value of the longest key that the text begins with; null if none does."""
    keys = sorted(values, key=lambda k: (-len(k), k))
    return F.coalesce(*[F.when(c.startswith(k), values[k]) for k in keys]) if keys else F.lit(None).cast("string")


def clean_name(names: Column, bad: str) -> Column:
    """The first name of an array that is not blank and does not match a pattern."""
    return F.get(F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: (x != "") & ~x.rlike(bad)), F.lit(0))


def shown_title(authoritative: Column, own: Column, other: Column) -> Column:
    return first_known(authoritative, own, other)
