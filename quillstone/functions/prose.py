"""Column functions on titles, prose and page texts: designations in titles, references in prose, dated news, languages."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns and words of the catalogue
EDITION = r"\s*/?\s*[-–—]\s*(19|20)\d{2}(\.\d{2})?\s*$"
CZECH_LETTERS = r"(?iu)[áčďéěíňóřšťúůýž]"
HYDROGEN = r"(?iu)vodík|vodíkov|hydrogen|wasserstoff|rfnbo|nebiologického původu|non-biological origin|palivov\w* článk|fuel[ -]cell|\bH2\b"
ANNEX = r"(?ium)^\s*(PŘÍLOHA|PRÍLOHA|ANNEX|ANHANG|ANNEXE)(\s+[IVXLC\d]+[a-z]?)?\s*\.?\s*$"
CSN, STN, INTERNATIONAL, IEC_ONLY = r"(?iu)^(ČSN|CSN)\s+", r"(?i)^(STN|TNI)\b", r"(?i)^(EN|ISO|IEC)\b", r"(?i)^(pr\s*EN\s+)?IEC\b"
BARE_ISO_IEC = r"(?i)^(?:ISO|IEC)(?:/[A-Z]+)?\s+\d"
BARE_EN_ISO, BARE_EN = r"(?i)^(?:pr|F\s*pr)?EN\s+(?:ISO|IEC)(?:/[A-Z]+)?\s+\d", r"(?i)^(?:pr|F\s*pr)?EN\s+\d"
PROSE = (
    r"(?iu)(?:zákon|vyhlášk[ay]|nařízení vlády)\s+č\.\s*(\d+/\d{4})\s*Sb\.",
    r"\(\s*(?:ES|EU|EÚ)\s*\)\s*(?:č\.\s*)?(\d+/\d{4})",
    r"(?U)\b(?:ES|EU|EÚ)\s+č\.\s*(\d+/\d{4})\b",
    r"(?U)\bč\.\s*(\d+/\d{4})\s*\([A-ZÁ-Ž]+\)",
    r"(\d{4}/\d+/(?:ES|EU|EÚ))",
    r"(ČSN(?:\s+EN)?(?:\s+ISO)?\s+[\d\s]+(?:-\d+)?)(?::\d{4})?",
    r"(?U)\b(EN\s+ISO\s+\d+)\b",
    r"(?U)(?<!ČSN )(?<!STN )\b(EN\s+\d{4,5})(?::\d{4})?\b",
)
INSTALLATIONS = {"ELEKTROLYZA": "elektrolý", "SKLADOVANI": "sklad", "VCS": "čerpací", "VOZIDLA": "vozidl"}
LANGUAGE_OF_ADDRESS = r"eur-lex\.europa\.eu/legal-content/([A-Z]{2})/"
HOSTS = {"zakonyprolidi.cz": "zakonyprolidi", "eur-lex.europa.eu": "eurlex", "slov-lex.sk": "slovlex"}
NORM_TYPE, SEPARATOR = "Norma", " — "


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def designation_core(designation: Column) -> Column:
    """The designation without an edition's date at its end."""
    return F.trim(F.regexp_replace(F.coalesce(designation, F.lit("")), EDITION, ""))


def is_real_designation(designation: Column) -> Column:
    """Designations have a digit."""
    return _text(designation).rlike(r"\d")


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with the value computed once."""
    return F.transform(F.array(value), then)[0]


def _without(title: Column, core: Column) -> Column:
    """The title without its designation at the end (bare, or in brackets with a year) or at the beginning.

    The designation is a value, not a pattern, so the ends are compared as texts.
    """

    def cut(x: Column) -> Column:
        t, n = x["title"], F.length(x["core"])
        head = F.left(t, F.length(t) - n)
        inside = F.rtrim(F.left(x["inner"], F.length(x["inner"]) - n))
        clean = lambda c: F.regexp_replace(c, r"[\s.,\-–—:]+$", "")
        in_brackets = (x["inner"] != t) & F.lower(x["inner"]).endswith(F.lower(x["core"])) & inside.endswith("(")
        at_end = F.lower(t).endswith(F.lower(x["core"])) & head.rlike(r"[\s.,\-–—:]$") & (clean(head) != "")
        at_start = F.lower(t).startswith(F.lower(x["core"]))
        rest = F.trim(F.regexp_replace(F.substr(t, n + 1), r"^[\s.,\-–—:]+", ""))
        outside = F.regexp_replace(F.left(inside, F.length(inside) - 1), r"[ .,\-–—]+$", "")
        return F.when(in_brackets, outside).when(at_end, clean(head)).when(at_start, rest).otherwise(t)

    inner = F.regexp_replace(title, r"\s*(:\s*\d{4})?\s*\)\s*$", "")
    return _let(F.struct(title.alias("title"), core.alias("core"), inner.alias("inner")), cut)


def norm_title(title: Column, designation: Column) -> Column:
    """`designation — title`, the designation once; the title as it is where there is no designation."""

    def shown(x: Column) -> Column:
        own = _let(_without(x["title"], x["core"]), lambda c: F.when(c == "", x["title"]).otherwise(c))
        return F.when(x["core"].rlike(r"\d"), F.concat(x["core"], F.lit(SEPARATOR), own)).otherwise(x["title"])

    d = _text(designation)
    core = F.coalesce(F.nullif(designation_core(d), F.lit("")), d)
    return _let(F.struct(_text(title).alias("title"), F.when(is_real_designation(d), core).otherwise("").alias("core")), shown)


def first_address(c: Column) -> Column:
    """The first of several addresses in one cell; blank if there is none."""
    return F.coalesce(F.regexp_extract(F.coalesce(c, F.lit("")), r"(?U)(\S+)", 1), F.lit(""))


def filed_under(designation: Column, address: Column, title: Column) -> Column:
    """The designation, else one made of the address, else of the title; blank without any."""
    short = lambda prefix, c: F.concat(F.lit(prefix), F.left(F.sha2(c, 256), F.lit(8)))
    url, words = first_address(address), F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)\s+", " "))
    return F.when(_text(designation) != "", _text(designation)).when(url != "", short("url-", url)).when(words != "", short("title-", words)).otherwise("")


def row_language(address: Column, raw: Column, codes: Mapping[str, str]) -> Column:
    """The language in the address of an act, else that of a table of names."""
    found = F.regexp_extract(F.coalesce(address, F.lit("")), LANGUAGE_OF_ADDRESS, 1)
    names = F.create_map(*[F.lit(x) for kv in codes.items() for x in kv])
    return F.when(found.isin("CS", "EN"), found).otherwise(names[F.lower(_text(raw))])


def guessed_language(title: Column) -> Column:
    return F.when(F.coalesce(title, F.lit("")).rlike(CZECH_LETTERS), "CS").otherwise("EN")


def guessed_jurisdiction(key: Column, designation: Column) -> Column:
    begins = lambda c, *ps: reduce(Column.__or__, [F.coalesce(c, F.lit("")).startswith(p) for p in ps])
    czech = begins(key, "CZ:", "DRAFT-CZ:", "DRAFT-NORM:CZ:") | begins(designation, "ČSN", "TPG")
    return F.when(czech, "CZ").when(begins(key, "EU:", "DRAFT-EU:"), "EU").when(begins(key, "NORM:", "DRAFT-NORM:"), "mezinárodní")


def listed_jurisdiction(designation: Column) -> Column:
    """Of a list of national adoptions: bare international and European designations are no adoptions."""
    d = _text(designation)
    return F.when(d.rlike(BARE_ISO_IEC), "mezinárodní").when(d.rlike(BARE_EN_ISO) | d.rlike(BARE_EN), "EU").otherwise("CZ")


def looked_up_in(kind: Column, designation: Column, address: Column) -> Column:
    """Registries that a record can be looked up in: law for all but norms; csn, stn, iec by designation, dvgw, eiga by address."""
    norm, d, url = _text(kind) == NORM_TYPE, _text(designation), F.coalesce(address, F.lit(""))
    tests = (
        ("law", ~norm), ("csn", norm & (d.rlike(CSN) | d.rlike(INTERNATIONAL))), ("stn", norm & d.rlike(STN)), ("iec", norm & d.rlike(IEC_ONLY)),
        ("dvgw", norm & F.contains(url, F.lit("dvgw.de"))), ("eiga", norm & F.contains(url, F.lit("eiga.eu"))),
    )
    return F.array_compact(F.array(*[F.when(c, n) for n, c in tests]))


def names_hydrogen(texts: Column) -> Column:
    """Whether any of an array of texts names hydrogen."""
    return F.exists(texts, lambda t: F.coalesce(t, F.lit("")).rlike(HYDROGEN))


def in_effect(end: Column, today: Column) -> Column:
    """No end, an end without a year, or one that is not past (ISO texts)."""
    e = F.coalesce(end, F.lit(""))
    return (e == "") | e.startswith("0000") | (F.left(e, F.lit(10)) >= today)


def first_pattern(c: Column, patterns: Sequence[str]) -> Column:
    """The first of the patterns, in their order, that the text matches, case aside; null if none does."""
    return F.coalesce(*[F.when(F.coalesce(c, F.lit("")).rlike(f"(?iuU){p}"), p) for p in patterns])


def source_of(address: Column) -> Column:
    """The site whose pages the engine reads, by host; null for others."""
    host = F.lower(F.parse_url(address, F.lit("HOST")))
    return F.coalesce(*[F.when(host.endswith(h), name) for h, name in HOSTS.items()])


def prose_citations(text: Column) -> Column:
    """References in prose, pattern by pattern."""
    return F.flatten(F.array(*[F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(p), F.lit(1)), lambda x: F.trim(x)) for p in PROSE]))


def bracket_refs(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"\[(\d+)\]"), F.lit(1)), lambda x: x.cast("int"))


def edge_target(text: Column) -> Column:
    return F.nullif(F.regexp_extract(F.coalesce(text, F.lit("")), r"(?U)\bU\d\b", 0), F.lit(""))


def problem(text: Column) -> Column:
    """title (before the first dash; null without one) and text of an entry."""
    t = _text(text)
    p = r"^(.+?)\s*[—–]\s*(.+)$"
    return F.struct(F.when(t.rlike(p), F.trim(F.regexp_extract(t, p, 1))).alias("title"), t.alias("text"))


def subject(text: Column) -> Column:
    """name and abbreviation (null without one) of a person or body."""
    t = _text(text)
    return F.struct(t.alias("name"), F.nullif(F.regexp_extract(t, r"^([A-ZÁ-Ž0-9]{2,10})\s*\(", 1), F.lit("")).alias("abbreviation"))


def bibliography(text: Column) -> Column:
    """number and citation of a line `[n] …`; null for other lines."""
    p = r"^\[(\d+)\]\s*(.+)$"
    t = _text(text)
    return F.when(t.rlike(p), F.struct(F.regexp_extract(t, p, 1).cast("int").alias("number"), F.regexp_extract(t, p, 2).alias("citation")))


def installation(text: Column) -> Column:
    t = F.lower(_text(text))
    return F.coalesce(*[F.when(F.contains(t, F.lit(w)), code) for code, w in INSTALLATIONS.items()])


def aligned(titles: Column, addresses: Column) -> Column:
    """Pairs of two lists kept as lines; null where their lengths differ."""
    a, b = (F.split(F.coalesce(c, F.lit("")), "\n") for c in (titles, addresses))
    return F.when(F.size(a) == F.size(b), F.zip_with(a, b, lambda x, y: F.struct(x.alias("title"), y.alias("url"))))


def parts_of_row(designations: Column, titles: Column, part_line: str) -> Column:
    """(designation, title) of each part of a row whose cells hold several lines; one more title that is no part's line goes
    before all. Null where the row is no such row."""
    lines = lambda c: F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: F.trim(x)), lambda x: x != "")
    d, t = lines(designations), lines(titles)
    shared = (F.size(t) == F.size(d) + 1) & ~F.coalesce(F.get(t, F.lit(0)).rlike(part_line), F.lit(False))
    own = F.when(shared, F.transform(F.slice(t, F.lit(2), F.greatest(F.size(t) - 1, F.lit(0))), lambda x: F.concat(F.get(t, F.lit(0)), F.lit(" "), x))).otherwise(t)
    return F.when((F.size(d) > 1) & (F.size(own) == F.size(d)), F.zip_with(d, own, lambda x, y: F.struct(x.alias("designation"), y.alias("title"))))


def keyword_areas(text: Column, words: Mapping[int, Sequence[str]]) -> Column:
    """Numbers of the areas one of whose words the text holds, in order."""
    t = F.lower(F.coalesce(text, F.lit("")))
    hit = lambda ws: reduce(Column.__or__, [F.contains(t, F.lit(w.lower())) for w in ws], F.lit(False))
    return F.array_compact(F.array(*[F.when(hit(ws), area) for area, ws in sorted(words.items())]))


def annex_count(text: Column) -> Column:
    return F.size(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ANNEX), F.lit(0)))


def number_in_title(celex: Column, text: Column, chars: int = 1500) -> Column:
    """Whether the number of an act stands at the beginning of its text, in either order; true where it has no fixed form."""
    p = r"^3(\d{4})[A-Z]+0*(\d+)"
    c = F.coalesce(celex, F.lit(""))
    y, n = F.regexp_extract(c, p, 1), F.regexp_extract(c, p, 2)
    head = F.regexp_replace(F.left(F.coalesce(text, F.lit("")), F.lit(chars)), r"(?U)\s+", " ")
    short = F.substr(y, F.lit(3))
    forms = [F.concat(a, F.lit("/"), b) for a, b in ((y, n), (n, y), (short, n), (n, short))]
    return ~c.rlike(p) | reduce(Column.__or__, [F.contains(head, f) for f in forms])


def _iso(day: Column, month: Column, year: Column) -> Column:
    return F.format_string("%04d-%02d-%02d", year.cast("int"), month.cast("int"), day.cast("int"))


def feed_date(text: Column) -> Column:
    """ISO date of a feed's date: `Wed, 04 Nov 2026 07:38:00 GMT`, or month/day/year somewhere in the text."""
    t = F.coalesce(text, F.lit(""))
    mail = r"(?i)\b(\d{1,2}) (jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]* (\d{4})\b"
    names = F.create_map(*[F.lit(x) for i, m in enumerate("jan feb mar apr may jun jul aug sep oct nov dec".split()) for x in (m, i + 1)])
    slashed = r"(\d{1,2})/(\d{1,2})/(\d{4})"
    by_name = _iso(F.regexp_extract(t, mail, 1), names[F.lower(F.regexp_extract(t, mail, 2))], F.regexp_extract(t, mail, 3))
    by_slash = _iso(F.regexp_extract(t, slashed, 2), F.regexp_extract(t, slashed, 1), F.regexp_extract(t, slashed, 3))
    return F.when(t.rlike(mail), by_name).when(t.rlike(slashed), by_slash)


def dated_blocks(page: Column, after: str = "Aktuality:") -> Column:
    """(date, text) of news that runs of hard blanks part and that begin with their date."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(page, F.lit("")), r"(?s)<(script|style|nav).*?</\1>", " "), "<[^>]+>", " ")
    rest = F.when(F.contains(bare, F.lit(after)), F.regexp_replace(bare, rf"(?s)^.*?{after}", "")).otherwise(bare)
    blocks = F.transform(F.split(rest, r"(?:&nbsp;|\x{A0})(?:\s|&nbsp;|\x{A0})*"), lambda b: F.trim(F.regexp_replace(b, r"\s+", " ")))
    p = r"^(\d{1,2})\.(\d{1,2})\.(20\d\d)\s*(?:-\s*)?(.+)$"
    part = lambda b, i: F.regexp_extract(b, p, i)
    return F.transform(F.filter(blocks, lambda b: b.rlike(p)), lambda b: F.struct(_iso(part(b, 1), part(b, 2), part(b, 3)).alias("date"), part(b, 4).alias("text")))


def table_rows(page: Column, reference: str, at: int = 1) -> Column:
    """Cells of the rows of a page's tables whose cell `at` matches a pattern, as text."""
    rows = F.regexp_extract_all(F.coalesce(page, F.lit("")), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), F.lit(1))
    plain = lambda c: F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]+>", " "), r"\s+", " "))
    cells = F.transform(rows, lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(?s)<td[^>]*>(.*?)</td>"), F.lit(1)), plain))
    return F.filter(cells, lambda c: F.coalesce(F.get(c, F.lit(at)).rlike(reference), F.lit(False)))


def token_probability(tokens: Column, mark: str = r'"recommendation"\s*:\s*"') -> Column:
    """Probability of the token that stands right behind a mark; tokens: array of (token, logprob). Null if there is none."""
    text = F.array_join(F.transform(tokens, lambda t: t["token"]), "")
    behind = F.when(text.rlike(mark), F.length(F.regexp_extract(text, rf"(?s)^.*?{mark}", 0)))
    start = F.struct(F.lit(0).alias("at"), F.lit(None).cast("double").alias("p"))

    def step(acc: Column, t: Column) -> Column:
        end = acc["at"] + F.length(t["token"])
        here = (acc["at"] <= behind) & (behind < end)
        return F.struct(end.alias("at"), F.coalesce(acc["p"], F.when(here, F.exp(t["logprob"]))).alias("p"))

    return F.aggregate(tokens, start, step)["p"]


def confidence(own: Column, measured: Column) -> Column:
    """The lower of the two that are known."""
    return F.least(own, measured)
