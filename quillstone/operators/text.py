"""Operators on texts: citations, own keys, contexts, lines of pages, similarity of titles."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from difflib import SequenceMatcher
from functools import reduce
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of the families of citations, words that tell kinds and amendments, years that can be meant
YEARS = (1950, 2035)
BODIES = "EU|ES|EC|EÚ|EHS|EEC|ESUO|ECSC|Euratom"
CZ = r"(?<![\d/])(\d{1,4})\s*/\s*(\d{4})\s*Sb\.(\s*m\.\s*s\.)?"
SK = r"(?<![\d/])(\d{1,4})\s*/\s*(\d{4})\s*Z\.\s*z\."
EU_BRACKET = rf"\((?:{BODIES})\)\s*(č\.|No\.?|n\.)?\s*(\d{{1,4}})\s*/\s*(\d{{1,4}})(?![\d/])"
EU_SUFFIX = rf"(?<![\d/])(\d{{2,4}})/(\d{{1,4}})/(?:{BODIES})\b"
NORM = r"\b(?:(?:ČSN|CSN|STN|DIN|BS|NF)\s+)?((?:EN|ISO|IEC)(?:\s*/\s*(?:ISO|IEC))?(?:\s+(?:ISO|IEC))?)\s+(\d{3,5}(?:-\d{1,3}){0,3})\b"
EU_KIND = r"(nařízení|nariadenie|nariadenia|regulation|směrnice|směrnic|smernice|smernica|directive|rozhodnutí|rozhodnutie|decision)"
KINDS = {"nař": "regulation", "nari": "regulation", "regu": "regulation", "smě": "directive", "sme": "directive", "dire": "directive", "rozh": "decision", "deci": "decision"}
INTRODUCES = r"(?:ve znění|ve zneni|v znení|as amended by|změněn[ýé]?|změna:|novel|zavedeno zákonem|zavedena zákonem|zavedeny zákonem)[^;§]{0,200}$"
NUMBER = r"\d+\s*/\s*\d+(?:\s*Sb\.|\s*Z\.\s*z\.|/(?:ES|EU|EHS|EHK|ESUO|Euratom|EEC|ECSC|EC)\b)?"
KIND_REACH, PHRASE_REACH, LIST_REACH, NUMBER_REACH = 120, 220, 45, 80
BEFORE, AFTER, PLACES, TITLE_REACH = 300, 400, 3, 300

_WORDS = "(?U)"  # blanks, letters and bounds of all scripts
_ANY_CASE = "(?iuU)"


def _whole(c: Column) -> Column:
    return c.try_cast("int").cast("string")


def _usable(year: Column) -> Column:
    """Whether the digits can be a year: two of them, or four in the range."""
    return (F.length(year) == 2) | ((F.length(year) == 4) & year.try_cast("int").between(*YEARS))


def _act(number: Column, year: Column, suffix: str) -> Column:
    return F.concat(_whole(number), F.lit("/"), _whole(year), F.lit(suffix))


def _eu(year: Column, number: Column) -> Column:
    full = year.try_cast("int") + F.when(F.length(year) == 2, 1900).otherwise(0)
    return F.when(_usable(year), F.concat(full.cast("string"), F.lit("/"), _whole(number)))


def _eu_bracket(label: Column, first: Column, second: Column) -> Column:
    """Of a bare pair the year comes first if it can be one; behind a label it never does."""
    leads = (label == "") & _usable(first)
    return F.when(leads, _eu(first, second)).otherwise(_eu(second, first))


def _norm(body: Column, number: Column) -> Column:
    return F.concat_ws(" ", F.regexp_replace(F.regexp_replace(body, " ?/ ?", "/"), _WORDS + r"\s+", " "), number)


@dataclass(frozen=True)
class Family:
    """How one family is cited: its pattern, what a match is called (null: it is none), and whether acts have a kind.

    Every match holds one of `needs`: a text without them is not searched. Patterns get a look at a match's first sign put
    before them, which changes no match and passes over other signs at once.
    """

    name: str
    pattern: str
    groups: int
    needs: tuple[str, ...]
    display: Callable[..., Column]
    accepts: Callable[..., Column] | None = None
    suffix: str = ""
    kinds: bool = False


FAMILIES = (
    Family("CZ", _WORDS + r"(?=\d)" + CZ, 3, ("Sb.",), lambda n, y, s: _act(n, y, " Sb."), lambda n, y, s: s == "", " Sb."),
    Family("CZ-MS", _WORDS + r"(?=\d)" + CZ, 3, ("Sb.",), lambda n, y, s: _act(n, y, " Sb. m. s."), lambda n, y, s: s != "", " Sb. m. s."),
    Family("SK", _WORDS + r"(?=\d)" + SK, 2, ("Z.",), lambda n, y: _act(n, y, " Z. z."), None, " Z. z."),
    Family("EU", _ANY_CASE + EU_BRACKET, 3, ("(",), _eu_bracket, kinds=True),
    Family("EU", _ANY_CASE + r"(?=\d)" + EU_SUFFIX, 2, ("/",), _eu, kinds=True),
    Family("NORM", _WORDS + "(?=[ČCSDBNEI])" + NORM, 2, ("EN", "ISO", "IEC"), _norm),
)


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value worked out once; written out, it is worked out again wherever it stands, in lambdas for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _starts(gaps: Column, found: Column) -> Column:
    """Place (from 0) of each match, as a running sum over the texts between matches and the matches."""
    steps = F.slice(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("own"))), F.lit(1), F.size(found))
    grown = F.aggregate(
        steps, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")),
        lambda acc, x: F.struct((acc["at"] + x["gap"] + x["own"]).alias("at"), F.concat(acc["starts"], F.array(acc["at"] + x["gap"])).alias("starts")),
    )
    return grown["starts"]


def _behind(text: Column, at: Column, reach: int) -> Column:
    """The last `reach` characters before a place."""
    low = F.greatest(at - reach, F.lit(0))
    return F.substr(text, low + 1, at - low)


def _kind(text: Column, at: Column) -> Column:
    words = F.regexp_extract_all(_behind(text, at, KIND_REACH), F.lit(_ANY_CASE + EU_KIND), F.lit(1))
    return _bound(F.lower(F.try_element_at(words, F.lit(-1))), lambda last: F.coalesce(*[F.when(last.startswith(p), k) for p, k in KINDS.items()]))


def _hits(text: Column, pattern: str, needs: Sequence[str]) -> Column:
    """at, own of the matches of a pattern; texts without any are not split."""
    some = reduce(Column.__or__, [F.contains(text, F.lit(w)) for w in needs])

    def placed(found: Column) -> Column:
        starts = _starts(F.split(text, pattern, -1), found)
        return F.when(F.size(found) > 0, F.zip_with(starts, found, lambda at, own: F.struct(at.alias("at"), own.alias("own")))).otherwise(F.array().cast("array<struct<at:int,own:string>>"))

    return _bound(F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")), placed)


def _of_family(text: Column, family: Family, hits: Column) -> Column:
    # A match alone has the groups that it has in the text: the patterns look around it at its ends only
    rows = F.transform(hits, lambda x: F.struct(x["at"].alias("at"), *[F.regexp_extract(x["own"], family.pattern, i + 1).alias(f"g{i}") for i in range(family.groups)]))

    def shown(x: Column) -> Column:
        parts = [x[f"g{i}"] for i in range(family.groups)]
        display = family.display(*parts)
        if family.accepts is not None:
            display = F.when(family.accepts(*parts), display)
        return F.struct(x["at"].alias("at"), display.alias("display"))

    def named(x: Column) -> Column:
        display = x["display"]
        bare = F.substr(display, F.lit(1), F.length(display) - len(family.suffix)) if family.suffix else display
        kind = _kind(text, x["at"]) if family.kinds else F.lit(None).cast("string")
        amendment = _behind(text, x["at"], PHRASE_REACH).rlike(_ANY_CASE + INTRODUCES)
        return F.struct(
            x["at"].alias("position"), F.concat(F.lit(f"{family.name}:"), bare).alias("key"), F.lit(family.name).alias("family"),
            display.alias("display"), kind.alias("kind"), amendment.alias("amendment"),
        )

    return F.transform(F.filter(F.transform(rows, shown), lambda x: x["display"].isNotNull()), named)


def citations(text: Column) -> Column:
    """position, key, family, display, kind, amendment of a text's citations in the order of their places; null has none.

    amendment: a phrase that introduces amending acts stands before the citation, in the same clause.
    """
    needs = {f.pattern: f.needs for f in FAMILIES}
    patterns = list(needs)

    def found(t: Column) -> Column:
        hits = F.struct(*[_hits(t, p, needs[p]).alias(f"h{i}") for i, p in enumerate(patterns)])
        return _bound(hits, lambda h: F.array_sort(F.concat(*[_of_family(t, f, h[f"h{patterns.index(f.pattern)}"]) for f in FAMILIES])))

    return _bound(F.coalesce(text, F.lit("")), found)


def listed_amendments(text: Column, cited: Column) -> Column:
    """Whether each citation amends, by its own phrase or as the next of a list: close behind one that does, in one clause."""
    start = F.struct(F.lit(None).cast("int").alias("at"), F.lit(False).alias("flag"), F.array().cast("array<boolean>").alias("flags"))

    def step(acc: Column, c: Column) -> Column:
        near = acc["flag"] & (c["position"] - acc["at"] < LIST_REACH)
        apart = F.substr(F.coalesce(text, F.lit("")), acc["at"] + 1, c["position"] - acc["at"]).rlike("[;§]")
        flag = c["amendment"] | F.coalesce(near & ~apart, F.lit(False))
        return F.struct(c["position"].alias("at"), flag.alias("flag"), F.concat(acc["flags"], F.array(flag)).alias("flags"))

    return F.aggregate(cited, start, step)["flags"]


def keys_of(cited: Column) -> Column:
    return F.array_distinct(F.transform(cited, lambda c: c["key"]))


def own_keys(designation: Column, title: Column) -> Column:
    """Keys that a document goes by. Its designation says them in full, or as a bare pair, which is a Czech act; without a
    designation it is the first act that its title names."""
    named = F.coalesce(designation, F.lit(""))
    pair = r"(?<![\d/])0*(\d{1,4})/(\d{4})(?![\d/])"
    act = F.concat(F.lit("CZ:"), F.regexp_extract(named, pair, 1), F.lit("/"), F.regexp_extract(named, pair, 2))
    by_title = F.slice(keys_of(citations(F.left(title, F.lit(TITLE_REACH)))), 1, 1)
    by_name = keys_of(citations(named))
    return F.when(named == "", by_title).when((F.size(by_name) == 0) & named.rlike(pair), F.array(act)).otherwise(by_name)


def citing_unit(keys: Column, doc: Column) -> Column:
    """What cites: a document and its language variants share their least key; one without keys is a unit of its own."""
    return F.coalesce(F.array_min(keys), F.concat(F.lit("doc:"), doc.cast("string")))


def context(text: Column, at: Column) -> Column:
    """before, cited, after of a place: whole words around the number that the text writes there, blanks squeezed."""
    squeezed = lambda c: F.regexp_replace(c, _WORDS + r"\s+", " ")

    def cut(x: Column) -> Column:
        left, right = x["left"], x["right"]
        whole_left = F.when(at <= BEFORE, left).otherwise(F.when(left.rlike(_WORDS + r"\s"), F.regexp_replace(left, _WORDS + r"(?s)^\S*\s", "")).otherwise(""))
        ends_here = at + AFTER >= F.length(text)
        whole_right = F.when(ends_here, right).otherwise(F.regexp_replace(right, r"(?s)^(.+) [^ ]*$", "$1"))
        cited = F.regexp_extract(F.left(right, F.lit(NUMBER_REACH)), rf"{_WORDS}(?s)^.*?{NUMBER}", 0)
        return F.struct(
            F.ltrim(squeezed(whole_left)).alias("before"), squeezed(cited).alias("cited"),
            F.rtrim(squeezed(F.substr(whole_right, F.length(cited) + 1))).alias("after"),
        )

    return _bound(F.struct(_behind(text, at, BEFORE).alias("left"), F.substr(text, at + 1, F.lit(AFTER)).alias("right")), cut)


def contexts(text: Column, most: int = PLACES) -> Column:
    """key, place, amendment and context of the first `most` citations of each key, by key and place."""

    def placed(t: Column, cited: Column) -> Column:
        same = lambda c, i, back: F.coalesce(F.get(cited, i - back)["key"] == c["key"], F.lit(False))
        place = lambda c, i: sum((F.when(same(c, i, b), 1).otherwise(0) for b in range(1, most + 1)), F.lit(1))
        rows = F.transform(cited, lambda c, i: F.struct(c["key"].alias("key"), place(c, i).alias("place"), c["amendment"].alias("amendment"), c["position"].alias("position")))
        first = F.filter(rows, lambda c: c["place"] <= most)
        around = F.transform(first, lambda c: F.struct(c["key"].alias("key"), c["place"].alias("place"), c["amendment"].alias("amendment"), context(t, c["position"]).alias("w")))
        return F.transform(around, lambda c: F.struct(c["key"], c["place"], c["amendment"], *[c["w"][k].alias(k) for k in ("before", "cited", "after")]))

    def found(t: Column) -> Column:
        by_key = F.array_sort(F.transform(citations(t), lambda c: F.struct(c["key"].alias("key"), c["position"].alias("position"), c["amendment"].alias("amendment"))))
        return _bound(by_key, lambda cited: placed(t, cited))

    return _bound(F.coalesce(text, F.lit("")), found)


def hint(text: Column, at: Column) -> Column:
    c = context(text, at)
    return F.concat(c["before"], c["cited"], c["after"])


# Elements of pages that end a line, that hold no text, and that are headings
BLOCKS = frozenset("address article aside blockquote body dd div dl dt fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table tbody tfoot thead tr ul br title".split())
SILENT = frozenset("script style noscript template head".split())


class _Lines(HTMLParser):
    """Lines of a page: a block is a line, a row of a table is one line of cells joined by a bar."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[str] = []
        self.text: list[str] = []
        self.rows: list[list[str]] = []  # open rows, the innermost last
        self.silent = 0

    def flush(self) -> None:
        line = re.sub(r"\s+", " ", "".join(self.text)).strip()
        self.text.clear()
        if not line:
            return
        if self.rows:
            cells = self.rows[-1]
            if cells:
                cells[-1] = f"{cells[-1]}; {line}" if cells[-1] else line
            else:
                cells.append(line)
        else:
            self.lines.append(line)

    def handle_starttag(self, tag, attrs) -> None:
        if tag in SILENT:
            self.silent += 1
        elif tag in ("td", "th"):
            self.flush()
            if self.rows:
                self.rows[-1].append("")
        elif tag in BLOCKS:
            self.flush()
            if tag == "tr":
                self.rows.append([])

    def handle_endtag(self, tag) -> None:
        if tag in SILENT:
            self.silent = max(0, self.silent - 1)
        elif tag in BLOCKS or tag in ("td", "th"):
            self.flush()
            if tag == "tr" and self.rows:
                self.end_row()

    def end_row(self) -> None:
        cells = self.rows.pop()
        if any(cells):
            self.text.append(" | ".join(cells))
            self.flush()

    def handle_data(self, data) -> None:
        if not self.silent:
            self.text.append(data)

    def result(self) -> str:
        self.close()
        self.flush()
        while self.rows:
            self.end_row()
        return "\n".join(self.lines)


def page_lines(page: str | None) -> str:
    parser = _Lines()
    parser.feed(page or "")
    return parser.result()


def html_lines(html: Column) -> Column:
    """Text of a page, one block a line, rows of tables as `cell | cell`; scripts, styles and the head give none."""

    def run(pages: pd.Series) -> pd.Series:
        return pages.map(page_lines)

    return F.pandas_udf(run, "string")(html)


def title_similarity(a: Column, b: Column, chars: int = 400) -> Column:
    """Ratio of matching blocks of two texts' first characters (0 to 1, two decimals), case and blanks aside; null is blank."""

    def norm(t: str | None) -> str:
        return re.sub(r"\s+", " ", t or "").strip().lower()[:chars]

    def run(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([round(SequenceMatcher(None, norm(x), norm(y)).ratio(), 2) for x, y in zip(left, right, strict=True)])

    return F.pandas_udf(run, "double")(a, b)


def query_form(c: Column) -> Column:
    """Composed letters, plain blanks squeezed, case folded: the form in which search words are compared."""

    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: re.sub(r"\s+", " ", unicodedata.normalize("NFC", t or "").replace("\xa0", " ")).strip().casefold())

    return F.pandas_udf(run, "string")(c)
