"""Column functions on issuing bodies, jurisdictions and designations that stand in titles. Null counts as blank."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quillstone.functions.designation import first_known, squeeze
from quillstone.functions.prose import designation_core

# Issuing bodies by the first word of a designation
SLOVAK = "Úrad pre normalizáciu, metrológiu a skúšobníctvo SR (ÚNMS SR)"
CZECH = "Česká agentura pro standardizaci (ČAS)"
BODIES = {
    "STN": SLOVAK,
    "TNI": SLOVAK,
    "ČSN": CZECH,
    "DIN": "Deutsches Institut für Normung (DIN)",
    "BS": "British Standards Institution (BSI)",
    "AFNOR": "Association française de normalisation (AFNOR)",
    "ISO": "International Organization for Standardization (ISO)",
    "ISO/AWI": "International Organization for Standardization (ISO)",
    "ISO/CD": "International Organization for Standardization (ISO)",
    "ISO/DIS": "International Organization for Standardization (ISO)",
    "ISO/FDIS": "International Organization for Standardization (ISO)",
    "ISO/PWI": "International Organization for Standardization (ISO)",
    "ISO/TR": "International Organization for Standardization (ISO)",
    "ISO/TS": "International Organization for Standardization (ISO)",
    "ISO/WD": "International Organization for Standardization (ISO)",
    "IEC": "International Electrotechnical Commission (IEC)",
    "IEC/TR": "International Electrotechnical Commission (IEC)",
    "IEC/TS": "International Electrotechnical Commission (IEC)",
    "EN": "Evropský výbor pro normalizaci (CEN/CENELEC)",
    "prEN": "Evropský výbor pro normalizaci (CEN/CENELEC)",
    "FprEN": "Evropský výbor pro normalizaci (CEN/CENELEC)",
    "CEN/TS": "Evropský výbor pro normalizaci (CEN/CENELEC)",
    "CEN/CLC/JTC": "Evropský výbor pro normalizaci (CEN/CENELEC)",
    "OIML": "International Organization of Legal Metrology (OIML)",
    "IMO": "International Maritime Organization (IMO)",
    "IGF": "International Maritime Organization (IMO)",
    "MSC.420(97)": "International Maritime Organization (IMO)",
    "MSC.1/Circ.1647": "International Maritime Organization (IMO)",
    "ES-TRIN": "Evropský výbor pro vypracování norem v oblasti vnitrozemské plavby (CESNI)",
    "G": "Deutscher Verein des Gas- und Wasserfaches (DVGW)",
    "GW": "Deutscher Verein des Gas- und Wasserfaches (DVGW)",
    "C": "Deutscher Verein des Gas- und Wasserfaches (DVGW)",
    "ZP": "Deutscher Verein des Gas- und Wasserfaches (DVGW)",
    "G269": "Deutscher Verein des Gas- und Wasserfaches (DVGW)",
    "Gas-Information": "Deutscher Verein des Gas- und Wasserfaches (DVGW)",
    "Gas": "Deutscher Verein des Gas- und Wasserfaches (DVGW)",
    "VDI": "Verein Deutscher Ingenieure (VDI)",
    "VDI/VDE": "Verein Deutscher Ingenieure (VDI)",
    "VDE-AR-N": "VDE Verband der Elektrotechnik Elektronik Informationstechnik (VDE)",
    "VDA": "Verband der Automobilindustrie (VDA)",
    "PTB": "Physikalisch-Technische Bundesanstalt (PTB)",
    "PTB-A": "Physikalisch-Technische Bundesanstalt (PTB)",
    "DGUV": "Deutsche Gesetzliche Unfallversicherung (DGUV)",
    "DASt": "Deutscher Ausschuss für Stahlbau (DASt)",
    "DWA-M": "Deutsche Vereinigung für Wasserwirtschaft, Abwasser und Abfall (DWA)",
    "AD": "Arbeitsgemeinschaft Druckbehälter (AD)",
    "AD-Merkblatt": "Arbeitsgemeinschaft Druckbehälter (AD)",
    "TRGS": "Bundesanstalt für Arbeitsschutz und Arbeitsmedizin (BAuA)",
    "TRBS": "Bundesanstalt für Arbeitsschutz und Arbeitsmedizin (BAuA)",
    "TRB": "Bundesanstalt für Arbeitsschutz und Arbeitsmedizin (BAuA)",
    "TRG16": "Bundesanstalt für Arbeitsschutz und Arbeitsmedizin (BAuA)",
    "TRG19": "Bundesanstalt für Arbeitsschutz und Arbeitsmedizin (BAuA)",
    "EIGA": "European Industrial Gases Association (EIGA)",
    "IGC": "European Industrial Gases Association (EIGA)",
    "Doc": "European Industrial Gases Association (EIGA)",
    "ASTM": "ASTM International",
    "ASME": "American Society of Mechanical Engineers (ASME)",
    "SAE": "SAE International",
    "SAE/USCAR-5-5": "SAE International",
    "SAE/USCAR-7-2": "SAE International",
    "API": "American Petroleum Institute (API)",
    "CGA": "Compressed Gas Association (CGA)",
    "NFPA": "National Fire Protection Association (NFPA)",
    "NACE": "NACE International",
    "ANSI/NACE": "NACE International",
    "UL": "UL Solutions",
    "OSHA": "Occupational Safety and Health Administration (OSHA)",
    "NASA": "National Aeronautics and Space Administration (NASA)",
    "NIST": "National Institute of Standards and Technology (NIST)",
    "FIPS": "National Institute of Standards and Technology (NIST)",
    "Sandia": "Sandia National Laboratories",
    "ARAMCO": "Saudi Aramco",
    "DNV/RP": "DNV",
    "IGEM/TD/1": "Institution of Gas Engineers and Managers (IGEM)",
    "CSA": "CSA Group",
    "CSA/ANSI": "CSA Group",
    "ANSI/CSA": "CSA Group",
    "CHMC": "CSA Group",
    "ANSI/AIAA": "American Institute of Aeronautics and Astronautics (AIAA)",
    "AS": "Standards Australia",
    "AS/NZS": "Standards Australia",
}
# Jurisdictions of these bodies
JURISDICTIONS = {
    SLOVAK: "SK",
    CZECH: "CZ",
    "Deutsches Institut für Normung (DIN)": "DE",
    "British Standards Institution (BSI)": "UK",
    "Association française de normalisation (AFNOR)": "FR",
    "International Organization for Standardization (ISO)": "mezinárodní",
    "International Electrotechnical Commission (IEC)": "mezinárodní",
    "Evropský výbor pro normalizaci (CEN/CENELEC)": "EU",
    "International Organization of Legal Metrology (OIML)": "mezinárodní",
    "International Maritime Organization (IMO)": "mezinárodní",
    "Evropský výbor pro vypracování norem v oblasti vnitrozemské plavby (CESNI)": "mezinárodní",
    "Deutscher Verein des Gas- und Wasserfaches (DVGW)": "DE",
    "Verein Deutscher Ingenieure (VDI)": "DE",
    "VDE Verband der Elektrotechnik Elektronik Informationstechnik (VDE)": "DE",
    "Verband der Automobilindustrie (VDA)": "DE",
    "Physikalisch-Technische Bundesanstalt (PTB)": "DE",
    "Deutsche Gesetzliche Unfallversicherung (DGUV)": "DE",
    "Deutscher Ausschuss für Stahlbau (DASt)": "DE",
    "Deutsche Vereinigung für Wasserwirtschaft, Abwasser und Abfall (DWA)": "DE",
    "Arbeitsgemeinschaft Druckbehälter (AD)": "DE",
    "Bundesanstalt für Arbeitsschutz und Arbeitsmedizin (BAuA)": "DE",
    "European Industrial Gases Association (EIGA)": "EU",
    "ASTM International": "US",
    "American Society of Mechanical Engineers (ASME)": "US",
    "SAE International": "US",
    "American Petroleum Institute (API)": "US",
    "Compressed Gas Association (CGA)": "US",
    "National Fire Protection Association (NFPA)": "US",
    "NACE International": "US",
    "UL Solutions": "US",
    "Occupational Safety and Health Administration (OSHA)": "US",
    "National Aeronautics and Space Administration (NASA)": "US",
    "National Institute of Standards and Technology (NIST)": "US",
    "Sandia National Laboratories": "US",
    "Saudi Aramco": "SA",
    "DNV": "mezinárodní",
    "Institution of Gas Engineers and Managers (IGEM)": "UK",
    "CSA Group": "CA",
    "American Institute of Aeronautics and Astronautics (AIAA)": "US",
    "Standards Australia": "AU",
}
# Short names of ministries, kinds of EU acts, treaties, sites of one jurisdiction or language
SHORT_NAMES = {
    "ČBÚ": "Český báňský úřad", "ERÚ": "Energetický regulační úřad", "MD": "Ministerstvo dopravy", "MMR": "Ministerstvo pro místní rozvoj",
    "MPO": "Ministerstvo průmyslu a obchodu", "MV": "Ministerstvo vnitra", "MZ": "Ministerstvo zdravotnictví", "MŽP": "Ministerstvo životního prostředí",
}
EU_ACTS = ("Nařízení EU", "Směrnice EU", "Rozhodnutí EU")
NORM = "Norma"
TREATIES = ("ADR", "RID")
CZECH_SITE = "zakonyprolidi.cz"
SITE_LANGUAGES = {"e-sbirka.gov.cz": "CS"}
UNKNOWN = ("", "neurčeno")
# Where a title holds a designation, in the order to look; (pattern, group, what is written alike)
BRACKETED = r"\[\d{3,4}/\d+\](?=(?U)\s*$)"
LEADING_ACTS = (r"(?U)^\(?\s*(?:EU|EÚ|ES)\s*\)?\s*\d{3,5}/\d+", r"^\d{3,5}/\d+/(?:EU|ES|EÚ)")
BEFORE_DASH = r"(?sU)^(.{1,60}?)\s+-\s+\S"
LAWS = {" Sb.": r"(?iuU)č\.?\s*(\d{1,4}\s*/\s*\d{4})\s*Sb\.", " Z. z.": r"(?iuU)č\.?\s*(\d{1,4}\s*/\s*\d{4})\s*Z\s*\.?\s*z\s*\.?"}
ACT_BEFORE, ACT_AFTER = r"(?U)\(\s*(?:EU|EÚ|ES)\s*\)\s*\d{3,5}/\d+", r"(?U)\d{3,5}/\d+\s*/\s*(?:EU|ES|EÚ)\b"
LONGEST_BARE = 40


def _text(c: Column) -> Column:
    return F.trim(F.coalesce(c, F.lit("")))


def _table(values: Mapping[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def _found(c: Column, pattern: str, group: int = 0) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def designation_in_title(title: Column) -> Column:
    """The designation that a title holds: in brackets at its end, an act's number in front, a code before a dash, a law's
    number, an act's number anywhere, else the title itself if it is short and has a digit. Blank if there is none."""
    t = F.regexp_replace(F.coalesce(title, F.lit("")), r"(?U)^\s+|\s+$", "")
    slovak = lambda c: F.replace(squeeze(c), F.lit("EÚ"), F.lit("EU"))
    digit = lambda c: F.when(c.rlike(r"(?U)\d"), c)
    laws = [F.concat(F.regexp_replace(_found(t, p, 1), r"(?U)\s+", ""), F.lit(end)) for end, p in LAWS.items()]
    whole = squeeze(t)
    return F.coalesce(
        _found(t, BRACKETED),
        *[slovak(_found(t, p)) for p in LEADING_ACTS],
        digit(squeeze(_found(t, BEFORE_DASH, 1))),
        *laws,
        F.replace(slovak(_found(t, ACT_BEFORE)), F.lit("ES"), F.lit("EU")),
        slovak(_found(t, ACT_AFTER)),
        F.when(F.length(whole) <= LONGEST_BARE, digit(whole)),
        F.lit(""),
    )


def issuing_body(designation: Column, bodies: Mapping[str, str] = BODIES) -> Column:
    """The body that issues a standard, by the first word of its designation as it is, in any case, or up to its first
    sign that is no letter; null if it is not in the table."""
    exact, folded = _table(bodies), _table({word.lower(): body for word, body in bodies.items()})
    first = F.regexp_extract(designation_core(designation), r"(?U)^\s*(\S+)", 1)
    letters = F.regexp_extract(first, "^[A-Za-zÁ-Žá-ž]+", 0)
    return F.coalesce(*[table[key] for word in (first, letters) for table, key in ((exact, word), (folded, F.lower(word)))])


def jurisdiction_of_body(body: Column, jurisdictions: Mapping[str, str] = JURISDICTIONS) -> Column:
    return _table(jurisdictions)[body]


def filled_jurisdiction(jurisdiction: Column, *, kind: Column, designation: Column, title: Column, address: Column, verified: Mapping[str, str] | None = None, treaties: tuple[str, ...] = TREATIES) -> Column:
    """The jurisdiction as given, if known; else by the kind of act, a norm's body, a table of verified designations, the
    site of its address, or a treaty's name in front of designation or title; else as given."""
    d, norm = _text(designation), _text(kind) == NORM
    named = reduce(Column.__or__, [F.regexp_extract(F.coalesce(c, F.lit("")), r"(?U)^\s*(\S+)", 1).isin(*treaties) for c in (designation, title)])
    return F.when(~_text(jurisdiction).isin(*UNKNOWN), jurisdiction).otherwise(
        F.coalesce(
            F.when(_text(kind).isin(*EU_ACTS), "EU"),
            F.when(norm, jurisdiction_of_body(issuing_body(d))),
            F.when(norm, _table(verified)[d]) if verified else F.lit(None).cast("string"),
            F.when(F.contains(F.coalesce(address, F.lit("")), F.lit(CZECH_SITE)), "CZ"),
            F.when(named, "mezinárodní"),
            jurisdiction,
        )
    )


def responsible(names: Column, short: Mapping[str, str] = SHORT_NAMES, longest: int = 100) -> Column:
    """The first name of an array that is one line of at most `longest` signs, written out; null if there is none."""
    clean = F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: (x != "") & ~F.contains(x, F.lit("\n")) & (F.length(x) <= longest))
    first = F.get(clean, F.lit(0))
    return F.coalesce(_table(short)[first], first)


def document_language(address: Column, raw: Column, guess: Column, codes: Mapping[str, str], sites: Mapping[str, str] = SITE_LANGUAGES) -> Column:
    """Struct code, sure: by the site of the address, else by a table of names, else the guess, which is not sure."""
    url = F.lower(_text(address))
    known = F.coalesce(*[F.when(F.contains(url, F.lit(site)), code) for site, code in sites.items()], _table(codes)[F.lower(_text(raw))])
    return F.struct(F.coalesce(known, guess).alias("code"), known.isNotNull().alias("sure"))


def document_kind(kind: Column, otherwise: str = "Nezařazeno") -> Column:
    """The kind as given; blank ones and numbers that leaked in have none."""
    return F.when(_text(kind).rlike(r"^\d*$"), otherwise).otherwise(_text(kind))


def first_title(record: Mapping[str, Column]) -> Column:
    return first_known(*[record[c] for c in ("title_authoritative", "title_cz", "title_sk", "title_eu")])
