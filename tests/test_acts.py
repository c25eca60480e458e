import pytest
from pyspark.sql import functions as F

from quillstone.functions import acts as A


def values(spark, build, *rows):
    n = max(len(r) for r in rows)
    df = spark.createDataFrame(rows, ", ".join(f"c{i} string" for i in range(n)))
    return [r["y"] for r in df.select(build(*[F.col(f"c{i}") for i in range(n)]).alias("y")).collect()]


CASES = [
    (A.act_type, [("Nařízení (EU) 2023/1804 o zrušení směrnice 2014/94/EU",), ("Energetický zákon",), ("Vyhláška o něčem",), ("ČSN EN 1",), ("Nařízení vlády 1",), ("x",), (None,), ("Commission Directive",)], ["Nařízení EU", "Zákon", "Vyhláška", "Norma", "Nařízení vlády", "", "", "Směrnice EU"]),
    (A.eu_subtype, [("x", "https://e/eli/reg_del/1", "EU"), ("Prováděcí nařízení, mění rozhodnutí v přenesené pravomoci", None, "EU"), ("delegated regulation", None, "CZ"), ("t", "https://eur-lex.europa.eu/x", None)], ["delegated", "implementing", None, None]),
    (A.written, [("EU:2019/943", "regulation"), ("EU:2009/715", "regulation"), ("EU:2003/87", "directive"), ("CZ:505/1990", None), ("NORM:EN 1", None)], ["(EU) 2019/943", "(ES) č. 715/2009", "2003/87/ES", "505/1990 Sb.", "EN 1"]),
    (A.celex, [("EU:2019/943", "regulation"), ("CZ:1/2000", "regulation"), ("EU:2014/94", None)], ["32019R0943", None, None]),
    (A.kind_of_celex, [("32014L0094",), ("x",), (None,)], ["directive", None, None]),
    (A.address, [("CZ:505/1990", None), ("EU:2019/943", "regulation"), ("EU:2019/943", None)], ["https://www.zakonyprolidi.cz/cs/1990-505", "https://eur-lex.europa.eu/legal-content/CS/TXT/?uri=CELEX:32019R0943", None]),
    (A.celex_pairs, [("32014R0559",), ("nothing",), (None,)], [["2014/559", "559/2014"], [], []]),
    (A.resource_candidates, [("(EU) 2022/869", "Nařízení EU"), ("1999/2001", "Směrnice EU"), ("2022/869", "Zákon"), (None, "Nařízení EU")], [["http://publications.europa.eu/resource/celex/32022R0869"], ["http://publications.europa.eu/resource/celex/31999L2001", "http://publications.europa.eu/resource/celex/32001L1999"], [], []]),
    (A.full_years, [("98/34/ES",), ("č. 2119/98/ES",), ("2001/42/ES",), (None,)], ["1998/34/ES", "č. 2119/1998/ES", "2001/42/ES", ""]),
    (A.czech_date, [("2026-07-01",), ("x",), (None,)], ["1. 7. 2026", None, None]),
    (A.date_signal, [("zo dňa 05. júla 2001",), ("z 5. ledna 2001",), ("none",), (None,)], ["5. července 2001", "5. ledna 2001", None, None]),
    (A.joined_lines, [("vodí-", "ková"), ("EN-", "ISO"), ("a", "b")], ["vodíková", "EN- ISO", "a b"]),
    (lambda d, h: A.file_name(d, h, "pdf"), [("ČSN EN 1/2", "0123456789"), (" ", "abcdefghij")], ["SN_EN_1_2__01234567.pdf", "unnamed__abcdefgh.pdf"]),
    (lambda c: A.longest_prefix(c, {"EN": "a", "EN ISO": "b"}), [("EN ISO 1",), ("EN 1",), ("x",), (None,)], ["b", "a", None, None]),
    (A.is_garbled, [("- 2024.09",), ("CEN/TC 326 Gas",), ("EN 1",), (None,)], [True, True, False, False]),
    (A.is_fragment, [("- x",), ("2-1: x",), ("lower case",), ("zákon č. 1",), ("Title",), (None,)], [True, True, True, False, False, False]),
    (A.token_estimate, [("x" * 28,), ("",), (None,)], [11, 1, 1]),
    (lambda a: A.with_reason(a, "b"), [("a",), ("a; b",), (None,)], ["a; b", "a; b", "b"]),
    (lambda a: A.without_reason(a, "b"), [("a; b",), ("b",), (None,)], ["a", "", ""]),
]


@pytest.mark.parametrize("build, rows, wanted", CASES)
def test_act_functions(spark, build, rows, wanted):
    assert values(spark, build, *rows) == wanted


def test_states_and_severity(spark):
    df = spark.createDataFrame([("návrh", True), ("návrh", False), (None, True)], "v string, c boolean")
    assert [r["s"] for r in df.select(A.lifecycle(F.col("v"), F.col("c")).alias("s")).collect()] == ["draft", "superseded", "active"]
    df = spark.createDataFrame([(True, A.REASONS[0], "", ""), (True, A.REASONS[2], "x", ""), (True, A.REASONS[2], "", ""), (None, "", "", "")], "n boolean, r string, a string, d string")
    assert [r["s"] for r in df.select(A.severity(*[F.col(c) for c in "nrad"]).alias("s")).collect()] == ["defect", "approximate", "incomplete", None]
    assert values(spark, A.review_reasons, ("- 2024.09", "x", " ")) == ["; ".join(A.REASONS)]
    assert values(spark, A.issued, ("7.2022",), ("?",)) == [(2022, 7), (0, 0)]
