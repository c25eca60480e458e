"""Cells of XLSX workbooks and paragraphs of DOCX files, read on the executors, one file a row."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BARE = re.compile(r"^\{[^}]*\}")


def _tag(e) -> str:
    return _BARE.sub("", e.tag)


def _all(e, name: str) -> Iterator:
    return (x for x in e.iter() if _tag(x) == name)


def _text(e) -> str:
    return "".join(x.text or "" for x in _all(e, "t"))


def workbook_cells(data: bytes) -> list[tuple[str, int, int, str]]:
    """sheet, row, column (from 1), value of all cells that hold something."""
    out = []
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = [_text(e) for e in _all(ElementTree.fromstring(z.read("xl/sharedStrings.xml")), "si")] if "xl/sharedStrings.xml" in names else []
        targets = {e.get("Id"): e.get("Target").lstrip("/") for e in _all(ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels")), "Relationship")}
        for sheet in _all(ElementTree.fromstring(z.read("xl/workbook.xml")), "sheet"):
            target = targets[next(v for k, v in sheet.attrib.items() if _BARE.sub("", k) == "id")]
            tree = ElementTree.fromstring(z.read(target if target.startswith("xl/") else f"xl/{target}"))
            for c in _all(tree, "c"):
                letters, row = re.fullmatch(r"([A-Z]+)(\d+)", c.get("r")).groups()
                column = 0
                for letter in letters:
                    column = column * 26 + ord(letter) - 64
                v = next(_all(c, "v"), None)
                kind = c.get("t")
                value = _text(c) if kind == "inlineStr" else shared[int(v.text)] if kind == "s" and v is not None else v.text if v is not None else None
                if value not in (None, ""):
                    out.append((sheet.get("name"), int(row), column, value))
    return out


def document_parts(data: bytes) -> list[tuple[int, str, str]]:
    """position, kind (the style of a paragraph, or `row`), text of a DOCX body in order; cells of a row joined by a bar."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        body = next(_all(ElementTree.fromstring(z.read("word/document.xml")), "body"))
    out = []
    for part in body:
        if _tag(part) == "p":
            style = next(_all(part, "pStyle"), None)
            kind = next((v for k, v in style.attrib.items() if _BARE.sub("", k) == "val"), "") if style is not None else ""
            out.append((kind or "text", _text(part)))
        elif _tag(part) == "tbl":
            out += [("row", " | ".join(_text(c) for c in row if _tag(c) == "tc")) for row in part if _tag(row) == "tr"]
    return [(i, kind, text) for i, (kind, text) in enumerate(out) if text.strip()]


def _read(spark: SparkSession, path: str, glob: str, parse, schema: str) -> DataFrame:
    names = ["file", *[c.split(" ")[0] for c in schema.split(", ")]]
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def run(batches):
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"], strict=True):
                yield pd.DataFrame([(file, *row) for row in parse(content)], columns=names)

    return files.mapInPandas(run, f"file string, {schema}")


def cells(spark: SparkSession, path: str) -> DataFrame:
    """file, sheet, row, col, value."""
    return _read(spark, path, "*.xlsx", workbook_cells, "sheet string, row int, col int, value string")


def parts(spark: SparkSession, path: str) -> DataFrame:
    """file, position, kind, text."""
    return _read(spark, path, "*.docx", document_parts, "position int, kind string, text string")


def anchored_table(cells: DataFrame, first: str, last: str, fields: list[str]) -> DataFrame:
    """file, sheet, row and fields of the table whose header row runs from the cell `first` to the cell `last`; blank rows go."""
    key = ["file", "sheet"]
    starts = cells.where(F.trim("value") == first).groupBy(*key).agg(F.min(F.struct("row", "col")).alias("a"))
    ends = cells.where(F.trim("value") == last).select(*key, F.col("row").alias("_r"), F.col("col").alias("_c"))
    box = starts.join(ends, key).where("_r = a.row and _c >= a.col").groupBy(*key, "a").agg(F.min("_c").alias("_c"))
    inside = cells.join(box, key).where("row > a.row and col between a.col and _c").withColumn("field", F.col("col") - F.col("a.col"))
    wide = inside.groupBy(*key, "row").agg(*[F.max(F.when(F.col("field") == i, F.trim("value"))).alias(f) for i, f in enumerate(fields)])
    return wide.where(F.coalesce(*[F.nullif(F.col(f), F.lit("")) for f in fields]).isNotNull())
