"""Tables in zip archives of delimited text, stored answers of endpoints, and a guard against cut-off answers."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def zipped_rows(spark: SparkSession, path: str, member: str, sep: str = "|", encoding: str = "cp1250") -> DataFrame:
    """file, line, fields (array) of one member of each archive; empty lines are none, archives without it give none."""

    def run(batches):
        for batch in batches:
            for file, content in zip(batch["file"], batch["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    if member not in z.namelist():
                        continue
                    with io.TextIOWrapper(z.open(member), encoding=encoding, errors="replace", newline="") as lines:
                        rows, at = [], 0
                        for raw in lines:  # a member is never in memory as a whole
                            line = raw.rstrip("\r\n")
                            if line:
                                rows.append((file, at, line.split(sep)))
                                at += 1
                            if len(rows) == 10_000:
                                yield pd.DataFrame(rows, columns=["file", "line", "fields"])
                                rows = []
                        if rows:
                            yield pd.DataFrame(rows, columns=["file", "line", "fields"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file"), "content").mapInPandas(run, "file string, line long, fields array<string>")


def bindings(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """Rows of stored SPARQL answers (JSON), a column for each name; unbound names are null."""
    value = ", ".join(f"`{n}`: struct<value: string>" for n in names)
    raw = spark.read.schema(f"results struct<bindings: array<struct<{value}>>>").json(path, multiLine=True)
    return raw.select(F.explode("results.bindings").alias("b")).select(*[F.col(f"b.{n}.value").alias(n) for n in names])


def batched_values(keys: DataFrame, size: int = 40) -> DataFrame:
    """batch, terms: distinct keys (key) in batches of `size` at most, within partitions, for the VALUES clause of a query."""

    def run(batches):
        for batch in batches:
            rows = batch["key"].tolist()
            parts = [" ".join(rows[i : i + size]) for i in range(0, len(rows), size)]
            yield pd.DataFrame({"terms": parts})

    return keys.select("key").where("key is not null").distinct().mapInPandas(run, "terms string").select(F.monotonically_increasing_id().alias("batch"), "terms")


def whole(df: DataFrame, limit: int, total: int | None = None) -> DataFrame:
    """df, if it is not cut off: fewer rows than the limit asked for, and no fewer than the total stated."""
    n = df.count()
    if n >= limit or (total is not None and total > n):
        raise ValueError(f"cut off: {n} rows, limit {limit}, total {total}")
    return df
