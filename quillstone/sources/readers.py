"""Readers with declared schemas; missing sources are skipped and reported."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructType
from pyspark.sql.window import Window


def json_records(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One JSON array a file, with seq, the position in the input."""
    return spark.read.schema(schema).json(path, multiLine=True).withColumn("seq", F.monotonically_increasing_id())


def json_map(spark: SparkSession, path: str, entry: str) -> DataFrame:
    """key, entry of a file that is one JSON object of entries of the given type."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string, {entry}>")).alias("key", "entry"))


def json_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Log of one JSON object a line; blank lines are none."""
    return spark.read.schema(schema).json(path)


def delimited(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Delimited text with a header row; a byte-order mark is no part of the first name. Adds file, its base name."""
    df = spark.read.csv(path, sep=sep, header=True, encoding=encoding)
    df = df.toDF(*[c.lstrip("﻿") for c in df.columns])
    return df.withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))


def rss_items(spark: SparkSession, path: str) -> DataFrame:
    """title, link, pubDate of the items of feeds."""
    return spark.read.schema("title string, link string, pubDate string").option("rowTag", "item").xml(path)


def marked_list(lines: DataFrame, marker: str) -> DataFrame:
    """Records of a list over lines (file, line, value): a line that matches `marker` starts one, others belong to it."""
    w = Window.partitionBy("file").orderBy("line")
    numbered = lines.withColumn("record", F.sum(F.col("value").rlike(marker).cast("int")).over(w)).where("record > 0")
    return numbered.groupBy("file", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "value"))), lambda x: x["value"]), "\n").alias("text"))


def union_sources(sources: Mapping[str, DataFrame | None]) -> tuple[DataFrame | None, list[str]]:
    """All sources in their order with source and source_rank, columns by name; and the names of those that are missing."""
    out, missing = None, []
    for rank, (name, df) in enumerate(sources.items()):
        if df is None:
            missing.append(name)
            continue
        df = df.withColumns({"source": F.lit(name), "source_rank": F.lit(rank)})
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out, missing


def fetch_targets(records: DataFrame, fields: list[str]) -> DataFrame:
    """id, field, url for each url field that is not blank, in the order of fields."""
    each = F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(f).alias("field"), F.trim(F.col(f)).alias("url")) for i, f in enumerate(fields)])
    return records.select("id", F.explode(F.filter(each, lambda x: F.coalesce(x["url"], F.lit("")) != "")).alias("t")).select("id", "t.*")


CACHE_TYPE = MapType(StringType(), StringType())
