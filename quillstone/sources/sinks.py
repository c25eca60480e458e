"""Exports of a fixed projection, logs that grow, review queues."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_projection(df: DataFrame, fields: list[str]) -> DataFrame:
    """Fields as text: null is blank, arrays are joined by a comma and a blank."""
    kinds = dict(df.dtypes)
    text = lambda c: F.array_join(c, ", ") if kinds[c].startswith("array") else F.col(c).cast("string")
    return df.select(*[F.coalesce(text(c), F.lit("")).alias(c) for c in fields])


def export(df: DataFrame, path: str, kind: str) -> None:
    w = df.write.mode("overwrite")
    if kind == "csv":
        w.csv(path, header=True)
    elif kind == "json":
        w.json(path)
    elif kind == "xml":
        w.option("rowTag", "document").option("rootTag", "documents").xml(path)
    else:
        raise ValueError(kind)


def append_log(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def reload(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
