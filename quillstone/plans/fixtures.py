"""Stand-ins for the documents of a catalogue, derived from the driver's tables in the same way by Spark and DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Records: one for each part; both engines run this text
RECORDS = """
SELECT p_partkey AS id, p_partkey AS seq, p_name AS title, p_brand AS issuer,
  CASE p_partkey % 9
    WHEN 0 THEN concat('  ČSN   EN  ', cast(10000 + p_partkey % 97 AS varchar(20)), ' ')
    WHEN 1 THEN concat('EN ', cast(10000 + p_partkey % 97 AS varchar(20)))
    WHEN 2 THEN concat('STN EN ISO ', cast(1000 + p_partkey % 89 AS varchar(20)), '-', cast(p_size % 3 + 1 AS varchar(20)), '/ – 2018.08')
    WHEN 3 THEN concat('ISO ', cast(1000 + p_partkey % 89 AS varchar(20)), '-', cast(p_size % 3 + 1 AS varchar(20)))
    WHEN 4 THEN concat('(EU) 20', cast(10 + p_size % 15 AS varchar(20)), '/', cast(p_partkey AS varchar(20)))
    WHEN 5 THEN concat(cast(p_partkey AS varchar(20)), '/', cast(1990 + p_size % 30 AS varchar(20)), ' Sb.')
    WHEN 6 THEN concat('CSA / ANSI HGV ', cast(p_size AS varchar(20)), ' :2019')
    WHEN 7 THEN concat('IGC Doc ', cast(p_size AS varchar(20)), '/', cast(10 + p_partkey % 15 AS varchar(20)))
    ELSE concat('EN IEC 60079-', cast(p_size % 40 AS varchar(20)), '+A', cast(p_partkey % 3 + 1 AS varchar(20))) END AS designation,
  CASE WHEN p_partkey % 9 IN (0, 5) THEN 'CZ' WHEN p_partkey % 9 = 2 THEN 'SK' WHEN p_partkey % 9 IN (1, 4, 8) THEN 'EU'
    WHEN p_partkey % 9 = 3 THEN 'mezinárodní' WHEN p_partkey % 9 = 6 THEN 'neurčeno' ELSE NULL END AS jurisdiction
FROM part
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RECORDS.replace("FROM part", "FROM {part}"), part=table(spark, sf_dir, "part"))
