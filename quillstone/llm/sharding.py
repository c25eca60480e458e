"""Reproducible shuffle into shards: a Feistel permutation over global row numbers with cycle walking. DataFrame only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quillstone.llm.common import materialise

ROUNDS = 6
WALKS = 24
PRIME = 2147483647


def global_rows(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds the row's number 0..n-1 in the order of the given columns. Rows equal in all of them are interchangeable.

    Ranges of the order are sorted apart and written to the shared folder with their place in the range; the offsets are
    sums over one row for each range, so no task sees more than its range.
    """
    spread = "_qs_spread"  # so that equal rows do not meet in one range
    place = F.monotonically_increasing_id()
    ranged = (
        rows.withColumn(spread, place).repartitionByRange(*[F.col(c) for c in order], F.col(spread))
        .sortWithinPartitions(*order, spread).drop(spread).withColumn("_qs_place", place)
    )
    ranged = materialise(ranged, "rows")
    part = F.shiftright(F.col("_qs_place"), 33)
    counts = ranged.groupBy(part.alias("_qs_part")).agg(F.count(F.lit(1)).alias("_qs_n"))
    # one row for each range: as many as the range shuffle has partitions
    earlier = Window.orderBy("_qs_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_qs_part", F.coalesce(F.sum("_qs_n").over(earlier), F.lit(0)).alias("_qs_at"))
    joined = ranged.withColumn("_qs_part", part).join(F.broadcast(offsets), "_qs_part")
    number = F.col("_qs_at") + F.col("_qs_place").bitwiseAND(F.lit((1 << 33) - 1))
    return joined.select("*", number.alias(name)).drop("_qs_part", "_qs_at", "_qs_place")


def permuted(row: Column, n: int, seed: int) -> Column:
    """Place of row number `row` in a pseudo-random permutation of 0..n-1, a function of row, n and seed alone.

    A Feistel network on pairs (left mod a, right mod b), a * b >= n, a * b - n < a. Places from n on are walked on until
    one is below n. At most a - 1 places are outside, so for n <= 576 the number of walks suffices by count; above, each
    walk ends with a chance of 1 - 1/sqrt(n) at least, and a row that never ended would raise an error, not get lost.
    """
    a = max(1, int(n**0.5))
    while a * a < n:
        a += 1
    b = max(1, -(-n // a))

    def coded(right: Column, i: Column) -> Column:
        t = F.pmod(right * (i * 7919 + 104729 + seed % 65536) + (i + 1) * 15485863 + seed, F.lit(PRIME))
        t = F.pmod(t * t + right, F.lit(PRIME))
        return F.pmod(t * (i * 2 + 48271), F.lit(PRIME))

    def once(x: Column) -> Column:
        start = F.struct(F.pmod(x, F.lit(a)).alias("l"), F.floor(x / F.lit(a)).cast("long").alias("r"))
        if n > 2**52:
            raise ValueError("row numbers above 2^52")
        end = F.aggregate(
            F.sequence(F.lit(0).cast("long"), F.lit(ROUNDS - 1).cast("long")),
            start,
            lambda s, i: F.when(
                i % 2 == 0, F.struct(F.pmod(s["l"] + coded(s["r"], i), F.lit(a)).alias("l"), s["r"].alias("r"))
            ).otherwise(F.struct(s["l"].alias("l"), F.pmod(s["r"] + coded(s["l"], i), F.lit(b)).alias("r"))),
        )
        return end["r"] * F.lit(a).cast("long") + end["l"]

    walk = F.aggregate(
        F.sequence(F.lit(1), F.lit(WALKS)), once(row), lambda x, _: F.when(x < F.lit(n), x).otherwise(once(x))
    )
    return F.when(walk < F.lit(n), walk).otherwise(F.raise_error(F.lit("cycle walking did not end")).cast("long"))


def shards(docs: DataFrame, *, n_shards: int = 40, seed: int = 20240607, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, row_number, place, shard, slot of every row of docs. Law: `rows`.

    The global row number counts rows in the order of id, crc32 and size; the permutation turns it into a place p; shard
    p mod n_shards, slot p div n_shards. Counts of shards thus differ by one at most and slots have no gap. Cases: a
    null text has size 16 and the crc32 of no bytes, 0; a null id sorts first; repeated rows keep their own places;
    an empty table gives no rows; other columns are left out.
    """
    spark = docs.sparkSession
    raw = F.encode(F.coalesce(docs[text_col].cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(
        docs[id_col].alias("doc_id"), (F.octet_length(raw) + 16).cast("long").alias("size"), F.crc32(raw).cast("long").alias("text_crc32")
    )
    numbered = global_rows(rows, ["doc_id", "text_crc32", "size"], "row_number")
    n = numbered.count()
    if n == 0:
        empty = "doc_id long, size long, text_crc32 long, law string, row_number long, place long, shard int, slot long"
        return spark.createDataFrame([], empty).withColumn("doc_id", F.col("doc_id").cast(docs.schema[id_col].dataType))
    placed = numbered.withColumn("place", permuted(F.col("row_number"), n, seed))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "row_number", "place",
        F.pmod("place", F.lit(n_shards)).cast("int").alias("shard"), F.floor(F.col("place") / n_shards).cast("long").alias("slot"),
    )


def op3_feistel_sharding(spark, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of all documents in 40 shards; cases as shards()."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = shards(docs)
    return out.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
