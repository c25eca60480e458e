"""Cleaning of a corpus: quality, boilerplate lines, near-duplicates, benchmark passages, token ids."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import bpe, decontam, linededup, nearcopies, quality
from quillstone.llm.common import materialise


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled part of docs, does not reject.

    Null, empty and blank texts have the bias alone as their score; repeated rows stay or go together; without labels
    every score is 0.5 and all go; an empty table stays empty.
    """
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, model).where(F.col("_qs_score") >= quality.CUT).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without boilerplate lines; n_chars follows the text.

    Null texts stay null; a text all of whose lines go is empty; ties of the smallest id keep a line together; every row
    stays; an empty table stays empty.
    """
    out = linededup.without_boilerplate(docs).drop("_qs_lines", "_qs_removed")
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in out.columns else out


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (5-word shingles, similarity 0.8): that with the smallest id.

    Of several texts with this id one stays, of repeated rows one; a row without an id stands for a group only if no other
    row can; null, empty and blank texts are one group; an empty table stays empty.
    """
    copies = materialise(nearcopies.near_copies(docs), "copies")
    named = docs.withColumn("_qs_text", nearcopies.text_hash("text"))
    chosen = nearcopies.representatives(copies).toDF("_qs_doc", "_qs_hash")
    kept = named.join(chosen, named["doc_id"].eqNullSafe(chosen["_qs_doc"]) & (named["_qs_text"] == chosen["_qs_hash"]), "left_semi")
    # only rows that occur again are compared with each other
    again = copies.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").toDF("_qs_doc", "_qs_hash", "n")
    same = kept["doc_id"].eqNullSafe(again["_qs_doc"]) & (kept["_qs_text"] == again["_qs_hash"])
    once = kept.join(again, same, "left_anti")
    return once.unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "_qs_text"])).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; rows of one id go together; an empty table stays empty.
    """
    found = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    gone = found.select(F.col("doc_id").alias("_qs_doc")).distinct()
    return docs.join(gone, docs["doc_id"].eqNullSafe(gone["_qs_doc"]), "left_anti")


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens and digests of the ids and of the text that they decode to, of every row.

    Null and empty texts have no ids; repeated rows are encoded alike; an empty table gives no rows.
    """
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", keep_one),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", token_ids),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
