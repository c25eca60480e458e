"""Incremental intake: findings as a file stream, merged into a queue once for each batch; marks of the last run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.operators import relational as R

QUEUE = "key string, title string, status string, seen long, first_seen long"


def high_water(log: DataFrame) -> DataFrame:
    """source, since: the start of the last run that succeeded and was applied."""
    return log.where("ok and applied").groupBy("source").agg(F.max("started").alias("since"))


def new_rows(found: DataFrame, marks: DataFrame) -> DataFrame:
    """Rows dated after their source's mark. A source without a mark only sets its baseline and gives none."""
    return found.join(marks, "source").where("date > since").drop("since")


def intake(spark: SparkSession, folder: str, queue_path: str, checkpoint: str) -> None:
    """Takes all new finding files (JSON lines of key, title, seen) into the queue, kept as one version for each batch.

    The version's folder carries the batch's number, so a batch that runs again writes the same version again.
    """

    def merge(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        before = session.createDataFrame([], QUEUE) if number == 0 else session.read.schema(QUEUE).parquet(f"{queue_path}/v{number - 1}")
        found = batch.groupBy("key").agg(F.max_by("title", "seen").alias("title"), F.max("seen").alias("seen"))
        R.upsert(before, found).drop("outcome").write.mode("overwrite").parquet(f"{queue_path}/v{number}")

    stream = spark.readStream.schema("key string, title string, seen long").option("maxFilesPerTrigger", 100).json(folder)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
