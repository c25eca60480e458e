"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A folder of this application under spark.checkpoint.dir; in local mode without that setting, a temporary one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if "dir" not in _LOCAL:
            _LOCAL["dir"] = tempfile.mkdtemp(prefix="quillstone-")
            atexit.register(shutil.rmtree, _LOCAL["dir"], ignore_errors=True)
        base = f"file://{_LOCAL['dir']}"
    return f"{base.rstrip('/')}/quillstone-{spark.sparkContext.applicationId}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """df written as Parquet and read back, so its lineage ends and a lost executor loses none of it."""
    path = f"{shared_dir(df.sparkSession)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
