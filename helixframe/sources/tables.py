"""The tables of a folder."""

from __future__ import annotations

import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])
#: Rows of an Arrow batch where the session has Spark's default (10,000): whole files then fit in little memory.
BATCH_ROWS, DEFAULT_ROWS = 256, "10000"


def workers_find_package(spark: SparkSession) -> None:
    """Puts this package on the Python workers' path, whatever the working directory is, and bounds Arrow batches."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == DEFAULT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def checkpoint_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder (``spark.checkpoint.dir``). One of its own where none is set, but only if the executors are this process, as in tests."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return sc._jsc.sc().getCheckpointDir().get()


def exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    workers_find_package(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
