"""What every operator here needs from the session: tables, checkpoints and the workers' import path."""

from __future__ import annotations

import os
import re
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: Rows of an Arrow batch where the session has Spark's default (10,000): long texts then fit in little memory.
BATCH_ROWS, DEFAULT_ROWS = 1000, "10000"
ROOT = str(Path(__file__).resolve().parents[2])


def prepare(spark: SparkSession) -> SparkSession:
    """Lets Python workers import this package, bounds Arrow batches, and sets a checkpoint folder where none is set (as in tests).

    On a cluster ``spark.checkpoint.dir`` names the shared folder; it is then left as it is. Without one only a session whose
    executors are this process gets a folder of its own: any other would write where no other executor can read.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == DEFAULT_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return spark


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores before it until no column has it."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = "_" + name
    return name


def arrow_map(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]], out: list[tuple[str, DataType | str]]) -> DataFrame:
    """``mapInArrow`` where columns may have any name (dots too): ``run`` gives lists of arrays, ``out`` their names and types."""
    names = [f"c{i}" for i in range(len(out))]

    def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in run(batches):
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = [DataType.fromDDL(k) if isinstance(k, str) else k for _, k in out]
    schema = StructType([StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return df.toDF(*(f"c{i}" for i in range(len(df.columns)))).mapInArrow(mapped, schema).toDF(*(name for name, _ in out))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fold(column: str, parts: int):
    """The fold of a row: crc32 of the id as text, modulo ``parts``. A null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % parts, F.lit(0))
