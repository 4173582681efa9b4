"""Queries of sequential kernels and streams, which SQL does not express; their tests compare with plain versions."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import crop, geometry
from ..operators import structures as S
from ..sources.tables import checkpoint_folder, read_table
from ..streaming import tasks
from .features import msa
from .fixture import atoms
from .spatial import points


def l13_superposition(spark, d: str) -> DataFrame:
    """Fits each label's points onto the next label's, paired by rank."""
    q = points(spark, d).withColumn("i", F.row_number().over(Window.partitionBy("label").orderBy("vec_id")))
    a, b = (q.select("label", "i", *(F.col(c).alias(f"{s}{c}") for c in "xyz")) for s in "ab")
    pairs = a.join(b.withColumn("label", F.col("label") - 1), ["label", "i"])
    return geometry.superposed(pairs, "label", ("ax", "ay", "az"), ("bx", "by", "bz"))


def l26_realigned(spark, d: str) -> DataFrame:
    """Parts' names aligned with their types."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            both = [geometry.aligned(x, y) for x, y in zip(b["p_name"], b["p_type"], strict=True)]
            yield pd.DataFrame({"p_partkey": b["p_partkey"], "query": [x for x, _ in both], "template": [y for _, y in both], "mapping": [geometry.mapped(x, y) for x, y in both]})

    pairs = read_table(spark, d, "part").select("p_partkey", "p_name", "p_type")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))  # a row is a few bytes and much work: by the file's bytes they'd all be one task's
    return pairs.repartition(n, "p_partkey").mapInPandas(run, "p_partkey long, query string, template string, mapping array<int>")


def g06_greedy(spark, d: str) -> DataFrame:
    return geometry.greedily_deduplicated(msa(spark, d), 0.8)


def j04_contiguous_crop(spark, d: str) -> DataFrame:
    p = points(spark, d)
    toks = p.select(F.col("label").alias("structure_id"), (F.col("vec_id") % 3).cast("string").alias("chain_id"), F.col("vec_id").alias("residue_pos"), F.col("vec_id").alias("token"), "x", "y", "z")
    return crop.contiguous_crop(toks, 16, 5)


def g12_chain_growth(spark, d: str) -> DataFrame:
    """Up to four chains of each structure, grown along its interfaces."""
    a = atoms(spark, d)
    return geometry.cropped_to_chains(a.select("structure_id", "chain_id").distinct(), S.interfaces(a).select("structure_id", "chain_1", "chain_2", "contacts"), 4, 1)


def n16_task_stream(spark, d: str) -> DataFrame:
    """Events as task reports in a stateful stream over the table's files: views start, purchases complete, all else fails."""
    schema = read_table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(d.rstrip("/") + "/events.parquet*")
    report = F.when(F.col("event_type") == "view", "started").when(F.col("event_type") == "purchase", "completed").otherwise("failed")
    reports = events.select(F.col("user_id").cast("string").alias("task"), F.col("event_id").alias("at"), report.alias("report"))
    out = f"{checkpoint_folder(spark)}/{uuid.uuid4()}"

    def write(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    tasks.task_states(reports).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}/log").trigger(availableNow=True).start().awaitTermination()
    rows = spark.read.parquet(f"{out}/rows/*")
    return rows.groupBy("task").agg(F.max(F.struct("batch", "state", "tried")).alias("m")).select("task", "m.state", "m.tried")


QUERIES = {f.__name__: f for f in (l13_superposition, l26_realigned, g06_greedy, j04_contiguous_crop, g12_chain_growth, n16_task_stream)}
ORACLES: dict[str, str] = {}
