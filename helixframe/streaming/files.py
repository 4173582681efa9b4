"""Files as a stream: new files are processed in batches; failures go to a dead-letter table and are tried again in later runs.

Spark's file source logs what it has read, so a restarted query goes on where it stopped; a batch that is run again
writes the same rows again to its own folder, which it overwrites, so nothing is counted twice. What has failed is known from the two
tables: a path with dead letters and no result. Before new files come, ``retry_failed`` takes such paths again, in batches with numbers
below 0, until they have ``RUNS`` dead letters each. ``ProgressLog`` keeps the rates of each batch.
"""

from __future__ import annotations

import functools
import gzip
import json
import random
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..sources.storage import Storage
from ..sources.tables import exists

FILE = "path string, modificationTime timestamp, length long, content binary"
MOST_BYTES = 100 << 20
#: Runs in which a failing file is tried, and files that are tried again together (their paths go through the driver).
RUNS, TOGETHER = 5, 10_000


def processed(files: DataFrame, function: Callable[[str, bytes], bytes | str], attempts: int = 3) -> DataFrame:
    """``path, ok, result, error`` of each file; ``.gz`` is unpacked first. A failing file is tried ``attempts`` times."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content in zip(b["path"], b["content"], strict=True):
                error = None
                for _ in range(attempts):
                    try:
                        raw = bytes(content)
                        out = function(path, gzip.decompress(raw) if path.endswith(".gz") else raw)
                        rows.append((path, True, out.encode() if isinstance(out, str) else out, None))
                        break
                    except Exception as e:  # noqa: BLE001  whatever a file does to the function is its own failure
                        error = f"{type(e).__name__}: {e}"
                else:
                    rows.append((path, False, None, error))
            yield pd.DataFrame(rows, columns=["path", "ok", "result", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, ok boolean, result binary, error string")


def _kept(df: DataFrame, number: int, sink: str, dead_letters: str, function: Callable[[str, bytes], bytes | str]) -> None:
    """Processes a batch of files (``path, content, length``) and writes its results and dead letters."""
    done = processed(df.filter(F.col("length") <= MOST_BYTES), function).persist()
    done.filter("ok").select("path", "result").write.mode("overwrite").parquet(f"{sink}/batch={number}")
    refused = df.filter(F.col("length") > MOST_BYTES).select("path", F.format_string("%d bytes are more than %d", "length", F.lit(MOST_BYTES)).alias("error"))
    done.filter("NOT ok").select("path", "error").unionByName(refused).write.mode("overwrite").parquet(f"{dead_letters}/batch={number}")
    done.unpersist()


def _table(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch long").parquet(folder) if exists(spark, folder) else spark.createDataFrame([], f"{schema}, batch long")


def open_failures(spark: SparkSession, sink: str, dead_letters: str, runs: int = RUNS) -> DataFrame:
    """``path, tried, error`` (the last one) of files that have failed in fewer than ``runs`` runs and never had a result."""
    dead, done = _table(spark, dead_letters, "path string, error string"), _table(spark, sink, "path string, result binary")
    run = F.when(F.col("batch") < 0, -F.col("batch")).otherwise(0)
    failed = dead.groupBy("path").agg(F.countDistinct("batch").alias("tried"), F.max_by("error", run).alias("error"))
    return failed.filter(F.col("tried") < runs).join(done.select("path").distinct(), "path", "left_anti")


def retry_failed(spark: SparkSession, sink: str, dead_letters: str, function: Callable[[str, bytes], bytes | str], runs: int = RUNS) -> int:
    """Processes the open failures again and gives their number. A path that is gone stays a dead letter."""
    rows = open_failures(spark, sink, dead_letters, runs).select("path").toLocalIterator()
    batches = [t.agg(F.min("batch")).first()[0] or 0 for t in (_table(spark, sink, "path string, result binary"), _table(spark, dead_letters, "path string, error string"))]
    number, count = min(*batches, 0), 0
    while paths := [r.path for _, r in zip(range(TOGETHER), rows, strict=False)]:
        there = [p for p in paths if exists(spark, p)]
        if there:
            number -= 1
            count += len(there)
            _kept(spark.read.format("binaryFile").load(there).select("path", "content", "length"), number, sink, dead_letters, function)
    return count


def stream_files(spark: SparkSession, source: str, sink: str, dead_letters: str, checkpoint: str, function: Callable[[str, bytes], bytes | str], batch: int = 100, pattern: str = "*", runs: int = RUNS) -> StreamingQuery:
    """Tries what has failed before again, then starts the query over what lies in ``source`` now; a later call takes what has come since. A file over ``MOST_BYTES`` is not read but is a dead letter."""
    retry_failed(spark, sink, dead_letters, function, runs)
    files = lambda: spark.readStream.format("binaryFile").schema(FILE).option("maxFilesPerTrigger", batch).option("pathGlobFilter", pattern).load(source)
    small = files().filter(F.col("length") <= MOST_BYTES).select("path", "content", "length")
    large = files().filter(F.col("length") > MOST_BYTES).select("path", F.lit(None).cast("binary").alias("content"), "length")
    write = functools.partial(_kept, sink=sink, dead_letters=dead_letters, function=function)
    return small.unionByName(large).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


PROGRESS = "query string, name string, batch long, at string, rows long, rows_per_second double, processed_per_second double, milliseconds long, error string"


class ProgressLog(StreamingQueryListener):
    """An object for each batch of the session's streams, and one for each stream's end, in a folder that Spark can reach.

    ``spark.streams.addListener(ProgressLog(spark, folder))`` begins it; ``read_progress`` reads it as a table.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.store = Storage(spark, folder)

    def _put(self, key: str, row: dict) -> None:
        self.store.put(key, (json.dumps(row) + "\n").encode())

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = {"query": str(p.id), "name": p.name, "batch": p.batchId, "at": p.timestamp, "rows": p.numInputRows, "rows_per_second": _finite(p.inputRowsPerSecond), "processed_per_second": _finite(p.processedRowsPerSecond), "milliseconds": p.durationMs.get("triggerExecution")}
        self._put(f"{p.id}-{p.batchId:012d}.json", row)

    def onQueryTerminated(self, event) -> None:
        self._put(f"{event.id}-end-{event.runId}.json", {"query": str(event.id), "error": event.exception})


def _finite(x: float) -> float | None:
    return x if x == x and abs(x) < float("inf") else None


def read_progress(spark: SparkSession, folder: str) -> DataFrame:
    """A row a batch, and one without ``batch`` for each end of a stream (``error`` if it failed)."""
    return spark.read.schema(PROGRESS).json(folder)


def packed(files: DataFrame) -> DataFrame:
    """``path`` with ``.gz`` and the content packed (the same bytes for the same content)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": b["path"] + ".gz", "content": [gzip.compress(bytes(c), mtime=0) for c in b["content"]]})

    return files.select("path", "content").mapInPandas(run, "path string, content binary")


def retried(function: Callable, attempts: int = 3, first: float = 1.0, most: float = 60.0, sleep: Callable[[float], None] = time.sleep, draw: Callable[[], float] = random.random) -> Callable:
    """``function``, called up to ``attempts`` times with a doubling wait between; the last error is raised."""

    def call(*args, **kwargs):
        for attempt in range(attempts):
            try:
                return function(*args, **kwargs)
            except Exception:  # noqa: BLE001  the caller names no kinds: all are tried again
                if attempt + 1 == attempts:
                    raise
                sleep(retry_delay(attempt, first, most, draw()))

    return call


def retry_delay(attempt: int, first: float = 1.0, most: float = 60.0, draw: float = 0.5) -> float:
    """Seconds to wait: doubling up to ``most``, times 0.5 to 1.5 by ``draw`` in [0, 1)."""
    return min(first * 2**attempt, most) * (0.5 + draw)


def missing(listing: DataFrame, there: DataFrame, overwrite: bool = False, key: str = "path") -> DataFrame:
    """Files of a listing that are not there yet."""
    return listing if overwrite else listing.join(there.select(key).distinct(), key, "left_anti")
