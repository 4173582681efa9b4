"""Workers that fall silent, failed files that are tried again, and what a stream says of itself."""

from __future__ import annotations

import time

import pytest

from helixframe.streaming import files as X
from helixframe.streaming import tasks as T

MESSAGE = "worker string, at timestamp, place long, task string, report string, tried long"


@pytest.fixture
def rocks(spark):
    old = spark.conf.get(T.ROCKS[0])
    yield
    spark.conf.set(T.ROCKS[0], old)


def told(spark, folder, *batches) -> list[tuple]:
    """States that the messages of the batches bring, one file a batch."""
    import datetime

    out = []
    for k, rows in enumerate(batches):
        at = lambda s: datetime.datetime(2024, 1, 1) + datetime.timedelta(seconds=s)
        spark.createDataFrame([(w, at(s), i, t, r, n) for i, (w, s, t, r, n) in enumerate(rows)], MESSAGE).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")

        def write(batch, number: int, k=k) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/out/run={k}/batch={number}")

        T.worker_states(stream).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{folder}/log").trigger(availableNow=True).start().awaitTermination()
        found = spark.read.parquet(f"{folder}/out/run={k}/*").collect()
        out.append(sorted((r.worker, r.task, r.state, r.tried, int(r["at"].timestamp() - datetime.datetime(2024, 1, 1).timestamp())) for r in found))
    return out


def test_silent_workers_lose_their_tasks(spark, tmp_path, rocks):
    first = [("a", 0, "t1", "started", 1), ("a", 1, "t2", "started", 3), ("b", 2, "t3", "started", 1), ("b", 20, None, "heartbeat", None), ("a", 5, "t9", "completed", 1)]
    second = [("b", 25, "t3", "completed", None), ("c", 31, "t4", "started", 1)]
    third = [("c", 60, None, "heartbeat", None), ("b", 60, "t5", "started", 1)]
    fourth = [("c", 91, "t4", "failed", None), ("a", 92, "t6", "started", 2), ("a", 93, "t6", "cancelled", None), ("a", 93, "t1", "completed", None)]
    got = told(spark, tmp_path, first, second, third, fourth)
    assert got[0] == [("a", "t1", "in_progress", 1, 0), ("a", "t2", "in_progress", 3, 1), ("b", "t3", "in_progress", 1, 2)]
    assert got[1] == [("b", "t3", "completed", 1, 25), ("c", "t4", "in_progress", 1, 31)]  # at 31 a's last word, of 5, is under 30 seconds old
    assert got[2] == [("a", "t1", "pending", 1, 35), ("a", "t2", "dead_letter", 3, 35), ("b", "t5", "in_progress", 1, 60)]
    assert got[3] == [("a", "t6", "cancelled", 2, 93), ("a", "t6", "in_progress", 2, 92), ("b", "t5", "pending", 1, 90), ("c", "t4", "pending", 1, 90)]


def test_states_do_not_depend_on_batches(spark, tmp_path, rocks):
    rows = [("a", 0, "x", "started", 1), ("a", 10, "y", "started", 2), ("a", 45, "y", "completed", None), ("b", 46, None, "heartbeat", None), ("a", 50, "x", "started", 2), ("a", 55, "x", "failed", None), ("b", 99, None, "heartbeat", None)]
    whole = told(spark, tmp_path / "one", rows)
    parts = told(spark, tmp_path / "many", *([r] for r in rows))
    assert sorted(x for p in parts for x in p) == whole[0]
    assert [x[1:] for x in whole[0]] == [("x", "in_progress", 1, 0), ("x", "in_progress", 2, 50), ("x", "pending", 1, 40), ("x", "pending", 2, 55), ("y", "in_progress", 2, 10), ("y", "pending", 2, 40)]


def test_failed_files_are_tried_again(spark, tmp_path):
    source, out, dead, log = (str(tmp_path / x) for x in ("in", "out", "dead", "log"))
    (tmp_path / "in").mkdir()
    for name, text in (("a", "good"), ("b", "cause"), ("c", "never")):
        (tmp_path / "in" / name).write_text(text)
    marker = tmp_path / "gone"

    def work(path: str, content: bytes) -> str:
        if content == b"never" or (content == b"cause" and not marker.exists()):
            raise ValueError(f"no {content.decode()}")
        return content.decode().upper()

    def run(runs: int = 4) -> tuple[list[str], dict[str, int]]:
        X.stream_files(spark, source, out, dead, log, work, runs=runs).awaitTermination()
        results = sorted(r.result.decode() for r in spark.read.parquet(out).collect())
        return results, {r.path[-1]: r.tried for r in X.open_failures(spark, out, dead, runs).collect()}

    assert run() == (["GOOD"], {"b": 1, "c": 1})
    assert run() == (["GOOD"], {"b": 2, "c": 2})
    marker.touch()
    assert run() == (["CAUSE", "GOOD"], {"c": 3})
    (tmp_path / "in" / "d").write_text("new")
    assert run() == (["CAUSE", "GOOD", "NEW"], {})  # c has failed in as many runs as it may
    assert run(5) == (["CAUSE", "GOOD", "NEW"], {}) and X.open_failures(spark, out, dead, 6).first().error == "ValueError: no never"
    (tmp_path / "in" / "c").unlink()
    assert X.retry_failed(spark, out, dead, work, 9) == 0


def test_progress_is_kept(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for k in range(5):
        (tmp_path / "in" / f"f{k}").write_text(str(k))
    log = X.ProgressLog(spark, f"{tmp_path}/progress")
    spark.streams.addListener(log)
    try:
        X.stream_files(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/dead", f"{tmp_path}/log", lambda path, content: content, batch=2).awaitTermination()
        for _ in range(100):
            if list((tmp_path / "progress").glob("*-end-*")):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(log)
    rows = X.read_progress(spark, f"{tmp_path}/progress").collect()
    batches = [r for r in rows if r.batch is not None]
    assert sum(r.rows for r in batches) >= 5 and all(r.milliseconds > 0 and r.at for r in batches) and len(batches) >= 3
    assert [r.error for r in rows if r.batch is None] == [None]
