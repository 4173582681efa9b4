"""The life of tasks as a stateful stream: reports come in, each task's state and attempts are kept.

States: pending, in_progress, completed, failed, dead_letter. A failed task goes back to pending until it has been
tried ``attempts`` times; then it is a dead letter. A report on a finished task changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..sources.tables import workers_find_package

FINAL = ("completed", "dead_letter", "cancelled")
# Seconds until a silent worker counts as lost, and how often a task is tried.
WORKER_TIMEOUT, ATTEMPTS = 30, 3
# End of fixed values.


def step(state: str, tried: int, report: str, attempts: int) -> tuple[str, int]:
    if state in FINAL:
        return state, tried
    if report == "started":
        return "in_progress", tried + 1
    if report == "completed":
        return "completed", tried
    if report in ("failed", "lost"):
        return ("dead_letter" if tried >= attempts else "pending"), tried
    return state, tried


def task_states(reports: DataFrame, attempts: int = 3) -> DataFrame:
    """``task, state, tried`` whenever a batch has reports (``task, at, report``) of a task, as an update stream."""

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now, tried = state.get if state.exists else ("pending", 0)
        for r in pd.concat(list(parts)).sort_values("at", kind="stable")["report"]:
            now, tried = step(now, tried, r, attempts)
        state.update((now, tried))
        yield pd.DataFrame({"task": [key[0]], "state": [now], "tried": [tried]})

    return reports.groupBy("task").applyInPandasWithState(run, "task string, state string, tried long", "state string, tried long", "update", GroupStateTimeout.NoTimeout)


class WorkerLife(StatefulProcessor):
    """A worker's open tasks and when it was last heard of; a timer ``timeout`` seconds later (of event time) finds it lost.

    A gap inside a batch is noticed as well, so results don't depend on how the messages fall into batches.
    """

    def __init__(self, timeout: int, attempts: int):
        self.timeout, self.attempts = timeout * 1000, attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "at long")
        self.tasks = handle.getMapState("tasks", "task string", "tried long")

    def _lost(self, worker: str, open_: dict[str, int], at: int) -> list[tuple]:
        """All open tasks go back, or are dead letters after the last attempt."""
        rows = [(worker, task, "dead_letter" if tried >= self.attempts else "pending", tried, at) for task, tried in sorted(open_.items())]
        open_.clear()
        return rows

    def _told(self, worker: str, open_: dict[str, int], at: int, task: str | None, report: str, tried: int) -> list[tuple]:
        if report == "started":
            open_[task] = tried
            return [(worker, task, "in_progress", tried, at)]
        if report not in ("completed", "failed", "cancelled") or task not in open_:
            return []  # a heartbeat, or the task isn't this worker's any more
        tried = open_.pop(task)
        state = report if report != "failed" else "dead_letter" if tried >= self.attempts else "pending"
        return [(worker, task, state, tried, at)]

    def _open(self) -> dict[str, int]:
        return {k[0]: v[0] for k, v in self.tasks.iterator()} if self.tasks.exists() else {}

    def _frame(self, rows: list[tuple]) -> pd.DataFrame:
        out = pd.DataFrame(rows, columns=["worker", "task", "state", "tried", "at"])
        return out.assign(at=pd.to_datetime(out["at"], unit="ms"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows)).sort_values(["at", "place"], kind="stable")
        last, out, before = self.last.get()[0] if self.last.exists() else None, [], self._open()
        open_ = dict(before)
        for at, task, report, tried in zip((batch["at"].astype("datetime64[us]").astype("int64") // 1000).tolist(), batch["task"], batch["report"], batch["tried"], strict=True):
            if last is not None and at - last > self.timeout:
                out += self._lost(key[0], open_, last + self.timeout)
            last = at if last is None else max(last, at)
            out += self._told(key[0], open_, at, task, report, 0 if pd.isna(tried) else int(tried))
        for task in before.keys() - open_.keys():
            self.tasks.removeKey((task,))
        for task, tried in open_.items() - before.items():
            self.tasks.updateValue((task,), (tried,))
        self.last.update((last,))
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last + self.timeout)
        yield self._frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield self._frame(self._lost(key[0], self._open(), self.last.get()[0] + self.timeout))
        self.tasks.clear()
        self.last.clear()

    def close(self) -> None:
        pass


ROCKS = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def worker_states(messages: DataFrame, timeout: int = WORKER_TIMEOUT, attempts: int = ATTEMPTS, delay: str = "0 seconds") -> DataFrame:
    """``worker, task, state, tried, at`` whenever a task changes, from a stream of messages (``worker, at, place, task, report, tried``).

    Reports are ``started`` (of which attempt: ``tried``), ``completed``, ``failed``, ``cancelled`` and ``heartbeat``; any of them shows that the worker
    lives, messages of equal ``at`` count by ``place``. A worker silent for over ``timeout`` seconds of event time is lost: its open tasks are pending
    again, or dead letters after ``attempts``. The session's state store becomes RocksDB, which timers need.
    """
    messages.sparkSession.conf.set(*ROCKS)
    workers_find_package(messages.sparkSession)
    given = messages.select("worker", F.col("at").cast("timestamp").alias("at"), "place", "task", "report", F.col("tried").cast("long").alias("tried")).withWatermark("at", delay)
    return given.groupBy("worker").transformWithStateInPandas(WorkerLife(timeout, attempts), "worker string, task string, state string, tried long, at timestamp", "Update", "EventTime")


def progress(states: DataFrame, job: str) -> DataFrame:
    """Tasks by outcome and the share that is done, for each job."""
    out = states.groupBy(job).agg(F.count("*").alias("total"), F.count_if(F.col("state") == "completed").alias("completed"), F.count_if(F.col("state") == "dead_letter").alias("failed"))
    return out.withColumn("percent", F.when(F.col("total") == 0, 0.0).otherwise(100 * F.col("completed") / F.col("total")))


# Jobs as tables: ``tasks`` has ``job, task, state, tried`` and, where needed, ``priority, worker``


def submitted(keys: DataFrame, job: str, key: str) -> DataFrame:
    """A pending task for each key of a job, named ``job_000000`` in the order of keys."""
    place = F.row_number().over(Window.partitionBy(job).orderBy(key)) - 1
    return keys.select(F.col(job).cast("string").alias("job"), key, F.format_string("%s_%06d", F.col(job).cast("string"), place).alias("task"), F.lit("pending").alias("state"), F.lit(0).alias("tried"))


def fetched(tasks: DataFrame, workers: int, order: list[Column]) -> DataFrame:
    """The tasks that the workers of each job take next: pending ones, the highest priority first; they are assigned and tried once more."""
    pending = F.coalesce(F.col("state") == "pending", F.lit(False))
    place = F.row_number().over(Window.partitionBy("job", pending).orderBy(F.col("priority").desc(), *order))
    taken = pending & (F.col("__n") <= workers)
    ranked = tasks.withColumn("__n", place)
    return ranked.withColumns({"state": F.when(taken, "assigned").otherwise(F.col("state")), "tried": F.col("tried") + F.when(taken, 1).otherwise(0)}).drop("__n")


def live_workers(workers: DataFrame, now: Column, timeout: int = WORKER_TIMEOUT) -> DataFrame:
    """``alive``: whether a worker's last ``heartbeat`` (in seconds) is at most ``timeout`` ago."""
    return workers.withColumn("alive", (now - F.col("heartbeat")) <= timeout)


def reassigned(tasks: DataFrame, workers: DataFrame, now: Column, timeout: int = WORKER_TIMEOUT, attempts: int = ATTEMPTS) -> DataFrame:
    """Tasks of lost workers are pending again, or dead letters after ``attempts``; all others stay."""
    alive = live_workers(workers, now, timeout).select("worker", "alive")
    lost = F.col("state").isin("assigned", "in_progress") & ~F.coalesce("alive", F.lit(False))
    return tasks.join(alive, "worker", "left").withColumn("state", F.when(lost, F.when(F.col("tried") >= attempts, "dead_letter").otherwise("pending")).otherwise(F.col("state"))).drop("alive")


def cancelled(tasks: DataFrame, jobs: DataFrame) -> DataFrame:
    """Tasks of the jobs (``job``) that are not finished."""
    gone = jobs.select("job", F.lit(True).alias("__gone")).distinct()
    out = tasks.join(gone, "job", "left")
    return out.withColumn("state", F.when(F.col("__gone") & ~F.col("state").isin(*FINAL), "cancelled").otherwise(F.col("state"))).drop("__gone")


def reported(tasks: DataFrame, reports: DataFrame) -> DataFrame:
    """``task, state``: completed if a report says so, failed if the last one does, as it was without reports (``task, at, ok``)."""
    last = reports.groupBy("task").agg(F.bool_or("ok").alias("done"), F.count("*").alias("reports"))
    state = F.when(F.col("reports").isNull() | F.col("state").isin(*FINAL), F.col("state")).when(F.col("done"), "completed").otherwise("failed")
    return tasks.join(last, "task", "left").withColumn("state", state).drop("done", "reports")


def job_status(tasks: DataFrame) -> DataFrame:
    """A row a job: tasks by outcome, and its state: cancelled, completed when none is left, running when some is done, else pending."""
    out = tasks.groupBy("job").agg(F.count("*").alias("total"), *(F.count_if(F.col("state") == s).alias(s) for s in ("completed", "dead_letter", "cancelled")))
    left = F.col("total") - F.col("completed") - F.col("dead_letter") - F.col("cancelled")
    return out.withColumn("status", F.when(F.col("cancelled") > 0, "cancelled").when(left == 0, "completed").when(F.col("completed") + F.col("dead_letter") > 0, "running").otherwise("pending"))


def listed_jobs(jobs: DataFrame, status: str | None = None, most: int = 100) -> DataFrame:
    """The newest jobs (``job, status, created``), ``most`` at the most."""
    kept = jobs if status is None else jobs.filter(F.col("status") == status)
    return kept.orderBy(F.col("created").desc(), "job").limit(most)


def expected(done: Column, total: Column, elapsed: Column) -> dict[str, Column]:
    """``percent`` and ``eta``, the seconds left at the same pace (null before anything is done)."""
    share = done / F.nullif(total, F.lit(0))
    return {"percent": F.coalesce(100 * share, F.lit(0.0)), "eta": F.when(share > 0, elapsed / share * (1 - share))}


def throughput(done: Column, failed: Column, total: Column, elapsed: Column) -> dict[str, Column]:
    """``rate`` a second, ``success`` and ``eta`` of a run."""
    rate = (done + failed) / F.nullif(elapsed, F.lit(0))
    return {"rate": rate, "success": F.coalesce(done / F.nullif(done + failed, F.lit(0)), F.lit(0.0)), "eta": F.when(rate > 0, (total - done - failed) / rate)}


def outcome(done: Column, attempts: Column, most: int = ATTEMPTS) -> Column:
    """A task's state from its completions and other reports."""
    return F.when(done > 0, "completed").when(attempts >= most, "dead_letter").otherwise("pending")
