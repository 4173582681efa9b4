"""Queries of jobs, tasks and workers: a user's events are the tasks of a job."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import checkpoint_folder, read_table
from ..streaming import tasks as T
from .base import Queries

q = Queries()
QUERIES, ORACLES = q.queries, q.oracles
STATE = "CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN 'in_progress' WHEN 'error' THEN 'assigned' WHEN 'click' THEN 'failed' ELSE 'pending' END"
TASKS = f"t AS (SELECT user_id::VARCHAR AS job, event_id AS task, {STATE} AS state, (event_id % 5)::INTEGER AS tried, (user_id % 50)::INTEGER AS worker, round(value)::INTEGER % 4 AS priority FROM events)"
#: Users share 50 workers, whose views are their heartbeats; the last event is now, and a worker is lost after six hours.
SILENT = 6 * 3600
WORKERS = "w AS (SELECT (user_id % 50)::INTEGER AS worker, max(floor(epoch(ts)))::BIGINT AS heartbeat, (SELECT max(floor(epoch(ts)))::BIGINT FROM events) AS now FROM events WHERE event_type = 'view' GROUP BY 1)"


def tasks(spark, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return e.select(F.col("user_id").cast("string").alias("job"), F.col("event_id").alias("task"), F.expr(STATE).alias("state"), (F.col("event_id") % 5).cast("int").alias("tried"), (F.col("user_id") % 50).cast("int").alias("worker"), (F.round("value").cast("int") % 4).alias("priority"))


def seconds(ts: str):
    return F.unix_timestamp(F.col(ts).cast("timestamp"))


def workers(spark, d: str) -> DataFrame:
    views = read_table(spark, d, "events").filter("event_type = 'view'")
    return views.groupBy((F.col("user_id") % 50).cast("int").alias("worker")).agg(F.max(seconds("ts")).alias("heartbeat"))


def now(spark, d: str):
    return F.lit(read_table(spark, d, "events").agg(F.max(seconds("ts"))).first()[0])


SUBMITTED = "SELECT user_id::VARCHAR AS job, event_id, user_id || '_' || lpad((row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1)::VARCHAR, 6, '0') AS task, 'pending' AS state, 0 AS tried FROM events"
for _name in ("n08_submitted_jobs", "p110_tasks_from_keys"):
    q.put(_name, lambda spark, d: T.submitted(read_table(spark, d, "events").select("user_id", "event_id"), "user_id", "event_id"), SUBMITTED)

LOST = f"state IN ('assigned', 'in_progress') AND NOT coalesce(now - heartbeat <= {SILENT}, false)"
REASSIGNED = f"WITH {TASKS}, {WORKERS} SELECT job, task, CASE WHEN {LOST} THEN CASE WHEN tried >= 3 THEN 'dead_letter' ELSE 'pending' END ELSE state END AS state FROM t LEFT JOIN w USING (worker)"
for _name in ("n09_lost_workers", "n10_reassigned_tasks"):
    q.put(_name, lambda spark, d: T.reassigned(tasks(spark, d), workers(spark, d), now(spark, d), SILENT).select("job", "task", "state"), REASSIGNED)


LIVES = f"""WITH e AS (SELECT user_id::VARCHAR AS worker, event_id, ts, event_type AS kind, event_id % 4 AS tried, coalesce(epoch_us(ts) // 1000 - epoch_us(lag(ts) OVER w) // 1000 > {SILENT * 1000}, false)::INTEGER AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
s AS (SELECT *, sum(gap) OVER (PARTITION BY worker ORDER BY ts, event_id) AS life FROM e),
m AS (SELECT *, last_value(CASE WHEN kind IN ('view', 'purchase', 'error') THEN kind END IGNORE NULLS) OVER b AS before, last_value(CASE WHEN kind = 'view' THEN tried END IGNORE NULLS) OVER b AS told, last_value(CASE WHEN kind IN ('view', 'purchase', 'error') THEN kind END IGNORE NULLS) OVER n AS now, last_value(CASE WHEN kind = 'view' THEN tried END IGNORE NULLS) OVER n AS trying, row_number() OVER (PARTITION BY worker, life ORDER BY ts DESC, event_id DESC) AS back, max(ts) OVER () AS latest
  FROM s WINDOW b AS (PARTITION BY worker, life ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), n AS (PARTITION BY worker, life ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
o AS (SELECT worker, 'in_progress' AS state, tried, epoch_us(ts) // 1000 AS happened FROM m WHERE kind = 'view'
UNION ALL SELECT worker, CASE WHEN kind = 'purchase' THEN 'completed' WHEN told >= 3 THEN 'dead_letter' ELSE 'pending' END, told, epoch_us(ts) // 1000 FROM m WHERE kind IN ('purchase', 'error') AND before = 'view'
UNION ALL SELECT worker, CASE WHEN trying >= 3 THEN 'dead_letter' ELSE 'pending' END, trying, epoch_us(ts) // 1000 + {SILENT * 1000} FROM m WHERE back = 1 AND now = 'view' AND epoch_us(latest) // 1000 - epoch_us(ts) // 1000 > {SILENT * 1000})
SELECT worker, state, tried::BIGINT AS tried, happened::BIGINT AS happened FROM o"""


@q(LIVES)
def n09_worker_stream(spark, d: str) -> DataFrame:
    """Users as workers with a task of their own: views start it, purchases complete it, errors fail it, all else is a heartbeat."""
    schema = read_table(spark, d, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(d.rstrip("/") + "/events.parquet*")
    report = F.when(F.col("event_type") == "view", "started").when(F.col("event_type") == "purchase", "completed").when(F.col("event_type") == "error", "failed").otherwise("heartbeat")
    user = F.col("user_id").cast("string")
    messages = events.select(user.alias("worker"), F.col("ts").cast("timestamp").alias("at"), F.col("event_id").alias("place"), F.concat(F.lit("t"), user).alias("task"), report.alias("report"), (F.col("event_id") % 4).alias("tried"))
    out = f"{checkpoint_folder(spark)}/{uuid.uuid4()}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/rows/batch={number}")

    store = spark.conf.get(T.ROCKS[0])
    try:
        T.worker_states(messages, SILENT).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{out}/log").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(T.ROCKS[0], store)
    return spark.read.parquet(f"{out}/rows/*").select("worker", "state", "tried", F.unix_millis("at").alias("happened"))


@q(f"WITH {TASKS} SELECT job, task, CASE WHEN job::INTEGER % 3 = 0 AND state NOT IN ('completed', 'dead_letter', 'cancelled') THEN 'cancelled' ELSE state END AS state FROM t")
def n11_cancelled_jobs(spark, d: str) -> DataFrame:
    t = tasks(spark, d)
    return T.cancelled(t, t.filter(F.col("job").cast("int") % 3 == 0).select("job")).select("job", "task", "state")


FETCHED = f"WITH {TASKS}, k AS (SELECT *, row_number() OVER (PARTITION BY job ORDER BY priority DESC, task) AS n FROM t WHERE state = 'pending') SELECT t.job, t.task, CASE WHEN n <= 2 THEN 'assigned' ELSE t.state END AS state, t.tried + coalesce(n <= 2, false)::INTEGER AS tried FROM t LEFT JOIN k USING (task)"
for _name in ("n12_fetched_tasks", "n14_worker_turn"):
    q.put(_name, lambda spark, d: T.fetched(tasks(spark, d), 2, [F.col("task")]).select("job", "task", "state", "tried"), FETCHED)


@q(f"WITH {TASKS}, r AS (SELECT event_id + 1 AS task, bool_or(event_type = 'purchase') AS done FROM events WHERE event_type <> 'view' GROUP BY 1) SELECT task, CASE WHEN done IS NULL OR state = 'completed' THEN state WHEN done THEN 'completed' ELSE 'failed' END AS state FROM t LEFT JOIN r USING (task)")
def n13_reported_tasks(spark, d: str) -> DataFrame:
    reports = read_table(spark, d, "events").filter("event_type <> 'view'").select((F.col("event_id") + 1).alias("task"), F.col("event_id").alias("at"), (F.col("event_type") == "purchase").alias("ok"))
    return T.reported(tasks(spark, d), reports).select("task", "state")


STATUS = f"WITH {TASKS}, s AS (SELECT job, count(*) AS total, count(*) FILTER (state = 'completed') AS completed, 0::BIGINT AS dead_letter, 0::BIGINT AS cancelled FROM t GROUP BY 1) SELECT *, CASE WHEN total = completed THEN 'completed' WHEN completed > 0 THEN 'running' ELSE 'pending' END AS status FROM s"
for _name in ("p111_job_status", "p116_jobs"):
    q.put(_name, lambda spark, d: T.job_status(tasks(spark, d)), STATUS)
for _name in ("p112_workers", "p113_heartbeats", "p114_worker_records", "p117_worker_states"):
    q.put(_name, lambda spark, d: T.live_workers(workers(spark, d), now(spark, d), SILENT), f"WITH {WORKERS} SELECT worker, heartbeat, now - heartbeat <= {SILENT} AS alive FROM w")


@q("SELECT user_id AS job, max(event_id) AS created, 'running' AS status FROM events GROUP BY 1 ORDER BY created DESC, job LIMIT 10")
def g13_listed_jobs(spark, d: str) -> DataFrame:
    jobs = read_table(spark, d, "events").groupBy(F.col("user_id").alias("job")).agg(F.max("event_id").alias("created"), F.lit("running").alias("status"))
    return T.listed_jobs(jobs, "running", 10)


@q("SELECT user_id, round(100 * count(*) FILTER (event_type = 'purchase') / count(*), 6) AS percent, round(CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 60 / (count(*) FILTER (event_type = 'purchase') / count(*)) * (1 - count(*) FILTER (event_type = 'purchase') / count(*)) END, 4) AS eta FROM events GROUP BY 1")
def e34_job_progress(spark, d: str) -> DataFrame:
    e = read_table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("total"), F.count_if(F.col("event_type") == "purchase").alias("done"))
    out = T.expected(F.col("done"), F.col("total"), F.lit(60.0))
    return e.select("user_id", F.round(out["percent"], 6).alias("percent"), F.round(out["eta"], 4).alias("eta"))


@q("WITH s AS (SELECT user_id, count(*) AS total, count(*) FILTER (event_type = 'purchase') AS done, count(*) FILTER (event_type = 'error') AS failed FROM events GROUP BY 1) SELECT user_id, round((done + failed) / 40.0::DOUBLE, 6) AS rate, round(coalesce(done / nullif(done + failed, 0), 0), 6) AS success, round(CASE WHEN done + failed > 0 THEN (total - done - failed) / ((done + failed) / 40.0::DOUBLE) END, 4) AS eta FROM s")
def e35_throughput(spark, d: str) -> DataFrame:
    e = read_table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("total"), F.count_if(F.col("event_type") == "purchase").alias("done"), F.count_if(F.col("event_type") == "error").alias("failed"))
    out = T.throughput(F.col("done"), F.col("failed"), F.col("total"), F.lit(40.0))
    return e.select("user_id", F.round(out["rate"], 6).alias("rate"), F.round(out["success"], 6).alias("success"), F.round(out["eta"], 4).alias("eta"))


@q("SELECT user_id, count(*) FILTER (event_type <> 'purchase') AS attempts, CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN 'completed' WHEN count(*) FILTER (event_type <> 'purchase') >= 3 THEN 'dead_letter' ELSE 'pending' END AS state FROM events GROUP BY 1")
def n10_task_states(spark, d: str) -> DataFrame:
    """A user's events as task reports: purchases complete, others are attempts; three attempts without one are a dead letter."""
    e = read_table(spark, d, "events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "purchase").alias("done"), F.count_if(F.col("event_type") != "purchase").alias("attempts"))
    return e.select("user_id", "attempts", T.outcome(F.col("done"), F.col("attempts")).alias("state"))
