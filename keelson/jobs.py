"""Jobs of the control surface: one at a time, cancelled cooperatively, kept in memory."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.operators import metrics
from keelson.operators.seed import plan_rows, seed


class Conflict(RuntimeError):
    """Another job runs, or the job has ended."""


class NotFound(KeyError):
    pass


class Job:
    def __init__(self, kind: str, params: dict):
        self.id, self.kind, self.params = uuid.uuid4().hex[:12], kind, params
        self.state, self.started, self.ended = "running", time.time(), None
        self.progress, self.result, self.error = {}, None, None
        self.cancel = threading.Event()

    def view(self) -> dict:
        status = "cancelling" if self.state == "running" and self.cancel.is_set() else self.state
        return {"id": self.id, "type": self.kind, "status": status, "params": self.params, "startedAt": self.started, "endedAt": self.ended, "elapsedSeconds": round((self.ended or time.time()) - self.started, 3), "progress": self.progress, "result": self.result, "error": self.error}


class JobManager:
    def __init__(self):
        self.jobs: dict[str, Job] = {}
        self.lock = threading.Lock()

    def start(self, kind: str, params: dict, work: Callable[[Job], object]) -> dict:
        with self.lock:
            if busy := next((j for j in self.jobs.values() if j.state == "running"), None):
                raise Conflict(f"job {busy.id} is running")
            job = Job(kind, params)
            self.jobs[job.id] = job

        def body() -> None:
            try:
                job.result = work(job)
                job.state = "cancelled" if job.cancel.is_set() else "succeeded"
            except Exception as e:
                job.error, job.state = f"{type(e).__name__}: {e}", "failed"
            job.ended = time.time()

        job.thread = threading.Thread(target=body, daemon=True)
        job.thread.start()
        return job.view()

    def get(self, job_id: str) -> dict:
        if job_id not in self.jobs:
            raise NotFound(job_id)
        return self.jobs[job_id].view()

    def list(self) -> list[dict]:
        """Newest first."""
        return [j.view() for j in reversed(self.jobs.values())]

    def cancel(self, job_id: str) -> dict:
        view = self.get(job_id)
        if view["status"] not in ("running", "cancelling"):
            raise Conflict(f"job {job_id} has ended")
        self.jobs[job_id].cancel.set()
        return self.get(job_id)


def start_seed(manager: JobManager, spark, root: str, total: int | None = None, rows: dict | None = None, batch: int = 200_000) -> dict:
    plan = plan_rows(total, rows)

    def work(job: Job):
        return seed(spark, root, plan, batch, job.cancel.is_set, lambda t, done, n: job.progress.update({t: {"done": done, "total": n}}))

    return manager.start("seed", {"rows": plan, "batch": batch}, work)


#: Bounds of a timed run's parameters: kind, least, most.
SYNC_BOUNDS = {"workers": (1, 64), "snapshot_partitions": (1, 256), "min_rows_per_partition": (1, 1_000_000_000), "batch_size": (1, 10_000_000), "timeout": (1, 86_400)}


class BadParameters(ValueError):
    """All that is wrong with a request's parameters, a line for each."""


def check_parameters(params: dict, bounds: dict[str, tuple[int, int]]) -> None:
    problems = [f"{k} is no parameter" for k in params if k not in bounds]
    for k, v in params.items():
        if k in bounds and (isinstance(v, bool) or not isinstance(v, (int, float)) or not bounds[k][0] <= v <= bounds[k][1]):
            problems.append(f"{k} must be a number from {bounds[k][0]} to {bounds[k][1]}: {v!r}")
    if problems:
        raise BadParameters("\n".join(problems))


def run_report(supervisor) -> list[dict]:
    """A row a table: rows of source and target, whether they match, seconds, rows a second and parts of the snapshot from the log, files, bytes and ratio from the footers."""
    spark, states = supervisor.spark, list(supervisor.states.values())
    plan, storage = [], []
    for s in states:
        store = supervisor.store(s.table_key)
        plan.append((s.table_key, supervisor.source.approx_rows(s.table_key), store.current().count() if store.live() else 0))
        storage += [store.storage().groupBy().agg(F.count(F.lit(1)).alias("files"), F.sum("packed").alias("bytes"), F.sum("raw").alias("raw_bytes")).select(F.lit(s.table_key).alias("table_key"), "files", "bytes", "raw_bytes")] if store.live() else []
    log = spark.createDataFrame([(r["table_key"], r["task"], r["status"], r["rows"], r["duration_ms"], r["ts"]) for r in supervisor.meta.rows("sync_log")], "table_key string, task string, status string, rows long, duration_ms long, ts double")
    timing = metrics.snapshot_metrics(log.withColumn("ts", F.timestamp_micros((F.col("ts") * 1_000_000).cast("long")).cast("timestamp_ntz")))
    empty = spark.createDataFrame([], "table_key string, files long, bytes long, raw_bytes long")
    return [r.asDict() for r in metrics.run_report(spark.createDataFrame(plan, "table_key string, source_rows long, target_rows long"), timing, reduce(DataFrame.unionByName, storage, empty)).orderBy("table_key").collect()]


def start_sync(manager: JobManager, supervisor, timeout: float = 3600, **params) -> dict:
    """Runs the supervisor until every table follows changes; params are settings of the run. The report is that of run_report()."""
    check_parameters({"timeout": timeout, **params}, SYNC_BOUNDS)
    for k, v in params.items():
        setattr(supervisor.sync, k, v)

    def work(job: Job):
        began = time.time()
        while not job.cancel.is_set() and any(s.phase != "cdc" for s in supervisor.states.values()):
            if time.time() - began > timeout:
                raise TimeoutError(f"not in sync after {timeout} s")
            supervisor.step()
            job.progress.update(supervisor.heartbeat())
        seconds = max(time.time() - began, 0.001)
        tables = {} if job.cancel.is_set() else {r["table_key"]: r for r in run_report(supervisor)}
        rows = sum(r["target_rows"] for r in tables.values())
        return {"seconds": seconds, "rows": rows, "rowsPerSecond": rows / seconds, "allMatch": all(r["match"] for r in tables.values()), "tables": tables, "settings": {"timeout": timeout, **params}}

    return manager.start("sync", {"timeout": timeout, **params}, work)


def health(spark, root: str) -> dict:
    """Probes of engine and storage with their latency; a failure is an answer, never an exception."""
    from keelson.sources.store import Files

    def probe(work) -> dict:
        began = time.time()
        try:
            work()
            return {"status": "up", "latencyMs": round(1000 * (time.time() - began), 1)}
        except Exception as e:
            return {"status": "down", "error": f"{type(e).__name__}: {e}"[:500]}

    parts = {"engine": probe(lambda: spark.sql("SELECT 1").collect()), "storage": probe(lambda: Files(spark).sizes(root))}
    up = all(p["status"] == "up" for p in parts.values())
    return {"status": "up" if up else "down", "code": 200 if up else 503, **parts}
