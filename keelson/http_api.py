"""The control surface over HTTP, on the standard library: health, schema, seed and sync jobs. One job runs at a time."""

from __future__ import annotations

import json
import re
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql import SparkSession

from keelson.jobs import BadParameters, Conflict, JobManager, NotFound, health, run_report, start_seed
from keelson.loadtest import KEYS, replicate, seeded_source
from keelson.operators.seed import SHARES, check_batch, make
from keelson.sources.files import Files

#: Parameters of a timed run: default, least, most (fixed values).
SYNC = {
    "workers": (4, 1, 64),
    "snapshotPartitions": (4, 1, 256),
    "minRowsPerPartition": (250_000, 1_000, 100_000_000),
    "batchSize": (100_000, 1_000, 1_000_000),
    "fetchSize": (10_000, 100, 100_000),
    "timeoutSeconds": (3600, 10, 86_400),
}
FLAGS = {"resetTarget": True, "keepRunning": False}
MOST_ROWS = 1_000_000_000


def sync_parameters(body: dict) -> dict:
    out, problems = {}, []
    for name, (default, least, most) in SYNC.items():
        v = body.get(name, default)
        out[name] = default if v is None else v
        if isinstance(out[name], bool) or not isinstance(out[name], int) or not least <= out[name] <= most:
            problems.append(f"{name} must be a whole number between {least} and {most}")
    for name, default in FLAGS.items():
        out[name] = body.get(name, default)
        if not isinstance(out[name], bool):
            problems.append(f"{name} must be true or false")
    if problems:
        raise BadParameters("\n".join(problems))
    return out


def seed_parameters(body: dict) -> dict:
    total, rows, batch = body.get("totalRows"), body.get("rows"), body.get("batchSize", 200_000)
    whole = lambda v: isinstance(v, int) and not isinstance(v, bool)
    if rows is not None and (not isinstance(rows, dict) or any(t not in SHARES or not whole(n) or n < 0 for t, n in rows.items())):
        raise BadParameters(f"rows must give whole numbers from 0 on for some of {', '.join(SHARES)}")
    if total is not None and not (whole(total) and 1 <= total <= MOST_ROWS):
        raise BadParameters(f"totalRows must be a whole number between 1 and {MOST_ROWS}")
    if not whole(batch):
        raise BadParameters("batchSize must be a whole number")
    try:
        check_batch(batch)
    except ValueError as e:
        raise BadParameters(str(e)) from e
    return {"total": None if rows is not None else total, "rows": rows, "batch": batch}


class Api:
    """Answers requests: handle(method, path, body) gives status, headers and what goes into the body as JSON."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.jobs = spark, root.rstrip("/"), JobManager()
        self.following = None  # a supervisor that a run has left running
        self.routes = [
            ("GET", r"/health", lambda _, b: self._health()),
            ("GET", r"/schema", lambda _, b: (200, {}, self.tables())),
            ("POST", r"/schema", lambda _, b: (200, {}, self.create(bool(b.get("dropExisting", False))))),
            ("POST", r"/seed", lambda _, b: self._seed(b)),
            ("POST", r"/sync", lambda _, b: self._sync(b)),
            ("GET", r"/jobs", lambda _, b: (200, {}, self.jobs.list())),
            ("GET", r"/jobs/([^/]+)", lambda m, b: (200, {}, self.jobs.get(m[1]))),
            ("POST", r"/jobs/([^/]+)/cancel", lambda m, b: (200, {}, self.jobs.cancel(m[1]))),
            ("GET", r"/docs", lambda _, b: (200, {}, [f"{method} {path}" for method, path, _ in self.routes])),
        ]

    def handle(self, method: str, path: str, body: bytes | None = None) -> tuple[int, dict, object]:
        path = path.split("?")[0].rstrip("/")
        try:
            given = json.loads(body) if body else {}
            if not isinstance(given, dict):
                raise BadParameters("the body must be an object")
            known = [(m, work) for verb, p, work in self.routes if (m := re.fullmatch(p, path)) and (verb == method)]
            if not known:
                other = any(re.fullmatch(p, path) for _, p, _ in self.routes)
                return 405 if other else 404, {}, {"error": f"no {method} {path}"}
            m, work = known[0]
            return work(m, given)
        except (BadParameters, json.JSONDecodeError) as e:
            return 400, {}, {"error": str(e)}
        except NotFound as e:
            return 404, {}, {"error": f"no job {e.args[0]}"}
        except Conflict as e:
            return 409, {}, {"error": str(e)}
        except Exception as e:
            return 500, {}, {"error": f"{type(e).__name__}: {e}"[:2000]}

    def _health(self) -> tuple[int, dict, object]:
        h = health(self.spark, self.root)
        return h["code"], {}, h

    def create(self, drop: bool) -> list[dict]:
        """Empty tables where there are none; with drop, in place of those there are."""
        files = Files(self.spark)
        for t in KEYS:
            path = f"{self.root}/source/{t}"
            if drop:
                files.delete(path)
            if not files.names(path):
                make(self.spark, t, 1, 0, dict.fromkeys(KEYS, 1)).write.mode("ignore").parquet(path)
        return self.tables()

    def tables(self) -> list[dict]:
        source = seeded_source(self.spark, f"{self.root}/source")
        found = {r["table_key"]: r for r in source.stats().collect()} if source.keys else {}
        out = []
        for t in KEYS:
            r = found.get(f"dbo.{t}")
            out.append({"table": t, "exists": True, "rows": r["rows"], "bytes": r["bytes"], "changeTracking": r["tracked"]} if r else {"table": t, "exists": False})
        return out

    def _started(self, job: dict, **more) -> tuple[int, dict, object]:
        return 202, {"Location": f"/jobs/{job['id']}"}, {"jobId": job["id"], "status": job["status"], **more}

    def _seed(self, body: dict) -> tuple[int, dict, object]:
        job = start_seed(self.jobs, self.spark, f"{self.root}/source", **seed_parameters(body))
        return self._started(job, plan=job["params"]["rows"], batchSize=job["params"]["batch"])

    def _sync(self, body: dict) -> tuple[int, dict, object]:
        p = sync_parameters(body)

        def work(job) -> dict:
            import time

            if self.following:
                self.following.shutdown()
                self.following = None
            if p["resetTarget"]:
                Files(self.spark).delete(f"{self.root}/target")
            began, source = time.time(), seeded_source(self.spark, f"{self.root}/source")
            sync = {"workers": p["workers"], "max_snapshot_workers": p["workers"], "snapshot_partitions": p["snapshotPartitions"], "min_rows_per_partition": p["minRowsPerPartition"], "batch_size": p["batchSize"]}
            s = replicate(self.spark, source, f"{self.root}/target", p["timeoutSeconds"], **sync)
            seconds, tables = max(time.time() - began, 0.001), run_report(s)
            if p["keepRunning"]:
                self.following = s
            else:
                s.shutdown()
            rows = sum(t["source_rows"] for t in tables)
            return {"syncSeconds": seconds, "totalRows": rows, "rowsPerSec": round(rows / seconds), "allRowCountsMatch": all(t["match"] for t in tables), "tables": {t["table_key"]: t for t in tables}, "settings": p}

        return self._started(self.jobs.start("sync", p, work), settings=p)


def serve(api: Api, port: int = 3000, host: str = "127.0.0.1") -> ThreadingHTTPServer:
    """A server for the API; serve_forever() runs it."""

    class Handler(BaseHTTPRequestHandler):
        def _answer(self) -> None:
            n = int(self.headers.get("Content-Length") or 0)
            status, headers, payload = api.handle(self.command, self.path, self.rfile.read(n) if n else None)
            data = json.dumps(payload, default=str).encode()
            self.send_response(status)
            for k, v in {"Content-Type": "application/json", "Content-Length": str(len(data)), **headers}.items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(data)

        do_GET = do_POST = _answer

        def log_message(self, *_: object) -> None:
            """Requests are not logged."""

    return ThreadingHTTPServer((host, port), Handler)
