"""A timed load test: fill tables, replicate them, validate source against target, report. python -m keelson.loadtest --root R [--rows N] generate | sync | validate | all"""

from __future__ import annotations

import argparse
import json
import sys
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.jobs import run_report
from keelson.operators import validate
from keelson.operators.seed import plan_rows, seed
from keelson.plans.settings import sync_settings, table_settings
from keelson.sources.change_source import ParquetSource
from keelson.sources.files import Files
from keelson.streaming.lifecycle import CDC, Supervisor

#: The tables of the load test and their keys (fixed values).
KEYS = {"Customers": "CustomerId", "Products": "ProductId", "Orders": "OrderId", "OrderItems": "OrderItemId", "Payments": "PaymentId"}


class SeededSource(ParquetSource):
    """The tables as seed() lays them: a folder each below root, and the changes beside them."""

    def folder(self, key: str, part: str) -> str:
        name = key.partition(".")[2]
        return f"{self.root}/{name}" if part == "base" else f"{self.root}/_changes/{name}"


def seeded_source(spark: SparkSession, root: str) -> SeededSource:
    """A source of those tables that have rows."""
    there = [t for t in KEYS if Files(spark).walk(f"{root}/{t}", ".parquet")]
    return SeededSource(spark, root, {f"dbo.{t}": [KEYS[t]] for t in there})


@dataclass
class StageTiming:
    stage: str
    seconds: float = 0.0
    rows: int = 0


@dataclass
class RunMetrics:
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex[:12])
    started_at: float = field(default_factory=time.time)
    stages: list[StageTiming] = field(default_factory=list)
    tables: list[dict] = field(default_factory=list)
    settings: dict = field(default_factory=dict)

    @contextmanager
    def stage(self, name: str) -> Iterator[StageTiming]:
        began, timing = time.time(), StageTiming(name)
        self.stages.append(timing)
        try:
            yield timing
        finally:
            timing.seconds = time.time() - began

    def to_dict(self) -> dict:
        return asdict(self)


def replicate(spark: SparkSession, source: ParquetSource, target: str, timeout: float = 3600, **sync) -> Supervisor:
    """Runs a supervisor until every table follows changes."""
    s = Supervisor(spark, source, target, sync_settings(**{"poll_interval": 0.0, **sync}), [table_settings(k) for k in source.tables()])
    end = time.time() + timeout
    while any(t.phase != CDC for t in s.states.values()):
        if time.time() > end:
            s.shutdown()
            raise TimeoutError(f"not in sync after {timeout} s")
        s.step()
    return s


def validate_all(source: ParquetSource, supervisor: Supervisor) -> DataFrame:
    """table_key, check, match for all checks of all tables; of a key of several columns its first one is checked."""
    parts = []
    for key in source.tables():
        base = source.base(key)
        current = supervisor.store(key).current(keep_meta=False)
        parts.append(validate.validate(base, current, source.keys[key][0]).select(F.lit(key).alias("table_key"), "check", "match"))
    return reduce(DataFrame.unionByName, parts)


def run_loadtest(spark: SparkSession, root: str, plan: dict[str, int], batch: int = 200_000, **sync) -> tuple[RunMetrics, list[dict]]:
    """Fills root/source, replicates it to a new folder below root, validates; metrics and the checks of every table."""
    m = RunMetrics(settings={"plan": plan, "batch": batch, **sync})
    with m.stage("generate") as t:
        t.rows = sum(seed(spark, f"{root}/source", plan, batch).values())
    source = seeded_source(spark, f"{root}/source")
    with m.stage("sync") as t:
        s = replicate(spark, source, f"{root}/target-{m.run_id}", **sync)
        t.rows = sum(x.rows_synced for x in s.states.values())
    m.tables = run_report(s)
    with m.stage("validate"):
        checks = [r.asDict() for r in validate_all(source, s).orderBy("table_key", "check").collect()]  # five lines a table
    s.shutdown()
    return m, checks


def write_json(spark: SparkSession, m: RunMetrics, checks: list[dict], folder: str) -> str:
    path = f"{folder}/{m.run_id}.json"
    Files(spark).write(path, json.dumps(m.to_dict() | {"validation": checks}, indent=1, default=str))
    return path


def write_markdown(spark: SparkSession, m: RunMetrics, checks: list[dict], folder: str) -> str:
    lines = [f"# Load test {m.run_id}", "", "| Stage | Seconds | Rows |", "|-|-|-|", *(f"| {t.stage} | {t.seconds:.1f} | {t.rows} |" for t in m.stages)]
    lines += ["", "| Table | Source rows | Target rows | Match | Seconds | Parts | Files | Bytes |", "|-|-|-|-|-|-|-|-|"]
    lines += ["| " + " | ".join(str(t[c]) for c in ("table_key", "source_rows", "target_rows", "match", "seconds", "parts", "files", "bytes")) + " |" for t in m.tables]
    lines += ["", "| Table | Check | Passed |", "|-|-|-|", *(f"| {c['table_key']} | {c['check']} | {'yes' if c['match'] else 'NO'} |" for c in checks)]
    path = f"{folder}/{m.run_id}.md"
    Files(spark).write(path, "\n".join(lines) + "\n")
    return path


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="keelson.loadtest")
    p.add_argument("--root", required=True)
    p.add_argument("--rows", type=int)
    p.add_argument("--batch", type=int, default=200_000)
    p.add_argument("command", choices=["generate", "sync", "validate", "all"])
    a = p.parse_args(argv)
    if spark is None:
        from keelson.cli import session

        spark = session()
    if a.command == "generate":
        print(json.dumps(seed(spark, f"{a.root}/source", plan_rows(a.rows), a.batch)))
        return 0
    if a.command == "all":
        m, checks = run_loadtest(spark, a.root, plan_rows(a.rows), a.batch)
        print(write_json(spark, m, checks, f"{a.root}/reports"), write_markdown(spark, m, checks, f"{a.root}/reports"), sep="\n")
        return 0 if all(c["match"] for c in checks) else 1
    source = seeded_source(spark, f"{a.root}/source")
    s = replicate(spark, source, f"{a.root}/target")
    good = True
    if a.command == "validate":
        checks = validate_all(source, s).collect()
        good = all(c["match"] for c in checks)
        print("\n".join(f"{c['table_key']} {c['check']} {'passed' if c['match'] else 'FAILED'}" for c in checks))
    else:
        print(json.dumps(run_report(s), default=str))
    s.shutdown()
    return 0 if good else 1


if __name__ == "__main__":
    sys.exit(main())
