"""python -m keelson.cli [-c config.yaml] run | check [--ddl] | status | resync TABLE... ; exit 2 on a configuration error."""

from __future__ import annotations

import argparse
import os
import signal
import sys
import time
from types import SimpleNamespace

from keelson.plans.settings import ConfigError, block, jdbc_options, load_dotenv, load_settings
from keelson.sources.change_source import IsolationOff
from keelson.streaming.lifecycle import SNAPSHOT, Supervisor


def session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("keelson").config("spark.sql.session.timeZone", "UTC").config("spark.scheduler.mode", "FAIR").getOrCreate()


def make_supervisor(config: SimpleNamespace, source=None) -> Supervisor:
    from keelson.sources.change_source import JdbcSource

    spark = session()
    return Supervisor(spark, source or JdbcSource(spark, jdbc_options(config.source)), config.target.root, config.sync, config.tables, target=config.target)


def status_lines(s: Supervisor, now: float) -> list[str]:
    out = []
    for t in sorted(s.states.values(), key=lambda t: t.table_key):
        phase = f"snap {len(t.done)}/{len(t.ranges)}" if t.phase == SNAPSHOT else t.phase
        age = f"{now - t.last_success:.0f}s" if t.last_success else "-"
        out.append(f"{t.table_key:40} {phase:12} v{t.last_version:<12} {t.rows_synced:>14} {age:>8} {t.last_error[:80]}")
    return out


def check_lines(s: Supervisor, ddl: bool) -> tuple[list[str], bool]:
    """A line per table - columns, key, rows, tracking - and whether all are fit for replication."""
    out, good = [], True
    for low, t in sorted(s.configs.items()):
        try:
            spec = s.spec(low)
            tracked = s.source.min_valid_version(t.key) is not None
            good &= tracked
            out.append(f"{t.key}: {len(spec.columns)} columns, key ({', '.join(spec.pk)}), ~{s.source.approx_rows(t.key)} rows, tracking {'on' if tracked else 'OFF'}")
            if ddl:
                out.append(f"  {t.target_table}: {spec.struct().simpleString()}")
        except Exception as e:
            good = False
            out.append(f"{t.key}: {e}")
    return out, good


def main(argv: list[str] | None = None, source=None) -> int:
    p = argparse.ArgumentParser(prog="keelson")
    p.add_argument("-c", "--config", default=os.environ.get("KEELSON_CONFIG", "config.yaml"))
    sub = p.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run")
    run.add_argument("--shard-index", type=int, default=os.environ.get("SHARD_INDEX"))
    run.add_argument("--shard-count", type=int, default=os.environ.get("SHARD_COUNT"))
    run.add_argument("--seconds", type=float)
    sub.add_parser("check").add_argument("--ddl", action="store_true")
    sub.add_parser("status")
    sub.add_parser("resync").add_argument("tables", nargs="+")
    a = p.parse_args(argv)
    load_dotenv(".env")
    try:
        config = load_settings(a.config)
        if a.command == "run" and a.shard_count is not None:
            config.sync = block("sync", {**vars(config.sync), "shard_count": int(a.shard_count), "shard_index": int(a.shard_index or 0)})
    except (ConfigError, OSError) as e:
        print(f"configuration: {e}", file=sys.stderr)
        return 2
    try:
        s = make_supervisor(config, source)
    except IsolationOff as e:
        print(f"source: {e}", file=sys.stderr)
        return 2
    if a.command == "check":
        lines, good = check_lines(s, a.ddl)
        print("\n".join(lines))
        return 0 if good else 1
    if a.command == "status":
        print("\n".join(status_lines(s, time.time())))
    elif a.command == "resync":
        s.request_resync(*a.tables)
    else:
        for sig in (signal.SIGTERM, signal.SIGINT):
            signal.signal(sig, lambda *_: s.stop())
        s.run(a.seconds)
    return 0


if __name__ == "__main__":
    sys.exit(main())
