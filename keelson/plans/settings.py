"""Settings: one table of keys with kind, default and bounds, from which every block is read and checked."""

from __future__ import annotations

import os
import re
from pathlib import Path
from types import SimpleNamespace
from typing import Any, NamedTuple

from keelson.plans.model import SchemaError, split_name, target_name


class ConfigError(ValueError):
    """All that is wrong with a configuration, a line for each."""


class Key(NamedTuple):
    kind: type
    default: Any = None
    least: float | None = None
    most: float | None = None
    needed: bool = False


#: Names and defaults are the contract of existing configuration files (fixed values).
SETTINGS: dict[str, dict[str, Key]] = {
    "source": {
        "server": Key(str, needed=True),
        "database": Key(str, needed=True),
        "username": Key(str),
        "password": Key(str),
        "port": Key(int, 1433, 1, 65535),
        "driver": Key(str, "com.microsoft.sqlserver.jdbc.SQLServerDriver"),
        "encrypt": Key(bool, True),
        "trust_server_certificate": Key(bool, False),
        "use_snapshot_isolation": Key(bool, True),
        "fetch_size": Key(int, 10_000, 1),
        "login_timeout": Key(int, 30, 0),
        "extra_params": Key(dict, {}),
    },
    "target": {
        "root": Key(str, needed=True),
        "database": Key(str, "analytics"),
        "create_views": Key(bool, True),
        "view_suffix": Key(str, "_current"),
        "merge_fan": Key(int, 8, 2),
        "grace_seconds": Key(float, 3600, 0),
    },
    "sync": {
        "workers": Key(int, 4, 1, 1000),
        "max_snapshot_workers": Key(int, None, 1),
        "poll_interval": Key(float, 15, 0),
        "batch_size": Key(int, 50_000, 1),
        "snapshot_partitions": Key(int, 8, 1),
        "min_rows_per_partition": Key(int, 2_000_000, 1),
        "schema_refresh_seconds": Key(float, 300, 0),
        "auto_discover": Key(bool, False),
        "shard_index": Key(int, 0, 0),
        "shard_count": Key(int, 1, 1),
        "max_backoff_seconds": Key(float, 300, 0),
        "state_flush_seconds": Key(float, 2, 0),
        "shutdown_timeout": Key(float, 30, 0),
    },
    "table": {
        "source": Key(str, needed=True),
        "target": Key(str),
        "order_by": Key(list),
        "partition_by": Key(str),
        "exclude_columns": Key(list, []),
        "snapshot_partitions": Key(int, None, 1),
        "poll_interval": Key(float, None, 0),
    },
}


def _read(block: str, values: Any, problems: list[str]) -> SimpleNamespace:
    """A block by the table above; what is wrong is added to problems."""
    keys, out = SETTINGS[block], {}
    if not isinstance(values, dict):
        problems.append(f"{block} is no mapping")
        values = {}
    problems += [f"{block}.{k} is no setting" for k in values if k not in keys]
    for name, key in keys.items():
        value = values.get(name)
        if value is None:
            if key.needed:
                problems.append(f"{block}.{name} is missing")
            value = key.default.copy() if isinstance(key.default, (dict, list)) else key.default
        elif key.kind is float and isinstance(value, int) and not isinstance(value, bool):
            value = float(value)
        elif key.kind in (int, float) and isinstance(value, str) and re.fullmatch(r"-?\d+(\.\d+)?", value) and not (key.kind is int and "." in value):
            value = key.kind(value)
        elif not isinstance(value, key.kind) or isinstance(value, bool) and key.kind is not bool:
            problems.append(f"{block}.{name} is no {key.kind.__name__}: {value!r}")
            value = key.default
        if isinstance(value, (int, float)) and not isinstance(value, bool) and not ((key.least is None or value >= key.least) and (key.most is None or value <= key.most)):
            problems.append(f"{block}.{name} is out of bounds: {value}")
        out[name] = value
    return SimpleNamespace(**out)


def _settle_sync(s: SimpleNamespace, problems: list[str]) -> None:
    s.max_snapshot_workers = min(s.workers, s.max_snapshot_workers or max(1, s.workers // 2))
    if s.shard_index >= s.shard_count:
        problems.append("sync.shard_index must be below sync.shard_count")


def _settle_table(t: SimpleNamespace, problems: list[str]) -> None:
    try:
        t.key, t.target_table = ".".join(split_name(t.source or "")), target_name(t.source or "", t.target)
    except SchemaError as e:
        problems.append(f"table.source: {e}")
        t.key = t.target_table = ""


_SETTLE = {"sync": _settle_sync, "table": _settle_table}


def block(name: str, values: dict | None = None) -> SimpleNamespace:
    """One checked block."""
    problems: list[str] = []
    out = _read(name, values or {}, problems)
    _SETTLE.get(name, lambda *_: None)(out, problems)
    if problems:
        raise ConfigError("\n".join(problems))
    return out


def sync_settings(**values: Any) -> SimpleNamespace:
    return block("sync", values)


def table_settings(source: str, **values: Any) -> SimpleNamespace:
    return block("table", {"source": source, **values})


def build_settings(raw: Any) -> SimpleNamespace:
    """source, target, sync and tables of a parsed file; all problems are reported together."""
    raw, problems = expand(raw or {}), []
    if not isinstance(raw, dict):
        raise ConfigError("the configuration is no mapping")
    problems += [f"{k} is no block" for k in raw if k not in ("source", "target", "sync", "tables")]
    out = SimpleNamespace(**{k: _read(k, raw.get(k) or {}, problems) for k in ("source", "target", "sync")})
    out.tables = [_read("table", t, problems) for t in raw.get("tables") or []]
    _settle_sync(out.sync, problems)
    for t in out.tables:
        _settle_table(t, problems)
    names = [t.key.lower() for t in out.tables]
    problems += [f"table {k} is given twice" for k in sorted({k for k in names if names.count(k) > 1})]
    if not out.tables and not out.sync.auto_discover:
        problems.append("there are no tables and sync.auto_discover is off")
    if problems:
        raise ConfigError("\n".join(problems))
    return out


def load_settings(path: str) -> SimpleNamespace:
    import yaml

    return build_settings(yaml.safe_load(Path(path).read_text()))


_VAR = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}")


def expand(value: Any) -> Any:
    """Replaces variables in strings, after parsing; one without value or default is an error."""
    if isinstance(value, dict):
        return {k: expand(v) for k, v in value.items()}
    if isinstance(value, list):
        return list(map(expand, value))
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        if (got := os.environ.get(m[1], m[2])) is None:
            raise ConfigError(f"environment variable {m[1]} is not set")
        return got

    return _VAR.sub(one, value)


def load_dotenv(path: str) -> None:
    """KEY=value lines into the environment; what is set stays."""
    if not os.path.isfile(path):
        return
    for line in Path(path).read_text().splitlines():
        key, sep, value = line.strip().partition("=")
        if sep and not key.startswith("#"):
            os.environ.setdefault(key.strip().removeprefix("export ").strip(), value.strip().strip("'\""))


def jdbc_options(source: SimpleNamespace) -> dict[str, str]:
    """Options of spark.read.format('jdbc'); a brace in a value is doubled, without user the login is integrated."""

    def safe(v: object) -> str:
        text = str(v).lower() if isinstance(v, bool) else str(v)
        return "{" + text.replace("}", "}}") + "}" if re.search(r"[;{}]", text) else text

    parts = {"databaseName": source.database, "encrypt": source.encrypt, "trustServerCertificate": source.trust_server_certificate, "loginTimeout": source.login_timeout, **({} if source.username else {"integratedSecurity": True}), **source.extra_params}
    url = f"jdbc:sqlserver://{source.server}:{source.port};" + ";".join(f"{k}={safe(v)}" for k, v in parts.items())
    login = {"user": source.username, "password": source.password or ""} if source.username else {}
    isolation = {"sessionInitStatement": "SET TRANSACTION ISOLATION LEVEL SNAPSHOT"} if source.use_snapshot_isolation else {}
    return {"url": url, "driver": source.driver, "fetchsize": str(source.fetch_size), **login, **isolation}
