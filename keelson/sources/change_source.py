"""Change sources: what a replicated database has to offer, and two of them.

A source gives base rows, a table-wide version counter, the lowest version from which its changes are complete
(None: tracking is off), and changes (key, version) in a version range. A session gives the source as it stands at one moment.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager, nullcontext
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.plans.model import ColumnSpec, TableSpec, spec_of, split_name
from keelson.sources.files import Files
from keelson.sources.footers import facts, footer_frame


class ResyncRequired(RuntimeError):
    """Changes since the last version are no longer complete."""


class TypeChanged(ResyncRequired):
    """A column has a type that the rows written before can't be read as."""


class IsolationOff(RuntimeError):
    """Reads are to be isolated by snapshot and the database does not allow it."""


class TrackingDisabled(RuntimeError):
    """The table has no change tracking."""


class ChangeSource(Protocol):
    def tables(self) -> list[str]: ...
    def spec(self, key: str, exclude: tuple[str, ...] = ()) -> TableSpec: ...
    def current_version(self) -> int: ...
    def min_valid_version(self, key: str) -> int | None: ...
    def base(self, key: str) -> DataFrame: ...
    def changes(self, key: str, last: int, current: int) -> DataFrame: ...
    def approx_rows(self, key: str) -> int: ...
    def session(self, key: str) -> AbstractContextManager[ChangeSource]: ...
    def probe(self) -> None: ...


def check_retention(source: ChangeSource, key: str, last: int) -> None:
    floor = source.min_valid_version(key)
    if floor is None:
        raise TrackingDisabled(f"{key}: change tracking is off")
    if last < floor:
        raise ResyncRequired(f"{key}: changes are complete from version {floor}, the last one applied is {last}")


def key_bounds(base: DataFrame, column: str) -> tuple[int | None, int | None]:
    r = base.agg(F.min(column).alias("a"), F.max(column).alias("z")).first()
    return r["a"], r["z"]


class ParquetSource:
    """Tables as Parquet folders below root: <table>/base and <table>/changes (key columns, version).

    Versions come from the footers of change files, each read once. A session freezes the lists of files, of the changes
    first: its base rows are then as new as its version or newer, and a newer row comes again with its own change.
    """

    def __init__(self, spark: SparkSession, root: str, keys: dict[str, list[str]], floors: dict[str, int] | None = None):
        self.spark, self.root, self.keys, self.floors = spark, root, keys, floors or {}
        self.versions: dict[str, int] = {}  # by change file
        self.frozen: dict[str, list[str]] = {}  # files by folder, in a session

    def folder(self, key: str, part: str) -> str:
        return f"{self.root}/{key}/{part}"

    def _files(self, key: str, part: str) -> list[str]:
        folder = self.folder(key, part)
        return self.frozen[folder] if folder in self.frozen else Files(self.spark).walk(folder, ".parquet")

    def _read(self, key: str, part: str) -> DataFrame:
        folder = self.folder(key, part)
        if folder not in self.frozen:
            return self.spark.read.parquet(folder)
        if self.frozen[folder]:
            return self.spark.read.option("basePath", folder).parquet(*self.frozen[folder])
        if part == "base":
            raise FileNotFoundError(f"{folder} has no files")
        base = self._read(key, "base")
        return base.select(*self.keys[key], F.lit(0).cast("long").alias("version")).where("false")

    def tables(self) -> list[str]:
        return sorted(self.keys)

    def spec(self, key: str, exclude: tuple[str, ...] = ()) -> TableSpec:
        schema, _, name = key.rpartition(".")
        return spec_of(self.base(key), name, self.keys[key], schema or "dbo", exclude=exclude)

    def _version(self, key: str) -> int:
        files = self._files(key, "changes")
        new = [f for f in files if f not in self.versions]
        self.versions |= {f.path: f.high or 0 for f in facts(self.spark, new, "version")}
        return max((self.versions[f] for f in files), default=0)

    def current_version(self) -> int:
        return max(map(self._version, self.keys), default=0)

    def min_valid_version(self, key: str) -> int | None:
        return self.floors.get(key, 0)

    def base(self, key: str) -> DataFrame:
        return self._read(key, "base")

    def changes(self, key: str, last: int, current: int) -> DataFrame:
        return self._read(key, "changes").where((F.col("version") > last) & (F.col("version") <= current))  # reaches the scan as a pushed filter

    def approx_rows(self, key: str) -> int:
        return self.base(key).count()  # answered from the footers

    @contextmanager
    def session(self, key: str) -> Iterator[ParquetSource]:
        """The source with one table, whose files are those of this moment."""
        pinned = type(self)(self.spark, self.root, {key: self.keys[key]}, self.floors)
        pinned.versions = self.versions
        for part in ("changes", "base"):
            pinned.frozen[self.folder(key, part)] = self._files(key, part)
        yield pinned

    def stats(self) -> DataFrame:
        """table_key, rows, files, bytes and raw_bytes of every table, from all footers in one job, and whether its changes are tracked."""
        files = [(k, f) for k in self.keys for f in self._files(k, "base")]
        tables = self.spark.createDataFrame([(k, self.min_valid_version(k) is not None) for k in self.keys], "table_key string, tracked boolean")
        parts = self.spark.createDataFrame(files, "table_key string, path string").join(footer_frame(self.spark, [f for _, f in files]), "path")
        sums = parts.groupBy("table_key").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("files"), F.sum("packed").alias("bytes"), F.sum("raw").alias("raw_bytes"))
        none = {c: F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "files", "bytes", "raw_bytes")}
        return tables.join(sums, "table_key", "left").select("table_key", *none.values(), "tracked")

    def probe(self) -> None:
        """Files are read as they were listed; there is nothing to allow."""


def bracketed(name: str) -> str:
    """A name in brackets, as the source's SQL quotes it."""
    return "[" + name.replace("]", "]]") + "]"


def literal(text: str) -> str:
    return "N'" + text.replace("'", "''") + "'"


def table_sql(key: str) -> str:
    schema, name = split_name(key)
    return f"{bracketed(schema)}.{bracketed(name)}"


def read_sql(name: str, sql_type: str) -> str:
    """A column in the form in which JDBC can read it: types without a JDBC mapping come as text."""
    c, t = bracketed(name), sql_type.lower()
    forms = {
        "hierarchyid": f"{c}.ToString()", "geography": f"{c}.STAsText()", "geometry": f"{c}.STAsText()", "xml": f"CAST({c} AS nvarchar(max))", "sql_variant": f"CAST({c} AS nvarchar(4000))",
        "datetimeoffset": f"CONVERT(varchar(34), {c}, 121)", "uniqueidentifier": f"CONVERT(char(36), {c})", "time": f"CONVERT(varchar(16), {c})",
    }
    return f"{forms[t]} AS {c}" if t in forms else c


class JdbcSource:
    """SQL Server change tracking over JDBC. The statements are built here; running them needs a driver on the class path.

    Spark opens a connection for each read, so one transaction can't span them. Instead the tick checks the floor before and
    after reading, and base rows are read after the version they are stamped with: a row that changed in between is
    only newer than its stamp and comes again with the next tick.
    """

    def __init__(self, spark: SparkSession, options: dict[str, str]):
        self.spark, self.options = spark, options

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options).option("query", sql).load()

    def session(self, key: str) -> AbstractContextManager[JdbcSource]:
        return nullcontext(self)

    def probe(self) -> None:
        """If reads are to be isolated by snapshot, the database must allow it."""
        if "SNAPSHOT" in self.options.get("sessionInitStatement", "") and self.query("SELECT snapshot_isolation_state AS s FROM sys.databases WHERE database_id = DB_ID()").first()["s"] != 1:
            raise IsolationOff("the database does not allow snapshot isolation; allow it or set source.use_snapshot_isolation to false")

    def tables(self) -> list[str]:
        sql = "SELECT s.name AS s, t.name AS t FROM sys.change_tracking_tables c JOIN sys.tables t ON t.object_id = c.object_id JOIN sys.schemas s ON s.schema_id = t.schema_id"
        return sorted(f"{r['s']}.{r['t']}" for r in self.query(sql).collect())

    def columns_sql(self, key: str) -> str:
        at = literal(table_sql(key))
        return (
            "SELECT c.name AS n, t.name AS kind, c.precision AS p, c.scale AS s, c.is_nullable AS nullable, coalesce(k.key_ordinal, 0) AS k FROM sys.columns c JOIN sys.types t ON t.user_type_id = c.system_type_id OR t.user_type_id = c.user_type_id AND t.is_user_defined = 0 AND c.system_type_id = 240 "
            "LEFT JOIN (SELECT ic.object_id, ic.column_id, ic.key_ordinal FROM sys.index_columns ic JOIN sys.indexes i ON i.object_id = ic.object_id AND i.index_id = ic.index_id AND i.is_primary_key = 1) k "
            f"ON k.object_id = c.object_id AND k.column_id = c.column_id WHERE c.object_id = OBJECT_ID({at}) AND c.is_computed = 0"
        )

    def spec(self, key: str, exclude: tuple[str, ...] = ()) -> TableSpec:
        schema, name = split_name(key)
        rows = self.query(self.columns_sql(key)).collect()
        return TableSpec(schema, name, tuple(ColumnSpec(r["n"], r["kind"], bool(r["nullable"]), r["k"], r["p"], r["s"]) for r in rows), exclude)

    def current_version(self) -> int:
        return self.query("SELECT CHANGE_TRACKING_CURRENT_VERSION() AS v").first()["v"] or 0

    def min_valid_version(self, key: str) -> int | None:
        return self.query(f"SELECT CHANGE_TRACKING_MIN_VALID_VERSION(OBJECT_ID({literal(table_sql(key))})) AS v").first()["v"]

    def base_sql(self, spec: TableSpec) -> str:
        return f"(SELECT {', '.join(read_sql(c.name, c.sql_type) for c in spec.columns)} FROM {table_sql(spec.key)}) AS base"

    def base(self, key: str) -> DataFrame:
        return self.spark.read.format("jdbc").options(**self.options).option("dbtable", self.base_sql(self.spec(key))).load()

    def changes_sql(self, spec: TableSpec, last: int, current: int) -> str:
        pk = ", ".join(f"CT.{bracketed(c)}" for c in spec.pk)
        return f"SELECT {pk}, CT.SYS_CHANGE_VERSION AS version FROM CHANGETABLE(CHANGES {table_sql(spec.key)}, {int(last)}) CT WHERE CT.SYS_CHANGE_VERSION <= {int(current)}"

    def changes(self, key: str, last: int, current: int) -> DataFrame:
        return self.query(self.changes_sql(self.spec(key), last, current))

    def approx_rows(self, key: str) -> int:
        return self.query(f"SELECT SUM(rows) AS n FROM sys.partitions WHERE object_id = OBJECT_ID({literal(table_sql(key))}) AND index_id IN (0, 1)").first()["n"] or 0
