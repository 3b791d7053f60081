"""A change source for tests."""

from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession

from keelson.plans.model import TableSpec


class MemorySource:
    """Change tracking emulated in Python: rows by key, the last change of each key, one counter."""

    def __init__(self, spark: SparkSession, version: int = 0):
        self.spark, self.version = spark, version
        self.specs: dict[str, TableSpec] = {}
        self.rows: dict[str, dict[tuple, dict]] = {}
        self.log: dict[str, dict[tuple, int]] = {}
        self.floor: dict[str, int | None] = {}
        self.schemas: dict[str, str] = {}
        self.on_read = None

    def create(self, spec: TableSpec, schema: str, rows: list[dict] = ()) -> None:
        k = spec.key
        self.specs[k], self.schemas[k], self.log[k], self.floor[k] = spec, schema, {}, self.version
        self.rows[k] = {tuple(r[c] for c in spec.pk): dict(r) for r in rows}

    def upsert(self, key: str, **row) -> None:
        self.version += 1
        at = tuple(row[c] for c in self.specs[key].pk)
        self.rows[key][at] = {**self.rows[key].get(at, {}), **row}
        self.log[key][at] = self.version

    def delete(self, key: str, *at) -> None:
        self.version += 1
        self.rows[key].pop(at, None)
        self.log[key][at] = self.version

    def tables(self) -> list[str]:
        return sorted(self.specs)

    def spec(self, key: str, exclude: tuple[str, ...] = ()) -> TableSpec:
        s = self.specs[key]
        return TableSpec(s.schema, s.name, s.columns, exclude) if exclude else s

    def current_version(self) -> int:
        return self.version

    def min_valid_version(self, key: str) -> int | None:
        return self.floor[key]

    def base(self, key: str) -> DataFrame:
        names = [x.strip().split()[0] for x in self.schemas[key].split(",")]
        out = self.spark.createDataFrame([tuple(r.get(c) for c in names) for r in self.rows[key].values()], self.schemas[key])
        if self.on_read:
            hook, self.on_read = self.on_read, None
            hook()
        return out

    def changes(self, key: str, last: int, current: int) -> DataFrame:
        pk = self.specs[key].pk
        kinds = dict(x.strip().split(None, 1) for x in self.schemas[key].split(","))
        rows = [(*k, v) for k, v in self.log[key].items() if last < v <= current]
        return self.spark.createDataFrame(rows, ", ".join([f"{c} {kinds[c]}" for c in pk] + ["version long"]))

    def approx_rows(self, key: str) -> int:
        return len(self.rows[key])

    def session(self, key: str):
        return nullcontext(self)

    def probe(self) -> None:
        """Nothing to allow."""
