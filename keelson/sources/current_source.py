"""The current relation of a stored table by name: spark.read.format("keelson").option("root", ...).load("orders").

Any session reads it, without the supervisor: schema, batches and key bounds come from the manifest. There is a partition for each
key range of the base; it reads its base files and those files of changes that may have keys of the range, and of those the
rows in it. Where no file of changes meets the range, rows stream through as they are; else a range is read in slices of
about equal size, cut at keys of a sample, so what a task holds does not grow with the range. Filters on key columns are pushed:
they choose ranges, row groups and rows; a row of a key decides alone which of its versions is live, so that is safe for keys and for
nothing else.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from keelson.plans.model import DELETED, SEQ, VERSION
from keelson.sources.footers import file_system, plain
from keelson.sources.store import BASE, _owners, _reaches, zone


#: Rows and bytes (before compression) of a slice, and keys of the sample for each slice.
SLICE_ROWS, SLICE_BYTES, SAMPLED = 100_000, 16 << 20, 200


def _text(path: str) -> str:
    system, inner = file_system(path)
    with system.open_input_file(inner) as f:
        return f.read().decode("utf-8")


class _Range(InputPartition):
    def __init__(self, low: Any, high: Any, base: list[str], changes: list[str], rows: int = 0, slices: int = 1):
        self.low, self.high, self.base, self.changes, self.rows, self.slices = low, high, base, changes, rows, slices


class _Reader(DataSourceReader):
    def __init__(self, path: str, generation: str, manifest: dict, schema: T.StructType):
        self.top, self.manifest, self.schema = f"{path}/{generation}", manifest, schema
        self.wanted: list[tuple[str, str, Any]] = []  # column, operation, value

    def pushFilters(self, filters: list[Filter]):
        """Takes comparisons of key columns with values; leaves all else to Spark."""
        names = {EqualTo: "==", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
        for f in filters:
            if type(f) in names and len(f.attribute) == 1 and f.attribute[0] in self.manifest["pk"] and f.value is not None:
                self.wanted.append((f.attribute[0], names[type(f)], list(f.value) if isinstance(f, In) else f.value))
            else:
                yield f

    def partitions(self) -> list[_Range]:
        batches = self.manifest["batches"]
        base = {b: zone(e["files"]) for b, e in batches.items() if e["level"] == BASE}
        changes = [f for e in batches.values() if e["level"] != BASE for f in e["files"]]
        groups = _owners(base) or [(None, [])]
        out = []
        for i, (low, own) in enumerate(groups):
            low, high = low if i else None, groups[i + 1][0] if i + 1 < len(groups) else None
            if self._may_have(low, high):
                met = [f for f in changes if _reaches(zone([f]), low, high)]
                mine = [f for b in own for f in batches[b]["files"] if self._file_may(f)]
                rows, size = (sum(f[k] for f in [*mine, *met]) for k in (1, 5))
                out.append(_Range(low, high, [f[0] for f in mine], [f[0] for f in met], rows, max(-(-rows // SLICE_ROWS), -(-size // SLICE_BYTES))))
        return out

    def _bounds(self) -> tuple[Any, Any]:
        """The least and greatest first key that the filters leave."""
        low = high = None
        for column, op, value in self.wanted:
            if column != self.manifest["pk"][0]:
                continue
            values = [plain(v) for v in (value if op == "in" else [value]) if v is not None]
            if not values or any(v is None for v in values):
                continue
            if op in ("==", ">", ">=", "in"):
                low = min(values) if low is None else max(low, min(values))
            if op in ("==", "<", "<=", "in"):
                high = max(values) if high is None else min(high, max(values))
        return low, high

    def _may_have(self, low: Any, high: Any) -> bool:
        a, z = self._bounds()
        return (a is None or high is None or a < high) and (z is None or low is None or z >= low)

    def _file_may(self, f: list) -> bool:
        a, z = self._bounds()
        return f[2] is None or ((a is None or f[3] >= a) and (z is None or f[2] <= z))

    def _dataset(self, files: list[str], schema):
        """Files with the columns of today: what a file lacks is null, what it has in a narrower type is widened."""
        import pyarrow.dataset as ds

        system, inner = file_system(self.top)
        return ds.dataset([f"{inner}/{f}" for f in files], schema=schema, format="parquet", filesystem=system)

    def read(self, partition: _Range):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.dataset as ds
        from pyspark.sql.pandas.types import to_arrow_schema

        full = to_arrow_schema(T.StructType.fromJson(self.manifest["schema"]))
        pk, out = self.manifest["pk"], to_arrow_schema(self.schema)
        test = None
        for column, op, value in [*self.wanted, *([(pk[0], ">=", partition.low)] if partition.low is not None else []), *([(pk[0], "<", partition.high)] if partition.high is not None else [])]:
            kind = full.field(column).type
            typed = lambda v, k=kind: pa.scalar(bytes.fromhex(v) if pa.types.is_binary(k) and isinstance(v, str) else v).cast(k)
            field = ds.field(column)
            one = field.isin(pa.array([typed(v).as_py() for v in value if v is not None], kind)) if op == "in" else {"==": field.__eq__, ">": field.__gt__, ">=": field.__ge__, "<": field.__lt__, "<=": field.__le__}[op](typed(value))
            test = one if test is None else test & one
        # one batch at a time, and of a row group what the batch needs
        scan = {"use_threads": False, "batch_size": 1 << 15, "batch_readahead": 1, "fragment_readahead": 1, "fragment_scan_options": ds.ParquetFragmentScanOptions(use_buffered_stream=True, pre_buffer=False)}
        if not partition.changes:
            if partition.base:
                live = ds.field(DELETED) == 0
                yield from self._dataset(partition.base, full).to_batches(columns=out.names, filter=live if test is None else test & live, **scan)
            return
        files = self._dataset([*partition.base, *partition.changes], full)
        cuts = _cuts(files.to_batches(columns=pk, filter=test, **scan), pk, partition.rows, partition.slices) if partition.slices > 1 else []
        for inside in _slices(cuts, pk, full):
            rows = files.to_table(filter=inside if test is None else test if inside is None else test & inside, **scan)
            rows = rows.sort_by([*[(c, "ascending") for c in pk], (VERSION, "descending"), (SEQ, "descending"), (DELETED, "descending")])
            if rows.num_rows:
                new = pa.array([True] + [False] * (rows.num_rows - 1))
                for c in pk:
                    column = rows.column(c).combine_chunks()
                    new = pc.or_(new, pa.concat_arrays([pa.array([True]), pc.not_equal(column.slice(1), column.slice(0, len(column) - 1))]))
                rows = rows.filter(pc.and_(new, pc.equal(rows.column(DELETED).combine_chunks(), 0)))
            yield from rows.select(out.names).cast(out).to_batches()


def _cuts(batches, pk: list[str], rows: int, slices: int) -> list[list]:
    """Keys, as scalars of their columns, that cut a range into about so many slices: every so-many-th of a sample that passes by."""
    import pyarrow as pa
    import pyarrow.compute as pc

    step, at, taken = max(1, rows // (slices * SAMPLED)), 0, []
    for b in batches:
        taken.append(b.take(pa.array(range(at, b.num_rows, step), pa.int64())))
        at = (at - b.num_rows) % step if at < b.num_rows else at - b.num_rows
    if not taken:
        return []
    sample = pa.Table.from_batches(taken)
    for c in pk:
        sample = sample.filter(pc.is_valid(sample[c]))
        if pa.types.is_floating(sample[c].type):
            sample = sample.filter(pc.invert(pc.is_nan(sample[c])))
    sample = sample.sort_by([(c, "ascending") for c in pk])
    cuts = [[sample[c][i] for c in pk] for i in range(SAMPLED, sample.num_rows, SAMPLED)]
    return [c for i, c in enumerate(cuts) if not i or c != cuts[i - 1]]


def _slices(cuts: list[list], pk: list[str], schema) -> list:
    """Conditions of which each row meets one: between two neighbouring keys; keys with a null or NaN are in the last slice."""
    import pyarrow as pa
    import pyarrow.dataset as ds

    if not cuts:
        return [None]
    fields = [ds.field(c) for c in pk]
    real = [pa.types.is_floating(schema.field(c).type) for c in pk]
    null = fields[0].is_null()
    for f in fields[1:]:
        null = null | f.is_null()

    def below(cut: list, k: int = 0):
        less = fields[k] < cut[k]
        return less if k == len(pk) - 1 else less | ((fields[k] == cut[k]) & below(cut, k + 1))

    def from_(cut: list, k: int = 0):
        if k == len(pk) - 1:
            return ~(fields[k] < cut[k]) if real[k] else fields[k] >= cut[k]
        return (~(fields[k] <= cut[k]) if real[k] else fields[k] > cut[k]) | ((fields[k] == cut[k]) & from_(cut, k + 1))

    inner = [from_(a) & below(z) & ~null for a, z in zip(cuts, cuts[1:], strict=False)]
    return [below(cuts[0]) & ~null, *inner, (from_(cuts[-1]) & ~null) | null]


class CurrentTable(DataSource):
    """Options: root, and the table's name as path."""

    @classmethod
    def name(cls) -> str:
        return "keelson"

    def _where(self) -> tuple[str, str, dict]:
        path = f"{self.options['root'].rstrip('/')}/{self.options['path']}"
        generation = _text(f"{path}/LIVE")
        return path, generation, json.loads(_text(f"{path}/{generation}/MANIFEST.json"))

    def schema(self) -> T.StructType:
        return T.StructType([f for f in T.StructType.fromJson(self._where()[2]["schema"]).fields if f.name not in (DELETED, SEQ)])

    def reader(self, schema: T.StructType) -> _Reader:
        return _Reader(*self._where(), schema)


def read_current(spark: SparkSession, root: str, table: str) -> DataFrame:
    spark.dataSource.register(CurrentTable)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("keelson").option("root", root).load(table)
