"""Changes as a stream: a source whose offset is the version, and a sink that applies micro-batches to a table store."""

from __future__ import annotations

import json
from typing import NamedTuple

import numpy as np
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from keelson.operators.changes import change_scan
from keelson.plans.model import TableSpec
from keelson.sources.footers import file_system
from keelson.sources.store import TableStore


class _Versions(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class _Group(NamedTuple):
    """A row group of a change file, by its footer."""

    path: str
    number: int
    low: int
    high: int
    rows: int


class _Reader(DataSourceStreamReader):
    """Offsets are versions. A batch takes max_rows changes at most, or one version that alone has more; without a limit all there are.

    Footers say what row groups hold; versions are read only of groups that the batch at hand may end in. Partitions get
    about equal numbers of changes.
    """

    def __init__(self, options: dict):
        self.path, self.start, self.parts = options["path"], int(options.get("start", 0)), int(options.get("parts", 4))
        self.floor, self.max_rows = options.get("floor"), int(options.get("max_rows", 0))
        self.columns = options["columns"].split(",")
        self.groups: dict[str, list[_Group]] = {}  # by file
        self.at = max(self.start, _planned(options["checkpoint"]) if options.get("checkpoint") else self.start)

    def initialOffset(self) -> dict:
        return {"v": self.start}

    def latestOffset(self) -> dict:
        self._look()
        last = max([self.at, *(g.high for gs in self.groups.values() for g in gs)])
        return {"v": self._admitted(last) if self.max_rows else last}

    def _look(self) -> None:
        """Reads the footers of files not seen yet."""
        for piece in ds.dataset(file_system(self.path)[1], format="parquet", filesystem=file_system(self.path)[0]).get_fragments():
            if piece.path not in self.groups:
                found = []
                for g in piece.row_groups:
                    stats = g.statistics.get("version", {}) if g.num_rows else {}
                    if g.num_rows and "min" not in stats:  # written without statistics
                        v = piece.subset(row_group_ids=[g.id]).to_table(columns=["version"], use_threads=False).column(0)
                        stats = pc.min_max(v).as_py()
                    if g.num_rows:
                        found.append(_Group(piece.path, g.id, stats["min"], stats["max"], g.num_rows))
                self.groups[piece.path] = found

    def _versions(self, group: _Group, low: int) -> np.ndarray:
        system = file_system(self.path)[0]
        with system.open_input_file(group.path) as f:
            v = pq.ParquetFile(f).read_row_group(group.number, columns=["version"]).column(0).to_numpy()
        return v[v > low]

    def _admitted(self, last: int) -> int:
        """The greatest version up to which there are max_rows changes at most behind the last batch."""
        waiting = sorted((g for gs in self.groups.values() for g in gs if g.high > self.at), key=lambda g: g.low)
        held = np.array([], np.int64)
        for i, g in enumerate(waiting):
            held = np.sort(np.concatenate([held, self._versions(g, self.at)]))
            if len(held) > self.max_rows:
                held = held[: np.searchsorted(held, held[self.max_rows], "right")]  # nothing behind the version that breaks the limit counts
                if i + 1 == len(waiting) or waiting[i + 1].low > held[self.max_rows]:
                    break
        if len(held) <= self.max_rows:
            return last
        over = int(held[self.max_rows])
        fit = held[held < over]
        return int(fit[-1]) if len(fit) else over

    def partitions(self, start: dict, end: dict) -> list[_Versions]:
        low, high = start["v"], end["v"]
        self.at = max(self.at, high)
        if self.floor is not None and low < int(self.floor):
            raise ValueError(f"resync required: changes are complete from version {self.floor}, the stream is at {low}")
        cuts = [low, *self._cuts(low, high), high]
        return [_Versions(a, z) for a, z in zip(cuts, cuts[1:], strict=False) if a < z]

    def _cuts(self, low: int, high: int) -> list[int]:
        """Versions between which there are about equal numbers of changes, as if those of a row group lay evenly between its bounds."""
        self._look()
        ends = []  # (version, changes from there on for each version)
        for g in (g for gs in self.groups.values() for g in gs if g.high > low and g.low <= high):
            a, z = max(g.low - 1, low), min(g.high, high)
            rate = g.rows / (g.high - g.low + 1)
            ends += [(a, rate), (z, -rate)]
        edges = sorted({v for v, _ in ends} | {low, high})
        change = dict.fromkeys(edges, 0.0)
        for v, r in ends:
            change[v] += r
        rates = np.cumsum([change[v] for v in edges[:-1]])
        mass = np.concatenate([[0.0], np.cumsum(np.maximum(rates, 0) * np.diff(edges))])
        if not mass[-1]:
            return []
        return [int(np.interp(mass[-1] * i / self.parts, mass, edges)) for i in range(1, self.parts)]

    def commit(self, end: dict) -> None:
        self.at = max(self.at, end["v"])

    def read(self, partition: _Versions):
        """Arrow batches of the versions; row groups beyond them are left out by their statistics."""
        system, inner = file_system(self.path)
        v = ds.field("version")
        yield from ds.dataset(inner, format="parquet", filesystem=system).to_batches(columns=[*self.columns, "version"], filter=(v > partition.low) & (v <= partition.high), use_threads=False)


def _planned(checkpoint: str) -> int:
    """The version up to which a query with this checkpoint has planned batches; 0 for a new one."""
    system, inner = file_system(checkpoint)
    found = system.get_file_info(fs.FileSelector(f"{inner}/offsets", allow_not_found=True))
    last = max((int(f.base_name) for f in found if f.base_name.isdigit()), default=None)
    if last is None:
        return 0
    with system.open_input_file(f"{inner}/offsets/{last}") as f:
        lines = f.read().decode("utf-8").strip().split("\n")
    return int(json.loads(lines[-1])["v"]) if lines[-1].startswith("{") else 0


class ChangeFeed(DataSource):
    """spark.readStream.format('keelson_changes'): options path, schema of the key as DDL (keys), floor, start, parts, max_rows and, with a
    limit, the checkpoint of the query, from which a restarted one takes its place."""

    @classmethod
    def name(cls) -> str:
        return "keelson_changes"

    def schema(self) -> str:
        return f"{self.options['keys']}, version long"

    def streamReader(self, schema) -> _Reader:
        names = ",".join(x.strip().split()[0] for x in self.options["keys"].split(","))
        return _Reader({**self.options, "columns": names})


def read_changes(spark: SparkSession, path: str, keys: str, **options) -> DataFrame:
    spark.dataSource.register(ChangeFeed)
    return spark.readStream.format("keelson_changes").option("keys", keys).options(**{k: str(v) for k, v in options.items()}).option("path", path).load()


def apply_stream(changes: DataFrame, base, store: TableStore, spec: TableSpec, checkpoint: str, trigger: dict | None = None):
    """Starts a query that turns each micro-batch into a batch of the live generation.

    The batch folder is named by the batch id, so a repeated micro-batch overwrites itself: exactly one effect. base() gives
    the base rows at the time of the batch; the version decides between rows, so arrival order does not matter.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch = batch.cache()
        try:
            r = batch.agg(F.count(F.lit(1)).alias("n"), F.min("version").alias("a"), F.max("version").alias("z")).first()
            if r["n"]:
                rows = change_scan(batch, base(), spec, r["a"] - 1, r["z"], seq=batch_id + 1, few_keys=r["n"])
                store.write_batch(store.live(), f"stream-{batch_id:012d}", rows)
        finally:
            batch.unpersist()

    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def apply_bounded(changes: DataFrame, base, store: TableStore, spec: TableSpec, checkpoint: str) -> list[int]:
    """Applies everything there is in bounded batches, one after the other, and ends; the input rows of each batch.

    A query that takes what is available at once plans its end only once, which a limit would make the end of it. So
    this one keeps asking until nothing is left.
    """
    query = apply_stream(changes, base, store, spec, checkpoint, {"processingTime": "0 seconds"})
    try:
        query.processAllAvailable()
        return [p["numInputRows"] for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
