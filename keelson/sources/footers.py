"""Facts from Parquet footers: rows, packed and raw bytes of files, and the least and greatest value of a column in each.

Few files are read where the caller is; more of them by a Spark job, a slice of paths a task. No row group is opened.
"""

from __future__ import annotations

import datetime
import json
import logging
import re
from collections.abc import Iterator
from typing import Any, NamedTuple
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

#: Files whose footers the driver reads by itself.
FEW_FILES = 32


class FileFacts(NamedTuple):
    path: str
    rows: int
    packed: int
    raw: int
    low: Any = None  # encoded by plain(); None with rows: not known
    high: Any = None


def file_system(path: str):
    """Arrow's file system for a path and the path in it; file: and plain paths are local or mounted."""
    from pyarrow import fs

    if "://" in path and not path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", path)


def plain(value: Any) -> Any:
    """A key value as JSON can hold it, in the same order as the values; None for types without one."""
    if isinstance(value, (bool, int, str)):
        return value
    if isinstance(value, (datetime.date, datetime.datetime)):
        return value.isoformat()
    return value.hex() if isinstance(value, bytes) else None


def read_footer(path: str, column: str | None = None) -> FileFacts:
    import pyarrow.parquet as pq

    system, inner = file_system(path)
    with system.open_input_file(inner) as f:
        meta = pq.read_metadata(f)
    groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
    groups = [g for g in groups if g.num_rows]
    raw = sum(g.total_byte_size for g in groups)
    packed = sum(g.column(c).total_compressed_size for g in groups for c in range(g.num_columns))
    low = high = None
    if column and groups:
        at = next((c for c in range(groups[0].num_columns) if groups[0].column(c).path_in_schema == column), None)
        stats = [g.column(at).statistics for g in groups] if at is not None else [None]
        if all(s is not None and s.has_min_max for s in stats):
            low, high = min(plain(s.min) for s in stats) if plain(stats[0].min) is not None else None, max(plain(s.max) for s in stats) if plain(stats[0].max) is not None else None
    return FileFacts(path, meta.num_rows, packed, raw, low, high)


_SCHEMA = pa.schema([("path", pa.string()), ("rows", pa.int64()), ("packed", pa.int64()), ("raw", pa.int64()), ("bounds", pa.string())])


def footer_frame(spark: SparkSession, paths: list[str], column: str | None = None) -> DataFrame:
    """path, rows, packed and raw bytes of Parquet files, and the bounds of a column as JSON, read by tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(*f[:4], json.dumps(f[4:])) for f in (read_footer(p, column) for p in b.column(0).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], f.type) for i, f in enumerate(_SCHEMA)], schema=_SCHEMA)

    given = spark.createDataFrame([(p,) for p in paths], "path string")
    return given.repartition(max(1, min(len(paths), spark.sparkContext.defaultParallelism * 4))).mapInArrow(run, "path string, rows long, packed long, raw long, bounds string")


def facts(spark: SparkSession, paths: list[str], column: str) -> list[FileFacts]:
    """The facts of files with the bounds of a column. Many footers are read by a Spark job; what comes back is a line a file, as a manifest holds it.

    On a file system that only Spark's readers open, a scan of the column tells rows and bounds, and the file's length stands for its bytes.
    """
    try:
        if len(paths) <= FEW_FILES:
            return [read_footer(p, column) for p in paths]
        file_system(paths[0])
    except (OSError, ImportError, pa.ArrowException) as e:
        log.info("footers are out of reach here (%s), scanning %s", e, column)
        return _scanned(spark, paths, column)
    return [FileFacts(r["path"], r["rows"], r["packed"], r["raw"], *json.loads(r["bounds"])) for r in footer_frame(spark, paths, column).collect()]


def _scanned(spark: SparkSession, paths: list[str], column: str) -> list[FileFacts]:
    seen = spark.read.option("recursiveFileLookup", True).parquet(*paths).groupBy("_metadata.file_path", "_metadata.file_size").agg(F.count(F.lit(1)).alias("n"), F.min(column).alias("a"), F.max(column).alias("z"))
    return [FileFacts(unquote(r["file_path"]), r["n"], r["file_size"], r["file_size"], None if r["a"] is None else plain(r["a"]), None if r["z"] is None else plain(r["z"])) for r in seen.collect()]
