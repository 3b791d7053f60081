"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words, as a character class of Java and Python patterns.
BLANKS = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, which the cluster names in spark.checkpoint.dir. On a local master that
    names none (tests) it is a temporary one, deleted when the process ends; elsewhere its absence is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="keelson-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = "file://" + folder
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/keelson-{name}-{uuid.uuid4().hex[:12]}"


def cut(df: DataFrame) -> DataFrame:
    """Materialises df in the shared folder, so that later stages don't recompute it and a lost executor costs nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def words(text: Column) -> Column:
    """The words of a text as an array; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+"), "")


def row_key(df: DataFrame) -> Column:
    """A 64-bit hash of all columns: with an id column it tells rows apart that share the id."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])


def free_name(df: DataFrame, name: str) -> str:
    """name, with underscores appended until df has no such column (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
