"""Snapshot and change scans: versioned rows with tombstones."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.functions.keys import keyset_after
from keelson.plans.model import CHANGE, DELETED, ROW, SEQ, SYNCED_AT, VERSION, TableSpec, projection
from keelson.plans.partitions import Range, in_range

#: Changed keys up to which the base is first reduced by a broadcast semi join.
FEW_KEYS = 500_000


def snapshot_scan(base: DataFrame, spec: TableSpec, version: int, bounds: Range = (None, None), after: Sequence[Any] | None = None, seq: int = 0) -> DataFrame:
    """The mapped columns of a key range, stamped with the snapshot version; after resumes behind a key."""
    rows = base.where(in_range(spec.pk[0], bounds)) if bounds != (None, None) else base
    if after:
        rows = rows.where(keyset_after(spec.pk, after))
    return rows.select(*[projection(c, ROW) for c in spec.columns], F.lit(version).cast("bigint").alias(VERSION), F.lit(0).cast("tinyint").alias(DELETED), F.lit(seq).cast("bigint").alias(SEQ))


def net_changes(log: DataFrame, pk: list[str], last: int, current: int, version: str = "version") -> DataFrame:
    """The latest version per key in (last, current]; combined before the shuffle, so a hot key costs one row per task."""
    window = log.where((F.col(version) > last) & (F.col(version) <= current))
    return window.groupBy(*[F.col(f"`{k}`") for k in pk]).agg(F.max(version).alias(version))


def change_scan(changes: DataFrame, base: DataFrame, spec: TableSpec, last: int, current: int, version: str = "version", seq: int = 1, few_keys: int | None = None) -> DataFrame:
    """Changes with key and version joined to the present base rows: an upsert where the row exists, else a tombstone.

    The preserved side of an outer join can't be broadcast. few_keys, a checked count of the changed keys, lets the base be
    reduced by a broadcast semi join first.
    """
    net = net_changes(changes, spec.pk, last, current, version)
    if few_keys is not None and few_keys <= FEW_KEYS:
        base = base.join(F.broadcast(net.select(*spec.pk)), spec.pk, "left_semi")
    net = net.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(spec.pk)], F.col(version).alias("__v"))
    there = base.withColumn("__there", F.lit(1)).alias("t")
    match = [F.col(f"__k{i}") == F.col(f"t.`{k}`") for i, k in enumerate(spec.pk)]
    joined = net.join(there, match, "left")
    columns = []
    for c in spec.columns:
        if c.pk_ordinal:
            columns.append(c.mapping.convert(F.col(f"__k{spec.pk.index(c.name)}")).alias(c.name))
        else:
            columns.append(projection(c, CHANGE, "t"))
    gone = F.when(F.col("__there").isNull(), 1).otherwise(0).cast("tinyint")
    return joined.select(*columns, F.col("__v").cast("bigint").alias(VERSION), gone.alias(DELETED), F.lit(seq).cast("bigint").alias(SEQ))


def current(log: DataFrame, pk: list[str], keep_meta: bool = False) -> DataFrame:
    """Live rows: the last version per key (later batches win ties), then without tombstones.

    row_number() = 1 is planned with a group limit before the shuffle. Predicates on the key pass below the window to the
    scan, others must not, since they would bring back overwritten versions; Catalyst keeps to that.
    """
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in pk]).orderBy(F.desc(VERSION), F.desc(SEQ), F.desc(DELETED))
    live = log.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").where(F.col(DELETED) == 0)
    return live.drop("__rn", *([DELETED, SEQ] if keep_meta else [VERSION, DELETED, SEQ, SYNCED_AT]))


def merge_on_read(snapshot: DataFrame, changes: DataFrame, pk: list[str]) -> DataFrame:
    """current() for a snapshot with one row per key, older than all changes: unchanged rows skip window and sort."""
    kept = snapshot.join(changes.select(*pk).distinct(), pk, "left_anti").drop(VERSION, DELETED, SEQ, SYNCED_AT)
    return kept.unionByName(current(changes, pk), allowMissingColumns=True)


def union_log(*parts: DataFrame) -> DataFrame:
    """Snapshot and change batches as one log; columns that a batch lacks are null."""
    out, *rest = parts
    for p in rest:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def compact(log: DataFrame, pk: list[str], keep_tombstones: bool = False) -> DataFrame:
    """One row per key; tombstones may go once nothing older can be replayed."""
    w = Window.partitionBy(*[F.col(f"`{k}`") for k in pk]).orderBy(F.desc(VERSION), F.desc(SEQ), F.desc(DELETED))
    last = log.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")
    return last if keep_tombstones else last.where(F.col(DELETED) == 0)
