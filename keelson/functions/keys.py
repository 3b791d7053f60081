"""Primary keys: page cursors, resume predicate, shard owner."""

from __future__ import annotations

import zlib
from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def last_key(rows: DataFrame, columns: Sequence[str]) -> list[str] | None:
    """The greatest key of some rows as text, a page's cursor; None without rows. The schema of the rows tells the types, so the text needs no tags."""
    top = rows.agg(F.max(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("k"))
    text = lambda c: F.hex(F.col("k")[c]) if isinstance(rows.schema[c].dataType, T.BinaryType) else F.col("k")[c].cast("string")
    r = top.select(*[text(c).alias(f"k{i}") for i, c in enumerate(columns)]).first()
    return None if r is None or r[0] is None else list(r)


def cursor_values(rows: DataFrame, columns: Sequence[str], cursor: Sequence[str]) -> list[Column]:
    """A cursor as typed values."""
    kinds = [rows.schema[c].dataType for c in columns]
    return [F.unhex(F.lit(v)) if isinstance(k, T.BinaryType) else F.lit(v).cast(k) for k, v in zip(kinds, cursor, strict=True)]


def keyset_after(columns: Sequence[str], values: Sequence[Any]) -> Column:
    """Rows behind a key in key order: (a > x) or (a = x and b > y) or ...; in this form Parquet and JDBC get it pushed down."""
    terms, equal = [], F.lit(True)
    for name, value in zip(columns, values, strict=True):
        here = F.col(f"`{name}`") > F.lit(value)
        terms.append(here if not terms else equal & here)
        same = F.col(f"`{name}`") == F.lit(value)
        equal = same if len(terms) == 1 else equal & same
    return reduce(Column.__or__, terms)


def shard_owner(table_key: str, shards: int) -> int:
    return zlib.crc32(table_key.lower().encode("utf-8")) % shards


def shard_owner_column(table_key: Column, shards: int) -> Column:
    return (F.crc32(F.lower(table_key).cast("binary")) % shards).cast("int")
