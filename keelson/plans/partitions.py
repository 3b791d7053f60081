"""Ranges of keys: of an integer key by arithmetic, of any key, composite ones too, by splitters."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.keys import cursor_values, keyset_after

Range = tuple[int | None, int | None]


def plan_ranges(low: int | None, high: int | None, rows: int, most: int, rows_per_range: int) -> list[Range]:
    """Contiguous half-open ranges, open at both ends so that rows which appear outside low..high are covered too.

    As many as rows / rows_per_range, `most`, and the number of keys allow; one open range if that is one or nothing is known.
    """
    if low is None or high is None:
        return [(None, None)]
    keys = high - low + 1
    n = max(1, min(most, rows // max(1, rows_per_range), keys))
    edges = [None, *(low + keys * i // n for i in range(1, n)), None]
    return list(zip(edges, edges[1:], strict=False))


def in_range(column: str, bounds: Range) -> Column:
    low, high = bounds
    c = F.col(f"`{column}`")
    tests = ([c >= F.lit(low)] if low is not None else []) + ([c < F.lit(high)] if high is not None else [])
    return reduce(Column.__and__, tests) if tests else F.lit(True)


def range_number(column: Column, ranges: list[Range]) -> Column:
    """The index of the range that holds a key, as one expression."""
    out = F.lit(len(ranges) - 1)
    for i in range(len(ranges) - 2, -1, -1):
        out = F.when(column < F.lit(ranges[i][1]), F.lit(i)).otherwise(out)
    return out


def jdbc_predicates(column: str, ranges: list[Range]) -> list[str]:
    """One predicate per range for spark.read.jdbc(predicates=...)."""
    return [" AND ".join(([f"{column} >= {a}"] if a is not None else []) + ([f"{column} < {z}"] if z is not None else [])) or "1=1" for a, z in ranges]


def typed(value: Any, kind: T.DataType) -> Column:
    """A bound as a manifest or a state holds it (text for all but numbers) as a literal of the key's type."""
    return F.unhex(F.lit(value)) if isinstance(kind, T.BinaryType) else F.lit(value).cast(kind)


def between(key: Column, kind: T.DataType, low: Any, high: Any) -> Column:
    """low <= key < high; None is open."""
    tests = ([key >= typed(low, kind)] if low is not None else []) + ([key < typed(high, kind)] if high is not None else [])
    return reduce(Column.__and__, tests) if tests else F.lit(True)


def range_index(key: Column, kind: T.DataType, edges: Sequence[Any]) -> Column:
    """The number of edges at or below a key, found by halving: a tree of conditions as deep as the logarithm of their number."""

    def find(a: int, z: int) -> Column:
        if a == z:
            return F.lit(a)
        mid = (a + z) // 2
        return F.when(key < typed(edges[mid], kind), find(a, mid)).otherwise(find(mid + 1, z))

    return find(0, len(edges))


def splitters(base: DataFrame, pk: Sequence[str], ranges: int, rows: int, per_range: int = 200) -> list[list[str]]:
    """Keys, as text, that cut a table into ranges of about equal size: every so-many-th of a sample of keys.

    The sample takes keys by a hash, `per_range` for each range whatever the table's size, so it is the same each time. One pass
    over the key columns; ranges only balance the work, so a sample is enough.
    """
    if ranges < 2:
        return []
    keys = [F.col(f"`{c}`") for c in pk]
    share = min(1.0, ranges * per_range / max(1, rows))
    picked = base.select(*keys) if share == 1.0 else base.select(*keys).where(F.pmod(F.xxhash64(*keys), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    text = [(F.hex(k) if isinstance(base.schema[c].dataType, T.BinaryType) else k.cast("string")).alias(f"k{i}") for i, (c, k) in enumerate(zip(pk, keys, strict=True))]
    sample = picked.orderBy(*keys).select(*text).collect()  # about ranges x per_range short rows
    cuts = [list(sample[len(sample) * i // ranges]) for i in range(1, ranges)] if sample else []
    return [c for i, c in enumerate(cuts) if i == 0 or c != cuts[i - 1]]


def in_key_range(base: DataFrame, pk: Sequence[str], low: Sequence[str] | None, high: Sequence[str] | None) -> Column:
    """low <= key < high in key order, for keys of any width; None is open. The first column's own bounds stand apart, so that scans can prune by them."""
    tests = []
    first = F.col(f"`{pk[0]}`")
    for cursor, above in ((low, True), (high, False)):
        if cursor is None:
            continue
        values = cursor_values(base, pk, cursor)
        at_or_behind = keyset_after(pk, values) | reduce(Column.__and__, [F.col(f"`{c}`") == v for c, v in zip(pk, values, strict=True)])
        tests += [first >= values[0], at_or_behind] if above else [first <= values[0], ~at_or_behind]
    return reduce(Column.__and__, tests) if tests else F.lit(True)
