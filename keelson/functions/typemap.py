"""Source column types to Spark: type, conversion of the raw column, and the value a tombstone holds in a NOT NULL column.

Timestamps are stored as timestamp_ntz in UTC, so no session time zone can shift them. Dates and timestamps are clamped
to 1900-01-01 .. 2299-12-31 by CASE, which leaves null null (least and greatest would not). Binary stays binary.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

log = logging.getLogger(__name__)
LOWEST, HIGHEST = "1900-01-01", "2299-12-31"
EPOCH = "1970-01-01"
NIL_UUID = "00000000-0000-0000-0000-000000000000"
INTEGER_TYPES = frozenset({"tinyint", "smallint", "int", "bigint"})


@dataclass(frozen=True)
class Mapping:
    spark_type: T.DataType
    convert: Callable[[Column], Column]
    tombstone: object

    def tombstone_column(self) -> Column:
        return F.lit(self.tombstone).cast(self.spark_type)


def clamp(c: Column, kind: str) -> Column:
    low, high = F.lit(LOWEST).cast(kind), F.lit(HIGHEST if kind == "date" else f"{HIGHEST} 23:59:59.999").cast(kind)
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def _timestamp(digits: int) -> Callable[[Column], Column]:
    def convert(c: Column) -> Column:
        c = c.cast("timestamp_ntz")
        if digits < 6:  # Spark keeps six digits; a seventh is cut by the cast
            below = F.pmod((F.date_part(F.lit("SECOND"), c) * 1_000_000).cast("bigint"), F.lit(10 ** (6 - digits)))
            c = c - F.make_dt_interval(secs=(below / 1_000_000).cast("decimal(18,6)"))
        return clamp(c, "timestamp_ntz")

    return convert


def offset_to_utc(c: Column) -> Column:
    """A date, time and offset in text ('2026-01-01 00:00:00.000 +05:30') as UTC; timestamps pass through."""
    text = c.cast("string")
    offset = F.regexp_extract(text, r"([+-]\d{2}:\d{2})$", 1)
    local = F.regexp_replace(text, r"\s*[+-]\d{2}:\d{2}$", "").cast("timestamp_ntz")
    minutes = F.when(offset == "", F.lit(0)).otherwise(
        F.concat(F.substring(offset, 1, 1), F.lit("1")).try_cast("int") * (F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int"))
    )
    return local - F.make_dt_interval(mins=minutes)


def _plain(kind: T.DataType, placeholder: object) -> Callable[..., Mapping]:
    """Builds the mapping to a type that a cast alone reaches."""
    return lambda p, s: Mapping(kind, lambda c: c.cast(kind), placeholder)


def _number(p: int | None, s: int | None) -> Mapping:
    return _plain(T.DecimalType(p or 18, s or 0), 0)(p, s)


def _floating(p: int | None, s: int | None) -> Mapping:
    return _plain(T.FloatType() if (p or 53) <= 24 else T.DoubleType(), 0)(p, s)


def _instant(p: int | None, s: int | None) -> Mapping:
    return Mapping(T.TimestampNTZType(), _timestamp(min(max(7 if s is None else s, 0), 7)), EPOCH)


def _instant_with_offset(p: int | None, s: int | None) -> Mapping:
    local = _instant(p, s)
    return Mapping(local.spark_type, lambda c: local.convert(offset_to_utc(c)), EPOCH)


_TEXT, _BYTES, _MILLIS = _plain(T.StringType(), ""), _plain(T.BinaryType(), b""), lambda p, s: _instant(p, 3)
#: Source types by name (a fixed list) and how the mapping of each is built from precision and scale.
TYPES: dict[str, Callable[[int | None, int | None], Mapping]] = {
    "bigint": _plain(T.LongType(), 0),
    "binary": _BYTES,
    "bit": _plain(T.BooleanType(), False),
    "date": lambda p, s: Mapping(T.DateType(), lambda c: clamp(c.cast("date"), "date"), EPOCH),
    "datetime": _MILLIS,
    "datetime2": _instant,
    "datetimeoffset": _instant_with_offset,
    "decimal": _number,
    "float": _floating,
    "image": _BYTES,
    "int": _plain(T.IntegerType(), 0),
    "money": lambda p, s: _number(19, 4),
    "numeric": _number,
    "real": _plain(T.FloatType(), 0),
    "rowversion": lambda p, s: Mapping(T.LongType(), lambda c: F.conv(F.hex(c), 16, 10).cast("bigint"), 0),
    "smalldatetime": _MILLIS,
    "smallint": _plain(T.ShortType(), 0),
    "smallmoney": lambda p, s: _number(10, 4),
    "time": lambda p, s: Mapping(T.StringType(), lambda c: F.substring(c.cast("string"), 1, 16), ""),
    "tinyint": _plain(T.ShortType(), 0),  # unsigned there, Spark's is not
    "uniqueidentifier": lambda p, s: Mapping(T.StringType(), lambda c: F.lower(c.cast("string")), NIL_UUID),
    "varbinary": _BYTES,
}
TYPES["timestamp"] = TYPES["rowversion"]
TYPES |= dict.fromkeys(("char", "varchar", "nchar", "nvarchar", "sysname", "text", "ntext", "xml", "sql_variant", "hierarchyid", "geography", "geometry"), _TEXT)


def mapping(sql_type: str, precision: int | None = None, scale: int | None = None) -> Mapping:
    """The mapping of a source type, given by name with its precision and scale; unknown types become text with a warning."""
    build = TYPES.get(sql_type.lower())
    if build is None:
        log.warning("no mapping for type %s, it is read as text", sql_type)
    return (build or _TEXT)(precision, scale)


#: Digits of whole numbers, from narrow to wide.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def widens(old: T.DataType, new: T.DataType) -> bool:
    """Whether Parquet files with a column of the old type can be read as the new one without loss."""
    whole = list(_DIGITS)
    if type(old) in _DIGITS:
        if type(new) in _DIGITS:
            return whole.index(type(old)) <= whole.index(type(new))
        if isinstance(new, T.DecimalType):
            return not isinstance(old, T.LongType) and new.precision - new.scale >= _DIGITS[type(old)]
        return isinstance(new, T.DoubleType) and not isinstance(old, T.LongType)
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return isinstance(old, T.FloatType) and isinstance(new, T.DoubleType) or isinstance(old, T.DateType) and isinstance(new, T.TimestampNTZType)
