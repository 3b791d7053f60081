"""Tables and columns of a source, and the names derived from them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.typemap import INTEGER_TYPES, Mapping, mapping

VERSION, DELETED, SEQ, SYNCED_AT = "_version", "_is_deleted", "_seq", "_synced_at"


class SchemaError(ValueError):
    pass


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    sql_type: str
    nullable: bool = True
    pk_ordinal: int = 0
    precision: int | None = None
    scale: int | None = None

    @property
    def mapping(self) -> Mapping:
        return mapping(self.sql_type, self.precision, self.scale)

    @property
    def target_nullable(self) -> bool:
        return self.nullable and not self.pk_ordinal


#: Roles of a row: as it stands in the table, or as what a change found of it.
ROW, CHANGE = "row", "change"


def projection(column: ColumnSpec, role: str, source: str | None = None) -> Column:
    """The converted column of a row in a role. A change may find no row; columns that can't be null then hold their type's placeholder."""
    place = f"{source}.`{column.name}`" if source else f"`{column.name}`"
    value = column.mapping.convert(F.col(place))
    filled = role == CHANGE and not column.target_nullable
    return (F.coalesce(value, column.mapping.tombstone_column()) if filled else value).alias(column.name)


@dataclass(frozen=True)
class TableSpec:
    schema: str
    name: str
    columns: tuple[ColumnSpec, ...]
    exclude: tuple[str, ...] = field(default=())

    def __post_init__(self):
        gone = {x.lower() for x in self.exclude}
        known = {c.name.lower() for c in self.columns}
        if missing := gone - known:
            raise SchemaError(f"{self.key}: no column {sorted(missing)} to exclude")
        if any(c.pk_ordinal and c.name.lower() in gone for c in self.columns):
            raise SchemaError(f"{self.key}: a key column can't be excluded")
        object.__setattr__(self, "columns", tuple(c for c in self.columns if c.name.lower() not in gone))
        if not self.pk:
            raise SchemaError(f"{self.key}: no primary key")

    @property
    def key(self) -> str:
        return f"{self.schema}.{self.name}"

    @property
    def pk(self) -> list[str]:
        return [c.name for c in sorted((c for c in self.columns if c.pk_ordinal), key=lambda c: c.pk_ordinal)]

    def single_integer_pk(self) -> str | None:
        """The key column if the table can be snapshot in ranges of it."""
        return self.pk[0] if len(self.pk) == 1 and next(c for c in self.columns if c.pk_ordinal).sql_type.lower() in INTEGER_TYPES else None

    def struct(self) -> T.StructType:
        own = [T.StructField(c.name, c.mapping.spark_type, c.target_nullable) for c in self.columns]
        return T.StructType([*own, T.StructField(VERSION, T.LongType(), False), T.StructField(DELETED, T.ByteType(), False), T.StructField(SEQ, T.LongType(), False), T.StructField(SYNCED_AT, T.TimestampNTZType(), True)])


def spec_of(df: DataFrame, name: str, pk: list[str], schema: str = "dbo", not_null: tuple[str, ...] = (), exclude: tuple[str, ...] = ()) -> TableSpec:
    """The table that a DataFrame with a declared key describes."""
    names = {
        T.BooleanType: "bit", T.ByteType: "smallint", T.ShortType: "smallint", T.IntegerType: "int", T.LongType: "bigint", T.FloatType: "real", T.DoubleType: "float", T.DateType: "date",
        T.TimestampNTZType: "datetime2", T.TimestampType: "datetime2", T.BinaryType: "varbinary", T.StringType: "nvarchar",
    }
    out = []
    for f in df.schema.fields:
        p, s = (f.dataType.precision, f.dataType.scale) if isinstance(f.dataType, T.DecimalType) else (None, None)
        kind = "decimal" if isinstance(f.dataType, T.DecimalType) else names.get(type(f.dataType), f.dataType.simpleString())
        ordinal = pk.index(f.name) + 1 if f.name in pk else 0
        out.append(ColumnSpec(f.name, kind, not (ordinal or f.name in not_null), ordinal, p, s))
    if missing := set(pk) - set(df.columns):
        raise SchemaError(f"{schema}.{name}: no key column {sorted(missing)}")
    return TableSpec(schema, name, tuple(out), exclude)


def split_name(source: str, default_schema: str = "dbo") -> tuple[str, str]:
    """'[sales].[Lines]' or 'Lines' to schema and table."""
    parts = [p.strip().removeprefix("[").removesuffix("]") for p in source.split(".")]
    if len(parts) > 2 or not all(parts):
        raise SchemaError(f"not a table name: {source}")
    return (default_schema, parts[0]) if len(parts) == 1 else (parts[0], parts[1])


def target_name(source: str, target: str | None = None, default_schema: str = "dbo") -> str:
    schema, name = split_name(source, default_schema)
    return target or (name if schema.lower() == default_schema else f"{schema}_{name}")
