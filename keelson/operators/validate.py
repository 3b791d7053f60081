"""Reconciliation of a source with its target: counts, key bounds, aggregates, hash buckets, a sample."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.plans.partitions import range_index


def normalize(name: str, kind: T.DataType) -> Column:
    """A column's value as text that does not depend on engine or session; null becomes a marker no value has."""
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        text = F.round(c.cast("double") * 100).cast("bigint").cast("string")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, T.BinaryType):
        text = F.lower(F.hex(c))
    elif isinstance(kind, T.BooleanType):
        text = F.when(c, "1").otherwise("0")
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit("\u0000")).otherwise(text)


def row_hash(df: DataFrame, columns: list[str]) -> Column:
    """The first 32 bits of the MD5 of a row's normalised values, as a number that can be summed in any order."""
    text = F.concat_ws("|", *[normalize(c, df.schema[c].dataType) for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def check_row_count(source: DataFrame, target: DataFrame) -> DataFrame:
    a = source.agg(F.count(F.lit(1)).alias("source_rows"))
    b = target.agg(F.count(F.lit(1)).alias("target_rows"))
    return a.join(b).withColumn("match", F.col("source_rows") == F.col("target_rows"))  # one row each


def check_pk_bounds(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    both = [d.agg(F.min(key).alias(f"{n}_min"), F.max(key).alias(f"{n}_max")) for n, d in (("source", source), ("target", target))]
    return both[0].join(both[1]).withColumn("match", F.col("source_min").eqNullSafe(F.col("target_min")) & F.col("source_max").eqNullSafe(F.col("target_max")))


def aggregates(df: DataFrame, side: str, columns: list[str]) -> DataFrame:
    """column, side, nulls, low, high, total in one pass; totals of numbers in hundredths, so that they are exact."""
    aggs = []
    for c in columns:
        number = isinstance(df.schema[c].dataType, T.NumericType)
        x = F.col(f"`{c}`")
        total = F.sum(F.round(x * 100).cast("bigint")) if number else F.lit(None).cast("bigint")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count_if(x.isNull()).alias("nulls"), F.min(normalize(c, df.schema[c].dataType)).alias("low"), F.max(normalize(c, df.schema[c].dataType)).alias("high"), total.alias("total")).alias(f"a{len(aggs)}"))
    one = df.agg(*aggs)
    return one.select(F.explode(F.array(*[F.col(c) for c in one.columns])).alias("a")).select(F.lit(side).alias("side"), "a.*")


def check_aggregates(source: DataFrame, target: DataFrame, columns: list[str]) -> DataFrame:
    a, b = aggregates(source, "s", columns).alias("s"), aggregates(target, "t", columns).alias("t")
    same = reduce(Column.__and__, [F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}")) for c in ("nulls", "low", "high", "total")])
    return a.join(b, "column").select("column", same.alias("match"), F.col("s.total").alias("source_total"), F.col("t.total").alias("target_total"))


def hash_buckets(df: DataFrame, key: str, columns: list[str], buckets: int) -> DataFrame:
    return df.groupBy(F.pmod(F.col(key), F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("rows"), F.sum(row_hash(df, columns)).alias("hash"))


def check_hash_buckets(source: DataFrame, target: DataFrame, key: str, columns: list[str], buckets: int = 64) -> DataFrame:
    """bucket, rows and match; both sides shrink to `buckets` rows before they meet."""
    a, b = hash_buckets(source, key, columns, buckets).alias("s"), hash_buckets(target, key, columns, buckets).alias("t")
    return a.join(b, "bucket", "full").select("bucket", F.col("s.rows").alias("source_rows"), F.col("t.rows").alias("target_rows"), (F.col("s.rows").eqNullSafe(F.col("t.rows")) & F.col("s.hash").eqNullSafe(F.col("t.hash"))).alias("match"))


def check_sample(source: DataFrame, target: DataFrame, key: str, columns: list[str], one_in: int = 100) -> DataFrame:
    """Differences among the keys whose hash falls into a one_in-th: key and what is wrong. The sample is the same on both sides."""

    def chosen(df: DataFrame, name: str) -> DataFrame:
        part = df.where(F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(one_in)) == 0)
        return part.select(F.col(key).alias(f"{name}_key"), row_hash(part, columns).alias(f"{name}_hash"))

    both = chosen(source, "s").join(chosen(target, "t"), F.col("s_key") == F.col("t_key"), "full")
    what = F.when(F.col("t_key").isNull(), "missing").when(F.col("s_key").isNull(), "extra").when(F.col("s_hash") != F.col("t_hash"), "different")
    return both.select(F.coalesce("s_key", "t_key").alias("key"), what.alias("problem")).where("problem is not null")


def diff_by_tree(source: DataFrame, target: DataFrame, key: str, columns: list[str], fan: int = 16, leaf_rows: int = 10_000, most: int = 256) -> DataFrame:
    """All keys that are missing in the target, extra there, or different: key, problem.

    A tree of hashes over ranges of an integer key, descended only where the sides differ: a level cuts every range that
    differs into `fan` parts and compares rows and hash sums of the parts, both sides reading these ranges only. Ranges of at
    most leaf_rows rows, or all that are left when there are more than `most`, are compared row by row.
    """
    ends = [key_ends(d, key) for d in (source, target)]
    known = [e for e in ends if e[0] is not None]
    ranges = [(min(e[0] for e in known), max(e[1] for e in known) + 1)] if known else []
    leaves: list[tuple[int, int]] = []
    while ranges and len(ranges) + len(leaves) <= most:
        parts = sorted({(low + (high - low) * i // fan, low + (high - low) * (i + 1) // fan) for low, high in ranges for i in range(fan)})
        parts = [p for p in parts if p[0] < p[1]]
        a, b = (_by_range(d, key, columns, parts, n) for d, n in ((source, "s"), (target, "t")))
        both = a.join(b, "part", "full").where(~(F.col("s_rows").eqNullSafe(F.col("t_rows")) & F.col("s_hash").eqNullSafe(F.col("t_hash"))))
        ranges = []
        for r in both.collect():  # fan x most rows at most
            low, high = parts[r["part"]]
            (leaves if high - low == 1 or max(r["s_rows"] or 0, r["t_rows"] or 0) <= leaf_rows else ranges).append((low, high))
    return _compared(source, target, key, columns, _joined(ranges + leaves))


def key_ends(df: DataFrame, key: str) -> tuple:
    return tuple(df.agg(F.min(key), F.max(key)).first())


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring ranges as one."""
    out: list[tuple[int, int]] = []
    for low, high in sorted(ranges):
        if out and out[-1][1] == low:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    return out


def _inside(key: str, ranges: list[tuple[int, int]]) -> Column:
    return reduce(Column.__or__, [(F.col(f"`{key}`") >= a) & (F.col(f"`{key}`") < z) for a, z in _joined(ranges)], F.lit(False))


def _by_range(df: DataFrame, key: str, columns: list[str], parts: list[tuple[int, int]], name: str) -> DataFrame:
    part = range_index(F.col(f"`{key}`"), T.LongType(), [p[0] for p in parts[1:]]).alias("part")
    return df.where(_inside(key, parts)).groupBy(part).agg(F.count(F.lit(1)).alias(f"{name}_rows"), F.sum(row_hash(df, columns)).alias(f"{name}_hash"))


def _compared(source: DataFrame, target: DataFrame, key: str, columns: list[str], ranges: list[tuple[int, int]]) -> DataFrame:
    sides = [d.where(_inside(key, ranges)).select(F.col(key).alias(f"{n}_key"), row_hash(d, columns).alias(f"{n}_hash")) for d, n in ((source, "s"), (target, "t"))]
    what = F.when(F.col("t_key").isNull(), "missing").when(F.col("s_key").isNull(), "extra").when(F.col("s_hash") != F.col("t_hash"), "different")
    both = sides[0].join(sides[1], F.col("s_key") == F.col("t_key"), "full")
    return both.select(F.coalesce("s_key", "t_key").alias("key"), what.alias("problem")).where("problem is not null")


def validate(source: DataFrame, target: DataFrame, key: str, columns: list[str] | None = None) -> DataFrame:
    """check, match for all checks of a table."""
    columns = columns or [c for c in source.columns if c in target.columns]
    parts = [
        check_row_count(source, target).select(F.lit("row_count").alias("check"), "match"),
        check_pk_bounds(source, target, key).select(F.lit("pk_bounds").alias("check"), "match"),
        check_aggregates(source, target, columns).agg(F.bool_and("match").alias("match")).select(F.lit("aggregates").alias("check"), "match"),
        check_hash_buckets(source, target, key, columns).agg(F.bool_and("match").alias("match")).select(F.lit("hash_buckets").alias("check"), "match"),
        check_sample(source, target, key, columns).agg((F.count(F.lit(1)) == 0).alias("match")).select(F.lit("sample").alias("check"), "match"),
    ]
    return reduce(DataFrame.unionByName, parts)
