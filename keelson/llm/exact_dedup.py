"""Exact deduplication by a heavy-hitter split.

One pass over the texts yields a digest per row and, per partition, a Misra-Gries summary of the digests. The merged
summary names at most ``counters`` candidates; an exact count verifies them. The verified winners, a table of at most
``counters`` rows, are broadcast and their copies resolved where they lie. All other digests are rarer than
rows / (counters + 1), so an ordinary shuffle by digest has no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import cut, table

COUNTERS = 1024


def misra_gries(counts: dict, key, k: int, weight: int = 1) -> None:
    """Adds key to a summary of at most k counters; each decrement of all counters is paid for by k + 1 additions."""
    if key in counts:
        counts[key] += weight
    elif len(counts) < k:
        counts[key] = weight
    else:
        least = min(weight, min(counts.values()))
        for x in [x for x, n in counts.items() if n == least]:
            del counts[x]
        for x in counts:
            counts[x] -= least
        if weight > least:
            misra_gries(counts, key, k, weight - least)


def _digests(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summary: dict[bytes, int] = {}
        pending: dict[bytes, int] = {}

        def settle() -> None:
            for d, n in pending.items():
                misra_gries(summary, d, counters, n)
            pending.clear()

        for b in batches:
            out = []
            # bytes.lower() changes A-Z only, which in UTF-8 leaves every other character as it is
            for t in b.column(1).cast(pa.binary()):
                d = hashlib.sha256((t.as_py() or b"").lower()).digest()
                out.append(d)
                pending[d] = pending.get(d, 0) + 1
            settle()
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary()), pa.nulls(len(out), pa.int64())], ["doc_id", "digest", "seen"])
        if summary:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(summary), pa.int64()), pa.array(list(summary), pa.binary()), pa.array(list(summary.values()), pa.int64())], ["doc_id", "digest", "seen"])

    return run


def merge_summaries(summaries: DataFrame, counters: int) -> list:
    """The merged Misra-Gries summary: counters added up, the (counters + 1)-th largest subtracted, the positive rest kept."""
    top = summaries.groupBy("digest").agg(F.sum("seen").alias("n")).orderBy(F.desc("n"), "digest").limit(counters + 1).collect()
    floor = top[counters]["n"] if len(top) > counters else 0
    return [bytes(r["digest"]) for r in top if r["n"] > floor]


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    Texts are equal when identical after lower-casing A-Z; a null text counts as empty. In a group the row with the
    largest id stays; null ids are smaller than any other. Rows that repeat that largest id are the same document and
    all kept; a group of null ids only has keep_id null and all rows kept. Other columns are not read.
    """
    spark = docs.sparkSession
    seen = cut(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_digests(counters), "doc_id long, digest binary, seen long"))
    rows = seen.where("seen is null").select("doc_id", "digest")
    candidates = merge_summaries(seen.where("seen is not null"), counters)
    names = spark.createDataFrame([(x,) for x in candidates], "digest binary")
    verified = rows.join(F.broadcast(names), "digest", "left_semi").groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id"))
    least = max(2, rows.count() // (counters + 1))
    winners = spark.createDataFrame(verified.where(F.col("group_size") >= least).collect(), verified.schema)  # at most `counters` rows
    heavy = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    w = Window.partitionBy("digest")
    rest = rest.select("digest", "doc_id", F.count(F.lit(1)).over(w).alias("group_size"), F.max("doc_id").over(w).alias("keep_id"))
    return heavy.unionByName(rest).select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
FROM d
"""
