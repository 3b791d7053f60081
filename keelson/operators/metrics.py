"""Run metrics from the sync log, reports by table, and counts by phase."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_metrics(log: DataFrame) -> DataFrame:
    """By table: distinct snapshot parts, rows and errors, and the seconds from the first part's start to the last one's end.

    log: table_key, task, status, rows, duration_ms, ts. Where no part matches, the seconds are null.
    """
    part = F.col("task").startswith("snapshot[") & (F.col("status") == "ok")
    began = F.col("ts") - F.make_dt_interval(secs=F.col("duration_ms") / 1000)
    first, last = F.min(F.when(part, began)), F.max(F.when(part, F.col("ts")))
    return log.groupBy("table_key").agg(
        F.count_distinct(F.when(part, F.col("task"))).alias("parts"),
        F.coalesce(F.sum(F.when(part, F.col("rows"))), F.lit(0)).alias("rows"),
        F.count_if(F.col("status") == "error").alias("errors"),
        (F.timestamp_diff("MILLISECOND", first, last) / 1000).alias("seconds"),
    )


def hourly_errors(log: DataFrame, now: Column, keep_days: int = 30) -> DataFrame:
    """Errors by hour, latest first, over the days that are kept."""
    kept = log.where(F.col("ts") >= now - F.make_dt_interval(days=F.lit(keep_days)))
    return kept.groupBy(F.date_trunc("HOUR", "ts").alias("hour")).agg(F.count_if(F.col("status") == "error").alias("errors"), F.count(F.lit(1)).alias("tasks")).orderBy(F.desc("hour"))


def latest_requests(requests: DataFrame, action: str) -> DataFrame:
    return requests.where(F.col("action") == action).groupBy("table_key").agg(F.max("requested_at").alias("requested_at"))


def latest_states(states: DataFrame) -> DataFrame:
    """The last row of every table of a state log."""
    rest = [c for c in states.columns if c not in ("table_key", "ts")]
    return states.groupBy("table_key").agg(*[F.max_by(c, "ts").alias(c) for c in rest], F.max("ts").alias("ts"))


def phase_counts(states: DataFrame) -> DataFrame:
    return states.groupBy("phase").agg(F.count(F.lit(1)).alias("tables"), F.count_if(F.coalesce(F.col("last_error"), F.lit("")) != "").alias("errors"), F.coalesce(F.sum("rows_synced"), F.lit(0)).alias("rows"))


def run_report(plan: DataFrame, timing: DataFrame, storage: DataFrame) -> DataFrame:
    """Plan (table_key, source_rows, target_rows), snapshot timing and storage side by side; ratios are null where nothing can be divided."""
    key = F.lower("table_key").alias("k")
    t = timing.select(key, F.col("seconds"), F.col("parts"))
    s = storage.select(key, "files", "bytes", "raw_bytes")
    out = plan.withColumn("k", F.lower("table_key")).join(t, "k", "left").join(s, "k", "left").drop("k")
    return out.withColumns({"match": F.col("source_rows").eqNullSafe(F.col("target_rows")), "rows_per_second": F.try_divide(F.col("target_rows"), F.col("seconds")), "compression": F.try_divide(F.col("raw_bytes"), F.col("bytes"))})


def lag(states: DataFrame, commits: DataFrame, now: Column) -> DataFrame:
    """How far each table is behind: states (table_key, last_version), commits (table_key, version, committed_at).

    table_key, last_version, newest_version, versions_behind, applied_at (commit time of the newest version that is applied),
    waiting_since (that of the oldest that is not) and lag_seconds: since when a committed change waits, 0 if none does. The look-up
    of the commit at or before a version is an aggregate over the index of commits, combined before the shuffle; states
    are a row a table.
    """
    both = commits.join(states.select("table_key", "last_version"), "table_key")
    done = F.col("version") <= F.col("last_version")
    out = both.groupBy("table_key").agg(
        F.first("last_version").alias("last_version"), F.max("version").alias("newest_version"), F.count_if(~done).alias("versions_behind"),
        F.max_by(F.when(done, F.col("committed_at")), F.when(done, F.col("version"))).alias("applied_at"), F.min(F.when(~done, F.col("committed_at"))).alias("waiting_since"),
    )
    return out.withColumn("lag_seconds", F.coalesce(F.timestamp_diff("SECOND", F.col("waiting_since"), now), F.lit(0)))
