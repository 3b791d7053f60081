"""Queries over the test tables, each through the library's operators, with the SQL that says the same.

The derived feed of orders: a snapshot at version 1000 and, for every key, change 1001 + o_orderkey - a delete where the
key divides by 11, else an update (status X, price doubled) where it divides by 7.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.functions import typemap
from keelson.functions.keys import keyset_after, shard_owner_column
from keelson.operators import changes as ch
from keelson.operators import metrics, validate
from keelson.operators.seed import make
from keelson.plans.model import ColumnSpec, TableSpec, spec_of
from keelson.plans.partitions import plan_ranges, range_number
from keelson.sources.change_source import key_bounds

V0 = 1000


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _orders_spec(o: DataFrame):
    return spec_of(o, "orders", ["o_orderkey"], not_null=("o_custkey", "o_orderdate"))


def _after(o: DataFrame) -> DataFrame:
    """orders after the changes of the feed."""
    k = F.col("o_orderkey")
    hit = k % 7 == 0
    return o.where(k % 11 != 0).withColumns({"o_orderstatus": F.when(hit, "X").otherwise(F.col("o_orderstatus")), "o_totalprice": F.when(hit, F.col("o_totalprice") * 2).otherwise(F.col("o_totalprice"))})


def _feed(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    return o.where((k % 11 == 0) | (k % 7 == 0)).select("o_orderkey", (k + V0 + 1).alias("version"))


def _log(spark, d) -> DataFrame:
    o = _t(spark, d, "orders")
    spec = _orders_spec(o)
    return ch.union_log(ch.snapshot_scan(o, spec, V0), ch.change_scan(_feed(o), _after(o), spec, V0, 1 << 60))


def current_state(spark, d):
    return ch.current(_log(spark, d), ["o_orderkey"])


def current_merge_on_read(spark, d):
    o = _t(spark, d, "orders")
    spec = _orders_spec(o)
    return ch.merge_on_read(ch.snapshot_scan(o, spec, V0), ch.change_scan(_feed(o), _after(o), spec, V0, 1 << 60), ["o_orderkey"])


def current_rollup(spark, d):
    return current_state(spark, d).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"))


def current_point_lookup(spark, d):
    return current_state(spark, d).where((F.col("o_custkey") == 7) | (F.col("o_orderkey") == 42))


def changes_since(spark, d):
    o = _t(spark, d, "orders")
    return ch.change_scan(_feed(o), _after(o), _orders_spec(o), V0 + 100, 1 << 60).drop("_seq")


def net_changes(spark, d):
    e = _t(spark, d, "events").select("user_id", F.col("event_id").alias("version"))
    return ch.net_changes(e, ["user_id"], 10, 1 << 60)


def _conversation_log(spark, d):
    c = _t(spark, d, "conversations")
    spec = spec_of(c, "conversations", ["conv_id", "turn"], not_null=("role",))
    feed = c.where(F.col("turn") % 3 == 1).select("conv_id", "turn", (F.col("conv_id") * 100 + F.col("turn") + V0 + 1).alias("version"))
    after = c.where(~((F.col("turn") % 3 == 1) & (F.col("conv_id") % 2 == 0))).withColumn("role", F.when(F.col("turn") % 3 == 1, F.upper("role")).otherwise(F.col("role")))
    return ch.union_log(ch.snapshot_scan(c, spec, V0), ch.change_scan(feed, after, spec, V0, 1 << 60))


def composite_key_current(spark, d):
    return ch.current(_conversation_log(spark, d), ["conv_id", "turn"]).select("conv_id", "turn", "role", "text")


def delete_then_reinsert(spark, d):
    """Every seventh order is deleted and inserted anew between two polls: one upsert each."""
    o = _t(spark, d, "orders")
    k = F.col("o_orderkey")
    raw = o.where(k % 7 == 0).select("o_orderkey", F.explode(F.array(2 * k + V0 + 1, 2 * k + V0 + 2)).alias("version"))
    after = o.withColumn("o_orderstatus", F.when(k % 7 == 0, "R").otherwise(F.col("o_orderstatus")))
    spec = _orders_spec(o)
    log = ch.union_log(ch.snapshot_scan(o, spec, V0), ch.change_scan(raw, after, spec, V0, 1 << 60))
    return ch.current(log, ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


def pk_update(spark, d):
    """A changed key arrives as a delete of the old and an insert of the new one."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    k = F.col("c_custkey")
    moved = c.where(k % 10 == 3)
    after = c.where(k % 10 != 3).unionByName(moved.withColumn("c_custkey", k + 10_000_000))
    feed = moved.select("c_custkey", (k + V0 + 1).alias("version")).unionByName(moved.select((k + 10_000_000).alias("c_custkey"), (k + V0 + 1).alias("version")))
    spec = spec_of(c, "customer", ["c_custkey"])
    return ch.current(ch.union_log(ch.snapshot_scan(c, spec, V0), ch.change_scan(feed, after, spec, V0, 1 << 60)), ["c_custkey"])


def snapshot_stamp(spark, d):
    c = _t(spark, d, "customer")
    return ch.snapshot_scan(c, spec_of(c, "customer", ["c_custkey"]), V0).drop("_seq")


def snapshot_ranges(spark, d):
    o = _t(spark, d, "orders")
    low, high = key_bounds(o, "o_orderkey")
    ranges = plan_ranges(low, high, 1_000_000, 8, 1)
    return o.groupBy(range_number(F.col("o_orderkey"), ranges).cast("bigint").alias("part")).agg(F.count(F.lit(1)).alias("rows"), F.min("o_orderkey").alias("low"), F.max("o_orderkey").alias("high"))


def keyset_resume(spark, d):
    return _t(spark, d, "conversations").where(keyset_after(["conv_id", "turn"], [10, 1])).select("conv_id", "turn", "role")


def idempotent_replay(spark, d):
    log = _log(spark, d)
    return ch.current(ch.union_log(log, log), ["o_orderkey"]).select("o_orderkey", "o_orderstatus")


def schema_drift_union(spark, d):
    """The source gains a column after the snapshot; rows from before have null in it."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    wide = o.withColumn("note", F.concat(F.lit("n"), F.col("o_orderkey")))
    feed = o.where(F.col("o_orderkey") % 7 == 0).select("o_orderkey", (F.col("o_orderkey") + V0 + 1).alias("version"))
    log = ch.union_log(ch.snapshot_scan(o, spec_of(o, "orders", ["o_orderkey"]), V0), ch.change_scan(feed, wide, spec_of(wide, "orders", ["o_orderkey"]), V0, 1 << 60))
    return ch.current(log, ["o_orderkey"])


def dropped_column_fill(spark, d):
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    thin = o.drop("o_orderpriority")
    feed = o.where(F.col("o_orderkey") % 7 == 0).select("o_orderkey", (F.col("o_orderkey") + V0 + 1).alias("version"))
    log = ch.union_log(ch.snapshot_scan(o, spec_of(o, "orders", ["o_orderkey"]), V0), ch.change_scan(feed, thin, spec_of(thin, "orders", ["o_orderkey"]), V0, 1 << 60))
    return ch.current(log, ["o_orderkey"])


def resync_drops_lost_delete(spark, d):
    """A delete whose record is lost stays visible until a new generation is read; the old one keeps it."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    now = o.where(F.col("o_orderkey") % 13 != 5)
    spec = spec_of(o, "orders", ["o_orderkey"])
    before = ch.current(ch.snapshot_scan(o, spec, V0), ["o_orderkey"])
    after = ch.current(ch.snapshot_scan(now, spec, V0 + 5000), ["o_orderkey"])
    return before.agg(F.count(F.lit(1)).alias("before_resync")).join(after.agg(F.count(F.lit(1)).alias("after_resync")))


def type_clamp_utc(spark, d):
    o = _t(spark, d, "orders")
    shifted = F.when(F.col("o_orderkey") % 5 == 0, F.col("o_orderdate") - F.make_ym_interval(years=F.lit(400))).when(F.col("o_orderkey") % 5 == 1, F.col("o_orderdate") + F.make_ym_interval(years=F.lit(400))).otherwise(F.col("o_orderdate"))
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 03:15:00.123 +05:30"))
    m = typemap.mapping
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSS")  # noqa: E731 - pandas can't hold the bounds
    return o.select(
        "o_orderkey", m("date").convert(shifted).cast("string").alias("d"), show(m("datetime").convert(F.when(F.col("o_orderkey") % 7 != 0, shifted))).alias("ts"), show(m("datetimeoffset", scale=3).convert(text)).alias("utc"),
        m("decimal", 18, 2).convert(F.col("o_orderkey")).cast("double").alias("amount"), m("bit").convert(F.col("o_orderkey") % 2).alias("flag"),
    )


def tombstone_defaults(spark, d):
    """What the tombstones of every fifth customer hold in columns that can't be null, by the source's type."""
    c = _t(spark, d, "customer").select("c_custkey", "c_name")
    k, day = F.col("c_custkey"), F.lit("2024-01-01").cast("timestamp_ntz")
    values = {
        ("bit",): k % 2 == 1, ("tinyint",): (k % 200).cast("smallint"), ("int",): k.cast("int"), ("bigint",): k * 3, ("decimal", 10, 2): k.cast("decimal(10,2)"), ("float", 53): k / 2, ("real",): k.cast("float"),
        ("date",): day.cast("date"), ("datetime2", None, 3): day, ("nvarchar",): F.col("c_name"), ("varbinary",): F.col("c_name").cast("binary"), ("uniqueidentifier",): F.upper(F.md5("c_name")), ("rowversion",): F.unhex(F.lpad(F.hex(k), 16, "0")),
    }
    spec = TableSpec("dbo", "customer", (ColumnSpec("c_custkey", "bigint", False, 1), *[ColumnSpec(f"c_{kind}", kind, False, 0, *size) for kind, *size in values]))
    base = c.where(k % 5 != 0).select("c_custkey", *[v.alias(f"c_{kind[0]}") for kind, v in values.items()])
    gone = ch.change_scan(c.select("c_custkey", (k + V0 + 1).alias("version")), base, spec, V0, 1 << 60).where("_is_deleted = 1")
    text = lambda kind: F.hex(f"c_{kind}") if kind == "varbinary" else F.col(f"c_{kind}").cast("string")
    rows = [F.struct(F.lit(kind).alias("sql_type"), text(kind).alias("placeholder")) for kind, *_ in values]
    return gone.select(F.explode(F.array(*rows)).alias("r")).groupBy("r.sql_type", "r.placeholder").agg(F.count(F.lit(1)).alias("tombstones"))


def exclude_columns(spark, d):
    c = _t(spark, d, "customer")
    return ch.snapshot_scan(c, spec_of(c, "customer", ["c_custkey"], exclude=("C_AcctBal", "c_mktsegment")), V0).drop("_seq")


def _as_log(e: DataFrame) -> DataFrame:
    """events as a run log: purchases are snapshot parts, errors fail."""
    return e.select(
        F.concat(F.lit("t"), F.col("user_id") % 20).alias("table_key"), F.when(F.col("event_type") == "purchase", F.concat(F.lit("snapshot["), F.col("event_id") % 8, F.lit("]"))).otherwise(F.lit("cdc")).alias("task"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"), (F.col("event_id") % 1000).alias("rows"), ((F.col("event_id") % 60) * 1000).alias("duration_ms"), "ts",
    )


def latest_request(spark, d):
    e = _t(spark, d, "events").select(F.concat(F.lit("t"), F.col("user_id") % 20).alias("table_key"), F.when(F.col("event_type") == "click", "resync").otherwise("other").alias("action"), F.col("ts").alias("requested_at"))
    return metrics.latest_requests(e, "resync")


def snapshot_log_metrics(spark, d):
    return metrics.snapshot_metrics(_as_log(_t(spark, d, "events")))


def hourly_error_metrics(spark, d):
    e = _as_log(_t(spark, d, "events"))
    return metrics.hourly_errors(e, F.lit("2100-01-01 00:00:00").cast("timestamp_ntz"), keep_days=365 * 200)


def retention_30_days(spark, d):
    """The hours that are left on the tenth of February: those since the eleventh of January."""
    return metrics.hourly_errors(_as_log(_t(spark, d, "events")), F.lit("2024-02-10 00:00:00").cast("timestamp_ntz"))


def table_state_latest(spark, d):
    """The last state row of every table, as a state log keeps it."""
    e = _t(spark, d, "events")
    states = e.select(F.concat(F.lit("t"), F.col("user_id") % 20).alias("table_key"), F.col("event_type").alias("phase"), F.col("event_id").alias("last_version"), "ts")
    return metrics.latest_states(states)


def storage_report(spark, d):
    """Orders by status as if each were a table: planned and loaded rows, seconds and bytes side by side."""
    o = _t(spark, d, "orders").withColumn("table_key", F.col("o_orderstatus"))
    plan = o.groupBy("table_key").agg(F.count(F.lit(1)).alias("source_rows"), F.count_if(F.col("o_orderkey") % 1000 != 1).alias("target_rows"))
    timing = o.where("o_orderstatus <> 'F'").groupBy(F.lower("table_key").alias("table_key")).agg((F.max("o_orderkey") - F.min("o_orderkey")).cast("double").alias("seconds"), F.count_distinct("o_orderpriority").alias("parts"))
    storage = o.groupBy("table_key").agg(F.count_distinct("o_custkey").alias("files"), F.sum(F.length("o_orderpriority")).alias("bytes"), F.sum(2 * F.length("o_orderpriority")).alias("raw_bytes"))
    return metrics.run_report(plan, timing, storage)

#: The tables whose sizes the load-test tables take here; by default a plan has ten million rows in all.
SEED_SIZES = {"Customers": "customer", "Products": "part", "Orders": "orders", "OrderItems": "lineitem", "Payments": "orders"}


def _seed(table: str, drop: tuple[str, ...] = ()):
    def run(spark, d):
        counts = {k: _t(spark, d, name).count() for k, name in SEED_SIZES.items()}
        out = make(spark, table, 1, counts[table], counts).drop(*drop)
        return out.select(*[F.col(c).cast("double").alias(c) if kind.startswith("decimal") else F.col(c) for c, kind in out.dtypes])

    return run


def _drifted(o: DataFrame) -> DataFrame:
    """orders with one row missing and one changed."""
    return o.where(F.col("o_orderkey") != 77).withColumn("o_custkey", F.when(F.col("o_orderkey") == 78, -1).otherwise(F.col("o_custkey")))


def row_count_check(spark, d):
    o = _t(spark, d, "orders")
    return validate.check_row_count(o, _drifted(o))


def pk_bounds_check(spark, d):
    o = _t(spark, d, "orders")
    return validate.check_pk_bounds(o, _drifted(o), "o_orderkey")


def aggregate_check(spark, d):
    o = _t(spark, d, "orders")
    return validate.check_aggregates(o, _drifted(o), ["o_orderkey", "o_custkey", "o_totalprice"])


def hash_bucket_check(spark, d):
    o = _t(spark, d, "orders")
    return validate.check_hash_buckets(o, _drifted(o), "o_orderkey", ["o_orderkey", "o_custkey", "o_orderstatus"], 16)


def diff_sample(spark, d):
    o = _t(spark, d, "orders")
    return validate.check_sample(o, _drifted(o), "o_orderkey", ["o_orderkey", "o_custkey"], 1)


def phase_heartbeat(spark, d):
    c = _t(spark, d, "customer")
    k = F.col("c_custkey")
    states = c.select(F.element_at(F.array(*map(F.lit, ("new", "snapshot", "cdc", "resync"))), (k % 4 + 1).cast("int")).alias("phase"), F.when(k % 9 == 0, "failed").alias("last_error"), k.alias("rows_synced"))
    return metrics.phase_counts(states)


def values_cross_join(spark, d):
    """A literal list beside every row: an explode, no join."""
    p = _t(spark, d, "part")
    return p.select("p_partkey", F.explode(F.lit([1, 2, 3]).cast("array<bigint>")).alias("line_no")).withColumn("sku", F.concat(F.lit("SKU-"), F.col("p_partkey"), F.lit("-"), F.col("line_no")))


def anti_join_report(spark, d):
    """Customers without an urgent order."""
    urgent = _t(spark, d, "orders").where("o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0")
    return _t(spark, d, "customer").join(urgent, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


def shard_assignment(spark, d):
    return _t(spark, d, "nation").select("n_name", shard_owner_column(F.concat(F.lit("dbo."), F.col("n_name")), 3).alias("shard"))


def compaction(spark, d):
    return ch.compact(_log(spark, d), ["o_orderkey"], keep_tombstones=True).select("o_orderkey", "_version", F.col("_is_deleted").cast("bigint").alias("_is_deleted"))


def table_statistics(spark, d):
    """Conditional sums by table, as a catalogue report joins them."""
    li = _t(spark, d, "lineitem")
    per = li.groupBy("l_orderkey").agg(F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0)).alias("returned"), F.count(F.lit(1)).alias("lines"))
    o = _t(spark, d, "orders")
    return o.join(per, F.col("o_orderkey") == F.col("l_orderkey"), "left").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"), F.coalesce(F.sum("returned"), F.lit(0)).alias("returned"))


def _scratch(spark, name: str) -> str:
    """A new folder in the shared folder that the cluster names; on a local master, where none is named, in a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="keelson-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        base = f"file://{folder}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


def stream_apply(spark, d):
    """The feed as a stream of changes, applied in micro-batches to a store: the current relation it ends with."""
    from keelson.sources.store import TableStore
    from keelson.streaming.change_stream import apply_stream, read_changes

    root = _scratch(spark, "stream")
    o = _t(spark, d, "orders")
    spec = _orders_spec(o)
    _feed(o).write.parquet(f"{root}/feed")
    store = TableStore(spark, f"{root}/store", "orders")
    store.create("g0", spec)
    store.write_batch("g0", "snap-0", ch.snapshot_scan(o, spec, V0))
    store.cut_over("g0")
    feed = read_changes(spark, f"{root}/feed", "o_orderkey long", start=V0)
    apply_stream(feed, lambda: _after(o), store, spec, f"{root}/checkpoint").awaitTermination()
    return store.current(keep_meta=False)


def _replica(spark, root: str, base: DataFrame, feed: DataFrame, name: str, floor: int = 0, table: str = "dbo.orders", pk: tuple[str, ...] = ("o_orderkey",)):
    """A Parquet source with one table."""
    from keelson.sources.change_source import ParquetSource

    base.write.parquet(f"{root}/{name}/{table}/base")
    feed.write.parquet(f"{root}/{name}/{table}/changes")
    return ParquetSource(spark, f"{root}/{name}", {table: list(pk)}, {table: floor})


def _supervisor(spark, root: str, source, table: str = "dbo.orders", **sync):
    from keelson.plans.settings import sync_settings, table_settings
    from keelson.streaming.lifecycle import Supervisor

    settings = sync_settings(**{"workers": 2, "poll_interval": 0.0, "min_rows_per_partition": 1000, "snapshot_partitions": 4, "batch_size": 1_000_000, **sync})
    return Supervisor(spark, source, f"{root}/target", settings, [table_settings(table)])


def _feed_before(o: DataFrame) -> DataFrame:
    """One change that the snapshot's version covers."""
    return o.limit(1).select("o_orderkey", F.lit(V0).cast("bigint").alias("version"))


def snapshot_resume(spark, d):
    """A snapshot that stops between two pages of a range and is resumed by another supervisor."""
    o = _t(spark, d, "orders")
    root = _scratch(spark, "resume")
    source = _replica(spark, root, o, _feed_before(o), "source")
    n = o.count()
    first = _supervisor(spark, root, source, batch_size=max(1, n // 12))
    while not any(p["page"] for s in first.states.values() for p in s.progress.values()):
        first.schedule()
        first.collect(0.05)
    first.shutdown()
    second = _supervisor(spark, root, source, batch_size=max(1, n // 12))
    second.step()
    second.shutdown()
    return second.store("dbo.orders").current(keep_meta=False)


def resync_through_store(spark, d):
    """A delete whose record is lost with the history: the tick asks for a resync, which reads a new generation."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    root = _scratch(spark, "resync")
    s = _supervisor(spark, root, _replica(spark, root, o, _feed_before(o), "before"))
    s.step()
    now = o.where(F.col("o_orderkey") % 13 != 5)
    s.source = _replica(spark, root, now, now.limit(1).select("o_orderkey", F.lit(V0 + 500).cast("bigint").alias("version")), "after", V0 + 100)
    s.step()  # finds the history cut off
    s.step()  # reads anew
    s.shutdown()
    return s.store("dbo.orders").current(keep_meta=False)


def add_columns_store(spark, d):
    """The source gains a column between snapshot and tick: rows from before have null in it."""
    o = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    root = _scratch(spark, "columns")
    s = _supervisor(spark, root, _replica(spark, root, o, _feed_before(o), "narrow"))
    s.step()
    wide = o.withColumn("note", F.concat(F.lit("n"), F.col("o_orderkey")))
    s.source = _replica(spark, root, wide, o.where(F.col("o_orderkey") % 7 == 0).select("o_orderkey", (F.col("o_orderkey") + V0 + 1).alias("version")), "wide")
    s.step()
    s.shutdown()
    return s.store("dbo.orders").current(keep_meta=False)


def _stored(spark, root: str, pages: int, fan: int):
    """orders in a store, as base batches of equal key ranges."""
    from keelson.sources.store import TableStore

    o = _t(spark, root[0], "orders")
    spec = _orders_spec(o)
    low, high = key_bounds(o, "o_orderkey")
    store = TableStore(spark, root[1], "orders", fan)
    store.create("g0", spec)
    for i, bounds in enumerate(plan_ranges(low, high, pages, pages, 1)):
        store.write_batch("g0", f"snap-{i}", ch.snapshot_scan(o, spec, V0, bounds), base=True)
    store.cut_over("g0")
    return o, spec, store, low, high


def tiered_compaction(spark, d):
    """The feed in eight ticks with merges in between: levels fill up and go into those base batches that they meet."""
    o, spec, store, low, high = _stored(spark, (d, _scratch(spark, "tiers")), 4, 3)
    for i in range(8):
        a, z = (V0 + low + (high - low + 1) * k // 8 for k in (i, i + 1))
        store.write_batch("g0", f"cdc-{i}", ch.change_scan(_feed(o), _after(o), spec, a, z, seq=i + 1))
        store.merge()
    return store.current(keep_meta=False)


def current_pruned(spark, d):
    """Changes of the first quarter of the keys: base files behind it are read as they are."""
    o, spec, store, low, high = _stored(spark, (d, _scratch(spark, "zones")), 8, 8)
    z = V0 + low + (high - low + 1) // 4
    store.write_batch("g0", "cdc-0", ch.change_scan(_feed(o), _after(o), spec, V0, z))
    return store.current(keep_meta=False)


def read_by_format(spark, d):
    """The current relation by name, as any session reads it."""
    from keelson.sources.current_source import read_current

    root = _scratch(spark, "format")
    o, spec, store, low, high = _stored(spark, (d, root), 4, 8)
    store.write_batch("g0", "cdc-0", ch.change_scan(_feed(o), _after(o), spec, V0, V0 + high // 2))
    store.write_batch("g0", "cdc-1", ch.change_scan(_feed(o), _after(o), spec, V0 + high // 2, 1 << 60, seq=2))
    return read_current(spark, root, "orders").where(F.col("o_orderkey") >= 10).drop("_version", "_synced_at")


def composite_ranges(spark, d):
    """A snapshot of a table with a key of two columns, in ten ranges of about equal size."""
    c = _t(spark, d, "conversations")
    root = _scratch(spark, "ranges")
    feed = c.limit(1).select("conv_id", "turn", F.lit(V0).cast("bigint").alias("version"))
    source = _replica(spark, root, c, feed, "source", table="dbo.conversations", pk=("conv_id", "turn"))
    s = _supervisor(spark, root, source, "dbo.conversations", min_rows_per_partition=100, batch_size=-(-c.count() // 10))
    s.step()
    s.shutdown()
    return s.store("dbo.conversations").current(keep_meta=False)


def pinned_tick(spark, d):
    """Rows and changes that arrive while a tick reads are left to the next one: all its reads see one state."""
    from keelson.sources.change_source import ParquetSource

    o = _t(spark, d, "orders")
    root = _scratch(spark, "pinned")
    source = _replica(spark, root, o, _feed_before(o), "source")
    s = _supervisor(spark, root, source)
    s.step()
    feed = _feed(o).where("o_orderkey % 11 <> 0")
    feed.write.mode("append").parquet(f"{root}/source/dbo.orders/changes")
    check, late = ParquetSource.min_valid_version, o.withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000)

    def meanwhile(self, key):
        if self.frozen and not s.__dict__.setdefault("late", False):  # inside the session, before changes and rows are read
            s.late = True
            late.write.mode("append").parquet(f"{root}/source/dbo.orders/base")
            late.select("o_orderkey", (F.col("o_orderkey") + V0).alias("version")).write.mode("append").parquet(f"{root}/source/dbo.orders/changes")
        return check(self, key)

    ParquetSource.min_valid_version = meanwhile
    try:
        s.step()
    finally:
        ParquetSource.min_valid_version = check
        s.shutdown()
    return s.store("dbo.orders").current(keep_meta=True).select("o_orderkey", "o_orderstatus", "_version")


def stream_bounded(spark, d):
    """The feed as a stream that takes a fifth of it in a batch at most."""
    from keelson.sources.store import TableStore
    from keelson.streaming.change_stream import apply_bounded, read_changes

    root = _scratch(spark, "bounded")
    o = _t(spark, d, "orders")
    spec = _orders_spec(o)
    _feed(o).write.parquet(f"{root}/feed")
    store = TableStore(spark, f"{root}/store", "orders")
    store.create("g0", spec)
    store.write_batch("g0", "snap-0", ch.snapshot_scan(o, spec, V0), base=True)
    store.cut_over("g0")
    limit = -(-_feed(o).count() // 5)
    feed = read_changes(spark, f"{root}/feed", "o_orderkey long", start=V0, max_rows=limit, checkpoint=f"{root}/checkpoint")
    batches = apply_bounded(feed, lambda: _after(o), store, spec, f"{root}/checkpoint")
    if max(batches) > limit:
        raise AssertionError(f"a batch of {max(batches)} changes, the limit is {limit}")
    return store.current(keep_meta=False)


def _retyped(spark, d, old, new, name: str, steps: int):
    """orders with a column whose type changes between snapshot and tick, with a change of every seventh row."""
    o = _t(spark, d, "orders")
    root = _scratch(spark, name)
    seventh = F.col("o_orderkey") % 7 == 0
    s = _supervisor(spark, root, _replica(spark, root, o.withColumn("amount", old), _feed_before(o), "before"))
    s.step()
    feed = o.where(seventh).select("o_orderkey", (F.col("o_orderkey") + V0 + 1).alias("version"))
    s.source = _replica(spark, root, o.withColumn("amount", new), feed, "after")
    for _ in range(steps):
        s.step()
    s.shutdown()
    return s.store("dbo.orders").current(keep_meta=False)


def type_widening(spark, d):
    """int to bigint: files written before are read as the wider type, changed rows have values that need it."""
    new = F.col("o_custkey") + F.when(F.col("o_orderkey") % 7 == 0, F.lit(1 << 40)).otherwise(F.lit(0))
    return _retyped(spark, d, F.col("o_custkey").cast("int"), new.cast("bigint"), "wider", 1)


def type_resync(spark, d):
    """Text to a number: the tick finds that out and asks for a resync, which reads a new generation."""
    return _retyped(spark, d, F.concat(F.lit("c"), F.col("o_custkey")), F.col("o_custkey").cast("bigint") * 2, "retyped", 2)


def storage_from_footers(spark, d):
    """Rows by snapshot range as the footers of its files have them, read by a job."""
    o = _t(spark, d, "orders")
    root = _scratch(spark, "footers")
    s = _supervisor(spark, root, _replica(spark, root, o, _feed_before(o), "source"))
    s.step()
    s.shutdown()
    part = F.regexp_extract("path", r"snap-(\d+)", 1).cast("bigint").alias("part")
    return s.store("dbo.orders").storage().groupBy(part).agg(F.sum("rows").alias("rows"), F.bool_and((F.col("packed") > 0) & (F.col("raw") > 0)).alias("measured"))


def replication_lag(spark, d):
    """events as an index of commits; every table has applied all but its last fifty versions."""
    e = _t(spark, d, "events")
    commits = e.select(F.concat(F.lit("t"), F.col("user_id") % 20).alias("table_key"), F.col("event_id").alias("version"), F.col("ts").alias("committed_at"))
    states = commits.groupBy("table_key").agg((F.max("version") - 50).alias("last_version"))
    return metrics.lag(states, commits, F.lit("2024-03-01 00:00:00").cast("timestamp_ntz"))


def diff_by_tree(spark, d):
    o = _t(spark, d, "orders")
    return validate.diff_by_tree(o, _drifted(o), "o_orderkey", ["o_orderkey", "o_custkey"], leaf_rows=500)


def queries() -> dict:
    own = (
        current_state, current_merge_on_read, current_rollup, current_point_lookup, changes_since, net_changes, composite_key_current, delete_then_reinsert, pk_update, snapshot_stamp,
        snapshot_ranges, keyset_resume, idempotent_replay, schema_drift_union, dropped_column_fill, resync_drops_lost_delete, type_clamp_utc, tombstone_defaults, exclude_columns,
        latest_request, snapshot_log_metrics, hourly_error_metrics, row_count_check, pk_bounds_check, aggregate_check, hash_bucket_check, diff_sample, phase_heartbeat, values_cross_join,
        anti_join_report, shard_assignment, compaction, table_statistics, stream_apply, snapshot_resume, resync_through_store, add_columns_store, retention_30_days,
        table_state_latest, storage_report, tiered_compaction, current_pruned, read_by_format, composite_ranges, pinned_tick, stream_bounded, type_widening, type_resync,
        storage_from_footers, replication_lag, diff_by_tree,
    )
    seeds = {
        "seed_customers": _seed("Customers"), "seed_products": _seed("Products"), "seed_orders": _seed("Orders", ("ExternalRef",)),  # a random value
        "seed_order_items": _seed("OrderItems"), "seed_payments": _seed("Payments"),
    }
    return {f.__name__: f for f in own} | seeds


# --- the same in SQL

_CURRENT = """SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
 CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 11 <> 0"""
_LOG = """(SELECT 't' || (user_id % 20) AS table_key, CASE WHEN event_type = 'purchase' THEN 'snapshot[' || (event_id % 8) || ']' ELSE 'cdc' END AS task,
 CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, event_id % 1000 AS rows, (event_id % 60) * 1000 AS duration_ms, ts FROM events)"""
_DRIFTED = "(SELECT o_orderkey, CASE WHEN o_orderkey = 78 THEN -1 ELSE o_custkey END AS o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey <> 77)"
_SEEDED = "(SELECT i, i * 2654435761 % 2147483647 AS h FROM (SELECT row_number() OVER () AS i FROM {t}))"


def _pick(k: str, values) -> str:
    return f"[{', '.join(repr(v) for v in values)}][({k}) % {len(values)} + 1]"


def _ago(k: str) -> str:
    return f"TIMESTAMP '2026-01-01 00:00:00' - to_minutes(({k})::BIGINT)"


def _bucket_sql(table: str) -> str:
    text = "concat_ws('|', o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus)"
    return f"(SELECT o_orderkey % 16 AS bucket, count(*) AS n, sum(('0x' || substr(md5({text}), 1, 8))::BIGINT) AS h FROM {table} GROUP BY 1)"


def _aggregate_sql(column: str, low: str, total: str) -> str:
    one = "SELECT count(*) FILTER ({c} IS NULL) AS nulls, min({low}) AS low, max({low}) AS high, sum({total})::BIGINT AS total FROM {t}"
    a, b = (one.format(c=column, low=low, total=total, t=t) for t in ("orders", _DRIFTED))
    return f"SELECT '{column}' AS \"column\", a.nulls = b.nulls AND a.low = b.low AND a.high = b.high AND a.total = b.total AS match, a.total AS source_total, b.total AS target_total FROM ({a}) a, ({b}) b"


def oracle_sql() -> dict[str, str]:
    from keelson.operators import seed as s

    cents = "round(o_totalprice * 100)::BIGINT"
    return {
        "current_state": _CURRENT,
        "current_merge_on_read": _CURRENT,
        "stream_apply": _CURRENT,
        "current_rollup": f"SELECT o_orderstatus, count(*) AS orders, sum({cents})::BIGINT AS cents FROM ({_CURRENT}) GROUP BY 1",
        "current_point_lookup": f"SELECT * FROM ({_CURRENT}) WHERE o_custkey = 7 OR o_orderkey = 42",
        "changes_since": f"""SELECT f.o_orderkey, CASE WHEN c.o_orderkey IS NULL THEN 0 ELSE c.o_custkey END AS o_custkey, c.o_orderstatus, c.o_totalprice,
            coalesce(c.o_orderdate, TIMESTAMP '1970-01-01') AS o_orderdate, c.o_orderpriority, f.o_orderkey + 1001 AS _version, (c.o_orderkey IS NULL)::INT AS _is_deleted
            FROM orders f LEFT JOIN ({_CURRENT}) c USING (o_orderkey) WHERE (f.o_orderkey % 11 = 0 OR f.o_orderkey % 7 = 0) AND f.o_orderkey + 1001 > 1100""",
        "net_changes": "SELECT user_id, max(event_id) AS version FROM events WHERE event_id > 10 GROUP BY user_id",
        "composite_key_current": "SELECT conv_id, turn, CASE WHEN turn % 3 = 1 THEN upper(role) ELSE role END AS role, text FROM conversations WHERE NOT (turn % 3 = 1 AND conv_id % 2 = 0)",
        "delete_then_reinsert": "SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN 'R' ELSE o_orderstatus END AS o_orderstatus FROM orders",
        "pk_update": "SELECT CASE WHEN c_custkey % 10 = 3 THEN c_custkey + 10000000 ELSE c_custkey END AS c_custkey, c_name, c_nationkey FROM customer",
        "snapshot_stamp": "SELECT *, 1000::BIGINT AS _version, 0::TINYINT AS _is_deleted FROM customer",
        "snapshot_ranges": """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) - min(o_orderkey) + 1 AS span FROM orders), e AS (SELECT i, lo + span * i // 8 AS edge FROM b, range(1, 8) r(i))
            SELECT (SELECT count(*) FROM e WHERE edge <= o_orderkey) AS part, count(*) AS rows, min(o_orderkey) AS low, max(o_orderkey) AS high FROM orders GROUP BY 1""",
        "keyset_resume": "SELECT conv_id, turn, role FROM conversations WHERE (conv_id, turn) > (10, 1)",
        "tiered_compaction": _CURRENT,
        "stream_bounded": _CURRENT,
        "read_by_format": f"SELECT * FROM ({_CURRENT}) WHERE o_orderkey >= 10",
        "current_pruned": """WITH b AS (SELECT min(o_orderkey) + (max(o_orderkey) - min(o_orderkey) + 1) // 4 AS z FROM orders)
            SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 AND o_orderkey < z THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 7 = 0 AND o_orderkey < z THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice,
            o_orderdate, o_orderpriority FROM orders, b WHERE NOT (o_orderkey % 11 = 0 AND o_orderkey < z)""",
        "composite_ranges": "SELECT * FROM conversations",
        "pinned_tick": """SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 11 <> 0 THEN o_orderkey + 1001 ELSE 1000 END AS _version FROM orders""",
        "type_widening": "SELECT *, o_custkey + CASE WHEN o_orderkey % 7 = 0 THEN 1099511627776 ELSE 0 END AS amount FROM orders",
        "type_resync": "SELECT *, o_custkey * 2 AS amount FROM orders",
        "storage_from_footers": """WITH b AS (SELECT min(o_orderkey) AS lo, max(o_orderkey) - min(o_orderkey) + 1 AS span, greatest(1, least(4, count(*) // 1000)) AS n FROM orders)
            SELECT (SELECT count(*) FROM range(1, 4) r(i) WHERE i < n AND lo + span * i // n <= o_orderkey) AS part, count(*) AS rows, true AS measured FROM orders, b GROUP BY 1""",
        "replication_lag": """WITH c AS (SELECT 't' || (user_id % 20) AS table_key, event_id AS version, ts, max(event_id) OVER (PARTITION BY user_id % 20) AS newest FROM events)
            SELECT table_key, max(newest) - 50 AS last_version, max(newest) AS newest_version, count(*) FILTER (version > newest - 50) AS versions_behind, arg_max(ts, version) FILTER (version <= newest - 50) AS applied_at,
            min(ts) FILTER (version > newest - 50) AS waiting_since, coalesce(date_diff('microsecond', min(ts) FILTER (version > newest - 50), TIMESTAMP '2024-03-01') // 1000000, 0) AS lag_seconds FROM c GROUP BY 1""",
        "diff_by_tree": f"""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS key, CASE WHEN b.o_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'extra' ELSE 'different' END AS problem
            FROM orders a FULL JOIN {_DRIFTED} b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_custkey <> b.o_custkey""",
        "idempotent_replay": f"SELECT o_orderkey, o_orderstatus FROM ({_CURRENT})",
        "schema_drift_union": "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN 'n' || o_orderkey END AS note FROM orders",
        "dropped_column_fill": "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 <> 0 THEN o_orderpriority END AS o_orderpriority FROM orders",
        "resync_drops_lost_delete": "SELECT count(*) AS before_resync, count(*) FILTER (o_orderkey % 13 <> 5) AS after_resync FROM orders",
        "type_clamp_utc": """WITH s AS (SELECT o_orderkey, o_orderdate, CASE o_orderkey % 5 WHEN 0 THEN o_orderdate - INTERVAL 400 YEAR WHEN 1 THEN o_orderdate + INTERVAL 400 YEAR ELSE o_orderdate END AS x FROM orders)
            SELECT o_orderkey, least(greatest(x::DATE, DATE '1900-01-01'), DATE '2299-12-31')::VARCHAR AS d,
            CASE WHEN o_orderkey % 7 <> 0 THEN strftime(least(greatest(x, TIMESTAMP '1900-01-01'), TIMESTAMP '2299-12-31 23:59:59.999'), '%Y-%m-%d %H:%M:%S.%g') END AS ts,
            strftime(o_orderdate::DATE + INTERVAL '3 hours 15 minutes 123 milliseconds' - INTERVAL 330 MINUTE, '%Y-%m-%d %H:%M:%S.%g') AS utc, o_orderkey::DECIMAL(18,2)::DOUBLE AS amount, o_orderkey % 2 = 1 AS flag FROM s""",
        "tombstone_defaults": """SELECT t.*, (SELECT count(*) FROM customer WHERE c_custkey % 5 = 0) AS tombstones FROM (VALUES ('bit', 'false'), ('tinyint', '0'), ('int', '0'), ('bigint', '0'), ('decimal', '0.00'), ('float', '0.0'), ('real', '0.0'), ('date', '1970-01-01'),
            ('datetime2', '1970-01-01 00:00:00'), ('nvarchar', ''), ('varbinary', ''), ('uniqueidentifier', '00000000-0000-0000-0000-000000000000'), ('rowversion', '0')) t(sql_type, placeholder)""",
        "exclude_columns": "SELECT c_custkey, c_name, c_nationkey, 1000::BIGINT AS _version, 0::TINYINT AS _is_deleted FROM customer",
        "latest_request": "SELECT 't' || (user_id % 20) AS table_key, max(ts) AS requested_at FROM events WHERE event_type = 'click' GROUP BY 1",
        "snapshot_log_metrics": f"""WITH l AS (SELECT *, starts_with(task, 'snapshot[') AND status = 'ok' AS part FROM {_LOG})
            SELECT table_key, count(DISTINCT task) FILTER (part) AS parts, coalesce(sum(rows) FILTER (part), 0)::BIGINT AS rows, count(*) FILTER (status = 'error') AS errors,
            ((epoch_us(max(ts) FILTER (part)) - epoch_us(min(ts - to_milliseconds(duration_ms)) FILTER (part))) // 1000) / 1000 AS seconds FROM l GROUP BY 1""",
        "hourly_error_metrics": f"SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (status = 'error') AS errors, count(*) AS tasks FROM {_LOG} GROUP BY 1",
        "row_count_check": f"SELECT (SELECT count(*) FROM orders) AS source_rows, (SELECT count(*) FROM {_DRIFTED}) AS target_rows, (SELECT count(*) FROM orders) = (SELECT count(*) FROM {_DRIFTED}) AS match",
        "pk_bounds_check": f"""SELECT a.*, b.*, a.source_min = b.target_min AND a.source_max = b.target_max AS match FROM (SELECT min(o_orderkey) AS source_min, max(o_orderkey) AS source_max FROM orders) a,
            (SELECT min(o_orderkey) AS target_min, max(o_orderkey) AS target_max FROM {_DRIFTED}) b""",
        "aggregate_check": " UNION ALL ".join([_aggregate_sql("o_orderkey", "o_orderkey::VARCHAR", "o_orderkey * 100"), _aggregate_sql("o_custkey", "o_custkey::VARCHAR", "o_custkey * 100"), _aggregate_sql("o_totalprice", f"({cents})::VARCHAR", cents)]),
        "hash_bucket_check": f"SELECT bucket, a.n AS source_rows, b.n AS target_rows, a.n IS NOT DISTINCT FROM b.n AND a.h IS NOT DISTINCT FROM b.h AS match FROM {_bucket_sql('orders')} a FULL JOIN {_bucket_sql(_DRIFTED)} b USING (bucket)",
        "diff_sample": f"""SELECT coalesce(a.o_orderkey, b.o_orderkey) AS key, CASE WHEN b.o_orderkey IS NULL THEN 'missing' WHEN a.o_orderkey IS NULL THEN 'extra' ELSE 'different' END AS problem
            FROM orders a FULL JOIN {_DRIFTED} b ON a.o_orderkey = b.o_orderkey WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR a.o_custkey <> b.o_custkey""",
        "phase_heartbeat": "SELECT ['new', 'snapshot', 'cdc', 'resync'][c_custkey % 4 + 1] AS phase, count(*) AS tables, count(*) FILTER (c_custkey % 9 = 0) AS errors, sum(c_custkey)::BIGINT AS rows FROM customer GROUP BY 1",
        "values_cross_join": "SELECT p_partkey, n::BIGINT AS line_no, 'SKU-' || p_partkey || '-' || n AS sku FROM part CROSS JOIN (VALUES (1), (2), (3)) v(n)",
        "anti_join_report": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT' AND o_orderkey % 3 = 0)",
        # the polynomial bit by bit, for there is no crc32 in the SQL engine
        "shard_assignment": """WITH n AS (SELECT n_name, lower('dbo.' || n_name) AS s FROM nation), c AS (SELECT n_name, list_reduce(
            list_prepend(4294967295::BIGINT, list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)),
            lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc FROM n)
            SELECT n_name, (xor(crc, 4294967295) % 3)::INT AS shard FROM c""",
        "snapshot_resume": "SELECT * FROM orders",
        "resync_through_store": "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 13 <> 5",
        "add_columns_store": "SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN 'n' || o_orderkey END AS note FROM orders",
        "retention_30_days": f"SELECT date_trunc('hour', ts) AS hour, count(*) FILTER (status = 'error') AS errors, count(*) AS tasks FROM {_LOG} WHERE ts >= TIMESTAMP '2024-01-11' GROUP BY 1",
        "table_state_latest": "SELECT 't' || (user_id % 20) AS table_key, arg_max(event_type, ts) AS phase, arg_max(event_id, ts) AS last_version, max(ts) AS ts FROM events GROUP BY 1",
        "storage_report": """WITH p AS (SELECT o_orderstatus AS k, count(*) AS source_rows, count(*) FILTER (o_orderkey % 1000 <> 1) AS target_rows, count(DISTINCT o_custkey) AS files, sum(length(o_orderpriority))::BIGINT AS bytes,
            (max(o_orderkey) - min(o_orderkey))::DOUBLE AS seconds, count(DISTINCT o_orderpriority) AS parts FROM orders GROUP BY 1)
            SELECT k AS table_key, source_rows, target_rows, CASE WHEN k <> 'F' THEN seconds END AS seconds, CASE WHEN k <> 'F' THEN parts END AS parts, files, bytes, 2 * bytes AS raw_bytes,
            source_rows = target_rows AS match, CASE WHEN k <> 'F' THEN target_rows / nullif(seconds, 0) END AS rows_per_second, 2.0::DOUBLE AS compression FROM p""",
        "compaction": "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 OR o_orderkey % 7 = 0 THEN o_orderkey + 1001 ELSE 1000 END AS _version, (o_orderkey % 11 = 0)::BIGINT AS _is_deleted FROM orders",
        "table_statistics": """SELECT o_orderstatus, count(*) AS orders, coalesce(sum(lines), 0)::BIGINT AS lines, coalesce(sum(returned), 0)::BIGINT AS returned FROM orders
            LEFT JOIN (SELECT l_orderkey, count(*) AS lines, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""",
        "seed_customers": f"""SELECT i AS CustomerId, {_pick('h', s.FIRST)} AS FirstName, {_pick('h // 10', s.LAST)} AS LastName, 'user' || i || '@example.com' AS Email, {_pick('h // 100', s.COUNTRIES)} AS Country,
            {_ago('h % 1051200')} AS CreatedAt, h % 10 <> 0 AS IsActive FROM {_SEEDED.format(t='customer')}""",
        "seed_products": f"SELECT i AS ProductId, 'SKU-' || lpad(i::VARCHAR, 10, '0') AS Sku, 'Product ' || i AS Name, {_pick('h', s.CATEGORIES)} AS Category, ((100 + h % 100000) / 100)::DECIMAL(10,2)::DOUBLE AS Price, {_ago('h % 1051200')} AS CreatedAt FROM {_SEEDED.format(t='part')}",
        "seed_orders": f"""SELECT i AS OrderId, 1 + h % (SELECT count(*) FROM customer) AS CustomerId, {_pick('h', s.STATUSES)} AS Status, {_ago('h % 525600')} AS OrderDate, ((h % 5000000) / 100)::DECIMAL(18,2)::DOUBLE AS TotalAmount,
            {_pick('h // 7', s.CURRENCIES)} AS Currency FROM {_SEEDED.format(t='orders')}""",
        "seed_order_items": f"""SELECT i AS OrderItemId, 1 + h % (SELECT count(*) FROM orders) AS OrderId, 1 + (h // 3) % (SELECT count(*) FROM part) AS ProductId, (1 + h % 5)::INT AS Quantity, ((100 + h % 50000) / 100)::DECIMAL(10,2)::DOUBLE AS UnitPrice,
            CASE WHEN h % 4 <> 0 THEN ((h % 30) / 100)::DECIMAL(5,2)::DOUBLE END AS Discount FROM {_SEEDED.format(t='lineitem')}""",
        "seed_payments": f"""SELECT i AS PaymentId, 1 + (i - 1) % (SELECT count(*) FROM orders) AS OrderId, {_pick('h', s.METHODS)} AS Method, ((h % 5000000) / 100)::DECIMAL(18,2)::DOUBLE AS Amount,
            CASE WHEN h % 7 <> 0 THEN {_ago('h % 525600 + 330')} END AS PaidAt, CASE WHEN h % 50 = 0 THEN repeat('note ', 20) END AS Notes FROM {_SEEDED.format(t='orders')}""",
    }
