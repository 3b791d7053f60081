"""The life cycle against an emulated source, compared with a dict of its rows."""

import random

import pytest
from pyspark.sql import functions as F

from keelson.operators import changes as ch
from keelson.operators import validate
from keelson.operators.seed import plan_rows, seed
from keelson.plans.model import ColumnSpec, TableSpec
from keelson.plans.settings import sync_settings, table_settings
from keelson.streaming.lifecycle import CDC, NEW, RESYNC, SNAPSHOT, Supervisor, backoff
from tests.emulated import MemorySource

ORDERS = TableSpec("dbo", "Orders", (ColumnSpec("OrderId", "bigint", False, 1), ColumnSpec("CustomerId", "int", False), ColumnSpec("Status", "nvarchar")))
LINES = TableSpec("sales", "Lines", (ColumnSpec("OrderId", "int", False, 1), ColumnSpec("LineNo", "smallint", False, 2), ColumnSpec("Sku", "nvarchar", False)))


def make(spark, tmp_path, orders=300):
    src = MemorySource(spark, 5000)
    src.create(ORDERS, "OrderId long, CustomerId int, Status string", [{"OrderId": i, "CustomerId": i % 97, "Status": None if i % 10 == 0 else "s"} for i in range(1, orders + 1)])
    src.create(LINES, "OrderId int, LineNo short, Sku string", [{"OrderId": o, "LineNo": n, "Sku": f"SKU-{o}-{n}"} for o in range(1, 21) for n in (1, 2, 3)])
    sync = sync_settings(workers=4, poll_interval=0.001, snapshot_partitions=4, min_rows_per_partition=10)
    return src, supervise(spark, src, tmp_path, sync)


def supervise(spark, src, tmp_path, sync):
    return Supervisor(spark, src, f"file://{tmp_path}/target", sync, [table_settings("dbo.Orders"), table_settings("sales.Lines", target="lines")])


def same(src, sup, key):
    cols = [c.name for c in src.specs[key].columns]
    got = sorted(map(tuple, sup.store(key).current(keep_meta=False).select(*cols).collect()), key=str)
    want = sorted((tuple(r.get(c) for c in cols) for r in src.rows[key].values()), key=str)
    assert got == want


def test_life_cycle(spark, tmp_path):
    src, sup = make(spark, tmp_path)
    o, lines = sup.states["dbo.orders"], sup.states["sales.lines"]

    def during_snapshot():
        src.upsert("dbo.Orders", OrderId=5, CustomerId=999999, Status="w")
        src.delete("dbo.Orders", 6)
        src.upsert("dbo.Orders", OrderId=3000, CustomerId=1, Status="n")

    src.on_read = during_snapshot
    sup.step()
    assert o.phase == lines.phase == CDC and o.last_version == 5000
    assert len(sup.store("dbo.Orders").manifest(sup.store("dbo.Orders").live())["batches"]) == 4
    sup.step()
    same(src, sup, "dbo.Orders")
    same(src, sup, "sales.Lines")

    for i in range(100, 120):
        src.upsert("dbo.Orders", OrderId=i, CustomerId=1, Status=None)
    for i in range(200, 210):
        src.delete("dbo.Orders", i)
    src.delete("dbo.Orders", 7)
    src.upsert("dbo.Orders", OrderId=7, CustomerId=7777, Status="back")
    src.delete("sales.Lines", 1, 1)
    src.upsert("sales.Lines", OrderId=1, LineNo=9, Sku="NEW")
    sup.step()
    same(src, sup, "dbo.Orders")
    same(src, sup, "sales.Lines")

    # a new column: older rows have null in it
    wide = TableSpec("dbo", "Orders", (*ORDERS.columns, ColumnSpec("Note", "nvarchar")))
    src.specs["dbo.Orders"], src.schemas["dbo.Orders"] = wide, src.schemas["dbo.Orders"] + ", Note string"
    src.upsert("dbo.Orders", OrderId=11, Note="hello")
    sup.step()
    same(src, sup, "dbo.Orders")
    assert sup.store("dbo.Orders").current().where("Note = 'hello'").count() == 1

    # a delete whose record is lost, and history cut off above the last version
    src.rows["dbo.Orders"].pop((8,))
    src.version += 10
    src.floor["dbo.Orders"] = src.version
    sup.step()
    assert o.phase == RESYNC and sup.store("dbo.Orders").current().where("OrderId = 8").count() == 1
    sup.step()
    assert o.phase == CDC
    same(src, sup, "dbo.Orders")

    # a requested resync whose cut-over is followed by a crash before the state is saved
    sup.request_resync("SALES.lines")
    sup.apply_requests()
    assert lines.phase == RESYNC
    src.upsert("sales.Lines", OrderId=2, LineNo=9, Sku="R")
    saved = sup.save
    sup.save = lambda s: (_ for _ in ()).throw(OSError("disk")) if s.phase == CDC else saved(s)
    with pytest.raises(OSError):
        sup.step()
    again = supervise(spark, src, tmp_path, sup.sync)
    assert again.states["sales.lines"].phase == SNAPSHOT
    again.step()
    again.step()
    assert again.states["sales.lines"].phase == CDC
    same(src, again, "sales.Lines")
    assert again.store("dbo.Orders").merge() == []  # too few batches
    same(src, again, "dbo.Orders")


def test_tracking_off_backs_off(spark, tmp_path):
    src, sup = make(spark, tmp_path, 5)
    src.floor["dbo.Orders"] = None
    sup.step()
    s = sup.states["dbo.orders"]
    assert s.phase == NEW and s.failures == 1 and "off" in s.last_error
    assert [backoff(n) for n in (0, 1, 4, 20)] == [1, 2, 16, 300]


def test_random_operations(spark):
    rnd = random.Random(1)
    spec = TableSpec("dbo", "t", (ColumnSpec("k", "int", False, 1), ColumnSpec("v", "int")))
    rows, log, version = {k: k for k in range(20)}, [], 100
    parts = [ch.snapshot_scan(spark.createDataFrame(list(rows.items()), "k int, v int"), spec, version)]
    for tick in range(4):
        last = version
        for _ in range(15):
            version += 1
            k = rnd.randrange(30)
            rows.pop(k, None) if rnd.random() < 0.4 else rows.update({k: version})
            log.append((k, version))
        base, feed = spark.createDataFrame(list(rows.items()), "k int, v int"), spark.createDataFrame(log, "k int, version long")
        parts.append(ch.change_scan(feed, base, spec, last, version, seq=tick + 1, few_keys=15 if tick % 2 else None))
        rnd.shuffle(parts)
        assert dict(map(tuple, ch.current(ch.union_log(*parts), ["k"]).collect())) == rows


def test_filters_and_the_window(spark, tmp_path):
    """A predicate on the key reaches the scan, one on another column stays above the deduplication."""
    path = f"{tmp_path}/log"
    spark.createDataFrame([(1, "a", 1, 0, 0), (1, "b", 2, 0, 1)], "k long, v string, _version long, _is_deleted tinyint, _seq long").write.parquet(path)
    cur = ch.current(spark.read.parquet(path), ["k"])
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(k,1)" in plan(cur.where("k = 1"))
    assert "EqualTo(v,a)" not in plan(cur.where("v = 'a'")) and cur.where("v = 'a'").count() == 0
    assert "WindowGroupLimit" in plan(cur)


def test_ties_go_to_the_later_batch(spark):
    rows = [(1, "first", 5, 0, 0), (1, "second", 5, 0, 1)]
    schema = "k int, v string, _version long, _is_deleted tinyint, _seq long"
    for r in (rows, rows[::-1]):
        assert ch.current(spark.createDataFrame(r, schema), ["k"]).first()["v"] == "second"


def test_seed_and_validate(spark, tmp_path):
    assert plan_rows(1000) == {"Customers": 100, "Products": 10, "Orders": 250, "OrderItems": 400, "Payments": 240}
    root = f"{tmp_path}/seed"
    assert sum(seed(spark, root, plan_rows(1000), 1000).values()) == 1000
    seed(spark, root, plan_rows(1000), 1000)
    c = spark.read.parquet(f"{root}/Customers")
    assert c.count() == 200 and c.agg(F.max("CustomerId")).first()[0] == 200
    with pytest.raises(ValueError):
        seed(spark, f"{tmp_path}/empty", plan_rows(rows={"Orders": 5}), 1000)
    good = validate.validate(c, c, "CustomerId")
    assert all(r["match"] for r in good.collect())
    bad = {r["check"]: r["match"] for r in validate.validate(c, c.where("CustomerId <> 3"), "CustomerId").collect()}
    assert not bad["row_count"] and not bad["hash_buckets"] and bad["pk_bounds"]


def test_demo(spark):
    from keelson.operators.seed import demo_changes, demo_lines, demo_orders

    orders, lines = demo_orders(spark, 60_000), demo_lines(spark, 1000)
    o, n = demo_changes(orders, lines)
    assert n.count() == 2900 and o.count() == 60_000 - 100 + 2 and o.where("Status = 'refunded' AND Amount <= 0").count() == 500 and o.where("Channel = 'mobile'").count() == 50


def test_jobs(spark, tmp_path):
    from keelson.jobs import Conflict, JobManager, NotFound, health, start_seed

    m = JobManager()
    job = start_seed(m, spark, f"{tmp_path}/jobs", total=1000, batch=1000)
    with pytest.raises(Conflict):
        m.start("x", {}, lambda j: None)
    m.jobs[job["id"]].thread.join(120)
    assert m.get(job["id"])["status"] == "succeeded" and m.list()[0]["id"] == job["id"]
    with pytest.raises(NotFound):
        m.get("nope")
    with pytest.raises(Conflict):
        m.cancel(job["id"])
    assert health(spark, str(tmp_path))["code"] == 200 and health(spark, "nofs://x")["code"] == 503


def test_sync_report(spark, tmp_path):
    """The report of a timed run: rows on both sides, the snapshot's parts and seconds, sizes from the footers; parameters have bounds."""
    from keelson.jobs import BadParameters, JobManager, start_sync

    src, sup = make(spark, tmp_path, 120)
    m = JobManager()
    with pytest.raises(BadParameters, match="workers must be a number from 1 to 64: 0\nbatch_size"):
        start_sync(m, sup, workers=0, batch_size=True)
    with pytest.raises(BadParameters, match="nonsense is no parameter"):
        start_sync(m, sup, nonsense=1)
    job = start_sync(m, sup, timeout=300, batch_size=40)
    m.jobs[job["id"]].thread.join(200)
    report = m.get(job["id"])["result"]
    orders = report["tables"]["dbo.Orders"]
    assert report["allMatch"] and report["rows"] == 180 and (orders["source_rows"], orders["target_rows"], orders["match"], orders["parts"]) == (120, 120, True, 4)
    assert orders["files"] >= 4 and 0 < orders["bytes"] and 0 < orders["raw_bytes"] and orders["seconds"] >= 0 and orders["compression"] > 0
    assert report["settings"] == {"timeout": 300, "batch_size": 40}


def test_command_line(spark, tmp_path, capsys):
    from keelson.cli import main

    src, _ = make(spark, tmp_path, 20)
    cfg = tmp_path / "c.yaml"
    cfg.write_text(f"source: {{server: s, database: d}}\ntarget: {{root: 'file://{tmp_path}/cli'}}\nsync: {{poll_interval: 0.01, min_rows_per_partition: 1000000}}\ntables: [{{source: dbo.Orders}}]\n")
    args = ["-c", str(cfg)]
    assert main([*args, "check", "--ddl"], src) == 0 and "key (OrderId)" in capsys.readouterr().out
    assert main([*args, "run", "--seconds", "8"], src) == 0
    assert main([*args, "status"], src) == 0 and "cdc" in capsys.readouterr().out
    assert main([*args, "resync", "dbo.Orders"], src) == 0
    assert main(["-c", str(tmp_path / "missing.yaml"), "status"]) == 2


def pumped(sup, until, most=60):
    import time

    end = time.monotonic() + most
    while not until():
        assert time.monotonic() < end
        sup.pump(0.05)


def test_changes_go_on_during_a_snapshot(spark, tmp_path):
    """A snapshot takes its share of the slots at most; another table's changes are followed meanwhile."""
    import threading

    src, _ = make(spark, tmp_path, 40)
    sync = sync_settings(workers=2, poll_interval=0.0, snapshot_partitions=4, min_rows_per_partition=10)
    sup = Supervisor(spark, src, f"file://{tmp_path}/side", sync, [table_settings("sales.Lines", target="lines")])
    pumped(sup, lambda: sup.states["sales.lines"].phase == CDC)
    gate, base = threading.Event(), src.base
    src.base = lambda key: base(key) if key != "dbo.Orders" or sup.states["dbo.orders"].phase != SNAPSHOT or gate.wait(60) else None
    sup.explicit["dbo.orders"] = table_settings("dbo.Orders")
    sup.refresh()
    pumped(sup, lambda: sup.busy("dbo.orders", SNAPSHOT))
    src.upsert("sales.Lines", OrderId=1, LineNo=1, Sku="CHANGED")
    pumped(sup, lambda: sup.states["sales.lines"].last_version == src.version)
    assert len(sup.busy("dbo.orders", SNAPSHOT)) == 1 and sup.states["dbo.orders"].phase == SNAPSHOT and sup.heartbeat()["running"] >= 1
    same(src, sup, "sales.Lines")
    gate.set()
    pumped(sup, lambda: sup.states["dbo.orders"].phase == CDC)
    same(src, sup, "dbo.Orders")
    del sup.explicit["dbo.orders"]
    pumped(sup, lambda: not sup.busy("dbo.orders"))
    sup.refresh()
    assert set(sup.states) == {"sales.lines"}
    sup.shutdown()


@pytest.mark.parametrize("key", ["dbo.Orders", "sales.Lines"])
def test_resume_inside_a_range(spark, tmp_path, key):
    """A supervisor that stops between two pages leaves its place; the next one goes on there, by key range or between splitters."""
    src, _ = make(spark, tmp_path, 60)
    sync = sync_settings(workers=1, poll_interval=0.0, snapshot_partitions=1, batch_size=7)
    run = lambda: Supervisor(spark, src, f"file://{tmp_path}/paged", sync, [table_settings(key, target="t")])
    first = run()
    s = first.states[key.lower()]
    while not s.progress or s.progress["0"]["page"] < 3:
        first.schedule()
        first.collect(0.02)
    first.shutdown()
    page = s.progress["0"]["page"]
    assert not s.progress["0"]["done"] and bool(s.cuts) == (key == "sales.Lines")
    second = run()
    assert second.states[key.lower()].progress["0"]["page"] == page
    second.step()
    same(src, second, key)
    store = second.store(key)
    assert len(store.manifest(store.live())["batches"]) == 9
    second.shutdown()


def test_layout_views_grace_and_compaction(spark, tmp_path):
    from types import SimpleNamespace

    src, _ = make(spark, tmp_path, 30)
    target = SimpleNamespace(create_views=True, view_suffix="_now", merge_fan=3, grace_seconds=0.0)
    sup = Supervisor(spark, src, f"file://{tmp_path}/lay", sync_settings(poll_interval=0.0), [table_settings("dbo.Orders", partition_by="CustomerId % 3", order_by=["CustomerId", "OrderId"])], target=target)
    sup.step()
    store = sup.store("dbo.Orders")
    batch = next(iter(store.manifest(store.live())["batches"]))
    assert [n for n in store.files.names(f"{store.path}/{store.live()}/{batch}") if "=" in n] == [f"_partition={i}" for i in range(3)]
    for n in range(5):
        src.upsert("dbo.Orders", OrderId=1, CustomerId=n, Status=f"s{n}")
        sup.step()
    assert spark.table("Orders_now").where("OrderId = 1").select("Status").first()[0] == "s4" and "_synced_at" in spark.table("Orders_now").columns
    assert len(store.manifest(store.live())["batches"]) < 5  # merged on the way
    old = store.live()
    sup.request_resync("dbo.orders")
    sup.step()
    assert store.live() != old and old in store.files.names(store.path)  # readers may hold it
    store.purge(3600)
    assert old in store.files.names(store.path)
    store.purge(0)
    assert old not in store.files.names(store.path)
    same(src, sup, "dbo.Orders")
    sup.shutdown()


def test_two_processes_write_requests(spark, tmp_path):
    from keelson.sources.store import MetaStore

    a, b = (MetaStore(spark, f"file://{tmp_path}/meta") for _ in range(2))
    for i in range(3):
        a.append("sync_requests", {"n": i}, 1e9 + i)
        b.append("sync_requests", {"n": 10 + i}, 1e9 + i)
    a.save("table_state", "dbo.A", {"x": "y" * 9000})
    b.save("table_state", "dbo.B", {"x": 2})
    assert sorted(r["n"] for r in a.rows("sync_requests")) == [0, 1, 2, 10, 11, 12]
    assert set(b.latest("table_state")) == {"dbo.A", "dbo.B"} and len(b.latest("table_state")["dbo.A"]["x"]) == 9000
    a.append("sync_requests", {"n": 99}, 1e9 + 31 * 86_400)
    assert [r["n"] for r in a.rows("sync_requests")] == [99]


def test_stream_offsets_come_from_footers(spark, tmp_path):
    from keelson.streaming.change_stream import _Reader

    spark.range(1000).selectExpr("id as k", "id + 5 as version").repartition(3).write.parquet(f"{tmp_path}/feed")
    r = _Reader({"path": f"file://{tmp_path}/feed", "columns": "k", "start": "7", "parts": "3"})
    assert r.latestOffset() == {"v": 1004} and len(r.groups) == 3
    parts = r.partitions({"v": 7}, {"v": 1004})
    assert len(parts) == 3 and sum(b.num_rows for p in parts for b in r.read(p)) == 997
    assert _Reader({"path": f"{tmp_path}/feed", "columns": "k"}).latestOffset() == {"v": 1004}


@pytest.mark.parametrize("limit", [1, 30, 200, 5000])
def test_stream_batches_are_bounded(spark, tmp_path, limit):
    """A batch has `limit` changes at most or is one version; together they are everything once, in about equal partitions."""
    from keelson.streaming.change_stream import _Reader

    rnd = random.Random(limit)
    rows = [(i, v) for v in sorted(rnd.sample(range(10, 4000), 150)) for i in range(rnd.choice([1, 1, 2, 9, 60]))]
    rnd.shuffle(rows)
    spark.createDataFrame(rows, "k long, version long").repartition(5).write.parquet(f"{tmp_path}/feed")
    options = {"path": f"file://{tmp_path}/feed", "columns": "k", "max_rows": str(limit), "parts": "4"}
    r, at, seen = _Reader(options), 0, []
    while (end := r.latestOffset()["v"]) > at:
        inside = sorted(v for _, v in rows if at < v <= end)
        assert len(inside) <= limit or len(set(inside)) == 1
        behind = [v for _, v in rows if v > end]
        assert not behind or len(inside) + behind.count(min(behind)) > limit or len(inside) > limit  # as much as fits
        parts = r.partitions({"v": at}, {"v": end})
        got = sorted(v for p in parts for b in r.read(p) for v in b.column(1).to_pylist())
        assert got == inside and (parts[0].low, parts[-1].high) == (at, end)
        r.commit({"v": end})
        seen, at = seen + got, end
    assert sorted(seen) == sorted(v for _, v in rows)


def test_a_bounded_stream_goes_on_after_a_restart(spark, tmp_path):
    from keelson.plans.model import spec_of
    from keelson.sources.store import TableStore
    from keelson.streaming.change_stream import apply_bounded, read_changes

    base = spark.range(100).selectExpr("id as k", "id * 2 as v")
    spec = spec_of(base, "t", ["k"])
    store = TableStore(spark, f"file://{tmp_path}/store", "t")
    store.create("g", spec)
    store.write_batch("g", "snap", ch.snapshot_scan(base, spec, 0), base=True)
    store.cut_over("g")
    feed = lambda: read_changes(spark, f"file://{tmp_path}/feed", "k long", max_rows=10, checkpoint=f"file://{tmp_path}/checkpoint")
    spark.range(35).selectExpr("id as k", "id + 1 as version").write.parquet(f"file://{tmp_path}/feed")
    assert apply_bounded(feed(), lambda: base.withColumn("v", F.lit(-1).cast("long")), store, spec, f"file://{tmp_path}/checkpoint") == [10, 10, 10, 5]
    spark.range(12).selectExpr("id as k", "id + 100 as version").write.mode("append").parquet(f"file://{tmp_path}/feed")
    assert apply_bounded(feed(), lambda: base.withColumn("v", F.lit(-2).cast("long")), store, spec, f"file://{tmp_path}/checkpoint") == [10, 2]
    got = dict(map(tuple, store.current(keep_meta=False).collect()))
    assert got == {k: -2 if k < 12 else -1 if k < 35 else 2 * k for k in range(100)}
