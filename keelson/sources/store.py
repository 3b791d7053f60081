"""Target storage: generations of batch folders, a manifest of committed ones, a pointer to the live generation.

<root>/<table>/<generation>/<batch>/*.parquet   one folder per snapshot range, page or change tick
<root>/<table>/<generation>/MANIFEST.json       committed batches with schema, version range, rows
<root>/<table>/LIVE                             the generation that readers see

<root>/<table>/TRASH.json                       what is no longer named, and since when

A batch is written first and committed after; a repeated batch overwrites its folder. A cut-over replaces the pointer,
which names the generation, so doing it twice does nothing. Folders that a cut-over or a merge leaves stay for a
grace period, since running readers may hold them.

The manifest names every batch's level and files, with the least and greatest first key of each file. Level BASE holds one row
per key, in batches of disjoint key ranges; changes arrive at level 0. FAN batches of a level are merged into one of the next
level. When the changes of a level outgrow the base divided by FAN, they go into the base, of which only the batches that
their keys meet are written anew. So a change is rewritten once for each level, a number of times that grows with the logarithm of the
table, and the part of the base that nobody changes is never rewritten. Readers use the same bounds: base files that no
change can touch are read as they are, without window or shuffle. Small files go through Hadoop's FileSystem, by a temporary file and a
rename, so root may be any path that Spark can write. A table has one writing process; threads of it take turns.
"""

from __future__ import annotations

import json
import logging
import re
import threading
import time
import uuid
from bisect import bisect_right
from collections import defaultdict
from functools import reduce
from typing import Any
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.functions.typemap import widens
from keelson.operators.changes import compact, current
from keelson.plans.model import DELETED, SEQ, SYNCED_AT, VERSION, SchemaError, TableSpec
from keelson.plans.partitions import between, range_index, splitters
from keelson.sources.change_source import TypeChanged
from keelson.sources.files import Files
from keelson.sources.footers import facts, footer_frame

_locks: dict[str, threading.RLock] = defaultdict(threading.RLock)
log = logging.getLogger(__name__)

PARTITION, SLOT = "_partition", "_slot"
#: The level of batches with one row per key, and the batches of a level that are merged at once, also the ratio of the sizes of levels.
BASE, FAN = -1, 8
#: Base batches that one job of a merge rewrites at most, and seconds between the tries of a write.
RANGES_AT_ONCE = 500
#: Rows of a base batch; one that a merge makes twice as large is cut.
SLOT_ROWS = 1_000_000
RETRY_SECONDS = (1.0, 2.0, 4.0, 8.0)


def partition_value(expression: str):
    """A partition_by expression: a column, an SQL expression, or toYYYYMM(column)."""
    m = re.fullmatch(r"\s*toYYYYMM\((.+)\)\s*", expression)
    return F.date_format(F.expr(m[1]), "yyyyMM") if m else F.expr(expression).cast("string")


def zone(files: list[list]) -> tuple[Any, Any] | None:
    """The least and greatest first key of files; None if a file does not say."""
    bounds = [(f[2], f[3]) for f in files]
    return None if any(a is None or z is None for a, z in bounds) or not bounds else (min(a for a, _ in bounds), max(z for _, z in bounds))


def _reaches(z: tuple[Any, Any] | None, low: Any, high: Any) -> bool:
    """Whether keys of a zone may lie in [low, high); None is open."""
    return z is None or ((high is None or z[0] < high) and (low is None or z[1] >= low))


def _owners(base: dict[str, tuple[Any, Any] | None]) -> list[tuple[Any, list[str]]]:
    """Base batches in key order, each with its least key; batches that overlap, or don't say where they are, are one."""
    if any(z is None for z in base.values()):
        return [(None, sorted(base))] if base else []
    out: list[list] = []
    for b, (low, high) in sorted(base.items(), key=lambda x: (x[1], x[0])):
        if out and low <= out[-1][2]:
            out[-1][1].append(b)
            out[-1][2] = max(out[-1][2], high)
        else:
            out.append([low, [b], high])
    return [(low, bs) for low, bs, _ in out]


def split_files(m: dict) -> tuple[list[list], list[list]]:
    """Base files whose keys no change can have, and all other files."""
    base = [f for e in m["batches"].values() if e["level"] == BASE for f in e["files"]]
    changes = [f for e in m["batches"].values() if e["level"] != BASE for f in e["files"]]
    zones = sorted(((f[2], f[3]) for f in changes if f[2] is not None and f[3] is not None), key=lambda z: z[0])
    unknown = any(f[2] is None or f[3] is None for f in changes)
    lows, tops = [a for a, _ in zones], []
    for _, z in zones:
        tops.append(z if not tops else max(tops[-1], z))  # the greatest key of the zones so far

    def met(f: list) -> bool:
        if unknown or f[2] is None or f[3] is None:
            return bool(changes)
        at = bisect_right(lows, f[3])
        return at > 0 and tops[at - 1] >= f[2]

    calm, stirred = [], list(changes)
    for f in base:
        (stirred if met(f) else calm).append(f)
    return calm, stirred


class TableStore:
    def __init__(self, spark: SparkSession, root: str, table: str, fan: int = FAN):
        self.spark, self.path, self.files, self.fan = spark, f"{root.rstrip('/')}/{table}", Files(spark), fan
        self.lock = _locks[self.path]

    # generations

    def live(self) -> str | None:
        return self.files.read(f"{self.path}/LIVE")

    def cut_over(self, generation: str) -> str | None:
        """Makes a generation live; the one before goes to the trash and is returned."""
        old = self.live()
        if old == generation:
            return None
        self.files.write(f"{self.path}/LIVE", generation)
        if old:
            self.discard([old])
        return old

    def discard(self, names: list[str]) -> None:
        with self.lock:
            trash = json.loads(self.files.read(f"{self.path}/TRASH.json") or "{}")
            self.files.write(f"{self.path}/TRASH.json", json.dumps(trash | {n: time.time() for n in names}))

    def purge(self, grace: float) -> list[str]:
        """Deletes what has been in the trash for longer than grace seconds."""
        with self.lock:
            trash = json.loads(self.files.read(f"{self.path}/TRASH.json") or "{}")
            gone = [n for n, since in trash.items() if since <= time.time() - grace]
            for n in gone:
                self.files.delete(f"{self.path}/{n}")
            if gone:
                self.files.write(f"{self.path}/TRASH.json", json.dumps({n: t for n, t in trash.items() if n not in gone}))
        return gone

    def manifest(self, generation: str) -> dict | None:
        text = self.files.read(f"{self.path}/{generation}/MANIFEST.json")
        return json.loads(text) if text else None

    def create(self, generation: str, spec: TableSpec, order_by: list[str] | None = None, partition_by: str | None = None) -> None:
        """An empty generation. order_by is a layout, rows are told apart by the key alone; it must hold the whole key."""
        order = order_by or spec.pk
        if missing := set(spec.pk) - set(order):
            raise SchemaError(f"order_by lacks the key columns {sorted(missing)}")
        if unknown := set(order) - {c.name for c in spec.columns}:
            raise SchemaError(f"order_by has unknown columns {sorted(unknown)}")
        m = {"pk": spec.pk, "order_by": order, "partition_by": partition_by, "schema": spec.struct().jsonValue(), "batches": {}, "comment": f"keelson:{generation}"}
        self._save(generation, m)

    def _save(self, generation: str, manifest: dict) -> None:
        self.files.write(f"{self.path}/{generation}/MANIFEST.json", json.dumps(manifest))

    def evolve(self, generation: str, spec: TableSpec) -> list[str]:
        """Takes in the source's columns; returns what changed.

        New columns join the schema, nullable; columns that the source dropped stay and get nulls. A column whose type got
        wider takes the wider type, as which the files written before can be read. Any other change of a type needs a new
        generation.
        """
        with self.lock:
            m = self.manifest(generation)
            fields = m["schema"]["fields"]
            own = {f.name.lower(): (f, at) for at, f in enumerate(T.StructType.fromJson(m["schema"]).fields)}
            changed, new = [], []
            for c in spec.columns:
                kind = c.mapping.spark_type
                if c.name.lower() not in own:
                    new.append(T.StructField(c.name, kind, True).jsonValue())
                    continue
                f, at = own[c.name.lower()]
                if f.dataType == kind:
                    continue
                if not widens(f.dataType, kind) or (c.pk_ordinal and not isinstance(kind, T.IntegralType)):
                    raise TypeChanged(f"{spec.key}.{c.name} was {f.dataType.simpleString()} and is {kind.simpleString()}")
                fields[at] = T.StructField(f.name, kind, f.nullable).jsonValue()
                changed.append(c.name)
            at = next(i for i, f in enumerate(fields) if f["name"] == VERSION)
            fields[at:at] = new
            if changed or new:
                self._save(generation, m)
            return changed + [f["name"] for f in new]

    # batches

    def write_files(self, generation: str, batch: str, rows: DataFrame) -> dict:
        """Writes a batch's files, stamped with the time of writing, sorted by the layout, in folders by partition_by.

        Returns its rows and version bounds, observed while they pass. A failed write is tried again after each of RETRY_SECONDS.
        """
        m = self.manifest(generation)
        rows = rows.withColumn(SYNCED_AT, F.date_trunc("MILLISECOND", F.current_timestamp()).cast("timestamp_ntz"))
        if m["partition_by"]:
            rows = rows.withColumn(PARTITION, partition_value(m["partition_by"]))
        order = [PARTITION] * bool(m["partition_by"]) + [f"`{c}`" for c in m["order_by"]]
        for wait in (*RETRY_SECONDS, None):
            seen = Observation()
            writer = rows.observe(seen, F.count(F.lit(1)).alias("n"), F.min(VERSION).alias("a"), F.max(VERSION).alias("z")).sortWithinPartitions(*order).write
            try:
                self._write(writer.partitionBy(PARTITION) if m["partition_by"] else writer, f"{self.path}/{generation}/{batch}")
                return seen.get
            except Exception:
                if wait is None:
                    raise
                log.warning("writing %s/%s failed, next try in %s s", generation, batch, wait, exc_info=True)
                time.sleep(wait)

    def _write(self, writer, path: str) -> None:
        writer.mode("overwrite").parquet(path)

    def _entry(self, generation: str, batch: str, seen: dict, level: int, key: str) -> dict:
        top = f"{self.path}/{generation}/"
        paths = self.files.walk(f"{top}{batch}", ".parquet")
        at = len(paths[0]) - len(paths[0].split(f"/{generation}/", 1)[1]) if paths else 0  # walk() gives qualified paths
        files = [[f.path[at:], f.rows, f.low, f.high, f.packed, f.raw] for f in facts(self.spark, paths, key)]
        return {"rows": seen["n"], "versions": [seen["a"], seen["z"]], "level": level, "files": [f for f in files if f[1]]}

    def commit_batch(self, generation: str, batch: str, seen: dict, level: int = 0, instead: list[str] = ()) -> int:
        """Puts a written batch into the manifest, instead of others that it replaces; returns its rows. A batch without rows leaves no folder."""
        entry = self._entry(generation, batch, seen, level, self.manifest(generation)["pk"][0]) if seen["n"] else None
        with self.lock:
            m = self.manifest(generation)
            for b in (batch, *instead):
                m["batches"].pop(b, None)
            if entry:
                m["batches"][batch] = entry
            self._save(generation, m)
        if instead:
            self.discard([f"{generation}/{b}" for b in instead])
        if not entry:
            self.files.delete(f"{self.path}/{generation}/{batch}")
        return seen["n"]

    def write_batch(self, generation: str, batch: str, rows: DataFrame, base: bool = False) -> int:
        """Writes and commits a batch, replacing an earlier try. base: its rows have keys that no other base batch has, each once."""
        return self.commit_batch(generation, batch, self.write_files(generation, batch, rows), BASE if base else 0)

    # reading

    def _read(self, generation: str, m: dict, files: list[list]) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        paths = [f"{self.path}/{generation}/{f[0]}" for f in files]
        return self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def log(self, generation: str | None = None, batches: list[str] | None = None) -> DataFrame:
        """All committed rows, or those of some batches; files of uncommitted batches are not seen."""
        generation = generation or self.live()
        m = self.manifest(generation)
        return self._read(generation, m, [f for b, e in m["batches"].items() if batches is None or b in batches for f in e["files"]])

    def current(self, generation: str | None = None, keep_meta: bool = True) -> DataFrame:
        """Live rows. Base files whose keys no file of changes can have are read as they are; only the rest goes through the window."""
        generation = generation or self.live()
        m = self.manifest(generation)
        calm, stirred = split_files(m)
        merged = current(self._read(generation, m, stirred), m["pk"], keep_meta)
        if not calm:
            return merged
        as_is = self._read(generation, m, calm).where(F.col(DELETED) == 0).select(*merged.columns)
        return as_is.unionByName(merged) if stirred else as_is

    def create_view(self, name: str) -> None:
        self.current().createOrReplaceTempView(name)

    # merging

    def due(self, generation: str) -> tuple[list[str], int] | None:
        """What to merge next: batches and the level they go to; None if every level is small enough."""
        m = self.manifest(generation)
        levels: dict[int, list[str]] = defaultdict(list)
        for b, e in m["batches"].items():
            levels[e["level"]].append(b)
        base = sum(m["batches"][b]["rows"] for b in levels.pop(BASE, []))
        for level in sorted(levels):
            if len(levels[level]) >= self.fan:
                upper = [b for k in levels if k >= level for b in levels[k]]
                if self.fan * sum(m["batches"][b]["rows"] for b in upper) >= base:
                    return upper, BASE
                return levels[level], level + 1
        return None

    def merge(self, most: int = 100) -> list[dict]:
        """Merges batches of the live generation until every level is small enough; what each step read and wrote."""
        generation, done = self.live(), []
        while generation and len(done) < most and (step := self.due(generation)):
            done.append(self._into_base(generation, step[0]) if step[1] == BASE else self._up(generation, *step))
        return done

    def _up(self, generation: str, batches: list[str], level: int) -> dict:
        m = self.manifest(generation)
        rows = compact(self.log(generation, batches), m["pk"], keep_tombstones=True).drop(SYNCED_AT)
        batch = f"level{level}-{uuid.uuid4().hex[:8]}"
        n = self.commit_batch(generation, batch, self.write_files(generation, batch, rows), level, batches)
        return {"level": level, "read": sum(m["batches"][b]["rows"] for b in batches), "written": n, "left_alone": 0}

    def _into_base(self, generation: str, changes: list[str]) -> dict:
        """Writes the base batches that changes meet anew, tombstones included: replayed old changes must still lose.

        A base batch owns the keys from its least one up to the next batch's; the first one owns what is before, too. So every
        changed key belongs to one batch, also a new key. Bounds are first-column keys; batches that share one are
        rewritten together.
        """
        m = self.manifest(generation)
        base = {b: zone(e["files"]) for b, e in m["batches"].items() if e["level"] == BASE}
        zones = [zone([f]) for b in changes for f in m["batches"][b]["files"]]
        groups = _owners(base)
        lows = [low for low, _ in groups]
        hit = [i for i in range(len(groups)) if any(_reaches(z, lows[i] if i else None, lows[i + 1] if i + 1 < len(lows) else None) for z in zones)]
        if not groups:
            hit, groups, lows = [0], [(None, [])], [None]
        done = {"level": BASE, "read": sum(m["batches"][b]["rows"] for b in changes), "written": 0, "left_alone": sum(len(bs) for i, (_, bs) in enumerate(groups) if i not in hit)}
        kind = next(f for f in T.StructType.fromJson(m["schema"]).fields if f.name == m["pk"][0]).dataType
        key = F.col(f"`{m['pk'][0]}`")
        name, part, log_ = uuid.uuid4().hex[:8], [], self.log(generation, changes)
        for at in range(0, len(hit), RANGES_AT_ONCE):
            some = hit[at : at + RANGES_AT_ONCE]
            # whole runs of neighbours: what lies between two hit batches belongs to none of them
            mine = reduce(Column.__or__, [between(key, kind, lows[i] if i else None, lows[i + 1] if i + 1 < len(lows) else None) for i in some])
            old = [b for i in some for b in groups[i][1]]
            done["read"] += sum(m["batches"][b]["rows"] for b in old)
            rows = compact(self.log(generation, old).unionByName(log_.where(mine)), m["pk"], keep_tombstones=True).drop(SYNCED_AT)
            edges = []
            for i in some:
                held = sum(m["batches"][b]["rows"] for b in groups[i][1])
                size = held + sum(m["batches"][b]["rows"] for b in changes) // len(hit)
                edges.append([lows[i]] if i else [None])
                if size > 2 * SLOT_ROWS:
                    inside = self.log(generation, groups[i][1]).unionByName(log_).where(between(key, kind, lows[i] if i else None, lows[i + 1] if i + 1 < len(lows) else None))
                    edges[-1] += [c[0] for c in splitters(inside, m["pk"][:1], -(-size // SLOT_ROWS), size)]
            edges = [e for es in edges for e in es][1:]
            rows = rows.withColumn(SLOT, range_index(key, kind, edges)).repartition(len(edges) + 1, SLOT)
            part.append((f"base{at // RANGES_AT_ONCE}-{name}", rows, old))
        written = []
        for folder, rows, old in part:
            rows = rows.withColumn(SYNCED_AT, F.date_trunc("MILLISECOND", F.current_timestamp()).cast("timestamp_ntz"))
            folders = [SLOT]
            if m["partition_by"]:
                rows, folders = rows.withColumn(PARTITION, partition_value(m["partition_by"])), [SLOT, PARTITION]
            self._write(rows.sortWithinPartitions(*folders, *[f"`{c}`" for c in m["order_by"]]).write.partitionBy(*folders), f"{self.path}/{generation}/{folder}")
            written.append((folder, old))
        versions = [v for b in [*changes, *[b for _, old in written for b in old]] for v in m["batches"][b]["versions"]]
        entries = {}
        for folder, _ in written:
            for slot in self.files.names(f"{self.path}/{generation}/{folder}"):
                if slot.startswith(f"{SLOT}="):
                    e = self._entry(generation, f"{folder}/{slot}", {"n": 0, "a": min(versions), "z": max(versions)}, BASE, m["pk"][0])
                    e["rows"] = sum(f[1] for f in e["files"])
                    entries[f"{folder}/{slot}"] = e
        gone = [*changes, *[b for _, old in written for b in old]]
        with self.lock:  # one change of the manifest: readers see all of the old batches or all of the new ones
            now = self.manifest(generation)
            now["batches"] = {b: e for b, e in now["batches"].items() if b not in gone} | entries
            self._save(generation, now)
        self.discard([f"{generation}/{b}" for b in gone])
        done["written"] = sum(e["rows"] for e in entries.values())
        return done

    def statistics(self) -> dict:
        """Rows, batches, files, packed and raw bytes of the live generation, as the footers had them at commit."""
        generation = self.live()
        m = self.manifest(generation) if generation else {"batches": {}}
        files = [f for e in m["batches"].values() for f in e["files"]]
        return {"rows": sum(f[1] for f in files), "parts": len(m["batches"]), "files": len(files), "bytes": sum(f[4] for f in files), "raw_bytes": sum(f[5] for f in files)}

    def storage(self) -> DataFrame:
        """path, rows, packed and raw bytes of every committed file of the live generation, by a job that reads the footers."""
        generation = self.live()
        files = [f"{self.path}/{generation}/{f[0]}" for e in self.manifest(generation)["batches"].values() for f in e["files"]] if generation else []
        return footer_frame(self.spark, files)


class MetaStore:
    """State as a small file per key of table_state; logs as segments in a folder per day, each written once.

    No file has two writers, so processes (a service, its shards, a resync from the command line) never lose each other's
    rows. Writing n rows costs n, whatever was written before. news() has a cursor: it lists the folders of the last days and
    opens only segments it has not read.
    """

    KEEP_DAYS = 30

    def __init__(self, spark: SparkSession, root: str):
        self.files, self.path, self.writer, self.written = Files(spark), root.rstrip("/"), uuid.uuid4().hex[:8], 0
        self.days: dict[str, int] = {}  # the last day written to, by log
        self.read: dict[str, set[str]] = {}  # segments that news() has given, by log
        self.lock = threading.Lock()

    def latest(self, name: str) -> dict[str, dict]:
        folder = f"{self.path}/{name}"
        rows = [json.loads(self.files.read(f"{folder}/{n}") or "null") for n in self.files.names(folder) if n.endswith(".json")]
        return {r["key"]: r["row"] for r in rows if r}

    def save(self, name: str, key: str, row: dict) -> None:
        self.files.write(f"{self.path}/{name}/{quote(key.lower(), safe='')}.json", json.dumps({"key": key, "row": row}))

    def append(self, name: str, row: dict, now: float) -> None:
        self.extend(name, [{"ts": now, **row}], now)

    def extend(self, name: str, rows: list[dict], now: float) -> None:
        """Adds rows, which have their times, as one segment; a new day's first one also deletes days older than KEEP_DAYS."""
        if not rows:
            return
        day = int(now // 86_400)
        with self.lock:
            at, self.written = self.written, self.written + 1
            fresh, self.days[name] = self.days.get(name) != day, day
        if fresh:
            self.expire(name, now)
        self.files.write(f"{self.path}/{name}/{day:06d}/{int(1000 * now):015d}-{self.writer}-{at:08d}.jsonl", "\n".join(map(json.dumps, rows)))

    def expire(self, name: str, now: float) -> None:
        oldest = int(now // 86_400) - self.KEEP_DAYS
        for n in self.files.names(f"{self.path}/{name}"):
            if n.isdigit() and int(n) < oldest:
                self.files.delete(f"{self.path}/{name}/{n}")

    def _segments(self, name: str, days: int | None = None) -> list[str]:
        folder = f"{self.path}/{name}"
        found = [n for n in self.files.names(folder) if n.isdigit()]
        return [f"{folder}/{day}/{n}" for day in found[-(days or len(found)) :] for n in self.files.names(f"{folder}/{day}") if n.endswith(".jsonl")]

    def _load(self, segments: list[str]) -> list[dict]:
        texts = [self.files.read(s) or "" for s in segments]
        return sorted((json.loads(x) for t in texts for x in t.split("\n") if x), key=lambda r: r["ts"])

    def rows(self, name: str) -> list[dict]:
        return self._load(self._segments(name))

    def news(self, name: str) -> list[dict]:
        """Rows that earlier calls have not given: at first all that are kept, then those of new segments of the last two days."""
        segments = self._segments(name, 2 if name in self.read else None)
        new = [s for s in segments if s not in self.read.get(name, ())]
        self.read[name] = set(segments)
        return self._load(new)
