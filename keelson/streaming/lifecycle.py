"""The life of a replicated table: new -> snapshot -> cdc -> resync -> snapshot -> ...

The supervisor alone changes table state and cuts over; tasks in a pool of threads plan, read, write, merge and commit, and
report back. Snapshot ranges take part of the pool's slots at most, so that changes of other tables are followed while a
snapshot runs; Spark shares executors between them by FAIR pools. A snapshot fixes its version before the first read and goes
through each range page by page; a page is committed before the range's place moves behind it. Pages are key ranges - of an integer
key by arithmetic, of any other key between splitters - so each is one scan that the bounds prune. Change ticks read the source
as it stands at one moment and write before they move the version. So a crash at any point repeats one page or tick, which
overwrites itself. Readers see the old generation until the cut-over. Merges run beside the ticks of their table.
"""

from __future__ import annotations

import logging
import queue
import threading
import time
import uuid
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from types import SimpleNamespace

from keelson.functions.keys import shard_owner
from keelson.operators.changes import change_scan, snapshot_scan
from keelson.plans.partitions import in_key_range, plan_ranges, splitters
from keelson.plans.settings import sync_settings, table_settings
from keelson.sources.change_source import ChangeSource, ResyncRequired, TrackingDisabled, check_retention, key_bounds
from keelson.sources.store import FAN, MetaStore, TableStore

log = logging.getLogger(__name__)
NEW, SNAPSHOT, CDC, RESYNC = "new", "snapshot", "cdc", "resync"
PLAN, MERGE = "plan", "merge"  # kinds of tasks besides SNAPSHOT and CDC
#: Seconds between two heartbeats.
HEARTBEAT = 30.0


@dataclass
class TableState:
    table_key: str
    phase: str = NEW
    last_version: int = 0
    snapshot_id: str | None = None
    snapshot_version: int = 0
    ranges: list = field(default_factory=list)
    bounds: list = field(default_factory=list)  # least and greatest key when the snapshot was planned
    pages: int = 1  # equal pages that a range of an integer key is cut into
    cuts: list = field(default_factory=list)  # of other keys: the keys between pages, as text; a range is then [first page, page behind the last]
    progress: dict = field(default_factory=dict)  # range number: {"page": committed pages, "rows", "done"}
    rows_synced: int = 0  # rows written, over snapshots and ticks; not a row count
    last_success: float = 0.0
    last_error: str = ""
    resync_handled_at: float = 0.0
    failures: int = 0
    next_run: float = 0.0

    @property
    def done(self) -> list[int]:
        return [int(k) for k, p in self.progress.items() if p["done"]]


def backoff(failures: int, most: float = 300.0) -> float:
    return min(most, 2.0 ** min(failures, 16))


def page_bounds(bounds: tuple, key_range: tuple, pages: int, page: int) -> tuple:
    """Page `page` of a key range, as wide as the others; the range's own ends stay as they are, open or not."""
    low = bounds[0] if bounds[0] is not None else key_range[0]
    high = bounds[1] if bounds[1] is not None else key_range[1] + 1
    cut = lambda i: low + (high - low) * i // pages
    return (bounds[0] if page == 0 else cut(page), bounds[1] if page == pages - 1 else cut(page + 1))


class Supervisor:
    def __init__(self, spark, source: ChangeSource, root: str, sync: SimpleNamespace | None = None, tables: list[SimpleNamespace] = (), clock=time.time, target: SimpleNamespace | None = None):
        self.spark, self.source, self.sync, self.clock = spark, source, sync or sync_settings(), clock
        self.root = root.rstrip("/")
        self.target = target or SimpleNamespace(create_views=False, view_suffix="_current", merge_fan=FAN, grace_seconds=3600.0)
        self.meta = MetaStore(spark, f"{self.root}/_meta")
        self.configs: dict[str, SimpleNamespace] = {}
        self.states: dict[str, TableState] = {}
        self.explicit = {t.key.lower(): t for t in tables}
        self.stopping = threading.Event()
        self.pool = ThreadPoolExecutor(self.sync.workers, thread_name_prefix="keelson")
        self.running: dict[Future, tuple[str, str, int]] = {}  # table, kind of task, range
        self.reports: queue.Queue = queue.Queue()
        self.dirty: set[str] = set()
        self.asked: dict[str, dict] = {}  # the last request of each table that has not been looked at
        self.logged: list[dict] = []  # rows of the log that flush() writes
        source.probe()
        self.next_refresh = self.next_flush = self.next_beat = 0.0
        self.refresh()

    # tables

    def refresh(self) -> None:
        """Configured tables and, with auto_discover, all tracked ones; configured entries win. Only this shard's are taken;
        a table that is gone is dropped once nothing of it runs."""
        wanted = {k: table_settings(k) for k in self.source.tables()} if self.sync.auto_discover else {}
        wanted = {k.lower(): t for k, t in wanted.items()} | self.explicit
        wanted = {k: t for k, t in wanted.items() if shard_owner(k, self.sync.shard_count) == self.sync.shard_index}
        saved = {k.lower(): v for k, v in self.meta.latest("table_state").items()}
        for low, t in wanted.items():
            self.configs[low] = t
            if low not in self.states:
                old = {k: v for k, v in saved.get(low, {}).items() if k in TableState.__dataclass_fields__}
                self.states[low] = TableState(**{**old, "failures": 0, "next_run": 0.0}) if old else TableState(t.key)
        for low in [k for k in self.states if k not in wanted and not self.busy(k)]:
            del self.states[low], self.configs[low]
        self.next_refresh = self.clock() + self.sync.schema_refresh_seconds

    def busy(self, low: str, kind: str | None = None) -> list[int]:
        return [part for k, what, part in self.running.values() if k == low and kind in (None, what)]

    def store(self, key: str) -> TableStore:
        return TableStore(self.spark, self.root, self.configs[key.lower()].target_table, self.target.merge_fan)

    def spec(self, key: str):
        t = self.configs[key.lower()]
        return self.source.spec(t.key, tuple(t.exclude_columns))

    def save(self, s: TableState) -> None:
        self.meta.save("table_state", s.table_key, dict(s.__dict__))
        self.dirty.discard(s.table_key.lower())

    def log(self, s: TableState, task: str, status: str, rows: int, began: float, message: str = "") -> None:
        self.logged.append({"ts": self.clock(), "table_key": s.table_key, "task": task, "status": status, "rows": rows, "duration_ms": int(1000 * (self.clock() - began)), "message": message})

    # requests

    def request_resync(self, *keys: str) -> None:
        for k in keys:
            self.meta.append("sync_requests", {"table_key": k, "action": "resync", "requested_at": self.clock()}, self.clock())

    def apply_requests(self) -> None:
        """A request newer than the last one handled sends its table to resync and ends its backoff."""
        for r in self.meta.news("sync_requests"):
            self.asked[r["table_key"].lower()] = r
        for low, r in list(self.asked.items()):  # also those of tables that were not known when they came
            s = self.states.get(low)
            if s:
                del self.asked[low]
            if s and r["action"] == "resync" and r["requested_at"] > s.resync_handled_at:
                s.phase, s.resync_handled_at, s.failures, s.next_run = RESYNC, r["requested_at"], 0, 0.0
                self.save(s)

    # snapshot

    def plan_snapshot(self, s: TableState) -> dict:
        """Version, generation and ranges of a new snapshot, as fields of the state. Runs as a task: it counts rows and may sample keys."""
        floor = self.source.min_valid_version(s.table_key)
        if floor is None:
            raise TrackingDisabled(f"{s.table_key}: change tracking is off")
        version = max(self.source.current_version(), floor)  # before any read: rows read later can only be newer
        spec, t = self.spec(s.table_key), self.configs[s.table_key.lower()]
        base, rows = self.source.base(s.table_key), self.source.approx_rows(s.table_key)
        most, column, bounds, cuts, pages = t.snapshot_partitions or self.sync.snapshot_partitions, spec.single_integer_pk(), [], [], 1
        if column:
            low, high = key_bounds(base, column)
            bounds = [low, high] if low is not None else []
            ranges = plan_ranges(low, high, rows, most, self.sync.min_rows_per_partition)
            pages = max(1, -(-rows // (len(ranges) * self.sync.batch_size))) if bounds else 1
        else:
            cuts = splitters(base, spec.pk, max(1, -(-rows // self.sync.batch_size)), rows)
            n = max(1, min(most, rows // self.sync.min_rows_per_partition, len(cuts) + 1))
            ranges = [((len(cuts) + 1) * i // n, (len(cuts) + 1) * (i + 1) // n) for i in range(n)]
        snapshot = uuid.uuid4().hex[:12]
        self.store(s.table_key).create(snapshot, spec, t.order_by, t.partition_by)
        progress = {str(i): {"page": 0, "rows": 0, "done": False} for i in range(len(ranges))}
        return {"snapshot_id": snapshot, "snapshot_version": version, "ranges": [list(r) for r in ranges], "bounds": bounds, "cuts": cuts, "pages": pages, "progress": progress, "phase": SNAPSHOT}

    def _planned(self, s: TableState, plan: dict) -> None:
        s.__dict__.update(plan)
        self.save(s)

    def _snapshot_range(self, low: str, s: TableState, part: int, at: dict) -> None:
        """Writes and commits the range page by page from where it stands, and reports each page. Ends at a page when stopped."""
        store, spec, base = self.store(low), self.spec(low), self.source.base(s.table_key)
        while not (at["done"] or self.stopping.is_set()):
            began = self.clock()
            if s.cuts or not s.bounds:
                first, end = s.ranges[part] if s.cuts else (0, 1)
                edges, page = [None, *s.cuts, None], first + at["page"]
                rows, pages = snapshot_scan(base.where(in_key_range(base, spec.pk, edges[page], edges[page + 1])), spec, s.snapshot_version), end - first
            else:
                rows, pages = snapshot_scan(base, spec, s.snapshot_version, page_bounds(tuple(s.ranges[part]), tuple(s.bounds), s.pages, at["page"])), s.pages
            n = store.write_batch(s.snapshot_id, f"snap-{part:05d}-{at['page']:06d}", rows, base=True)
            at = {"page": at["page"] + 1, "rows": at["rows"] + n, "done": at["page"] + 1 >= pages}
            self.reports.put((low, s.snapshot_id, part, at, n, began))

    def finalize(self, s: TableState) -> None:
        """The cut-over; repeated after a crash it finds the generation live and only saves the state."""
        self.store(s.table_key).cut_over(s.snapshot_id)
        s.phase, s.last_version, s.ranges, s.cuts, s.progress, s.last_success = CDC, s.snapshot_version, [], [], {}, self.clock()
        self.save(s)
        self.view(s)

    def view(self, s: TableState) -> None:
        if self.target.create_views:
            self.store(s.table_key).create_view(self.configs[s.table_key.lower()].target_table + self.target.view_suffix)

    def resume(self, s: TableState) -> None:
        """A snapshot whose generation is gone starts anew; one that is live already is finished."""
        store = self.store(s.table_key)
        if store.live() != s.snapshot_id and store.manifest(s.snapshot_id or "-") is None:
            s.phase = NEW

    # changes

    def tick(self, s: TableState) -> tuple[int, int]:
        """One round of changes: the version reached and the rows written. Floor, version, changes and base rows are those of one moment, where the source can."""
        last = s.last_version
        store = self.store(s.table_key)
        n = 0
        with self.source.session(s.table_key) as at:
            spec = at.spec(s.table_key, tuple(self.configs[s.table_key.lower()].exclude_columns))
            store.evolve(store.live(), spec)
            check_retention(at, s.table_key, last)
            version = max(at.current_version(), last)
            if version > last:
                changes = at.changes(s.table_key, last, version).cache()
                try:
                    keys = changes.count()
                    if keys:
                        rows = change_scan(changes, at.base(s.table_key), spec, last, version, seq=version, few_keys=keys)
                        n = store.write_batch(store.live(), f"cdc-{version:020d}", rows)
                    check_retention(self.source, s.table_key, last)  # history lost while reading, where a session can't hold it
                finally:
                    changes.unpersist()
        store.purge(self.target.grace_seconds)
        return version, n

    def merge(self, s: TableState) -> list[dict]:
        return self.store(s.table_key).merge()

    # scheduling

    def _submit(self, low: str, kind: str, part: int, work, *args) -> None:
        def task():
            sc = self.spark.sparkContext
            sc.setLocalProperty("spark.scheduler.pool", kind)
            sc.setJobGroup(f"keelson-{id(self)}", f"{kind} {low}", interruptOnCancel=True)
            began = self.clock()
            return work(*args), began

        self.running[self.pool.submit(task)] = (low, kind, part)

    def _schedule_table(self, low: str, s: TableState) -> None:
        """Submits what the table can do now, within the slots that are free."""
        if s.phase in (NEW, RESYNC):
            if not self.busy(low):  # work of the generation before ends first
                self._submit(low, PLAN, 0, self.plan_snapshot, s)
            return
        if s.phase == SNAPSHOT:
            if not self.busy(low):
                self.resume(s)
                if s.phase == NEW:
                    self._submit(low, PLAN, 0, self.plan_snapshot, s)
                    return
                if all(p["done"] for p in s.progress.values()) or self.store(low).live() == s.snapshot_id:
                    self.finalize(s)
                    s.next_run = self.clock() + self._poll(low)
                    return
            taken = self.busy(low, SNAPSHOT)
            for part in range(len(s.ranges)):
                at = s.progress[str(part)]
                if len(self.running) >= self.sync.workers or sum(k == SNAPSHOT for _, k, _ in self.running.values()) >= self.sync.max_snapshot_workers:
                    return
                if not at["done"] and part not in taken:
                    self._submit(low, SNAPSHOT, part, self._snapshot_range, low, s, part, dict(at))
        elif s.phase == CDC and not self.busy(low, CDC) and len(self.running) < self.sync.workers:
            self._submit(low, CDC, 0, self.tick, s)
            store = self.store(low)
            if not self.busy(low, MERGE) and len(self.running) < self.sync.workers and store.due(store.live()):
                self._submit(low, MERGE, 0, self.merge, s)

    def _poll(self, low: str) -> float:
        t = self.configs[low]
        return self.sync.poll_interval if t.poll_interval is None else t.poll_interval

    def schedule(self, only: set[str] | None = None) -> None:
        now = self.clock()
        for low, s in sorted(self.states.items(), key=lambda x: x[1].next_run):
            if self.stopping.is_set() or len(self.running) >= self.sync.workers:
                return
            if s.next_run > now or only is not None and low not in only:
                continue
            try:
                self._schedule_table(low, s)
            except Exception as e:  # noqa: BLE001
                self._fail(s, s.phase, e, now)

    def collect(self, timeout: float) -> set[str]:
        """Takes in what tasks report and how they end; returns the tables whose tick or snapshot range ended."""
        if self.running:
            wait(self.running, timeout, FIRST_COMPLETED)
        ended = [f for f in self.running if f.done()]
        self._take_reports()
        out = set()
        for f in ended:
            low, kind, _ = self.running.pop(f)
            out.add(low)
            s = self.states[low]
            try:
                result, began = f.result()
            except Exception as e:  # noqa: BLE001
                self._fail(s, kind, e, self.clock())
                continue
            s.failures, s.last_error = 0, ""
            if kind == PLAN and s.phase != CDC:
                self._planned(s, result)
            elif kind == MERGE and result:
                self.log(s, MERGE, "ok", sum(x["written"] for x in result), began)
                self.view(s)
            elif kind == CDC and s.phase == CDC:  # a request may have come in between
                self._moved(s, *result, began)
                s.next_run = self.clock() + self._poll(low)
        return out

    def _take_reports(self) -> None:
        while not self.reports.empty():
            low, snapshot, part, at, n, began = self.reports.get()
            s = self.states[low]
            if s.snapshot_id == snapshot and s.phase == SNAPSHOT:
                s.progress[str(part)] = at
                s.rows_synced += n
                self.save(s)
                self.log(s, f"snapshot[{part}]", "ok", n, began)

    def _moved(self, s: TableState, version: int, n: int, began: float) -> None:
        # moves on without changes too, else an idle table would fall behind the retention
        s.last_version, s.rows_synced, s.last_success = version, s.rows_synced + n, self.clock()
        self.dirty.add(s.table_key.lower())
        if n:
            self.save(s)
            self.log(s, "cdc", "ok", n, began)
            self.view(s)

    def _fail(self, s: TableState, task: str, e: Exception, began: float) -> None:
        if isinstance(e, ResyncRequired):
            s.phase, s.last_error = RESYNC, str(e)
            self.log(s, task, "resync", 0, began, str(e))
        else:
            s.failures += 1
            s.last_error = f"{type(e).__name__}: {e}"[:4000]
            s.next_run = self.clock() + backoff(s.failures, self.sync.max_backoff_seconds)
            self.log(s, task, "error", 0, began, s.last_error)
        self.save(s)

    def flush(self) -> None:
        for low in list(self.dirty):
            if low in self.states:
                self.save(self.states[low])
        self.dirty.clear()
        logged, self.logged = self.logged, []
        self.meta.extend("sync_log", logged, self.clock())

    def step(self) -> None:
        """One round to its end: requests, then every due table one move further, a snapshot as a whole."""
        self.apply_requests()
        now = self.clock()
        due = {low for low, s in self.states.items() if s.next_run <= now}
        while due and not self.stopping.is_set():
            loading = {low for low in due if self.states[low].phase == SNAPSHOT}
            self.schedule(due)
            due -= {low for low in loading if self.states[low].phase == CDC}  # cut over: that was the move
            if not self.running:
                break
            for low in self.collect(1.0):
                s = self.states[low]
                if s.phase != SNAPSHOT and not self.busy(low, CDC) or s.next_run > self.clock():
                    due.discard(low)
            due -= {low for low in due if self.states[low].next_run > self.clock()}
        while self.running:
            self.collect(1.0)
        self.flush()

    def pump(self, timeout: float = 0.5) -> None:
        """One turn of the service: what is due is submitted, what has ended is taken in; nothing waits for a snapshot."""
        now = self.clock()
        if now >= self.next_refresh:
            self.refresh()
        self.apply_requests()
        self.schedule()
        self.collect(timeout)
        if self.clock() >= self.next_flush:
            self.flush()
            self.next_flush = self.clock() + self.sync.state_flush_seconds
        if self.clock() >= self.next_beat:
            log.info("%s", self.heartbeat())
            self.next_beat = self.clock() + HEARTBEAT

    def heartbeat(self) -> dict:
        phases: dict[str, int] = {}
        for s in self.states.values():
            phases[s.phase] = phases.get(s.phase, 0) + 1
        return {"phases": phases, "errors": sum(bool(s.last_error) for s in self.states.values()), "rows": sum(s.rows_synced for s in self.states.values()), "running": len(self.running)}

    def run(self, seconds: float | None = None) -> None:
        end = None if seconds is None else self.clock() + seconds
        while not self.stopping.is_set() and (end is None or self.clock() < end):
            self.pump(min(0.5, self.sync.poll_interval))
            if not self.running:
                time.sleep(min(0.2, self.sync.poll_interval))
        self.shutdown()

    def stop(self) -> None:
        self.stopping.set()

    def shutdown(self) -> None:
        """Lets tasks end at their next page or tick; what still runs after shutdown_timeout is cancelled."""
        self.stopping.set()
        end = time.monotonic() + self.sync.shutdown_timeout
        while self.running and time.monotonic() < end:
            self.collect(min(1.0, self.sync.shutdown_timeout))
        if self.running:
            self.spark.sparkContext.cancelJobGroup(f"keelson-{id(self)}")
            self.collect(5.0)
        self.flush()
        self.pool.shutdown(wait=False, cancel_futures=True)
