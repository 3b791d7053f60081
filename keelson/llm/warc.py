"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

Each record is a gzip member of its own. Records of equal payloads point at one response. The reader streams through an
archive member by member and record by record, so it holds one record at a time whatever the archive's size. After a
failed check - a member that doesn't inflate or whose CRC is wrong, a header that doesn't parse, a length beyond the data,
a payload digest that differs - it looks for the next member that inflates to a version line, or the next version line,
goes on there, and reports the bytes in between as a quarantined gap. Of a member that fails as a whole, the records whose
payload digests hold are recovered.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm.common import cut, fresh_dir, table
from keelson.llm.files import FolderWriter, open_file

#: Payloads from this size on may be replaced by a reference to an equal one.
REVISIT_BYTES = 1000
#: Compressed size at which an archive is closed and the next begun.
ARCHIVE_BYTES = 8 << 20
LEVEL = 3
MAGIC = b"\x1f\x8b\x08"
VERSION = re.compile(rb"WARC/1\.[01]\r?\n")
START = re.compile(re.escape(MAGIC) + rb"|WARC/1\.[01]\r?\n")
HEADER_END = re.compile(rb"\r?\n\r?\n")
#: Bytes read at a time; the longest header; the longest record, beyond which it is quarantined as a gap.
PIECE, HEADER_BYTES, RECORD_BYTES = 1 << 18, 1 << 20, 1 << 28
#: No row holds more.
LARGEST = 1 << 32
#: Gaps up to this size come with their bytes.
GAP_BYTES = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# --- records


def record_bytes(page_id: int | None, url: str | None, payload: bytes, digest_hex: str, refers_to: int | None, is_response: bool) -> bytes:
    """One record: version line, named fields, HTTP header and, in a response, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if is_response else http
    digest = base64.b32encode(bytes.fromhex(digest_hex)).decode()
    fields = {
        "WARC-Type": "response" if is_response else "revisit",
        "WARC-Record-ID": f"<urn:page:{'null' if page_id is None else page_id}>",
        "WARC-Date": "1970-01-01T00:00:00Z",
        "WARC-Target-URI": None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": None if is_response else PROFILE,
        "WARC-Refers-To": None if is_response else f"<urn:page:{refers_to}>",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items() if v is not None) + "\r\n"
    return head.encode("utf-8") + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


@dataclass
class Record:
    offset: int
    fields: dict[str, str]
    block: bytes
    verified: bool = False  # its payload has the digest that the header gives

    @property
    def payload(self) -> bytes | None:
        """What follows the HTTP header; None in a revisit."""
        if self.fields.get("warc-type") == "revisit":
            return None
        head, sep, body = self.block.partition(b"\r\n\r\n")
        return body if sep and head.startswith(b"HTTP/") else self.block

    @property
    def http_length(self) -> int | None:
        m = re.search(rb"(?im)^content-length:\s*(\d+)", self.block.partition(b"\r\n\r\n")[0])
        return int(m[1]) if m else None


class Damage(Exception):
    pass


@dataclass
class Gap:
    """Quarantined bytes: a range of the archive, or of the inflated member that stands in that range."""

    offset: int
    end: int
    reason: str
    inner: int | None = None
    inner_end: int | None = None


def sha1_hex(field: str) -> str | None:
    """The digest of a field like sha1:..., in base32 or hex of any case, as lower-case hex; None for all else."""
    kind, _, value = field.strip().partition(":")
    if kind.lower() != "sha1":
        return None
    if re.fullmatch(r"[0-9a-fA-F]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch(r"[A-Za-z2-7]{32}", value) else None


class Feed:
    """Bytes that come in pieces: read() gives the next ones, none at the end. buf begins at pos."""

    def __init__(self, read, size: int | None = None):
        self.read, self.size, self.buf, self.pos, self.ended = read, size, bytearray(), 0, False

    def ensure(self, n: int) -> bool:
        """Whether n bytes are there, read as far as needed."""
        while len(self.buf) < n and not self.ended:
            if piece := self.read():
                self.buf += piece
            else:
                self.ended = True
        return len(self.buf) >= n

    def drop(self, n: int) -> None:
        del self.buf[:n]
        self.pos += n


def file_feed(f, at: int, size: int) -> Feed:
    place = at

    def read() -> bytes:
        nonlocal place
        f.seek(place)
        piece = f.read(PIECE)
        place += len(piece)
        return piece

    return Feed(read, size - at)


class Member:
    """The gzip member at a place of a file, inflated piece by piece; then either end or error is set."""

    def __init__(self, f, at: int):
        self.f, self.at, self.end, self.error = f, at, None, None
        self.z, self.waiting = zlib.decompressobj(31), b""

    def read(self) -> bytes:
        while self.end is None and self.error is None:
            if not self.waiting:
                self.f.seek(self.at)
                self.waiting = self.f.read(PIECE)
                self.at += len(self.waiting)
                if not self.waiting:
                    self.error = "member is cut off"
                    break
            before = self.z.copy()
            try:
                out = self.z.decompress(self.waiting, 4 * PIECE)
            except zlib.error as e:
                self.error = f"member doesn't inflate: {e}"
                return self._last(before)
            self.waiting = self.z.unconsumed_tail
            if self.z.eof:
                self.end = self.at - len(self.z.unused_data)
            if out:
                return out
        return b""

    def _last(self, z) -> bytes:
        """What the bytes in front of the damage give."""
        out = bytearray()
        try:
            for i in range(len(self.waiting)):
                out += z.decompress(self.waiting[i : i + 1])
        except zlib.error:
            pass
        return bytes(out)

    def check(self) -> Member:
        """Inflates all of it and forgets it."""
        while self.read():
            pass
        return self


def parse_record(feed: Feed, offset: int, most: int) -> tuple[Record, int]:
    """The record that the feed begins with, checked, and its size; offset is where it stands in the archive."""
    feed.ensure(12)
    m = VERSION.match(feed.buf)
    if not m:
        raise Damage("no version line")
    end, looked = None, m.end() - 1
    while not (end := HEADER_END.search(feed.buf, looked)):
        looked = max(m.end() - 1, len(feed.buf) - 4)
        if len(feed.buf) > (HEADER_BYTES if most <= RECORD_BYTES else most) or not feed.ensure(len(feed.buf) + 1):
            raise Damage("header without end")
    fields: dict[str, str] = {}
    for line in bytes(feed.buf[m.end() : end.start()]).splitlines():
        name, sep, value = line.partition(b":")
        if not sep:
            raise Damage("header line without a colon")
        fields[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d{1,18}", fields.get("content-length", ""), re.A):
        raise Damage("no content length")
    start = end.end()
    stop = start + int(fields["content-length"])
    if feed.size is not None and feed.pos + stop + 4 > feed.size:
        raise Damage("block doesn't end where its length says")
    if stop > most:
        raise Damage(f"record of more than {most} bytes")
    if not feed.ensure(stop + 4) or feed.buf[stop : stop + 4] != b"\r\n\r\n":
        raise Damage("block doesn't end where its length says")
    record = Record(offset, fields, bytes(memoryview(feed.buf)[start:stop]))
    said = sha1_hex(fields.get("warc-payload-digest", ""))
    if said and record.payload is not None:
        if hashlib.sha1(record.payload).hexdigest() != said:
            raise Damage("payload digest differs")
        record.verified = True
    return record, stop + 4


def records_in(feed: Feed, offset: int, end: int, most: int, sound: bool) -> Iterator[Record | Gap]:
    """Records of an inflated member and the gaps between them; of a member that isn't sound, only records whose digest holds."""
    lost, why = None, ""
    while feed.ensure(1):
        try:
            record, size = parse_record(feed, offset, most)
        except Damage as e:
            if lost is None:
                lost, why = feed.pos, str(e)
            feed.drop(1)
            skip_to_version(feed)
            continue
        if lost is not None and sound:
            yield Gap(offset, end, why, lost, feed.pos)
        lost = None
        feed.drop(size)
        if sound or record.verified:
            yield record
    if lost is not None and sound:
        yield Gap(offset, end, why, lost, feed.pos)


def skip_to_version(feed: Feed) -> None:
    while feed.ensure(1):
        m = VERSION.search(feed.buf)
        if m:
            feed.drop(m.start())
            return
        held = len(feed.buf)
        if not feed.ensure(held + 1):
            feed.drop(len(feed.buf))
        else:
            feed.drop(max(0, held - 16))  # a version line may be cut


def salvage(f, most: int = RECORD_BYTES) -> Iterator[Record | Gap]:
    """All records of an archive (a seekable file) that pass their checks, and the byte ranges that had to be left out."""
    size, at = f.seek(0, 2), 0
    while at < size:
        f.seek(at)
        if f.read(3) == MAGIC:
            whole = Member(f, at).check()
            if whole.error is None:
                yield from records_in(Feed(Member(f, at).read), at, whole.end, most, True)
                at = whole.end
                continue
            yield from records_in(Feed(Member(f, at).read), at, size, most, False)
            why = whole.error
        else:
            feed = file_feed(f, at, size)
            try:
                record, n = parse_record(feed, at, most)
                yield record
                at += n
                continue
            except Damage as e:
                why = str(e)
        end = next_start(f, at + 1, size)
        yield Gap(at, end, why)
        at = end


def next_start(f, at: int, size: int) -> int:
    """The next place from `at` on where a member inflates to a version line or a version line stands."""
    while at < size:
        f.seek(at)
        piece = f.read(PIECE)
        last = at + len(piece) >= size
        for m in START.finditer(piece):
            if m[0] != MAGIC:
                return at + m.start()
            if VERSION.match(Member(f, at + m.start()).read()[:64]):
                return at + m.start()
        if last:
            break
        at += len(piece) - 16
    return size


# --- tables


def assign_records(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> DataFrame:
    """page_id, url, payload, digest, refers_to and is_response of every row.

    The largest page_id per digest is found by a combined aggregation, and only digests that occur twice travel back.
    """
    payload = F.encode(F.coalesce(F.col(html_col).cast("string"), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    shared = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    rows = rows.join(shared, "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return rows.select("page_id", "url", "payload", "digest", F.when(revisit, F.col("first_id")).alias("refers_to"), (~revisit).alias("is_response"))


def _write(root: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        folder, f, files, size, records = None, None, 0, 0, 0
        for b in batches:
            for page_id, url, payload, digest, refers_to, is_response in zip(*(c.to_pylist() for c in b.columns), strict=True):
                data = member(record_bytes(page_id, url, payload, digest, refers_to, is_response))
                folder = folder or FolderWriter(root, f"part-{part:06d}")
                if f is None:
                    f, size, files = folder.open(f"{files:05d}.warc.gz"), 0, files + 1
                f.write(data)
                size, records = size + len(data), records + 1
                if size >= archive_bytes:
                    f.close()
                    f = None
        if f is not None:
            f.close()
        if folder:
            folder.commit()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, files, records)], ["part", "archives", "records"])

    return run


def write_warc(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = REVISIT_BYTES, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes a record per row below root (part-*/*.warc.gz) and returns part, archives, records.

    The payload is the html in UTF-8, null being empty. Among records with equal payloads of `least` bytes or more, the
    one with the largest page_id is a response and the others revisit it; rows that repeat this page_id are responses
    too; of rows without any page_id all are responses. Smaller payloads are always written. Null urls leave the field
    out. Other columns are not read; an empty table writes nothing.
    """
    return cut(assign_records(pages, id_col, url_col, html_col, least).mapInArrow(_write(root, archive_bytes), "part long, archives long, records long"))


RECORDS = "archive string, offset long, end long, inner long, inner_end long, record_type string, record_id string, url string, payload_bytes long, payload_digest string, refers_to string, payload binary, gap string"


def _row(path: str, found: Record | Gap, f, with_payload: bool) -> tuple:
    if isinstance(found, Gap):
        data = None
        if with_payload and found.inner is None and found.end - found.offset <= GAP_BYTES:
            f.seek(found.offset)
            data = f.read(found.end - found.offset)
        return (path, found.offset, found.end, found.inner, found.inner_end, None, None, None, None, None, None, data, found.reason)
    payload, fields = found.payload, found.fields
    digest = sha1_hex(fields.get("warc-payload-digest", "")) or (None if payload is None else hashlib.sha1(payload).hexdigest())
    n = len(payload) if payload is not None else found.http_length
    return (path, found.offset, None, None, None, fields.get("warc-type"), fields.get("warc-record-id"), fields.get("warc-target-uri"), n, digest, fields.get("warc-refers-to"), payload if with_payload else None, None)


def _read(with_payload: bool, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = zip(*(x.split() for x in RECORDS.split(", ")), strict=True)
        kinds = [{"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[k] for k in kinds]
        rows: list[tuple] = []
        size = 0

        def give() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            return b

        for b in batches:
            for path in b.column(0).to_pylist():
                with open_file(path) as f:
                    for found in salvage(f, most):
                        rows.append(_row(path, found, f, with_payload))
                        size += len(rows[-1][11] or b"")
                        if len(rows) >= 1000 or size >= 16 << 20:
                            yield give()
                            size = 0
        if rows:
            yield give()

    return run


def read_warc(spark: SparkSession, *paths: str, with_payload: bool = True, most: int = RECORD_BYTES) -> DataFrame:
    """The records of archives, gzipped by record, gzipped as a whole or plain, and the quarantined gaps.

    Gaps are rows with a reason in `gap` and the byte range offset to end; inside a sound member the range inner to
    inner_end of its inflated bytes. Records have gap null. payload is null in revisits, whose payload_bytes is the length
    that the HTTP header gives; small gaps have their bytes in it. payload_digest is the record's own sha1 (base32 or hex, in
    hex) or, where it gives none that can be read, that of the payload. Spark lists the archives, tasks stream them: each is
    read by one task, a record at a time, and may be of any size. A record of more than `most` bytes is a gap, and so is a header
    of more than HEADER_BYTES, unless `most` is above RECORD_BYTES: then it bounds headers too.
    """
    files = spark.read.format("binaryFile").load(list(paths)).select("path")
    return files.mapInArrow(_read(with_payload, most), RECORDS)


def page_of(record_id: str):
    """The page_id in a record id of this writer, null for null."""
    return F.expr(f"try_cast(regexp_extract({record_id}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")


def op8_warc(spark, sf_dir: str) -> DataFrame:
    """Writes and reads back all pages. Records that are lost on the way are an error, not a shorter result."""
    root = fresh_dir(spark, "warc")
    written = write_warc(table(spark, sf_dir, "pages"), root).agg(F.sum("records")).first()[0] or 0
    if not written:
        return spark.createDataFrame([], "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
    records = cut(read_warc(spark, f"{root}/part-*/*.warc.gz", with_payload=False, most=LARGEST))  # what was written is no damage, however long it is
    read = records.agg(F.count_if(F.col("gap").isNull()).alias("records"), F.count("gap").alias("gaps")).first()
    if read["gaps"] or read["records"] != written:
        raise ValueError(f"{written} records written, {read['records']} read, {read['gaps']} gaps below {root}")
    return records.select(page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_of("refers_to").alias("refers_to"))


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM m
"""
