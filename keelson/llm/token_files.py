"""Token ids in binary shards of patched frame-of-reference blocks.

Rows are range-partitioned and sorted by doc_id; each partition encodes its texts and writes one folder of shards that
appears by a rename. A shard is
  b"KTOK" u16 version u16 block size, u32 documents,
  i64 doc_id and u8 null flag of each, u64 end of each document in the shard's ids (offsets), u64 ids before the shard in its partition,
  then one PFOR array (see pfor.py) with all ids, each document's end id included.
Reading back takes the shards of the committed folders; a prefix sum over partitions turns local into global starts.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm import pfor
from keelson.llm.bytebpe import default_path, id_encoder
from keelson.llm.common import cut, fresh_dir, table
from keelson.llm.files import FolderWriter

END_ID = 0
SHARD_IDS = 1 << 20


def shard_bytes(doc_ids: list, ids: list[bytes], before: int) -> bytes:
    ends = np.cumsum([len(x) // 4 for x in ids]).astype("<u8") if ids else np.zeros(0, "<u8")
    keys = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([b"KTOK", struct.pack("<HHI", 1, pfor.BLOCK, len(ids)), keys.tobytes(), nulls.tobytes(), ends.tobytes(), struct.pack("<Q", before), pfor.encode(np.frombuffer(b"".join(ids), "<u4"))])


def read_shard(data: bytes) -> tuple[list, np.ndarray, int, np.ndarray]:
    """doc_ids, the end of each document, the ids before this shard in its partition, all ids."""
    if data[:4] != b"KTOK" or struct.unpack_from("<HH", data, 4) != (1, pfor.BLOCK):
        raise ValueError("not a token shard")
    (n,) = struct.unpack_from("<I", data, 8)
    keys, nulls = np.frombuffer(data, "<i8", n, 12), np.frombuffer(data, np.uint8, n, 12 + 8 * n)
    ends = np.frombuffer(data, "<u8", n, 12 + 9 * n)
    (before,) = struct.unpack_from("<Q", data, 12 + 17 * n)
    return [None if z else int(k) for k, z in zip(keys, nulls, strict=True)], ends, before, pfor.decode(data[20 + 17 * n :])


def _write(path: str, root: str, end_id: int):
    end = struct.pack("<I", end_id)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = id_encoder(path), TaskContext.get().partitionId()
        folder, shards, total, docs = None, 0, 0, 0
        ids: list[bytes] = []
        keys: list = []
        held = 0

        def flush() -> None:
            nonlocal folder, shards, total, held, docs
            folder = folder or FolderWriter(root, f"part-{part:06d}")
            with folder.open(f"{shards:06d}.ktok") as f:
                f.write(shard_bytes(keys, ids, total))
            shards, total, docs, held = shards + 1, total + held, docs + len(keys), 0
            keys.clear()
            ids.clear()

        for b in batches:
            for i in range(0, b.num_rows, 256):
                part_of = b.slice(i, 256)
                for key, x in zip(part_of.column(0).to_pylist(), encoder.encode([t or "" for t in part_of.column(1).to_pylist()]), strict=True):
                    keys.append(key)
                    ids.append(x + end)
                    held += len(x) // 4 + 1
                    if held >= SHARD_IDS:
                        flush()
        if keys:
            flush()
        if folder:
            folder.commit()
            yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (part, shards, docs, total)], ["part", "shards", "documents", "ids"])

    return run


def write_tokens(docs: DataFrame, root: str, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes the shards below root and returns the manifest: part, shards, documents, ids.

    Order is by doc_id, nulls first; rows that share an id follow each other by a hash of the text. A null text is
    empty: its document holds the end id only. Other columns are not read. An empty table writes nothing.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # ranges of id and text: the rows of one id, or without any, are no task of their own
    rows = rows.withColumn("h", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").drop("h")
    return cut(ordered.mapInArrow(_write(path or default_path(), root, end_id), "part long, shards long, documents long, ids long"))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for name, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            part = int(name.split("/")[-2].removeprefix("part-"))
            keys, ends, before, ids = read_shard(data.as_py())
            raw = ids.astype("<u4").tobytes()
            starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
            sums = [zlib.crc32(raw[4 * int(a) : 4 * int(z)]) for a, z in zip(starts, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(keys), pa.int64()), pa.array(keys, pa.int64()), pa.array(starts + before), pa.array(ends.astype(np.int64) - starts), pa.array(sums, pa.int64())], ["part", "doc_id", "local_start", "n_tokens", "ids_crc32"])


def read_token_index(spark: SparkSession, root: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the shards below root."""
    schema = "part long, doc_id long, local_start long, n_tokens long, ids_crc32 long"
    if manifest.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.ktok").load(f"{root}/part-*").select("path", "content")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition written
    base = manifest.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    return files.mapInArrow(_read, schema).join(base, "part").select("doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    root = fresh_dir(spark, "tokens")
    manifest = write_tokens(table(spark, sf_dir, "documents"), root)
    return read_token_index(spark, root, manifest)
