"""SentencePiece encoding and decoding of whole texts; the segmentation is pieces.PieceModel's."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from keelson.llm.common import free_name, table
from keelson.llm.pieces import SPACE, default_path, piece_model

#: Characters of text that are segmented together.
SLICE_CHARS = 2_000_000


def _slices(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t)
        if size >= SLICE_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _encode(path: str, report: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path)
        for b in batches:
            at = 0
            for texts in _slices([t or "" for t in b.column(0).to_pylist()]):
                ids = model.encode(texts)
                rest = b.columns[1:]
                sliced = [c.slice(at, len(texts)) for c in rest]
                at += len(texts)
                counts = pa.array([len(x) // 4 for x in ids], pa.int64())
                if report:
                    back = [model.decode(x) for x in ids]
                    out = {
                        "n_tokens": counts,
                        "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                        "decoded_sha256": pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in back]),
                        "round_trip": pa.array([t == s.replace(SPACE, " ") for t, s in zip(back, texts, strict=True)]),
                    }
                else:
                    flat = np.frombuffer(b"".join(ids), "<i4")
                    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
                    out = {"n_tokens": counts, "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))}
                yield pa.RecordBatch.from_arrays([*sliced, *out.values()], [*b.schema.names[1:], *out])

    return run


def encode_texts(docs: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """docs with n_tokens (long) and ids (array of int): whole texts as the library encodes them, no begin or end id.

    The names get underscores where docs has them. A null text counts as empty and has no ids. Rows are independent.
    """
    text, n, ids = free_name(docs, "text_"), free_name(docs, "n_tokens"), free_name(docs, "ids")
    out = StructType([*docs.schema.fields, StructField(n, LongType()), StructField(ids, ArrayType(IntegerType()))])
    rows = docs.select(F.col(text_col).cast("string").alias(text), *[F.col(f"`{c}`") for c in docs.columns])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _encode(path or default_path(), False)(batches):
            yield b.rename_columns([*b.schema.names[:-2], n, ids])

    return rows.mapInArrow(renamed, out)


def decode_ids(rows: DataFrame, ids_col: str = "ids", text_name: str = "text", path: str | None = None) -> DataFrame:
    """rows with the text that the ids spell in a column text_name, with underscores where rows has one; null ids give null."""
    name, place = free_name(rows, text_name), rows.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(path or default_path())
        for b in batches:
            texts = [None if x is None else model.decode(np.array(x, "<u4").tobytes()) for x in b.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, name])

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(name, StringType())]))


def encode_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers), decoded_sha256, round_trip.

    Every text is encoded, its ids decoded, and the result compared: round_trip is false only where the library's own
    differs, in texts that hold a character which normalisation changes. Null texts count as empty.
    """
    rows = docs.select(F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("doc_id"))
    return rows.mapInArrow(_encode(path or default_path(), True), "doc_id long, n_tokens long, ids_crc32 long, decoded_sha256 string, round_trip boolean")


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_report(table(spark, sf_dir, "documents"))
