"""Token counts with a whole-token shortcut.

The driver puts every vocabulary string through the merges, once; those that end as one token are whole, and the set of them
is broadcast (its size is the vocabulary's). A pre-token that is a whole string counts one without merging, only the others
are merged. See bytebpe.TokenCounter.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keelson.llm.bytebpe import default_path, token_counter, whole_tokens
from keelson.llm.common import table

LIMIT = 512


def _count(path: str, whole: Broadcast, limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(path, whole.value)
        for b in batches:
            sizes, counts = [], []
            for t in b.column(1):
                t = t.as_py() or ""
                sizes.append(len(t.encode("utf-8")))
                counts.append(counter.count(t))
            n = pa.array(counts, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), n, pa.array([x > limit for x in counts], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit), one row per row of docs, whole texts.

    path: a byte-level BPE file of the tokenizers library; another kind is an error. The counts are the library's own: special strings inside a
    text are one token each, nothing is added, cut or padded. A null text counts as empty: no bytes, no tokens. Null and
    repeated ids are passed on; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    path = path or default_path()
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(path))
    return rows.mapInArrow(_count(path, whole, limit), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op7_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
