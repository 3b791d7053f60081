"""SimHash near-duplicates by a binary trie self-join.

Fingerprints of whole texts are made in numpy, a batch at a time. Distinct fingerprints are joined with themselves:
three differing bits leave one of four blocks equal, so each fingerprint is dealt to four groups by block value. In a
group a binary trie over the remaining bits is walked against itself, all node pairs of one depth together: descending
by equal bits keeps the error count, by different bits adds one, and pairs beyond the budget are pruned. A group
larger than GROUP is dealt again by four blocks of its remaining bits, and so on: no task gets an unbounded group and
no link is lost. Each group gives a spanning star of every component it sees, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm import minhash
from keelson.llm.common import cut, free_name, row_key, table
from keelson.llm.components import connected_components, hot_join
from keelson.llm.shingles import shingle_parts

SEED, SHINGLE, BITS, BUDGET = 42, 3, 64, 3
#: Widths of the blocks at each dealing: 16 bits of 64, 12 of 48, 9 of 36, then 7, 7, 7 and 6 of 27.
DEALS = ((16, 16, 16, 16), (12, 12, 12, 12), (9, 9, 9, 9), (7, 7, 7, 6))
#: Fingerprints in a group beyond which it is dealt again; after the last dealing 2**21 are the most there can be.
GROUP = 2000
#: Node pairs of tries that are walked at once.
FRONTIER = 1 << 18


def fingerprints(texts: Iterable[bytes], n: int) -> np.ndarray:
    """One unsigned 64-bit fingerprint for each of n texts; zero for a text without words. Texts may be of any length: the
    hashes of a long one are counted bit by bit as they come."""
    ones, sizes = np.zeros((n, BITS), np.int64), np.zeros(n, np.int64)
    held: list[int] = []
    marks: list[tuple[int, int]] = []

    def settle() -> None:
        if not held:
            return
        bits = np.unpackbits(np.array(held, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts, rows = np.array([a for _, a in marks]), np.array([i for i, _ in marks])
        np.add.at(ones, rows, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
        np.add.at(sizes, rows, np.diff(starts, append=len(held)))
        held.clear()
        marks.clear()

    for i, t in enumerate(texts):
        for h in shingle_parts(t, SHINGLE, SEED):
            marks.append((i, len(held)))
            held += h
            if len(held) >= 50_000:
                settle()
    settle()
    return np.packbits(2 * ones > sizes[:, None], axis=1, bitorder="little").reshape(-1).view("<u8")


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = (t.as_py() or b"" for t in b.column(0).cast(pa.binary()))
        fp = pa.array(fingerprints(texts, b.num_rows).view(np.int64))
        yield pa.RecordBatch.from_arrays([*b.columns[1:], fp], [*b.schema.names[1:], "fp"])


def trie_links(groups: np.ndarray, values: np.ndarray, budget: int = BUDGET, most: int = FRONTIER) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (i, j) of values in one group that differ in at most budget bits, in batches.

    groups and values are sorted by group, then value, without repeats: a forest of binary tries, a node being a range.
    More than `most` node pairs at once are walked in parts, so what is held does not grow with the pairs that are found.
    """
    n = len(values)
    cuts = np.flatnonzero(np.diff(groups)) + 1
    lo = np.concatenate([[0], cuts])
    hi = np.concatenate([cuts, [n]])
    many = hi - lo > 1
    stack = [(BITS - 1, (lo[many], hi[many], lo[many], hi[many], np.zeros(int(many.sum()), np.int64)))]
    while stack:
        d, pairs = stack.pop()
        if len(pairs[0]) > most:
            half = len(pairs[0]) // 2
            stack += [(d, tuple(x[half:] for x in pairs)), (d, tuple(x[:half] for x in pairs))]
            continue
        if d < 0 or not len(pairs[0]):
            continue
        a_lo, a_hi, b_lo, b_hi, err = pairs
        a_mid, b_mid = _first_one(values, a_lo, a_hi, d), _first_one(values, b_lo, b_hi, d)
        cross = a_lo != b_lo
        parts = [
            (a_lo, a_mid, b_lo, b_mid, err),
            (a_mid, a_hi, b_mid, b_hi, err),
            (a_lo, a_mid, b_mid, b_hi, err + 1),
            (a_mid[cross], a_hi[cross], b_lo[cross], b_mid[cross], err[cross] + 1),
        ]
        a_lo, a_hi, b_lo, b_hi, err = (np.concatenate(x) for x in zip(*parts, strict=True))
        alone = (a_lo == b_lo) & (a_hi - a_lo == 1)
        keep = (a_hi > a_lo) & (b_hi > b_lo) & (err <= budget) & ~alone
        a_lo, a_hi, b_lo, b_hi, err = (x[keep] for x in (a_lo, a_hi, b_lo, b_hi, err))
        # a pair of leaves needs no further descent: the rest of its bits is compared at once
        leaf = (a_hi - a_lo == 1) & (b_hi - b_lo == 1)
        i, j = a_lo[leaf], b_lo[leaf]
        near = np.bitwise_count(values[i] ^ values[j]) <= budget
        if near.any():
            yield i[near], j[near]
        stack.append((d - 1, tuple(x[~leaf] for x in (a_lo, a_hi, b_lo, b_hi, err))))


def _first_one(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, d: int) -> np.ndarray:
    """Where bit d becomes one within each sorted range whose higher bits agree: a binary search of all ranges together."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        one = (values[np.minimum(mid, len(values) - 1)] >> np.uint64(d) & np.uint64(1)).astype(bool)
        hi, lo = np.where(open_ & one, mid, hi), np.where(open_ & ~one, mid + 1, lo)
    return lo


def stars(n: int, links: Iterable[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of n nodes the smallest node it reaches over the links, which come in batches."""
    root = np.arange(n)
    for i, j in links:
        while True:
            low = np.minimum(root[i], root[j])
            new = root.copy()
            for x in (i, j, root[i], root[j]):
                np.minimum.at(new, x, low)
            while (new != (deeper := new[new])).any():
                new = deeper
            if (new == root).all():
                break
            root = new
    return root


def _star_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (key, fp) in; edges (u, v) of spanning stars within each key out. The last key waits for the next batch."""
    keys, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)

    def run(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((f, k))
        k, f = k[order], f[order]
        root = stars(len(f), trie_links(k, f))
        own = np.flatnonzero(root != np.arange(len(f)))
        return pa.RecordBatch.from_arrays([pa.array(f[own].view(np.int64)), pa.array(f[root[own]].view(np.int64))], ["u", "v"])

    for b in batches:
        keys = np.concatenate([keys, b.column(0).to_numpy(zero_copy_only=False)])
        fps = np.concatenate([fps, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
        done = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0
        if done:
            yield run(keys[:done], fps[:done])
            keys, fps = keys[done:], fps[done:]
    if len(keys):
        yield run(keys, fps)


def _dealt(rest: Column, key: Column, widths: tuple[int, ...]) -> Column:
    """For every block of the remaining bits: the longer key and the bits left without the block."""
    out, at = [], 0
    for n, w in enumerate(widths):
        block = F.shiftrightunsigned(rest, at).bitwiseAND(F.lit((1 << w) - 1))
        above = F.lit(0).cast("long") if at + w >= 64 else F.shiftrightunsigned(rest, at + w)
        left = F.shiftleft(above, at).bitwiseOR(rest.bitwiseAND(F.lit((1 << at) - 1))) if at else above
        out.append(F.struct(F.shiftleft(key, w + 2).bitwiseOR(F.lit(n << w)).bitwiseOR(block).alias("key"), left.alias("rest")))
        at += w
    return F.explode(F.array(*out))


def fingerprint_links(distinct: DataFrame, group: int = GROUP) -> DataFrame:
    """Edges (u, v) that connect exactly the distinct fingerprints (column fp) linked by BUDGET bits or fewer."""
    rows = distinct.select("fp", F.col("fp").alias("rest"), F.lit(0).cast("long").alias("key"))
    edges = None
    for level, widths in enumerate(DEALS):
        rows = rows.select("fp", _dealt(F.col("rest"), F.col("key"), widths).alias("x")).select("fp", "x.key", "x.rest")
        ready, more = rows, None
        if level < len(DEALS) - 1:
            rows = cut(rows)
            big = rows.groupBy("key").count().where(F.col("count") > group).select("key")
            if level == 0:
                big = F.broadcast(big)  # at most 4 * 2**16 keys
            if not big.isEmpty():
                ready, more = rows.join(big, "key", "left_anti"), rows.join(big, "key", "left_semi")
            else:
                ready = rows
        found = ready.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(_star_batches, "u long, v long")
        edges = found if edges is None else edges.unionByName(found)
        if more is None:
            break
        rows = more.select("fp", "rest", "key")
    return edges


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns of carry, fp, component_id and component for every row.

    component_id is the smallest doc_id in reach of the row's fingerprint, component the smallest fingerprint in reach.

    Null and wordless texts have fingerprint zero, which links like any other. Rows with equal texts share a
    fingerprint. Null ids have no part in the minimum; a component of null ids has a null component_id. Repeated ids
    are ordinary rows. A text of any length is read a slice at a time.
    """
    rows = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.col(id_col).cast("long").alias("doc_id"), *carry)
    schema = ", ".join(["doc_id long", *[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry], "fp long"])
    rows = cut(rows.mapInArrow(_fingerprint_batches, schema))
    distinct = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(fingerprint_links(distinct))
    linked = roots.join(distinct.select(F.col("fp").alias("node"), "low"), "node")
    lows = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    n = distinct.count()
    linked = hot_join(linked, "root", lows, n, n).select(F.col("node").alias("fp"), F.col("root").alias("r"), F.col("component_id").alias("c"))
    of = distinct.join(linked, "fp", "left").select("fp", F.coalesce("c", "low").alias("component_id"), F.coalesce("r", "fp").alias("component"))
    return hot_join(rows, "fp", cut(of), rows.count(), n)


def fingerprint_groups(distinct: DataFrame) -> DataFrame:
    """fp, component (the smallest fingerprint in reach) of the distinct fingerprints that are linked to others."""
    return connected_components(fingerprint_links(distinct)).select(F.col("node").alias("fp"), F.col("root").alias("component"))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands_too: bool = True) -> DataFrame:
    """The rows of docs without near-duplicates: of each component of similar texts the row with the smallest id stays, of those that share it the one with the smallest row hash.

    Similar are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, which is tested exactly. Candidates
    are the components of the trie join of the sets' fingerprints; with bands_too also texts that MinHash brings together,
    as most pairs near 0.8 differ in more than BUDGET bits.
    """
    key, doc_id = free_name(docs, "row_key"), free_name(docs, "id_")
    keyed = docs.withColumn(key, row_key(docs))
    groups = minhash.similar_groups(keyed.withColumn(doc_id, F.col(id_col).cast("long")), text_col, (key, doc_id), fingerprint_groups, bands_too)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col(doc_id).isNull(), F.col(doc_id), F.col(key))).alias("first"))
    stay = first.select(F.col("first")[key].alias(key)).distinct()
    return keyed.join(stay, key, "left_semi").dropDuplicates([key]).select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_simhash(spark, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
