"""Near copies by similarity: texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Candidates come from two sides. SimHash (simhash.py) links the fingerprints of the shingle sets; the texts of one component of
links share a key. At a similarity of 0.8 fingerprints mostly lie further apart than its bits, so texts also share BANDS keys
made of ROWS MinHash values each: a pair at 0.8 shares none of these with probability (1 - 0.8 ** 5) ** 25 = 5e-5, a more similar one
less. What shares keys, directly or over others, is a cluster. A cluster's shingle sets meet in one tile, each sent once, and a
kernel counts the common shingles of all its pairs: rare shingles by listing who has them, common ones by products of 0/1
matrices. Only links leave the tile, a spanning forest of them, so neither pairs nor texts travel, however alike or unlike the
members of a dense cluster are. No pair that shares a key goes untested.

A cluster that is too large for a tile (MEMBERS, SHINGLES) is taken by its keys: the texts of a key are dealt into blocks. First
every block meets itself and the first block, which links most copies of one text; then the texts outside the key's largest
component meet each other and all others, block by block. Work on a key with m texts of which k are left outside grows with
k x m, in tiles of one size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keelson.llm.common import cut
from keelson.llm.components import connected_components, hot_join
from keelson.llm.shingles import shingle_parts, text_hash

SEED, SHINGLE, SIMILARITY = 42, 5, 0.8
BANDS, ROWS = 25, 5
#: Texts and shingles of a tile at most; one text may have more shingles.
MEMBERS, SHINGLES = 4096, 1 << 22
#: Members up to which a tile's pairs are tested one by one, holders up to which a shingle's pairs are listed, and columns of a matrix.
FEW, LISTED, COLUMNS = 12, 8, 1024

_random = np.random.default_rng(SEED)
_A = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
_B = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)[:, None]


def shingle_set(text: bytes) -> np.ndarray:
    """Distinct hashes of the five-word shingles; a text of fewer words is one shingle, and so is the empty text."""
    parts = [np.unique(np.array(h, np.uint64)) for h in shingle_parts(text, SHINGLE, SEED)]
    return np.unique(np.concatenate(parts)) if parts else np.array([xxhash.xxh64_intdigest(b"", SEED)], np.uint64)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    out = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(out, (_A * shingles[at : at + 512] + _B).min(axis=1), out=out)
    return out >> np.uint64(24)  # the low bits of a product are weak


def fingerprint(shingles: np.ndarray) -> np.uint64:
    """The SimHash of a set: a bit is 1 if set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(shingles), 50_000):
        ones += np.unpackbits(np.ascontiguousarray(shingles[at : at + 50_000], "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(shingles), bitorder="little").view("<u8")[0]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts in column 0 to node (hash of the folded text), fingerprint, band keys and number of shingles."""
    for b in batches:
        nodes, fps, keys, sizes = [], [], [], []
        for t in b.column(0).cast(pa.binary()):
            text = t.as_py() or b""
            shingles = shingle_set(text)
            sizes.append(len(shingles))
            nodes.append(text_hash(text, SEED + 1))
            fps.append(fingerprint(shingles))
            keys.append([xxhash.xxh64_intdigest(x.tobytes(), k) for k, x in enumerate(min_hashes(shingles).reshape(BANDS, ROWS))])
        signed = lambda x: np.array(x, np.uint64).view(np.int64)
        columns = [pa.array(signed(nodes)), pa.array(signed(fps)), pa.array(signed(keys).tolist(), pa.list_(pa.int64())), pa.array(sizes, pa.int64())]
        yield pa.RecordBatch.from_arrays([*b.columns[1:], *columns], [*b.schema.names[1:], "node", "fp", "keys", "size"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingle_set(t.as_py() or b"").tobytes() for t in b.column(0).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(sets, pa.binary())], [*b.schema.names[1:], "shingles"])


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """The number of shingles that each two sets have in common (upper triangle at least)."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    shingles = np.concatenate(sets)
    order = np.argsort(shingles, kind="stable")
    owner, shingles = owner[order], shingles[order]  # by shingle, owners rising
    starts = np.flatnonzero(np.concatenate([[True], shingles[1:] != shingles[:-1]]))
    held = np.diff(np.concatenate([starts, [len(shingles)]]))
    counts = np.zeros((m, m), np.float32)  # whole numbers, exact up to 2^24
    flat = counts.reshape(-1)
    for d in range(2, LISTED + 1):
        at = starts[held == d]
        for i in range(d - 1):
            for j in range(i + 1, d):
                pair = owner[at + i] * m + owner[at + j]
                if len(pair):
                    where, n = np.unique(pair, return_counts=True)
                    flat[where] += n
    many = np.flatnonzero(held > LISTED)
    for a in range(0, len(many), COLUMNS):
        some = many[a : a + COLUMNS]
        column = np.repeat(np.arange(len(some)), held[some])
        first = np.repeat(starts[some] - np.concatenate([[0], np.cumsum(held[some])[:-1]]), held[some])
        matrix = np.zeros((m, len(some)), np.float32)
        matrix[owner[first + np.arange(len(column))], column] = 1
        counts += matrix @ matrix.T
    return counts


def forest(sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between the sets whose similarity is SIMILARITY or more, as many as connect what they connect."""
    m, size = len(sets), np.array([len(s) for s in sets])
    if m <= FEW:
        near = np.zeros((m, m), bool)
        for i in range(m):
            for j in range(i):
                if min(size[i], size[j]) >= SIMILARITY * max(size[i], size[j]):
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    near[i, j] = both / (size[i] + size[j] - both) >= SIMILARITY
    else:
        both = np.triu(common_counts(sets), 1).astype(np.float64)
        near = both / (size[:, None] + size[None, :] - both) >= SIMILARITY
    near |= near.T
    left, links = np.ones(m, bool), []
    for i in range(m):
        stack = [i] if left[i] else []
        left[i] = False
        while stack:
            x = stack.pop()
            new = np.flatnonzero(near[x] & left).tolist()
            left[new] = False
            links += [(x, y) for y in new]
            stack += new
    return links


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tile, node, shingles), tile by tile, to links (u, v)."""
    tile, nodes, sets = None, [], []

    def links() -> pa.RecordBatch:
        found = [(min(nodes[i], nodes[j]), max(nodes[i], nodes[j])) for i, j in forest(sets)] if len(sets) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    for b in batches:
        for t, n, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
            if t != tile:
                yield links()
                tile, nodes, sets = t, [], []
            nodes.append(n)
            sets.append(np.frombuffer(s.as_py(), np.uint64))
    yield links()


def _linked(tiles: DataFrame) -> DataFrame:
    return cut(tiles.select("tile", "node", "shingles").repartition("tile").sortWithinPartitions("tile", "node").mapInArrow(_tiles, "u long, v long"))


def _blocks(n: Column, shingles: Column) -> Column:
    """The number of blocks of half a tile that so many texts and shingles fill."""
    return F.greatest(F.ceil(n / (MEMBERS // 2)), F.ceil(shingles / (SHINGLES // 2))).cast("int")


def _tile(*parts) -> Column:
    return F.xxhash64(*parts)


def _by_keys(keyed: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of large clusters. keyed: key, node, size, of keys with several texts; sets: node, shingles."""
    keyed = cut(keyed)
    shape = keyed.groupBy("key").agg(_blocks(F.count(F.lit(1)), F.sum("size")).alias("blocks"))
    dealt = keyed.join(shape, "key").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # a tile of a block with itself would be part of that with the first block: all of them meet the first one
    others = F.when(F.col("block") == 0, F.sequence(F.least(F.lit(1), F.col("blocks") - 1), F.col("blocks") - 1)).otherwise(F.array("block"))
    first = dealt.select("node", F.explode(others).alias("with"), "key").select("node", _tile("key", F.lit("first"), "with").alias("tile"))
    edges = _linked(first.join(sets, "node"))
    roots = connected_components(edges)
    now = keyed.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parts = now.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    open_ = parts.groupBy("key").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.sum("n").alias("n"), F.sum("size").alias("all"), F.max("n").alias("most"), F.max_by("size", F.struct("n", "root")).alias("main_size"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    rest, main = _blocks(F.col("n") - F.col("most"), F.col("all") - F.col("main_size")), _blocks(F.col("most"), F.col("main_size"))
    open_ = cut(open_.select("key", "main", rest.alias("rest_blocks"), main.alias("main_blocks")))
    now = now.join(open_, "key").withColumn("inside", F.col("root") == F.col("main"))
    block = F.pmod(F.xxhash64("node", F.lit(1)), F.when(F.col("inside"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    now = now.withColumn("block", block)
    rest_ids, main_ids = F.sequence(F.lit(0), F.col("rest_blocks") - 1), F.sequence(F.lit(0), F.col("main_blocks") - 1)
    rest_rest = F.transform(rest_ids, lambda x: _tile("key", F.lit("rest"), F.least(x, F.col("block")), F.greatest(x, F.col("block"))))
    to_main = F.transform(main_ids, lambda x: _tile("key", F.lit("main"), F.col("block"), x))
    from_main = F.transform(rest_ids, lambda x: _tile("key", F.lit("main"), x, F.col("block")))
    tiles = now.select("node", F.explode(F.when(F.col("inside"), from_main).otherwise(F.concat(rest_rest, to_main))).alias("tile"))
    return edges.unionByName(_linked(tiles.join(sets, "node")))


def similar_groups(docs: DataFrame, text_col: str, carry: tuple[str, str], fingerprint_groups: Callable[[DataFrame], DataFrame], bands_too: bool = True) -> DataFrame:
    """The columns of carry (row key, id) and node, root: rows with one root are linked by similar texts. Rows that share a row key are equal.

    fingerprint_groups makes of distinct fingerprints (fp) those with links, each with its component (fp, component). Without
    bands_too only texts whose fingerprints are linked are candidates.
    """
    key, _ = carry
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    texts = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *carry)
    rows = cut(texts.mapInArrow(_keyed, f"{fields}, node long, fp long, keys array<long>, size long"))
    distinct = cut(rows.groupBy("node").agg(F.first("fp").alias("fp"), F.first("keys").alias("keys"), F.first("size").alias("size"), F.min(key).alias("row")))
    fps = cut(distinct.groupBy("fp").agg(F.count(F.lit(1)).alias("n")))
    linked = fps.join(fingerprint_groups(fps.select("fp")), "fp", "left").where("n > 1 OR component IS NOT NULL")
    linked = cut(linked.select("fp", F.xxhash64(F.lit("simhash"), F.coalesce("component", "fp")).alias("key")))
    bands = hot_join(distinct.select("node", "fp"), "fp", linked, distinct.count(), linked.count()).select("node", "key")
    if bands_too:
        bands = bands.unionByName(distinct.select("node", F.explode("keys").alias("key")))
    heads = cut(bands.groupBy("key").agg(F.min("node").alias("head"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "head"))
    shared = cut(hot_join(bands, "key", heads, distinct.count() * (BANDS + 1), heads.count()))
    clusters = connected_components(shared.where("node <> head").select(F.col("head").alias("u"), F.col("node").alias("v")))
    members = cut(clusters.join(distinct.select("node", "size", "row"), "node"))
    large = cut(members.groupBy("root").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("shingles")).where(f"n > {MEMBERS} OR shingles > {SHINGLES}").select("root"))  # few
    sources = docs.select(F.col(key).alias("row"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    sets = members.join(sources, "row").select("text", "node", "root").dropDuplicates(["node"]).mapInArrow(_sets, "node long, root long, shingles binary")
    sets = cut(sets)
    edges = _linked(sets.join(large, "root", "left_anti").withColumnRenamed("root", "tile"))
    if not large.isEmpty():
        keyed = shared.select("key", "node").join(members.join(large, "root", "left_semi").select("node", "size"), "node")
        edges = edges.unionByName(_by_keys(keyed, sets.select("node", "shingles")))
    roots = connected_components(edges)
    return rows.select(*carry, "node").join(roots, "node", "left").select(*carry, "node", F.coalesce("root", "node").alias("root"))
