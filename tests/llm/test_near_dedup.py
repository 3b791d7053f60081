"""The near-dup stage against all pairs of five-word shingle sets: sparse and dense groups, large clusters, odd rows."""

import collections
import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from keelson.llm import minhash, simhash
from tests.llm.test_operators import ROUGH, SCHEMA, clash


def shingles(t):
    words = (t or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def plain_roots(docs):
    """Smallest id in reach by Jaccard 0.8, by all pairs that share a shingle; docs: (id, text)."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    by = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            by[x].append(i)
    common = collections.Counter()
    for ids in by.values():
        common.update(itertools.combinations(ids, 2))
    for (i, j), n in common.items():
        if n / (len(sets[i]) + len(sets[j]) - n) >= 0.8:
            parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        low[find(i)] = min(d, low.get(find(i), d))
    return {d: low[find(i)] for i, (d, _) in enumerate(docs)}


def family(rnd, n, words=150, most=0.16):
    """Copies of one text with a share of words changed that differs from copy to copy: pairs are 0.5 to 1 alike."""
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(words)]
    for _ in range(n):
        x = list(base)
        for i in rnd.sample(range(words), int(rnd.random() * most * words / 3)):
            x[i] = word()
        yield " ".join(x)


def kept(df):
    return sorted(r["doc_id"] for r in df.collect())


@pytest.mark.parametrize("size", [17, 120, 500])
def test_dense_groups(spark, size):
    rnd = random.Random(size)
    docs = list(enumerate([*family(rnd, size), *family(rnd, 5), *(" ".join(f"w{rnd.randrange(50)}" for _ in range(40)) for _ in range(50)), "one two", "one two", "", None]))
    roots = plain_roots(docs)
    assert 3 < len(set(roots.values())) < len(docs)
    df = spark.createDataFrame([(d, t, "l", "s", 1) for d, t in docs], SCHEMA)
    assert kept(simhash.near_dedup(df)) == sorted(set(roots.values()))


@pytest.mark.parametrize(("members", "grams"), [(20, 1 << 22), (64, 1 << 22), (4096, 3000)])
def test_clusters_beyond_a_tile(spark, monkeypatch, members, grams):
    """Tiles far too small for the cluster lose no link."""
    monkeypatch.setattr(minhash, "MEMBERS", members)
    monkeypatch.setattr(minhash, "SHINGLES", grams)
    rnd = random.Random(members)
    docs = list(enumerate([*family(rnd, 150), *family(rnd, 30, most=0.05), *family(rnd, 4)]))
    df = spark.createDataFrame([(d, t, "l", "s", 1) for d, t in docs], SCHEMA)
    assert kept(simhash.near_dedup(df)) == sorted(set(plain_roots(docs).values()))


def test_counts_of_common_shingles():
    rnd = np.random.default_rng(0)
    for m, top in ((13, 40), (40, 60), (60, 3000)):
        sets = [np.unique(rnd.integers(0, top, rnd.integers(1, 200)).astype(np.uint64)) for _ in range(m)]
        got = np.triu(minhash.common_counts(sets), 1)
        assert all(got[i, j] == len(np.intersect1d(sets[i], sets[j])) for i in range(m) for j in range(i + 1, m))


def test_forest_connects_the_same():
    rnd = random.Random(1)
    sets = [np.array(sorted({hash(x) & (1 << 62) - 1 for x in shingles(t)}), np.uint64) for t in family(rnd, 60)]
    pairs = [(i, j) for i in range(60) for j in range(i) if (n := len(np.intersect1d(sets[i], sets[j]))) / (len(sets[i]) + len(sets[j]) - n) >= 0.8]

    def groups(links):
        at = list(range(60))
        for _ in range(60):
            for i, j in links:
                at[i] = at[j] = min(at[i], at[j])
        return at

    links = minhash.forest(sets)
    assert groups(links) == groups(pairs) and len(links) == 60 - len(set(groups(pairs)))


def test_edges(spark):
    """Empty tables, nulls, repeated rows, clashing names, a very long text and its copy with a few words changed."""
    assert kept(simhash.near_dedup(spark.createDataFrame([], SCHEMA))) == []
    rough = simhash.near_dedup(clash(spark.createDataFrame(ROUGH, SCHEMA), "node", "root", "key", "keys", "shingles", "row", "tile", "u", "size"))
    assert sorted(map(tuple, rough.select("doc_id", "text").collect()), key=str) == [(7, "a b c"), (7, "other text"), (None, "x y z"), (None, None)]
    words = [f"w{i % 7919}x{i}" for i in range(120_000)]
    other = list(words)
    for i in range(0, 120_000, 3000):
        other[i] = "changed"
    docs = spark.createDataFrame([(1, " ".join(words), "l", "s", 1), (2, " ".join(other), "l", "s", 1), (3, "x" * 1_000_000, "l", "s", 1)], SCHEMA)
    assert kept(simhash.near_dedup(docs)) == [1, 3]


def test_recall_on_the_documents(spark):
    """On the small documents table every pair at 0.8 that brute force finds is linked."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    roots = plain_roots([(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()])
    assert kept(simhash.near_dedup(docs)) == sorted(set(roots.values()))
    assert docs.where(F.col("text").isNotNull()).count() > len(set(roots.values()))


def near_in_bits(rnd):
    """Two texts at 0.8 or more whose fingerprints differ in 3 bits at most, though they share no MinHash key."""
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    mins = lambda words: minhash.min_hashes(minhash.shingle_set(" ".join(words).encode())).reshape(minhash.BANDS, minhash.ROWS)
    while True:
        base = [word() for _ in range(120)]
        own = mins(base)
        at = []
        for _ in range(2):  # the words whose change spoils the most keys; 10 of 116 shingles are others then
            free = [i for i in range(4, 116) if all(abs(i - j) > 4 for j in at)]
            spoilt = {i: (mins([w if k not in (*at, i) else "x" for k, w in enumerate(base)]) != own).any(axis=1).sum() for i in free}
            at.append(max(free, key=spoilt.get))
        if spoilt[at[-1]] < minhash.BANDS - 3:
            continue
        for _ in range(1500):
            other = [word() if i in at else w for i, w in enumerate(base)]
            a, b = (minhash.fingerprint(minhash.shingle_set(" ".join(x).encode())) for x in (base, other))
            if int(a ^ b).bit_count() <= simhash.BUDGET and (mins(other) != own).any(axis=1).all():
                return " ".join(base), " ".join(other)


def plain_fingerprint(t):
    hashes = [xxhash.xxh64_intdigest(" ".join(s), 42) for s in {tuple(x.decode() for x in s) for s in shingles(t)}]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def test_candidates_of_fingerprints(spark):
    """What SimHash links is a candidate by itself, tested exactly: a pair that no MinHash key brings together is found."""
    rnd = random.Random(4)
    docs = list(enumerate([*near_in_bits(rnd), *family(rnd, 60, most=0.03), "one two", "One  two", "", None]))
    df = spark.createDataFrame([(d, t, "l", "s", 1) for d, t in docs], SCHEMA)
    assert kept(simhash.near_dedup(df)) == sorted(set(plain_roots(docs).values()))
    fps = [plain_fingerprint(t) for _, t in docs]
    assert [int(minhash.fingerprint(minhash.shingle_set((t or "").encode()))) for _, t in docs] == fps
    groups = list(range(len(docs)))  # components by bits, then links at 0.8 inside them
    for _ in groups:
        for i, j in itertools.combinations(range(len(docs)), 2):
            if (fps[i] ^ fps[j]).bit_count() <= simhash.BUDGET:
                groups[i] = groups[j] = min(groups[i], groups[j])
    by = collections.defaultdict(list)
    for g, d in zip(groups, docs, strict=True):
        by[g].append(d)
    want = sorted(root for part in by.values() for root in set(plain_roots(part).values()))
    assert kept(simhash.near_dedup(df, bands_too=False)) == want and 1 not in want
