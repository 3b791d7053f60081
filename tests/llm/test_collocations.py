"""Phrase mining against plain Python, with small sketches, small buffers, nulls, empty tables and long texts."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm import collocations
from tests.llm.test_operators import ROUGH, SCHEMA, clash

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_runs(docs):
    f, n = collections.Counter(), collections.Counter()
    for t, lang in docs:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (t or "").translate(UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    f[lang, tuple(words[i : i + m])] += 1
    return f, n


def plain_collocations(docs, least=100, first=2000):
    f, n = plain_runs(docs)
    good = {k: c for k, c in f.items() if c >= least}
    longer = collections.Counter()
    for (lang, p), c in good.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                longer[lang, p[i : i + m]] = max(longer[lang, p[i : i + m]], c)
    by_lang = collections.defaultdict(list)
    for (lang, p), a in good.items():
        if len(p) > 1 and not 100 * longer[lang, p] >= 100 * a:
            score, _, l, r = min((1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            by_lang[lang].append((-score, -a, " ".join(p).encode(), l, r))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s) for lang, rows in by_lang.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:first], 1))


def make(seed, n=400):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeéß中") for _ in range(rnd.randrange(1, 6))) for _ in range(300)]
    phrases = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randrange(2, 8))) for _ in range(12)]
    out = []
    for i in range(n):
        parts = [rnd.choice(phrases) if rnd.random() < 0.5 else rnd.choice(vocabulary) for _ in range(rnd.randrange(1, 40))]
        parts = [p.upper() if rnd.random() < 0.1 else p for p in parts]
        out.append((i, "".join(p + rnd.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b", "! ", " ", "\x00 "]) for p in parts), rnd.choice(["en", "en", "de", None]), "s", 1))
    return out + [(n, "a b a b a b a b " * 60, "en", "s", 1), (n + 1, None, "en", "s", 1), (n + 2, "", None, "s", 1), (n + 3, ".,;", "fr", "s", 1)]


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize(("seed", "least"), [(0, 100), (1, 30)])
def test_collocations(spark, monkeypatch, seed, least):
    monkeypatch.setattr(collocations, "LEAST", least)
    docs = make(seed)
    df = clash(spark.createDataFrame(docs, SCHEMA), "f", "n", "n_words", "phrase", "k", "a", "rank", "row", "slice").repartition(5)
    want = plain_collocations([(t, lang) for _, t, lang, *_ in docs], least)
    assert len(want) > 20
    assert got(collocations.collocations(df)) == want
    assert got(collocations.collocations(df, first=3)) == [r for r in want if r[1] <= 3]


def test_edges(spark, monkeypatch):
    assert got(collocations.collocations(spark.createDataFrame([], SCHEMA))) == []
    monkeypatch.setattr(collocations, "LEAST", 2)
    for rough in (ROUGH, ROUGH[::-1]):
        assert got(collocations.collocations(spark.createDataFrame(rough, SCHEMA))) == plain_collocations([(t, lang) for _, t, lang, *_ in rough], 2)


@pytest.mark.parametrize(("flush", "cut"), [(1 << 21, 1 << 20), (7, 5), (50, 64)])
def test_buffers_lose_nothing(monkeypatch, flush, cut):
    """Whatever the size of buffers and cuts of texts, runs are counted once; words are learnt anew now and then."""
    import pyarrow as pa

    for name, value in (("FLUSH", flush), ("SLICE", cut), ("MEMO", 40), ("KEPT", 500 if flush > 100 else 30), ("LEAST", 1)):
        monkeypatch.setattr(collocations, name, value)
    docs = [(t, lang if lang else "und") for _, t, lang, *_ in make(5, 40)]
    batch = pa.RecordBatch.from_arrays([pa.array([t for t, _ in docs]), pa.array([x for _, x in docs])], ["text", "lang"])

    class Cells:
        value = [np.full(1 << 17, 255, np.uint8)] * 2

    counts = collections.Counter()
    for out in collocations._exact(20, Cells)(iter([batch])):
        for lang, m, phrase, c in zip(*[x.to_pylist() for x in out.columns], strict=True):
            counts[(lang, m, phrase)] += c
    f, n = plain_runs(docs)
    assert counts == collections.Counter({(lang, len(p), " ".join(p).encode()): c for (lang, p), c in f.items()} | {(lang, 0, b""): c for lang, c in n.items() if c})


@pytest.mark.parametrize("most", [20, 22, 29])
def test_sketch_loses_nothing_frequent(spark, monkeypatch, most):
    """A sketch far too small for the table still has the bits of everything frequent; several cells may share a bit."""
    monkeypatch.setattr(collocations, "CELL_BITS", most)
    monkeypatch.setattr(collocations, "sketch_bits", lambda size: 23)
    docs = make(2)
    f, n = plain_runs([(t, lang) for _, t, lang, *_ in docs])
    runs = {(r["lang"], r["phrase"]): r["f"] for r in collocations.frequent_runs(spark.createDataFrame(docs, SCHEMA)).where("n_words > 0").collect()}
    assert runs == {(lang, " ".join(p)): c for (lang, p), c in f.items() if c >= 100}


def test_blocks():
    cells = np.sort(np.random.default_rng(0).integers(0, 1 << 24, 5000, dtype=np.uint64))
    cells = np.sort(np.concatenate([cells, np.full(1000, cells[17])]))
    back = np.concatenate([collocations._unblock(b) + (part << collocations.SLICE_BITS) for part, b in collocations._blocks(cells)])
    assert np.count_nonzero(back == int(cells[17])) <= collocations.LEAST + 1 and set(back.tolist()) == set(cells.tolist())


def test_exact_arithmetic(spark):
    """Products beyond 64 bits, quotients on the edge."""
    rnd = random.Random(1)
    rows, want = [], {}
    for i in range(200):
        l, r = rnd.randrange(100, 10**13), rnd.randrange(100, 10**13)
        a, n = min(l, r) - rnd.randrange(0, 5), 10**15
        rows += [("x", 1, f"l{i}", l), ("x", 1, f"r{i}", r), ("x", 2, f"l{i} r{i}", a)]
        want[f"l{i} r{i}"] = 1000 * a * n // (l * r)
    rows += [("x", 0, "", 10**15)]
    out = collocations.scored(spark.createDataFrame(rows, "lang string, n_words int, phrase string, f long"))
    assert {r["phrase"]: r["score"] for r in out.collect()} == want


def test_very_long_text(spark):
    """One text of many words, with and without ends of pieces."""
    text = "Alpha beta gamma " * 250_000 + ". " + "x" * 3_000_000 + " alpha beta"
    docs = spark.createDataFrame([(1, text, "en", "s", 1)], SCHEMA)
    assert got(collocations.collocations(docs)) == plain_collocations([(text, "en")])
    assert docs.select(F.octet_length("text")).first()[0] > 7_000_000
