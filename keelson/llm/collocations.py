"""Phrase collocation mining: frequent phrases of two to five words, scored by how much they exceed chance.

The first pass counts all runs of one to five words in count-min sketches. A sketch has DEPTH rows whose width grows with
the bytes of text, so it is no larger than a task can hold only because it is dealt out: a task sorts the cells that its
words hit and writes them in blocks, by slice of the rows, as differences between neighbours; the blocks of a slice are
merged by adding. A cell with LEAST hits or more gives a set bit. The bits, CELL_BITS a row at most, are broadcast: a run of
words survives if all its cells are set and the two runs one word shorter in it survive. Cells only overestimate and bits
stand for one or more cells, so no frequent run is lost.

The second pass counts the survivors exactly, by their words: in a task by integer codes, over tasks by a sum that is
combined before the shuffle. Where the sketch lets rare runs through, they cost time and fall to the exact count. Scores
need only frequent runs, as every part of a frequent run is frequent; all that follows works on the table of frequent runs.

Both passes hold FLUSH words at a time, whatever the length of a text, and the second one the counts of KEPT runs. Null texts are empty, a null lang is `und`, rows that
repeat count as often as they stand there, rows without an id too; an empty table gives no rows; further columns are left alone.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keelson.llm.common import cut, table
from keelson.llm.components import hot_join

LEAST, LONGEST, FIRST = 100, 5, 2000
SEED, DEPTH = 42, 2
#: Words that a task holds before it writes their cells or counts, and bytes of a text that are cut to words together.
FLUSH, SLICE = 1 << 20, 1 << 20
#: Runs of words for each cell of a row, on average; with LEAST hits needed, that many strays don't make a rare run survive.
LOAD = 32
#: Cells of a slice of a row, and bits of a row that are broadcast at most (64 MB), both as powers of two.
SLICE_BITS, CELL_BITS = 20, 29
#: Bytes of text that a task of the second pass takes at least, unless cores would stand idle: larger tasks add up more before the shuffle.
TASK_BYTES = 1 << 28
#: Known words a task keeps before it starts to learn anew, and runs whose counts it adds up before it writes them.
MEMO, KEPT = 1 << 21, 1 << 20

_FOLD = bytes.maketrans(b".,;:!?\x0a\x0b\x0c\x0d\x09", b"\n\n\n\n\n\n\n\n\n\n ")
_CUT = re.compile(rb"[\x20\x09.,;:!?\x0A-\x0D]")
_K = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_GAP = 1  # the code of the end of a piece; 0 is the empty string between two blanks


class _Words(dict):
    """Codes of words, given as they come."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": _GAP})
        self.texts, self.hashes = [b"", b"\n"], [0, 0]

    def __missing__(self, word: bytes) -> int:
        self[word] = code = len(self.texts)
        self.texts.append(word)
        self.hashes.append(xxhash.xxh64_intdigest(word, SEED))
        return code


class _Buffer:
    """Words by language, in codes, until there are FLUSH of them."""

    def __init__(self):
        self.words, self.held, self.size = _Words(), {}, 0

    def feed(self, batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        """Columns text, lang. Gives full buffers: by language all codes so far. What a buffer leaves open is put back by keep()."""
        for b in batches:
            for text, lang in zip(b.column(0).cast(pa.binary()), b.column(1).to_pylist(), strict=True):
                text, at = text.as_py() or b"", 0
                while at < len(text):
                    m = _CUT.search(text, at + SLICE) if len(text) - at > SLICE else None
                    end = m.start() if m else len(text)
                    found = text[at:end].lower().translate(_FOLD).replace(b"\n", b" \n ").split(b" ")  # bytes.lower() changes A-Z only
                    codes = np.fromiter(map(self.words.__getitem__, found), np.int64, len(found))
                    self.held.setdefault(lang, []).append(codes[codes > 0])
                    self.size += len(codes)
                    at = end
                    if self.size >= FLUSH:
                        yield self._out()
                if text:
                    self.held.setdefault(lang, []).append(np.array([_GAP]))
        if self.held:
            yield self._out()

    def _out(self) -> dict[str, np.ndarray]:
        out = {lang: np.concatenate(parts) for lang, parts in self.held.items()}
        self.held, self.size = {}, 0
        return out

    def keep(self, lang: str, codes: np.ndarray) -> None:
        if len(codes):
            self.held.setdefault(lang, []).append(codes)

    def settle(self) -> None:
        """Forgets the known words if they are many; open pieces are carried over by their texts."""
        if len(self.words) > MEMO:
            old, self.words = self.words.texts, _Words()
            self.held = {lang: [np.array([self.words[old[c]] for c in np.concatenate(parts).tolist()], np.int64)] for lang, parts in self.held.items()}


def _runs(codes: np.ndarray, hashes: np.ndarray, lang: str):
    """Of the codes of a language: the words, how many of them begin runs now, what is left open, and for n of 1 to LONGEST
    the hashes of the runs of n words with whether each lies in one piece."""
    gap = codes == _GAP
    words, piece = codes[~gap], np.cumsum(gap)[~gap]
    last = np.flatnonzero(gap)
    open_ = len(codes) - (last[-1] + 1 if len(last) else 0)
    left = words[len(words) - min(open_, LONGEST - 1) :]
    starts = len(words) - len(left)
    own = hashes[words] ^ np.uint64(xxhash.xxh64_intdigest(lang.encode(), SEED))
    run, by_length = np.zeros(len(words) + 1, np.uint64), []
    for n in range(1, min(LONGEST, len(words)) + 1):
        run = run[:-1] * _K[0] + own[n - 1 :]
        x = (run ^ (run >> np.uint64(31))) * _K[1]
        by_length.append((x ^ (x >> np.uint64(29)), piece[n - 1 :] == piece[: len(piece) - n + 1]))
    return words, starts, left, by_length


def _cells(x: np.ndarray, row: int, bits: int) -> np.ndarray:
    y = (x ^ (x >> np.uint64(32))) * _K[2 + row]
    return (y ^ (y >> np.uint64(33))) * _K[1] >> np.uint64(64 - bits)


def _blocks(cells: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Sorted cells to (slice, block). A block gives the differences of neighbours, in as many bytes as the largest needs. Of one
    cell no more than LEAST are kept, which is all that a threshold needs to know."""
    keep = np.ones(len(cells), bool)
    keep[LEAST:] = cells[LEAST:] != cells[:-LEAST]
    cells = cells[keep]
    part = cells >> np.uint64(SLICE_BITS)
    cuts = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(cells)]])
    inside = (cells & np.uint64((1 << SLICE_BITS) - 1)).astype(np.int64)
    for a, z in zip(cuts.tolist(), cuts[1:].tolist(), strict=False):
        steps = np.diff(inside[a:z], prepend=0)
        width = 1 if (top := steps.max()) < 1 << 8 else 2 if top < 1 << 16 else 4
        yield int(part[a]), bytes([width]) + steps.astype(f"<u{width}").tobytes()


def _unblock(block: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(block, f"<u{block[0]}", offset=1), dtype=np.int64)


def _sketch(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer = _Buffer()
        for held in buffer.feed(batches):
            hashes, parts = np.array(buffer.words.hashes, np.uint64), []
            for lang, codes in held.items():
                _, starts, left, by_length = _runs(codes, hashes, lang)
                parts += [x[:starts][whole[:starts]] for x, whole in by_length]
                buffer.keep(lang, left)
            buffer.settle()
            x = np.concatenate(parts) if parts else np.array([], np.uint64)
            for row in range(DEPTH if len(x) else 0):
                out = list(_blocks(np.sort(_cells(x, row, bits))))
                for at in range(0, len(out), 1024):
                    some = out[at : at + 1024]
                    yield pa.RecordBatch.from_arrays([pa.array([row] * len(some), pa.int32()), pa.array([s for s, _ in some], pa.int64()), pa.array([b for _, b in some], pa.binary())], ["row", "slice", "block"])
        # what the end of the task leaves open there is none of: every text ends with a gap

    return run


def _merge(bits: int):
    """The blocks of a slice to its bits: whether a cell, or one of several where bits are fewer than cells, has LEAST hits."""
    share = 1 << max(0, bits - CELL_BITS)

    def run(group: pa.Table) -> pa.Table:
        hits = np.zeros(1 << SLICE_BITS, np.int64)
        for b in group.column("block"):
            hits += np.bincount(_unblock(b.as_py()), minlength=1 << SLICE_BITS)
        packed = np.packbits((hits >= LEAST).reshape(-1, share).any(axis=1), bitorder="little")
        return pa.table({"row": group.column("row").slice(0, 1), "slice": group.column("slice").slice(0, 1), "bits": pa.array([packed.tobytes()], pa.binary())})

    return run


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    return docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0


def sketch_bits(size: int) -> int:
    """The width of a row, as a power of two, that so many bytes of text call for."""
    return min(SLICE_BITS + 28, max(SLICE_BITS, int(size * LONGEST // 6 // LOAD).bit_length()))


def frequent_cells(texts: DataFrame, bits: int) -> list[np.ndarray]:
    """By row of the merged sketch the bits of cells with LEAST hits: DEPTH rows of 2^min(bits, CELL_BITS) bits on the driver. texts: text, lang."""
    blocks = texts.mapInArrow(_sketch(bits), "row int, slice long, block binary")
    slices = blocks.groupBy("row", "slice").applyInArrow(_merge(bits), "row int, slice long, bits binary")
    out = [np.zeros(1 << (min(bits, CELL_BITS) - 3), np.uint8) for _ in range(DEPTH)]
    for r in slices.toLocalIterator():
        size = len(r["bits"])
        out[r["row"]][r["slice"] * size : (r["slice"] + 1) * size] = np.frombuffer(r["bits"], np.uint8)
    return out


def _exact(bits: int, cells):
    def alive(x: np.ndarray) -> np.ndarray:
        ok = np.ones(len(x), bool)
        for row, known in enumerate(cells.value):
            at = _cells(x, row, bits) >> np.uint64(max(0, bits - CELL_BITS))
            ok &= (known[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return ok

    def count(codes: np.ndarray, words: _Words, hashes: np.ndarray, lang: str):
        """(phrase, count) of the surviving runs - the empty phrase counts all words - and what is left open."""
        run_of, starts, left, by_length = _runs(codes, hashes, lang)
        out, there, code = [(b"", starts)] if starts else [], None, None
        for n, (x, whole) in enumerate(by_length, 1):
            may = whole if there is None else whole & there[:-1] & there[1:]
            at = np.flatnonzero(may)
            at = at[alive(x[at])]
            there = np.zeros(len(x), bool)
            there[at] = True
            # runs of one text get one code: that of the run one word shorter and the last word's
            key = run_of[at] if code is None else (code[at] << 32) | run_of[at + n - 1]
            codes_, unique = pd.factorize(key)
            code = np.zeros(len(x), np.int64)
            code[at] = codes_
            example = np.zeros(len(unique), np.int64)
            example[codes_[::-1]] = at[::-1]
            times = np.bincount(codes_[at < starts], minlength=len(unique))
            texts = words.texts
            out += [(b" ".join([texts[c] for c in run_of[i : i + n]]), k) for i, k in zip(example.tolist(), times.tolist(), strict=True) if k]
        return out, left

    def written(lang: str, sums: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
        phrases = list(sums)
        for i in range(0, len(phrases), 50_000):
            some = phrases[i : i + 50_000]
            n = [p.count(b" ") + 1 if p else 0 for p in some]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(n, pa.int32()), pa.array(some, pa.binary()), pa.array([sums[p] for p in some], pa.int64())], ["lang", "n_words", "phrase", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffer, sums = _Buffer(), {}
        for held in buffer.feed(batches):
            hashes = np.array(buffer.words.hashes, np.uint64)
            for lang, codes in held.items():
                out, left = count(codes, buffer.words, hashes, lang)
                buffer.keep(lang, left)
                mine = sums.setdefault(lang, {})
                for phrase, k in out:
                    mine[phrase] = mine.get(phrase, 0) + k
            buffer.settle()
            if sum(map(len, sums.values())) > KEPT:
                for lang, mine in sums.items():
                    yield from written(lang, mine)
                sums = {}
        for lang, mine in sums.items():
            yield from written(lang, mine)

    return run


def frequent_runs(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, n_words, phrase, f: all runs of 1 to LONGEST words that occur LEAST times or more, and, as n_words 0, the number of words of each lang."""
    texts = docs.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"))
    sc, size = docs.sparkSession.sparkContext, text_bytes(texts)
    bits = sketch_bits(size)
    cells = sc.broadcast(frequent_cells(texts, bits))
    counts = texts.coalesce(max(2 * sc.defaultParallelism, size // TASK_BYTES)).mapInArrow(_exact(bits, cells), "lang string, n_words int, phrase binary, f long")
    exact = counts.groupBy("lang", "n_words", "phrase").agg(F.sum("f").alias("f")).where((F.col("n_words") == 0) | (F.col("f") >= LEAST))
    return cut(exact.select("lang", "n_words", F.col("phrase").cast("string").alias("phrase"), "f"))


def scored(runs: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, n, score, k of every run of two words or more: the cut after k words that scores lowest."""
    known = runs.where("n_words > 0").select("lang", "phrase", "f")
    words, k = F.split("phrase", " ", -1), F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k")
    cuts = runs.where("n_words > 1").select("lang", "phrase", F.col("f").alias("a"), "n_words", k)
    cuts = cuts.withColumns({"first": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "rest": F.array_join(F.slice(words, F.col("k") + 1, F.col("n_words") - F.col("k")), " ")}).drop("n_words")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"]).join(known.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    totals = runs.where("n_words = 0").select("lang", F.col("f").alias("n"))
    cuts = hot_join(cuts, "lang", totals, 0, totals.count()) if totals.count() <= 10_000 else cuts.join(totals, "lang")
    # up to 38 digits the decimals are exact, and `div` cuts the quotient off
    score = F.expr("(CAST(1000 AS decimal(38,0)) * a * n) div (CAST(l AS decimal(38,0)) * r)")
    best = cuts.withColumn("score", score).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b"))
    return best.select("lang", "phrase", "b.a", "b.l", "b.r", "b.n", "b.score", "b.k")


def subsumed(runs: DataFrame) -> DataFrame:
    """lang, phrase, longer: the greatest count of a longer frequent run that holds the phrase; phrases of two words or more."""
    words = F.split("phrase", " ", -1)
    sizes = F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)).alias("size")
    inner = runs.where("n_words > 2").select("lang", "f", "n_words", words.alias("words"), sizes)
    inner = inner.select("lang", "f", "words", "size", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("size") + 1)).alias("at"))
    return inner.select("lang", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", first: int = FIRST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best `first` phrases of each lang that no longer phrase stands for."""
    runs = frequent_runs(docs, text_col, lang_col)
    left = scored(runs).join(subsumed(runs), ["lang", "phrase"], "left").where(F.col("longer").isNull() | (100 * F.col("longer") < 100 * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    """All documents, candidates from 100 occurrences on, the first 2000 of each lang."""
    return collocations(table(spark, sf_dir, "documents"))


SQL = r"""
WITH w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM (SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY 1),
g AS (SELECT lang, m, array_to_string(ws[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM (SELECT lang, ws, unnest(range(1, 6)) AS m FROM w))),
f AS (SELECT lang, m, phrase, string_split(phrase, ' ') AS p, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, f AS a, k, array_to_string(p[1:k], ' ') AS x, array_to_string(p[k + 1:], ' ') AS y FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1)),
s AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, ((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
    FROM c JOIN t USING (lang) JOIN f x ON x.lang = c.lang AND x.phrase = c.x JOIN f y ON y.lang = c.lang AND y.phrase = c.y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT lang, f, p, z, unnest(range(1, m - z + 2)) AS o FROM (SELECT *, unnest(range(2, m)) AS z FROM f WHERE m > 2)),
h AS (SELECT lang, array_to_string(p[o:o + z - 1], ' ') AS phrase, max(f) AS longer FROM i GROUP BY ALL),
r AS (SELECT b.lang, b.phrase, a, l, r, n, score, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
    FROM b LEFT JOIN h ON h.lang = b.lang AND h.phrase = b.phrase WHERE longer IS NULL OR 100 * longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score FROM r WHERE rank <= 2000
"""
