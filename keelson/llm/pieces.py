"""SentencePiece BPE by batched numpy Viterbi.

Of all ways to cut a word into pieces exactly one is the merges' own, and it is built from the left: a prefix's last
piece p fits behind the prefix before it if the merges leave the pair (last piece there, p) apart. So a Viterbi pass
whose transitions are 0 for pairs that stay apart and minus infinity for others finds it. Words of one length advance
together, a position at a time: prefix hashes give the hashes of all substrings that end there, a binary search in the
sorted hashes of the pieces finds those in the vocabulary, a table of pairs (sorted keys, filled on first sight by
running the merges) gives the transitions, and maxima over the starts keep the back pointers.
"""

from __future__ import annotations

import re
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np

from keelson.llm.bytebpe import Memo, pieces_of

SPACE = "▁"
#: Longer words are merged one by one, with the same result: a pass of the Viterbi over a single word gains nothing. Of the 27
#: million words of a table of 0.1 GB none is longer than 42 characters.
LONGEST = 200
#: Words remembered by a worker. It stays alive when other stages run, so what it holds counts against them.
MEMO = 400_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PairTable:
    """Non-negative integers to 0 or 1, looked up in bulk: open addressing, half full at most."""

    def __init__(self, bits: int = 18):
        self.bits, self.n = bits, 0
        self.keys, self.values = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int8)

    def _slot(self, keys):
        return ((keys * 0x2545F4914F6CDD1D & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)) if isinstance(keys, int) else (keys.view(np.uint64) * np.uint64(0x2545F4914F6CDD1D) >> np.uint64(64 - self.bits)).astype(np.int64)

    def put(self, key: int, value: int) -> None:
        if 2 * self.n >= len(self.keys):
            old = [(k, v) for k, v in zip(self.keys.tolist(), self.values.tolist(), strict=True) if k >= 0]
            self.__init__(self.bits + 1)
            for k, v in old:
                self.put(k, v)
        at, mask = self._slot(key), len(self.keys) - 1
        while self.keys[at] not in (-1, key):
            at = (at + 1) & mask
        self.n += self.keys[at] < 0
        self.keys[at], self.values[at] = key, value

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values; -1 where there is none."""
        out = np.full(len(keys), -1, np.int8)
        rows, at, mask = np.arange(len(keys)), self._slot(keys), len(self.keys) - 1
        while len(rows):
            there = self.keys[at]
            hit = there == keys
            out[rows[hit]] = self.values[at[hit]]
            more = ~hit & (there >= 0)
            rows, at, keys = rows[more], (at[more] + 1) & mask, keys[more]
        return out


class PieceModel:
    """Encodes and decodes as the sentencepiece library does with a BPE model with byte fallback.

    The library gives vocabulary, scores and normalisation; segmentation is done here. Words are cut before spaces, since
    no piece holds a space behind another character.
    """

    def __init__(self, path: str):
        import sentencepiece

        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        names = [sp.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        if any(SPACE in names[i].lstrip(SPACE) for i in plain):
            raise ValueError("a piece holds a space behind another character")
        self.ids = {names[i]: i for i in plain}
        self.scores = {names[i]: sp.get_score(i) for i in plain}
        self.names = names
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        self.other = n  # stands for one character that is no piece
        self.raw = [bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else names[i].replace(SPACE, " ").encode("utf-8") for i in range(n)]
        self.longest = max(map(len, self.ids))
        codes = [np.array([ord(c) for c in p], np.uint64) for p in self.ids]
        hashes = self._mixed(np.array([self._hash(c) for c in codes], np.uint64))
        order = np.argsort(hashes)
        self.hashes, self.hash_ids = hashes[order], np.array(list(self.ids.values()), np.int64)[order]
        self.hash_sizes = np.array([len(c) for c in codes], np.int64)[order]
        if (np.diff(self.hashes) == 0).any():
            raise ValueError("two pieces share a hash")
        self.name_sizes = np.array([len(x) for x in names] + [0])
        self.name_codes = np.zeros((n + 1, self.longest), np.uint32)
        for i in plain:
            self.name_codes[i, : len(names[i])] = [ord(c) for c in names[i]]
        # only pieces that their own merges yield can be part of a result
        alone = np.array([self.merge(names[i]) == [names[i]] for i in self.hash_ids.tolist()])
        self.hashes, self.hash_ids, self.hash_sizes = self.hashes[alone], self.hash_ids[alone], self.hash_sizes[alone]
        self.singles = np.array(sorted(ord(p) for p in self.ids if len(p) == 1), np.uint64)
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(self.longest, _BASE, np.uint64)]))
        # where the sorted hashes with given top bits start: a search is a few probes from there
        self.radix = np.searchsorted(self.hashes, np.arange(1 << 16, dtype=np.uint64) << np.uint64(48)).astype(np.int32)
        self.radix = np.append(self.radix, np.int32(len(self.hashes)))
        self.pairs = PairTable()
        self.memo = Memo(MEMO)
        self.newline_known = "\n" in self.ids

    @staticmethod
    def _hash(codes: np.ndarray) -> np.uint64:
        h = np.uint64(0)
        with np.errstate(over="ignore"):
            for c in codes:
                h = h * _BASE + c + np.uint64(1)
        return h

    @staticmethod
    def _mixed(h: np.ndarray) -> np.ndarray:
        """Spreads polynomial hashes, which are small for short strings, over all bits; one to one."""
        with np.errstate(over="ignore"):
            return (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def merge(self, word: str) -> list[str]:
        """The merges themselves: the pair with the best score, the leftmost of equals, until none is a piece."""
        parts: list[str | None] = list(word)
        n, scores = len(parts), self.scores
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(-s, i, a, b) for i, (a, b) in enumerate(zip(word, word[1:], strict=False)) if (s := scores.get(a + b)) is not None]
        heapify(heap)
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := scores.get(parts[i] + parts[k])) is not None:
                    heappush(heap, (-s, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (s := scores.get(parts[h] + parts[i])) is not None:
                heappush(heap, (-s, h, parts[h], parts[i]))
        return [p for p in parts if p is not None]

    def _find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the hashes are a piece's, and its place among the sorted pieces."""
        top = (h >> np.uint64(48)).astype(np.int32)
        at, end = self.radix[top], self.radix[top + 1]
        rows = np.flatnonzero(at < end)
        at, end, h = at[rows], end[rows], h[rows]
        found_rows, found = [], []
        while len(rows):
            hit = self.hashes[at] == h
            found_rows.append(rows[hit])
            found.append(at[hit])
            at = at + 1
            more = ~hit & (at < end)
            rows, at, end, h = rows[more], at[more], end[more], h[more]
        return (np.concatenate(found_rows), np.concatenate(found)) if found else (rows, at)

    def _apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the merges leave each pair of pieces apart; pairs seen first are merged to find out."""
        keys = left * (self.other + 1) + right
        out = self.pairs.get(keys)
        new = np.flatnonzero(out < 0)
        if len(new):
            fresh, back = np.unique(keys[new], return_inverse=True)
            values = []
            for k in fresh.tolist():
                a, b = divmod(k, self.other + 1)
                values.append(int(self.other in (a, b) or self.merge(self.names[a] + self.names[b]) == [self.names[a], self.names[b]]))
                self.pairs.put(k, values[-1])
            out[new] = np.array(values, np.int8)[back]
        return out > 0

    def viterbi(self, words: list[str]) -> list[bytes]:
        """The ids of words of one length, as little-endian 32-bit integers."""
        n, size = len(words), len(words[0])
        codes = np.array(words, dtype=f"<U{size}").view(np.uint32).reshape(n, size)
        wide = codes.astype(np.uint64)
        strange = ~np.isin(wide, self.singles)
        prefix = np.zeros((size + 1, n), np.uint64)
        best = np.full((size + 1, n), -1, np.int32)  # the back pointer: the largest valid start of the prefix's last piece
        last = np.full((size + 1, n), -1, np.int64)  # that piece
        best[0] = 0
        with np.errstate(over="ignore"):
            for p in range(1, size + 1):
                prefix[p] = prefix[p - 1] * _BASE + wide[:, p - 1] + np.uint64(1)
                for q in range(max(0, p - self.longest), p):
                    rows, at = self._find(self._mixed(prefix[p] - prefix[q] * self.powers[p - q]))
                    if not len(rows):
                        continue
                    fits = (self.hash_sizes[at] == p - q) & (best[q][rows] >= 0)
                    rows, found = rows[fits], self.hash_ids[at[fits]]
                    if q and len(rows):
                        apart = self._apart(last[q][rows], found)
                        rows, found = rows[apart], found[apart]
                    best[p][rows], last[p][rows] = q, found  # starts only grow, so what is stored last is the maximum
                odd = np.flatnonzero(strange[:, p - 1] & (best[p - 1] >= 0))
                best[p][odd], last[p][odd] = p - 1, self.other
        return self._backtrack(words, codes, best, last)

    def _backtrack(self, words: list[str], codes: np.ndarray, best: np.ndarray, last: np.ndarray) -> list[bytes]:
        """Follows the back pointers of all words at once; words with strange characters, or not spelled by their pieces, one by one."""
        n, size = codes.shape
        every = np.arange(n)
        at, columns, starts = np.full(n, size), [], []
        while at.any():
            live = at > 0
            piece = np.where(live, last[at, every], -1)
            start = np.where(live & (piece >= 0), best[at, every], 0)
            columns.append(np.where(live & (piece < 0), self.other, piece))
            starts.append(start)
            at = start
        ids, begin = np.stack(columns[::-1], axis=1), np.stack(starts[::-1], axis=1)
        plain = ~(ids == self.other).any(axis=1)
        rows, k = np.nonzero((ids >= 0) & (ids != self.other))
        piece, begin = ids[rows, k], begin[rows, k]
        sizes = self.name_sizes[piece]
        for j in range(min(self.longest, size)):
            more = np.flatnonzero(sizes > j)
            wrong = codes[rows[more], np.minimum(begin[more] + j, size - 1)] != self.name_codes[piece[more], j]
            plain[rows[more[wrong]]] = False
        flat = ids[plain]
        raw = flat[flat >= 0].astype("<u4").tobytes()
        ends = np.zeros(n, np.int64)
        ends[plain] = 4 * np.cumsum((flat >= 0).sum(axis=1))
        out, before = [], 0
        for w, good, end in zip(words, plain.tolist(), ends.tolist(), strict=True):
            if good:
                out.append(raw[before:end])
                before = end
            else:
                out.append(np.array(self._merged(w), "<u4").tobytes())
        return out

    def _fallback(self, c: str) -> list[int]:
        return [self.byte_ids[b] for b in c.encode("utf-8")] if self.byte_ids else [self.unknown]

    def _merged(self, word: str) -> list[int]:
        out: list[int] = []
        for p in self.merge(word):
            out += [self.ids[p]] if p in self.ids else self._fallback(p)
        return out

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of words, as little-endian 32-bit integers; words of one length in one pass."""
        out: list[bytes] = [b""] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > LONGEST or SPACE * 2 in w:  # runs of spaces are pieces of one score: ties that only the merges decide
                out[i] = np.array(self._merged(w), "<u4").tobytes()
            else:
                by_size.setdefault(len(w), []).append(i)
        for size, rows in by_size.items():
            for k in range(0, len(rows) if size else 0, 20_000):
                part = rows[k : k + 20_000]
                for i, ids in zip(part, self.viterbi([words[i] for i in part]), strict=True):
                    out[i] = ids
        return out

    def _learn(self, pieces: list[str]) -> list[bytes]:
        return self.encode_words([p if p[:1] == "\n" else SPACE + p for p in pieces])

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit integers. All texts' new words are segmented together."""
        cut: list[list[str] | None] = []
        for t in texts:
            t = t if self.plain(t) else None
            # "\n" is no piece, so a word ends before it and what follows stands without a space
            cut.append(pieces_of(t) if t else None)
        flat = [p for pieces in cut if pieces for p in pieces]
        values = self.memo.look_up(flat, self._learn)
        out, at = [], 0
        for t, pieces in zip(texts, cut, strict=True):
            if pieces:
                out.append(b"".join(values[at : at + len(pieces)]))
                at += len(pieces)
            else:
                out.append(b"".join(self.encode_words(self.words(t))))
        return out

    def plain(self, text: str) -> bool:
        """Whether words are what single spaces and line feeds between other characters separate, and the text is its own normal form."""
        return bool(text) and not self.newline_known and text[0] not in " \n" and text[-1] not in " \n" and "  " not in text and " \n" not in text and "\n " not in text and "\n\n" not in text and SPACE not in text and self.identity

    @property
    def identity(self) -> bool:
        """Whether normalisation only puts a space in front and marks spaces."""
        if not hasattr(self, "_identity"):
            probe = "Aéé ﬁ½　Ａ​­①\n\tZ"
            self._identity = self.sp.Normalize(probe) == SPACE + probe.replace(" ", SPACE) and self.sp.Normalize("a  b ") == f"{SPACE}a{SPACE}{SPACE}b{SPACE}"
        return self._identity

    def words(self, text: str) -> list[str]:
        """The normalised text cut before each run of spaces."""
        return re.findall(f"{SPACE}*[^{SPACE}]+|{SPACE}+", self.sp.Normalize(text)) if text else []

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces joined, bytes put together, the space in front taken off."""
        text = b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")
        return text.removeprefix(" ")


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)
