"""Byte-level BPE over memoised pieces.

The vocabulary's pattern lets a space start a pre-token but never stand inside or end one, except in runs of white
space. So a text whose white space is single spaces and single line feeds, each between other characters, falls apart
before each of them, and its tokens are those of the pieces one after another. Pieces repeat far more than texts; each
distinct one is encoded once per worker while the memo has room. Texts with other white space (runs, tabs, at the end)
or with a special string take the plain path: their pieces never enter the memo.
"""

from __future__ import annotations

import json
import re
from functools import cache, lru_cache
from heapq import heapify, heappop, heappush

import numpy as np

MEMO = 2_000_000
_ODD = re.compile(r"\s")
#: The split pattern of the byte-level vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read_spec(path: str) -> dict:
    """A vocabulary file of the tokenizers library; ValueError unless it is byte-level BPE with the split pattern above and no more."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    plain = model.get("type") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "byte_fallback"))
    level = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True)
    bare = all(not any(x.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")) for x in spec["added_tokens"])
    if not plain or not level or not bare or spec.get("normalizer") or spec.get("truncation") or spec.get("padding"):
        raise ValueError(f"{path} is no plain byte-level BPE: its normalizer, pre-tokenizer or model has options that are not built here")
    return spec


@cache
def special_strings(path: str) -> tuple[str, ...]:
    return tuple(x["content"] for x in read_spec(path)["added_tokens"])


def pieces_of(text: str) -> list[str]:
    """The text cut before single spaces and line feeds; a space is not part of its piece, a line feed is."""
    return text.replace("\n", " \n").split(" ")


def all_plain(pieces: list[str], specials: tuple[str, ...]) -> bool:
    """Whether each piece may stand for itself wherever it occurs: no white space but one line feed before other text."""
    if "" in pieces or "\n" in pieces:
        return False
    joined = "".join(map(as_written, pieces))
    return len(_ODD.findall(joined)) == len(pieces) and not any(s in joined for s in specials)


def as_written(piece: str) -> str:
    return piece if piece[0] == "\n" else " " + piece


class Memo:
    """A dict of bounded size in two generations: when the young one is full it becomes the old one, and what is used again is taken over."""

    def __init__(self, limit: int = MEMO):
        self.limit, self.young, self.old = limit // 2, {}, {}

    def look_up(self, pieces: list[str], learn) -> list | None:
        """The pieces' values. learn(new pieces) gives those of new ones, or None if one of them can't be learnt: then the result is None."""
        values = list(map(self.young.get, pieces))
        holes = [i for i, v in enumerate(values) if v is None]
        if not holes:
            return values
        missing, old = {pieces[i] for i in holes}, self.old
        new = [p for p in missing if p not in old]
        learnt = learn(new) if new else []
        if learnt is None:
            return None
        found = dict(zip(new, learnt, strict=True))
        for p in missing:
            if p not in found:
                found[p] = old[p]
        for i in holes:
            values[i] = found[pieces[i]]
        if len(self.young) + len(found) > self.limit:
            self.young, self.old = {}, self.young
        if len(found) <= self.limit:
            self.young.update(found)
        return values


class IdEncoder:
    """Token ids of whole texts as little-endian unsigned 32-bit integers, by the tokenizers library."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        self.specials = special_strings(path)
        blanks = tuple(byte_letters()[ord(c)] for c in " \n")
        vocab = self.lib.get_vocab(with_added_tokens=True)
        # tokens that begin with a space or line feed: in plain pieces these are the first tokens, one per piece
        self.opens = np.zeros(max(vocab.values()) + 1, bool)
        self.opens[[i for t, i in vocab.items() if t.startswith(blanks)]] = True
        self.memo = Memo()

    def plain(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, pieces: list[str]) -> list[bytes] | None:
        """Encodes pieces by the library, many in one text; None if one of them isn't plain or doesn't begin with one opening token."""
        if not all_plain(pieces, self.specials):
            return None
        out = []
        for i in range(0, len(pieces), 500):
            part = pieces[i : i + 500]
            ids = np.array(self.lib.encode_batch_fast(["".join(map(as_written, part))], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(self.opens[ids])).tolist()
            if len(cuts) != len(part):
                return None
            raw = ids.tobytes()
            out += [raw[a:z] for a, z in zip(cuts, [*cuts[1:], len(raw)], strict=True)]
        return out

    def encode_one(self, text: str) -> bytes:
        pieces = pieces_of(text)
        first = pieces.pop(0)
        if not pieces:
            return self.plain(first) if first else b""
        values = self.memo.look_up(pieces, self.learn)
        if values is None:
            return self.plain(text)
        # the first piece has no space before it
        return (self.plain(first) if first else b"") + b"".join(values)

    def encode(self, texts: list[str]) -> list[bytes]:
        return list(map(self.encode_one, texts))


@lru_cache(maxsize=2)
def id_encoder(path: str) -> IdEncoder:
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return IdEncoder(path)


def byte_letters() -> dict[int, str]:
    """The printable stand-in for each byte: itself where visible in Latin-1, else the next code point from 256 on."""
    out, spare = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class TokenCounter:
    """Token counts without ids: whole-token pre-tokens are looked up, only the rest is merged. whole is the result of prove()."""

    def __init__(self, path: str, whole: frozenset[str] = frozenset()):
        import regex

        spec = read_spec(path)
        self.letters = byte_letters()
        self.vocab = spec["model"]["vocab"]
        self.specials = tuple(x["content"] for x in spec["added_tokens"])
        self.cut = regex.compile("|".join(regex.escape(s) for s in sorted(self.specials, key=len, reverse=True))) if self.specials else None
        self.pieces = regex.compile(PATTERN)
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.ranks = {m: i for i, m in reversed(list(enumerate(merges)))}
        self.whole = whole
        self.memo = Memo()
        self.rest: dict[str, int] = {}

    def prove(self) -> frozenset[str]:
        """The vocabulary strings whose own merges end in one token."""
        back, out = {ord(c): b for b, c in self.letters.items()}, set()
        for token in self.vocab:
            try:
                text = bytes(back[ord(c)] for c in token).decode("utf-8")
            except (KeyError, UnicodeDecodeError):
                continue  # a special token, or a fragment of a character: never a pre-token
            if self.merged(text) == 1:
                out.add(text)
        return frozenset(out)

    def merged(self, pre_token: str) -> int:
        """The number of tokens that the merges leave of a pre-token, lowest rank first, then leftmost."""
        parts: list[str | None] = [self.letters[b] for b in pre_token.encode("utf-8")]
        n, ranks = len(parts), self.ranks
        if n == 1:
            return 1
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None]
        heapify(heap)
        left = n
        while heap:
            _, i, a, b = heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, None
            left -= 1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if (r := ranks.get((parts[i], parts[k]))) is not None:
                    heappush(heap, (r, i, parts[i], parts[k]))
            if (h := before[i]) >= 0 and (r := ranks.get((parts[h], parts[i]))) is not None:
                heappush(heap, (r, h, parts[h], parts[i]))
        return left

    def count_pre_tokens(self, text: str) -> int:
        total = 0
        for p in self.pieces.findall(text):
            if p in self.whole:
                total += 1
                continue
            if (n := self.rest.get(p)) is None:
                n = self.merged(p)
                if len(self.rest) >= MEMO // 4:
                    self.rest.clear()
                if len(p) < 200:
                    self.rest[p] = n
            total += n
        return total

    def count_plain(self, text: str) -> int:
        parts = self.cut.split(text) if self.cut else [text]
        return sum(map(self.count_pre_tokens, parts)) + len(parts) - 1

    def learn(self, pieces: list[str]) -> list[int] | None:
        if not all_plain(pieces, self.specials):
            return None
        return [self.count_pre_tokens(as_written(p)) for p in pieces]

    def count(self, text: str) -> int:
        pieces = pieces_of(text)
        first = pieces.pop(0)
        if not pieces:
            return self.count_plain(first) if first else 0
        values = self.memo.look_up(pieces, self.learn)
        if values is None:
            return self.count_plain(text)
        return (self.count_plain(first) if first else 0) + sum(values)


@cache
def whole_tokens(path: str) -> frozenset[str]:
    """The proof for a vocabulary, once per process: the driver makes it and workers are handed the result."""
    return TokenCounter(path).prove()


_counters: dict[str, TokenCounter] = {}


def token_counter(path: str, whole: frozenset[str] | None = None) -> TokenCounter:
    """A worker's counter for a vocabulary, with its memo kept from task to task."""
    if path not in _counters:
        _counters[path] = TokenCounter(path, whole_tokens(path) if whole is None else whole)
    return _counters[path]
