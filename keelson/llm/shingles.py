"""Words and shingles of texts of any length, a slice at a time."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

#: Bytes of text that are cut to words together; what a text of any length costs beyond itself follows from it.
SLICE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z in lower case, as lists; slices end at blanks, so no word is cut."""
    at, n = 0, len(text)
    while at < n:
        end = n
        if n - at > SLICE and (m := _BLANK.search(text, at + SLICE)):
            end = m.start()
        yield text[at:end].lower().split()  # on bytes: A-Z and the six ASCII blanks only
        at = end


def shingle_parts(text: bytes, width: int, seed: int) -> Iterator[list[int]]:
    """XXH64 of every run of `width` words, joined by spaces; a text of fewer words is one shingle, one without words has none."""
    digest, carry, short = xxhash.xxh64_intdigest, [], True
    for words in word_slices(text):
        words = carry + words if carry else words
        n = len(words)
        if n < width:
            carry = words
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1)
        starts = (ends - np.diff(ends, prepend=0)).tolist()
        yield [digest(joined[a:z], seed) for a, z in zip(starts, (ends[width - 1 :] - 1).tolist(), strict=False)]
        carry, short = words[n - width + 1 :], False
    if short and carry:
        yield [digest(b" ".join(carry), seed)]


def text_hash(text: bytes, seed: int) -> int:
    """XXH64 of the words in lower case, joined by spaces."""
    h, first = xxhash.xxh64(seed=seed), True
    for words in word_slices(text):
        if words:
            h.update(b" ".join(words) if first else b" " + b" ".join(words))
            first = False
    return h.intdigest()
