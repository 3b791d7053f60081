"""Patched frame-of-reference blocks for token ids, in numpy.

A block of 128 values: its minimum is subtracted, the differences are packed at the bit width that a given percentile of
them needs, and the high bits of the rest go to an exception list. Blocks of one width are packed together.

Layout of an encoded array, all little-endian:
  u32 values, u32 blocks, u32 exceptions, u8 width of each block, u32 minimum of each block,
  u32 start of each block in the packed bytes (the index), packed bytes, then for exceptions u32 position, u32 high bits.
The last block is padded with its own minimum, that is with zeros after subtraction.
"""

from __future__ import annotations

import struct

import numpy as np

BLOCK = 128
PERCENTILE = 90


def _bit_length(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.floor(np.log2(np.maximum(x, 1).astype(np.float64))).astype(np.int64) + 1, 0)


def encode(values: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    n = len(values)
    blocks = -(-n // BLOCK)
    v = np.zeros(blocks * BLOCK, np.uint32)
    v[:n] = values
    if n % BLOCK:
        v[n:] = v[n - n % BLOCK : n].min()
    v = v.reshape(blocks, BLOCK)
    least = v.min(axis=1) if blocks else np.zeros(0, np.uint32)
    v = v - least[:, None]
    k = BLOCK * percentile // 100
    widths = _bit_length(np.partition(v, k, axis=1)[:, k]).astype(np.uint8) if blocks else np.zeros(0, np.uint8)
    sizes = widths.astype(np.uint32) * (BLOCK // 8)
    starts = np.zeros(blocks, np.uint32)
    np.cumsum(sizes[:-1], out=starts[1:])
    packed = np.zeros(int(sizes.sum()) // 4, "<u4")
    high = v >> widths[:, None]
    where = np.flatnonzero(high)
    for w in np.unique(widths):
        if w:
            rows = np.flatnonzero(widths == w)
            packed[(starts[rows] // 4)[:, None] + np.arange(4 * int(w))] = _pack(v[rows], int(w))
    return b"".join([struct.pack("<III", n, blocks, len(where)), widths.tobytes(), least.astype("<u4").tobytes(), starts.astype("<u4").tobytes(), packed.tobytes(), where.astype("<u4").tobytes(), high.ravel()[where].astype("<u4").tobytes()])


def _pack(v: np.ndarray, w: int) -> np.ndarray:
    """The low w bits of each row's 128 values, as 4 * w words a row; value i of all rows moves at once."""
    cols = np.ascontiguousarray((v & np.uint32((1 << w) - 1)).T)
    out = np.zeros((4 * w, len(v)), np.uint32)
    for i in range(BLOCK):
        k, s = divmod(i * w, 32)
        out[k] |= cols[i] << np.uint32(s)
        if s + w > 32:
            out[k + 1] |= cols[i] >> np.uint32(32 - s)
    return out.T


def _unpack(words: np.ndarray, w: int) -> np.ndarray:
    cols = np.ascontiguousarray(words.T)
    out = np.empty((BLOCK, len(words)), np.uint32)
    mask = np.uint32((1 << w) - 1)
    for i in range(BLOCK):
        k, s = divmod(i * w, 32)
        x = cols[k] >> np.uint32(s)
        if s + w > 32:
            x = x | (cols[k + 1] << np.uint32(32 - s))
        out[i] = x & mask
    return out.T


def _header(data: memoryview) -> tuple:
    n, blocks, exceptions = struct.unpack_from("<III", data)
    at = 12
    widths = np.frombuffer(data, np.uint8, blocks, at)
    least = np.frombuffer(data, "<u4", blocks, at + blocks)
    starts = np.frombuffer(data, "<u4", blocks, at + 5 * blocks)
    body = at + 9 * blocks
    size = int(widths.astype(np.int64).sum()) * (BLOCK // 8)
    where = np.frombuffer(data, "<u4", exceptions, body + size)
    high = np.frombuffer(data, "<u4", exceptions, body + size + 4 * exceptions)
    return n, blocks, widths, least, starts, np.frombuffer(data, "<u4", size // 4, body), where, high


def decode(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The values of blocks first to last (not included), found by the index; all by default."""
    n, blocks, widths, least, starts, packed, where, high = _header(memoryview(data))
    last = blocks if last is None else min(last, blocks)
    out = np.zeros((max(0, last - first), BLOCK), np.uint32)
    for w in np.unique(widths[first:last]):
        if w:
            rows = np.flatnonzero(widths[first:last] == w)
            out[rows] = _unpack(packed[(starts[rows + first] // 4)[:, None] + np.arange(4 * int(w))], int(w))
    mine = slice(*np.searchsorted(where, [first * BLOCK, last * BLOCK]))
    at = where[mine].astype(np.int64) - first * BLOCK
    flat = out.reshape(-1)
    flat[at] |= high[mine] << widths[where[mine] // BLOCK]
    out += least[first:last, None]
    return flat[: max(0, min(n, last * BLOCK) - first * BLOCK)]
