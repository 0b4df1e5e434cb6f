"""Vectorised word scanning over Arrow string columns (helper of the tasks).

A batch of texts is one byte buffer, so words are found with a byte table and
hashed with prefix sums: no Python loop per word.  A word's 64-bit hash is a
polynomial over per-byte random values, so equal words have equal hashes in
every task and run.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_MASK = (1 << 64) - 1
#: stands for a null integer id: it ranks above all others
NO_ID = (1 << 63) - 1
BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


#: one random value per byte, and the multipliers of a word's place in a window
BYTE = mix(np.arange(1, 257, dtype=U) * U(BASE))
PLACE = mix(np.arange(1001, 1065, dtype=U) * U(BASE)) | U(1)


def separators(*ranges: tuple[int, int], lower: bool) -> np.ndarray:
    """Byte table: 0 for separators, else the byte (A-Z lower-cased if asked)."""
    t = np.arange(256, dtype=np.uint8)
    if lower:
        t[65:91] += 32
    for a, b in ranges:
        t[a:b + 1] = 0
    return t


#: words ``[^\x20\x09-\x0D]+``; a NUL byte counts as a letter and is mapped to 0x01's neighbour below
SPACE = ((0x09, 0x0D), (0x20, 0x20))
#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
PUNCT = ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


class Words:
    """Words of a batch: byte ranges, 64-bit hashes, and each text's first word."""

    __slots__ = ("start", "end", "hash", "first")

    def __init__(self, start, end, hashes, first):
        self.start, self.end, self.hash, self.first = start, end, hashes, first


_pow = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i for i < n, modulo 2**64."""
    if _pow["n"] < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        up, down = np.full(size, BASE & _MASK, U), np.full(size, pow(BASE, -1, 1 << 64), U)
        up[0] = down[0] = 1
        _pow.update(n=size, up=np.cumprod(up, dtype=U), down=np.cumprod(down, dtype=U))
    return _pow["up"][:n], _pow["down"][:n]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(len(column) + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def scan(off: np.ndarray, raw: np.ndarray, sep: tuple, lower: bool) -> Words:
    """Words of every text; a separator or a text's end closes a word."""
    low = separators(lower=lower)[raw] if lower else raw
    inside = np.ones(256, bool)
    for a, b in sep:
        inside[a:b + 1] = False
    word = inside[low]
    n = len(raw)
    first_byte, last_byte = off[:-1], off[1:] - 1
    filled = last_byte >= first_byte
    start, end = word.copy(), word.copy()
    if n:
        start[1:] &= ~word[:-1]
        end[:-1] &= ~word[1:]
        b = first_byte[filled]
        start[b] = word[b]
        b = last_byte[filled]
        end[b] = word[b]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    up, down = _powers(max(n, 1))
    total = np.zeros(n + 1, U)
    np.cumsum(BYTE[low] * up[:n], out=total[1:])
    return Words(s, e, mix((total[e] - total[s]) * down[s] if len(s) else np.zeros(0, U)), np.searchsorted(s, off))


def pieces(column: pa.Array, limit: int = 1 << 21, rows: int = 1 << 30):
    """Row ranges ``(a, b, offsets, bytes)`` of about ``limit`` bytes (a longer text is one range) and at most ``rows`` rows each."""
    off, raw = utf8(column)
    a, n = 0, len(off) - 1
    while a < n:
        b = min(a + rows, max(a + 1, int(np.searchsorted(off, off[a] + limit, "right")) - 1))
        yield a, b, off[a:b + 1] - off[a], raw[off[a]:off[b]]
        a = b


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words; a shorter, non-empty text is one run."""
    n = len(hashes)
    if n == 0:
        return hashes
    size = min(size, n)
    acc = np.full(n - size + 1, size, U)
    for j in range(size):
        acc += hashes[j:n - size + 1 + j] * PLACE[j % len(PLACE)]
    return mix(acc)


def whole_groups(batches, key: str, least: int, weight=lambda t: t.num_rows):
    """Tables of about ``least`` weight or more, cut where ``key`` (sorted) changes."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += weight(batch)
        if size >= least:
            table = pa.Table.from_batches(held)
            k = table.column(key).to_numpy()
            cut = int(np.searchsorted(k, k[-1]))
            if cut:
                yield table.slice(0, cut)
                held = table.slice(cut).to_batches()
            size = sum(map(weight, held))
            if not cut:
                least = max(least, 2 * size)
    if held:
        yield pa.Table.from_batches(held)
