"""Texts of an Arrow batch as flat byte arrays: slices, words, prefix polynomials modulo 2**64."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
BASE = 0x9E3779B97F4A7C15
SLICE_BYTES = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers = {BASE: np.ones(1, U), pow(BASE, -1, 2**64): np.ones(1, U)}


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Spread 64-bit values evenly (xor-shift and multiply); `seed` gives independent orders."""
    h = h ^ U(seed * 0xD6E8FEB86659FD93 % 2**64)
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; the table is kept and doubled as needed."""
    out = _powers[base]
    while len(out) < n:
        out = np.concatenate([out, out * U(pow(base, len(out), 2**64))])
    _powers[base] = out
    return out[:n]


class Prefixes:
    """Prefix polynomial of a byte array; the hash of any span is one subtraction and one product."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, U)
        np.cumsum((data.astype(U) + U(1)) * powers(BASE, n), out=self.sums[1:])
        self.back = powers(pow(BASE, -1, 2**64), n + 1)

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of data[start:end]; equal spans have equal hashes wherever they stand."""
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mixed(raw + (ends - starts).astype(U) * U(0xA0761D6478BD642F))


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the row offsets in them; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, offsets


def slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Groups of whole rows of at most `most` bytes (a longer row alone): first row, bytes, offsets."""
    data, offsets = flat(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1)
        part = offsets[first : last + 1]
        yield first, data[part[0] : part[-1]], part - part[0]
        first = last


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes other than blank, tab to carriage return.

    Returns starts, ends, hashes, and for each row the number of its first word (rows + 1 numbers).
    """
    if lower:
        data = _LOWER[data]
    inside = ~_SPACE[data]
    starts, ends = inside.copy(), inside.copy()
    if len(data):
        head = np.zeros(len(data) + 1, bool)
        head[offsets] = True  # a word never crosses rows
        starts[1:] &= ~inside[:-1] | head[1:-1]
        ends[:-1] &= ~inside[1:] | head[1:-1]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    hashes = Prefixes(data).spans(begin, end) if len(begin) else np.zeros(0, U)
    return begin, end, hashes, np.searchsorted(begin, offsets)


def shingled(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of every run of `size` consecutive words."""
    out = hashes[: len(hashes) - size + 1].copy()
    for k in range(1, size):
        out = mixed(out) + hashes[k : len(hashes) - size + 1 + k]
    return mixed(out)
