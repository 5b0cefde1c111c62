"""Whole-batch text work on the raw UTF-8 bytes of Arrow columns: words, word hashes, slice hashes.

Words are maximal runs of bytes other than space and 0x09-0x0D; lower-casing touches A-Z only. Both are byte-wise, so
nothing is decoded. Hashes of words are 64-bit sums of one random number for each byte and place; those of slices, which may
overlap, are polynomial prefix sums. Both end in a finishing mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS: dict[str, np.ndarray] = {}
#: A random number for each byte at each of PLACES places, for two independent hashes.
PLACES = 64
_GRIDS = np.random.default_rng(20260101).integers(0, 1 << 64, (2, PLACES * 256), dtype=np.uint64)


def _powers(name: str, base: int, n: int) -> np.ndarray:
    """base**0 .. base**n modulo 2**64, kept between calls up to a few blocks' length."""
    have = _POWERS.get(name)
    if have is not None and len(have) > n:
        return have[:n + 1]
    out = np.full(max(n + 1, BLOCK_BYTES + 1), base, np.uint64)
    out[0] = 1
    np.multiply.accumulate(out, out=out)
    if len(out) <= 4 * BLOCK_BYTES:
        _POWERS[name] = out
    return out[:n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finishing mix of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """All texts of an Arrow column as one byte array, and each text's bounds in it; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts hold about `limit` bytes; a longer text is a slice of its own."""
    _, bounds = utf8(batch.column(text))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(bounds, bounds[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start)
        start = end


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the position of its first word (one more entry than texts)."""
    ink = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = ink[:-1], ink[1:]
    starts = np.flatnonzero(ink & (~before | edge[:-1]))
    ends = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as one number, zeros beyond the end."""
    out = np.zeros(len(data) + 8, np.uint64)
    out[:len(data)] = data
    for width in (1, 2, 4):
        out[:-width] |= out[width:] << np.uint64(8 * width)
    return out[:len(data)]


class Slices:
    """Hashes of arbitrary slices of a byte array in constant time each.

    Sums of powers modulo 2**64 meet for some patterned strings of bytes, those of Thue and Morse. With `grouped` a slice,
    then of eight bytes at least, is hashed as its overlapping groups of eight bytes, each mixed, where they do not.
    """

    def __init__(self, data: np.ndarray, grouped: bool = False):
        n = len(data)
        self.beyond = 7 if grouped else 0
        self.inverse = _powers("inverse", pow(_BASE, -1, 1 << 64), n)
        self.sums = np.zeros(n + 1, np.uint64)
        symbols = mix(eights(data)) if grouped else _BYTE[data]
        np.cumsum(symbols * _powers("base", _BASE, n)[:n], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends - self.beyond] - self.sums[starts]) * self.inverse[starts]
        return mix(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Hashes of slices that follow one another without overlap; `which` of two independent ones.

    Every byte adds a random number of its own for its place in the slice; from PLACES on the numbers come again under
    another odd factor for each round.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    place = np.arange(len(data), dtype=np.uint32)
    place[starts[0]:] -= np.repeat(starts.astype(np.uint32), np.diff(np.append(starts, len(data))))
    value = _GRIDS[which][(place & np.uint32(PLACES - 1)) << np.uint32(8) | data]
    longest = int((ends - starts).max())
    if longest > PLACES:
        factors = mix(np.arange(-(-longest // PLACES), dtype=np.uint64)) | np.uint64(1)
        value *= factors[np.minimum(place // np.uint32(PLACES), len(factors) - 1)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value, out=sums[1:])
    return mix(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def distinct_shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, joined, and their bounds.

    A text with fewer words has its whole sequence as its one shingle; without words it has none.
    """
    weights = mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
    sets, bounds = [], np.zeros(len(first), np.int64)
    whole = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for t in range(width if len(whole) else 0):
        whole += hashes[t:t + len(whole)] * weights[t]
    whole = mix(whole)
    for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b - a >= width:
            own = np.unique(whole[a:b - width + 1])
        elif b > a:
            own = mix((hashes[a:b] * weights[:b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a))
        else:
            own = whole[:0]
        sets.append(own)
        bounds[i + 1] = bounds[i] + len(own)
    return (np.concatenate(sets) if sets else whole[:0]), bounds


def strings(values) -> pa.Array:
    return pa.array(values, pa.string())


def longs(values: np.ndarray) -> pa.Array:
    """64-bit hashes as Spark's signed longs."""
    return pa.array(np.asarray(values).astype(np.uint64).view(np.int64))


def lists(values: np.ndarray, bounds: np.ndarray, kind=None) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.asarray(bounds, np.int32)), pa.array(values, kind))
