"""Vectorised kernels over Arrow string buffers.

Every operator that reads text works on the UTF-8 buffer of an Arrow batch with numpy, so no
Python string is made per row. A slice of rows is handled at a time to bound memory.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that one vectorised step handles; a longer row is handled alone.
SLICE_BYTES = 1 << 20
MULT = 0x9E3779B97F4A7C15
_INVERSE = pow(MULT, -1, 1 << 64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

#: Byte to folded byte: ASCII letters in lower case, digits and all bytes of non-ASCII characters as they are, 0 for the rest.
FOLD = np.zeros(256, np.uint8)
FOLD[128:] = np.arange(128, 256)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    FOLD[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    FOLD[_c] = _c + 32


def utf8_view(values: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all rows and the n + 1 offsets between them; a null has no bytes."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    if not pa.types.is_large_string(values.type):
        values = values.cast(pa.large_string())
    if values.null_count:
        values = values.fill_null("")
    if len(values) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = values.buffers()
    offsets = np.frombuffer(where, np.int64)[values.offset : values.offset + len(values) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes, one row at least."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, min(to, n)
        at = to


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((MULT, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _POWERS[k] = np.multiply.accumulate(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``codes``, equal spans having equal hashes wherever they stand."""
    up, down = _powers(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * up[: len(codes)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs in ``mask`` that don't cross a row."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    cut = np.zeros(len(mask) + 1, bool)
    cut[offsets] = True
    before = np.concatenate([[False], mask[:-1]])
    after = np.concatenate([mask[1:], [False]])
    return np.flatnonzero(mask & (~before | cut[:-1])), np.flatnonzero(mask & (~after | cut[1:])) + 1


def rows_of(offsets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The row in which each position lies."""
    return np.searchsorted(offsets, at, "right") - 1


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all spans, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)
