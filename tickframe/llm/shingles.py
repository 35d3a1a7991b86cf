"""Vectorised word hashing and word shingles over Arrow text batches.

Helpers used inside tasks: they take one Arrow string array (a slice of a
Spark batch) and work on its UTF-8 buffer with numpy. Nothing here knows
about Spark or about more than one batch.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single text is one slice.
SLICE_BYTES = 2 << 20

_U = np.uint64
_MIX1, _MIX2, _STEP = _U(0xBF58476D1CE4E5B9), _U(0x94D049BB133111EB), _U(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so invertible modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64-bit result."""
    x = (x ^ (x >> _U(30))) * _MIX1
    x = (x ^ (x >> _U(27))) * _MIX2
    return x ^ (x >> _U(31))


def _byte_values() -> np.ndarray:
    lowered = np.arange(256)
    lowered[65:91] += 32
    return mix((lowered.astype(_U) + _U(1)) * _STEP)


_VALUES = _byte_values()
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, _U)
    down = np.full(size, pow(_BASE, -1, 1 << 64), _U)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=_U), np.cumprod(down, dtype=_U)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string array (nulls as empty texts) and its offsets."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, limit: int = SLICE_BYTES):
    """(first, last) row ranges of at most ``limit`` bytes, or one row."""
    _, offsets = utf8(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield first, last
        first = last


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash of each white-space separated word, A-Z lower-cased, and
    the row offsets of the words (``len(texts) + 1`` numbers)."""
    data, offsets = utf8(texts)
    if len(data) == 0:
        return np.zeros(0, _U), np.zeros(len(texts) + 1, np.int64)
    inside = ~_SEPARATOR[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    size = 1 << max(19, int(len(data)).bit_length())  # few sizes, as they are kept
    up, down = _powers(size)
    total = np.zeros(len(data) + 1, _U)
    np.cumsum(_VALUES[data] * up[:len(data)], dtype=_U, out=total[1:])
    hashes = (total[ends + 1] - total[starts]) * down[starts]
    hashes = mix(hashes + (ends - starts).astype(_U) * _STEP)
    return hashes, np.searchsorted(starts, offsets)


def shingle_hashes(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``size``-word shingles of each text as sorted 64-bit hashes,
    and the row offsets. A text with fewer words, but not none, has one
    shingle: the whole sequence."""
    words, offsets = word_hashes(texts)
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    counts = np.diff(offsets)
    value = np.zeros(len(words), _U)
    for k in range(size):
        part = mix(words + _U((k + 1) * int(_STEP) & 0xFFFFFFFFFFFFFFFF))
        value[:max(len(words) - k, 0)] += part[k:]
    value = mix(value)
    place = np.arange(len(words)) - offsets[rows] if len(words) else np.zeros(0, np.int64)
    keep = place + size <= counts[rows] if len(words) else np.zeros(0, bool)
    short = np.flatnonzero((counts > 0) & (counts < size))
    value, rows = value[keep], rows[keep]
    if len(short):
        extra = np.array([mix(np.array([sum(int(x) for x in mix(words[offsets[r]:offsets[r + 1]] + _STEP * np.arange(1, counts[r] + 1, dtype=_U)))
                                        + int(counts[r]) & 0xFFFFFFFFFFFFFFFF], _U))[0] for r in short], _U)
        value, rows = np.concatenate([value, extra]), np.concatenate([rows, short])
    order = np.lexsort((value, rows))
    value, rows = value[order], rows[order]
    if len(value):
        fresh = np.ones(len(value), bool)
        fresh[1:] = (value[1:] != value[:-1]) | (rows[1:] != rows[:-1])
        value, rows = value[fresh], rows[fresh]
    return value, np.searchsorted(rows, np.arange(len(texts) + 1))
