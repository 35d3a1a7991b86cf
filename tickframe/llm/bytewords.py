"""Words of a slice of texts by classes of bytes, vectorised.

Separators are ASCII bytes, so cutting UTF-8 bytes cuts no character.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .shingles import utf8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_words(texts: pa.Array, separator: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The words of all texts in order, A-Z lower-cased: maximal runs of
    bytes for which ``separator[byte]`` is 0; none crosses texts. Also the
    start of each word, the separator class of each byte, and the texts'
    offsets, all in the joined bytes."""
    data, offsets = utf8(texts)
    kind = separator[data]
    inside = kind == 0
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    at = np.concatenate([[0], np.cumsum(ends - starts + 1)]).astype(np.int64)
    words = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(_LOWER[data[inside]].tobytes())])
    return words, starts, kind, offsets
