"""Pre-tokens ("words") of byte-level BPE: split by the vocabulary's pattern
in Spark, then handled as the distinct words of a slice of rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import whole_texts

#: Bytes of words handled at once inside a task.
SLICE_BYTES = 6 << 20


def with_words(docs: DataFrame, pattern: str) -> DataFrame:
    """(doc_id, words): every match of ``pattern`` in the whole text, in
    order. ``(?U)`` gives white space its Unicode meaning."""
    return whole_texts(docs).select("doc_id", F.regexp_extract_all("text", F.lit("(?U)" + pattern), F.lit(0)).alias("words"))


def word_slices(words: pa.Array, limit: int = SLICE_BYTES):
    """Slices of a list<string> array: (first row, last row, offsets of the
    rows' words, distinct words, index of each word among them)."""
    offsets = words.offsets.to_numpy().astype(np.int64)
    flat = words.values
    at = np.frombuffer(flat.buffers()[1], np.int64 if pa.types.is_large_string(flat.type) else np.int32)
    at = at[flat.offset:flat.offset + len(flat) + 1].astype(np.int64) if len(flat) else np.zeros(1, np.int64)
    bytes_at = at[offsets]
    first = 0
    while first < len(words):
        last = int(np.searchsorted(bytes_at, bytes_at[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(words))
        part = flat.slice(offsets[first], offsets[last] - offsets[first]).dictionary_encode()
        yield first, last, offsets[first:last + 1] - offsets[first], part.dictionary, part.indices.to_numpy()
        first = last


def spread(lengths: np.ndarray) -> np.ndarray:
    """0..n-1 within each run, for runs of the given lengths."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lengths, lengths)


def gather(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray, picks: np.ndarray) -> np.ndarray:
    """Concatenation of ``values[starts[p]:starts[p] + lengths[p]]`` over picks."""
    n = lengths[picks]
    return values[np.repeat(starts[picks], n) + spread(n)]


def binaries(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """Binary array of the rows of ``values`` (any fixed-width type) between offsets."""
    width = values.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer((offsets * width).astype(np.int32).tobytes()), pa.py_buffer(np.ascontiguousarray(values).tobytes())])
