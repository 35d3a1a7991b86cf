"""Byte-level BPE encoding and decoding by ranked merges.

Texts are split into words by the vocabulary's pattern inside Spark. A task
takes the distinct words of a slice of rows as byte arrays and folds the
ranked merges over all of them at once: each round merges, in every word,
the adjacent pair of lowest rank (the leftmost of equals) until no pair of
any word has a rank. The rank map is read from the vocabulary file by the
driver and travels with the tasks; its size is that of the vocabulary.
Decoding concatenates the binary pieces of the ids.

Cases: a null text counts as empty and gives no ids; repeated rows give
repeated results; rows keep their null doc_id; an empty table gives an
empty result; columns other than doc_id and text play no part. Memory is
bounded by the Arrow batch, or by one text if that is longer.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import binaries, gather, with_words, word_slices

ENCODED = "doc_id long, n_tokens long, ids binary"
DECODED = "doc_id long, n_tokens long, ids binary, decoded binary"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
#: Words of more bytes are merged one by one with a heap.
LONG_WORD = 256
#: Bytes of words merged at once: the merge's tables take some 30 times as much.
SLICE_BYTES = 2 << 20
NONE = np.int64(1 << 40)


class Ranks:
    """Rank map of a vocabulary: byte strings to ranks (= ids), and the rank
    that each adjacent pair of pieces merges to."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        pairs = sorted(((self.ranks[p[:k]] << 32) + self.ranks[p[k:]], r) for p, r in self.ranks.items()
                       for k in range(1, len(p)) if p[:k] in self.ranks and p[k:] in self.ranks)
        self.keys = np.array([k for k, _ in pairs], np.int64)
        self.merged = np.array([r for _, r in pairs], np.int64)
        self.bytes = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        size = max(self.ranks.values()) + 1
        pieces = [b""] * size
        for p, r in self.ranks.items():
            pieces[r] = p
        self.piece_len = np.array([len(p) for p in pieces], np.int64)
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def of_pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << np.int64(32)) + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.merged[at], NONE)

    def fold(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word and how many."""
        out: list = [None] * len(words)
        todo = []
        for i, w in enumerate(words):
            whole = self.ranks.get(w)
            if whole is not None:
                out[i] = (whole,)
            elif len(w) > LONG_WORD:
                out[i] = self._fold_long(w)
            else:
                todo.append(i)
        counts = np.array([0 if x is None else len(x) for x in out], np.int64)
        ids = np.fromiter((y for x in out if x is not None for y in x), np.int64, int(counts.sum()))
        if not todo:
            return ids, counts
        merged, lengths = self._fold_many([words[i] for i in todo])
        todo = np.array(todo)
        owner = np.concatenate([np.repeat(np.arange(len(words)), counts), np.repeat(todo, lengths)])
        counts[todo] = lengths
        return np.concatenate([ids, merged])[np.argsort(owner, kind="stable")], counts

    def _fold_many(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        lengths = np.array([len(w) for w in words], np.int64)
        pieces = self.bytes[np.frombuffer(b"".join(words), np.uint8)]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_owner = [], []
        rank = np.full(len(pieces), NONE)
        near = owner[1:] == owner[:-1]
        rank[:-1][near] = self.of_pairs(pieces[:-1][near], pieces[1:][near])
        while len(pieces):
            starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            least = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.append(starts, len(pieces)))
            live = np.repeat(least < NONE, sizes)
            if not live.all():
                done_ids.append(pieces[~live])
                done_owner.append(owner[~live])
                least = least[least < NONE]
                pieces, owner, rank = pieces[live], owner[live], rank[live]
                if not len(pieces):
                    break
                starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                sizes = np.diff(np.append(starts, len(pieces)))
            hits = np.flatnonzero(rank == np.repeat(least, sizes))
            hits = hits[np.concatenate([[True], owner[hits[1:]] != owner[hits[:-1]]])]  # the leftmost of each word
            pieces[hits] = rank[hits]
            keep = np.ones(len(pieces), bool)
            keep[hits + 1] = False
            at = np.cumsum(keep)[hits] - 1
            pieces, owner, rank = pieces[keep], owner[keep], rank[keep]
            for i in (at, at[at > 0] - 1):  # the pairs on both sides of the new piece
                j = np.minimum(i + 1, len(pieces) - 1)
                same = (i + 1 < len(pieces)) & (owner[i] == owner[j])
                rank[i] = np.where(same, self.of_pairs(pieces[i], pieces[j]), NONE)
        ids = np.concatenate(done_ids) if done_ids else np.zeros(0, np.int64)
        who = np.concatenate(done_owner) if done_owner else np.zeros(0, np.int64)
        return ids[np.argsort(who, kind="stable")], np.bincount(who, minlength=len(words))

    def _fold_long(self, word: bytes) -> list[int]:
        parts: list = [word[i:i + 1] for i in range(len(word))]
        left, right = list(range(-1, len(parts) - 1)), list(range(1, len(parts) + 1))
        heap = [(r, i, 2) for i in range(len(parts) - 1) if (r := self.ranks.get(word[i:i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, size = heapq.heappop(heap)
            j = right[i] if parts[i] is not None else len(parts)
            if j >= len(parts) or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i] += parts[j]
            parts[j] = None
            right[i] = right[j]
            if right[i] < len(parts):
                left[right[i]] = i
            for a in (left[i], i):
                if a >= 0 and right[a] < len(parts):
                    both = parts[a] + parts[right[a]]
                    if (r := self.ranks.get(both)) is not None:
                        heapq.heappush(heap, (r, a, len(both)))
        return [self.ranks[p] for p in parts if p is not None]


@lru_cache(maxsize=2)
def _ranks(path: str) -> Ranks:
    return Ranks(path)


def _encoded(batches, path: str):
    """Batches (doc_id, n_tokens, ids) of batches (doc_id, words), a slice of rows each."""
    ranks = _ranks(path)
    for batch in batches:
        for first, last, offsets, distinct, index in word_slices(batch.column("words"), SLICE_BYTES):
            values, n = ranks.fold([w.encode() for w in distinct.to_pylist()])
            own = np.concatenate([[0], np.cumsum(n[index])])[offsets]
            ids = binaries(gather(values.astype("<u4"), np.cumsum(n) - n, n, index), own)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(np.diff(own), pa.int64()), ids], ["doc_id", "n_tokens", "ids"])


def _decoded(batches, path: str):
    """The batches with what their ids decode to."""
    ranks = _ranks(path)
    for batch in batches:
        decoded = []
        for ids in batch.column("ids"):
            picks = np.frombuffer(ids.as_py(), "<u4")
            decoded.append(gather(ranks.piece_bytes, ranks.piece_at, ranks.piece_len, picks).tobytes())
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_tokens", "ids")), pa.array(decoded, pa.binary())],
                                         ["doc_id", "n_tokens", "ids", "decoded"])


def _digested(batches):
    sha = lambda b: hashlib.sha256(b).hexdigest()
    for batch in batches:
        ids = [sha(" ".join(map(str, np.frombuffer(x.as_py(), "<u4").tolist())).encode()) for x in batch.column("ids")]
        decoded = [sha(x.as_buffer()) for x in batch.column("decoded")]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_tokens"), pa.array(ids, pa.string()), pa.array(decoded, pa.string())],
                                         ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every row; ids are little-endian unsigned
    32-bit integers in one binary value."""
    return with_words(docs, pattern).mapInArrow(lambda batches: _encoded(batches, ranks_path), ENCODED)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with the bytes that its ids stand for."""
    return encoded.mapInArrow(lambda batches: _decoded(batches, ranks_path), DECODED)


def round_trip_digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, SHA-256 of the decimal ids joined by one space, and
    SHA-256 of the bytes they decode to: ``encode`` and ``decode`` slice by
    slice in one Python worker a task, so neither ids nor decoded texts
    travel between workers."""
    return with_words(docs, pattern).mapInArrow(lambda batches: _digested(_decoded(_encoded(batches, ranks_path), ranks_path)), DIGESTS)
