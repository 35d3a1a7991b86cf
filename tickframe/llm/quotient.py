"""Counting quotient filters of packed n-grams.

An n-gram is ``n`` word ids of ``bits`` bits each. ``permute`` maps it to
another number of the same ``n * bits`` bits and back again (a Feistel
network over the ids), so that its leading bits are spread evenly. The
leading bits are the quotient, all other bits the remainder; as the
remainder is kept whole, a filter loses nothing and its counts are exact.

A filter is kept in the order of its permuted n-grams: the quotients as one
bit per possible quotient (is it occupied?) and one bit per entry (does its
run end here?), the remainders as whole bytes, the counts as variable-length
bytes (one byte below 128). Two filters of the same n-grams have the same
order, so they are merged like sorted runs.

Numbers of more than 64 bits are lists of ``uint64`` columns, the first
column with the leading bits. Nothing here knows about Spark.
"""

from __future__ import annotations

import numpy as np

from .shingles import mix

_U = np.uint64
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


def _turn(ids: list[np.ndarray], bits: int, sweep: int, i: int) -> None:
    others = np.full(len(ids[0]), (sweep * 64 + i + 1) * _ODD[0] & 0xFFFFFFFFFFFFFFFF, _U)
    for j, other in enumerate(ids):
        if j != i:
            others += other * _U(_ODD[(j + 1) % len(_ODD)])
            others ^= others >> _U(29)
    ids[i] = ids[i] ^ (mix(others) >> _U(64 - bits))


def permute(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Each id in turn, last to first, is xored with a hash of the others; two sweeps."""
    ids = list(ids)
    for sweep in range(2):
        for i in reversed(range(len(ids))):
            _turn(ids, bits, sweep, i)
    return ids


def restore(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """The inverse of ``permute``."""
    ids = list(ids)
    for sweep in reversed(range(2)):
        for i in range(len(ids)):
            _turn(ids, bits, sweep, i)
    return ids


def pack(ids: list[np.ndarray], bits: int) -> list[np.ndarray]:
    """Columns that hold the ids one after another, from the leading bit on."""
    columns = [np.zeros(len(ids[0]), _U) for _ in range((len(ids) * bits + 63) // 64)]
    for i, one in enumerate(ids):
        c, room = i * bits // 64, 64 - i * bits % 64 - bits
        if room >= 0:
            columns[c] |= one << _U(room)
        else:
            columns[c] |= one >> _U(-room)
            columns[c + 1] |= one << _U(64 + room)
    return columns


def unpack(columns: list[np.ndarray], n: int, bits: int) -> list[np.ndarray]:
    out, full = [], _U((1 << bits) - 1)
    for i in range(n):
        c, room = i * bits // 64, 64 - i * bits % 64 - bits
        if room >= 0:
            out.append(columns[c] >> _U(room) & full)
        else:
            out.append((columns[c] << _U(-room) | columns[c + 1] >> _U(64 + room)) & full)
    return out


def _left(columns: list[np.ndarray], k: int) -> list[np.ndarray]:
    """The columns without their ``k`` (below 64) leading bits."""
    if k == 0:
        return list(columns)
    after = [*columns[1:], np.zeros_like(columns[0])]
    return [a << _U(k) | b >> _U(64 - k) for a, b in zip(columns, after, strict=True)]


def _right(columns: list[np.ndarray], k: int) -> list[np.ndarray]:
    if k == 0:
        return list(columns)
    before = [np.zeros_like(columns[0]), *columns[:-1]]
    return [a >> _U(k) | b << _U(64 - k) for a, b in zip(columns, before, strict=True)]


def count(columns: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct n-grams in ascending order, and how often each occurs.
    Sorted runs in the input are merged as such (a stable sort)."""
    if len(columns[0]) == 0:
        return columns, np.zeros(0, np.int64)
    if len(columns) == 1 and counts is None:
        columns = [np.sort(columns[0])]
    else:
        order = np.argsort(columns[0], kind="stable")
        ordered = [c[order] for c in columns]
        if len(columns) > 1:
            same = ordered[0][1:] == ordered[0][:-1]
            if any((same & (c[1:] != c[:-1])).any() for c in ordered[1:]):
                order = np.lexsort(columns[::-1])
                ordered = [c[order] for c in columns]
        columns, counts = ordered, None if counts is None else counts[order]
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = columns[0][1:] != columns[0][:-1]
    for c in columns[1:]:
        fresh[1:] |= c[1:] != c[:-1]
    at = np.flatnonzero(fresh)
    total = np.diff(np.append(at, len(fresh))) if counts is None else np.add.reduceat(counts, at)
    return [c[at] for c in columns], total.astype(np.int64)


def parts_of(columns: list[np.ndarray], part_bits: int) -> np.ndarray:
    """The leading ``part_bits`` (below 64) of each n-gram."""
    return columns[0] >> _U(64 - part_bits) if part_bits else np.zeros(len(columns[0]), _U)


def _counters(counts: np.ndarray) -> bytes:
    size = np.ones(len(counts), np.int64)
    for k in range(1, 9):
        size += counts >= 1 << 7 * k
    starts, out = np.cumsum(size) - size, np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max())):
        has = size > k
        out[starts[has] + k] = (counts[has] >> 7 * k & 127) | np.where(size[has] > k + 1, 128, 0)
    return out.tobytes()


def _read_counters(raw: bytes) -> np.ndarray:
    values = np.frombuffer(raw, np.uint8)
    starts = np.flatnonzero(np.concatenate([[True], values[:-1] < 128]))
    place = np.arange(len(values)) - np.repeat(starts, np.diff(np.append(starts, len(values))))
    return np.add.reduceat((values & 127).astype(np.int64) << 7 * place, starts)


def write(columns: list[np.ndarray], counts: np.ndarray, width: int, part: int, part_bits: int) -> bytes:
    """The filter of ascending distinct n-grams of ``width`` bits that share
    their leading ``part_bits``, which are not stored."""
    n = len(counts)
    q = max(min(n.bit_length() - 1, width - part_bits, 40), 0)
    quotients = parts_of(_left(columns, part_bits), q).astype(np.int64)
    occupied, ends = np.zeros(1 << q, np.uint8), np.ones(n, np.uint8)
    occupied[quotients] = 1
    ends[:-1] = quotients[1:] != quotients[:-1]
    keep = (width - part_bits - q + 7) // 8
    rest = np.stack(_left(_left(columns, part_bits), q), 1).astype(">u8").view(np.uint8).reshape(n, -1)[:, :keep]
    head = np.array([n, q, width], "<i8").tobytes()
    return head + np.packbits(occupied).tobytes() + np.packbits(ends).tobytes() + np.ascontiguousarray(rest).tobytes() + _counters(counts)


def read(raw: bytes, part: int, part_bits: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The inverse of ``write``."""
    n, q, width = (int(x) for x in np.frombuffer(raw, "<i8", 3))
    at = 24
    occupied = np.unpackbits(np.frombuffer(raw, np.uint8, ((1 << q) + 7) // 8, at), count=1 << q)
    at += ((1 << q) + 7) // 8
    ends = np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, at), count=n)
    at += (n + 7) // 8
    run = np.cumsum(ends, dtype=np.int64) - ends
    quotients = np.flatnonzero(occupied)[run].astype(_U)
    keep, wide = (width - part_bits - q + 7) // 8, (width + 63) // 64
    rest = np.zeros((n, 8 * wide), np.uint8)
    rest[:, :keep] = np.frombuffer(raw, np.uint8, n * keep, at).reshape(n, keep)
    rest = rest.view(">u8").astype(_U)
    columns = _right([np.ascontiguousarray(rest[:, c]) for c in range(wide)], q)
    if q:
        columns[0] |= quotients << _U(64 - q)
    columns = _right(columns, part_bits)
    if part_bits:
        columns[0] |= _U(part) << _U(64 - part_bits)
    return columns, _read_counters(raw[at + n * keep:])
