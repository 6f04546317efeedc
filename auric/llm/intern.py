"""Interning of byte spans in numpy: equal spans get one slot of an open-addressed table.

A slot is claimed by the first span whose 64-bit key probes it; later spans
match it only if group, length and all bytes agree, so that no two different
spans ever share a slot.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

#: Fixed values of the 64-bit xxHash: its five primes.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
SHORT = 32
LONG_SPAN = 256
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def padded(data: np.ndarray) -> np.ndarray:
    """The bytes with eight more, so that a lane of eight bytes can be read at every place."""
    return np.concatenate([data, np.zeros(8, np.uint8)])


def lanes(buf: np.ndarray, kind: str) -> np.ndarray:
    """Little-endian numbers at every byte of a padded buffer."""
    wide = np.dtype(kind).itemsize
    return np.ndarray((len(buf) - wide + 1,), kind, buf, 0, (1,))


def joined(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(padded buffer, start, end) of the words with one space after each, so that a run of words is one span."""
    size = end - start + 1
    to = np.cumsum(size) - size
    if len(start) == 0:
        return np.zeros(8, np.uint8), to, to
    at = np.repeat(start - to, size) + np.arange(int(size.sum()))
    buf = padded(data[np.minimum(at, len(data) - 1)])
    buf[to + size - 1] = 32
    return buf, to, to + size - 1


def rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << np.uint64(by)) | (x >> np.uint64(64 - by))


def xxhash64(buf: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int = 0) -> np.ndarray:
    """xxHash64 of each span of a padded buffer: short spans of one length at a time, long ones by the library."""
    out = np.empty(len(start), np.uint64)
    if len(start) == 0:
        return out
    eight, four = lanes(buf, "<u8"), lanes(buf, "<u4")
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for rows in np.split(order, cuts):
        n, at = int(size[rows[0]]), start[rows]
        if n >= SHORT:
            whole = memoryview(buf)
            out[rows] = [xxhash.xxh64_intdigest(whole[a:a + n], seed) for a in at.tolist()]
            continue
        h = np.full(len(rows), (seed + int(P5) + n) & int(ALL), np.uint64)
        done = 0
        while n - done >= 8:
            h = rotated(h ^ (rotated(eight[at + done] * P2, 31) * P1), 27) * P1 + P4
            done += 8
        if n - done >= 4:
            h = rotated(h ^ (four[at + done].astype(np.uint64) * P1), 23) * P2 + P3
            done += 4
        while done < n:
            h = rotated(h ^ (buf[at + done].astype(np.uint64) * P5), 11) * P1
            done += 1
        h = (h ^ (h >> np.uint64(33))) * P2
        h = (h ^ (h >> np.uint64(29))) * P3
        out[rows] = h ^ (h >> np.uint64(32))
    return out


def same_bytes(buf: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans at ``a`` and ``b`` hold the same ``size`` bytes."""
    out = np.ones(len(a), bool)
    eight, done, rows = lanes(buf, "<u8"), 0, np.flatnonzero(a != b)
    while len(rows) and done < LONG_SPAN:
        left = size[rows] - done
        mask = ALL >> (np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64) & np.uint64(63))
        differ = ((eight[a[rows] + done] ^ eight[b[rows] + done]) & np.where(left > 0, mask, np.uint64(0))) != 0
        out[rows[differ]] = False
        rows = rows[~differ & (left > 8)]
        done += 8
    for r in rows.tolist():
        n = int(size[r])
        out[r] = np.array_equal(buf[a[r] + done:a[r] + n], buf[b[r] + done:b[r] + n])
    return out


def intern(buf: np.ndarray, start: np.ndarray, size: np.ndarray, key: np.ndarray, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(slot of each span, holder of each slot or -1): spans of a group share a slot if their bytes are equal."""
    bits = max(4, int(2 * len(start)).bit_length())
    mask = (1 << bits) - 1
    holder = np.full(1 << bits, -1, np.int64)
    slot = (key >> np.uint64(64 - bits)).astype(np.int64)
    todo = np.arange(len(start))
    while len(todo):
        at = slot[todo]
        free = holder[at] < 0
        holder[at[free]] = todo[free]  # of several one stays, the others are compared with it
        by = holder[at]
        match = (key[by] == key[todo]) & (size[by] == size[todo])
        if group is not None:
            match &= group[by] == group[todo]
        some = np.flatnonzero(match)
        match[some] = same_bytes(buf, start[by[some]], start[todo[some]], size[todo[some]])
        todo = todo[~match]
        slot[todo] = (slot[todo] + 1) & mask
    return slot, holder


def strings(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> pa.Array:
    """The spans as an Arrow string array."""
    to = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=to[1:])
    at = np.repeat(start - to[:-1], size) + np.arange(int(to[-1]))
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(to), pa.py_buffer(np.ascontiguousarray(buf[at])))
