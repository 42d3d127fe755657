"""Vectorised word and shingle hashing over Arrow string columns.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z, on UTF-8 bytes.  A word's
64-bit hash is a polynomial over its bytes, read off prefix sums, then mixed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEP = np.zeros(256, bool)
_SEP[[0x20, 9, 10, 11, 12, 13]] = True
_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_LOW_CODE = _LOW.astype(np.uint64) + np.uint64(1)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, CHUNK + 1)
        _powers[:] = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, x, np.uint64)])) for x in (_BASE, _INVERSE)]
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def _hash_piece(raw: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start positions of the words of one piece; fresh marks the first byte of each document."""
    inside = ~_SEP[raw]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | fresh))
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:] & ~fresh[1:]
    ends = np.flatnonzero(inside & ~after) + 1
    power, inverse = _power_tables(len(raw) + 1)
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_LOW_CODE[raw] * power[: len(raw)], out=sums[1:])
    h = (sums[ends] - sums[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64)), starts


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and each document's first position among them (n + 1 entries).

    Works in pieces of about CHUNK bytes; a longer document is cut at separators.
    """
    n = len(offsets) - 1
    hashes, counts = [], np.zeros(n, np.int64)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        lo, hi = int(offsets[i]), int(offsets[j])
        if hi - lo <= CHUNK or j > i + 1:
            if hi > lo:
                fresh = np.zeros(hi - lo, bool)
                at = offsets[i:j] - lo
                fresh[at[at < hi - lo]] = True
                h, starts = _hash_piece(raw[lo:hi], fresh)
                hashes.append(h)
                owner = np.searchsorted(offsets[i : j + 1] - lo, starts, "right") - 1
                counts[i:j] += np.bincount(owner, minlength=j - i)
        else:
            while lo < hi:
                end = min(lo + CHUNK, hi)
                while end < hi:
                    cuts = np.flatnonzero(_SEP[raw[lo:end]])
                    if len(cuts):
                        end = lo + int(cuts[-1]) + 1
                        break
                    end = min(end + CHUNK, hi)
                h, _ = _hash_piece(raw[lo:end], np.zeros(end - lo, bool))
                hashes.append(h)
                counts[i] += len(h)
                lo = end
        i = j
    first = np.concatenate([[0], np.cumsum(counts)])
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), first


def shingle_sets(words: np.ndarray, first: np.ndarray, size: int = 5):
    """For each document its sorted distinct shingle hashes; fewer words than size make one shingle, none an empty set."""
    factor = np.uint64(0xD6E8FEB86659FD93)
    rolled = np.zeros(0, np.uint64)
    if len(words) >= size:
        m = len(words) - size + 1
        rolled = words[:m].copy()
        for k in range(1, size):
            rolled = rolled * factor + words[k : k + m]
        rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(rolled[a : b - size + 1])
        elif b > a:
            h = words[a : a + 1].copy()
            for k in range(a + 1, b):
                h = h * factor + words[k : k + 1]
            yield mix(h + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)
