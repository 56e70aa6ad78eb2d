"""Vectorised kernels over UTF-8 buffers: word bounds, word hashes, shingles.

All kernels work on whole Arrow columns cut into slices of whole texts, so memory is bounded by the slice
or by the longest single text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: True for bytes of words `[^\x20\x09-\x0D]+`.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: True for bytes of lower-cased words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
LETTER_DIGIT = np.zeros(256, bool)
LETTER_DIGIT[0x30:0x3A] = LETTER_DIGIT[0x61:0x7B] = LETTER_DIGIT[0x80:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64."""
    x = x.astype(_U, copy=True)
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


BYTE_CODE = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))

_power = np.ones(1, _U)
_inverse = np.ones(1, _U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n at least."""
    global _power, _inverse
    if len(_power) < n:
        n = max(n, 2 * SLICE_BYTES)
        steps = np.full(n, _BASE, _U), np.full(n, _INVERSE, _U)
        for s in steps:
            s[0] = 1
        _power, _inverse = (np.multiply.accumulate(s) for s in steps)
    return _power, _inverse


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    column = column.cast(pa.large_binary())
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about most bytes; a longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_bounds(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end byte of each word; words do not cross texts. data is lower-cased as kind needs it."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = kind[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < n)]
    first[cuts] |= inside[cuts]
    last[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Running sums whose differences are polynomial hashes of spans."""
    power, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, _U)
    np.cumsum(BYTE_CODE[data] * power[: len(data)], out=out[1:])
    return out


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of spans, the same wherever a span stands."""
    _, inverse = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(_U) * _U(0xD6E8FEB86659FD93))


#: Bytes up to which a word is hashed in lanes of eight; longer words are rare and hashed one by one.
_LANES_END = 64


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hashes of words: lanes of eight bytes, each mixed into the hash of those before it.

    Unlike sums of powers, mixing leaves no pairs of words that are known to share a hash. Each seed is a hash of its own.
    """
    if not len(starts):
        return np.zeros(0, _U)
    filled = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes = np.ndarray((len(data) + 1,), "<u8", filled, strides=(1,))
    size = ends - starts
    out = mix(_lane(lanes, starts, size) ^ size.astype(_U) * _U(0xD6E8FEB86659FD93) ^ _U(seed))
    more = np.flatnonzero((size > 8) & (size <= _LANES_END))
    at = 8
    while len(more):
        own = _lane(lanes, starts[more] + at, size[more] - at)
        out[more] = mix(out[more] * _U(0x9FB21C651E98DF25 + 2 * seed) ^ own)
        at += 8
        more = more[size[more] > at]
    for i in np.flatnonzero(size > _LANES_END).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=seed.to_bytes(8, "little")).digest(), "little")
    return out


def _lane(lanes: np.ndarray, at: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Eight bytes from each place on, those behind the word's end as zeros."""
    shift = (np.maximum(8 - left, 0) * 8).astype(_U)
    return lanes[at].astype(_U) << shift


def words_of(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per word its first byte, end, hash; per text the index of its first word (and the end)."""
    low = LOWER[data]
    starts, ends = word_bounds(low, offsets, kind)
    return starts, ends, word_hashes(low, starts, ends), np.searchsorted(starts, offsets)


def shingle_sets(hashes: np.ndarray, bounds: np.ndarray, k: int) -> list[np.ndarray]:
    """The sorted distinct k-word shingles of each text; fewer words make one shingle, none make none."""
    n = len(hashes)
    acc = hashes.copy() if n else hashes
    for i in range(1, k):
        acc = acc * _U(0x9FB21C651E98DF25) + _U(i)
        if n > i:
            acc[: n - i] += hashes[i:]
    acc = mix(acc) if n else acc
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= k:
            s = acc[a : b - k + 1].copy()
            s.sort()
            keep = np.ones(len(s), bool)
            keep[1:] = s[1:] != s[:-1]
            out.append(s[keep])
        elif b > a:
            h = np.full(1, b - a, _U)
            for i in range(a, b):
                h = mix(h * _U(0x9FB21C651E98DF25) + hashes[i : i + 1])
            out.append(h)
        else:
            out.append(np.zeros(0, _U))
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Unions of overlapping or touching spans, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
