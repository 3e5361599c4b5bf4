"""Vectorised helpers over the bytes of many texts at once (NumPy, inside tasks).

Texts arrive as Arrow binary columns (UTF-8 bytes, never decoded) and are walked in
blocks of bounded size. Words have 64-bit hashes, made of multiply-and-mix steps over
8-byte lanes and, for long words, by xxhash. A hash only proposes that words are equal:
where that decides a result, `span_codes` and `same_spans` compare their bytes, and words
that share a hash by chance or by design get codes of their own. A null text counts as
empty. A block takes about eight bytes of working memory a byte of text, also when the
block is one single word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash

#: A word is a run of bytes outside \x20 and \x09-\x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True

#: Only A-Z are folded.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)

BLOCK_BYTES = 2 << 20
#: Spans of more bytes are hashed whole by xxhash and compared one by one.
LONG = 64

_ODD = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F,
                 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser, so that every bit of a hash depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def binary(column: pa.Array) -> pa.Array:
    """The column as one 64-bit-offset binary array without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_binary()).fill_null(b"")


def blocks(column: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of consecutive rows with about max_bytes of text
    (one row at least, however long it is)."""
    arr = binary(column)
    if not len(arr):
        return
    offs = np.frombuffer(arr.buffers()[1], dtype=np.int64)[arr.offset:arr.offset + len(arr) + 1]
    data = arr.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(arr):
        to = int(np.searchsorted(offs, offs[at] + max_bytes, side="right")) - 1
        to = min(max(to, at + 1), len(arr))
        yield at, raw[offs[at]:offs[to]], offs[at:to + 1] - offs[at]
        at = to


@dataclass
class Words:
    """Words of a block of texts, in order; text i owns words first[i]:first[i + 1]. Their
    bytes are folded[start:end]."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    folded: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def codes(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of each word, 0 .. distinct - 1; place of a word with each number)."""
        return span_codes(self.folded, self.starts, self.ends, self.hashes)


def factorize(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct values, place of each value among them), in order of first appearance."""
    codes, distinct = pd.factorize(values)
    return distinct, codes


def spans(inside: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true cells; no run crosses a text's border."""
    borders = offs[:-1][np.diff(offs) > 0]
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[borders] = inside[borders]
    end = inside.copy()
    end[:-1] &= ~inside[1:]
    before = borders[1:] - 1
    end[before] = inside[before]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


#: Masks that keep the first n bytes of a little-endian lane.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)


def _lanes(buf: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number (zeros beyond the end)."""
    padded = np.zeros(len(buf) + 8, np.uint8)
    padded[:len(buf)] = buf
    return np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of non-empty byte spans."""
    size = ends - starts
    out = mix(size.astype(np.uint64) * _ODD[0] + _ODD[1])
    lanes, at = _lanes(buf), 0
    alive = np.flatnonzero(size <= LONG)
    while len(alive):
        left = size[alive] - at
        out[alive] = mix((out[alive] ^ (lanes[starts[alive] + at] & _MASK[np.minimum(left, 8)])) * _ODD[2])
        alive = alive[left > 8]
        at += 8
    for i in np.flatnonzero(size > LONG):
        out[i] = xxhash.xxh3_64_intdigest(buf[starts[i]:ends[i]])
    return out


def same_spans(a: np.ndarray, a_starts: np.ndarray, a_ends: np.ndarray,
               b: np.ndarray, b_starts: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """Whether the i-th span of a and the i-th span of b hold the same bytes."""
    size = a_ends - a_starts
    ok = size == b_ends - b_starts
    a_lanes = _lanes(a)
    b_lanes = a_lanes if b is a else _lanes(b)
    alive, at = np.flatnonzero(ok & (size <= LONG)), 0
    while len(alive):
        left = size[alive] - at
        differ = a_lanes[a_starts[alive] + at] ^ b_lanes[b_starts[alive] + at]
        same = (differ & _MASK[np.minimum(left, 8)]) == 0
        ok[alive[~same]] = False
        alive = alive[same & (left > 8)]
        at += 8
    for i in np.flatnonzero(ok & (size > LONG)):
        ok[i] = np.array_equal(a[a_starts[i]:a_ends[i]], b[b_starts[i]:b_ends[i]])
    return ok


def span_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each span, place of a span with each number): spans have one number
    exactly if their bytes are equal, whatever their hashes."""
    codes, distinct = pd.factorize(hashes)
    first = np.zeros(len(distinct), np.int64)
    first[codes[::-1]] = np.arange(len(codes) - 1, -1, -1)
    again = np.flatnonzero(first[codes] != np.arange(len(codes)))
    other = first[codes[again]]
    differ = again[~same_spans(buf, starts[again], ends[again], buf, starts[other], ends[other])] if len(again) else again
    if len(differ):
        apart: dict[bytes, int] = {}
        places = []
        for i in differ:
            data = buf[starts[i]:ends[i]].tobytes()
            if data not in apart:
                apart[data] = len(distinct) + len(apart)
                places.append(i)
            codes[i] = apart[data]
        first = np.concatenate((first, np.array(places, np.int64)))
    return codes, first


def words(buf: np.ndarray, offs: np.ndarray, apart: np.ndarray = SPACE, fold: np.ndarray = LOWER) -> Words:
    """Words of each text of a block: runs of bytes for which apart is false."""
    if not len(buf):
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(len(offs), np.int64), np.zeros(0, np.uint64), buf)
    starts, ends = spans(~apart[buf], offs)
    folded = buf if fold is AS_IS else fold[buf]
    return Words(starts, ends, np.searchsorted(starts, offs), hash_spans(folded, starts, ends), folded)


def gram(parts: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of word hashes, element-wise; order and length count."""
    out = np.full(len(parts[0]), (len(parts) * int(_ODD[5])) & (2**64 - 1), dtype=np.uint64)
    for part in parts:
        out = mix((out ^ part) * _ODD[2])
    return out


def window_codes(codes: np.ndarray, width: int) -> np.ndarray:
    """Number of each window of `width` codes: equal exactly if the windows are equal."""
    n = len(codes) - width + 1
    out, many = codes[:n].astype(np.int64), int(codes.max()) + 1
    for k in range(1, width):
        out = pd.factorize(out * many + codes[k:n + k])[0]
    return out


@dataclass
class Shingles:
    """A text's set of shingles: its windows of `width` words, or its whole sequence if it
    has fewer words; none without words."""

    keys: np.ndarray        # sorted distinct hashes
    at: np.ndarray          # first word of a window with each hash
    width: int              # words of a window of this text
    size: int               # distinct windows by their words


def shingles(hashes: np.ndarray, codes: np.ndarray, width: int) -> Shingles:
    """The shingles of a text from its words' hashes and codes. Windows that share a hash are
    compared by their codes, so the size is exact."""
    width = min(width, len(hashes))
    if not width:
        return Shingles(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, 0)
    n = len(hashes) - width + 1
    windows = gram([hashes[k:n + k] for k in range(width)])
    keys, at, back = np.unique(windows, return_index=True, return_inverse=True)
    size = len(keys)
    if size < n:
        first = at[back]
        again = np.flatnonzero(first != np.arange(n))
        other = first[again]
        if any((codes[again + k] != codes[other + k]).any() for k in range(width)):
            size = int(window_codes(codes, width).max()) + 1
    return Shingles(keys, at, width, size)
