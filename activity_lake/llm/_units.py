"""Tokenizer units: the pieces of a text that the public word-level BPE encodes on their own.

The tokenizer cuts special tokens out, composes (NFC), lower-cases, drops white space and
cuts the rest into letter runs, single digits and runs of other characters, with English
contractions apart; then each such piece is merged alone. No piece spans ASCII white
space, so a text's ids are those of its words in order. Words made only of ASCII letters,
digits and punctuation and of the precomposed Latin-1 letters are cut here, many at once;
a word with an apostrophe, a control character, "<|" or any other non-ASCII character is
one unit and goes through the tokenizer's own normalizer and pre-tokenizer.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from . import _text as X

#: Distinct units and their bytes that a worker keeps; beyond them it starts afresh (results
#: don't change).
CACHE_UNITS = 250_000
CACHE_BYTES = 16 << 20

_SPACE, _LETTER, _DIGIT, _OTHER, _HARD = range(5)
_CLASS = np.full(256, _HARD, np.uint8)
_CLASS[33:127] = _OTHER
_CLASS[48:58] = _DIGIT
_CLASS[65:91] = _CLASS[97:123] = _LETTER
_CLASS[ord("'")] = _HARD
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE


def units(buf: np.ndarray, offs: np.ndarray):
    """(starts, ends, hard, first, folded bytes) of the units of a block of texts."""
    cls = _CLASS[buf]
    folded = X.LOWER[buf]
    last = np.zeros(len(buf) + 1, bool)
    last[offs[1:] - 1] = True  # a text's last byte has no next one
    lead = np.flatnonzero(buf == 0xC3)
    lead = lead[~last[lead]]
    nxt = buf[lead + 1]
    ok = (nxt >= 0x80) & (nxt <= 0xBF) & (nxt != 0x97) & (nxt != 0xB7)
    lead, nxt = lead[ok], nxt[ok]
    cls[lead] = cls[lead + 1] = _LETTER
    folded[lead[nxt <= 0x9E] + 1] += 0x20
    angle = np.flatnonzero(buf == ord("<"))
    angle = angle[~last[angle]]
    cls[angle[buf[angle + 1] == ord("|")]] = _HARD
    starts, ends = X.spans(cls != _SPACE, offs)
    if not len(starts):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, bool), np.zeros(len(offs), np.int64), folded
    hard_word = np.unique(np.searchsorted(starts, np.flatnonzero(cls == _HARD), side="right") - 1)
    for s, e in zip(starts[hard_word].tolist(), ends[hard_word].tolist()):
        cls[s:e] = _HARD
        folded[s:e] = buf[s:e]
    begin = np.zeros(len(buf) + 1, bool)
    begin[1:-1] = (cls[1:] != cls[:-1]) | (cls[1:] == _DIGIT)
    begin[:-1] &= cls != _SPACE
    begin[starts] = True
    cut = np.flatnonzero(begin)
    stop = np.empty_like(cut)
    stop[:-1] = cut[1:]
    word = np.searchsorted(starts, cut, side="right") - 1
    stop[-1] = ends[-1]
    stop = np.minimum(stop, ends[word])
    return cut, stop, cls[cut] == _HARD, np.searchsorted(cut, offs), folded


class UnitEncoder:
    """Ids of whole texts from ids of distinct units, each encoded once a worker.

    `encode` gets simple units (lower-cased bytes) and hard units (raw bytes) and returns
    a list of id lists for each. Known units are found by their bytes, never by a hash; a
    simple and a hard unit never have the same bytes, as only a hard one holds a byte or
    pair that makes it hard."""

    def __init__(self, encode: Callable[[list[bytes], bool], list[list[int]]], limit: int = CACHE_UNITS):
        self._encode, self._limit = encode, limit
        self._clear()

    def _clear(self) -> None:
        self._places: dict[bytes, int] = {}
        self._bytes = 0
        self._at = np.zeros(0, np.int64)
        self._len = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _learn(self, spans: list[bytes], hard: np.ndarray) -> None:
        ids: list[list[int]] = [[]] * len(spans)
        for kind in (False, True):
            at = np.flatnonzero(hard == kind)
            if len(at):
                for i, x in zip(at, self._encode([spans[i] for i in at], kind)):
                    ids[i] = x
        lens = np.array([len(x) for x in ids], np.int64)
        flat = np.array([x for y in ids for x in y], np.uint32)
        start = len(self._ids) + np.concatenate(([0], np.cumsum(lens)[:-1]))
        self._ids = np.concatenate((self._ids, flat))
        self._places.update(zip(spans, range(len(self._at), len(self._at) + len(spans))))
        self._bytes += sum(map(len, spans))
        self._at = np.concatenate((self._at, start))
        self._len = np.concatenate((self._len, lens))

    def block(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, border of each text's ids)."""
        starts, ends, hard, first, folded = units(buf, offs)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        code, at = X.span_codes(folded, starts, ends, X.hash_spans(folded, starts, ends))
        if len(self._places) > self._limit or self._bytes > CACHE_BYTES:
            self._clear()
        data = folded.tobytes()
        spans = [data[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist())]
        new = [i for i, s in enumerate(spans) if s not in self._places]
        if new:
            self._learn([spans[i] for i in new], hard[at[new]])
        place = np.fromiter(map(self._places.__getitem__, spans), np.int64, len(spans))[code]
        begin, lens = self._at[place], self._len[place]
        stop = np.cumsum(lens)
        ids = self._ids[np.repeat(begin - (stop - lens), lens) + np.arange(int(stop[-1]))]
        return ids, np.concatenate(([0], stop))[first]
