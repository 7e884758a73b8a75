"""Sets of word shingles of many texts at once, by array operations on their bytes.

Words are ``[^\\x20\\x09-\\x0D]+`` after A-Z is lower-cased.  A word's hash is a polynomial of its bytes modulo
2^64: the difference of two running sums over the text, shifted to the word's own first power.  A shingle's hash is
a sum of its words' hashes, each with a multiplier for its place, mixed."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

from quern.llm.common import Texts
from quern.llm.near_dedup import _mix

#: Bytes that are hashed at once; longer texts go piece by piece.
PIECE = 1 << 20

_RANDOM = np.random.default_rng(23)
_BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0xD1342543DE82EF95
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_BASE, PIECE), _powers(pow(_BASE, -1, 1 << 64), PIECE + 1)


def _piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first bytes of the words of up to ``PIECE`` bytes."""
    raw = np.frombuffer(data.lower(), np.uint8)
    edges = np.flatnonzero(np.diff(_SPACE[raw], prepend=True, append=True))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _UP[:len(raw)], out=sums[1:])
    starts, ends = edges[::2], edges[1::2]
    return (sums[ends] - sums[starts]) * _DOWN[starts], starts


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of one text of any length."""
    if len(text) <= PIECE:
        return _piece(text)[0]
    found, at = [], 0
    while at < len(text):
        part = text[at:at + PIECE]
        if at + len(part) < len(text):
            blanks = np.flatnonzero(_SPACE[np.frombuffer(part, np.uint8)])
            if len(blanks):
                part = part[:blanks[-1] + 1]
            else:  # a word longer than a piece: its polynomial, piece by piece
                total, power = 0, 1
                while True:
                    part = text[at:at + PIECE]
                    blank = np.flatnonzero(_SPACE[np.frombuffer(part, np.uint8)])
                    part = part[:blank[0]] if len(blank) else part
                    if part:
                        total = (total + int(_piece(part)[0][0]) * power) % (1 << 64)
                    power, at = power * pow(_BASE, len(part), 1 << 64) % (1 << 64), at + len(part)
                    if len(blank) or at >= len(text):
                        break
                found.append(np.array([total], np.uint64))
                continue
        found.append(_piece(part)[0])
        at += len(part)
    return np.concatenate(found)


def _of_words(words: np.ndarray, n: int, count: int) -> np.ndarray:
    out = np.full(count, n, np.uint64)
    for k in range(n):
        out += words[k:k + count] * _PLACE[k]
    return _mix(out)


def _together(texts: Texts) -> Iterator[list[bytes]]:
    some, size = [], 0
    for t in texts:
        t = t or b""
        if some and size + len(t) + 1 > PIECE:
            yield some
            some, size = [], 0
        some.append(t)
        size += len(t) + 1
    if some:
        yield some


def shingle_lists(texts: Texts, size: int) -> Iterable[np.ndarray]:
    """For each text the hashes of its shingles of ``size`` words, in order, repeats included; a text of fewer words,
    but not none, has one of all its words."""
    for some in _together(texts):
        if len(some) == 1:
            words = [word_hashes(some[0])]
            bounds = np.array([0, len(words[0])])
            flat = words[0]
        else:
            flat, starts = _piece(b"\n".join(some))
            sizes = np.fromiter((len(t) + 1 for t in some), np.int64, len(some))
            bounds = np.concatenate([np.searchsorted(starts, np.cumsum(sizes) - sizes), [len(starts)]])
        whole = _of_words(flat, size, max(0, len(flat) - size + 1))
        for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            n = end - start
            yield whole[start:end - size + 1] if n >= size else _of_words(flat[start:end], n, 1) if n else flat[:0]


def shingle_sets(texts: Texts, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    return [np.unique(found) for found in shingle_lists(texts, size)]
