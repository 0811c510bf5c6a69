"""64-bit hashes of all words of many texts at once, in numpy passes over their bytes.

A word is a run of bytes other than 09-0D and 20, with A-Z in lower case. Its hash is a polynomial of
random values of its bytes, mixed at the end, so no dictionary of words is kept in memory."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_M1, _M2 = _U(0xFF51AFD7ED558CCD), _U(0xC4CEB9FE1A85EC53)
#: Bytes that one pass covers (a longer word makes a longer pass), and the length of the table of powers.
PASS, POWERS = 1 << 16, 1 << 16


def draws(n: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers."""
    return np.random.default_rng(seed).integers(1, 2**63, n, np.uint64) * _U(2) + _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(33))) * _M1
    x = (x ^ (x >> _U(33))) * _M2
    return x ^ (x >> _U(33))


_BYTE = draws(256, 41)
_BYTE[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWER = np.cumprod(np.full(POWERS, draws(1, 42)[0]))


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start .. start + size - 1 of all, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def hashes_of(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A hash of each stretch of bytes (none empty), A-Z in lower case."""
    if not len(starts):
        return np.empty(0, _U)
    at = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
    value = _BYTE[data[place + np.repeat(starts, sizes)]]
    if place.max() >= POWERS:
        value = value ^ mixed((place >> 16).astype(_U))
    return mixed(np.add.reduceat(value * _POWER[place & (POWERS - 1)], at) + sizes.astype(_U))


def _hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each word's first byte and hash."""
    edge = np.flatnonzero(np.diff(~_SPACE[data], prepend=False, append=False))
    return edge[::2], hashes_of(data, edge[::2], edge[1::2] - edge[::2])


_ODD_WHITE = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def odd_white(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to white space beyond ASCII."""
    found = np.zeros(len(data), bool)
    for first in (0xC2, 0xE1, 0xE2, 0xE3):
        at = np.flatnonzero(data == first)
        for code in _ODD_WHITE:
            if len(at) and code[0] == first:
                hit = at
                for i in range(1, len(code)):
                    hit = hit[data[hit + i] == code[i]]
                for i in range(len(code)):
                    found[hit + i] = True
    return found


def _passes(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Parts of about PASS bytes that end between words."""
    low = 0
    while low < len(data):
        high = low + PASS
        while high < len(data):
            gap = np.flatnonzero(_SPACE[data[high : high + 4096]])
            if len(gap):
                high += int(gap[0])
                break
            high += 4096
        yield low, data[low:high]
        low = high


def word_hashes(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, end to end, and how many each text has."""
    parts = [t.encode() for t in docs]
    ends = np.cumsum([len(p) + 1 for p in parts])
    data = np.frombuffer(b" ".join(parts), np.uint8)
    starts, found = [], []
    for low, part in _passes(data):
        s, h = _hashed(part)
        starts.append(s + low)
        found.append(h)
    if not found:
        return np.empty(0, _U), np.zeros(len(docs), np.int64)
    until = np.searchsorted(np.concatenate(starts), ends)
    return np.concatenate(found), np.diff(until, prepend=0)


def grouped(docs: list[str], rows: int = 500, chars: int = 1 << 20) -> Iterator[list[str]]:
    """The texts in runs of at most `rows` texts and about `chars` characters, so that no run is large in memory."""
    run, size = [], 0
    for t in docs:
        run.append(t)
        size += len(t)
        if len(run) >= rows or size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run
