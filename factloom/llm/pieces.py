"""Pre-token handling for byte-level vocabularies: cut texts into pieces, remember what each gave.

Texts are cut in numpy passes over their bytes, at places where the vocabulary's pattern cuts whatever
else the text holds: around runs of white space, and between ASCII letters, digits and marks. A piece
between two cuts gives the same tokens alone as in its text, so it is encoded once, and every further
occurrence is answered by a hash table that compares the bytes. What cannot be told from bytes alone
(apostrophes, letters of most other scripts, white space beyond ASCII) is left inside a piece."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Sequence
from typing import Any

import numpy as np

from .words import draws, mixed, odd_white, spread

#: Fixed value: the pattern whose cuts are known here.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_OTHER, _LETTER, _DIGIT, _MARK, _BLANK, _WHITE, _ODD, _END = range(8)
_CLASS = np.zeros(256, np.uint8)
for _c in range(33, 127):
    _CLASS[_c] = _LETTER if chr(_c).isalpha() else _DIGIT if chr(_c).isdigit() else _MARK
_CLASS[ord("'")] = _OTHER
_CLASS[9:14] = _WHITE
_CLASS[32] = _BLANK
_CLASS[255] = _END  # no byte of UTF-8: it stands between texts
_U = np.uint64
_BYTE, _POWER = draws(256, 51), np.cumprod(np.full(1 << 12, draws(1, 52)[0]))


def _classes(data: np.ndarray) -> np.ndarray:
    kinds = _CLASS[data]
    high = np.flatnonzero(data == 0xC3)  # most letters of western scripts; its 97 and B7 are marks
    high = high[(data[high + 1] != 0x97) & (data[high + 1] != 0xB7)]
    kinds[high] = kinds[high + 1] = _LETTER
    kinds[odd_white(data)] = _ODD
    return kinds


def cuts(data: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts that stand end to end, an FF byte after each (a piece of its own)."""
    kinds = _classes(data)
    n = len(data)
    cut = np.zeros(n, bool)
    cut[0] = True
    known = (kinds >= _LETTER) & (kinds <= _MARK)
    cut[1:] = known[1:] & known[:-1] & (kinds[1:] != kinds[:-1])
    end = np.flatnonzero(kinds == _END)
    cut[end] = True
    cut[end[:-1] + 1] = True
    white = (kinds >= _BLANK) & (kinds <= _ODD)
    edge = np.flatnonzero(np.diff(white, prepend=False, append=False))
    low, high = edge[::2], edge[1::2]  # each run of white space, without and with what follows
    if len(low):
        cut[low] = True
        sure = kinds[high] != _END  # the last text's end follows, so high < n
        if (odd := kinds == _ODD).any():
            seen = np.concatenate([[0], np.cumsum(odd)])
            sure &= seen[high] == seen[low]
        last = high[sure] - 1
        cut[last] = True  # but for one character, the run is a piece
        cut[last[kinds[last] == _WHITE] + 1] = True  # a blank goes with what follows it
    return np.flatnonzero(cut)


class Slots:
    """A hash table in numpy arrays: 64-bit keys to numbers of 0 or more."""

    def __init__(self, bits: int):
        self.bits, self.probes = bits, 0
        self.keys, self.values = np.zeros(1 << bits, np.int64), np.full(1 << bits, -1, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mixed(keys.view(_U)) >> _U(64 - self.bits)).astype(np.int64)

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Distinct keys that are not in the table."""
        slot, probes = self._slot(keys), 1
        while len(keys):
            free = np.flatnonzero(self.values[slot] < 0)
            _, first = np.unique(slot[free], return_index=True)
            won = free[first]
            self.keys[slot[won]], self.values[slot[won]] = keys[won], values[won]
            left = np.ones(len(keys), bool)
            left[won] = False
            keys, values, slot = keys[left], values[left], (slot[left] + 1) & ((1 << self.bits) - 1)
            self.probes = max(self.probes, probes)
            probes += 1

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Each key's number, or -1."""
        slot = self._slot(keys)
        out = self.values[slot]
        open_ = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            found = self.values[slot[open_]]
            out[open_] = found
            open_ = open_[(found >= 0) & (self.keys[slot[open_]] != keys[open_])]
        out[open_] = -1
        return out


def give_back() -> None:
    """Hands freed memory back to the system, where the C library knows how."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class _Live:
    """A worker serves many stages; only the memory at work keeps what it knows."""

    now: Any = None

    @classmethod
    def switch(cls, to: Any) -> None:
        if cls.now is not to:
            if cls.now is not None:
                cls.now.forget()
                give_back()
            cls.now = to


class Pieces:
    """What each piece gave, for pieces of up to LONGEST bytes and up to ENTRIES of them and BYTES in all.

    `encode` answers a list of new pieces at once, each as little-endian 32-bit ids; past a bound, pieces that did not
    recur are forgotten."""

    ENTRIES, BYTES, LONGEST = 600_000, 32 << 20, 256

    def __init__(self, encode: Callable[[list[bytes]], Sequence[bytes]]):
        self.encode = encode
        self.forget()

    def forget(self) -> None:
        self.slots = Slots(10)
        self.keys = self.hits = self.at = self.size = self.id_at = self.id_size = np.empty(0, np.int64)
        self.data, self.ids = np.empty(0, np.uint8), np.empty(0, np.int32)

    def _learn(self, pieces: list[bytes]) -> np.ndarray:
        """Appends entries and gives their numbers."""
        found = self.encode(pieces)
        size, id_size = np.array(list(map(len, pieces)), np.int64), np.array(list(map(len, found)), np.int64) >> 2
        first = len(self.at)
        self.at = np.concatenate([self.at, len(self.data) + np.cumsum(size) - size])
        self.id_at = np.concatenate([self.id_at, len(self.ids) + np.cumsum(id_size) - id_size])
        self.size, self.id_size = np.concatenate([self.size, size]), np.concatenate([self.id_size, id_size])
        self.data = np.concatenate([self.data, np.frombuffer(b"".join(pieces), np.uint8)])
        self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<i4")])
        return np.arange(first, len(self.at))

    def _tidied(self) -> None:
        """Keeps the entries that recurred most, at most half of what fits."""
        often = 1
        while (keep := np.flatnonzero(self.hits >= often)).size > self.ENTRIES // 2 or (
            (self.size[keep] + 4 * self.id_size[keep]).sum() > self.BYTES // 2
        ):
            often *= 2
        self.data = self.data[spread(self.at[keep], self.size[keep])]
        self.ids = self.ids[spread(self.id_at[keep], self.id_size[keep])]
        self.size, self.id_size, self.keys, self.hits = (x[keep] for x in (self.size, self.id_size, self.keys, self.hits // 2))
        self.at, self.id_at = np.cumsum(self.size) - self.size, np.cumsum(self.id_size) - self.id_size
        self.slots = Slots(20)
        self.slots.add(self.keys, np.arange(len(keep), dtype=np.int32))

    def _known(self, data: np.ndarray, at: np.ndarray, size: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Each piece's entry, or -1; an entry of other bytes is none."""
        entry = self.slots.find(keys)
        some = np.flatnonzero(entry >= 0)
        some_entry = entry[some]
        alike = self.size[some_entry] == size[some]
        entry[some[~alike]] = -1
        some, some_entry = some[alike], some_entry[alike]
        sizes = size[some]
        if len(some):
            same = data[spread(at[some], sizes)] == self.data[spread(self.at[some_entry], sizes)]
            entry[some[~np.logical_and.reduceat(same, np.cumsum(sizes) - sizes)]] = -1
        return entry

    def of(self, docs: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, end to end, and how many each text has."""
        _Live.switch(self)
        if self.slots.bits < 20 or len(self.at) > self.ENTRIES or len(self.data) + 4 * len(self.ids) > self.BYTES:
            self._tidied()
        raw = b"\xff".join([t.encode() for t in docs]) + b"\xff"
        data = np.frombuffer(raw, np.uint8)
        at = cuts(data)
        size = np.diff(np.append(at, len(data)))
        ends = np.flatnonzero(data[at] == 255)  # the pieces between texts
        short = size <= self.LONGEST
        keys = np.zeros(len(at), np.int64)
        value = _BYTE[data] * _POWER[np.minimum(np.arange(len(data)) - np.repeat(at, size), self.LONGEST)]
        keys[:] = mixed(np.add.reduceat(value, at) + size.astype(_U)).view(np.int64)
        entry = np.full(len(at), -1, np.int32)
        lookup = np.flatnonzero(short & (data[at] != 255))
        entry[lookup] = self._known(data, at[lookup], size[lookup], keys[lookup])
        seen = entry[lookup]
        self.hits += np.bincount(seen[seen >= 0], minlength=len(self.hits)) > 0
        new = lookup[seen < 0]
        fresh, first = np.unique(keys[new], return_index=True)
        unknown = self.slots.find(fresh) < 0  # else the key stands for other bytes
        fresh, first = fresh[unknown], new[first[unknown]]
        if len(fresh):
            begun = self._learn([raw[a : a + n] for a, n in zip(at[first].tolist(), size[first].tolist(), strict=True)])
            self.slots.add(fresh, begun.astype(np.int32))
            self.keys, self.hits = np.append(self.keys, fresh), np.append(self.hits, np.zeros(len(fresh), np.int64))
            entry[new] = self._known(data, at[new], size[new], keys[new])
        kept = len(self.at), len(self.data), len(self.ids)
        once = np.flatnonzero(entry < 0)
        once = once[data[at[once]] != 255]
        if len(once):
            entry[once] = self._learn([raw[a : a + n] for a, n in zip(at[once].tolist(), size[once].tolist(), strict=True)])
        real = np.delete(entry, ends)
        counts = self.id_size[real]
        ids = self.ids[spread(self.id_at[real], counts)]
        total = np.concatenate([[0], np.cumsum(counts)])
        per_doc = np.diff(total[ends - np.arange(len(ends))], prepend=0)
        self.at, self.size, self.id_at, self.id_size = (x[: kept[0]] for x in (self.at, self.size, self.id_at, self.id_size))
        self.data, self.ids = self.data[: kept[1]], self.ids[: kept[2]]
        return ids, per_doc


class Memory:
    """What each string gave, for up to `entries` of them; past that all is forgotten.

    `make` answers a list of new strings at once. Strings longer than `longest` characters are
    answered but not kept, so the bytes held have a bound too."""

    def __init__(self, make: Callable[[list[str]], Sequence[Any]], entries: int, longest: int = 64):
        self.make, self.entries, self.longest, self.known = make, entries, longest, {}

    def forget(self) -> None:
        self.known = {}

    def of(self, docs: list[list[str]]) -> list[list[Any]]:
        _Live.switch(self)
        if len(self.known) > self.entries:
            self.known = {}
        known = self.known
        new = list(set().union(*docs).difference(known))
        extra: dict[str, Any] = {}
        if new:
            made = dict(zip(new, self.make(new), strict=True))
            extra = {c: made.pop(c) for c in new if len(c) > self.longest}
            known.update(made)
        if not extra:
            return [list(map(known.__getitem__, d)) for d in docs]
        return [[known[c] if c in known else extra[c] for c in d] for d in docs]
