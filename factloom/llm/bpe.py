"""Operator 7: byte-level BPE encoding and decoding over padded numpy matrices.

Pieces are bucketed by length and laid out as rows of a padded matrix. Each round every row merges
its leftmost pair of least rank; pair ranks come from a hashed table, finished rows leave the matrix
and the matrix narrows by one column (compaction). Pieces longer than LONGEST bytes are merged one
by one with a heap, which gives the same tokens in O(n log n).

Defined cases: a null or empty text gives no ids and decodes to no bytes; repeated rows and ties in
doc_id are encoded row by row; an empty table gives an empty table; input columns called `ids` or
`decoded` are replaced, all others are kept.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, texts
from .pieces import PATTERN, Pieces, Slots
from .words import grouped

LONGEST = 2048
NONE = np.int32(2**31 - 1)


class PairTable:
    """(left id, right id) -> rank of the merged token, by open addressing in numpy arrays."""

    def __init__(self, keys: np.ndarray, ranks: np.ndarray):
        self.slots = Slots(max(4, int(len(keys) * 4).bit_length()))
        self.slots.add(keys, ranks)

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE where the pair doesn't merge; a negative id never merges."""
        out = self.slots.find((left.astype(np.int64) << 32) | right.astype(np.int64))
        out[(out < 0) | (left < 0) | (right < 0)] = NONE
        return out


class BytePairs:
    """A vocabulary of byte strings with ranks, and the pattern that cuts texts into pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.cut = ranks, regex.compile(pattern)
        lefts, rights, merged = [], [], []
        for token, rank in ranks.items():
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    lefts.append(a)
                    rights.append(b)
                    merged.append(rank)
        self.pairs = PairTable(
            (np.array(lefts, np.int64) << 32) | np.array(rights, np.int64), np.array(merged, np.int32)
        )
        self.known = {t: np.int32(r).tobytes() for t, r in ranks.items()}
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        top = max(ranks.values()) + 1
        by_id: list[bytes] = [b""] * top
        for token, rank in ranks.items():
            by_id[rank] = token
        self.lengths = np.array([len(t) for t in by_id], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> BytePairs:
        with open(path, "rb") as f:
            rows = [line.split() for line in f if line.strip()]
        return cls({base64.b64decode(token): int(rank) for token, rank in rows}, pattern)

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Each piece's ids as little-endian int32 bytes."""
        out = [self.known.get(p) for p in pieces]
        buckets: dict[int, list[int]] = {}
        for i in [i for i, v in enumerate(out) if v is None]:
            n = len(pieces[i])
            if n > LONGEST:
                out[i] = self._long(pieces[i]).tobytes()
            else:
                buckets.setdefault(n if n <= 24 else 100 + n.bit_length(), []).append(i)
        for members in buckets.values():
            width = max(len(pieces[i]) for i in members)
            step = max(1, 2_000_000 // max(width, 1))
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for where, sizes, flat in self._matrix([pieces[i] for i in part], width):
                    ends = np.cumsum(sizes) * 4
                    data = flat.tobytes()
                    for i, s, e in zip(where.tolist(), (ends - sizes * 4).tolist(), ends.tolist(), strict=True):
                        out[part[i]] = data[s:e]
        return out

    def _matrix(self, pieces: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Yields, as rows finish: their numbers, their counts of ids, and their ids end to end."""
        sizes = np.array(list(map(len, pieces)))
        raw = np.array(pieces, f"S{width}").view(np.uint8).reshape(-1, width)
        tok = self.single[raw]
        tok[np.arange(width) >= sizes[:, None]] = -1
        rank = np.full((len(pieces), width), NONE, np.int32)
        if width > 1:
            rank[:, :-1] = self.pairs.ranks_of(tok[:, :-1].ravel(), tok[:, 1:].ravel()).reshape(len(pieces), -1)
        where = np.arange(len(pieces))
        while len(tok):
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(tok)), at]
            done = best == NONE
            if done.any():
                kept = tok[done]
                real = kept >= 0
                yield where[done], real.sum(axis=1), kept[real]
                go = ~done
                tok, rank, where, at, best = tok[go], rank[go], where[go], at[go], best[go]
                if not len(tok):
                    break
            n, w = tok.shape
            rows = np.arange(n)
            flat = rows * w + at
            tok.reshape(-1)[flat] = best
            drop = np.ones(n * w, bool)  # the merged pair's right half leaves its row
            drop[flat + 1] = False
            tok = tok.reshape(-1)[drop].reshape(n, w - 1)
            rank = rank.reshape(-1)[drop].reshape(n, w - 1)
            last = at + 1 > w - 2
            after = self.pairs.ranks_of(tok[rows, at], tok[rows, np.minimum(at + 1, w - 2)])
            after[last] = NONE
            rank[rows, at] = after
            has = np.flatnonzero(at > 0)
            rank[has, at[has] - 1] = self.pairs.ranks_of(tok[has, at[has] - 1], tok[has, at[has]])

    def _long(self, piece: bytes) -> np.ndarray:
        tok = self.single[np.frombuffer(piece, np.uint8)].tolist()
        n = len(tok)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        first = self.pairs.ranks_of(np.array(tok[:-1]), np.array(tok[1:])).tolist()
        heap = [(r, i, tok[i], tok[i + 1]) for i, r in enumerate(first) if r != NONE]
        heapq.heapify(heap)
        spell = self._spelling

        def offer(i: int) -> None:
            if i >= 0 and after[i] < n:
                r = self.ranks.get(spell(tok[i]) + spell(tok[after[i]]))
                if r is not None:
                    heapq.heappush(heap, (r, i, tok[i], tok[after[i]]))

        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tok[i] != a or j >= n or tok[j] != b:
                continue
            tok[i], tok[j] = r, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return np.array([t for t in tok if t >= 0], np.int32)

    def _spelling(self, i: int) -> bytes:
        return self.bytes[self.starts[i] : self.starts[i] + self.lengths[i]].tobytes()

    def encode_parts(self, new: list[bytes]) -> list[bytes]:
        """Each part's ids as little-endian int32 bytes; the pattern cuts parts further."""
        out: list[bytes | None] = [None] * len(new)
        whole = [i for i, c in enumerate(new) if (c[1:] if c[:1] == b" " else c).isalpha()]  # one piece each
        for i, v in zip(whole, self.encode_pieces([new[i] for i in whole]), strict=True):
            out[i] = v
        rest = [i for i, v in enumerate(out) if v is None]
        split = [[p.encode() for p in self.cut.findall(new[i].decode())] for i in rest]
        distinct = list(set().union(*split))
        ids = dict(zip(distinct, self.encode_pieces(distinct), strict=True))
        for i, ps in zip(rest, split, strict=True):
            out[i] = b"".join([ids[p] for p in ps])
        return out

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a flat id array, by one gather over the vocabulary's bytes."""
        size = self.lengths[ids]
        ends = np.cumsum(size)
        index = np.arange(int(ends[-1]) if len(ids) else 0, dtype=np.int64)
        return self.bytes[index + np.repeat(self.starts[ids] - (ends - size), size)]


_LOADED: dict[tuple[str, str], tuple[BytePairs, Pieces]] = {}


def loaded(path: str, pattern: str) -> tuple[BytePairs, Pieces]:
    """The vocabulary and its memory, once for each Python worker."""
    if (path, pattern) not in _LOADED:
        pairs = BytePairs.from_file(path, pattern)
        _LOADED[path, pattern] = pairs, Pieces(pairs.encode_parts)
    return _LOADED[path, pattern]


def encode_texts(docs: list[str], path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the texts, and each text's number of ids."""
    pairs, memory = loaded(path, pattern)
    if pattern == PATTERN:
        return memory.of(docs)
    parts = pairs.encode_parts([t.encode() for t in docs])
    return np.frombuffer(b"".join(parts), np.int32), np.array([len(p) // 4 for p in parts], np.int64)


def encode_decode(df: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """Appends `ids` (array of int) of the whole text and `decoded` (binary), decoded from those ids."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        pairs, _ = loaded(path, pattern)
        outs: list[list[pa.Array]] = [[], []]
        for part in grouped(texts(batch, text)):  # bounds the strings and flat arrays held at once
            ids, counts = encode_texts(part, path, pattern)
            ends = np.concatenate([[0], np.cumsum(counts)])
            outs[0].append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))
            sizes = np.concatenate([[0], np.cumsum(pairs.lengths[ids])])[ends]
            data = pairs.decode(ids)
            outs[1].append(
                pa.Array.from_buffers(
                    pa.binary(), len(counts), [None, pa.py_buffer(sizes.astype(np.int32)), pa.py_buffer(data)]
                )
            )
        if not len(batch):
            return [pa.array([], pa.list_(pa.int32())), pa.array([], pa.binary())]
        return [pa.concat_arrays(x) for x in outs]

    made = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return annotate(df, made, run)


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and sha256 of the ids (decimal, joined by commas) and of the decoded bytes."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
