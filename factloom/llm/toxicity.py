"""Operator 6: toxicity by a factorization machine over hashed terms.

Terms (words in lower case without outer marks, and their first four and five letters, which stay when
endings change) are hashed into buckets. A bucket becomes a feature on either of two grounds: it tells the
labels apart by itself, or together with another one beyond what both do alone, so that two neutral terms
which are toxic only side by side are learned too. The machine learns a weight and a short vector for each
feature, so that pairs of terms count beyond the sum of their weights.

Defined cases: a null or empty text has no terms and scores from the bias alone; repeated rows score
alike; an empty table gives an empty table; without labels of both kinds every score is the smoothed
share of 1s; input columns called `held_out`, `score` or `predicted` are replaced.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, remainder, texts
from .labelled import sample
from .pieces import Memory

#: Most labelled rows that a fit sees, hash bits, length of a feature's vector.
SAMPLE_ROWS, BITS, RANK = 12_000, 20, 8
#: Documents a feature must be in, standard errors by which it (or a pair) must differ from no effect, and
#: buckets of the most even presence among which pairs are searched (their counts are squares of this).
LEAST, ALONE, TOGETHER, PAIRED = 5, 3.0, 5.0, 1024
ENTRIES = 150_000
_EDGE = ".,;:!?\"'()[]{}<>|*#$%&-_=+~`/\\"


def terms(token: str) -> set[str]:
    word = token.strip(_EDGE).lower()
    return {word, *(word[:n] + "-" for n in (4, 5) if len(word) >= n)} if word else set()


def bucket(term: str, bits: int = BITS) -> int:
    return zlib.crc32(term.encode()) >> (32 - bits)


def _make(new: list[str]) -> list[bytes]:
    return [b"".join([bucket(t).to_bytes(4, "little") for t in terms(token)]) for token in new]


_TERMS = Memory(_make, ENTRIES)


def buckets(docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document number, bucket) pairs, in that order."""
    found = [b"".join(x) for x in _TERMS.of([list(set(t.split())) for t in docs])]
    counts = np.array([len(x) // 4 for x in found], np.int64)
    flat = np.frombuffer(b"".join(found), "<i4").astype(np.int64)
    key = np.unique((np.repeat(np.arange(len(docs)), counts) << BITS) | flat)
    return key >> BITS, key & ((1 << BITS) - 1)


@dataclass
class Machine:
    bias: float
    place: np.ndarray  #: bucket -> feature, or -1
    weight: np.ndarray
    vector: np.ndarray

    def logits(self, doc: np.ndarray, feature: np.ndarray, n: int) -> np.ndarray:
        z = self.bias + np.bincount(doc, self.weight[feature], n)
        v = self.vector[feature]
        for k in range(v.shape[1]):
            s = np.bincount(doc, v[:, k], n)
            z += 0.5 * (s * s - np.bincount(doc, v[:, k] ** 2, n))
        return z

    def score(self, docs: list[str]) -> np.ndarray:
        found = [b"".join(x) for x in _TERMS.of([list(set(t.split())) for t in docs])]
        doc = np.repeat(np.arange(len(docs)), [len(x) // 4 for x in found])
        feature = self.place[np.frombuffer(b"".join(found), "<i4")].astype(np.int64)
        on = feature >= 0
        size = max(1, len(self.weight))
        key = np.unique(doc[on] * size + feature[on])  # each term once for a document
        z = self.logits(key // size, key % size, len(docs))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def informative(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The buckets, each in LEAST documents, whose log odds differ from none by ALONE standard errors."""
    n1, n0 = y.sum(), len(y) - y.sum()
    size = 1 << BITS
    flat = np.concatenate(docs) if docs else np.empty(0, np.int64)
    label = np.repeat(y, [len(d) for d in docs])
    one = np.bincount(flat, label, size)
    zero = np.bincount(flat, 1 - label, size)
    odds = np.log((one + 0.5) / (n1 - one + 0.5)) - np.log((zero + 0.5) / (n0 - zero + 0.5))
    error = np.sqrt(1 / (one + 0.5) + 1 / (zero + 0.5))
    return np.flatnonzero((one + zero >= LEAST) & (np.abs(odds) > ALONE * error))


def interacting(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """The buckets of pairs whose joint log odds differ from the sum of both by TOGETHER standard errors."""
    count = np.bincount(np.concatenate(docs), minlength=1 << BITS) if docs else np.zeros(1 << BITS)
    even = np.minimum(count, len(docs) - count)
    chosen = np.argsort(-even, kind="stable")[:PAIRED]
    chosen = np.sort(chosen[even[chosen] >= LEAST])
    both = [np.zeros((len(chosen), len(chosen))) for _ in range(2)]
    for kind in range(2):
        rows = np.flatnonzero(y == kind)
        for at in range(0, len(rows), 1000):
            part = [docs[i] for i in rows[at : at + 1000]]
            flat, line = np.concatenate(part), np.repeat(np.arange(len(part)), [len(d) for d in part])
            place = np.minimum(np.searchsorted(chosen, flat), max(len(chosen) - 1, 0))
            on = chosen[place] == flat if len(chosen) else np.zeros(len(flat), bool)
            x = np.zeros((len(part), len(chosen)), np.float32)
            x[line[on], place[on]] = 1
            both[kind] += x.T @ x
    effect = variance = 0.0
    joint = both[0] + both[1]
    for a, b, sign in ((1, 1, 1), (1, 0, -1), (0, 1, -1), (0, 0, 1)):
        cells = []
        for kind in range(2):
            m, n = both[kind], (y == kind).sum()
            alone = np.diag(m)
            with_a, with_b = alone[:, None], alone[None, :]
            cells.append({(1, 1): m, (1, 0): with_a - m, (0, 1): with_b - m, (0, 0): n - with_a - with_b + m}[a, b] + 0.5)
        effect = effect + sign * (np.log(cells[1]) - np.log(cells[0]))
        variance = variance + 1 / cells[0] + 1 / cells[1]
    found = (np.abs(effect) > TOGETHER * np.sqrt(variance)) & (joint >= LEAST)
    np.fill_diagonal(found, False)
    return chosen[found.any(axis=1)]


def one_of_each(docs: list[np.ndarray], seed: int = 7) -> np.ndarray:
    """Numbers of the rows to learn from: of near copies, told by minima over their rarer terms, the first.

    Else a copied text's whole vocabulary would pass for a sign of its label."""
    size = 1 << BITS
    count = np.bincount(np.concatenate(docs), minlength=size) if docs else np.zeros(size)
    mix = np.random.default_rng(seed).permuted(np.tile(np.arange(size, dtype=np.int32), (9, 1)), axis=1)
    rare = count <= max(5, len(docs) // 100)
    seen: set[tuple] = set()
    kept = []
    for i, d in enumerate(docs):
        own = d[rare[d]]
        if len(own):
            low = mix[:, own].min(axis=1).tolist()
            keys = [(j, *low[3 * j : 3 * j + 3]) for j in range(3)]
            new = not any(k in seen for k in keys)
            seen.update(keys)
            if not new:
                continue
        kept.append(i)
    return np.array(kept, np.int64)


def fit(
    docs: list[np.ndarray], y: np.ndarray, epochs: int = 30, rate: float = 0.2, l2: float = 1e-5, seed: int = 7
) -> Machine:
    """docs: each row's distinct buckets. Adagrad over minibatches."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = Machine(float(np.log(share / (1 - share))), np.full(1 << BITS, -1, np.int32), np.zeros(0), np.zeros((0, RANK)))
    if not 0 < y.sum() < len(y):
        return model
    kept = one_of_each(docs)
    docs, y = [docs[i] for i in kept], y[kept]
    chosen = np.union1d(informative(docs, y), interacting(docs, y))
    model.place[chosen] = np.arange(len(chosen))
    rows = [f[f >= 0].astype(np.int64) for f in (model.place[d] for d in docs)]
    rng = np.random.default_rng(seed)
    model.weight = np.zeros(len(chosen))
    model.vector = rng.normal(0, 0.01, (len(chosen), RANK))
    seen_w, seen_v, seen_b = np.full(len(chosen), 1e-6), np.full((len(chosen), RANK), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), 128):
            part = order[at : at + 128]
            counts = np.array([len(rows[i]) for i in part])
            feature = np.concatenate([rows[i] for i in part])
            doc = np.repeat(np.arange(len(part)), counts)
            p = 1 / (1 + np.exp(-np.clip(model.logits(doc, feature, len(part)), -30, 30)))
            slope = (p - y[part]) / len(part)
            live, local = np.unique(feature, return_inverse=True)
            v = model.vector[feature]
            sums = np.stack([np.bincount(doc, v[:, k], len(part)) for k in range(RANK)], axis=1)
            by = slope[doc]
            gw = np.bincount(local, by, len(live)) + l2 * model.weight[live]
            inner = by[:, None] * (sums[doc] - v)
            gv = np.stack([np.bincount(local, inner[:, k], len(live)) for k in range(RANK)], axis=1) + l2 * model.vector[live]
            seen_w[live] += gw * gw
            seen_v[live] += gv * gv
            seen_b += float(slope.sum()) ** 2
            model.weight[live] -= rate * gw / np.sqrt(seen_w[live])
            model.vector[live] -= 0.1 * rate * gv / np.sqrt(seen_v[live])
            model.bias -= rate * float(slope.sum()) / seen_b**0.5
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", rows: int = SAMPLE_ROWS) -> Machine:
    """Fits on the driver from at most `rows` bucket lists, made on the executors."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        docs = texts(batch)
        doc, b = buckets(docs)
        ends = np.searchsorted(doc, np.arange(len(docs) + 1))
        data = b.astype("<i4").tobytes()
        return [pa.array([data[4 * s : 4 * e] for s, e in zip(ends, ends[1:], strict=False)], pa.binary())]

    got = (
        annotate(sample(docs, labels, label, rows), [T.StructField("b", T.BinaryType())], run)
        .select("doc_id", "b", "y")
        .toPandas()
        .sort_values("doc_id", kind="stable")
    )
    if not len(got):
        return fit([], np.zeros(0))
    return fit([np.frombuffer(b, "<i4") for b in got["b"]], got["y"].to_numpy(float))


def classify(docs: DataFrame, model: Machine, threshold: float = 0.7) -> DataFrame:
    """Appends held_out, score and predicted to every document."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        parts = [model.score(texts(batch.slice(i, 500))) for i in range(0, len(batch), 500)]
        return [pa.array(np.concatenate(parts) if parts else np.empty(0), pa.float64())]

    scored = annotate(docs, [T.StructField("score", T.DoubleType())], run)
    return scored.withColumns(
        {
            "held_out": remainder(F.col("doc_id"), 3) == 1,
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )
