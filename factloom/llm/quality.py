"""Operator 1: quality classifier, a generalised additive model with pairwise interactions.

Per-document features are cut into quantile bins. Shallow trees (at most four leaves) are boosted
cyclically, one feature at a time, each adding to that feature's lookup table; the pairs of features
that explain most of what is left get small two-way tables in the same manner. A score is the
logistic of a sum of bin lookups.

Defined cases: a null or empty text is scored from the features of the empty text; repeated rows
score alike; an empty table gives an empty table; without labels of both kinds every score is the
smoothed share of 1s (0.5 without any labels); input columns called `held_out`, `score` or
`predicted` are replaced.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, remainder, texts
from .labelled import sample

#: Most labelled rows that a fit sees.
SAMPLE_ROWS = 12_000
FEATURES = (
    "log_bytes", "log_words", "word_length", "distinct_words", "top_word", "repeated_neighbour", "upper_words",
    "upper_bytes", "digit_bytes", "mark_bytes", "symbol_bytes", "space_bytes", "wide_bytes", "repeated_lines",
    "line_length", "sentence_marks", "bars", "bangs", "packed",
)
_UPPER, _LOWER, _DIGIT, _SPACE, _MARK, _SYMBOL, _WIDE = range(7)
_CLASS = np.full(256, _SYMBOL, np.uint8)
_CLASS[128:] = _WIDE
for _i in range(128):
    _c = chr(_i)
    _CLASS[_i] = (
        _UPPER if _c.isupper() else _LOWER if _c.islower() else _DIGIT if _c.isdigit() else
        _SPACE if _c.isspace() else _MARK if _c in ".,;:'\"()-?" else _SYMBOL
    )


def features(docs: list[str]) -> np.ndarray:
    out = np.zeros((len(docs), len(FEATURES)))
    for i, text in enumerate(docs):
        data = text.encode()
        n = max(1, len(data))
        kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=7) / n
        words = data.split()
        w = max(1, len(words))
        counts = Counter(words)
        lines = [x for x in data.split(b"\n") if x]
        k = max(1, len(lines))
        out[i] = (
            np.log1p(len(data)), np.log1p(len(words)), sum(map(len, words)) / w, len(counts) / np.sqrt(w),
            max(counts.values(), default=0) / w, sum(a == b for a, b in zip(words, words[1:], strict=False)) / w,
            sum(map(bytes.isupper, words)) / w, kinds[_UPPER], kinds[_DIGIT], kinds[_MARK], kinds[_SYMBOL],
            kinds[_SPACE], kinds[_WIDE], 1 - len(set(lines)) / k, np.log1p(n / k), data.count(b".") / w,
            data.count(b"|") / w, data.count(b"!") / w, len(zlib.compress(data, 1)) / n,
        )
    return out


@dataclass
class Gam:
    """Bin edges, one table for each feature, and two-way tables over coarser bins."""

    prior: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.prior)
        for f, (e, t) in enumerate(zip(self.edges, self.tables, strict=True)):
            z += t[np.searchsorted(e, x[:, f], side="right")]
        for a, b, t in self.pairs:
            z += t[
                np.searchsorted(self.coarse[a], x[:, a], side="right"),
                np.searchsorted(self.coarse[b], x[:, b], side="right"),
            ]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray, l2: float) -> np.ndarray:
    return g * g / (h + l2)


def _tree(g: np.ndarray, h: np.ndarray, l2: float, leaf: float) -> np.ndarray:
    """A tree of depth two over ordered bins: each bin's step."""

    def cut(lo: int, hi: int) -> int:
        gs, hs = np.cumsum(g[lo:hi]), np.cumsum(h[lo:hi])
        if hi - lo < 2:
            return 0
        left, right = _gain(gs[:-1], hs[:-1], l2), _gain(gs[-1] - gs[:-1], hs[-1] - hs[:-1], l2)
        ok = (hs[:-1] >= leaf) & (hs[-1] - hs[:-1] >= leaf)
        total = np.where(ok, left + right, -np.inf)
        at = int(total.argmax())
        return lo + at + 1 if total[at] > _gain(gs[-1], hs[-1], l2) + 1e-9 else 0

    bounds = [0, len(g)]
    for _ in range(2):
        cuts = [cut(a, b) for a, b in zip(bounds, bounds[1:], strict=False)]
        bounds = sorted({*bounds, *(c for c in cuts if c)})
    out = np.zeros(len(g))
    for a, b in zip(bounds, bounds[1:], strict=False):
        out[a:b] = g[a:b].sum() / (h[a:b].sum() + l2)
    return out


def _quarter(g: np.ndarray, h: np.ndarray, l2: float) -> tuple[float, np.ndarray]:
    """The best cut of a two-way table into four quarters: its gain and each cell's step."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    a, b = gs[:-1, :-1], hs[:-1, :-1]
    if not a.size:
        return 0.0, np.zeros_like(g)
    top, left = (gs[:-1, -1:], hs[:-1, -1:]), (gs[-1:, :-1], hs[-1:, :-1])
    four = [
        (a, b), (top[0] - a, top[1] - b), (left[0] - a, left[1] - b),
        (gs[-1, -1] - top[0] - left[0] + a, hs[-1, -1] - top[1] - left[1] + b),
    ]
    total = sum(_gain(x, y, l2) for x, y in four)
    i, j = np.unravel_index(total.argmax(), total.shape)
    step = np.zeros_like(g)
    for (x, y), at in zip(
        four, (np.s_[: i + 1, : j + 1], np.s_[: i + 1, j + 1 :], np.s_[i + 1 :, : j + 1], np.s_[i + 1 :, j + 1 :]),
        strict=True,
    ):
        step[at] = x[i, j] / (y[i, j] + l2)
    return float(total[i, j] - _gain(gs[-1, -1], hs[-1, -1], l2)), step


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, l2: float = 2.0, leaf: float = 2.0,
    bins: int = 32, cells: int = 8, pairs: int = 6,
) -> Gam:
    share = (y.sum() + 1) / (len(y) + 2)
    model = Gam(float(np.log(share / (1 - share))))
    if not 0 < y.sum() < len(y):
        return model
    model.edges = [_edges(x[:, f], bins) for f in range(x.shape[1])]
    model.coarse = [_edges(x[:, f], cells) for f in range(x.shape[1])]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    fine = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    rough = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.coarse)]
    z = np.full(len(y), model.prior)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, b in enumerate(fine):
            g, h = slopes()
            size = len(model.tables[f])
            step = rate * _tree(np.bincount(b, g, size), np.bincount(b, h, size), l2, leaf)
            model.tables[f] += step
            z += step[b]
    g, h = slopes()
    found = []
    for a in range(x.shape[1]):
        for b in range(a + 1, x.shape[1]):
            shape = (len(model.coarse[a]) + 1, len(model.coarse[b]) + 1)
            cell = rough[a] * shape[1] + rough[b]
            n = shape[0] * shape[1]
            found.append((_quarter(np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape), l2)[0], a, b, cell, shape))
    best = sorted(found, key=lambda v: -v[0])[:pairs]
    tables = [np.zeros(v[4]) for v in best]
    for _ in range(rounds // 3):
        for t, (_, _, _, cell, shape) in zip(tables, best, strict=True):
            g, h = slopes()
            n = shape[0] * shape[1]
            step = rate * _quarter(np.bincount(cell, g, n).reshape(shape), np.bincount(cell, h, n).reshape(shape), l2)[1]
            t += step
            z += step.ravel()[cell]
    model.pairs = [(a, b, t) for t, (_, a, b, _, _) in zip(tables, best, strict=True)]
    return model


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE_ROWS) -> Gam:
    """Fits on the driver from at most `rows` feature vectors, computed on the executors."""
    made = [T.StructField("x", T.ArrayType(T.DoubleType()))]
    got = annotate(
        sample(docs, labels, label, rows), made,
        lambda b: [pa.array(list(features(texts(b))), pa.list_(pa.float64()))],
    ).select("doc_id", "x", "y").toPandas().sort_values("doc_id", kind="stable")
    if not len(got):
        return Gam(0.0)
    return fit(np.array(got["x"].tolist()), got["y"].to_numpy(float))


def classify(docs: DataFrame, model: Gam, threshold: float = 0.5) -> DataFrame:
    """Appends held_out, score and predicted to every document."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(model.score(features(texts(batch))), pa.float64())]

    scored = annotate(docs, [T.StructField("score", T.DoubleType())], run)
    return scored.withColumns(
        {
            "held_out": remainder(F.col("doc_id"), 3) == 1,
            "predicted": (F.col("score") >= threshold).cast("int"),
        }
    )
