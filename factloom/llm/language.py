"""Operator 4: language by rank-order n-gram profiles and out-of-place distance.

A text's 1- to 3-grams (letters, with word ends as blanks, never across words) are ranked by count.
Its distance to a language is the sum of rank differences to that language's profile; an n-gram the
profile lacks counts as wholly out of place. The nearest language wins; ties go to the first name.

Defined cases: a null text or one without a letter is `und` with score 0; with no profiles at all
every text is `und`; repeated rows and an empty table need no special care; documents whose lang is
null, empty or blank teach nothing; input columns called `held_out`, `lang_pred` or `score` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from .common import annotate, remainder, small_batches, texts

#: Ranks in a profile, and documents of each language that a fit expects to see.
PLACES, PER_LANGUAGE = 300, 1500
_BLANK = 1


def _alpha() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


_TABLE: list[np.ndarray] = []


def grams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes (three code points of 21 bits) and their counts."""
    if not _TABLE:
        _TABLE.append(_alpha())
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    letter = _TABLE[0][points]
    s = np.where(letter, points, _BLANK)
    two = letter[:-1] | letter[1:]
    mid = letter[1:-1] & (letter[:-2] | letter[2:])
    codes = np.concatenate(
        [
            s[letter],
            ((s[:-1] << 21) | s[1:])[two],
            ((s[:-2] << 42) | (s[1:-1] << 21) | s[2:])[mid],
        ]
    )
    codes.sort()
    if not len(codes):
        return codes, codes
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    return codes[first], np.diff(np.append(first, len(codes)))


def ranked(codes: np.ndarray, counts: np.ndarray, places: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    return codes[np.argsort(-counts, kind="stable")[:places]]


@dataclass
class Profiles:
    names: list[str]
    codes: np.ndarray  #: all profiles' codes, sorted
    start: np.ndarray  #: where each code's entries begin in `lang` and `rank`; one more for their end
    lang: np.ndarray
    rank: np.ndarray
    places: int

    @classmethod
    def of(cls, ranked_codes: dict[str, np.ndarray], places: int = PLACES) -> Profiles:
        names = sorted(ranked_codes)
        sizes = [len(ranked_codes[n]) for n in names]
        flat = np.concatenate([np.empty(0, np.int64), *(ranked_codes[n] for n in names)]).astype(np.int64)
        lang = np.repeat(np.arange(len(names)), sizes)
        rank = np.concatenate([np.empty(0, np.int64), *map(np.arange, sizes)]).astype(np.int64)
        order = np.argsort(flat, kind="stable")
        codes, first = np.unique(flat[order], return_index=True)
        return cls(names, codes, np.append(first, len(flat)), lang[order], rank[order], places)

    def predict(self, text: str) -> tuple[str, float]:
        top = ranked(*grams(text), self.places)
        if not len(top) or not self.names:
            return "und", 0.0
        at = np.searchsorted(self.codes, top)
        own = np.flatnonzero(np.append(self.codes, -1)[at] == top)
        low, n = self.start[at[own]], self.start[at[own] + 1] - self.start[at[own]]
        # the entries of all n-grams of the text that some profile has
        entry = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        near = self.places - np.abs(self.rank[entry] - np.repeat(own, n))
        distance = self.places * len(top) - np.bincount(self.lang[entry], near, len(self.names))
        best = int(distance.argmin())
        return self.names[best], float(1 - distance[best] / (self.places * len(top)))


def train(docs: DataFrame, lang: str = "lang", per_language: int = PER_LANGUAGE, places: int = PLACES) -> Profiles:
    """Profiles from about `per_language` documents of each language, picked by a hash of the id."""
    known = docs.select("doc_id", "text", F.trim(F.col(lang).cast("string")).alias("lang")).where(
        (F.col("lang") != "") & (remainder(F.col("doc_id"), 4) != 2)
    )
    sizes = known.groupBy("lang").count()  # a row for each profile, which all workers get anyway
    draw = F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0)), F.lit("profile")), F.lit(1 << 30)) / float(1 << 30)
    taken = known.join(F.broadcast(sizes), "lang").where(draw < per_language / F.col("count"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, dict[int, int]] = {}
        for b in batches:
            for lang, text in zip(b.column(b.schema.get_field_index("lang")).to_pylist(), texts(b), strict=True):
                own = total.setdefault(lang, {})
                for c, n in zip(*(x.tolist() for x in grams(text)), strict=True):
                    own[c] = own.get(c, 0) + n
        for lang, own in total.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(own)), pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.int64())],
                names=["lang", "code", "n"],
            )

    small_batches(docs.sparkSession)
    counts = taken.select("lang", "text").mapInArrow(run, "lang string, code long, n long")
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    best = (
        counts.groupBy("lang", "code").agg(F.sum("n").alias("n")).withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= places).toPandas()
    )
    found = {n: g.sort_values("place")["code"].to_numpy(np.int64) for n, g in best.groupby("lang")}
    return Profiles.of(found, places)


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """Appends lang_pred, score and held_out to every document."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        found = [profiles.predict(t) for t in texts(batch)]
        return [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]

    made = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return annotate(docs, made, run).withColumn("held_out", remainder(F.col("doc_id"), 4) == 2)


def lettered(docs: DataFrame) -> DataFrame:
    """Appends whether a document's text has a letter."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([len(grams(t)[0]) > 0 for t in texts(batch)], pa.bool_())]

    return annotate(docs, [T.StructField("lettered", T.BooleanType())], run)
