"""Operator 9: a uniform shuffle into shards of exact size by a communication matrix.

Rows are numbered where they lie, in a written copy of the table, so that every later pass sees them alike.
A matrix of how many rows each partition sends to each cell is drawn from the multivariate hypergeometric
law with the partitions' and the cells' sizes as margins, which is the law of a uniform permutation. Each
partition permutes its rows and sends them by its line of the matrix; after the one exchange of rows, the
rows of a cell are permuted again and numbered. Shard sizes differ by at most one row (law `rows`); a shard is
cut into cells of about ROWS rows of known size, so numbering needs no count and no task holds a whole shard.

The matrix is never held in whole: partitions are halved again and again, and each task draws the path
to its own line, with a seed for every halving. The driver holds one count for each partition of the input.

Defined cases: null and repeated keys, and wholly equal rows, are rows like any other, each dealt by itself;
fewer rows than shards leave shards empty; an empty table gives an empty table; columns called `shard` or
`slot` are replaced. The result follows from the rows, how they lie in partitions, and the seed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import small_batches, written

#: Rows of a cell.
ROWS = 100_000
#: monotonically_increasing_id() holds the partition above this bit, the row's number below.
_BIT = 33


def hypergeometric(rng: np.random.Generator, good: int, bad: int, need: int) -> int:
    """How many of `need` drawn from good + bad are good, at any size, by inversion of the law.

    Weights follow from the ratios of neighbouring terms, taken outward from the mode until they no longer count."""
    low, high = max(0, need - bad), min(need, good)
    if low == high:
        return low
    total = good + bad
    mode = min(max((need + 1) * (good + 1) // (total + 2), low), high)
    reach = 50 + int(12 * np.sqrt(need * (good / total) * (bad / total)))
    x = np.arange(max(low, mode - reach), min(high, mode + reach) + 1)
    k = x[:-1].astype(float)  # ratio of the term after k to that of k
    step = np.log((good - k) * (need - k)) - np.log((k + 1) * (bad - need + k + 1))
    height = np.concatenate([[0.0], np.cumsum(step)])
    weight = np.exp(height - height[mode - x[0]])
    heap = np.cumsum(weight)
    return int(x[min(np.searchsorted(heap, rng.random() * heap[-1], "right"), len(x) - 1)])


def split(rng: np.random.Generator, cells: np.ndarray, need: int) -> np.ndarray:
    """A multivariate draw: how many of `need` rows go to each of the cells, which hold as many as given."""
    out, rest = np.zeros_like(cells), int(cells.sum())
    for j, room in enumerate(cells.tolist()):
        if not need:
            break
        rest -= room
        out[j] = take = hypergeometric(rng, room, rest, need)
        need -= take
    return out


def line(until: np.ndarray, part: int, cells: np.ndarray, seed: int) -> np.ndarray:
    """The partition's line of the matrix: rows to each cell. until: rows before each partition, and in all."""
    low, high, node = 0, len(until) - 1, 1
    while high - low > 1:
        mid = (low + high) // 2
        left = split(np.random.default_rng([seed, node]), cells, int(until[mid] - until[low]))
        if part < mid:
            high, cells, node = mid, left, 2 * node
        else:
            low, cells, node = mid, cells - left, 2 * node + 1
    return cells


def bounds(total: int, shards: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each cell's shard, first slot and size."""
    shard, start, size = [], [], []
    for s in range(shards):
        n = total // shards + (s < total % shards)
        blocks = max(1, -(-n // rows))
        ends = [n * b // blocks for b in range(blocks + 1)]
        shard += [s] * blocks
        start += ends[:-1]
        size += [b - a for a, b in zip(ends, ends[1:], strict=False)]
    return np.array(shard), np.array(start, np.int64), np.array(size, np.int64)


def shuffle_into(df: DataFrame, shards: int, seed: int = 17, rows: int = ROWS) -> DataFrame:
    """Appends shard (0 to shards - 1) and slot (0 to the shard's size - 1) to every row."""
    columns = [c for c in df.columns if c.lower() not in ("shard", "slot")]
    small_batches(df.sparkSession)
    lain = written(df.select(*columns, F.monotonically_increasing_id().alias("_lies")), "lain")
    part = F.shiftright("_lies", _BIT).cast("int")
    counts = {r["p"]: r["n"] for r in lain.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()}
    until = np.concatenate([[0], np.cumsum([counts.get(p, 0) for p in range(max(counts, default=-1) + 1)])]).astype(np.int64)
    shard, start, cells = bounds(int(until[-1]), shards, rows)
    dealt: dict[int, np.ndarray] = {}

    def cell(lies: pd.Series) -> pd.Series:
        at = lies.to_numpy()
        own, number = at >> _BIT, at & ((1 << _BIT) - 1)
        out = np.zeros(len(at), np.int32)
        for p in np.unique(own).tolist():
            if p not in dealt:
                dealt.clear()  # a task reads one partition after another
                labels = np.repeat(np.arange(len(cells), dtype=np.int32), line(until, p, cells, seed))
                dealt[p] = np.random.default_rng([seed, 0, p]).permutation(labels)
            mine = own == p
            out[mine] = dealt[p][number[mine]]
        return pd.Series(out)

    sent = lain.withColumn("_cell", F.pandas_udf(cell, "int")("_lies"))
    place = F.row_number().over(Window.partitionBy("_cell").orderBy(F.xxhash64("_lies", F.lit(seed)), "_lies"))
    blocks = np.bincount(shard, minlength=shards).tolist()
    known = F.array(*(F.struct(F.lit(b).alias("blocks"), F.lit(f).alias("first")) for b, f in zip(blocks, np.cumsum([0, *blocks])[:-1].tolist(), strict=True)))
    # at most one row more or less tells shards apart, so a cell's shard and start follow from its number
    total = int(until[-1])
    of = F.size(F.filter(known, lambda k: k["first"] <= F.col("_cell"))) - 1
    named = sent.withColumn("_inner", place).withColumn("shard", of.cast("int"))
    mine = F.element_at(known, F.col("shard") + 1)
    size = F.lit(total // shards) + (F.col("shard") < total % shards).cast("int")
    first = F.call_function("div", (size * (F.col("_cell") - mine["first"])).cast("long"), mine["blocks"].cast("long"))
    return named.select(*columns, "shard", (first + F.col("_inner") - 1).cast("long").alias("slot"))
