"""Operator 2: near-duplicates by min-max hashing, exact confirmation and connected components.

Each hash function gives two signature values, its minimum and its maximum over a document's word
shingles, so half as many hashes are evaluated. Documents that agree on a band of values meet in a
bucket. First every member is compared with the bucket's best connected document, which settles most
buckets. Members of buckets that still hold several components are candidates of one another only where
their sets can be as alike as asked for: with each set's shingles ordered rarest first, two sets that
share enough must meet at a shingle that stands early in both (prefix and position bounds, which lose
nothing). So a large group of texts that resemble each other below the threshold, because they share a
passage say, is parted by the shingles each has for itself, without comparing all pairs. Every link is
confirmed on the full shingle sets. Equal word sequences are one node throughout.

With ROWS = 4 and BANDS = 28 a pair at 85 % is missed by all bands with probability 1e-9, at 80 % 4e-7.

Defined cases: a text without words (null, empty, blank) has no shingles and no link; one with fewer
words than a shingle is one shingle; a repeated row (same doc_id and text) shares its component; rows
with one doc_id and different texts are linked text by text; a null doc_id never gives a component its
id, has a null component_id and is kept; an empty table gives an empty table; other columns are not used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, dropped, texts, written
from .words import draws, grouped, mixed, word_hashes

ROWS, BANDS = 4, 28
#: Most ids that are broadcast to pick the texts to confirm (8 bytes each).
SENT = 500_000
#: Most word sequences that count as hot: each holds over 1/HOT of all rows, so there are no more.
HOT = 10_000
_U = np.uint64
_PLACE = draws(64, 11)


def shingles(docs: list[str], k: int) -> tuple[list[np.ndarray], list[bytes | None]]:
    """Each text's distinct shingles as sorted 64-bit hashes, and a digest of its word sequence (None without words)."""
    flat, counts = word_hashes(docs)
    n = max(len(flat) - k + 1, 0)
    words = mixed(flat)
    all_ = np.zeros(n, _U)  # shingles that cross texts are not read
    for i in range(k):
        all_ += words[i : n + i] * _PLACE[i]
    all_ = mixed(all_)
    sets, keys = [], []
    for size, end in zip(counts.tolist(), np.cumsum(counts).tolist(), strict=True):
        at = end - size
        if size >= k:
            own = np.sort(all_[at : end - k + 1])
            own = own[np.append(True, own[1:] != own[:-1])]
        elif size:
            own = mixed((words[at:end] * _PLACE[:size]).sum(dtype=_U, keepdims=True) + _U(size))
        else:
            own = flat[:0]
        sets.append(own)
        keys.append(xxhash.xxh3_128_digest(flat[at:end]) if size else None)
    return sets, keys


class MinMax:
    """Signatures cut into bands: int64 band keys of a shingle set."""

    def __init__(self, rows: int = ROWS, bands: int = BANDS, seed: int = 5):
        n = (rows * bands + 1) // 2
        self.rows, self.bands = rows, bands
        self.a, self.b = draws(n, seed).astype(np.uint32)[:, None], draws(n, seed + 1).astype(np.uint32)[:, None]
        self.weights = draws(rows * bands, seed + 2).reshape(bands, rows)

    def keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of band keys for each set (of meaning where it is not empty)."""
        half = len(self.a)
        sign = np.zeros((len(sets), 2 * half), np.uint32)
        for row, x in zip(sign, sets, strict=True):
            x = (x >> _U(32)).astype(np.uint32)
            for at in range(0, len(x), 4096):
                v = x[at : at + 4096] * self.a + self.b
                low, high = v.min(axis=1), v.max(axis=1)
                row[:half] = np.minimum(row[:half], low) if at else low
                row[half:] = np.maximum(row[half:], high) if at else high
        sign = mixed(sign[:, : self.rows * self.bands].astype(_U) + _U(1)).reshape(-1, self.bands, self.rows)
        return mixed((sign * self.weights).sum(axis=2, dtype=_U)).view(np.int64)


def signed(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, key (equal for equal word sequences; null without words), bands."""
    hashes = MinMax()

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        sizes, keys, bands = [], [], []
        for part in grouped(texts(batch)):
            sets, found = shingles(part, k)
            sizes += map(len, sets)
            keys += found
            bands += [b if len(s) else None for s, b in zip(sets, hashes.keys(sets), strict=True)]
        return [
            pa.array(sizes, pa.int64()),
            pa.array(keys, pa.binary()),
            pa.array(bands, pa.list_(pa.int64())),
        ]

    made = [
        T.StructField("n_shingles", T.LongType()),
        T.StructField("key", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
    return annotate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), made, run, drop=["text"])


def with_sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, key and shingle hashes."""

    def run(batch: pa.RecordBatch) -> list[pa.Array]:
        kind, keys, parts = pa.list_(pa.int64()), [], []
        for part in grouped(texts(batch)):
            sets, found = shingles(part, k)
            keys += found
            parts.append(pa.array([s.view(np.int64) for s in sets], kind))
        return [pa.array(keys, pa.binary()), pa.concat_arrays(parts) if parts else pa.array([], kind)]

    made = [T.StructField("key", T.BinaryType()), T.StructField("set", T.ArrayType(T.LongType()))]
    return annotate(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), made, run, drop=["text"])


def sets_of(nodes: DataFrame, heads: DataFrame, docs: DataFrame, k: int, repeated: bool) -> DataFrame:
    """(node, n, set) of the given nodes, from their texts. heads: node, key, first (a doc_id of that text)."""
    wanted = heads if nodes is None else heads.join(nodes, "node", "left_semi")
    ids = written(wanted.select("node", F.col("first").alias("doc_id"), "key"), "ids")
    few = ids.limit(SENT + 1).count() <= SENT  # else the texts are shuffled to their ids
    only = ids.select("doc_id").distinct() if repeated else ids.select("doc_id")
    found = with_sets(docs.join(F.broadcast(only) if few else only, "doc_id", "left_semi"), k)
    if repeated:  # of the rows of an id, one with the node's own text
        found = found.join(ids, ["doc_id", "key"]).dropDuplicates(["node"])
    else:
        found = found.withColumnRenamed("doc_id", "node")
    return written(found.select("node", F.size("set").alias("n"), "set"), "sets")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on full sets."""
    own = sets.select("node", "set")
    both = pairs.select("a", "b").join(own.toDF("b", "sb"), "b").join(own.toDF("a", "sa"), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    found = both.where(100 * common >= percent * (F.size("sa") + F.size("sb") - common))
    return written(found.select("a", "b"), "links")


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable; every node of an edge has a row.

    Rounds of neighbours' minima and pointer jumping, each written to the shared folder."""
    both = written(edges.toDF("u", "v").union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")
    labels = written(both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("label")), "labels")
    while True:
        near = both.join(labels.toDF("v", "near"), "v").groupBy(F.col("u").alias("node")).agg(F.min("near").alias("near"))
        jump = labels.toDF("label", "jump")
        step = labels.join(near, "node").join(jump, "label")
        new = written(
            step.select("node", F.least("label", "near", "jump").alias("label"), F.col("label").alias("old")), "labels"
        )
        moved = new.where(F.col("label") != F.col("old")).limit(1).count()
        dropped(labels)
        labels = new.select("node", "label")
        if not moved:
            dropped(both)
            return labels


def _sizes_fit(a: Column, b: Column, percent: int) -> Column:
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def early(sets: DataFrame, percent: int) -> DataFrame:
    """(shingle, node, at, n): of each set, rarest first, the shingles at which a set alike enough can first be met.

    Rarity is counted over the sets given. Two sets of m and n shingles are alike enough with at least
    percent * (m + n) / (100 + percent) shingles in common, and a partner has at least percent * n / 100,
    so the first common one stands at most n - percent * n / 100 from a set's start. Shingles that one
    set alone has take places and are then left out."""
    spread = sets.select("node", "n", F.explode("set").alias("shingle"))
    known = spread.groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    ordered = (
        spread.join(known, "shingle", "left")
        .groupBy("node", "n")
        .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(1)).alias("df"), "shingle"))).alias("o"))
    )
    last = F.floor((100 - percent) * F.col("n") / 100).cast("int")
    return (
        ordered.select("node", "n", F.posexplode(F.slice("o", F.lit(1), last + 1)).alias("at", "o"))
        .where("o.df > 1")
        .select("o.shingle", "node", "at", "n")
    )


def unsettled(members: DataFrame, sets: DataFrame, bands: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different components that share a bucket, but for those whose sets can't be alike.

    members: bucket, node, comp; sets: node, n, set; bands: node, bands."""
    mixed = members.groupBy("bucket").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo < hi")
    open_ = written(members.join(mixed.select("bucket"), "bucket", "left_semi").select("node", "comp").distinct(), "open")
    if open_.isEmpty():
        return open_.select(F.col("node").alias("a"), F.col("comp").alias("b"))
    rows = written(early(sets.join(open_.select("node"), "node", "left_semi"), percent).join(open_, "node"), "early")
    x, y = rows.toDF("a", "shingle", "ia", "na", "ca"), rows.toDF("b", "shingle", "ib", "nb", "cb")
    least = F.ceil(percent * (F.col("na") + F.col("nb")) / (100 + percent))
    meet = (
        (x["shingle"] == y["shingle"]) & (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb"))
        & _sizes_fit(F.col("na"), F.col("nb"), percent)
        & (F.col("na") - F.col("ia") >= least) & (F.col("nb") - F.col("ib") >= least)
    )
    pairs = x.join(y, meet).select("a", "b").distinct()
    return (
        pairs.join(bands.select("node", "bands").toDF("a", "ba"), "a").join(bands.select("node", "bands").toDF("b", "bb"), "b")
        .where(F.arrays_overlap("ba", "bb")).select("a", "b")
    )


def labelled(all_: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """(key, size, component_id) of every word sequence; all_ is what signed() made."""
    named = all_.where("key is not null and doc_id is not null")
    heads = named.groupBy("key").agg(F.min("doc_id").alias("first"), F.count("*").alias("size"))
    repeated = not named.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").isEmpty()
    node = F.col("first")
    if repeated:  # an id may have several texts, so that it can't tell nodes apart
        node = F.xxhash64("first", "key")
    heads = written(heads.withColumn("node", node), "heads")
    own = named.select("key", F.col("doc_id").alias("first"), F.col("n_shingles").cast("int").alias("n"), "bands")
    bands = own.join(heads, ["key", "first"]).select("node", "n", "bands")
    if repeated:
        bands = bands.dropDuplicates(["node"])
    bands = written(bands, "bands")
    spread = bands.select("node", "n", F.explode(F.array_distinct("bands")).alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("c")).where("c > 1")
    members = written(spread.join(shared, "bucket"), "members")
    # the text that others were made from agrees with most of them: it is in its group's largest buckets
    fame = members.groupBy("node").agg(F.sum("c").alias("fame"))
    best = F.max(F.struct("fame", (-F.col("node")).alias("node"), "n")).alias("best")
    leads = members.join(fame, "node").groupBy("bucket").agg(best)
    star = (
        members.join(leads.select("bucket", (-F.col("best.node")).alias("lead"), F.col("best.n").alias("m")), "bucket")
        .where((F.col("node") != F.col("lead")) & _sizes_fit(F.col("n"), F.col("m"), percent))
        .select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"))
    )
    sets = sets_of(members.select("node").distinct(), heads, docs, k, repeated)
    labels = components(confirmed(written(star.distinct(), "pairs"), sets, percent))
    placed = members.join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("comp"))
    more = confirmed(written(unsettled(placed, sets, bands, percent), "pairs"), sets, percent)
    if not more.isEmpty():
        across = (
            more.join(labels.toDF("a", "la"), "a", "left").join(labels.toDF("b", "lb"), "b", "left")
            .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b").distinct()
        )
        merged = components(written(across, "across"))
        labels = written(
            labels.join(merged.toDF("label", "top"), "label", "left").select("node", F.coalesce("top", "label").alias("label"))
            .union(merged.join(labels, "node", "left_anti")), "labels",
        )
    dropped(sets)
    out = heads.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    if repeated:
        least = out.groupBy("label").agg(F.min("first").alias("component_id"))
        out = out.join(least, "label")
    else:
        out = out.withColumn("component_id", F.col("label"))
    return written(out.select("key", "size", "component_id"), "keys")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """For every row: doc_id, n_shingles, component_id, kept."""
    all_ = written(signed(docs, k), "signed")
    keys = labelled(all_, docs, k, percent)
    rows = all_.select("doc_id", "n_shingles", "key")
    # a word sequence with many copies would be one task's; those are few, so they are sent to the rows
    often = F.lit(max(100, keys.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0] // HOT))
    hot = keys.where(F.col("size") > often).select("key", "component_id")
    cold = keys.where(F.col("size") <= often).select("key", "component_id")
    met = rows.where("key is not null").join(F.broadcast(hot), "key", "left")
    none = F.lit(None).cast("long").alias("component_id")
    out = (
        met.where("component_id is not null").select("doc_id", "n_shingles", "component_id")
        .union(
            met.where("component_id is null").select("doc_id", "n_shingles", "key").join(cold, "key", "left")
            .select("doc_id", "n_shingles", "component_id")
        )
        .union(rows.where("key is null").select("doc_id", "n_shingles", none))
    )
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def one_of_each(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each group of near-duplicates; all columns stay.

    Rows that repeat an id and its text stay once; an id of several texts goes only if all of them do."""
    judged = written(near_duplicates(docs, k, percent), "judged").where("doc_id is not null")
    repeated = not judged.groupBy("doc_id").agg(F.count("*").alias("c")).where("c > 1").isEmpty()
    gone = judged.where("not kept").select("doc_id")
    if repeated:
        gone = judged.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select("doc_id")
    gone = written(gone, "gone")
    few = gone.limit(SENT + 1).count() <= SENT
    left = docs.join(F.broadcast(gone) if few else gone, "doc_id", "left_anti").select(docs.columns)
    if not repeated:
        return left
    named = left.where("doc_id is not null").dropDuplicates(["doc_id", "text"])
    return named.union(left.where("doc_id is null"))
