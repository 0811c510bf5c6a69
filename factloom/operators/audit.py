"""Checks of catalogues, logs and stages: what a release or a replay is held against."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import paging

DESCRIPTOR = "object string, position int, name string, type string"


def descriptors(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row for each column of each table, from schemas alone."""
    rows = [(t, i + 1, f.name, f.dataType.simpleString()) for t, df in sorted(tables.items()) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, DESCRIPTOR)


def fingerprint(described: DataFrame) -> DataFrame:
    """One hash for each object over its columns in order."""
    column = F.concat_ws(" ", "name", "type")
    return described.groupBy("object").agg(
        F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("position", column.alias("c")))), lambda x: x.c), "\n"), 256).alias("hash"),
        F.count("*").alias("columns"),
    )


def difference(expected: DataFrame, found: DataFrame) -> DataFrame:
    """Columns that are missing, unexpected or changed; an empty result is a pass."""
    key = ["object", "name"]
    a = expected.select(*key, F.struct("position", "type").alias("want"))
    b = found.select(*key, F.struct("position", "type").alias("have"))
    fault = F.when(F.col("have").isNull(), "MISSING").when(F.col("want").isNull(), "UNEXPECTED").otherwise("CHANGED")
    return a.join(b, key, "full").where(~F.col("want").eqNullSafe(F.col("have"))).select(*key, fault.alias("fault"))


def shaped(df: DataFrame, fields: Sequence[str]) -> list[str]:
    """Faults of a view's shape, without running it: fields it lacks, and dotted names."""
    known = set(df.columns)
    return [f"missing {f}" for f in fields if f not in known] + [f"dotted {c}" for c in df.columns if "." in c]


def exactly(df: DataFrame, n: int, what: str) -> DataFrame:
    """One row with the count, or an error at run time when it is not `n`."""
    one = df.agg(F.count("*").alias("n"))
    return one.where(F.assert_true(F.col("n") == n, F.lit(f"{what}: expected {n} rows")).isNull())


def unused(rows: DataFrame, column: str, value: object) -> DataFrame:
    """One row: how often the value occurs, and whether it is free."""
    return rows.where(F.col(column) == F.lit(value)).agg(F.count("*").alias("n")).withColumn("free", F.col("n") == 0)


def stage_counts(stages: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Rows of each key at every stage, zero where it never came; `complete` where all stages hold exactly one."""
    parts: DataFrame | None = None
    for name, df in stages.items():
        own = df.select(*keys, *(F.lit(int(n == name)).alias(n) for n in stages))
        parts = own if parts is None else parts.union(own)
    done = None
    for n in stages:
        done = (F.col(n) == 1) if done is None else done & (F.col(n) == 1)
    return parts.groupBy(*keys).agg(*(F.sum(n).alias(n) for n in stages)).withColumn("complete", done)


def gate(rows: DataFrame, gate_id: str, passed: Column, expected: Iterable[object]) -> DataFrame:
    """One row: passes, open ids (sorted), and whether the ids are exactly the expected ones."""
    want = F.array_sort(F.array(*(F.lit(str(e)) for e in expected)))
    one = rows.agg(
        F.count_if(passed).alias("n_pass"), F.array_sort(F.collect_list(F.when(~passed, F.col(gate_id).cast("string")))).alias("open"),
        F.array_sort(F.collect_list(F.col(gate_id).cast("string"))).alias("ids"),
    )
    return one.select("n_pass", F.array_join("open", ",").alias("open_ids"), (F.col("ids") == want).alias("exact"))


def sealed_log(frames: DataFrame, partition: str, ordinal: str, body: Column, checksum: Column) -> DataFrame:
    """Each partition's frames and ordinals, or an error at run time where one has a gap or a bad checksum."""
    checked = frames.groupBy(partition).agg(
        F.count("*").alias("frames"), F.min(ordinal).alias("first"), F.max(ordinal).alias("last"),
        F.count_distinct(ordinal).alias("_ordinals"), F.count_if(~F.coalesce(F.sha2(body, 256) == checksum, F.lit(False))).alias("_bad"),
    )
    whole = (F.col("_bad") == 0) & (F.col("_ordinals") == F.col("frames")) & (F.col("last") - F.col("first") + 1 == F.col("frames"))
    return checked.where(F.assert_true(whole, F.lit("the log is torn or corrupt")).isNull()).drop("_ordinals", "_bad")


def replay(rows: DataFrame, scope: Mapping[str, object], cursor: Sequence[str], low: Sequence[object], high: Sequence[object], most: int = 1000) -> DataFrame:
    """Rows of one scope from cursor `low` to `high`, both included, in order; more than `most` are an error."""
    own = rows
    for name, value in scope.items():
        own = own.where(F.col(name) == F.lit(value))
    at = F.struct(*cursor)
    first, last = (F.struct(*(F.lit(v).cast(rows.schema[c].dataType) for c, v in zip(cursor, bound, strict=True))) for bound in (low, high))
    # the bounds on the first column alone reach the scan
    own = own.where(F.col(cursor[0]).between(*(F.lit(v).cast(rows.schema[cursor[0]].dataType) for v in (low[0], high[0]))))
    return paging.capped(own.where((at >= first) & (at <= last)), most).orderBy(*cursor)


def matched(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """One row: distinct keys on both sides; matched where neither side is empty."""
    a = left.agg(F.count_distinct(key).alias("sources"))
    b = right.agg(F.count_distinct(key).alias("facts"))
    return a.crossJoin(b).withColumn("matched", (F.col("sources") > 0) & (F.col("facts") > 0))  # one row each


def changed_after(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys whose rows differ between two readings (null-safe); empty where a replay left all as it was."""
    rest = [c for c in before.columns if c not in keys]
    a, b = (df.select(*keys, F.struct(*rest).alias(n)) for df, n in ((before, "_a"), (after, "_b")))
    return a.join(b, list(keys), "full").where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*keys)


def in_order(frames: DataFrame, partition: str, ordinal: str) -> DataFrame:
    """Frames with their place in their partition, from 1."""
    return frames.withColumn("place", F.row_number().over(Window.partitionBy(partition).orderBy(ordinal)))
