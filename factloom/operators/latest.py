"""Latest-version, conflict and status operators: grouped aggregates that combine before the shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row for each key: the one with the greatest `order`, ties by all other columns.

    max(struct) is a partial aggregate, so a hot key is reduced before the exchange; a row_number
    window would bring all its versions to one task first."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = df.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("_"))
    return best.select(*keys, *(F.col(f"_.{c}").alias(c) for c in [*order, *rest])).select(df.columns)


def latest_by(df: DataFrame, keys: Sequence[str], version: str, values: Sequence[str]) -> DataFrame:
    """The named values of the row with the greatest version; for versions unique within a key."""
    return df.groupBy(*keys).agg(
        F.max(version).alias(version), *(F.max_by(v, version).alias(v) for v in values)
    )


def conflicts(df: DataFrame, keys: Sequence[str], content: Column, where: Column | None = None) -> DataFrame:
    """Keys with more than one distinct content: the number of contents (exact)."""
    rows = df if where is None else df.where(where)
    distinct = rows.select(*keys, content.alias("_c")).distinct()  # one small row for each key and content
    return distinct.groupBy(*keys).agg(F.count("*").alias("n_contents")).where("n_contents > 1")


def histogram(df: DataFrame, column: str, values: Sequence[str], prefix: str = "n_") -> DataFrame:
    """One row of counts, zeros kept."""
    return df.agg(*(F.count_if(F.col(column) == v).alias(prefix + v) for v in values))


def with_watermark(df: DataFrame, column: str, name: str = "watermark") -> DataFrame:
    """Every row with the maximum of a column: an aggregate and a one-row join, no global window."""
    top = df.agg(F.max(column).alias(name))
    return df.crossJoin(F.broadcast(top))


def sequence_steps(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    """Each row with the step from its predecessor in the key; null for the first."""
    w = Window.partitionBy(*keys).orderBy(sequence)
    return df.withColumn("step", F.col(sequence) - F.lag(sequence).over(w))


def boundaries(df: DataFrame, keys: Sequence[str], sequence: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.min(sequence).alias("first_sequence"), F.max(sequence).alias("last_sequence"), F.count("*").alias("n_records")
    )
