"""Bounded reads: keyset pages, look-back windows, caps that fail instead of cutting."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ResultTooLarge(RuntimeError):
    """A result exceeded its cap."""


def after(columns: Sequence[str], cursor: Sequence[Column]) -> Column:
    """(a, b, ...) > cursor, spelled so that its first comparison reaches the scan."""
    out = None
    for i in reversed(range(len(columns))):
        here = F.col(columns[i]) > cursor[i]
        out = here if out is None else here | ((F.col(columns[i]) == cursor[i]) & out)
    return (F.col(columns[0]) >= cursor[0]) & out


def keyset_page(df: DataFrame, keys: Sequence[str], cursor: Sequence[Column] | None, n: int) -> DataFrame:
    """The next n rows in key order after the cursor."""
    rows = df if cursor is None else df.where(after(keys, cursor))
    return rows.orderBy(*keys).limit(n)


def lookback(df: DataFrame, time: str, checkpoint: Column, back: Column, through: Column) -> DataFrame:
    """Rows within [checkpoint - back, through]."""
    return df.where(F.col(time).between(checkpoint - back, through))


def late(df: DataFrame, time: str, checkpoint: Column, back: Column) -> DataFrame:
    """How many rows lie before the look-back window and so are never read."""
    return df.where(F.col(time) < checkpoint - back).agg(F.count("*").alias("late_beyond_lookback"))


def capped(df: DataFrame, most: int) -> DataFrame:
    """The rows, or ResultTooLarge when there are more than `most`."""
    if df.limit(most + 1).count() > most:
        raise ResultTooLarge(f"more than {most} rows")
    return df


def trace(df: DataFrame, keys: Mapping[str, object], columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows that match every given key; a key may stand for any of several columns. No key is an error."""
    unknown = set(keys) - set(columns)
    if unknown or not keys:
        raise ValueError(f"unknown keys {sorted(unknown)}" if unknown else "at least one key is needed")
    tests = [reduce(lambda a, b: a | b, [F.col(c) == F.lit(v) for c in columns[k]]) for k, v in keys.items()]
    return df.where(reduce(lambda a, b: a & b, tests))
