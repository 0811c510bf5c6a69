"""A bounded, repeatable sample of labelled training rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remainder


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, modulus: int = 3, held: int = 1) -> DataFrame:
    """At most `rows` documents (doc_id, text, y) with a 0/1 label outside the held-out remainder.

    Rows are picked by a hash of the id, so the sample does not depend on how the tables are dealt.
    Only the chosen ids are broadcast; `rows` bounds them. Labels that disagree count as 1. Of rows that repeat
    an id the least text counts, so that the result has no more rows than `rows`, however often an id occurs."""
    chosen = (
        labels.select(F.col("doc_id").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & (remainder(F.col("doc_id"), modulus) != held))
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y"))
