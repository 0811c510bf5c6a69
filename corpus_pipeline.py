"""A corpus pipeline of five training-data operators.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
their documents, less the rows that they reject. Defined cases (nulls, empty and repeated rows, empty
tables) are those of the operators; columns that share a name with an operator's results pass through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import bpe, decontaminate, language, neardup, toxicity
from factloom.llm.common import table, written


def _where(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """The rows of docs for which `keep` holds of what `judge` appends."""
    names = {c: c if c in ("doc_id", "text") else f"_{i}_{c}" for i, c in enumerate(docs.columns)}
    judged = judge(docs.withColumnsRenamed(names)).where(keep)
    return judged.select(*(F.col(n).alias(c) for c, n in names.items()))


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language: texts that are null or have no letters. Profiles reject nothing."""
    profiles = language.train(docs)
    if not profiles.names:  # every text would be `und`
        return _where(docs, language.lettered, F.col("lettered"))
    return _where(docs, lambda d: language.identify(d, profiles), F.col("lang_pred") != "und")


def by_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents predicted toxic (score of 0.7 or more)."""
    model = toxicity.train(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return _where(docs, lambda d: toxicity.classify(d, model), F.col("predicted") == 0)


def by_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each group linked at 80 % of five-word shingles."""
    return neardup.one_of_each(docs, k=5, percent=80)


def by_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item."""
    leaked = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(leaked, "doc_id", "left_anti").select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of each document, as digests, and the digest of what they decode to."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.digests(bpe.encode_decode(docs.select("doc_id", "text"), path, public_tokenizers.PATTERN))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", by_language),
    ("toxicity", by_toxicity),
    ("near_duplicates", by_near_duplicates),
    ("decontamination", by_leaks),
    ("byte_bpe", encoded),
]

#: The classifiers and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
