"""Source-to-target reconciliation as set operations (anti joins and unions, no loops)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The issue codes.
CODES = (
    "SOURCE_WITHOUT_TERMINAL", "TARGET_WITHOUT_LINEAGE", "PRODUCED_LINEAGE_WITHOUT_TARGET",
    "TARGET_CONTENT_HASH_MISMATCH", "CHECKPOINT_AHEAD_OF_TERMINAL", "UNRESOLVED_BLOCKING_DLQ",
    "SCHEMA_DEFINITION_DRIFT", "DUPLICATE_TARGET_IDENTITY",
)


def missing(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right.select(*on), list(on), "left_anti")


def terminals(lineage: DataFrame, dead: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every source key with a lineage row or any dead letter, resolved ones too."""
    return lineage.select(*keys).unionByName(dead.select(*keys)).distinct()


def ahead(checkpoints: DataFrame, sources: DataFrame, terminal: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Checkpointed keys that are not both a source and terminal."""
    both = sources.select(*keys).join(terminal.select(*keys), list(keys), "left_semi").distinct()
    return missing(checkpoints, both, keys)


def issues(
    sources: DataFrame, targets: DataFrame, lineage: DataFrame, dead: DataFrame, checkpoints: DataFrame, drift: bool = False
) -> DataFrame:
    """code, key, target of every issue.

    sources: record_id, revision. targets: target_id, content_hash. lineage: record_id, revision,
    target_id, target_hash, decision (produced, skipped). dead: record_id, revision, blocking, status. checkpoints: record_id, revision."""
    keys = ["record_id", "revision"]
    key = F.concat_ws("\x1f", "record_id", F.col("revision").cast("string"))
    row = lambda df, code, k, t: df.select(F.lit(code).alias("code"), k.alias("key"), t.alias("target"))
    none = F.lit("")
    done = terminals(lineage, dead, keys)
    produced = lineage.where("decision = 'produced'")
    # the first target row of an id counts; the smallest hash where insertion order is unknown
    ids = targets.groupBy("target_id").agg(F.min("content_hash").alias("content_hash"), F.count("*").alias("n"))
    differing = lineage.join(ids, "target_id").where("target_hash <> content_hash").select("target_id").distinct()
    blocked = dead.where(F.col("blocking") & F.col("status").isin("open", "retrying"))
    parts = [
        row(missing(sources, done, keys), CODES[0], key, none),
        row(missing(ids, lineage.where("target_id is not null"), ["target_id"]), CODES[1], none, F.col("target_id")),
        row(missing(produced, targets, ["target_id"]), CODES[2], key, F.col("target_id")),
        row(differing, CODES[3], none, F.col("target_id")),
        row(ahead(checkpoints, sources, done, keys), CODES[4], key, none),
        row(blocked, CODES[5], key, none),
        row(ids.where("n > 1"), CODES[7], none, F.col("target_id")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if drift:
        out = out.unionByName(row(sources.sparkSession.range(1), CODES[6], none, none))
    return out.orderBy("code", "key", "target")


def summary(sources: DataFrame, found: DataFrame) -> DataFrame:
    """Counts and status: empty without sources, healthy without issues, else gap."""
    n = sources.agg(F.count("*").alias("sources"))
    m = found.agg(F.count("*").alias("issues"))
    status = F.when(F.col("sources") == 0, "empty").when(F.col("issues") == 0, "healthy").otherwise("gap")
    return n.crossJoin(m).withColumn("status", status)


def outcome_of_redelivery(df: DataFrame, keys: Sequence[str], content: str) -> DataFrame:
    """For each identity: accepted (one delivery), duplicate (equal contents) or conflict."""
    stats = df.groupBy(*keys).agg(
        F.count("*").alias("deliveries"), F.min(content).alias("_lo"), F.max(content).alias("_hi")
    )
    outcome = F.when(F.col("deliveries") == 1, "accepted").when(F.col("_lo") == F.col("_hi"), "duplicate").otherwise("conflict")
    return stats.select(*keys, "deliveries", outcome.alias("outcome"))


def difference(want: DataFrame, got: DataFrame) -> DataFrame:
    """Rows of one side only, as often as they exceed the other: side is missing or extra."""
    return want.exceptAll(got).withColumn("side", F.lit("missing")).unionByName(got.exceptAll(want).withColumn("side", F.lit("extra")))
