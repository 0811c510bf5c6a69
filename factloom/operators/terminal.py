"""Terminal closure: what becomes of each decided source row, computed for all rows at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TARGET_CONFLICT, LINEAGE_CONFLICT = "TARGET_CONTENT_CONFLICT", "MAPPER_DETERMINISM_VIOLATION"


def outcome(decision: Column, old_target: Column, new_target: Column, old_lineage: Column, new_lineage: Column) -> Column:
    """produced, duplicate, skipped, failed or blocked. Old values are null where nothing was written yet."""
    differs = old_lineage.isNotNull() & (old_lineage != new_lineage)
    return (
        F.when(decision == "fail", "failed")
        .when((decision == "produce") & old_target.isNotNull() & (old_target != new_target), "blocked")
        .when(differs, "blocked")
        .when(decision == "skip", "skipped")
        .when(old_target.isNotNull(), "duplicate")
        .otherwise("produced")
    )


def failure_class(code: Column) -> Column:
    return (
        F.when(code == TARGET_CONFLICT, "content_conflict")
        .when(code == LINEAGE_CONFLICT, "implementation_error")
        .when(code.startswith("SOURCE_"), "data_contract")
        .otherwise("mapping_error")
    )


def contract_class(code: Column) -> Column:
    """The contract's own enumeration, beside the written class."""
    return F.when(code.isin(TARGET_CONFLICT, LINEAGE_CONFLICT), "blocking").otherwise("non_retryable")


def close(decided: DataFrame, targets: DataFrame, lineage: DataFrame) -> DataFrame:
    """decided: record_id, revision, decision, code, target_id, target_hash, source_hash, reason, ...

    Joined to what is already written (targets: target_id, content_hash; lineage: record_id, revision, tuple_hash),
    each row gets new_tuple, outcome, dlq_code, dlq_class and checkpoint_eligible. A target id with any
    stored hash other than the new one is a conflict, so stored hashes are reduced to their extremes first."""
    stored = targets.groupBy("target_id").agg(F.min("content_hash").alias("_lo"), F.max("content_hash").alias("_hi"))
    seen = lineage.groupBy("record_id", "revision").agg(F.max("tuple_hash").alias("_tuple"))
    new = F.sha2(F.to_json(F.struct("source_hash", "target_hash", "decision", "reason")), 256)
    rows = decided.withColumn("new_tuple", new).join(stored, "target_id", "left").join(seen, ["record_id", "revision"], "left")
    old = F.when(F.col("_lo") != F.col("target_hash"), F.col("_lo")).otherwise(F.col("_hi"))
    result = outcome(F.col("decision"), old, F.col("target_hash"), F.col("_tuple"), F.col("new_tuple"))
    conflict = (F.col("decision") == "produce") & old.isNotNull() & (old != F.col("target_hash"))
    code = (
        F.when(F.col("outcome") == "failed", F.col("code"))
        .when(conflict, TARGET_CONFLICT)
        .when(F.col("outcome") == "blocked", LINEAGE_CONFLICT)
    )
    return (
        rows.withColumn("outcome", result)
        .withColumn("dlq_code", code)
        .withColumn("dlq_class", F.when(code.isNotNull(), failure_class(code)))
        .withColumn("dlq_contract_class", F.when(code.isNotNull(), contract_class(code)))
        .withColumn("checkpoint_eligible", F.col("outcome") != "blocked")
        .drop("_lo", "_hi", "_tuple")
    )


def checkpoints(closed: DataFrame, keys: list[str]) -> DataFrame:
    """The row with the greatest sequence of each partition; `conflict` where that sequence has two contents."""
    token = F.sha2(F.concat_ws("|", "record_id", "source_hash", F.when(F.col("outcome") == "duplicate", "produced").otherwise(F.col("outcome"))), 256)
    rows = closed.where("checkpoint_eligible").withColumn("token", token)
    by_seq = rows.groupBy(*keys, "sequence").agg(
        F.max(F.struct("record_id", "source_hash", "token")).alias("at"), (F.min("token") != F.max("token")).alias("conflict"),
        F.count("*").alias("processed"),
        F.count_if(F.col("outcome") == "skipped").alias("skipped"), F.count_if(F.col("outcome") == "failed").alias("failed"),
    )
    last = by_seq.groupBy(*keys).agg(
        F.max("sequence").alias("sequence"), F.max_by(F.struct("at", "conflict"), "sequence").alias("x"),
        F.sum("processed").alias("processed"), F.sum("skipped").alias("skipped"), F.sum("failed").alias("failed"),
    )
    return last.select(*keys, "sequence", "x.at.record_id", "x.at.source_hash", "x.at.token", "x.conflict", "processed", "skipped", "failed")


def advance(stored: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Checkpoints after a batch: never back; an equal sequence with another token is a conflict."""
    s = stored.select(*keys, F.col("sequence").alias("_s"), F.col("token").alias("_t"))
    joined = new.join(s, keys, "left")
    same = F.col("sequence") == F.col("_s")
    return joined.where(F.col("_s").isNull() | (F.col("sequence") >= F.col("_s"))).withColumn(
        "conflict", F.col("conflict") | F.coalesce(same & (F.col("token") != F.col("_t")), F.lit(False))
    ).drop("_s", "_t")
