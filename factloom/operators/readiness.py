"""Readiness verdicts with reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terminal lifecycle states; the two spellings are distinct.
TERMINAL = ("completed", "failed", "cancelled", "canceled", "rejected", "expired")


def provider(facts: DataFrame, by: list[str]) -> DataFrame:
    """Per scope: conflict, not_ready, degraded or ready from its facts.

    facts: fact_id, fact_hash, fact_type, task_id, lifecycle_status, related (a relation touches the task),
    blocking_issue. Distinct counts are of small (scope, key, value) rows."""
    once = facts.groupBy(*by, "fact_id").agg(
        F.count_distinct("fact_hash").alias("hashes"), *(F.max(c).alias(c) for c in ("fact_type", "task_id", "lifecycle_status", "related", "blocking_issue"))
    )
    ends = F.col("fact_type").eqNullSafe("provider.task.lifecycle") & F.col("lifecycle_status").isin(*TERMINAL)
    tasks = once.groupBy(*by, "task_id").agg(
        F.count_distinct(F.when(ends & F.col("task_id").isNotNull(), F.col("lifecycle_status"))).alias("ends"),
        F.count("*").alias("facts"), F.max(F.col("hashes") > 1).alias("two_hashes"), F.max("related").alias("related"),
        F.max("blocking_issue").alias("blocked"), F.max(ends).alias("ended"),
        *(F.max(F.col("fact_type") == t).alias(n) for t, n in (
            ("provider.command.lifecycle", "command"), ("provider.execution.progress", "progress"), ("provider.resource.health", "health"))),
    )
    scope = tasks.groupBy(*by).agg(
        F.sum("facts").alias("facts"), F.max("ends").alias("ends"),
        *(F.coalesce(F.max(c), F.lit(False)).alias(c) for c in ("two_hashes", "related", "blocked", "ended", "command", "progress", "health")),
    )
    status = (
        F.when(F.col("blocked") | F.col("two_hashes") | (F.col("ends") > 1), "conflict")
        .when((F.col("facts") == 0) | ~F.col("related") | ~F.col("ended"), "not_ready")
        .when(~(F.col("command") & (F.col("progress") | F.col("health"))), "degraded")
        .otherwise("ready")
    )
    return scope.select(*by, "facts", status.alias("status"))


# Reason codes of set members, in the order in which they are looked for.
MEMBER_REASONS = (
    ("PROJECTION_MEMBER_MISSING", "observed is null"),
    ("PROJECTION_NOT_ACTIVE", "observed and lifecycle <> 'ACTIVE'"),
    ("SOURCE_EMPTY", "observed and source_count = 0"),
    ("TERMINAL_COVERAGE_INCOMPLETE", "observed and terminal_count < source_count"),
    ("BLOCKING_DLQ_OPEN", "observed and blocking_dlq > 0"),
    ("EPISODE_SEAL_UNVERIFIED", "observed and not seal_verified"),
)


def member_reasons() -> Column:
    """The reasons that hold for a set member joined (left) to what was observed of it."""
    return F.filter(F.array(*(F.when(F.expr(test), F.lit(code)) for code, test in MEMBER_REASONS)), lambda r: r.isNotNull())


def projection_set(members: DataFrame, observed: DataFrame, by: list[str], required_set: Column | None = None) -> DataFrame:
    """Per set: status and sorted reasons. members: by..., projection_id, position, requirement ('required' or
    'diagnostic'). observed: projection_id, lifecycle, source_count, terminal_count, blocking_dlq, seal_verified, drift.

    A diagnostic member that was observed adds DIAGNOSTIC_GAP when a reason, its own or of a member before
    it, is known. Any reason without a required member's gap is degraded."""
    seen = members.join(observed.withColumn("observed", F.lit(True)), "projection_id", "left").withColumn("own", member_reasons())
    drift = F.coalesce(F.col("drift"), F.lit(False)) | F.coalesce(F.col("lifecycle") == "BLOCKED_DRIFT", F.lit(False))
    gap = F.size("own") > 0
    sets = seen.groupBy(*by).agg(
        F.max(drift).alias("drift"),
        F.max(gap & (F.col("requirement") == "required")).alias("required_gap"),
        F.max(gap).alias("any_gap"),
        F.min(F.when(gap, F.col("position"))).alias("first_gap"),
        F.max(F.when((F.col("requirement") == "diagnostic") & F.col("observed"), F.col("position"))).alias("last_diagnostic"),
        F.array_distinct(F.flatten(F.collect_set("own"))).alias("own"),
    )
    note = F.col("last_diagnostic") >= F.col("first_gap")
    reasons = F.when(F.coalesce(note, F.lit(False)), F.array_union("own", F.array(F.lit("DIAGNOSTIC_GAP")))).otherwise(F.col("own"))
    wanted = F.lit(True) if required_set is None else required_set
    reasons = (
        F.when(~wanted, F.array(F.lit("DOMAIN_NOT_REQUIRED")))
        .when(F.col("drift"), F.array(F.lit("SCHEMA_CONTRACT_DRIFT")))
        .otherwise(reasons)
    )
    status = (
        F.when(~wanted, "not_required")
        .when(F.col("drift"), "blocked_drift").when(F.col("required_gap"), "not_ready")
        .when(F.col("any_gap"), "degraded").otherwise("ready")
    )
    return sets.select(*by, status.alias("status"), F.array_sort(reasons).alias("reasons"))
