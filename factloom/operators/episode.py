"""Episode closure: facts joined to authoritative bindings, origin claims, hints, status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCOPE = ("tenant_id", "project_id", "environment")


def matches(facts: DataFrame, bindings: DataFrame, on: Sequence[str], fact_id: str, instance: str | None = None) -> DataFrame:
    """Every fact with `n_matches` bindings and, where exactly one matched, its `binding_id`.

    Equal keys, and the same instance where the binding names one. Bindings are counted by their keys (and
    instance) before they meet facts, so a fact meets at most one row of each kind: nothing fans out or is regrouped."""
    counts = [F.count("binding_id").alias("n"), F.max("binding_id").alias("b")]
    f = facts.select(fact_id, *on, *([instance] if instance else []))
    free = bindings.where(F.col(instance).isNull()) if instance else bindings
    met = f.join(free.groupBy(*on).agg(*counts).withColumnsRenamed({"n": "_n0", "b": "_b0"}), list(on), "left")
    n, found = F.coalesce("_n0", F.lit(0)), F.col("_b0")
    if instance:
        keys = [*on, instance]
        own = bindings.where(F.col(instance).isNotNull()).groupBy(*keys).agg(*counts).withColumnsRenamed({"n": "_n1", "b": "_b1"})
        met = met.join(own, keys, "left")
        n, found = n + F.coalesce("_n1", F.lit(0)), F.coalesce("_b0", "_b1")
    return met.select(fact_id, *on, n.alias("n_matches"), F.when(n == 1, found).alias("binding_id"))


def claim_status(claims: Column, refs: Column) -> Column:
    """missing, unverifiable, matched, ambiguous or conflict; both sides are sets."""
    c, r = F.array_sort(F.array_distinct(claims)), F.array_sort(F.array_distinct(refs))
    return (
        F.when(F.size(c) == 0, "missing")
        .when(F.size(r) == 0, "unverifiable")
        .when(c == r, "matched")
        .when(F.size(F.array_intersect(c, r)) > 0, "ambiguous")
        .otherwise("conflict")
    )


STATUSES = ("matched", "missing", "unverifiable", "ambiguous", "conflict", "out_of_scope")


def claim_results(selected: DataFrame) -> DataFrame:
    """One row per fact and claim kind (runtime, task, invocation), or one out-of-scope task row.

    selected: fact_id, origin_system, and per kind arrays <kind>_claims and <kind>_refs."""
    foreign = F.col("origin_system").isNotNull() & (F.trim("origin_system") != "") & (F.lower(F.trim("origin_system")) != "sdar")
    empty = F.array().cast("array<string>")
    own = [
        F.struct(F.lit(k).alias("kind"), claim_status(F.coalesce(f"{k}_claims", empty), F.coalesce(f"{k}_refs", empty)).alias("status"))
        for k in ("runtime", "task", "invocation")
    ]
    outside = F.array(F.struct(F.lit("task").alias("kind"), F.lit("out_of_scope").alias("status")))
    return selected.select("fact_id", F.explode(F.when(foreign, outside).otherwise(F.array(*own))).alias("r")).select(
        "fact_id", "r.kind", "r.status"
    )


def hint_results(hints: DataFrame, selected: DataFrame) -> DataFrame:
    """Hints that cite a selected fact; one that claims authority it cannot have is a conflict."""
    own = hints.withColumn("_f", F.explode("evidence_fact_ids")).join(
        selected.select(F.col("fact_id").alias("_f")).distinct(), "_f", "left_semi"
    )
    bad = (F.col("authority") == "authoritative") & (F.lower(F.trim("producer_system")) != "sdar")
    return own.select("relation_id", F.when(bad, "conflict").otherwise("unverifiable").alias("status")).distinct()


def closure_status(counts: DataFrame) -> DataFrame:
    """counts: one row of foreign, truncated, conflict, ambiguous, bindings, unresolved, unverifiable."""
    blocking = (F.col("foreign") > 0) | F.col("truncated") | (F.col("conflict") > 0) | (F.col("ambiguous") > 0)
    status = (
        F.when(blocking, "conflict")
        .when((F.col("bindings") == 0) | (F.col("unresolved") > 0), "not_ready")
        .when(F.col("unverifiable") > 0, "degraded")
        .otherwise("ready")
    )
    return counts.withColumn("blocking", blocking).withColumn("status", status)


def close(facts: DataFrame, bindings: DataFrame, hints: DataFrame, on: Sequence[str], instance: str | None = None,
          most_items: int = 100_000, captured: tuple[int, int, int] | None = None) -> DataFrame:
    """One row: counts of the closure and its status. facts and bindings carry claim and ref arrays."""
    matched = matches(facts, bindings, on, "fact_id", instance)
    selected = matched.where("n_matches = 1")
    refs = bindings.select("binding_id", *(f"{k}_refs" for k in ("runtime", "task", "invocation")))
    full = selected.join(facts.select("fact_id", "origin_system", "runtime_claims", "task_claims", "invocation_claims"), "fact_id").join(refs, "binding_id")
    results = claim_results(full).select("status").unionByName(hint_results(hints, selected).select("status"))
    unresolved = bindings.join(selected.select("binding_id"), "binding_id", "left_anti")
    sizes = [df.agg(F.count("*").alias(n)) for df, n in ((bindings, "bindings"), (facts, "facts"), (hints, "hints"))]
    row = matched.agg(F.count_if(F.col("n_matches") == 1).alias("selected"), F.count_if(F.col("n_matches") != 1).alias("foreign"))
    row = row.crossJoin(results.agg(*(F.count_if(F.col("status") == s).alias(s) for s in STATUSES)))
    row = row.crossJoin(unresolved.agg(F.count("*").alias("unresolved")))
    for s in sizes:
        row = row.crossJoin(s)
    moved = F.lit(False)
    if captured is not None:
        moved = (F.col("bindings") != captured[0]) | (F.col("facts") != captured[1]) | (F.col("hints") != captured[2])
    over = (F.col("bindings") + F.col("facts") + F.col("hints")) > most_items
    return closure_status(row.withColumn("truncated", over | moved))


def consumer_gate(row: DataFrame) -> Column:
    return (
        (row["status"] == "ready") & (row["facts"] == row["selected"]) & (row["foreign"] == 0)
        & (row["unresolved"] == 0) & ~row["truncated"] & (row["hints"] == 0)
    )
