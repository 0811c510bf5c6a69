"""The fixed query surface: routes over named tables, bounded results, envelopes and metrics text."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ident
from ..operators import latest, paging

MAX_ROWS = 10_000


@dataclass(frozen=True)
class Route:
    """A table, the columns a caller may filter on, the order of the result, its watermark column."""

    table: str
    filters: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    watermark: str = "projected_at"
    required: tuple[str, ...] = ()
    versions: tuple[tuple[str, ...], str] | None = None  #: keys and version of a table with re-deliveries
    fixed: str | None = field(default=None)  #: a predicate that always holds


_EVIDENCE = ("occurred_at", "length(evidence_sequence)", "evidence_sequence", "record_id")
_VERSION = (("record_type", "record_id", "row_id"), "projected_at")
ROUTES: dict[str, Route] = {
    "task_timeline": Route("evidence_canonical", ("task_id",), _EVIDENCE, required=("task_id",), versions=_VERSION),
    "task_capability_chain": Route(
        "evidence_canonical", ("task_id",), _EVIDENCE, required=("task_id",), versions=_VERSION,
        fixed="record_type LIKE 'capability.%' OR record_type LIKE 'node_control.capability%'",
    ),
    "provider_facts": Route("provider_facts", ("smpp_source_id", "external_task_id", "fact_type"), ("occurred_at", "fact_id"), versions=(("fact_id",), "projected_at")),
    "provider_fact": Route("provider_facts", ("fact_id",), ("occurred_at", "fact_id"), required=("fact_id",), versions=(("fact_id",), "projected_at")),
    "provider_relations": Route("entity_relations", ("relation_type", "source_entity_id", "target_entity_id"), ("valid_from", "relation_id"), versions=(("relation_id",), "projected_at")),
    "provider_task_timeline": Route("provider_facts", ("external_task_id",), ("occurred_at", "projected_at"), fixed="external_task_id IS NOT NULL"),
    "resource_state": Route("resource_current_state", ("smpp_source_id", "provider_id"), ("smpp_source_id", "provider_id", "resource_id")),
    "resource_health": Route("resource_current_health", ("smpp_source_id", "provider_id"), ("smpp_source_id", "provider_id", "resource_id")),
    "execution_progress": Route("execution_latest_progress", ("smpp_source_id", "provider_id"), ("smpp_source_id", "provider_id", "execution_id")),
    "task_reconciliation": Route("task_reconciliation", ("tenant_id", "project_id"), ("tenant_id", "project_id", "binding_id")),
    "projections": Route("domain_projections", (), ("projection_id", "projection_version")),
    "projection": Route("domain_projections", ("projection_id",), ("projection_id", "projection_version"), required=("projection_id",)),
    "projection_sets": Route("domain_projection_sets", (), ("set_id", "set_version")),
    "projection_set": Route("domain_projection_sets", ("set_id",), ("set_id", "set_version"), required=("set_id",)),
    "episode_readiness": Route("episode_domain_readiness", ("episode_key", "tenant_id", "project_id"), ("set_id",), required=("episode_key",)),
    "episode_facts": Route("episode_fact_index", ("canonical_episode_id", "tenant_id", "project_id"), ("occurred_at", "projection_id", "target_table", "target_record_id"), required=("canonical_episode_id",)),
    "projection_runs": Route("projection_runs", ("projection_id",), ("updated_at", "run_id")),
    "projection_checkpoints": Route("projection_checkpoints", ("projection_id", "tenant_id"), ("updated_at", "checkpoint_id")),
    "projection_lineage": Route("projection_lineage", ("projection_id", "source_record_id"), ("projected_at", "lineage_id")),
    "projection_dead_letters": Route("projection_dead_letters", ("projection_id", "status"), ("created_at", "dead_letter_id"), watermark="created_at"),
}


def run(spark: SparkSession, route: str, args: Mapping[str, object], most: int = MAX_ROWS, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The route's rows with a watermark column; unknown or missing arguments and overflow are errors."""
    r = ROUTES[route]
    unknown, absent = sorted(set(args) - set(r.filters)), sorted(set(r.required) - set(args))
    if unknown or absent:
        raise ValueError(f"{route}: unknown {unknown}, missing {absent}")
    rows = tables[r.table] if tables else spark.table(r.table)
    keep = F.lit(True)
    for name, value in args.items():
        keep = keep & (F.col(name) == F.lit(value))
    if r.fixed:
        keep = keep & F.expr(r.fixed)
    if r.versions:
        # keys of versions that meet the filters reach the scan; their last versions are then filtered once more
        keys = list(r.versions[0])
        met = rows.where(keep).select(*keys).distinct()
        rows = latest.latest(rows.join(met, keys, "left_semi"), keys, [r.versions[1]])
    rows = rows.where(keep)
    rows = paging.capped(rows, most)
    if r.watermark in rows.columns:
        rows = latest.with_watermark(rows, r.watermark, "query_watermark")
    return rows.orderBy(*map(F.expr, r.order)) if r.order else rows


def latest_per_resource(facts: DataFrame, fact_type: str, key: str) -> DataFrame:
    """Current state, health or progress: the last fact of a type for each source, provider and key."""
    keys = ["smpp_source_id", "provider_id", key]
    return latest.latest(facts.where(F.col("fact_type") == fact_type).where(F.col(key).isNotNull()), keys, ["occurred_at", "fact_id"])


def task_reconciliation(bindings: DataFrame, facts: DataFrame) -> DataFrame:
    """Bindings beside the last fact of their task in their own scope: status and revision mismatches of terminal tasks."""
    scope = [c for c in ("tenant_id", "project_id", "environment") if c in bindings.columns and c in facts.columns]
    last = facts.groupBy(F.col("external_task_id").alias("remote_task_id"), *scope).agg(
        F.max(F.struct("occurred_at", "lifecycle_status", "provider_revision", "projected_at")).alias("f")
    )
    both = bindings.join(last, ["remote_task_id", *scope], "left")
    return both.select(
        *bindings.columns, F.col("f.lifecycle_status").alias("fact_status"), F.col("f.provider_revision").alias("fact_revision"),
        F.coalesce(F.col("f.lifecycle_status") != F.col("status"), F.lit(False)).alias("status_mismatch"),
        F.coalesce(F.col("f.provider_revision") != F.col("revision"), F.lit(False)).alias("revision_mismatch"),
    )


def envelope(rows: DataFrame, watermark: str, now, coverage: list[str]) -> DataFrame:
    """One row: data (JSON array), as_of, watermark, lag and freshness, source coverage. Rows are capped before."""
    one = rows.agg(
        F.collect_list(F.to_json(F.struct(*(c for c in rows.columns if c != watermark)))).alias("data"),
        F.max(watermark).alias("watermark"), F.count_distinct(watermark).alias("n"),
    )
    lag = F.greatest(F.lit(0), F.unix_seconds(F.lit(now).cast("timestamp")) - F.unix_seconds(F.col("watermark").cast("timestamp")))
    return one.select(
        F.assert_true(F.col("n") <= 1, F.lit("the result holds several watermarks")).alias("_"),
        F.concat(F.lit("["), F.array_join("data", ","), F.lit("]")).alias("data"), F.lit(now).cast("timestamp").alias("as_of"),
        "watermark", F.when(F.col("watermark").isNotNull(), lag).alias("lag_seconds"),
        ident.freshness(F.when(F.col("watermark").isNotNull(), lag)).alias("freshness"),
        F.array(*map(F.lit, coverage)).alias("source_coverage"),
    ).drop("_")


def metric_lines(names: DataFrame, values: DataFrame, key: str, metric: str, label: str) -> DataFrame:
    """Metrics text: one line for each name, zero where no value is known."""
    joined = names.join(values, key, "left")
    return joined.select(
        F.concat(F.lit(f'{metric}{{{label}="'), ident.escaped_label(F.col(key)), F.lit('"} '), F.coalesce("value", F.lit(0)).cast("string")).alias("line")
    )
