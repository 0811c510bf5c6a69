"""Evidence projections: a registry of predicates and row makers, fanned out to target tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ident


@dataclass(frozen=True)
class Projection:
    """`rows` turns the facts for which `supports` holds into rows of one table each (column target_table)."""

    id: str
    version: str
    supports: Column
    rows: Callable[[DataFrame], DataFrame]


@dataclass
class Registry:
    projections: list[Projection] = field(default_factory=list)

    def add(self, p: Projection) -> None:
        if any((q.id, q.version) == (p.id, p.version) for q in self.projections):
            raise ValueError(f"projection {p.id} {p.version} is registered twice")
        self.projections.append(p)

    def project(self, facts: DataFrame) -> DataFrame:
        """target_table, projection_id and the row as JSON, of every projection that supports a fact."""
        parts = []
        for p in self.projections:
            made = p.rows(facts.where(p.supports))
            body = F.to_json(F.struct(*(c for c in made.columns if c != "target_table")))
            parts.append(made.select("target_table", F.lit(p.id).alias("projection_id"), body.alias("row")))
        return reduce(DataFrame.unionByName, parts)


# Ids, tables and types of the evidence projections.
CANONICAL, LEGACY_TABLE = "sdar-evidence-v1-canonical", "legacy_fact"
SPECIALISED = {
    "node_control.capability_revision": "node_capability_version_fact",
    "node_control.a2a_exposure": "a2a_exposure_revision_fact",
    "node_control.agent_card_revision": "agent_card_revision_fact",
}
CANONICAL_ONLY = (
    "capability.definition", "capability.implementation_binding", "capability.readiness", "capability.a2a_exposure",
    "capability.agent_card_revision", "capability.task_binding", "capability.execution_attempt", "node_control.capability_readiness",
)
LEGACY_V14 = {
    "sdar.node_capability.version": "node_capability_version_fact",
    "sdar.node_capability.implementation_binding": "capability_implementation_binding_fact",
    "sdar.node_capability.readiness": "capability_readiness_fact",
    "sdar.a2a.exposure_revision": "a2a_exposure_revision_fact",
    "sdar.a2a.agent_card_revision": "agent_card_revision_fact",
    "sdar.task.capability_binding": "task_capability_binding_fact",
    "sdar.task.capability_attempt": "task_capability_attempt_fact",
}


def _routed(column: str, routes: dict[str, str]) -> Column:
    return F.create_map(*(F.lit(x) for kv in routes.items() for x in kv))[F.col(column)]


# Canonical names of the batch header.
_BATCH = {
    "batch_exportId": "export_id", "batch_sourceId": "source_id", "batch_nodeId": "batch_node_id", "batch_revision": "export_revision",
    "batch_firstSequence": "first_sequence", "batch_lastSequence": "last_sequence", "batch_batchHash": "batch_hash",
}


def snake(name: str) -> str:
    return "".join("_" + c.lower() if c.isupper() else c for c in name)


def canonical_rows(facts: DataFrame, received) -> DataFrame:
    """Canonical rows of evidence records: record columns in snake case, identity, batch and projection columns."""
    renamed = facts.select(*(F.col(c).alias(_BATCH.get(c) or snake(c)) for c in facts.columns if c != "batch_contractVersion"))
    record = ident.row_id(F.lit(CANONICAL), F.col("record_id"))
    return renamed.withColumns(
        {
            "row_id": record, "fact_id": F.col("record_id"), "payload_json": F.col("payload"),
            "occurred_at": ident.strict_utc(F.col("occurred_at")), "recorded_at": ident.strict_utc(F.col("recorded_at")),
            "received_at": F.lit(received).cast("timestamp"), "projected_at": F.lit(received).cast("timestamp"),
            "projection_id": F.lit(CANONICAL), "projection_version": F.lit("1.0.0"), "target_table": F.lit("evidence_canonical"),
            "ym": F.date_format(ident.strict_utc(F.col("occurred_at")), "yyyyMM"),
        }
    ).drop("payload")


def specialised_scope(node: Column) -> Column:
    """Facts without tenant, project, environment, node and payload hash give no specialised row."""
    filled = [F.coalesce(F.trim(c) != "", F.lit(False)) for c in (F.col("tenantId"), F.col("projectId"), F.col("environment"), node)]
    return reduce(lambda a, b: a & b, filled) & F.coalesce(ident.is_hash(F.col("payloadHash")), F.lit(False))


def specialised_rows(facts: DataFrame, required: dict[str, tuple[str, ...]]) -> DataFrame:
    """Rows of the specialised types whose payload holds every required key with a value."""
    node = F.coalesce("nodeId", "batch_nodeId")
    own = facts.where(F.col("recordType").isin(*SPECIALISED)).where(specialised_scope(node))
    complete = reduce(
        lambda a, b: a | b,
        [
            (F.col("recordType") == kind)
            & reduce(lambda a, b: a & b, [F.get_json_object("payload", f"$.{k}").isNotNull() for k in keys], F.lit(True))
            for kind, keys in required.items()
        ],
    )
    card = F.when(F.col("recordType") == "node_control.agent_card_revision", F.get_json_object("payload", "$.nodeId"))
    return own.where(complete).select(
        _routed("recordType", SPECIALISED).alias("target_table"),
        ident.shaped_uuid(F.col("recordId"), "sdar-evidence-v1-specialized").alias("fact_id"),
        F.col("recordId").alias("source_fact_id"), F.coalesce(card, node).alias("node_id"),
        F.col("tenantId").alias("tenant_id"), F.col("projectId").alias("project_id"), "environment",
        ident.bare_hash(F.col("payloadHash")).alias("payload_hash"), F.col("payload").alias("payload_json"),
        ident.strict_utc(F.col("occurredAt")).alias("occurred_at"),
    )


def legacy_rows(facts: DataFrame) -> DataFrame:
    """Legacy facts of the seven routed families; others go to the general legacy table."""
    return facts.withColumn("target_table", F.coalesce(_routed("recordFamily", LEGACY_V14), F.lit(LEGACY_TABLE)))


def coverage(record_types: DataFrame, column: str = "record_type") -> DataFrame:
    """Each type's coverage and the reason for it."""
    kind = F.col(column)
    special = kind.isin(*SPECIALISED)
    reason = F.when(special, "specialised").when(kind.isin(*CANONICAL_ONLY), "payload_lacks_columns").otherwise("no_specialised_table")
    return record_types.select(
        kind, F.when(special, "canonical+specialized").otherwise("canonical-only").alias("coverage"), reason.alias("reason")
    )


def by_table(projected: DataFrame, path: str) -> None:
    """Writes every target table as a folder of its own, sorted by the record within files."""
    projected.write.mode("append").partitionBy("target_table").parquet(path)


# Tables of the older contracts, and runtime families kept as summaries.
RUNTIME_TABLE, SUMMARY_TABLE, PROVIDER_TABLE = "sdar_core.runtime_fact", "sdar_core.runtime_capability_summary_fact", "sdar_core.smpp_provider_ops_fact"
SUMMARIES = ("sdar.runtime.capability_summary", "sdar.runtime.public_capability_card")
PROVIDER_SOURCE = "smpp-providerops-1.1.0"


def older_routes(facts: DataFrame) -> DataFrame:
    """Rows of older contracts with target_table and the column that names their kind there (kind_column, kind).

    facts: source_type, record_family, evidence (true for facts of the evidence contract, which don't go here).
    A provider's runtime fact goes to both tables; a fact of neither sort goes nowhere."""
    runtime = F.col("record_family").startswith("sdar.runtime.")
    summary = F.col("record_family").isin(*SUMMARIES)
    route = lambda table, column: F.struct(F.lit(table).alias("target_table"), F.lit(column).alias("kind_column"))
    routes = F.array_compact(
        F.array(
            F.when(runtime & summary, route(SUMMARY_TABLE, "summary_kind")),
            F.when(runtime & ~summary, route(RUNTIME_TABLE, "fact_type")),
            F.when(F.col("source_type") == PROVIDER_SOURCE, route(PROVIDER_TABLE, "record_type")),
        )
    )
    own = facts.where("not evidence").withColumn("_route", F.explode(routes))
    return own.select(*facts.columns, "_route.target_table", "_route.kind_column", F.col("record_family").alias("kind"))
