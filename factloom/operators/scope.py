"""Scopes and episodes: who may write for whom, and which facts belong to an episode's tasks."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ident

SCOPE = ("tenant_id", "project_id", "environment", "source_id")
_IDENTIFIER = re.compile(r"[A-Za-z_][A-Za-z0-9_.]*")


def safe_identifier(name: str) -> str:
    """The name if it can stand unquoted in SQL, else ValueError."""
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"unsafe SQL identifier: {name!r}")
    return name


def authorised(rows: DataFrame, sources: DataFrame, source: str = "source_id", tenant: str = "tenant_id") -> DataFrame:
    """Appends verdict: SOURCE_UNKNOWN (none or not enabled), CROSS_TENANT, or AUTHORISED ('*' stands for every tenant).

    sources: one row for each source id, with tenant_ids (array) and enabled."""
    known = sources.where("enabled").select(F.col("source_id").alias(source), "tenant_ids")
    fits = F.array_contains("tenant_ids", "*") | F.array_contains("tenant_ids", F.col(tenant))
    verdict = F.when(F.col("tenant_ids").isNull(), "SOURCE_UNKNOWN").when(fits, "AUTHORISED").otherwise("CROSS_TENANT")
    return rows.join(known, source, "left").withColumn("verdict", verdict).drop("tenant_ids")


def either(rows: DataFrame, keys: Mapping[str, object]) -> DataFrame:
    """Rows of which at least one of the named columns has its value."""
    if not keys:
        raise ValueError("no key given")
    found = F.lit(False)
    for name, value in keys.items():
        found = found | F.coalesce(F.col(name) == F.lit(value), F.lit(False))
    return rows.where(found)


def episode_facts(bindings: DataFrame, edges: DataFrame, facts: DataFrame, episode: str = "episode_id") -> DataFrame:
    """(episode, fact columns): facts cited by edges that touch a task of the episode, in the edge's own scope.

    bindings: episode, a2a_task_id, remote_task_id; edges: SCOPE, source_entity_id, target_entity_id,
    evidence_fact_ids; facts: SCOPE, fact_id. The join of facts is on all five keys."""
    tasks = bindings.select(episode, F.explode(F.array("a2a_task_id", "remote_task_id")).alias("task")).where("task is not null").distinct()
    ends = F.explode(F.array_distinct(F.array("source_entity_id", "target_entity_id"))).alias("task")
    cited = (
        edges.select(*SCOPE, "evidence_fact_ids", ends).join(tasks, "task")
        .select(episode, *SCOPE, F.explode(F.array_distinct("evidence_fact_ids")).alias("fact_id")).distinct()
    )
    return cited.join(facts, [*SCOPE, "fact_id"])


def assembled(bindings: DataFrame, relations: DataFrame, facts: DataFrame, episode: str = "episode_id") -> DataFrame:
    """(episode, fact columns) through relations whose source end is a bound task; each fact once for an episode.

    bindings: episode, task_id; relations: relation_id, source_entity_type, source_entity_id, evidence_fact_ids."""
    tasks = bindings.select(episode, F.col("task_id").alias("source_entity_id")).distinct()
    own = relations.where("source_entity_type = 'task'").join(tasks, "source_entity_id").dropDuplicates([episode, "relation_id"])
    cited = own.select(episode, F.explode("evidence_fact_ids").alias("fact_id")).distinct()
    return cited.join(facts, "fact_id")


def json_text(fields: Mapping[str, Column]) -> Column:
    """Canonical JSON of text fields: names in code unit order, no blanks."""
    return F.to_json(F.struct(*(fields[n].cast("string").alias(n) for n in sorted(fields))))


def binding_relation(bindings: DataFrame) -> DataFrame:
    """Appends the id of the relation that a binding (binding_id, episode_id, remote_task_id) stands for."""
    # The relation's type and authority.
    identity = {
        "relationType": F.lit("binds_provider_remote_task"), "bindingId": F.col("binding_id"), "episodeId": F.col("episode_id"),
        "remoteTaskId": F.col("remote_task_id"), "authoritySource": F.lit("sdar_core.remote_task_binding"),
    }
    return bindings.withColumn("relation_id", ident.prefixed_sha256(json_text(identity)))


def log_partition(fields: Mapping[str, Column]) -> Column:
    """The key of the log that a batch goes to: the hash of its identity fields."""
    return F.sha2(json_text(fields), 256)


def operational_id(kind: str, parts: Sequence[Column]) -> Column:
    """The repeatable id of a lineage or dead-letter row; parts: tenant, project, projection, version, record, revision, discriminator."""
    return ident.uuid5(F.concat_ws(ident.UNIT, F.lit(f"sdar-domain-{kind}-v1"), *(p.cast("string") for p in parts)))
