"""Contracts of incoming batches: schemas, acceptance codes, normalised facts.

A batch is one JSON text (one file or message). Acceptance is a vectorised check of whole texts, since
hashes cover them; what is accepted is parsed by explicit schemas and exploded by Spark."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import canonical as C
from ..functions import ident

MAX_RECORDS = 1000
# Contract names, applications, environments.
EVIDENCE_CONTRACT, DOMAIN_CONTRACT = "sdar.evidence/v1", "sdar.domain-source/v1"
DOMAIN_CONTRACTS = {
    "commander": ("mcp-action", "mcp-receipt", "capability-track-sample", "error-recovery", "ugv-state-snapshot"),
    "npc": ("mission-tool-call", "mcp-receipt", "hmi-approval", "preemption-record", "blackboard-snapshot"),
}
ENVIRONMENTS = ("dev", "test", "staging", "prod")
SEAL_STATES = ("sealed", "superseded", "invalid")
_DECIMAL = re.compile(r"0|[1-9][0-9]*")
_HASH = re.compile(r"sha256:[0-9a-f]{64}")
_UTC = re.compile(r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d{1,9})?Z")


def _fields(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(n, kind) for n in names.split()]


EVIDENCE_RECORD = T.StructType(
    _fields("contractVersion schemaName", T.StringType()) + _fields("schemaVersion", T.LongType())
    + _fields(
        "recordFamily recordType recordId sourceSystem sourceTable sourceRecordId sourceRevision tenantId userScopeId projectId "
        "environment taskId contextId episodeId runId goalId", T.StringType())
    + _fields("goalVersion", T.LongType()) + _fields("planId", T.StringType()) + _fields("planVersion", T.LongType())
    + _fields(
        "skillExecutionId capabilityBindingId remoteTaskBindingId nodeId correlationId causationId occurredAt recordedAt "
        "deliveryGuarantee evaluationRole", T.StringType())
    + _fields("observationGeneration", T.LongType()) + _fields("evidenceSequence", T.StringType())
    + _fields("evidenceRefs artifactRefs", T.ArrayType(T.StringType())) + _fields("payloadHash payload", T.StringType())
)
EVIDENCE_BATCH = T.StructType(
    _fields("contractVersion exportId sourceId nodeId", T.StringType()) + _fields("revision", T.LongType())
    + _fields("firstSequence lastSequence batchHash", T.StringType()) + _fields("records", T.ArrayType(EVIDENCE_RECORD))
)
DOMAIN_RECORD = T.StructType(
    _fields(
        "sourceContractId sourceContractVersion tenantId projectId environment recordId episodeId taskId contextId agentId "
        "agentVersion scenarioId correlationId sequence sourceRevision producerId producerVersion occurredAt payload payloadHash",
        T.StringType(),
    )
)
DOMAIN_BATCH = T.StructType(
    _fields("contractVersion batchId application firstSequence lastSequence batchHash", T.StringType())
    + _fields("records", T.ArrayType(DOMAIN_RECORD))
)
SEAL = T.StructType(
    _fields(
        "contractVersion application tenantId projectId environment sealId sealRevision sourceContractId episodeId finalSequence "
        "finalSourceRevision sourceRecordCount sourceSnapshotHash sealStatus producerId producerVersion payload sealedAt",
        T.StringType(),
    )
)
_OPTIONAL = {"taskId", "contextId", "agentVersion", "scenarioId", "correlationId"}


def _u64(text: object, positive: bool = False) -> bool:
    good = isinstance(text, str) and _DECIMAL.fullmatch(text) and int(text) <= ident.U64_MAX
    return bool(good) and not (positive and text == "0")


def application_of(contract: object) -> str | None:
    return next((a for a, names in DOMAIN_CONTRACTS.items() for n in names if contract == f"sdar.domain-source/{a}/{n}"), None)


def evidence_code(batch: object) -> str | None:
    """The first broken rule of an evidence batch, or None."""
    header = {"contractVersion", "exportId", "sourceId", "nodeId", "revision", "firstSequence", "lastSequence", "batchHash", "records"}
    if not isinstance(batch, dict) or set(batch) != header or batch["contractVersion"] != EVIDENCE_CONTRACT:
        return "EVIDENCE_SCHEMA_INVALID"
    records = batch["records"]
    if not isinstance(records, list) or not 1 <= len(records) <= MAX_RECORDS or not all(isinstance(r, dict) for r in records):
        return "EVIDENCE_SCHEMA_INVALID"
    try:
        if C.digest({k: v for k, v in batch.items() if k != "batchHash"}, C.EVIDENCE_BATCH) != batch["batchHash"]:
            return "EVIDENCE_BATCH_HASH_INVALID"
        last, ids = None, set()
        for r in records:
            if not isinstance(r.get("evidenceSequence"), str) or not _DECIMAL.fullmatch(r["evidenceSequence"]):
                return "EVIDENCE_SEQUENCE_INVALID"
            here = int(r["evidenceSequence"])
            if (last is not None and here <= last) or r.get("recordId") in ids:
                return "EVIDENCE_SEQUENCE_INVALID"
            last = here
            ids.add(r.get("recordId"))
            if C.digest(r.get("payload"), C.EVIDENCE) != r.get("payloadHash"):
                return "EVIDENCE_PAYLOAD_HASH_INVALID"
            if evidence_id(r) != r.get("recordId"):
                return "EVIDENCE_RECORD_ID_INVALID"
    except C.CanonicalError as e:
        return e.code
    ends = (records[0]["evidenceSequence"], records[-1]["evidenceSequence"])
    return None if ends == (batch["firstSequence"], batch["lastSequence"]) else "EVIDENCE_SEQUENCE_INVALID"


def evidence_id(r: dict) -> str:
    parts = [r.get(k) for k in ("sourceSystem", "sourceTable", "sourceRecordId", "sourceRevision", "schemaName", "schemaVersion")]
    return "evidence_" + C.digest(parts).removeprefix("sha256:")


def domain_code(batch: object) -> str | None:
    """The first broken rule of a domain-source batch, or None."""
    wrong = "DOMAIN_SOURCE_SCHEMA_INVALID"
    if not isinstance(batch, dict) or set(batch) != set(DOMAIN_BATCH.names) or batch["contractVersion"] != DOMAIN_CONTRACT:
        return wrong
    records = batch["records"]
    if not isinstance(records, list) or not 1 <= len(records) <= MAX_RECORDS or batch["application"] not in DOMAIN_CONTRACTS:
        return wrong
    known, needed = set(DOMAIN_RECORD.names), set(DOMAIN_RECORD.names) - _OPTIONAL
    if not all(isinstance(r, dict) and needed <= set(r) <= known and application_of(r["sourceContractId"]) for r in records):
        return wrong
    if not all(r["environment"] in ENVIRONMENTS and isinstance(r["payload"], dict) and _UTC.fullmatch(str(r["occurredAt"])) for r in records):
        return wrong
    last, seen, scope = None, set(), None
    for r in records:
        if not _u64(r["sequence"]) or not _u64(r["sourceRevision"], positive=True):
            return "DOMAIN_SOURCE_REVISION_INVALID"
        if last is not None and int(r["sequence"]) <= last:
            return "DOMAIN_SOURCE_SEQUENCE_INVALID"
        last = int(r["sequence"])
        own = (r["tenantId"], r["projectId"], r["environment"])
        scope = scope or own
        if application_of(r["sourceContractId"]) != batch["application"] or own != scope:
            return "DOMAIN_SOURCE_APPLICATION_MISMATCH"
        identity = (*own, r["sourceContractId"], r["recordId"], r["sourceRevision"])
        if identity in seen:
            return "DOMAIN_SOURCE_IDENTITY_DUPLICATE"
        seen.add(identity)
        try:
            if C.digest(r["payload"], C.DOMAIN) != r["payloadHash"]:
                return "DOMAIN_SOURCE_PAYLOAD_HASH_INVALID"
        except C.CanonicalError:
            return "DOMAIN_SOURCE_FINITE_JSON_REQUIRED"
    if (batch["firstSequence"], batch["lastSequence"]) != (records[0]["sequence"], records[-1]["sequence"]):
        return "DOMAIN_SOURCE_SEQUENCE_INVALID"
    signed = {k: v for k, v in batch.items() if k != "batchHash"}
    return None if C.digest(signed) == batch["batchHash"] else "DOMAIN_SOURCE_BATCH_HASH_INVALID"


def seal_code(seal: object) -> str | None:
    known = set(SEAL.names) | {"sourceContractVersion"}
    if not isinstance(seal, dict) or not set(SEAL.names) <= set(seal) <= known or seal["contractVersion"] != DOMAIN_CONTRACT:
        return "DOMAIN_SOURCE_SCHEMA_INVALID"
    if seal["sealStatus"] not in SEAL_STATES or not _HASH.fullmatch(str(seal["sourceSnapshotHash"])):
        return "DOMAIN_SOURCE_SCHEMA_INVALID"
    good = _u64(seal["sealRevision"], True) and all(_u64(seal[k]) for k in ("finalSequence", "finalSourceRevision", "sourceRecordCount"))
    if not good:
        return "DOMAIN_SOURCE_REVISION_INVALID"
    return None if application_of(seal["sourceContractId"]) == seal["application"] else "DOMAIN_SOURCE_APPLICATION_MISMATCH"


def legacy_code(batch: object) -> str | None:
    """The minimal check of legacy batches."""
    if not isinstance(batch, dict) or not batch.get("sourceId"):
        return "TEL-ING-001"
    if not isinstance(batch.get("records"), list) or not batch["records"]:
        return "TEL-ING-002"
    return None if all(isinstance(r, dict) and r.get("sourceRecordId") for r in batch["records"]) else "TEL-ING-003"


def code_column(raw: Column, check: Callable[[object], str | None], broken: str) -> Column:
    """The first broken rule of each JSON text, or null; `broken` for texts that are not JSON."""

    def one(text: str | None) -> str | None:
        try:
            return check(json.loads(text)) if text is not None else broken
        except ValueError:
            return broken

    @F.pandas_udf(T.StringType())
    def run(col: pd.Series) -> pd.Series:
        return pd.Series([one(x) for x in col], dtype=object)

    return run(raw)


def evidence_batches(raw: DataFrame, column: str = "value") -> DataFrame:
    """raw, code and the parsed batch (null where refused)."""
    code = code_column(F.col(column), evidence_code, "EVIDENCE_SCHEMA_INVALID")
    rows = raw.withColumn("code", code)
    return rows.withColumn("batch", F.when(F.col("code").isNull(), F.from_json(column, EVIDENCE_BATCH)))


def domain_batches(raw: DataFrame, column: str = "value") -> DataFrame:
    code = code_column(F.col(column), domain_code, "DOMAIN_SOURCE_SCHEMA_INVALID")
    rows = raw.withColumn("code", code)
    return rows.withColumn("batch", F.when(F.col("code").isNull(), F.from_json(column, DOMAIN_BATCH)))


def seals(raw: DataFrame, column: str = "value") -> DataFrame:
    """raw, code and the parsed episode seal (null where refused)."""
    code = code_column(F.col(column), seal_code, "DOMAIN_SOURCE_SCHEMA_INVALID")
    schema = SEAL if "sourceContractVersion" in SEAL.names else T.StructType([*SEAL.fields, T.StructField("sourceContractVersion", T.StringType())])
    rows = raw.withColumn("code", code)
    return rows.withColumn("seal", F.when(F.col("code").isNull(), F.from_json(column, schema)))


def evidence_facts(batches: DataFrame) -> DataFrame:
    """Accepted batches as one row per record, with the batch's header."""
    own = batches.where("code is null").select(
        *(F.col(f"batch.{n}").alias(f"batch_{n}") for n in EVIDENCE_BATCH.names if n != "records"), F.explode("batch.records").alias("r")
    )
    return own.select("r.*", *(c for c in own.columns if c != "r"))


def domain_records(batches: DataFrame) -> DataFrame:
    own = batches.where("code is null").select(
        F.col("batch.batchId").alias("batchId"), F.col("batch.application").alias("application"), F.explode("batch.records").alias("r")
    )
    return own.select("batchId", "application", "r.*")


def legacy_facts(records: DataFrame) -> DataFrame:
    """Legacy records with their derived fact id (a digest of source, record, family and payload hash)."""
    name = F.to_json(F.struct("payloadHash", "recordFamily", "sourceId", "sourceRecordId"))
    return records.withColumn("fact_id", F.concat(F.lit("legacy_"), F.sha2(name, 256)))


def provider_records(operations: DataFrame) -> DataFrame:
    """Provider operations as legacy records, with the adapter's defaults."""
    have = set(operations.columns)
    default = lambda n, v: F.coalesce(F.col(n), v) if n in have else v
    return operations.withColumns(
        {
            "recordFamily": default("recordFamily", F.lit("smpp.provider.operation")),
            "tenantId": default("tenantId", F.lit("default")),
            "occurredAt": default("occurredAt", F.current_timestamp().cast("string")),
        }
    )


def ingest_conflicts(new: DataFrame, seen: DataFrame, identity: list[str], content: str, sequence: str) -> DataFrame:
    """Every new row with its verdict against what a partition holds: accepted, duplicate, identity_conflict or sequence_conflict."""
    by_id = seen.groupBy(*identity).agg(F.max(content).alias("_content"), F.max(sequence).alias("_sequence"))
    by_seq = seen.groupBy(sequence).agg(F.max(F.sha2(F.concat_ws("|", *identity), 256)).alias("_owner"))
    rows = new.join(by_id, identity, "left").join(by_seq, sequence, "left")
    verdict = (
        F.when(F.col("_content").isNotNull() & (F.col("_content") != F.col(content)), "identity_conflict")
        .when(F.col("_sequence").isNotNull() & (F.col("_sequence") != F.col(sequence)), "sequence_conflict")
        .when(F.col("_content").isNull() & F.col("_owner").isNotNull(), "sequence_conflict")
        .when(F.col("_content").isNotNull(), "duplicate")
        .otherwise("accepted")
    )
    return rows.withColumn("verdict", verdict).drop("_content", "_sequence", "_owner")


def seal_completeness(records: DataFrame, seals: DataFrame) -> DataFrame:
    """Per sealed episode and contract: whether count and last sequence match the latest seal."""
    keys = ["tenantId", "projectId", "environment", "sourceContractId", "episodeId"]
    last = seals.groupBy(*keys).agg(F.max_by(F.struct("finalSequence", "sourceRecordCount", "sealStatus"), ident.sequence_key(F.col("sealRevision"))).alias("s"))
    found = records.groupBy(*keys).agg(F.count("*").alias("n"), F.max(ident.sequence_key(F.col("sequence"))).alias("last"))
    joined = last.join(found, keys, "left")
    match = (
        (F.col("s.sealStatus") == "sealed")
        & (F.coalesce("n", F.lit(0)) == F.col("s.sourceRecordCount").cast("long"))
        & (F.col("last") == ident.sequence_key(F.col("s.finalSequence")))
    )
    return joined.select(*keys, F.coalesce(match, F.lit(False)).alias("seal_verified"))
