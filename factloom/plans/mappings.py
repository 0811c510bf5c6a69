"""Domain mappings as tables of rules: source payload (JSON text) to typed target columns.

Each target is a list of rules in evaluation order. A rule reads one payload field and says which values
it takes; the first rule that a row breaks names the row's failure (`code:field`), so a mapping is one
projection without branches on rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import canonical as C
from ..functions import ident

MISSING, ENUM, LINK = "MAPPING_REQUIRED_FIELD_MISSING", "MAPPING_ENUM_UNSUPPORTED", "HMI_APPROVAL_ACTION_LINK_UNRESOLVED"


@dataclass(frozen=True)
class Rule:
    column: str | None  #: target column; None for a check alone
    field: str
    value: Callable[[Column], Column]
    good: Callable[[Column], Column]  #: of the raw value (null: absent or null)
    code: str = MISSING


def _raw(field: str) -> Column:
    return F.get_json_object("payload", f"$.{field}")


def _is_text(field: str) -> Column:
    """A JSON string, not a number or object that prints alike."""
    return F.col("_kinds")[field] == "string"


def text(column: str | None, field: str, code: str = MISSING) -> Rule:
    return Rule(column, field, lambda v: v, lambda v: v.isNotNull() & (F.trim(v) != "") & _is_text(field), code)


def any_text(column: str, field: str) -> Rule:
    return Rule(column, field, lambda v: v, lambda v: v.isNotNull() & _is_text(field))


def optional(column: str, field: str) -> Rule:
    return Rule(column, field, lambda v: F.coalesce(v, F.lit("")), lambda v: F.col("_kinds")[field].isNull() | _is_text(field))


def digest(column: str, field: str) -> Rule:
    return Rule(column, field, lambda v: v, lambda v: F.coalesce(ident.is_hash(v), F.lit(False)))


def one_of(column: str, field: str, *allowed: str) -> Rule:
    return Rule(column, field, lambda v: v, lambda v: F.coalesce(v.isin(*allowed), F.lit(False)), ENUM)


def instant(column: str | None, field: str, nullable: bool = False) -> Rule:
    absent = (lambda v: v.isNull()) if nullable else (lambda v: F.lit(False))
    return Rule(column, field, ident.strict_utc, lambda v: absent(v) | ident.strict_utc(v).isNotNull())


def whole(column: str | None, field: str, most: int = ident.U64_MAX, absent: bool = False, positive: bool = False) -> Rule:
    def good(v: Column) -> Column:
        ok = ident.unsigned(v, most)
        fine = ok.isNotNull() & (ok > 0) if positive else ok.isNotNull()
        return (v.isNull() | fine) if absent else fine

    return Rule(column, field, lambda v: ident.unsigned(v, most), good)


def flag(column: str, field: str) -> Rule:
    return Rule(column, field, lambda v: (v == "true").cast("int"), lambda v: F.coalesce(F.col("_kinds")[field] == "boolean", F.lit(False)))


def json_value(column: str, field: str, kind: str | None = None, default: str | None = None) -> Rule:
    good = lambda v: (F.col("_kinds")[field] == kind) if kind else v.isNotNull()
    if default is not None:
        return Rule(column, field, lambda v: F.coalesce(v, F.lit(default)), lambda v: F.col("_kinds")[field].isNull() | good(v))
    return Rule(column, field, lambda v: v, good)


def strings(column: str, field: str, absent: bool = False) -> Rule:
    array = lambda v: F.from_json(v, "array<string>")
    empty = lambda: F.array().cast("array<string>")
    good = lambda v: (v.isNull() if absent else F.lit(False)) | (F.coalesce(F.col("_kinds")[field] == "array", F.lit(False)))
    return Rule(column, field, lambda v: F.coalesce(array(v), empty()), good)


def fixed(column: str, value) -> Rule:
    return Rule(column, "", lambda v: F.lit(value), lambda v: F.lit(True))


def check(field: str, good: Callable[[], Column], code: str = MISSING) -> Rule:
    return Rule(None, field, lambda v: v, lambda v: F.coalesce(good(), F.lit(False)), code)


def _at(field: str) -> Column:
    return ident.strict_utc(_raw(field))


def _not_before(later: str, *earlier: str) -> Rule:
    return check(later, lambda: _at(later).isNull() | (_at(later) >= F.coalesce(*(_at(e) for e in earlier))))


# Target tables, their columns, the payload fields that fill them and the values they take.
ACTION = (
    text("target_id", "targetEntityId"), text(None, "targetEntityType"), text("action_id", "actionId"), text("device_id", "deviceId"),
    fixed("action_type", "device_control"), text("action_name", "actionName"), text("capability", "capabilityRef"),
    text("resource_channel", "resourceChannel"), text("risk_level", "riskLevel"), text("idempotency_key", "idempotencyKey"),
    digest("input_hash", "parametersHash"), fixed("side_effect", 1), text("execution_status", "dispatchStatus"),
    text("controller_ref", "controlAuthorityRef"), text("basis_id", "executionBasisRef"), any_text("input_summary", "inputSummary"),
)
RECEIPT = (
    text(None, "deviceId"), text(None, "resourceChannel"), text("receipt_id", "receiptId"), text("action_id", "actionId"),
    text("provider_id", "providerId"), optional("provider_request_id", "providerRequestId"), text("transport_status", "transportStatus"),
    text("acceptance_status", "acceptanceStatus"), text("execution_status", "executionStatus"), instant("received_at", "receivedAt"),
    optional("output_summary", "outputSummary"), optional("error_code", "errorCode"), optional("raw_response_ref", "rawResponseRef"),
    optional("observed_state_ref", "observedStateRef"), json_value("error_json", "error", "object", "{}"),
    json_value("metrics_json", "metrics", "array", "[]"),
)
CONFIRMATION = (
    text(None, "approvalId"), text("action_id", "actionId", LINK), instant("requested_at", "requestedAt"),
    instant("decided_at", "respondedAt", True), instant("valid_from", "validFrom", True), instant("valid_until", "expiresAt", True),
    instant(None, "invalidatedAt", True), _not_before("respondedAt", "requestedAt"), _not_before("validFrom", "requestedAt"),
    _not_before("expiresAt", "validFrom", "requestedAt"), _not_before("invalidatedAt", "validFrom", "requestedAt"),
    strings("invalidation_conditions", "invalidationConditions", True), optional("_reason", "invalidationReason"),
    text(None, "confirmationScope"), text("confirmation_id", "confirmationId"), fixed("subject_type", "action"),
    text("subject_id", "actionId"), one_of("confirmation_status", "decision", "approved", "rejected", "expired", "cancelled"),
    optional("decided_by", "approvedBy"), strings("evidence_refs", "evidenceRefs", True),
)
VERIFICATION = (
    text(None, "resourceChannel"), instant("device_timestamp", "deviceTimestamp"), instant("verified_at", "verifiedAt"),
    check("confirmationLatencyMs", lambda: _at("verifiedAt") >= _at("deviceTimestamp")),
    text("physical_verification_id", "physicalVerificationId"), text("verification_id", "verificationId"),
    text("criterion_id", "criterionId"), text("action_id", "actionId"), text("device_id", "deviceId"), text("capability", "capability"),
    text("verification_channel", "verificationChannel"), json_value("expected_json", "expected"), json_value("actual_json", "actual"),
    text("comparator", "comparator"), one_of("verification_result", "verificationResult", "passed", "failed", "inconclusive", "not_observed"),
    flag("critical", "critical"), whole("stable_duration_ms", "stableDurationMs", absent=True), optional("source_state_id", "sourceStateId"),
    strings("evidence_refs", "evidenceRefs"),
)
PREEMPTION = (
    text(None, "resourceChannel"), text("preemption_id", "preemptionId"),
    one_of("phase", "phase", "requested", "stopping", "stopped", "recovering", "resumed", "failed"), text("device_id", "deviceId"),
    text("trigger_type", "triggerType"), optional("trigger_event_id", "triggerEventId"), text("preempted_basis_id", "preemptedBasisId"),
    whole("preempted_basis_version", "preemptedBasisVersion", ident.U32_MAX), text("preempted_action_id", "preemptedActionId"),
    text("selected_basis_id", "recoveryBasisRef"), whole("selected_basis_version", "recoveryBasisVersion", ident.U32_MAX),
    text("selected_intent", "selectedIntent"), whole("required_deadline_ms", "requiredDeadlineMs", absent=True),
    whole("actual_latency_ms", "actualLatencyMs"), flag("stop_confirmed", "stopConfirmed"), text("recovery_strategy", "recoveryStrategy"),
    text("recovery_result", "recoveryResult"), optional("resumed_basis_id", "resumedBasisId"),
    whole("resumed_basis_version", "resumedBasisVersion", ident.U32_MAX, absent=True, positive=True),
)
FRESHNESS = (
    text(None, "stateSnapshotId"), text("state_field", "stateField"), text(None, "entityId"), text(None, "deviceId"),
    whole(None, "stateSnapshotVersion"), text(None, "thresholdPolicyId"), whole(None, "thresholdPolicyVersion"),
    instant("observed_at", "observedAt"), instant("checked_at", "evaluatedAt"), _not_before("evaluatedAt", "observedAt"),
    text("source_component", "sourceComponent"), whole("age_ms", "ageMs"), whole("max_allowed_age_ms", "thresholdMs"),
    one_of("check_result", "freshnessResult", "fresh", "stale", "unknown"), flag("conflict_detected", "conflictDetected"),
    flag("missing", "missing"),
)


@dataclass(frozen=True)
class Mapping:
    projection: str
    application: str
    contract: str
    target: str
    rules: tuple[Rule, ...]


# The ten projections.
MAPPINGS = (
    Mapping("DP-C01", "commander", "mcp-action", "control_action", ACTION),
    Mapping("DP-C02", "commander", "mcp-receipt", "control_receipt", RECEIPT),
    Mapping("DP-C03", "commander", "capability-track-sample", "physical_verification", VERIFICATION),
    Mapping("DP-C04", "commander", "error-recovery", "preemption_recovery", PREEMPTION),
    Mapping("DP-C05", "commander", "ugv-state-snapshot", "state_freshness_check", FRESHNESS),
    Mapping("DP-N01", "npc", "mission-tool-call", "control_action", ACTION),
    Mapping("DP-N02", "npc", "mcp-receipt", "control_receipt", RECEIPT),
    Mapping("DP-N03", "npc", "hmi-approval", "human_confirmation", CONFIRMATION),
    Mapping("DP-N04", "npc", "preemption-record", "preemption_recovery", PREEMPTION),
    Mapping("DP-N05", "npc", "blackboard-snapshot", "state_freshness_check", FRESHNESS),
)


def contract_id(m: Mapping) -> str:
    return f"sdar.domain-source/{m.application}/{m.contract}"


def _identity(kind: str, source: Column, application: Column) -> Column:
    return ident.uuid5(ident.canonical_name(F.col("tenantId"), F.col("projectId"), application, F.lit(kind), source))


def map_records(records: DataFrame, m: Mapping) -> DataFrame:
    """Rows of one contract with decision ('produce' or 'fail'), code, field, the common envelope and target columns.

    records: domain-source records whose payload is JSON text. A null payload value is read as absent."""
    own = records.where(F.col("sourceContractId") == contract_id(m))
    top = F.from_json("payload", "map<string,variant>")
    kind = F.transform_values(top, lambda k, v: F.schema_of_variant(v))
    named = F.transform_values(
        kind,
        lambda k, t: F.when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").when(t.startswith("ARRAY"), "array")
        .when(t.startswith("OBJECT"), "object").when(t != "VOID", "number"),
    )
    own = own.withColumn("_kinds", named)
    bad = [F.when(~F.coalesce(r.good(_raw(r.field)), F.lit(False)), F.lit(f"{r.code}:{r.field}")) for r in m.rules if r.field]
    own = own.withColumn("_bad", F.coalesce(*bad))
    app = F.lit(m.application)
    values = {r.column: r.value(_raw(r.field)) if r.field else r.value(F.lit(None)) for r in m.rules if r.column}
    if m.target == "control_action":
        canonical = C.canonical_column(
            F.to_json(F.struct(_raw("targetEntityId").alias("entityId"), _raw("targetEntityType").alias("entityType")))
        )
        values["target_json"] = canonical["text"]
    if m.target == "physical_verification":
        values["confirmation_latency_ms"] = F.unix_millis(_at("verifiedAt")) - F.unix_millis(_at("deviceTimestamp"))
    if m.target == "state_freshness_check":
        values["check_id"] = _identity("state_freshness_check", ident.derived_id(_raw("stateSnapshotId"), _raw("stateField")), app)
    if m.target == "human_confirmation":
        reason, conditions = values.pop("_reason"), values["invalidation_conditions"]
        values["invalidation_conditions"] = F.when((F.size(conditions) == 0) & (reason != ""), F.array(reason)).otherwise(conditions)
    episode = F.col("episodeId")
    # a state snapshot has one target for each field, so its target id is derived from both
    source = ident.derived_id(F.col("recordId"), _raw("stateField")) if m.target == "state_freshness_check" else F.col("recordId")
    envelope = {
        "tenant_id": F.col("tenantId"), "project_id": F.col("projectId"), "environment": F.col("environment"),
        "record_id": _identity(m.target, source, app), "episode_key": episode,
        "canonical_episode_id": _identity("episode", episode, app),
        "run_id": _identity("run", F.concat(F.lit("p1-default-run:"), F.trim(episode)), app),
        "segment_id": _identity("segment", F.concat(F.lit("p1-default-segment:"), F.trim(episode)), app),
        "agent_id": F.col("agentId"), "agent_type": app, "source_record_id": F.col("recordId"),
        "source_revision": ident.unsigned(F.col("sourceRevision")), "sequence": ident.unsigned(F.col("sequence")),
        "source_schema_name": F.col("sourceContractId"), "source_payload_hash": F.col("payloadHash"),
        "projection_id": F.lit(m.projection), "target_table": F.lit(m.target), "occurred_at": ident.strict_utc(F.col("occurredAt")),
    }
    fine = F.col("_bad").isNull()
    head = [
        F.when(fine, "produce").otherwise("fail").alias("decision"),
        F.split("_bad", ":")[0].alias("code"), F.split("_bad", ":")[1].alias("field"),
    ]
    out = own.select(*head, *(v.alias(n) for n, v in envelope.items()), *(F.when(fine, v).alias(n) for n, v in values.items()))
    payload = F.to_json(F.struct(*sorted(values)))
    return out.withColumn("payload_json", F.when(F.col("decision") == "produce", payload)).withColumn(
        "payload_sha256", F.sha2("payload_json", 256)
    )


def not_applicable(records: DataFrame) -> DataFrame:
    """Records of contracts that no mapping takes: decision 'skip' with its reason, and the columns closure needs."""
    known = F.col("sourceContractId").isin(*map(contract_id, MAPPINGS))
    own = records.where(~F.coalesce(known, F.lit(False)))
    absent = F.lit(None).cast("string")
    return own.select(
        F.col("recordId").alias("record_id"), ident.unsigned(F.col("sourceRevision")).alias("revision"), ident.unsigned(F.col("sequence")).alias("sequence"),
        F.lit("skip").alias("decision"), absent.alias("code"), absent.alias("field"), absent.alias("target_id"), absent.alias("target_hash"),
        F.col("payloadHash").alias("source_hash"), F.lit("SOURCE_NOT_APPLICABLE").alias("reason"), F.col("tenantId").alias("tenant_id"),
        F.col("projectId").alias("project_id"), F.col("episodeId").alias("episode_key"), F.lit("none").alias("projection_id"),
        absent.alias("target_table"), absent.alias("payload_json"),
    )


def seal_rows(seals: DataFrame, received) -> DataFrame:
    """Accepted episode seals as rows: scope, contract, counts as decimals, bare snapshot hash, payload text."""
    number = lambda n: ident.unsigned(F.col(n))
    return seals.select(
        "application", F.col("tenantId").alias("tenant_id"), F.col("projectId").alias("project_id"), "environment", F.col("sealId").alias("seal_id"),
        number("sealRevision").alias("seal_revision"), F.col("sourceContractId").alias("source_contract_id"),
        F.coalesce("sourceContractVersion", F.lit("")).alias("source_contract_version"), F.col("episodeId").alias("episode_id"),
        number("finalSequence").alias("final_sequence"), number("finalSourceRevision").alias("final_source_revision"),
        number("sourceRecordCount").alias("source_record_count"), ident.bare_hash(F.col("sourceSnapshotHash")).alias("source_snapshot_sha256"),
        F.col("sealStatus").alias("seal_status"), F.col("producerId").alias("producer_id"), F.col("producerVersion").alias("producer_version"),
        F.col("payload").alias("payload_json"), ident.strict_utc(F.col("sealedAt")).alias("sealed_at"), F.lit(received).cast("timestamp").alias("ingested_at"),
    )


def landing_rows(records: DataFrame, received, present: set[str] | None = None) -> dict[str, DataFrame]:
    """The ten source tables (or those of the contracts given): 21 common columns and the payload's text fields, by table name."""
    out = {}
    for m in MAPPINGS:
        if present is not None and contract_id(m) not in present:
            continue
        own = records.where(F.col("sourceContractId") == contract_id(m))
        blank = lambda n: F.coalesce(F.col(n), F.lit(""))
        common = [
            F.col("tenantId").alias("tenant_id"), F.col("projectId").alias("project_id"), "environment", F.col("recordId").alias("record_id"),
            F.col("episodeId").alias("episode_id"), blank("taskId").alias("task_id"), blank("contextId").alias("context_id"),
            F.col("agentId").alias("agent_id"), blank("agentVersion").alias("agent_version"), blank("scenarioId").alias("scenario_id"),
            blank("correlationId").alias("correlation_id"), "sequence", F.col("sourceRevision").alias("source_revision"),
            F.col("sourceContractId").alias("source_contract_id"), F.col("sourceContractVersion").alias("source_contract_version"),
            F.col("producerId").alias("producer_id"), F.col("producerVersion").alias("producer_version"),
            F.col("payload").alias("payload_json"), ident.bare_hash(F.col("payloadHash")).alias("payload_sha256"),
            ident.strict_utc(F.col("occurredAt")).alias("occurred_at"), F.lit(received).cast("timestamp").alias("ingested_at"),
        ]
        fields = dict.fromkeys(r.field for r in m.rules if r.field and r.field != "confirmationLatencyMs")
        out[f"{m.application}_{m.contract.replace('-', '_')}"] = own.select(*common, *(_raw(f).alias(f"p_{f}") for f in fields))
    return out
