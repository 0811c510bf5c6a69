import json
import os

import pytest
from pyspark.sql import functions as F

from factloom.functions import canonical as C
from factloom.plans import mappings as M
from factloom.plans import projections as P
from factloom.sources import contracts as K
from factloom.streaming import lanes

APPROVAL = {
    "confirmationId": "c", "approvalId": "a", "actionId": "x", "decision": "approved", "requestedAt": "2024-01-01T00:00:00Z",
    "confirmationScope": "one", "invalidationReason": "moved",
}
RECEIPT = {
    "deviceId": "d", "resourceChannel": "m", "receiptId": "r", "actionId": "x", "providerId": "p", "transportStatus": "ok",
    "acceptanceStatus": "ok", "executionStatus": "ok", "receivedAt": "2024-01-01T00:00:00.5Z",
}


def record(sequence, contract, payload, **extra):
    return {
        "sourceContractId": f"sdar.domain-source/npc/{contract}", "sourceContractVersion": "1", "tenantId": "t", "projectId": "p",
        "environment": "test", "recordId": f"r{sequence}", "episodeId": "e", "agentId": "g", "sequence": str(sequence),
        "sourceRevision": "1", "producerId": "q", "producerVersion": "1", "occurredAt": "2024-01-01T00:00:00Z",
        "payload": payload, "payloadHash": C.digest(payload, C.DOMAIN), **extra,
    }


def batch(*records, **extra):
    body = {
        "contractVersion": K.DOMAIN_CONTRACT, "batchId": "b", "application": "npc", "firstSequence": records[0]["sequence"],
        "lastSequence": records[-1]["sequence"], "records": list(records), **extra,
    }
    return {**body, "batchHash": C.digest(body)}


def test_domain_rules():
    a, b = record(1, "hmi-approval", APPROVAL), record(2, "mcp-receipt", RECEIPT)
    assert K.domain_code(batch(a, b)) is None
    assert K.domain_code(batch(b, a)) == "DOMAIN_SOURCE_SEQUENCE_INVALID"
    assert K.domain_code(batch(a, {**b, "recordId": "r1", "sourceContractId": a["sourceContractId"]})) == "DOMAIN_SOURCE_IDENTITY_DUPLICATE"
    assert K.domain_code(batch(a, {**b, "payloadHash": "sha256:" + "0" * 64})) == "DOMAIN_SOURCE_PAYLOAD_HASH_INVALID"
    assert K.domain_code({**batch(a), "batchHash": "x"}) == "DOMAIN_SOURCE_BATCH_HASH_INVALID"
    assert K.domain_code(batch(a, firstSequence="0")) == "DOMAIN_SOURCE_SEQUENCE_INVALID"
    assert K.domain_code(batch({**a, "sourceRevision": "01"})) == "DOMAIN_SOURCE_REVISION_INVALID"
    assert K.domain_code(batch(a, application="commander")) == "DOMAIN_SOURCE_APPLICATION_MISMATCH"
    assert K.domain_code(batch(*(record(i, "hmi-approval", APPROVAL) for i in range(1001)))) == "DOMAIN_SOURCE_SCHEMA_INVALID"
    assert K.domain_code([]) == "DOMAIN_SOURCE_SCHEMA_INVALID"


def evidence(*sequences):
    records = []
    for s in sequences:
        r = {
            "schemaName": "n", "schemaVersion": 1, "recordFamily": "f", "recordType": "runtime.episode", "sourceSystem": "s",
            "sourceTable": "t", "sourceRecordId": f"x{s}", "sourceRevision": "1", "environment": "test", "occurredAt": "2024-01-01T00:00:00Z",
            "recordedAt": "2024-01-01T00:00:00Z", "evidenceSequence": s, "payload": {"k": s}, "payloadHash": C.digest({"k": s}, C.EVIDENCE),
        }
        records.append({**r, "recordId": K.evidence_id(r)})
    body = {
        "contractVersion": K.EVIDENCE_CONTRACT, "exportId": "e", "sourceId": "s", "nodeId": "n", "revision": 1,
        "firstSequence": sequences[0], "lastSequence": sequences[-1], "records": records,
    }
    return {**body, "batchHash": C.digest(body, C.EVIDENCE_BATCH)}


def test_evidence_rules():
    good = evidence("9", "10", "400")  # gaps are legal, order is numeric
    assert K.evidence_code(good) is None
    assert K.evidence_code(evidence("10", "9")) == "EVIDENCE_SEQUENCE_INVALID"
    assert K.evidence_code(evidence("01")) == "EVIDENCE_SEQUENCE_INVALID"
    assert K.evidence_code({**good, "nodeId": "other"}) == "EVIDENCE_BATCH_HASH_INVALID"
    assert K.evidence_code({**good, "more": 1}) == "EVIDENCE_SCHEMA_INVALID"


def rows(spark, *records):
    flat = [{**r, "payload": json.dumps(r["payload"])} for r in records]
    return spark.createDataFrame([tuple(r.get(n) for n in K.DOMAIN_RECORD.names) for r in flat], K.DOMAIN_RECORD)


def mapping(projection):
    return next(m for m in M.MAPPINGS if m.projection == projection)


def test_confirmation_folds_its_reason(spark):
    got = M.map_records(rows(spark, record(1, "hmi-approval", APPROVAL)), mapping("DP-N03")).first()
    assert got.decision == "produce" and got.invalidation_conditions == ["moved"] and got.decided_at is None


@pytest.mark.parametrize(
    ("change", "code", "field"),
    [
        ({"actionId": " "}, M.LINK, "actionId"),
        ({"decision": "maybe"}, M.ENUM, "decision"),
        ({"respondedAt": "2023-01-01T00:00:00Z"}, M.MISSING, "respondedAt"),
        ({"requestedAt": "2024-02-30T00:00:00Z"}, M.MISSING, "requestedAt"),
        ({"confirmationId": 5}, M.MISSING, "confirmationId"),
        ({"approvalId": "", "actionId": ""}, M.MISSING, "approvalId"),  # the first broken rule is named
    ],
)
def test_mapping_failures(spark, change, code, field):
    got = M.map_records(rows(spark, record(1, "hmi-approval", {**APPROVAL, **change})), mapping("DP-N03")).first()
    assert (got.decision, got.code, got.field, got.action_id) == ("fail", code, field, None)


def put(folder, name, value):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(value if isinstance(value, str) else json.dumps(value))


def test_domain_lane_closes_once(spark, tmp_path):
    a, b = record(1, "hmi-approval", APPROVAL), record(2, "mcp-receipt", {**RECEIPT, "receivedAt": "never"})
    source, root, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    put(source, "1.json", batch(a, b))
    put(source, "2.json", "not json")
    lanes.domain_lane(spark, source, root, mark).awaitTermination()
    count = lambda t: spark.read.parquet(f"{root}/{t}").count()
    assert [count(t) for t in ("targets", "lineage", "dead_letters", "checkpoints", "rejects")] == [1, 1, 1, 2, 1]
    put(source, "3.json", batch(a, b))  # a repeated delivery gives no new target
    lanes.domain_lane(spark, source, root, mark).awaitTermination()
    assert count("targets") == 1
    # running a micro-batch again leaves the same rows
    again = K.domain_batches(spark.createDataFrame([(json.dumps(batch(a, b)),)], "value string"))
    lanes.close_batch(K.domain_records(again), root, 0)
    assert count("targets") == 1
    changed = record(1, "hmi-approval", {**APPROVAL, "decision": "rejected"})
    blocked = K.domain_batches(spark.createDataFrame([(json.dumps(batch(changed)),)], "value string"))
    assert {r.outcome: r.n for r in lanes.close_batch(K.domain_records(blocked), root, 9).collect()} == {"blocked": 1}


def test_evidence_lane_is_idempotent(spark, tmp_path):
    source, root, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    put(source, "1.json", evidence("1", "2"))
    lanes.evidence_lane(spark, source, root, mark).awaitTermination()
    put(source, "2.json", evidence("1", "2"))
    lanes.evidence_lane(spark, source, root, mark).awaitTermination()
    rows = spark.read.parquet(f"{root}/evidence_canonical")
    assert rows.count() == 2 and rows.select("ym").distinct().count() == 1


def test_checkpoints_never_go_back(spark, tmp_path):
    root = str(tmp_path / "out")
    close = lambda n, *records: lanes.close_batch(K.domain_records(K.domain_batches(spark.createDataFrame([(json.dumps(batch(*records)),)], "value string"))), root, n)
    late, early = record(5, "hmi-approval", APPROVAL), record(2, "hmi-approval", {**APPROVAL, "confirmationId": "other"})
    close(0, late)
    close(1, early)  # a lower sequence writes its target, not a checkpoint
    rows = spark.read.parquet(f"{root}/checkpoints")
    assert [int(r.sequence) for r in rows.collect()] == [5] and spark.read.parquet(f"{root}/targets").count() == 2
    other = {**record(5, "hmi-approval", {**APPROVAL, "confirmationId": "third"}), "recordId": "someone-else"}
    with pytest.raises(lanes.ContentConflict, match="CHECKPOINT"):
        close(2, other)
    assert spark.read.parquet(f"{root}/targets").count() == 2


def test_contracts_without_a_mapping_are_skipped(spark):
    own = rows(spark, {**record(1, "hmi-approval", APPROVAL), "sourceContractId": "sdar.domain-source/npc/unheard-of"})
    got = M.not_applicable(own).first()
    assert (got.decision, got.reason, got.target_id) == ("skip", "SOURCE_NOT_APPLICABLE", None)
    assert M.not_applicable(rows(spark, record(1, "hmi-approval", APPROVAL))).count() == 0


def test_lookback_deduplication_streams(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(20).select((F.col("id") % 10).alias("id"), F.timestamp_seconds(1000 + F.col("id") % 10).alias("ts")).write.parquet(path)
    stream = spark.readStream.schema("id long, ts timestamp").parquet(path)
    q = lanes.deduplicated(stream, "ts", ["id"]).writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("once").count() == 10


def test_torn_log_keeps_its_valid_prefix(spark):
    ok = lambda p, o: (p, o, f"{p}{o}", None)
    frames = spark.createDataFrame([ok("a", 0), ok("a", 1), ok("a", 2), ok("b", 0), ok("b", 2)], "p string, o int, body string, sum string")
    frames = frames.withColumn("sum", F.when((F.col("p") == "a") & (F.col("o") == 1), "bad").otherwise(F.sha2("body", 256)))
    assert sorted((r.p, r.o) for r in lanes.torn_prefix(frames, "p", "o", "body", "sum").collect()) == [("a", 0), ("b", 0)]


def test_registry_and_coverage(spark):
    registry = P.Registry()
    one = P.Projection("all", "1", F.lit(True), lambda d: d.select(F.lit("t").alias("target_table"), "k"))
    registry.add(one)
    registry.add(P.Projection("even", "1", F.col("k") % 2 == 0, lambda d: d.select(F.lit("u").alias("target_table"), "k")))
    with pytest.raises(ValueError):
        registry.add(one)
    got = registry.project(spark.range(4).toDF("k")).groupBy("target_table").count().collect()
    assert {r.target_table: r["count"] for r in got} == {"t": 4, "u": 2}
    kinds = spark.createDataFrame([(k,) for k in ("node_control.a2a_exposure", "capability.readiness", "x")], "record_type string")
    assert [r.coverage for r in P.coverage(kinds).collect()] == ["canonical+specialized", "canonical-only", "canonical-only"]


def test_seals(spark):
    records = spark.createDataFrame([("t", "p", "test", "c", "e", "9"), ("t", "p", "test", "c", "e", "10")], "tenantId string, projectId string, environment string, sourceContractId string, episodeId string, sequence string")
    seals = spark.createDataFrame(
        [("t", "p", "test", "c", "e", "2", "10", "2", "sealed"), ("t", "p", "test", "c", "e", "1", "9", "1", "sealed")],
        "tenantId string, projectId string, environment string, sourceContractId string, episodeId string, sealRevision string, finalSequence string, sourceRecordCount string, sealStatus string",
    )
    assert K.seal_completeness(records, seals).first().seal_verified
