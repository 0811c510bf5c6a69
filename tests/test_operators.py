from datetime import datetime

import pytest
from pyspark.sql import functions as F

from factloom.operators import episode, latest, paging, readiness, reconcile, terminal
from factloom.plans import lifecycle as L
from factloom.plans import surface


def test_latest_breaks_ties_by_all_columns(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "c")], "k int, v int, x string")
    assert sorted(map(tuple, latest.latest(df, ["k"], ["v"]).collect())) == [(1, 5, "b"), (2, 1, "c")]


def test_capped_fails_on_overflow(spark):
    assert paging.capped(spark.range(3), 3).count() == 3
    with pytest.raises(paging.ResultTooLarge):
        paging.capped(spark.range(4), 3)


def test_trace_needs_known_keys(spark):
    with pytest.raises(ValueError):
        paging.trace(spark.range(1), {}, {"id": ["id"]})
    with pytest.raises(ValueError):
        paging.trace(spark.range(1), {"x": 1}, {"id": ["id"]})


def _reconciliation(spark):
    sources = spark.createDataFrame([("a", 1), ("b", 1), ("c", 1)], "record_id string, revision int")
    targets = spark.createDataFrame([("t1", "h1"), ("t2", "h2"), ("t2", "h3"), ("t9", "h9")], "target_id string, content_hash string")
    lineage = spark.createDataFrame(
        [("a", 1, "t1", "hX", "produced"), ("b", 1, "t2", "h2", "produced"), ("b", 1, "t7", "h7", "produced")],
        "record_id string, revision int, target_id string, target_hash string, decision string",
    )
    dead = spark.createDataFrame([("z", 1, True, "open"), ("b", 1, True, "resolved")], "record_id string, revision int, blocking boolean, status string")
    marks = spark.createDataFrame([("c", 1), ("q", 1), ("a", 1)], "record_id string, revision int")
    return sources, targets, lineage, dead, marks


def test_reconciliation_finds_every_code(spark):
    found = reconcile.issues(*_reconciliation(spark), drift=True)
    got = [(r.code, r.key, r.target) for r in found.collect()]
    assert got == sorted(got)
    assert {c for c, _, _ in got} == set(reconcile.CODES)
    assert [k for c, k, _ in got if c == "CHECKPOINT_AHEAD_OF_TERMINAL"] == ["c\x1f1", "q\x1f1"]


def test_empty_status_wins(spark):
    s, *rest = _reconciliation(spark)
    none = s.where("false")
    assert reconcile.summary(none, reconcile.issues(none, *rest)).first().status == "empty"


def _closure(spark, bindings, facts, hints=()):
    arrays = "runtime_{0} array<string>, task_{0} array<string>, invocation_{0} array<string>"
    b = spark.createDataFrame(bindings, "binding_id string, task string, instance string, " + arrays.format("refs"))
    f = spark.createDataFrame(facts, "fact_id string, task string, instance string, origin_system string, " + arrays.format("claims"))
    h = spark.createDataFrame(list(hints), "relation_id string, authority string, producer_system string, evidence_fact_ids array<string>")
    return f, b, h


def test_closure_ready_and_conflict(spark):
    ref = (["r"], ["t"], ["i"])
    f, b, h = _closure(spark, [("b1", "x", None, *ref)], [("f1", "x", "1", "SDAR", *ref)])
    row = episode.close(f, b, h, ["task"], "instance")
    assert row.first().status == "ready" and row.select(episode.consumer_gate(row).alias("g")).first().g
    f, b, h = _closure(spark, [("b1", "x", "2", *ref)], [("f1", "x", "1", None, *ref)])
    assert episode.close(f, b, h, ["task"], "instance").first().status == "conflict"  # foreign fact
    f, b, h = _closure(spark, [], [])
    assert episode.close(f, b, h, ["task"], "instance").first().status == "not_ready"


def test_closure_claims_and_hints(spark):
    ref = (["r"], ["t"], ["i"])
    f, b, h = _closure(
        spark, [("b1", "x", None, *ref)], [("f1", "x", "1", "other", *ref), ("f2", "x", "1", None, ["r", "q"], [], ["z"])],
        [("h1", "authoritative", "provider", ["f1"]), ("h2", "hint", "provider", ["none"])],
    )
    row = episode.close(f, b, h, ["task"], "instance").first()
    assert (row.out_of_scope, row.ambiguous, row.missing, row.conflict) == (1, 1, 1, 2)
    assert row.status == "conflict"


def test_closure_truncation(spark):
    ref = (["r"], ["t"], ["i"])
    f, b, h = _closure(spark, [("b1", "x", None, *ref)], [("f1", "x", "1", None, *ref)])
    assert episode.close(f, b, h, ["task"], captured=(1, 2, 0)).first().truncated


def test_terminal_outcomes(spark):
    rows = spark.createDataFrame(
        [
            ("a", 1, "produce", None, "t1", "h1", "s", ""), ("b", 1, "produce", None, "t2", "h2", "s", ""),
            ("c", 1, "fail", "SOURCE_SCHEMA_INVALID", None, None, "s", ""), ("d", 1, "skip", None, None, None, "s", ""),
            ("e", 1, "produce", None, "t3", "h3", "s", ""),
        ],
        "record_id string, revision int, decision string, code string, target_id string, target_hash string, source_hash string, reason string",
    )
    targets = spark.createDataFrame([("t2", "h2"), ("t3", "other")], "target_id string, content_hash string")
    none = spark.createDataFrame([], "record_id string, revision int, tuple_hash string")
    first = terminal.close(rows, targets, none)
    got = {r.record_id: (r.outcome, r.dlq_code, r.dlq_class, r.checkpoint_eligible) for r in first.collect()}
    assert got["a"] == ("produced", None, None, True)
    assert got["b"] == ("duplicate", None, None, True)
    assert got["c"] == ("failed", "SOURCE_SCHEMA_INVALID", "data_contract", True)
    assert got["d"][0] == "skipped"
    assert got["e"] == ("blocked", terminal.TARGET_CONFLICT, "content_conflict", False)
    lineage = first.select("record_id", "revision", F.lit("changed").alias("tuple_hash"))
    again = {r.record_id: r.dlq_code for r in terminal.close(rows, targets, lineage).collect()}
    assert again["a"] == terminal.LINEAGE_CONFLICT


def test_checkpoints_never_go_back(spark):
    stored = spark.createDataFrame([("k", 5, "x")], "p string, sequence int, token string")
    new = spark.createDataFrame([("k", 4, "y", False)], "p string, sequence int, token string, conflict boolean")
    assert terminal.advance(stored, new, ["p"]).count() == 0
    same = spark.createDataFrame([("k", 5, "y", False)], "p string, sequence int, token string, conflict boolean")
    assert terminal.advance(stored, same, ["p"]).first().conflict


def test_set_readiness_table(spark):
    members = spark.createDataFrame([("s", "p1", 0, "required"), ("s", "p2", 1, "diagnostic")], "set_id string, projection_id string, position int, requirement string")
    schema = "projection_id string, lifecycle string, source_count int, terminal_count int, blocking_dlq int, seal_verified boolean, drift boolean"
    fine = lambda p, **k: tuple({"p": p, "l": "ACTIVE", "s": 1, "t": 1, "b": 0, "v": True, "d": False, **k}.values())
    cases = [
        ([fine("p1"), fine("p2")], "ready", []),
        ([fine("p1"), fine("p2", b=1)], "degraded", ["BLOCKING_DLQ_OPEN", "DIAGNOSTIC_GAP"]),
        ([fine("p1"), fine("p2", d=True)], "blocked_drift", ["SCHEMA_CONTRACT_DRIFT"]),
        ([fine("p2")], "not_ready", ["DIAGNOSTIC_GAP", "PROJECTION_MEMBER_MISSING"]),
        ([fine("p1")], "degraded", ["PROJECTION_MEMBER_MISSING"]),
        ([fine("p1", t=0), fine("p2")], "not_ready", ["DIAGNOSTIC_GAP", "TERMINAL_COVERAGE_INCOMPLETE"]),
    ]
    for rows, status, reasons in cases:
        got = readiness.projection_set(members, spark.createDataFrame(rows, schema), ["set_id"]).first()
        assert (got.status, got.reasons) == (status, reasons)
    observed = spark.createDataFrame([fine("p1")], schema)
    assert readiness.projection_set(members, observed, ["set_id"], F.lit(False)).first().status == "not_required"


def test_provider_readiness_spellings_conflict(spark):
    schema = "s int, fact_id string, fact_hash string, fact_type string, task_id string, lifecycle_status string, related boolean, blocking_issue boolean"
    end = lambda i, st: (1, i, i, "provider.task.lifecycle", "t", st, True, False)
    other = lambda i, kind: (1, i, i, kind, "t", None, True, False)
    status = lambda rows: readiness.provider(spark.createDataFrame(rows, schema), ["s"]).first().status
    assert status([end("a", "cancelled"), end("b", "canceled")]) == "conflict"
    assert status([end("a", "completed")]) == "degraded"
    assert status([end("a", "running")]) == "not_ready"
    assert status([end("a", "completed"), other("b", "provider.command.lifecycle"), other("c", "provider.resource.health")]) == "ready"


def test_lifecycle_rules():
    now = L.Lifecycle("p", "DRY_RUN", 3)
    with pytest.raises(L.Refused, match="ACTIVATION"):
        L.apply(now, "a", "h", "set_active", 3)
    active = L.apply(now, "a", "h", "set_active", 3, may_activate=True)
    assert (active.state, active.revision) == ("ACTIVE", 4)
    assert L.apply(active, "a", "h", "set_active", 0) is active
    for args, why in ((("a", "x", "suspend", 4), "CONTENT"), (("b", "x", "suspend", 3), "REVISION"), (("b", "x", "set_dry_run", 4), "FORBIDDEN")):
        with pytest.raises(L.Refused, match=why):
            L.apply(active, *args)


def test_leases_and_dead_letters():
    lease = L.claim(L.Lease(), "a", 0, 10)
    with pytest.raises(L.Refused):
        L.claim(lease, "b", 5, 10)
    taken = L.claim(lease, "b", 10, 10)
    assert taken.token == 2
    with pytest.raises(L.Refused):
        L.renew(taken, "a", 1, 11, 10)
    row = L.DeadLetter(("t",), "open")
    assert L.settle(row, ("t",), "open", "retry").status == "retrying"
    done = L.settle(row, ("t",), "open", "retry", terminal=True)
    assert done.status == "resolved" and L.settle(done, ("t",), "open", "retry") is done
    with pytest.raises(L.Refused):
        L.settle(row, ("x",), "open", "ignore")


def test_routes(spark):
    facts = spark.createDataFrame(
        [("f1", datetime(2024, 1, 1), datetime(2024, 1, 2), "s"), ("f1", datetime(2024, 1, 1), datetime(2024, 1, 3), "s")],
        "fact_id string, occurred_at timestamp, projected_at timestamp, smpp_source_id string",
    )
    rows = surface.run(spark, "provider_facts", {"smpp_source_id": "s"}, tables={"provider_facts": facts})
    assert rows.count() == 1
    one = surface.envelope(rows.drop("projected_at"), "query_watermark", datetime(2024, 1, 3, 0, 0, 30), ["s"]).first()
    assert (one.freshness, one.lag_seconds) == ("fresh", 30)
    with pytest.raises(ValueError):
        surface.run(spark, "provider_fact", {}, tables={"provider_facts": facts})
