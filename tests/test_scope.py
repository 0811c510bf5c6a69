"""Scope, audit and replay rules on small fixtures."""

import pytest
from pyspark.sql import functions as F

from factloom.operators import audit, paging, scope
from factloom.plans import projections, surface


def test_identifiers():
    assert scope.safe_identifier("a_b.c") == "a_b.c"
    for bad in ("", "1a", "a b", "a;drop", "a-b"):
        with pytest.raises(ValueError):
            scope.safe_identifier(bad)
    with pytest.raises(ValueError):
        scope.either(None, {})


def test_logs_fail_closed(spark):
    frames = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 7, "z")], "p string, o int, body string").withColumn("sum", F.sha2("body", 256))
    check = lambda df: audit.sealed_log(df, "p", "o", F.col("body"), F.col("sum")).collect()
    assert {(r.p, r.frames, r.first, r.last) for r in check(frames)} == {("a", 2, 1, 2), ("b", 1, 7, 7)}
    for broken in (frames.where("o <> 1").union(frames.where("o = 7").withColumn("o", F.lit(9))), frames.withColumn("sum", F.lit("x"))):
        with pytest.raises(Exception, match="torn or corrupt"):
            check(broken)


def test_replay_has_a_hard_count(spark):
    rows = spark.range(20).select((F.col("id") % 2).alias("t"), (F.col("id") / 4).cast("int").alias("at"), "id")
    got = audit.replay(rows, {"t": 0}, ["at", "id"], [1, 6], [3, 12]).collect()
    assert [r.id for r in got] == [6, 8, 10, 12]
    with pytest.raises(paging.ResultTooLarge):
        audit.replay(rows, {"t": 0}, ["at", "id"], [0, 0], [9, 99], most=3)


def test_counts_shapes_and_changes(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    assert audit.exactly(rows, 2, "rows").first().n == 2
    with pytest.raises(Exception, match="expected 3 rows"):
        audit.exactly(rows, 3, "rows").collect()
    assert audit.changed_after(rows, rows, ["k"]).count() == 0
    assert [r.k for r in audit.changed_after(rows, rows.withColumn("v", F.lit("a")), ["k"]).collect()] == [2]
    assert audit.shaped(rows.withColumn("x.y", F.lit(1)), ["k", "z"]) == ["missing z", "dotted x.y"]
    a, b = audit.descriptors(spark, {"t": rows}), audit.descriptors(spark, {"t": rows.withColumn("k", F.col("k").cast("long"))})
    assert audit.fingerprint(a).first().hash != audit.fingerprint(b).first().hash
    assert [(r.name, r.fault) for r in audit.difference(a, b).collect()] == [("k", "CHANGED")] and audit.difference(a, a).count() == 0
    one = audit.gate(rows, "k", F.col("v").isNotNull(), [1, 2, 3]).first()
    assert (one.n_pass, one.open_ids, one.exact) == (1, "2", False)


def test_older_facts_have_their_own_tables(spark):
    rows = [("smpp-providerops-1.1.0", "sdar.runtime.signup", False), ("x", "other", False), ("x", "sdar.runtime.public_capability_card", False), ("x", "sdar.runtime.a", True)]
    got = projections.older_routes(spark.createDataFrame(rows, "source_type string, record_family string, evidence boolean")).collect()
    assert sorted((r.target_table, r.kind_column) for r in got) == sorted(
        [(projections.RUNTIME_TABLE, "fact_type"), (projections.PROVIDER_TABLE, "record_type"), (projections.SUMMARY_TABLE, "summary_kind")]
    )


def test_reconciliation_keeps_tenants_apart(spark):
    bindings = spark.createDataFrame([("t1", "p", "e", "r", "done", 1)], "tenant_id string, project_id string, environment string, remote_task_id string, status string, revision int")
    facts = spark.createDataFrame([("t2", "p", "e", "r", 9, "failed", 2, 9)], "tenant_id string, project_id string, environment string, external_task_id string, occurred_at int, lifecycle_status string, provider_revision int, projected_at int")
    other = surface.task_reconciliation(bindings, facts).first()
    assert other.fact_status is None and not other.status_mismatch
    own = surface.task_reconciliation(bindings, facts.withColumn("tenant_id", F.lit("t1"))).first()
    assert own.fact_status == "failed" and own.status_mismatch and own.revision_mismatch


def test_routes_filter_before_versions(spark):
    rows = [("k", "a", "1", "t1", 1, 1), ("k", "a", "1", "t2", 2, 1), ("k", "b", "2", "t1", 1, 2)]
    table = spark.createDataFrame(rows, "record_type string, record_id string, row_id string, task_id string, projected_at int, occurred_at int").withColumn("evidence_sequence", F.col("record_id"))
    got = surface.run(spark, "task_timeline", {"task_id": "t1"}, tables={"evidence_canonical": table}).collect()
    assert [r.record_id for r in got] == ["b"]  # record a's last version belongs to another task
