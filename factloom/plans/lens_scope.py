"""Queries of scopes, episodes, older contracts, catalogues and stages; they join the lens's QUERIES and SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ident
from ..operators import audit, scope
from . import projections
from .lens import _LINE, _NS, _query, _t

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


@_query("""WITH m AS (SELECT n_nationkey AS source_id, CASE n_regionkey WHEN 0 THEN ['*'] WHEN 1 THEN ['BUILDING', 'MACHINERY'] ELSE ['AUTOMOBILE'] END AS t,
  n_nationkey % 7 <> 0 AS enabled FROM nation)
SELECT c_nationkey AS source_id, CASE WHEN NOT coalesce(enabled, FALSE) THEN 'SOURCE_UNKNOWN'
  WHEN list_contains(t, '*') OR list_contains(t, c_mktsegment) THEN 'AUTHORISED' ELSE 'CROSS_TENANT' END AS verdict, count(*) AS n
FROM customer LEFT JOIN m ON c_nationkey = source_id GROUP BY 1, 2""")
def tenant_authorised(spark, d):
    region = F.col("n_regionkey")
    tenants = (
        F.when(region == 0, F.array(F.lit("*"))).when(region == 1, F.array(F.lit("BUILDING"), F.lit("MACHINERY"))).otherwise(F.array(F.lit("AUTOMOBILE")))
    )
    sources = _t(spark, d, "nation").select(F.col("n_nationkey").alias("source_id"), tenants.alias("tenant_ids"), (F.col("n_nationkey") % 7 != 0).alias("enabled"))
    rows = _t(spark, d, "customer").select(F.col("c_nationkey").alias("source_id"), F.col("c_mktsegment").alias("tenant_id"))
    return scope.authorised(rows, sources).groupBy("source_id", "verdict").agg(F.count("*").alias("n"))


@_query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderkey = 33 OR o_custkey = 7")
def episode_key_or_id(spark, d):
    return scope.either(_t(spark, d, "orders"), {"o_orderkey": 33, "o_custkey": 7}).select("o_orderkey", "o_custkey", "o_orderstatus")


_EDGES = """e AS (SELECT l_quantity::INT % 2 AS tenant_id, l_linenumber % 3 AS project_id, l_returnflag AS environment, l_suppkey % 4 AS source_id,
  l_orderkey AS s, l_orderkey + l_linenumber AS t, unnest([l_partkey, l_partkey + 1, l_partkey]) AS fact_id FROM lineitem),
f AS (SELECT p_size % 2 AS tenant_id, p_size % 3 AS project_id, CASE WHEN p_size % 5 < 3 THEN 'N' ELSE 'R' END AS environment, p_partkey % 4 AS source_id,
  p_partkey AS fact_id, p_brand FROM part),"""


def _edges(spark, d):
    part = F.col("l_partkey")
    edges = _t(spark, d, "lineitem").select(
        (F.col("l_quantity").cast("int") % 2).alias("tenant_id"), (F.col("l_linenumber") % 3).alias("project_id"), F.col("l_returnflag").alias("environment"),
        (F.col("l_suppkey") % 4).alias("source_id"), F.concat_ws("-", *_LINE, "l_partkey").alias("relation_id"), F.col("l_orderkey").alias("source_entity_id"),
        F.when(F.col("l_linenumber") > 1, "task").otherwise("order").alias("source_entity_type"),
        (F.col("l_orderkey") + F.col("l_linenumber")).alias("target_entity_id"), F.array(part, part + 1, part).alias("evidence_fact_ids"),
    )
    size = F.col("p_size")
    facts = _t(spark, d, "part").select(
        (size % 2).alias("tenant_id"), (size % 3).alias("project_id"), F.when(size % 5 < 3, "N").otherwise("R").alias("environment"),
        (F.col("p_partkey") % 4).alias("source_id"), F.col("p_partkey").alias("fact_id"), "p_brand",
    )
    return edges, facts


@_query(f"""WITH {_EDGES}
t AS (SELECT DISTINCT o_custkey AS episode_id, unnest([o_orderkey, o_orderkey + 1]) AS task FROM orders)
SELECT DISTINCT t.episode_id, f.fact_id, f.p_brand FROM t JOIN e ON t.task = e.s OR t.task = e.t
JOIN f ON e.fact_id = f.fact_id AND e.tenant_id = f.tenant_id AND e.project_id = f.project_id AND e.environment = f.environment AND e.source_id = f.source_id""")
def episode_facts_five_keys(spark, d):
    edges, facts = _edges(spark, d)
    bindings = _t(spark, d, "orders").select(
        F.col("o_custkey").alias("episode_id"), F.col("o_orderkey").alias("a2a_task_id"), (F.col("o_orderkey") + 1).alias("remote_task_id")
    )
    return scope.episode_facts(bindings, edges, facts).select("episode_id", "fact_id", "p_brand")


@_query("""SELECT o_custkey AS episode_id, count(DISTINCT p_partkey) AS facts, count(DISTINCT p_brand) AS brands FROM orders
JOIN lineitem ON l_orderkey = o_orderkey AND l_linenumber > 1 JOIN part ON p_partkey = l_partkey OR p_partkey = l_partkey + 1 GROUP BY 1""")
def task_assembly(spark, d):
    edges, facts = _edges(spark, d)
    bindings = _t(spark, d, "orders").select(F.col("o_custkey").alias("episode_id"), F.col("o_orderkey").alias("task_id"))
    found = scope.assembled(bindings, edges, facts)
    return found.groupBy("episode_id").agg(F.count("*").alias("facts"), F.count_distinct("p_brand").alias("brands"))


@_query("""SELECT o_orderkey AS binding_id, 'sha256:' || sha256('{"authoritySource":"sdar_core.remote_task_binding","bindingId":"' || o_orderkey ||
  '","episodeId":"' || o_custkey || '","relationType":"binds_provider_remote_task","remoteTaskId":"' || (o_orderkey + 1) || '"}') AS relation_id FROM orders""")
def binding_relation_ids(spark, d):
    bindings = _t(spark, d, "orders").select(
        F.col("o_orderkey").alias("binding_id"), F.col("o_custkey").alias("episode_id"), (F.col("o_orderkey") + 1).alias("remote_task_id")
    )
    return scope.binding_relation(bindings).select("binding_id", "relation_id")


@_query("""WITH f AS (SELECT CASE event_type WHEN 'view' THEN 'sdar.runtime.capability_summary' WHEN 'click' THEN 'sdar.runtime.public_capability_card'
  WHEN 'logout' THEN 'smpp.provider.operation' ELSE 'sdar.runtime.' || event_type END AS family,
  CASE WHEN event_type IN ('logout', 'signup') THEN 'smpp-providerops-1.1.0' ELSE 'sdar-v13' END AS source_type FROM events WHERE user_id % 11 <> 0)
SELECT 'sdar_core.runtime_capability_summary_fact' AS target_table, family AS kind, count(*) AS n FROM f
  WHERE family IN ('sdar.runtime.capability_summary', 'sdar.runtime.public_capability_card') GROUP BY 2
UNION ALL SELECT 'sdar_core.runtime_fact', family, count(*) FROM f
  WHERE starts_with(family, 'sdar.runtime.') AND family NOT IN ('sdar.runtime.capability_summary', 'sdar.runtime.public_capability_card') GROUP BY 2
UNION ALL SELECT 'sdar_core.smpp_provider_ops_fact', family, count(*) FROM f WHERE source_type = 'smpp-providerops-1.1.0' GROUP BY 2""")
def older_route_counts(spark, d):
    kind = F.col("event_type")
    facts = _t(spark, d, "events").select(
        F.when(kind == "view", "sdar.runtime.capability_summary").when(kind == "click", "sdar.runtime.public_capability_card")
        .when(kind == "logout", "smpp.provider.operation").otherwise(F.concat(F.lit("sdar.runtime."), kind)).alias("record_family"),
        F.when(kind.isin("logout", "signup"), "smpp-providerops-1.1.0").otherwise("sdar-v13").alias("source_type"),
        (F.col("user_id") % 11 == 0).alias("evidence"),  # facts of the evidence contract, which have routes of their own
    )
    return projections.older_routes(facts).groupBy("target_table", "kind").agg(F.count("*").alias("n"))


@_query("""SELECT c_custkey, sha256('{"application":"' || CASE WHEN c_custkey % 2 = 0 THEN 'commander' ELSE 'npc' END ||
  '","contractVersion":"sdar.domain-source/v1","projectId":"' || c_nationkey || '","tenantId":"' || c_mktsegment || '"}') AS log_key FROM customer""")
def log_partition_keys(spark, d):
    key = scope.log_partition(
        {
            "contractVersion": F.lit("sdar.domain-source/v1"), "application": F.when(F.col("c_custkey") % 2 == 0, "commander").otherwise("npc"),
            "tenantId": F.col("c_mktsegment"), "projectId": F.col("c_nationkey"),
        }
    )
    return _t(spark, d, "customer").select("c_custkey", key.alias("log_key"))


@_query(f"""WITH h AS (SELECT o_orderkey, sha1(unhex('{_NS}') || encode(concat_ws(chr(31), 'sdar-domain-lineage-v1', o_orderpriority, o_custkey, 'DP-C01', 1,
  o_orderkey, o_custkey % 3, 'target'))) AS h FROM orders)
SELECT o_orderkey, substr(h,1,8) || '-' || substr(h,9,4) || '-5' || substr(h,14,3) || '-' ||
  substr('89ab', 1 + (position(substr(h,17,1) IN '0123456789abcdef') - 1) % 4, 1) || substr(h,18,3) || '-' || substr(h,21,12) AS lineage_id FROM h""")
def lineage_ids(spark, d):
    parts = [F.col("o_orderpriority"), F.col("o_custkey"), F.lit("DP-C01"), F.lit(1), F.col("o_orderkey"), F.col("o_custkey") % 3, F.lit("target")]
    return _t(spark, d, "orders").select("o_orderkey", scope.operational_id("lineage", parts).alias("lineage_id"))


@_query(f"""SELECT table_name AS object, column_name AS name, ordinal_position AS position FROM information_schema.columns
WHERE table_name IN ({', '.join(repr(t) for t in _TABLES)})""")
def catalogue_columns(spark, d):
    return audit.descriptors(spark, {t: _t(spark, d, t) for t in _TABLES}).select("object", "name", "position")


@_query("SELECT 'orders' AS object, 'o_comment' AS name, 'MISSING' AS fault UNION ALL SELECT 'orders', 'o_custkey', 'CHANGED' UNION ALL SELECT 'region', 'r_name', 'UNEXPECTED'")
def catalogue_difference(spark, d):
    found = audit.descriptors(spark, {t: _t(spark, d, t) for t in ("orders", "region")})
    want = found.where("name <> 'r_name'").withColumn("type", F.when(F.col("name") == "o_custkey", "string").otherwise(F.col("type")))
    extra = spark.createDataFrame([("orders", 7, "o_comment", "string")], audit.DESCRIPTOR)
    return audit.difference(want.union(extra), found)


@_query("""SELECT coalesce(o.o_orderkey, l.l_orderkey) AS key, coalesce(o.target, 0) AS target, coalesce(l.lineage, 0) AS lineage,
  coalesce(o.target, 0) = 1 AND coalesce(l.lineage, 0) = 1 AS complete
FROM (SELECT o_orderkey, count(*) AS target FROM orders GROUP BY 1) o
FULL JOIN (SELECT l_orderkey, count(*) AS lineage FROM lineitem WHERE l_linenumber = 1 GROUP BY 1) l ON o_orderkey = l_orderkey""")
def stage_row_counts(spark, d):
    target = _t(spark, d, "orders").select(F.col("o_orderkey").alias("key"))
    lineage = _t(spark, d, "lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("key"))
    return audit.stage_counts({"target": target, "lineage": lineage}, ["key"])


@_query("""SELECT count(*) FILTER (n_regionkey < 3) AS n_pass, array_to_string(list_sort(list(n_nationkey::VARCHAR) FILTER (n_regionkey >= 3)), ',') AS open_ids,
  list_sort(list(n_nationkey)) = range(25) AS exact FROM nation""")
def release_gate(spark, d):
    return audit.gate(_t(spark, d, "nation"), "n_nationkey", F.col("n_regionkey") < 3, range(25))


@_query("SELECT conv_id, count(*) AS frames, min(turn) AS first, max(turn) AS last FROM conversations GROUP BY 1")
def sealed_log_frames(spark, d):
    own = _t(spark, d, "conversations").withColumn("checksum", F.sha2("text", 256))
    return audit.sealed_log(own.where("text is not null"), "conv_id", "turn", F.col("text"), F.col("checksum"))


@_query("""SELECT event_id, user_id, ts FROM events, (SELECT min(ts) AS low FROM events) WHERE event_type = 'purchase'
  AND (ts > low + INTERVAL 1 DAY OR ts = low + INTERVAL 1 DAY AND event_id >= 5) AND (ts < low + INTERVAL 9 DAY OR ts = low + INTERVAL 9 DAY AND event_id <= 7)""")
def replay_between_cursors(spark, d):
    events = _t(spark, d, "events").select("event_id", "user_id", "ts", "event_type")
    low, high = events.agg(F.min("ts") + F.expr("interval 1 day"), F.min("ts") + F.expr("interval 9 day")).first()
    return audit.replay(events, {"event_type": "purchase"}, ["ts", "event_id"], [low, 5], [high, 7], most=10_000_000).drop("event_type")


@_query("SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS sources, (SELECT count(DISTINCT c_custkey) FROM customer) AS facts, TRUE AS matched")
def legacy_reconcile(spark, d):
    return audit.matched(_t(spark, d, "orders").select(F.col("o_custkey").alias("k")), _t(spark, d, "customer").select(F.col("c_custkey").alias("k")), "k")


@_query("SELECT count(*) AS n, count(*) = 0 AS free FROM orders WHERE o_orderkey = -1")
def export_id_unused(spark, d):
    return audit.unused(_t(spark, d, "orders"), "o_orderkey", -1)


@_query("SELECT 25 AS n")
def exact_row_count(spark, d):
    return audit.exactly(_t(spark, d, "nation"), 25, "nation")


@_query("""SELECT DISTINCT l_suppkey AS source_entity_id, l_partkey AS target_entity_id, 'supplies' AS relation_type FROM lineitem
UNION SELECT DISTINCT l_orderkey, l_suppkey, 'served_by' FROM lineitem""")
def execution_topology(spark, d):
    """Every edge between entities, once."""
    lines = _t(spark, d, "lineitem")
    edge = lambda a, b, kind: F.struct(F.col(a).alias("source_entity_id"), F.col(b).alias("target_entity_id"), F.lit(kind).alias("relation_type"))
    both = F.explode(F.array(edge("l_suppkey", "l_partkey", "supplies"), edge("l_orderkey", "l_suppkey", "served_by"))).alias("e")
    return lines.select(both).select("e.*").distinct()


@_query("""SELECT user_id % 10 AS source_id, max(ts) AS watermark, count(*) AS rows, CASE WHEN max(lag) IS NULL THEN 'degraded' WHEN min(lag) < 60 THEN 'fresh' ELSE 'stale' END AS health
FROM (SELECT *, epoch((SELECT max(ts) FROM events)) - epoch(ts) AS lag FROM events) GROUP BY 1""")
def source_health(spark, d):
    """Each source's last instant against the newest one of all."""
    events = _t(spark, d, "events")
    top = events.agg(F.max("ts").alias("top"))
    per = events.groupBy((F.col("user_id") % 10).alias("source_id")).agg(F.max("ts").alias("watermark"), F.count("*").alias("rows"))
    seconds = lambda c: F.unix_micros(F.col(c).cast("timestamp")) / 1_000_000
    joined = per.crossJoin(F.broadcast(top))  # one row
    return joined.select("source_id", "watermark", "rows", ident.freshness(seconds("top") - seconds("watermark")).alias("health"))
