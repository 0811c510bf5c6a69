"""The driver's tables read as telemetry facts, and the queries that run every operator on them.

`events` are a fact stream, `lineitem` provider facts with repeated deliveries, `orders` authoritative
bindings, `customer` their scope, the other tables dimensions. QUERIES and SQL share their keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ident
from ..operators import episode, latest, paging, readiness, reconcile

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str):
    def add(fn):
        QUERIES[fn.__name__] = fn
        SQL[fn.__name__] = sql
        return fn

    return add


def _t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _ms(c) -> F.Column:
    return F.unix_millis(c.cast("timestamp"))


_LINE = ["l_orderkey", "l_linenumber"]
_FACT = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus"]
_TIES = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_returnflag DESC, l_linestatus DESC"
_LATEST_SQL = f"""SELECT l_orderkey, l_linenumber, l_shipdate, {', '.join(_FACT)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_TIES}) AS rn FROM lineitem %s) WHERE rn = 1"""


def _latest_lines(lines: DataFrame) -> DataFrame:
    return latest.latest(lines.select(*_LINE, "l_shipdate", *_FACT), _LINE, ["l_shipdate"])


@_query(_LATEST_SQL % "")
def latest_fact_per_key(spark, d):
    return _latest_lines(_t(spark, d, "lineitem"))


@_query("SELECT user_id, max(ts) AS ts, max_by(event_id, ts) AS event_id, max_by(event_type, ts) AS event_type FROM events GROUP BY user_id")
def latest_state_per_entity(spark, d):
    return latest.latest_by(_t(spark, d, "events"), ["user_id"], "ts", ["event_id", "event_type"])


@_query("SELECT event_id, ts, event_type, max(ts) OVER () AS watermark FROM events WHERE user_id = 7 ORDER BY ts, event_id")
def task_timeline(spark, d):
    rows = _t(spark, d, "events").where("user_id = 7").select("event_id", "ts", "event_type")
    return latest.with_watermark(rows, "ts").orderBy("ts", "event_id")


@_query("SELECT event_id, user_id, event_type FROM events WHERE event_type LIKE 'c%' OR event_type LIKE 'p_r%' OR event_type LIKE '%view%'")
def capability_chain(spark, d):
    kind = F.col("event_type")
    return _t(spark, d, "events").where(kind.like("c%") | kind.like("p_r%") | kind.like("%view%")).select("event_id", "user_id", "event_type")


@_query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE (l_partkey = 5 OR l_suppkey = 5) AND l_returnflag = 'R'")
def evidence_trace(spark, d):
    columns = {"node": ["l_partkey", "l_suppkey"], "flag": ["l_returnflag"], "task": ["l_orderkey"]}
    return paging.trace(_t(spark, d, "lineitem"), {"node": 5, "flag": "R"}, columns).select(*_LINE, "l_partkey", "l_suppkey")


@_query("SELECT event_id, user_id, value FROM events WHERE (user_id, event_id) > (40, 500) ORDER BY user_id, event_id LIMIT 500")
def keyset_page_facts(spark, d):
    page = paging.keyset_page(_t(spark, d, "events"), ["user_id", "event_id"], [F.lit(40), F.lit(500)], 500)
    return page.select("event_id", "user_id", "value")


@_query(_LATEST_SQL % "WHERE l_shipdate <= TIMESTAMP '1996-06-30'")
def asof_snapshot(spark, d):
    return _latest_lines(_t(spark, d, "lineitem").where(F.col("l_shipdate") <= F.lit("1996-06-30").cast("timestamp_ntz")))


@_query("""SELECT event_id, user_id, ts FROM events
WHERE ts BETWEEN (SELECT min(ts) FROM events) + INTERVAL 10 DAY - INTERVAL 30 MINUTE AND (SELECT min(ts) FROM events) + INTERVAL 12 DAY
ORDER BY ts, event_id LIMIT 1000""")
def lookback_page(spark, d):
    events = _t(spark, d, "events")
    start = events.agg(F.min("ts")).first()[0]
    base = F.lit(start.isoformat(sep=" ")).cast("timestamp_ntz")
    through = base + F.expr("INTERVAL 12 DAYS")
    rows = paging.lookback(events, "ts", base + F.expr("INTERVAL 10 DAYS"), F.expr("INTERVAL 30 MINUTES"), through)
    return paging.keyset_page(rows, ["ts", "event_id"], None, 1000).select("event_id", "user_id", "ts")


@_query("SELECT p_partkey, p_type FROM part WHERE starts_with(p_type, 'STANDARD')")
def topic_prefix(spark, d):
    return _t(spark, d, "part").where(F.col("p_type").startswith("STANDARD")).select("p_partkey", "p_type")


@_query("SELECT DISTINCT unnest([o_orderkey, o_custkey]) AS endpoint FROM orders WHERE o_orderstatus = 'F'")
def episode_endpoints(spark, d):
    own = _t(spark, d, "orders").where("o_orderstatus = 'F'")
    return own.select(F.explode(F.array("o_orderkey", "o_custkey")).alias("endpoint")).distinct()


@_query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P') OR l_partkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')""")
def episode_edges_semi(spark, d):
    # two existence joins: each row stays one row, so nothing is regrouped
    ends = _t(spark, d, "orders").where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("end"))
    a, b = ends.withColumnRenamed("end", "a").withColumn("ina", F.lit(True)), ends.withColumnRenamed("end", "b").withColumn("inb", F.lit(True))
    lines = _t(spark, d, "lineitem").select(*_LINE, "l_partkey")
    met = lines.join(a, F.col("l_orderkey") == F.col("a"), "left").join(b, F.col("l_partkey") == F.col("b"), "left")
    return met.where("ina or inb").select(*_LINE, "l_partkey")


@_query("""SELECT l.l_orderkey, l.l_linenumber, o.o_custkey, c.c_mktsegment FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey WHERE c.c_nationkey = 3""")
def episode_facts_join(spark, d):
    scope = _t(spark, d, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    tasks = _t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(scope, "o_custkey")
    return _t(spark, d, "lineitem").select(*_LINE).join(tasks, "l_orderkey").select(*_LINE, "o_custkey", "c_mktsegment")


def _matches(spark, d):
    bindings = _t(spark, d, "orders").select(
        F.col("o_orderkey").alias("task"), F.col("o_orderkey").alias("binding_id"),
        F.when(~F.col("o_orderpriority").like("1%"), F.col("o_custkey") % 10).alias("instance"),
    )
    facts = _t(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("task"), (F.col("l_suppkey") % 10).alias("instance"),
        F.concat_ws("-", *_LINE, "l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("fact_id"),
    )
    return episode.matches(facts, bindings, ["task"], "fact_id", "instance"), bindings


_J2 = """WITH m AS (SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, count(o.o_orderkey) AS n, max(o.o_orderkey) AS b
  FROM (SELECT *, row_number() OVER () AS r FROM lineitem) l LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  AND (o.o_orderpriority LIKE '1%' OR o.o_custkey % 10 = l.l_suppkey % 10) GROUP BY l.r, l.l_orderkey, l.l_linenumber, l.l_partkey) """


@_query(_J2 + "SELECT b AS binding_id, count(*) AS n_facts FROM m WHERE n = 1 GROUP BY b")
def closure_selected(spark, d):
    return _matches(spark, d)[0].where("n_matches = 1").groupBy("binding_id").agg(F.count("*").alias("n_facts"))


@_query(_J2 + "SELECT l_orderkey AS task, count(*) AS n_foreign FROM m WHERE n <> 1 GROUP BY l_orderkey")
def closure_foreign(spark, d):
    return _matches(spark, d)[0].where("n_matches <> 1").groupBy("task").agg(F.count("*").alias("n_foreign"))


@_query(_J2 + "SELECT o_orderkey AS binding_id FROM orders WHERE NOT EXISTS (SELECT 1 FROM m WHERE n = 1 AND b = o_orderkey)")
def unresolved_bindings(spark, d):
    found, bindings = _matches(spark, d)
    return reconcile.missing(bindings.select("binding_id"), found.where("n_matches = 1"), ["binding_id"])


@_query("""WITH c AS (SELECT o.o_orderkey, o.o_orderstatus, list_sort(list_distinct(coalesce(list(l.l_linestatus) FILTER (l.l_linestatus IS NOT NULL), []))) AS claims
  FROM orders o LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey GROUP BY 1, 2),
r AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN [] ELSE [o_orderstatus] END AS refs FROM c)
SELECT CASE WHEN len(claims) = 0 THEN 'missing' WHEN len(refs) = 0 THEN 'unverifiable' WHEN claims = refs THEN 'matched'
  WHEN len(list_intersect(claims, refs)) > 0 THEN 'ambiguous' ELSE 'conflict' END AS status, count(*) AS n FROM r GROUP BY 1""")
def claim_reconcile_counts(spark, d):
    claims = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_linestatus").alias("claims"))
    orders = _t(spark, d, "orders").join(claims, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    empty = F.array().cast("array<string>")
    refs = F.when(F.col("o_orderstatus") == "P", empty).otherwise(F.array("o_orderstatus"))
    status = episode.claim_status(F.coalesce("claims", empty), refs)
    return orders.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@_query("SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def source_without_terminal(spark, d):
    return reconcile.missing(_t(spark, d, "documents").select("doc_id"), _t(spark, d, "labels"), ["doc_id"])


@_query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F')""")
def target_without_lineage(spark, d):
    lineage = _t(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return reconcile.missing(_t(spark, d, "lineitem").select(*_LINE), lineage, ["l_orderkey"])


@_query("""WITH h AS (SELECT l_orderkey, l_linenumber, sha256(concat_ws('|', l_partkey, l_suppkey)) AS h FROM lineitem)
SELECT DISTINCT a.l_orderkey, a.l_linenumber FROM h a JOIN h b USING (l_orderkey, l_linenumber) WHERE a.h <> b.h""")
def hash_mismatch(spark, d):
    content = F.sha2(F.concat_ws("|", "l_partkey", "l_suppkey"), 256)
    return latest.conflicts(_t(spark, d, "lineitem"), _LINE, content).select(*_LINE)


@_query("""SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')
  OR o_orderstatus = 'O'""")
def checkpoint_ahead(spark, d):
    orders = _t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    terminal = _t(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return reconcile.ahead(orders.select("o_orderkey"), orders.where("o_orderstatus <> 'O'"), terminal, ["o_orderkey"])


@_query("""WITH i AS (SELECT o_orderkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey))
SELECT s.n AS sources, t.n AS issues, CASE WHEN s.n = 0 THEN 'empty' WHEN t.n = 0 THEN 'healthy' ELSE 'gap' END AS status
FROM (SELECT count(*) AS n FROM orders) s, (SELECT count(*) AS n FROM i) t""")
def reconcile_summary(spark, d):
    orders = _t(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"))
    return reconcile.summary(orders, reconcile.missing(orders, _t(spark, d, "lineitem"), ["l_orderkey"]))


@_query("SELECT l_orderkey, l_linenumber, count(DISTINCT l_partkey) AS n_contents FROM lineitem GROUP BY 1, 2 HAVING count(DISTINCT l_partkey) > 1")
def content_conflict(spark, d):
    return latest.conflicts(_t(spark, d, "lineitem"), _LINE, F.col("l_partkey"))


@_query("""SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_contents FROM lineitem WHERE l_returnflag IN ('A', 'R')
GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1""")
def terminal_conflict(spark, d):
    return latest.conflicts(_t(spark, d, "lineitem"), ["l_orderkey"], F.col("l_returnflag"), F.col("l_returnflag").isin("A", "R"))


@_query("SELECT l_returnflag, count(*) AS n_facts, count(DISTINCT l_suppkey) AS n_sources, max(l_shipdate) AS watermark FROM lineitem GROUP BY 1")
def projection_status(spark, d):
    return _t(spark, d, "lineitem").groupBy("l_returnflag").agg(
        F.count("*").alias("n_facts"), F.count_distinct("l_suppkey").alias("n_sources"), F.max("l_shipdate").alias("watermark")
    )


_KINDS = ["click", "view", "purchase", "signup", "logout", "absent"]


@_query("SELECT " + ", ".join(f"count(*) FILTER (event_type = '{k}') AS n_{k}" for k in _KINDS) + " FROM events")
def status_histogram(spark, d):
    return latest.histogram(_t(spark, d, "events"), "event_type", _KINDS)


@_query("""WITH f AS (SELECT l_orderkey, max(struct_pack(t := l_shipdate, n := l_linenumber, s := l_linestatus)) AS x FROM lineitem GROUP BY 1)
SELECT o_orderkey, o_orderstatus, x.s AS fact_status, coalesce(x.s <> o_orderstatus, FALSE) AS status_mismatch, l_orderkey IS NULL AS no_fact
FROM orders LEFT JOIN f ON o_orderkey = l_orderkey""")
def binding_vs_latest(spark, d):
    last = _t(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.struct("l_shipdate", "l_linenumber", "l_linestatus")).alias("x")
    )
    joined = _t(spark, d, "orders").join(last, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        "o_orderkey", "o_orderstatus", F.col("x.l_linestatus").alias("fact_status"),
        F.coalesce(F.col("x.l_linestatus") != F.col("o_orderstatus"), F.lit(False)).alias("status_mismatch"),
        F.col("l_orderkey").isNull().alias("no_fact"),
    )


_READY = """WITH f AS (SELECT *, user_id % 10 AS scope FROM events),
s AS (SELECT scope, count(*) AS facts, max(e) AS ends, bool_or(related) AS related, bool_or(ended) AS ended, bool_or(command) AS command,
  bool_or(progress) AS progress FROM (SELECT scope, user_id, count(DISTINCT CASE WHEN event_type IN ('purchase', 'logout') THEN event_type END) AS e
  FROM f GROUP BY 1, 2) JOIN (SELECT scope AS s2, user_id AS u2, event_type = 'click' AS related,
  event_type IN ('purchase', 'logout') AS ended, event_type = 'signup' AS command, event_type = 'view' AS progress FROM f)
  ON scope = s2 AND user_id = u2 GROUP BY scope)
SELECT scope, facts, CASE WHEN ends > 1 THEN 'conflict' WHEN NOT related OR NOT ended THEN 'not_ready'
  WHEN NOT (command AND progress) THEN 'degraded' ELSE 'ready' END AS status FROM s"""


@_query(_READY)
def provider_readiness(spark, d):
    kind = F.col("event_type")
    ended = kind.isin("purchase", "logout")
    fact_type = (
        F.when(ended, "provider.task.lifecycle").when(kind == "signup", "provider.command.lifecycle")
        .when(kind == "view", "provider.execution.progress").otherwise("other")
    )
    facts = _t(spark, d, "events").select(
        (F.col("user_id") % 10).alias("scope"), F.col("event_id").alias("fact_id"), F.sha2("props", 256).alias("fact_hash"),
        fact_type.alias("fact_type"), F.col("user_id").alias("task_id"),
        F.when(kind == "purchase", "completed").when(kind == "logout", "failed").alias("lifecycle_status"),
        (kind == "click").alias("related"), F.lit(False).alias("blocking_issue"),
    )
    return readiness.provider(facts, ["scope"])


@_query("""WITH o AS (SELECT user_id % 5 AS set_id, user_id % 4 AS member, count(*) AS source_count, count(*) FILTER (event_type <> 'view') AS terminal_count
  FROM events GROUP BY 1, 2), m AS (SELECT s.range AS set_id, p.range AS member FROM range(5) s, range(5) p),
r AS (SELECT m.set_id, m.member, o.source_count IS NOT NULL AS seen, list_filter([CASE WHEN o.source_count IS NULL THEN 'PROJECTION_MEMBER_MISSING' END,
  CASE WHEN o.terminal_count < o.source_count AND m.member < 2 THEN 'TERMINAL_COVERAGE_INCOMPLETE' END], lambda x: x IS NOT NULL) AS own
  FROM m LEFT JOIN o USING (set_id, member)),
g AS (SELECT set_id, flatten(list(own)) AS own, bool_or(len(own) > 0 AND member < 3) AS required_gap,
  coalesce(max(CASE WHEN member >= 3 AND seen THEN member END) >= min(CASE WHEN len(own) > 0 THEN member END), FALSE) AS note FROM r GROUP BY 1)
SELECT set_id, CASE WHEN required_gap THEN 'not_ready' WHEN len(own) > 0 THEN 'degraded' ELSE 'ready' END AS status,
  array_to_string(list_sort(list_distinct(CASE WHEN note THEN list_append(own, 'DIAGNOSTIC_GAP') ELSE own END)), ',') AS reasons FROM g""")
def set_readiness(spark, d):
    stats = _t(spark, d, "events").groupBy((F.col("user_id") % 5).alias("set_id"), (F.col("user_id") % 4).alias("member")).agg(
        F.count("*").alias("source_count"), F.count_if(F.col("event_type") != "view").alias("n")
    )
    name = F.concat_ws("/", F.col("set_id").cast("string"), F.col("member").cast("string"))
    observed = stats.select(
        name.alias("projection_id"), F.lit("ACTIVE").alias("lifecycle"), "source_count",
        F.when(F.col("member") < 2, F.col("n")).otherwise(F.col("source_count")).alias("terminal_count"),
        F.lit(0).alias("blocking_dlq"), F.lit(True).alias("seal_verified"), F.lit(False).alias("drift"),
    )
    members = spark.range(25).select(
        F.expr("id div 5").alias("set_id"), (F.col("id") % 5).alias("position"),
        F.concat_ws("/", F.expr("id div 5").cast("string"), (F.col("id") % 5).cast("string")).alias("projection_id"),
        F.when(F.col("id") % 5 < 3, "required").otherwise("diagnostic").alias("requirement"),
    )
    return readiness.projection_set(members, observed, ["set_id"]).withColumn("reasons", F.array_join("reasons", ","))


_ROUTES = (("canonical", "TRUE"), ("runtime", "event_type IN ('click', 'view')"), ("terminal", "event_type IN ('purchase', 'logout')"))


@_query(" UNION ALL ".join(f"SELECT '{t}' AS target, count(*) AS n FROM events WHERE {p}" for t, p in _ROUTES))
def fanout_route_counts(spark, d):
    # one pass: each row names all its targets
    targets = F.filter(F.array(*(F.when(F.expr(p), F.lit(t)) for t, p in _ROUTES)), lambda x: x.isNotNull())
    return _t(spark, d, "events").select(F.explode(targets).alias("target")).groupBy("target").agg(F.count("*").alias("n"))


@_query("SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def dimension_route(spark, d):
    # 25 and 5 rows by definition
    nation = _t(spark, d, "nation").join(F.broadcast(_t(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    joined = _t(spark, d, "supplier").join(F.broadcast(nation), F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.select("s_suppkey", "n_name", "r_name")


@_query("""SELECT l_orderkey, l_linenumber, count(*) AS deliveries, CASE WHEN count(*) = 1 THEN 'accepted'
  WHEN count(DISTINCT l_partkey) = 1 THEN 'duplicate' ELSE 'conflict' END AS outcome FROM lineitem GROUP BY 1, 2""")
def duplicate_vs_conflict(spark, d):
    return reconcile.outcome_of_redelivery(_t(spark, d, "lineitem"), _LINE, "l_partkey")


@_query("""SELECT l_orderkey, l_linenumber, step FROM (SELECT *, l_linenumber - lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS step
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) WHERE step > 1""")
def sequence_gaps(spark, d):
    return latest.sequence_steps(_t(spark, d, "lineitem").select(*_LINE).distinct(), ["l_orderkey"], "l_linenumber").where("step > 1")


@_query("SELECT conv_id, min(turn) AS first_sequence, max(turn) AS last_sequence, count(*) AS n_records FROM conversations GROUP BY 1")
def sequence_boundaries(spark, d):
    return latest.boundaries(_t(spark, d, "conversations"), ["conv_id"], "turn")


_NS = ident.NAMESPACE.replace("-", "")


@_query(f"""WITH h AS (SELECT o_orderkey, sha1(unhex('{_NS}') || encode('order:' || o_orderkey)) AS h FROM orders)
SELECT o_orderkey, substr(h,1,8) || '-' || substr(h,9,4) || '-5' || substr(h,14,3) || '-' ||
  substr('89ab', 1 + (position(substr(h,17,1) IN '0123456789abcdef') - 1) % 4, 1) || substr(h,18,3) || '-' || substr(h,21,12) AS target_id FROM h""")
def uuid5_identity(spark, d):
    return _t(spark, d, "orders").select("o_orderkey", ident.uuid5(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string"))).alias("target_id"))


@_query("SELECT event_id, sha256('canonical.v1' || chr(0) || event_id) AS row_id FROM events")
def row_id_sha256(spark, d):
    return _t(spark, d, "events").select("event_id", ident.row_id(F.lit("canonical.v1"), F.col("event_id").cast("string")).alias("row_id"))


@_query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL")
def payload_extract_typed(spark, d):
    k = ident.unsigned(F.get_json_object("props", "$.k"), 2**63 - 1)
    return _t(spark, d, "events").select("event_id", k.cast("long").alias("k")).where("k is not null")


@_query("""SELECT event_id, CASE WHEN event_type = 'view' THEN 'skip:SOURCE_NOT_APPLICABLE' WHEN value < 5 THEN 'fail:value'
  WHEN CAST(json_extract_string(props, '$.k') AS BIGINT) > 90 THEN 'fail:k' ELSE 'produce' END AS decision FROM events""")
def mapping_decision(spark, d):
    k = F.get_json_object("props", "$.k").cast("long")
    tests = [(F.col("event_type") == "view", "skip:SOURCE_NOT_APPLICABLE"), (F.col("value") < 5, "fail:value"), (k > 90, "fail:k")]
    decision = F.coalesce(*(F.when(t, F.lit(m)) for t, m in tests), F.lit("produce"))
    return _t(spark, d, "events").select("event_id", decision.alias("decision"))


@_query("""SELECT user_id, max(lag_ms) AS max_lag_ms, min(lag_ms) AS min_lag_ms FROM (SELECT user_id,
  epoch_us(ts) // 1000 - lag(epoch_us(ts) // 1000) OVER (PARTITION BY user_id ORDER BY ts) AS lag_ms FROM events) GROUP BY 1""")
def freshness_latency(spark, d):
    rows = _t(spark, d, "events").select("user_id", _ms(F.col("ts")).alias("ms"))
    steps = latest.sequence_steps(rows, ["user_id"], "ms")
    return steps.groupBy("user_id").agg(F.max("step").alias("max_lag_ms"), F.min("step").alias("min_lag_ms"))


@_query("""SELECT vec_id, array_to_string(list_sort(list_distinct(list_filter(list_transform(embedding,
  lambda x: CAST(CAST(floor(x * 10) AS INTEGER) AS VARCHAR)), lambda s: s <> '0'))), ',') AS labels FROM embeddings""")
def array_normalise(spark, d):
    words = F.transform("embedding", lambda x: F.floor(x * F.lit(10).cast("float")).cast("int").cast("string"))
    return _t(spark, d, "embeddings").select("vec_id", F.array_join(ident.normalised(F.filter(words, lambda s: s != "0")), ",").alias("labels"))


@_query("SELECT event_id, max(ts) OVER () AS watermark FROM events WHERE event_type = 'purchase'")
def watermark_broadcast(spark, d):
    rows = _t(spark, d, "events").where("event_type = 'purchase'").select("event_id", "ts")
    return latest.with_watermark(rows, "ts").select("event_id", "watermark")


@_query("SELECT user_id FROM events WHERE event_type = 'purchase' INTERSECT SELECT user_id FROM events WHERE event_type = 'signup'")
def set_ops_intersect(spark, d):
    e = _t(spark, d, "events")
    return e.where("event_type = 'purchase'").select("user_id").intersect(e.where("event_type = 'signup'").select("user_id"))


@_query("SELECT user_id FROM events WHERE event_type = 'purchase' EXCEPT ALL SELECT user_id FROM events WHERE event_type = 'signup'")
def set_ops_except(spark, d):
    e = _t(spark, d, "events")
    return e.where("event_type = 'purchase'").select("user_id").exceptAll(e.where("event_type = 'signup'").select("user_id"))


@_query("""SELECT 'facts_total{type="' || t.k || '"} ' || coalesce(n, 0) AS line FROM (VALUES ('click'), ('view'), ('purchase'), ('absent"x')) t(k)
LEFT JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY 1) e ON t.k = e.event_type""".replace("t.k ||", "replace(t.k, '\"', '\\\"') ||"))
def metrics_text(spark, d):
    from .surface import metric_lines

    names = spark.createDataFrame([("click",), ("view",), ("purchase",), ('absent"x',)], "event_type string")
    counts = _t(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("value"))
    return metric_lines(names, counts, "event_type", "facts_total", "type")


@_query("""WITH d AS (SELECT l_orderkey, l_linenumber, count(*) AS n, count(DISTINCT l_partkey) AS h FROM lineitem GROUP BY 1, 2)
SELECT CASE WHEN h > 1 THEN 'blocked' WHEN n > 1 THEN 'duplicate' ELSE 'produced' END AS outcome, count(*) AS n FROM d GROUP BY 1""")
def terminal_outcomes(spark, d):
    from ..operators import terminal

    rows = _t(spark, d, "lineitem").groupBy(*_LINE).agg(
        F.count("*").alias("n"), F.min("l_partkey").alias("old"), F.max("l_partkey").alias("new")
    )
    known = F.when(F.col("n") > 1, F.col("old"))
    decided = rows.select(terminal.outcome(F.lit("produce"), known, F.col("new"), known, F.col("new")).alias("outcome"))
    return decided.groupBy("outcome").agg(F.count("*").alias("n"))


@_query("""SELECT 'line' AS kind, l_orderkey AS task, l_shipdate AS occurred_at FROM lineitem UNION ALL
SELECT 'order', o_orderkey, o_orderdate FROM orders UNION ALL SELECT 'event', user_id, ts FROM events""")
def fact_index_union(spark, d):
    parts = [
        _t(spark, d, t).select(F.lit(kind).alias("kind"), F.col(task).alias("task"), F.col(at).alias("occurred_at"))
        for kind, t, task, at in (("line", "lineitem", "l_orderkey", "l_shipdate"), ("order", "orders", "o_orderkey", "o_orderdate"), ("event", "events", "user_id", "ts"))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@_query("SELECT event_id, 'sha256:' || sha256('{\"k\":' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '}') AS payload_hash FROM events")
def canonical_payload_hash(spark, d):
    from ..functions import canonical

    made = canonical.canonical_column(F.col("props"), canonical.DOMAIN)
    return _t(spark, d, "events").select("event_id", made["hash"].alias("payload_hash"))


@_query("SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def stream_lookback_dedup(spark, d):
    from ..streaming import lanes

    schema = _t(spark, d, "lineitem").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/lineitem.parquet*")
    rows = stream.select(*_LINE, F.col("l_shipdate").cast("timestamp").alias("ts"))
    # one look-back over the whole range, so that every repeat lies within it
    return lanes.to_table(lanes.deduplicated(rows, "ts", _LINE, "20000 days").select(*_LINE))


@_query("""WITH s AS (SELECT conv_id, max(turn) AS last, count(*) AS n FROM conversations GROUP BY 1)
SELECT conv_id, n = last + 1 AS seal_verified FROM s""")
def seal_completeness(spark, d):
    from ..sources import contracts

    scope = {c: F.lit("x") for c in ("tenantId", "projectId", "environment", "sourceContractId")}
    records = _t(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("episodeId"), F.col("turn").cast("string").alias("sequence")
    ).withColumns(scope)
    seals = records.groupBy("episodeId").agg(F.max(F.col("sequence").cast("long")).alias("last")).select(
        "episodeId", F.lit("1").alias("sealRevision"), F.col("last").cast("string").alias("finalSequence"),
        (F.col("last") + 1).cast("string").alias("sourceRecordCount"), F.lit("sealed").alias("sealStatus"),
    ).withColumns(scope)
    return contracts.seal_completeness(records, seals).select(F.col("episodeId").cast("long").alias("conv_id"), "seal_verified")


@_query("""SELECT side, count(*) AS n FROM (
  (SELECT 'missing' AS side, event_id, event_type FROM events WHERE event_type <> 'view' EXCEPT ALL SELECT 'missing', event_id, event_type FROM events WHERE value > 10)
  UNION ALL (SELECT 'extra', event_id, event_type FROM events WHERE value > 10 EXCEPT ALL SELECT 'extra', event_id, event_type FROM events WHERE event_type <> 'view'))
GROUP BY side""")
def exact_difference(spark, d):
    events = _t(spark, d, "events").select("event_id", "event_type", "value")
    want, got = events.where("event_type <> 'view'").drop("value"), events.where("value > 10").drop("value")
    return reconcile.difference(want, got).groupBy("side").agg(F.count("*").alias("n"))


@_query("""SELECT count(*) AS late_beyond_lookback FROM events
WHERE ts < (SELECT min(ts) FROM events) + INTERVAL 10 DAY - INTERVAL 30 MINUTE""")
def late_beyond_lookback(spark, d):
    events = _t(spark, d, "events")
    base = F.lit(events.agg(F.min("ts")).first()[0].isoformat(sep=" ")).cast("timestamp_ntz")
    return paging.late(events, "ts", base + F.expr("INTERVAL 10 DAYS"), F.expr("INTERVAL 30 MINUTES"))


@_query("""WITH g AS (SELECT l_orderkey, l_linenumber, l_orderkey % 97 <> 0 OR l_linenumber <> 2 AS good,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) - 1 AS place, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS first
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)),
b AS (SELECT l_orderkey, min(l_linenumber) AS bad FROM g WHERE NOT good GROUP BY 1)
SELECT g.l_orderkey, g.l_linenumber FROM g LEFT JOIN b USING (l_orderkey) WHERE l_linenumber - first = place AND (bad IS NULL OR l_linenumber < bad)""")
def torn_log_prefix(spark, d):
    from ..streaming import lanes

    frames = _t(spark, d, "lineitem").select(*_LINE).distinct().withColumn("body", F.concat_ws(":", *_LINE))
    torn = (F.col("l_orderkey") % 97 == 0) & (F.col("l_linenumber") == 2)
    frames = frames.withColumn("sum", F.when(torn, "torn").otherwise(F.sha2("body", 256)))
    return lanes.torn_prefix(frames, "l_orderkey", "l_linenumber", "body", "sum").select(*_LINE)


@_query("""SELECT CASE WHEN event_type = 'click' THEN 'canonical+specialized' ELSE 'canonical-only' END AS coverage,
  CASE WHEN event_type = 'click' THEN 'specialised' WHEN event_type = 'view' THEN 'payload_lacks_columns' ELSE 'no_specialised_table' END AS reason,
  count(DISTINCT event_type) AS n_types FROM events GROUP BY 1, 2""")
def coverage_matrix(spark, d):
    from . import projections

    kind = F.col("event_type")
    named = F.when(kind == "click", "node_control.a2a_exposure").when(kind == "view", "capability.readiness").otherwise(kind)
    types = _t(spark, d, "events").select(named.alias("record_type")).distinct()
    return projections.coverage(types).groupBy("coverage", "reason").agg(F.count("*").alias("n_types"))
