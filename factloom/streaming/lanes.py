"""Streams: look-back deduplication, batch lanes with idempotent multi-table writes.

A file source and its checkpoint stand for the write-ahead log: a file is one accepted batch, a micro-batch
is committed after all its writes. Every write of a micro-batch goes to a folder named by the batch id and
overwrites it, so a micro-batch that is run again leaves the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators import terminal
from ..plans import mappings
from ..sources import contracts


class ContentConflict(RuntimeError):
    """One identity came with two contents."""


def deduplicated(stream: DataFrame, time: str, identity: list[str], back: str = "30 minutes") -> DataFrame:
    """Each identity once within the look-back; rows later than that are dropped by the watermark.

    State is bounded by the look-back. Longer replays are settled by the batch join with stored identities."""
    return stream.withWatermark(time, back).dropDuplicatesWithinWatermark(identity)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach: spark.checkpoint.dir, or a fresh one where it is unset (tests)."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        known = f"file:///tmp/checkpoints/{uuid.uuid4().hex}"
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def to_table(stream: DataFrame) -> DataFrame:
    """Runs a stream over what its source holds now, to a table in the shared folder."""
    path = f"{shared_folder(stream.sparkSession)}/stream-{uuid.uuid4().hex}"
    writer = stream.writeStream.format("parquet").option("path", f"{path}/rows").option("checkpointLocation", f"{path}/log")
    writer.trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/rows")


def written_once(df: DataFrame, path: str, batch_id: int, by: list[str] | None = None) -> None:
    """Writes a micro-batch's rows to its own folder, replacing what an earlier try left."""
    w = df.write.mode("overwrite").option("compression", "zstd")
    (w.partitionBy(*by) if by else w).parquet(f"{path}/batch_id={batch_id}")


def stored(spark: SparkSession, path: str, schema: T.StructType | str, before: int) -> DataFrame:
    """What micro-batches before this one wrote."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    if not root.getFileSystem(conf).exists(root):
        return spark.createDataFrame([], schema)
    kept = spark.createDataFrame([], schema).schema
    full = T.StructType([*kept.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(full).parquet(path).where(F.col("batch_id") < before).select(*kept.names)


def few(df: DataFrame, most: int = 200_000) -> bool:
    """Whether a micro-batch's keys may be sent to every task."""
    return df.limit(most + 1).count() <= most


TARGETS = "target_id string, content_hash string"
LINEAGE = "record_id string, revision decimal(20,0), tuple_hash string"
_PARTITION = ["tenant_id", "project_id", "episode_key", "projection_id"]
CHECKPOINTS = ", ".join(f"{k} string" for k in _PARTITION) + ", sequence decimal(20,0), token string"


def contracts_of(records: DataFrame) -> set[str]:
    """The known contracts that occur in a micro-batch, so that no plan is made for the others."""
    known = [mappings.contract_id(m) for m in mappings.MAPPINGS]
    return {r[0] for r in records.select("sourceContractId").where(F.col("sourceContractId").isin(*known)).distinct().collect()}


def decided(records: DataFrame, present: set[str] | None = None) -> DataFrame:
    """Every record as a row for terminal closure: mapped by its contract, or skipped where none applies."""
    parts = mappings.not_applicable(records)
    for m in mappings.MAPPINGS:
        if present is not None and mappings.contract_id(m) not in present:
            continue
        rows = mappings.map_records(records, m).select(
            F.col("source_record_id").alias("record_id"), F.col("source_revision").alias("revision"), "sequence", "decision", "code", "field",
            F.when(F.col("decision") == "produce", F.col("record_id")).alias("target_id"), F.col("payload_sha256").alias("target_hash"),
            F.col("source_payload_hash").alias("source_hash"), F.coalesce("code", F.lit("")).alias("reason"),
            "tenant_id", "project_id", "episode_key", "projection_id", "target_table", "payload_json",
        )
        parts = parts.unionByName(rows)
    return parts


def close_batch(records: DataFrame, root: str, batch_id: int) -> DataFrame:
    """Targets, lineage, dead letters and checkpoints of one micro-batch, written in this order.

    A checkpoint never goes back; one sequence with another content stops the batch before anything is written."""
    spark = records.sparkSession
    rows = decided(records, contracts_of(records))
    if rows.groupBy("record_id", "revision", "projection_id").agg(F.count_distinct("source_hash").alias("n")).where("n > 1").limit(1).count():
        raise ContentConflict("SOURCE_CONTENT_CONFLICT")
    rows = rows.dropDuplicates(["record_id", "revision", "projection_id"])
    closed = terminal.close(
        rows, stored(spark, f"{root}/targets", TARGETS, batch_id), stored(spark, f"{root}/lineage", LINEAGE, batch_id)
    ).persist()
    try:
        reached = stored(spark, f"{root}/checkpoints", CHECKPOINTS, batch_id)
        reached = reached.groupBy(*_PARTITION).agg(F.max(F.struct("sequence", "token")).alias("x")).select(*_PARTITION, "x.sequence", "x.token")
        ahead = terminal.advance(reached, terminal.checkpoints(closed, _PARTITION), _PARTITION)
        if ahead.where("conflict").limit(1).count():
            raise ContentConflict("CHECKPOINT_CONTENT_CONFLICT")
        done = F.col("outcome")
        written_once(
            closed.where(done == "produced").select("target_id", F.col("target_hash").alias("content_hash"), "target_table", "payload_json"),
            f"{root}/targets", batch_id,
        )
        written_once(
            closed.where(done.isin("produced", "duplicate", "skipped")).select("record_id", "revision", F.col("new_tuple").alias("tuple_hash"), "target_id", "outcome"),
            f"{root}/lineage", batch_id,
        )
        written_once(
            closed.where("dlq_code is not null").select("record_id", "revision", "dlq_code", "dlq_class", "dlq_contract_class", "field"),
            f"{root}/dead_letters", batch_id,
        )
        written_once(ahead.drop("conflict"), f"{root}/checkpoints", batch_id)
        return closed.groupBy("outcome").agg(F.count("*").alias("n"))
    finally:
        closed.unpersist()


def domain_lane(spark: SparkSession, source: str, root: str, checkpoint: str, files: int = 100,
                each: Callable[[DataFrame, int], None] | None = None) -> StreamingQuery:
    """Files of domain-source batches to landing tables and closed targets; refused batches go to `rejects` with their code."""

    def run(raw: DataFrame, batch_id: int) -> None:
        checked = contracts.domain_batches(raw.where("value is not null").dropDuplicates(["value"])).persist()
        try:
            written_once(checked.where("code is not null").select("value", "code"), f"{root}/rejects", batch_id)
            records = contracts.domain_records(checked)
            for table, rows in mappings.landing_rows(records, F.current_timestamp(), contracts_of(records)).items():
                written_once(rows, f"{root}/landing/{table}", batch_id)
            close_batch(records, root, batch_id)
            if each:
                each(checked, batch_id)
        finally:
            checked.unpersist()

    raw = spark.readStream.option("maxFilesPerTrigger", files).text(source, wholetext=True)
    return raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def evidence_lane(spark: SparkSession, source: str, root: str, checkpoint: str, files: int = 100) -> StreamingQuery:
    """Files of evidence batches to canonical rows by month; an exact repeat of a record adds nothing.

    A record id with a second content is written to `conflicts`; what was accepted first stays (within a
    micro-batch, the content recorded first)."""
    from ..plans import projections

    def run(raw: DataFrame, batch_id: int) -> None:
        checked = contracts.evidence_batches(raw.where("value is not null")).persist()
        try:
            written_once(checked.where("code is not null").select("value", "code"), f"{root}/rejects", batch_id)
            facts = contracts.evidence_facts(checked)
            rows = projections.canonical_rows(facts, F.current_timestamp())
            first = rows.groupBy("record_id").agg(F.min(F.struct("recorded_at", "payload_hash")).alias("x")).select("record_id", F.col("x.payload_hash").alias("_first"))
            seen = stored(spark, f"{root}/evidence_canonical", "record_id string, payload_hash string", batch_id)
            seen = seen.join(F.broadcast(first) if few(first) else first, "record_id", "left_semi").groupBy("record_id").agg(F.min("payload_hash").alias("_seen"))
            met = rows.join(first, "record_id").join(seen, "record_id", "left").withColumn("_own", F.coalesce("_seen", "_first"))
            other = met.where(~F.col("payload_hash").eqNullSafe(F.col("_own")))
            written_once(other.select("record_id", "payload_hash", F.col("_own").alias("accepted_hash")).distinct(), f"{root}/conflicts", batch_id)
            fresh = met.where(F.col("_seen").isNull() & F.col("payload_hash").eqNullSafe(F.col("_own"))).drop("_first", "_seen", "_own").dropDuplicates(["record_id"])
            written_once(fresh.sortWithinPartitions("record_type", "record_id", "row_id"), f"{root}/evidence_canonical", batch_id, ["ym"])
        finally:
            checked.unpersist()

    raw = spark.readStream.option("maxFilesPerTrigger", files).text(source, wholetext=True)
    return raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def seal_lane(spark: SparkSession, source: str, root: str, checkpoint: str, files: int = 100) -> StreamingQuery:
    """Files of episode seals to seal rows; refused seals go to `seal_rejects` with their code."""

    def run(raw: DataFrame, batch_id: int) -> None:
        checked = contracts.seals(raw.where("value is not null").dropDuplicates(["value"])).persist()
        try:
            written_once(checked.where("code is not null").select("value", "code"), f"{root}/seal_rejects", batch_id)
            written_once(mappings.seal_rows(checked.where("code is null").select("seal.*"), F.current_timestamp()), f"{root}/seals", batch_id)
        finally:
            checked.unpersist()

    raw = spark.readStream.option("maxFilesPerTrigger", files).text(source, wholetext=True)
    return raw.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def torn_prefix(frames: DataFrame, partition: str, ordinal: str, body: str, checksum: str) -> DataFrame:
    """The valid prefix of each partition's log: frames before its first bad checksum or gap."""
    good = (F.sha2(body, 256) == F.col(checksum)).alias("good")
    first_bad = frames.select(partition, ordinal, good).where(~F.col("good")).groupBy(partition).agg(F.min(ordinal).alias("_bad"))
    span = frames.groupBy(partition).agg(F.min(ordinal).alias("_first"))
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(partition).orderBy(ordinal)) - 1
    rows = frames.join(span, partition).withColumn("_gap", F.col(ordinal) - F.col("_first") != place).join(first_bad, partition, "left")
    return rows.where(~F.col("_gap") & (F.col("_bad").isNull() | (F.col(ordinal) < F.col("_bad")))).select(frames.columns)
