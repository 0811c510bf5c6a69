"""What the training-data operators share: table access, batch mapping, shared storage."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark alone, so any store Spark knows will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo `modulus`; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: spark.checkpoint.dir, or a fresh one where it is unset (tests)."""
    known = spark.conf.get("spark.checkpoint.dir", None)
    if not known:
        known = f"file:///tmp/checkpoints/{uuid.uuid4().hex}"
        os.makedirs(known.removeprefix("file://"), exist_ok=True)
        spark.conf.set("spark.checkpoint.dir", known)
    return known.rstrip("/")


def written(df: DataFrame, what: str) -> DataFrame:
    """Cuts lineage: writes a Parquet table to the shared folder and reads it again.

    Lost executors cost a re-read of this table, not a recomputation; Parquet keeps it smaller
    than the row format of checkpoint()."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes a table made by written() once nothing will read it again."""
    spark = df.sparkSession
    root = shared_folder(spark).split(":", 1)[-1].lstrip("/")
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if path.split(":", 1)[-1].lstrip("/").startswith(root):
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Arrow batch holds, unless the cluster says otherwise: long texts make batches of few rows."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(name):
        spark.conf.set(name, "4m")


def annotate(
    df: DataFrame, made: Sequence[T.StructField], fn: Callable[[pa.RecordBatch], Sequence[pa.Array]], drop: Sequence[str] = ()
) -> DataFrame:
    """Appends columns made by `fn` from each Arrow batch; every other column but `drop` passes through.

    An input column that has the name of a made one (in any case) gives way to it."""
    small_batches(df.sparkSession)
    names = {f.name.lower() for f in made} | set(drop)
    keep = [f.name for f in df.schema.fields if f.name.lower() not in names]
    schema = T.StructType([df.schema[n] for n in keep] + list(made))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = fn(b)
            cols = [b.column(b.schema.get_field_index(n)) for n in keep]
            yield pa.RecordBatch.from_arrays([*cols, *new], names=[*keep, *(f.name for f in made)])

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The batch's texts; null becomes the empty text."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(column)).to_pylist()]
