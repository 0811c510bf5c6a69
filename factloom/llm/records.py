"""Operator 8: token ids in length-delimited binary records, with an offset index beside each file.

A record is `uint64 length | uint32 masked checksum of the length | payload | uint32 masked checksum
of the payload`; the payload is the int64 doc_id followed by the ids, two bytes each where the
vocabulary fits, else four. `<name>.idx` holds per record `uint64 offset | uint64 ids before it in
the file | int64 doc_id | uint32 ids`; fetch() seeks by it to records in any order. Files follow
ascending doc_id (nulls first, then by a hash of the text), one for each range partition, so rows that
repeat an id, or have none, are dealt by their texts.

Recovery: a task writes files under a name of its own attempt, and only the manifest, a Parquet table
committed by Spark, says which files count; a repeated or speculative task leaves at most an unread file.

Defined cases: a null or empty text is a record with the end id alone; repeated rows give repeated
records; a null doc_id is stored as the smallest int64 and read back as null; an empty table gives no
file and an empty result; other input columns are not used.
"""

from __future__ import annotations

import json
import os
import struct
import sys
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_folder, small_batches, texts
from .pieces import Pieces
from .words import grouped

#: Pieces that one call of the library encodes as one text.
TOGETHER = 250
NO_ID = -(2**63)
_INDEX = np.dtype([("offset", "<u8"), ("before", "<u8"), ("doc_id", "<i8"), ("n", "<u4")])
MANIFEST = "part int, name string, records long, ids long, width int"
ROWS = "doc_id long, start long, ids binary"
_LOADED: dict[tuple[str, bool], "Library"] = {}


def masked(data: bytes) -> int:
    """A rotated, offset crc32, so that a checksum of data that holds checksums stays strong."""
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join((head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))))


def unframed(buffer: bytes, at: int) -> bytes:
    head = buffer[at : at + 8]
    (length,) = struct.unpack("<Q", head)
    if struct.unpack("<I", buffer[at + 8 : at + 12])[0] != masked(head):
        raise ValueError(f"the length at {at} does not match its checksum")
    payload = buffer[at + 12 : at + 12 + length]
    if struct.unpack("<I", buffer[at + 12 + length : at + 16 + length])[0] != masked(payload):
        raise ValueError(f"the record at {at} does not match its checksum")
    return payload


def little(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


class Library:
    """The tokenizers library behind a memory of pieces; texts whose pieces are not told from bytes go to it whole.

    `special`: special tokens spelled out in a text give their own id, as is the library's default."""

    def __init__(self, path: str, special: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = not special
        self.size = self.tok.get_vocab_size()
        with open(path, encoding="utf-8") as f:
            made = json.load(f)
        before = made.get("pre_tokenizer") or {}
        self.cuts = not made.get("normalizer") and before.get("type") == "ByteLevel" and before.get("use_regex", True)
        self.cuts = self.cuts and not before.get("add_prefix_space") and made["model"]["type"] == "BPE"
        self.apart = [t["content"] for t in made.get("added_tokens", []) if special or not t["special"]]
        self.memory = Pieces(self._pieces)
        (self.mark,) = self._library(["\n"])[0] if self.cuts else (None,)

    def _library(self, texts_: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tok.encode_batch_fast(texts_, add_special_tokens=False)]

    def _pieces(self, new: list[bytes]) -> list[bytes]:
        """Pieces without white space but for a blank before them go some hundred to a text, a line end between them."""
        single = [(p[1:] if p[:1] == b" " else p).isalnum() for p in new]
        words = [i for i, s in enumerate(single) if s]
        others = [i for i, s in enumerate(single) if not s]
        out: list[bytes] = [b""] * len(new)
        for at in range(0, len(words), TOGETHER * 20):
            groups = [words[i : i + TOGETHER] for i in range(at, min(at + TOGETHER * 20, len(words)), TOGETHER)]
            joined = [b"\n".join([new[i] for i in g]).decode() for g in groups]
            for g, found in zip(groups, self._library(joined), strict=True):
                ids = np.array(found, "<u4")
                ends = np.append(np.flatnonzero(ids == self.mark), len(ids))
                if len(ends) != len(g):
                    raise ValueError("a piece holds the id of the line end")
                data, start = ids.tobytes(), 0
                for i, end in zip(g, (ends * 4).tolist(), strict=True):
                    out[i] = data[start:end]
                    start = end + 4
        for at in range(0, len(others), 5000):  # the library's own results are large
            part = others[at : at + 5000]
            for i, ids in zip(part, self._library([new[i].decode() for i in part]), strict=True):
                out[i] = little(ids)
        return out

    def encode(self, docs: list[str]) -> list[bytes]:
        """Each text's ids, little-endian."""
        whole = [i for i, t in enumerate(docs) if not self.cuts or any(a in t for a in self.apart)]
        apart = dict(zip(whole, map(little, self._library([docs[i] for i in whole])), strict=True))
        ids, counts = self.memory.of([t if i not in apart else "" for i, t in enumerate(docs)])
        data, ends = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(counts)]) * 4
        found = [data[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        return [apart.get(i, v) for i, v in enumerate(found)]


def _loaded(path: str, special: bool) -> Library:
    if (path, special) not in _LOADED:
        _LOADED[path, special] = Library(path, special)
    return _LOADED[path, special]


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder)


def write(df: DataFrame, folder: str, path: str, end_id: int = 0, special: bool = True) -> DataFrame:
    """Encodes every text, writes the files under `folder` and returns the manifest table.

    `special`: special tokens spelled out in a text give their own id (the library's default), else they are plain text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = _loaded(path, special)
        size = library.size
        width = 2 if max(size, end_id + 1) <= 1 << 16 else 4
        end = np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        store, base = _store(folder)
        name, out, index = f"part-{part:06d}-{uuid.uuid4().hex}", None, []
        offset = before = 0
        for b in batches:
            ids = b.column(b.schema.get_field_index("doc_id")).to_pylist()
            at = 0
            for docs in grouped(texts(b)):
                block = []
                for doc_id, values in zip(ids[at : at + len(docs)], library.encode(docs), strict=True):
                    data = values + end
                    n = len(data) // 4
                    if width == 2:
                        data = np.frombuffer(data, "<u4").astype("<u2").tobytes()
                    doc_id = NO_ID if doc_id is None else doc_id
                    record = frame(struct.pack("<q", doc_id) + data)
                    index.append((offset, before, doc_id, n))
                    block.append(record)
                    offset += len(record)
                    before += n
                if out is None:
                    out = store.open_output_stream(f"{base}/{name}.rec")
                out.write(b"".join(block))
                at += len(docs)
        if out is not None:
            out.close()
            with store.open_output_stream(f"{base}/{name}.idx") as f:
                f.write(np.array(index, _INDEX).tobytes())
            row = {"part": [part], "name": [name], "records": [len(index)], "ids": [before], "width": [width]}
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row)
            )

    spark = df.sparkSession
    small_batches(spark)
    store, base = _store(folder)
    store.create_dir(base, recursive=True)
    ordered = (
        df.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .withColumn("h", F.xxhash64("text"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), F.col("h"))
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "h", "text")
        .drop("h")
    )
    ordered.mapInArrow(run, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def files_of(spark: SparkSession, folder: str) -> list[tuple[str, int, int, int]]:
    """Each file's name, ids before it, width, records before it.

    The manifest has one short row for each file; its running totals are taken on the driver."""
    rows, start, records = [], 0, 0
    for r in sorted(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").collect(), key=lambda r: r["part"]):
        rows.append((r["name"], start, r["width"], records))
        start += r["ids"]
        records += r["records"]
    return rows


def fetch(spark: SparkSession, folder: str, picks: DataFrame, record: str = "record") -> DataFrame:
    """The records at the given numbers (0 for the first of all files), in the picks' own order: record, doc_id, start, ids.

    Each pick is two seeks, in the index and in the file. A number that is null or beyond the files is an error."""
    found = files_of(spark, folder)
    before = np.array([f[3] for f in found], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for b in batches:
            numbers = b.column(0).to_pylist()
            if any(n is None or n < 0 for n in numbers) or (numbers and not found):
                raise ValueError("no record has such a number")
            file = np.searchsorted(before, np.array(numbers, np.int64), "right") - 1
            rows: list[tuple] = [()] * len(numbers)
            for k in np.unique(file).tolist():
                name, first, width, low = found[k]
                with store.open_input_file(f"{base}/{name}.idx") as index, store.open_input_file(f"{base}/{name}.rec") as data:
                    for i in np.flatnonzero(file == k).tolist():
                        index.seek((numbers[i] - low) * _INDEX.itemsize)
                        entry = index.read(_INDEX.itemsize)
                        if len(entry) < _INDEX.itemsize:
                            raise ValueError("no record has such a number")
                        offset, ahead, doc_id, n = np.frombuffer(entry, _INDEX)[0].tolist()
                        data.seek(offset)
                        payload = unframed(data.read(24 + n * width), 0)
                        if struct.unpack("<q", payload[:8])[0] != doc_id:
                            raise ValueError(f"{name}: index and record differ at {offset}")
                        ids = np.frombuffer(payload, f"<u{width}", offset=8).astype("<u4").tobytes()
                        rows[i] = (numbers[i], None if doc_id == NO_ID else doc_id, first + ahead, ids)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], t) for c, t in enumerate(kinds)], names=["record", "doc_id", "start", "ids"]
            )

    small_batches(spark)
    return picks.select(F.col(record).cast("long").alias("record")).mapInArrow(run, f"record long, {ROWS}")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the files: doc_id, start (ids of all records before it), ids (uint32, little-endian)."""
    rows = [f[:3] for f in files_of(spark, folder)]
    if not rows:
        return spark.createDataFrame([], ROWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = _store(folder)
        for b in batches:
            for name, first, width in zip(*(c.to_pylist() for c in b.columns), strict=True):
                with store.open_input_file(f"{base}/{name}.idx") as f:
                    index = np.frombuffer(f.read(), _INDEX)
                with store.open_input_file(f"{base}/{name}.rec") as f:
                    for at in range(0, len(index), 500):  # consecutive records share a read
                        part = index[at : at + 500]
                        low = int(part["offset"][0])
                        high = int(index["offset"][at + 500]) if at + 500 < len(index) else f.size()
                        f.seek(low)
                        buffer, ids, values = f.read(high - low), [], []
                        for offset, doc_id in zip(part["offset"].tolist(), part["doc_id"].tolist(), strict=True):
                            payload = unframed(buffer, offset - low)
                            if struct.unpack("<q", payload[:8])[0] != doc_id:
                                raise ValueError(f"{name}: index and record differ at {offset}")
                            ids.append(None if doc_id == NO_ID else doc_id)
                            values.append(np.frombuffer(payload, f"<u{width}", offset=8).astype("<u4").tobytes())
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids, pa.int64()),
                                pa.array(part["before"].astype(np.int64) + first, pa.int64()),
                                pa.array(values, pa.binary()),
                            ],
                            names=["doc_id", "start", "ids"],
                        )

    files = spark.createDataFrame(rows, "name string, start long, width int").repartition(len(rows))
    return files.mapInArrow(run, ROWS)


def new_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
