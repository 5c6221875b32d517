"""Token ids as length-delimited binary records, with a separate offset index for shuffled reads.

A data file is a sequence of records in ascending id order:

    8 bytes   length of the body, little endian
    4 bytes   masked checksum of those 8 bytes
    body      int64 id, 1 byte "has an id", 1 byte width of a token (2 or 4), then the tokens, little endian
    4 bytes   masked checksum of the body
    1 byte    0x0A

The checksum is CRC-32; masked means rotated right by 15 bits plus 0xA282EAD8, so that a file of
records does not checksum to a constant. Each data file ``kind=records/part-N...`` has an index file
of the same part number, ``kind=index/part-N...``: one line ``id offset length tokens_before tokens``
for each record. Both are written by one Spark write, so its commit protocol covers retried and
speculative tasks on any file system that Spark can write.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F

from fareline.llm.byte_encode import TEXT_AT_ONCE, encoder
from fareline.llm.text import slices, utf8

SHARD_BYTES = 16 << 20  # text per data file, about
_HEAD, _BODY = struct.Struct("<QI"), struct.Struct("<qBB")
_END = b"\n"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, tokens: bytes, width: int) -> bytes:
    body = _BODY.pack(doc_id or 0, doc_id is not None, width) + tokens
    length = struct.pack("<Q", len(body))
    return b"".join((length, struct.pack("<I", masked(length)), body, struct.pack("<I", masked(body)), _END))


def parse(data: bytes, at: int = 0, one: bool = False) -> Iterator[tuple[int | None, np.ndarray]]:
    """(id, tokens) of the records from a place in a file; a wrong checksum raises ValueError."""
    while at < len(data):
        if at + _HEAD.size > len(data):
            raise ValueError(f"record at {at} is cut off")
        length, check = _HEAD.unpack_from(data, at)
        if masked(data[at : at + 8]) != check:
            raise ValueError(f"record length at {at} is damaged")
        body = data[at + _HEAD.size : at + _HEAD.size + length]
        tail = data[at + _HEAD.size + length : at + _HEAD.size + length + 5]
        if len(body) < length or tail != struct.pack("<I", masked(body)) + _END:
            raise ValueError(f"record body at {at} is damaged")
        doc_id, has_id, width = _BODY.unpack_from(body)
        yield (doc_id if has_id else None), np.frombuffer(body, f"<u{width}", offset=_BODY.size)
        at += _HEAD.size + length + len(tail)
        if one:
            return


def write_records(docs: DataFrame, path: str, model: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> None:
    """Encode each text, append ``end_id`` and write all records in ascending id order below ``path``.

    Null ids come first, equal ids in the order of a hash of their text. A null text counts as
    empty: only the end id. Other columns of ``docs`` are ignored; an empty table writes no record.
    One range exchange of the texts; its bounds also split rows of one id.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows.withColumn("tie", F.xxhash64("text"))
    rows = rows.repartitionByRange(max(1, -(-total // shard_bytes)), "id", "tie").sortWithinPartitions("id", "tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        end, width = np.array([end_id], enc.dtype).tobytes(), enc.dtype.itemsize
        offset, before = 0, 0
        for batch in batches:
            _, sizes = utf8(batch.column(1))
            for a, b in slices(sizes, TEXT_AT_ONCE):
                part = batch.slice(a, b - a)
                data, index = [], []
                for doc_id, ids in zip(part.column(0).to_pylist(), enc.encode_batch(part.column(1))):
                    record, n = frame(doc_id, ids + end, width), len(ids) // width + 1
                    data.append(record)
                    index.append(f"{'' if doc_id is None else doc_id} {offset} {len(record)} {before} {n}".encode())
                    offset, before = offset + len(record), before + n
                # the writer ends every line with 0x0A, the last byte of a record
                values = pa.array([r[:-1] for r in data] + index, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(["records"] * len(data) + ["index"] * len(index)), values], names=["kind", "value"])

    out = rows.select("id", "text").mapInArrow(run, "kind string, value binary").withColumn("at", F.monotonically_increasing_id())
    out = out.sortWithinPartitions("kind", "at").select("kind", F.col("value").cast("string").alias("value"))
    out.write.mode("overwrite").partitionBy("kind").text(path)


def _written(reader: DataFrameReader, path: str, kind: str, schema: str) -> DataFrame:
    """The files of one kind; nothing if no record was ever written."""
    try:
        return reader.load(f"{path}/kind={kind}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        reader.load(path)  # the folder itself must be there
        return SparkSession.active().createDataFrame([], schema)


def _part(col) -> Column:
    return F.regexp_extract(col, r"part-(\d+)", 1).cast("int")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """The offset index: shard, id, offset, length, tokens_before (in its file), n_tokens."""
    lines = _written(spark.read.format("text"), path, "index", "value string").select(_part(F.input_file_name()).alias("shard"), F.split("value", " ").alias("f"))
    return lines.select(
        "shard",
        F.nullif(F.col("f")[0], F.lit("")).cast("long").alias("id"),
        *(F.col("f")[k].cast("long").alias(n) for k, n in enumerate(("offset", "length", "tokens_before", "n_tokens"), 1)),
    )


def _files(spark: SparkSession, path: str) -> DataFrame:
    return _written(spark.read.format("binaryFile"), path, "records", "path string, content binary").select(_part("path").alias("shard"), "content")


def read_records(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """The records of all files, or of the given rows of the index: shard, id, offset, tokens.

    Checksums are verified. With ``wanted`` each file is opened once and only the listed places are
    parsed (a shuffled read); several rows of one place give it several times.
    """
    files = _files(spark, path)
    if wanted is not None:
        files = files.join(wanted.groupBy("shard").agg(F.collect_list("offset").alias("places")), "shard")
    else:
        files = files.withColumn("places", F.lit(None).cast("array<long>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content, places in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                data = content.as_py()
                found = parse(data) if places is None else (next(parse(data, p, True)) for p in places)
                for doc_id, tokens in found:
                    yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([doc_id], pa.int64()), pa.array([tokens.astype(np.int32)], pa.list_(pa.int32()))], names=["shard", "id", "tokens"])

    return files.select("shard", "content", "places").mapInArrow(run, "shard int, id long, tokens array<int>")


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per record, read back from the files: id, start (tokens of all records before it), n_tokens,
    ids_crc32 (CRC-32 of its tokens as little-endian unsigned 32-bit numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, sizes, crcs = [], [], []
                for doc_id, tokens in parse(content.as_py()):
                    ids.append(doc_id)
                    sizes.append(len(tokens))
                    crcs.append(zlib.crc32(tokens.astype("<u4").tobytes()))
                n = np.array(sizes, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(ids), pa.int32()), pa.array(ids, pa.int64()), pa.array(np.cumsum(n) - n), pa.array(n), pa.array(crcs, pa.int64())],
                    names=["shard", "id", "before", "n_tokens", "ids_crc32"],
                )

    found = _files(spark, path).mapInArrow(run, "shard int, id long, before long, n_tokens long, ids_crc32 long")
    # one row per file: how many tokens the files before it hold, from the index
    shards = read_index(spark, path).groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    base = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("base"))
    return found.join(base, "shard").select("id", (F.col("base") + F.col("before")).alias("start"), "n_tokens", "ids_crc32")
