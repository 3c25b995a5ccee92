"""Token ids as length-delimited binary records, with an offset index beside them.

A file holds the documents of one range of ids, in ascending order, one record
for each. A record is

    length of the payload       8 bytes, unsigned, little endian
    masked crc32 of the length  4 bytes
    payload                     doc_id (8 bytes, signed), flags (1 byte), then ids of 2 or 4 bytes
    masked crc32 of the payload 4 bytes
    line feed                   1 byte

A mask rotates the checksum by 15 bits and adds a constant, so that a file of
records can itself be a payload. Spark's text writer puts the records into
files byte by byte, so any file system, commit protocol or retry that Spark
knows works here too. The index holds file, offset and length of each record,
and the ids before it in its file: a reader that shuffles can open any record.

Defined results: a null or empty text is the end token alone. Equal doc_ids are
ordered by the hash of their text, and may lie in several files. A null doc_id
comes first and is read back as null. An empty table gives an empty folder and no
rows. Columns other than the id and the text are not read.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import plain_text, shuffle_partitions, text_blocks, written
from sedimenta.llm.vocab import TEXT_BYTES, encode_by_spaced_words, load_tokenizer
from sedimenta.sources.scratch import new_scratch

END_ID = 2
MASK_DELTA = 0xA282EAD8
HEAD, FLAGS = struct.Struct("<QI"), struct.Struct("<qB")
NULL_ID, WIDE_IDS = 1, 2
# Bytes of records that are handed on together.
READ_BYTES = 4 << 20
RECORDS = "doc_id long, offset long, length long, before long, n_tokens long, ids binary"


class CorruptRecord(ValueError):
    """A length or a checksum of a record file does not fit its bytes."""


def masked_crc(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """The record of a payload, without its line feed: the writer adds that."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload,
                     struct.pack("<I", masked_crc(payload))))


def unframe(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, payload) of every record of a file; raises at the first byte that does not fit."""
    at = 0
    while at < len(data):
        if at + HEAD.size > len(data):
            raise CorruptRecord(f"the record at byte {at} is cut off")
        length, crc = HEAD.unpack_from(data, at)
        end = at + HEAD.size + length
        if masked_crc(data[at:at + 8]) != crc or end + 5 > len(data):
            raise CorruptRecord(f"the record at byte {at} has a wrong length")
        payload = bytes(data[at + HEAD.size:end])
        if struct.unpack_from("<I", data, end)[0] != masked_crc(payload) or data[end + 4] != 10:
            raise CorruptRecord(f"the record at byte {at} has a wrong checksum")
        yield at, payload
        at = end + 5


def to_payload(doc_id: int | None, ids: np.ndarray) -> bytes:
    wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
    flags = NULL_ID * (doc_id is None) | WIDE_IDS * wide
    return FLAGS.pack(doc_id or 0, flags) + ids.astype("<u4" if wide else "<u2").tobytes()


def from_payload(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, flags = FLAGS.unpack_from(payload)
    ids = np.frombuffer(payload, "<u4" if flags & WIDE_IDS else "<u2", offset=FLAGS.size)
    return None if flags & NULL_ID else doc_id, ids.astype("<u4")


def _records(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    tokenizer = load_tokenizer(path)
    for block in text_blocks(batches, "text", TEXT_BYTES):
        encoded = encode_by_spaced_words(tokenizer, plain_text(block.column("text")))
        records = [frame(to_payload(d, np.append(ids, end_id)))
                   for d, ids in zip(block.column("doc_id").to_pylist(), encoded, strict=True)]
        yield pa.record_batch({"record": pa.array(records, pa.binary())})


def write_token_files(docs: DataFrame, tokenizer_path: str, folder: str, files: int | None = None,
                      end_id: int = END_ID) -> None:
    """Encode all documents and write them in ascending doc_id order as ``files`` record files.

    By default there are as many as the table has scan tasks, which grow with its bytes, or as the session has shuffle partitions.
    """
    files = files or max(shuffle_partitions(docs.sparkSession), docs.rdd.getNumPartitions())
    key = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ordered = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
               .repartitionByRange(files, *key).sortWithinPartitions(*key))
    records = ordered.mapInArrow(partial(_records, path=tokenizer_path, end_id=end_id), "record binary")
    # A string column is written as the bytes it holds; the line feed that ends a record is the separator.
    records.select(F.expr("cast(record as string)").alias("value")).write.mode("errorifexists").option(
        "lineSep", "\n").text(folder)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["path", "doc_id", "offset", "length", "before", "n_tokens", "ids"]
    types = [pa.string(), *[pa.int64()] * 5, pa.binary()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            before, rows, held = 0, [], 0
            for offset, payload in unframe(memoryview(content.as_buffer())):
                doc_id, ids = from_payload(payload)
                size = HEAD.size + len(payload) + 5
                rows.append((path, doc_id, offset, size, before, len(ids), ids.tobytes()))
                before += len(ids)
                held += size
                if held > READ_BYTES:
                    yield batch_of(rows)
                    rows, held = [], 0
            if rows:
                yield batch_of(rows)


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the files, checked: path, offset, length, doc_id, ids, and the ids before it in its file."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return found.select("path", "content").mapInArrow(_read, f"path string, {RECORDS}")


def with_starts(records: DataFrame) -> DataFrame:
    """Adds ``start``, the ids before a record in all files in the order of their numbers; one row a file is summed."""
    number = F.regexp_extract("path", r"part-(\d+)[^/]*$", 1).cast("long")
    order = Window.orderBy(number, "path").rowsBetween(Window.unboundedPreceding, -1)
    totals = records.groupBy("path").agg(F.sum("n_tokens").alias("tokens"))
    bases = totals.select("path", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))
    return (records.join(F.broadcast(bases), "path")
            .withColumn("start", F.col("base") + F.col("before")).drop("base"))


def write_index(spark: SparkSession, folder: str, index_folder: str) -> None:
    """The offset index: path, offset, length, doc_id, start and n_tokens of every record, as Parquet."""
    # The files are read once; what is summed and joined are the narrow rows written from that.
    records = written(read_token_files(spark, folder).drop("ids"))
    with_starts(records).select("path", "offset", "length", "doc_id", "start", "n_tokens").write.mode(
        "errorifexists").parquet(index_folder)


def encode_to_files(docs: DataFrame, tokenizer_path: str, folder: str | None = None, files: int | None = None,
                    end_id: int = END_ID) -> str:
    """Write the record files and their index into a folder, by default a new shared one, and return it."""
    spark = docs.sparkSession
    folder = folder or new_scratch(spark)
    write_token_files(docs, tokenizer_path, f"{folder}/records", files, end_id)
    write_index(spark, f"{folder}/records", f"{folder}/index")
    return folder


def digest(spark: SparkSession, folder: str) -> DataFrame:
    """One row a document, from the files: its place in the whole stream and the checksum of its ids."""
    index = spark.read.schema("path string, offset long, start long").parquet(f"{folder}/index")
    held = read_token_files(spark, f"{folder}/records").select(
        "path", "offset", "doc_id", "n_tokens", F.crc32("ids").alias("ids_crc32"))
    return held.join(index, ["path", "offset"]).select("doc_id", "start", "n_tokens", "ids_crc32")
