"""Removal of lines that several documents hold.

Every document is exploded into its lines. A line's key is the line without
white space at both ends and with A-Z lower-cased; it is hashed to 128 bits.
Distinct documents are counted per hash, and a hash found in enough documents loses its
lines everywhere but in the document with the smallest id. The lines to drop go
back as positions to the documents, which are put together without them. Text is
read twice and shuffled once; in between only hashes and positions move.

A line that a third of all documents hold is counted by partial aggregates first, and the join that
finds its places is against a written table, so Spark can split it.

Defined results: a null or empty text is one empty line; it stays null if nothing is dropped. Rows with equal
ids count as one document, and keep or lose a line together. A null id is one document, larger than all
others. A text whose lines all go is empty. An empty table gives no rows; other columns are not touched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import free_name, plain_text, release, text_blocks, written
from sedimenta.llm.suffix_dedup import numbered

BLANKS = " \t\n\v\f\r"
MIN_CHARS, MIN_DOCUMENTS = 10, 2
LINES = "row long, doc long, pos int, h1 long, h2 long"


def line_keys(lines: pa.Array) -> pa.Array:
    return pc.ascii_lower(pc.ascii_trim(lines, characters=BLANKS))


def _explode(batches: Iterator[pa.RecordBatch], min_chars: int) -> Iterator[pa.RecordBatch]:
    """Row, document, position and hash of every line whose key is long enough."""
    for block in text_blocks(batches, "text"):
        split = pc.split_pattern(plain_text(block.column("text")), "\n")
        offsets = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        keys = line_keys(split.flatten())
        at = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
        codes = keys.take(pa.array(at)).dictionary_encode()
        digests = b"".join(map(xxhash.xxh3_128_digest, codes.dictionary.cast(pa.large_binary()).to_pylist()))
        hashes = np.frombuffer(digests, "<i8").reshape(-1, 2)[np.asarray(codes.indices)]
        row = np.searchsorted(offsets - offsets[0], at, side="right") - 1
        yield pa.record_batch({
            "row": block.column("row").take(pa.array(row)), "doc": block.column("doc").take(pa.array(row)),
            "pos": pa.array(at - (offsets - offsets[0])[row], pa.int32()),
            "h1": np.ascontiguousarray(hashes[:, 0]), "h2": np.ascontiguousarray(hashes[:, 1])})


def dropped_lines(texts: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(row, dropped): positions of the lines to drop from written texts (row, doc, text); rows that lose none are left out."""
    lines = written(texts.mapInArrow(partial(_explode, min_chars=min_chars), LINES))
    nameless = F.max(F.col("doc").isNull().cast("int"))
    held = lines.groupBy("h1", "h2").agg(
        (F.count_distinct("doc") + nameless).alias("documents"), F.min("doc").alias("keeper"))
    # Written, because an aggregate right below the join would keep AQE from splitting its hot lines.
    repeated = written(held.where(F.col("documents") >= min_documents).select("h1", "h2", "keeper"))
    # Neither side has a proven size, so both joins are merges at every size.
    dropped = lines.join(repeated.hint("merge"), ["h1", "h2"]).where(~F.col("doc").eqNullSafe(F.col("keeper")))
    lists = written(dropped.groupBy("row").agg(F.collect_list("pos").alias("dropped")))
    release(texts.sparkSession, lines, repeated)
    return lists


def keep_lines(text: str, dropped: list[int] | None) -> str:
    if not dropped:
        return text
    gone = set(dropped)
    return "\n".join(line for at, line in enumerate(text.split("\n")) if at not in gone)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "text"):
        texts = plain_text(block.column("text")).to_pylist()
        dropped = block.column("dropped").to_pylist()
        kept = [hashlib.sha256(keep_lines(t, d).encode()).hexdigest() for t, d in zip(texts, dropped, strict=True)]
        yield pa.record_batch({
            "doc_id": block.column("doc"), "n_lines": pa.array([t.count("\n") + 1 for t in texts], pa.int64()),
            "n_dropped": pa.array([len(d or ()) for d in dropped], pa.int64()), "kept_sha256": pa.array(kept, pa.string())})


def digest(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """doc_id, lines, dropped lines and the checksum of the lines kept of every document."""
    rows, number = numbered(docs.select(F.col("doc_id").cast("long").alias("doc"), "text"))
    texts = rows.withColumnRenamed(number, "row")
    found = texts.join(dropped_lines(texts, min_chars, min_documents).hint("merge"), "row", "left")
    return found.select("doc", "text", "dropped").mapInArrow(
        _digests, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def _rewrite(batches: Iterator[pa.RecordBatch], names: list[str], dropped: str) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "text"):
        kept = [t if t is None else keep_lines(t, d) for t, d in zip(
            block.column("text").to_pylist(), block.column(dropped).to_pylist(), strict=True)]
        yield pa.record_batch([pa.array(kept, pa.string()) if n == "text" else block.column(n) for n in names], names)


def without_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """The documents without the lines that others hold too; all rows and columns stay.

    A column n_chars, if there is one, is counted again.
    """
    rows, number = numbered(docs)
    texts = rows.select(F.col(number).alias("row"), F.col("doc_id").cast("long").alias("doc"), "text")
    name = free_name(rows, "__dropped")
    lists = dropped_lines(texts, min_chars, min_documents).select(F.col("row").alias(number), F.col("dropped").alias(name))
    kept = rows.join(lists.hint("merge"), number, "left").select(*docs.columns, name).mapInArrow(
        partial(_rewrite, names=docs.columns, dropped=name), docs.schema)
    if "n_chars" in docs.columns:
        counted = F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", counted)
    return kept.select(docs.columns)
