"""Concatenate and cut: documents become one stream of tokens, cut into windows of one length.

Two passes. The first encodes every document once, writes its ids to the
shared folder and counts the tokens before it in its partition. The totals of
the partitions, one row each, give every partition its global offset; the
second pass cuts the written ids at the window borders. A document across a
border leaves a piece in each window, so only the last window needs padding.

Defined results: a null or empty text is its end token alone; equal rows are
packed as often as they come; an empty table gives no piece; a null id stays
null; columns other than the id and the text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import plain_text, text_blocks, written
from sedimenta.llm.vocab import KEPT_BYTES, TEXT_BYTES, encode_by_words, load_tokenizer

WINDOW = 2048
END_ID = 1
STAGED = "doc_id long, part int, before long, doc_tokens long, ids binary"
PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def _encode(batches: Iterator[pa.RecordBatch], path: str, end_id: int, text_bytes: int, kept_bytes: int
            ) -> Iterator[pa.RecordBatch]:
    tokenizer, part, before = load_tokenizer(path), TaskContext.get().partitionId(), 0
    for block in text_blocks(batches, "text", text_bytes):
        ids = [np.append(row, end_id).astype("<u4").tobytes()
               for row in encode_by_words(tokenizer, plain_text(block.column("text")), kept_bytes)]
        tokens = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = before + np.cumsum(tokens) - tokens
        before += int(tokens.sum())
        yield pa.record_batch({
            "doc_id": block.column("doc_id").cast(pa.int64()), "part": pa.array(np.full(len(ids), part, np.int32)),
            "before": starts, "doc_tokens": tokens, "ids": pa.array(ids, pa.binary())})


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_ids, ids = batch.column("doc_id").to_pylist(), batch.column("ids")
        first = batch.column("first").to_numpy()
        tokens = batch.column("doc_tokens").to_numpy()
        pieces = (first + tokens - 1) // window - first // window + 1
        row = np.repeat(np.arange(len(tokens)), pieces)
        number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        sequence = first[row] // window + number
        begin = np.maximum(first[row], sequence * window)
        end = np.minimum((first + tokens)[row], (sequence + 1) * window)
        start = begin - first[row]
        length = end - begin
        whole = ids.to_pylist()
        cut = [whole[r][4 * s:4 * (s + n)] for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(),
                                                            strict=True)]
        yield pa.record_batch({
            "doc_id": pa.array([doc_ids[r] for r in row], pa.int64()), "start": start, "length": length,
            "doc_tokens": tokens[row], "sequence_id": sequence, "offset": begin - sequence * window,
            "ids": pa.array(cut, pa.binary())})


def stage_tokens(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, text_bytes: int = TEXT_BYTES,
                 kept_bytes: int = KEPT_BYTES) -> DataFrame:
    """First pass: ids of every document (32-bit little endian) and the tokens before it in its partition."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return written(narrow.mapInArrow(partial(
        _encode, path=tokenizer_path, end_id=end_id, text_bytes=text_bytes, kept_bytes=kept_bytes), STAGED))


def pack(docs: DataFrame, tokenizer_path: str, window: int = WINDOW, end_id: int = END_ID, text_bytes: int = TEXT_BYTES,
         kept_bytes: int = KEPT_BYTES) -> DataFrame:
    """Pieces of the documents with their place in the stream; see the module for the rules.

    ``text_bytes`` of text are encoded at a time, and a worker keeps ``kept_bytes`` of words for its next task. With less of
    both, workers that other steps use too take less memory and encode more words again; the pieces are the same.
    """
    staged = stage_tokens(docs, tokenizer_path, end_id, text_bytes, kept_bytes)
    totals = staged.groupBy("part").agg(F.sum("doc_tokens").alias("tokens"))
    # One row for each partition of the input: the prefix sum over them is small.
    order = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("tokens").over(order), F.lit(0)).alias("base"))
    placed = staged.join(F.broadcast(bases), "part").select(
        "doc_id", "doc_tokens", (F.col("base") + F.col("before")).alias("first"), "ids")
    return placed.mapInArrow(partial(_cut, window=window), PIECES)


def padded_length(length: int, window: int = WINDOW) -> int:
    """What a sequence is padded to: the window, unless it ends at a power of two."""
    return length if length > 0 and length & (length - 1) == 0 else window


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids instead of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
