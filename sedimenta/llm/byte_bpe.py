"""Byte-level BPE by one global shuffle of distinct words.

A task cuts its texts into words and keeps, for every block of texts, the
positions of the words and the distinct words. The distinct words go, packed
by their hash, to as many buckets as there are shuffle partitions; a bucket
encodes each of its words once, whatever number of blocks and rows hold it,
and sends the ids back to the blocks that asked. There they are put at their
positions again. What is shuffled is compressed and grows with the distinct
words of a block, so a word that is in every text costs one entry a block.

A word here is a piece between single spaces, with the space before it: the
pattern never joins anything across the place before a space that has no white space
beside it, and only there texts with longer runs of white space are cut. The pattern is applied inside a piece.

Decoding joins the byte table: one entry for each id, at most the size of the
vocabulary, which every task loads from the rank file.

Defined results: a null text is an empty one and has no ids; equal rows give
equal rows; an empty table gives no rows; columns other than the id and the
text are not read. The input must be read alike twice, as files are: the
blocks are cut in two branches of one plan, and a block whose words do not
match raises.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import BLOCK_BYTES, give_back, plain_text, ragged_rows, shuffle_partitions, text_blocks
from sedimenta.llm.vocab import spaced_pieces

PACKED = "block long, bucket int, words long, data binary"
ENCODED = "doc_id long, ids binary"
DECODED = "doc_id long, bytes binary"

_LOADED: dict[str, object] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Bytes and id of every entry of a rank file."""
    if path not in _LOADED:
        with open(path, "rb") as lines:
            _LOADED[path] = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return _LOADED[path]


def load_encoding(path: str, pattern: str):
    if (path, pattern) not in _LOADED:
        import tiktoken

        _LOADED[path, pattern] = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=load_ranks(path), special_tokens={})
    return _LOADED[path, pattern]


def byte_table(path: str) -> list[bytes]:
    """The bytes of every id, empty where an id has none."""
    ranks = load_ranks(path)
    table = [b""] * (max(ranks.values(), default=-1) + 1)
    for token, number in ranks.items():
        table[number] = token
    return table


def _pack(array: np.ndarray) -> bytes:
    return zstandard.compress(array.tobytes(), 3)


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def _join_words(words: list[bytes]) -> bytes:
    """Words as one compressed text: lengths first, then their bytes."""
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.compress(lengths.tobytes() + b"".join(words), 3)


def _split_words(data: bytes, count: int) -> list[bytes]:
    plain = zstandard.decompress(data)
    ends = np.cumsum(np.frombuffer(plain, "<u4", count).astype(np.int64)) + 4 * count
    return [plain[a:b] for a, b in zip([4 * count, *ends[:-1].tolist()], ends.tolist(), strict=True)]


def _bucket_of(words: list[bytes], buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list, list[bytes], np.ndarray, np.ndarray]]:
    """Number, doc_ids, distinct words, codes and row offsets of every block of the task's texts."""
    part = TaskContext.get().partitionId()
    for number, block in enumerate(text_blocks(batches, "text", BLOCK_BYTES)):
        codes, words, offsets = spaced_pieces(plain_text(block.column("text")))
        yield (part << 32) + number, block.column("doc_id").to_pylist(), [
            w.encode() for w in words.to_pylist()], codes, offsets


def _words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for block, _, words, _, _ in _cut(batches):
        bucket = _bucket_of(words, buckets)
        order = np.argsort(bucket, kind="stable")
        used, first = np.unique(bucket[order], return_index=True)
        groups = np.split(order, first[1:])
        yield pa.record_batch({
            "block": pa.array([block] * len(used), pa.int64()), "bucket": pa.array(used.astype(np.int32)),
            "words": pa.array([len(g) for g in groups], pa.int64()),
            "data": pa.array([_join_words([words[i] for i in g]) for g in groups], pa.binary())})


def _positions(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """One row a block: its doc_ids, the words of each text, and the codes in the order of the buckets' answers."""
    for block, doc_ids, words, codes, offsets in _cut(batches):
        order = np.argsort(_bucket_of(words, buckets), kind="stable")
        place = np.empty(len(words), "<u4")
        place[order] = np.arange(len(words))
        ids = pa.array(doc_ids, pa.int64())
        known = np.array([d is not None for d in doc_ids], np.uint8)
        head = np.array([len(doc_ids), len(words)], "<i8").tobytes()
        parts = [head, known.tobytes(), ids.fill_null(0).to_numpy().astype("<i8").tobytes(),
                 np.diff(offsets).astype("<i8").tobytes(), place[codes].tobytes()]
        yield pa.record_batch({
            "block": pa.array([block], pa.int64()), "bucket": pa.array([-1], pa.int32()),
            "words": pa.array([len(words)], pa.int64()),
            "data": pa.array([zstandard.compress(b"".join(parts), 3)], pa.binary())})


def _encode_bucket(group: pd.DataFrame, path: str, pattern: str) -> pd.DataFrame:
    """Encode each distinct word of a bucket once and answer every block that holds it."""
    encoding, known, answers = load_encoding(path, pattern), {}, []
    for count, data in zip(group["words"], group["data"], strict=True):
        words = _split_words(data, count)
        for word in words:
            if word not in known:
                known[word] = encoding.encode_ordinary(word.decode())
        ids = [known[w] for w in words]
        lengths = np.fromiter(map(len, ids), "<u4", len(ids))
        flat = np.fromiter((i for w in ids for i in w), "<u4")
        answers.append(_pack(np.concatenate([lengths, flat])))
    del known
    give_back()
    return pd.DataFrame({"block": group["block"], "bucket": group["bucket"], "words": group["words"],
                         "data": answers})


def _reassemble(positions: pd.DataFrame, answers: pd.DataFrame) -> tuple[pd.api.extensions.ExtensionArray, Iterator]:
    """The doc_ids of a block and the ids of its texts, some of which are put together at a time."""
    if len(positions) != 1 or positions["words"].iloc[0] != answers["words"].sum():
        raise RuntimeError("a block was not read alike twice; write the input before encoding it")
    lengths, flats = [np.zeros(0, "<u4")], [np.zeros(0, "<u4")]
    for count, data in answers.sort_values("bucket")[["words", "data"]].itertuples(index=False):
        both = _unpack(data, "<u4")
        lengths.append(both[:count])
        flats.append(both[count:])
    flat = np.concatenate(flats)
    starts = np.concatenate([[0], np.cumsum(np.concatenate(lengths), dtype=np.int64)])
    data = zstandard.decompress(positions["data"].iloc[0])
    docs = int(np.frombuffer(data, "<i8", 1)[0])
    known = np.frombuffer(data, np.uint8, docs, 16)
    doc_ids = pd.array(np.frombuffer(data, "<i8", docs, 16 + docs).copy(), "Int64")
    doc_ids[known == 0] = pd.NA
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<i8", docs, 16 + 9 * docs))])
    codes = np.frombuffer(data, "<u4", offset=16 + 17 * docs)
    return doc_ids, ragged_rows(flat, starts, codes, ends)


def _ids(positions: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    doc_ids, rows = _reassemble(positions, answers)
    return pd.DataFrame({"doc_id": doc_ids, "ids": [ids.tobytes() for ids in rows]})


def _by_block(docs: DataFrame, ranks_path: str, pattern: str, buckets: int | None, finish, schema: str) -> DataFrame:
    buckets = buckets or shuffle_partitions(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = narrow.mapInArrow(partial(_words, buckets=buckets), PACKED)
    positions = narrow.mapInArrow(partial(_positions, buckets=buckets), PACKED)
    answers = words.groupBy("bucket").applyInPandas(
        lambda group: _encode_bucket(group, ranks_path, pattern), PACKED)
    return positions.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(finish, schema)


def encode(docs: DataFrame, ranks_path: str, pattern: str, buckets: int | None = None) -> DataFrame:
    """doc_id and ids (32-bit little endian) of every document."""
    return _by_block(docs, ranks_path, pattern, buckets, _ids, ENCODED)


def decode_ids(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join(map(table.__getitem__, ids.tolist()))


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    table = byte_table(path)
    for batch in batches:
        texts = [decode_ids(np.frombuffer(i, "<u4"), table) for i in batch.column("ids").to_pylist()]
        yield pa.record_batch({"doc_id": batch.column("doc_id"), "bytes": pa.array(texts, pa.binary())})


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id and the bytes its ids stand for."""
    return encoded.select("doc_id", "ids").mapInArrow(partial(_decode, path=ranks_path), DECODED)


def _round_trip(positions: pd.DataFrame, answers: pd.DataFrame, path: str) -> pd.DataFrame:
    table = byte_table(path)
    doc_ids, rows = _reassemble(positions, answers)
    out = [(len(ids), hashlib.sha256(ids.astype("<u4", copy=False)).hexdigest(),
            hashlib.sha256(decode_ids(ids, table)).hexdigest()) for ids in rows]
    del rows
    give_back()
    return pd.DataFrame(out, columns=["n_tokens", "ids_sha256", "decoded_sha256"]).assign(doc_id=doc_ids)


def digest(docs: DataFrame, ranks_path: str, pattern: str, buckets: int | None = None) -> DataFrame:
    """Length and checksum of the ids of every document, and the checksum of what they decode to.

    The same as ``decode`` after ``encode``, but a block's ids are not sent anywhere in between.
    """
    return _by_block(docs, ranks_path, pattern, buckets, lambda p, a: _round_trip(p, a, ranks_path),
                     "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
