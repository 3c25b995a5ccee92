"""Importance resampling towards a target distribution, with weights from bit-sliced bucket counts.

Features are the words and the pairs of neighbouring words of a text, hashed to
10,000 buckets by crc32. A bucket's gain is the scaled log ratio of its smoothed
share in the target to that in the corpus; a document's weight is the mean gain of its
features, and its score adds noise from the hash of its id, so that taking the highest
scores draws without replacement in proportion to the exponential of the weights.

The sum of gains is exact integer work on bit planes: bit i of the counts of all
buckets is a plane of 10,000 bits, and so is bit j of the gains, once for positive and once
for negative ones. A plane of counts AND a plane of gains, its ones counted, stands for 2**(i + j) a one.

Corpus counts are one sum a bucket in each task, added by one shuffle of at most 10,000 rows a task; totals
and gains (10,000 numbers) go through the driver. The rank of the drawn documents comes from a range shuffle and
the sizes of its partitions, so no task sees them all.

Defined results: a null or empty text has no feature, and weight 0. A null id hashes as an empty one and comes after all others
among equal scores; rows that tie in both follow their place in the input. Equal rows are drawn each for itself. An empty
table gives no rows; an empty target gives gains of its smoothing alone. Other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import plain_text, shuffle_partitions, text_blocks, utf8_bytes, written
from sedimenta.llm.suffix_dedup import numbered

BUCKETS = 10_000
WORDS = -(-BUCKETS // 64)
SCALE = 1000
MIN_WORDS, PERCENT, SEED = 20, 25, 7
# Rows whose bucket counts are held at a time, and bytes of one text read at a time.
ROWS, STRETCH = 256, 4 << 20
TABLED = 64

# What a byte is in a word, lower-cased; 0 ends a word.
_BYTE = np.arange(256, dtype=np.uint8)
_IN_WORD = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_LOWER = np.where(_IN_WORD, np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE), 0).astype(np.uint8)


def _crc_shifts() -> np.ndarray:
    """[length, byte, value]: what a crc32 becomes once ``length`` bytes follow, apart from the crc32 of those."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = (table >> np.uint32(1)) ^ np.where(table & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    held = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [held]
    for _ in range(TABLED):
        held = table[held & np.uint32(255)] ^ (held >> np.uint32(8))
        out.append(held)
    return np.stack(out)


_SHIFTS = _crc_shifts()


def word_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes (0 outside words), and starts and ends of the words; none crosses a row."""
    low = _LOWER[data]
    inside = low != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
    ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
    return low, starts, ends


def feature_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row and bucket of every word, then row and bucket of every pair of neighbouring words; rows ascend."""
    low, starts, ends = word_runs(data, offsets)
    rows = np.searchsorted(offsets, starts, side="right") - 1
    ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)), pa.py_buffer(low[low != 0])])
    coded = ids.dictionary_encode()
    words = coded.dictionary.to_pylist()
    code = np.asarray(coded.indices)
    crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
    spaced = np.fromiter((zlib.crc32(b" ", c) for c in crc.tolist()), np.uint32, len(words))
    length = np.fromiter(map(len, words), np.int64, len(words))

    pair = np.flatnonzero(rows[1:] == rows[:-1])
    first, second = code[pair], code[pair + 1]
    head, size = spaced[first], np.minimum(length[second], TABLED)
    joined = crc[second]
    for byte in range(4):
        joined = joined ^ _SHIFTS[size, byte, (head >> np.uint32(8 * byte)) & np.uint32(255)]
    for at in np.flatnonzero(length[second] > TABLED):
        joined[at] = zlib.crc32(words[second[at]], int(head[at]))
    return rows, (crc % BUCKETS)[code].astype(np.int64), rows[pair], (joined % BUCKETS).astype(np.int64)


def stretches(data: np.ndarray, size: int = STRETCH) -> Iterator[tuple[np.ndarray, bool]]:
    """The bytes of one row in parts cut between words, and whether a part starts with the last word before it again."""
    begin, end, again = 0, 0, False
    while end < len(data):
        end = min(end + size, len(data))
        while end < len(data):  # on to the end of the word
            ahead = np.flatnonzero(_LOWER[data[end:end + size]] == 0)
            end = end + int(ahead[0]) if len(ahead) else min(end + size, len(data))
            if len(ahead):
                break
        yield data[begin:end], again
        inside = _LOWER[data[begin:end]] != 0
        again = bool(inside.any())
        last = len(inside) - int(np.argmax(inside[::-1]))
        gaps = np.flatnonzero(~inside[:last])
        # The last word is read again, for the pair it makes with the next one.
        begin = begin + (int(gaps[-1]) + 1 if len(gaps) else 0) if again else end


def _counts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, counts (row, bucket) and words of a few rows at a time."""
    if len(offsets) == 2 and len(data) > STRETCH:
        counts, words = np.zeros(BUCKETS, np.int64), 0
        for part, again in stretches(data):
            rows, single, _, pairs = feature_buckets(part, np.array([0, len(part)]))
            counts += np.bincount(single[int(again):], minlength=BUCKETS) + np.bincount(pairs, minlength=BUCKETS)
            words += len(rows) - int(again)
        yield 0, counts[None, :], np.array([words])
        return
    rows, single, pair_rows, pairs = feature_buckets(data, offsets)
    for first in range(0, len(offsets) - 1, ROWS):
        last = min(first + ROWS, len(offsets) - 1)
        a, b = np.searchsorted(rows, (first, last))
        c, d = np.searchsorted(pair_rows, (first, last))
        place = np.concatenate([(rows[a:b] - first) * BUCKETS + single[a:b], (pair_rows[c:d] - first) * BUCKETS + pairs[c:d]])
        yield (first, np.bincount(place, minlength=(last - first) * BUCKETS).reshape(-1, BUCKETS),
               np.bincount(rows[a:b] - first, minlength=last - first))


def _corpus(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, np.int64)
    for block in text_blocks(batches, "text"):
        data, offsets = utf8_bytes(plain_text(block.column("text")))
        if block.num_rows == 1:
            total += sum(counts[0] for _, counts, _ in _counts(data, offsets))
        else:
            _, single, _, pairs = feature_buckets(data, offsets)
            total += np.bincount(single, minlength=BUCKETS) + np.bincount(pairs, minlength=BUCKETS)
    held = np.flatnonzero(total)
    yield pa.record_batch({"bucket": pa.array(held, pa.int32()), "n": total[held]})


def bucket_totals(texts: DataFrame) -> np.ndarray:
    """Features in each bucket over all texts: at most as many rows as buckets come to the driver."""
    counted = texts.select("text").mapInArrow(_corpus, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in counted.collect():
        out[row.bucket] = row.n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored scaled log ratio of each bucket's share in the target to that in the corpus, one added to every bucket."""
    all_corpus, all_target = float(int(corpus.sum()) + BUCKETS), float(int(target.sum()) + BUCKETS)
    return np.array([math.floor(SCALE * math.log((t + 1) * all_corpus / ((s + 1) * all_target)))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def to_planes(values: np.ndarray) -> list[np.ndarray]:
    """Plane i holds bit i of every value of a row, a bit a bucket, in 64-bit words."""
    values = np.atleast_2d(values)
    planes = []
    for bit in range(int(values.max(initial=0)).bit_length()):
        packed = np.packbits((values >> bit & 1).astype(np.uint8), axis=1, bitorder="little")
        held = np.zeros((len(values), 8 * WORDS), np.uint8)
        held[:, :packed.shape[1]] = packed
        planes.append(held.view(np.uint64))
    return planes


def sliced_sums(counts: np.ndarray, gains: tuple[list[np.ndarray], list[np.ndarray]]) -> np.ndarray:
    """Sum of counts times gains of every row, from the planes of positive and negative gains."""
    out = np.zeros(len(counts), np.int64)
    for i, ones in enumerate(to_planes(counts.astype(np.int32) if counts.max(initial=0) < 1 << 31 else counts)):
        for sign, planes in zip((1, -1), gains, strict=True):
            for j, plane in enumerate(planes):
                out += sign * (np.bitwise_count(ones & plane).sum(axis=1, dtype=np.int64) << (i + j))
    return out


def _weights(batches: Iterator[pa.RecordBatch], gains: np.ndarray) -> Iterator[pa.RecordBatch]:
    planes = to_planes(np.maximum(gains, 0)), to_planes(np.maximum(-gains, 0))
    for block in text_blocks(batches, "text"):
        data, offsets = utf8_bytes(plain_text(block.column("text")))
        for first, counts, words in _counts(data, offsets):
            part, features = block.slice(first, len(counts)), counts.sum(axis=1)
            sums = sliced_sums(counts, planes)
            yield pa.record_batch({
                "row": part.column("row"), "doc_id": part.column("doc_id"), "n_features": features,
                "n_words": words.astype(np.int64),
                "weight": np.where(features > 0, sums // np.maximum(features, 1), 0)})


def scored(texts: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """Row, doc_id, n_features, n_words, weight and score of written texts (row, doc_id, text). Written."""
    gains = bucket_gains(bucket_totals(texts), bucket_totals(target))
    weighed = texts.mapInArrow(partial(_weights, gains=gains),
                               "row long, doc_id long, n_features long, n_words long, weight long")
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / float(1 << 32))))
    return written(weighed.withColumn("score", F.col("weight") + noise))


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        batch = batch.append_column("part", pa.array(np.full(batch.num_rows, part, np.int32)))
        yield batch.append_column("place", pa.array(np.arange(at, at + batch.num_rows)))
        at += batch.num_rows


def ranked(scores: DataFrame, min_words: int = MIN_WORDS, percent: int = PERCENT) -> DataFrame:
    """Written scores with ``rank``: 1, 2, 3... for the drawn rows, null for all others."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    able = scores.where(F.col("n_words") >= min_words)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in scores.schema)
    placed = written(able.repartitionByRange(shuffle_partitions(scores.sparkSession), *order).sortWithinPartitions(*order)
                     .mapInArrow(_places, f"{columns}, part int, place long"))
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    # One row a partition of the range shuffle.
    every = Window.orderBy("part")
    bases = sizes.select(
        "part", F.coalesce(F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(every.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("all"))
    rank = F.col("base") + F.col("place") + 1
    drawn = placed.join(F.broadcast(bases), "part").withColumn(
        "rank", F.when(rank * 100 <= F.col("all") * percent, rank)).select(*scores.columns, "rank")
    return drawn.unionAll(scores.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long")))


def digest(docs: DataFrame, target: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document."""
    rows, number = numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    scores = scored(rows.withColumnRenamed(number, "row"), target)
    return ranked(scores).select("doc_id", "n_features", "weight", "score", "rank")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """The drawn documents with all their columns: ``percent`` of those with enough words, likest to the target first to go in."""
    rows, number = numbered(docs)
    texts = rows.select(F.col(number).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    drawn = ranked(scored(texts, target, seed), min_words, percent).where("rank is not null")
    return rows.join(drawn.select(F.col("row").alias(number)), number, "left_semi").select(docs.columns)
