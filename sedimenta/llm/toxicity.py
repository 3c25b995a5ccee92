"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

The features of a text are the hashes of its words, of its pairs of
neighbouring words and of its pairs with one word between, each counted once.
Every coordinate has its own learning rate, and L1 keeps a weight at exactly
zero until there is evidence for it, so the fitted model is a short list of
(index, weight) that is sent to every task: at most one entry for each feature
of the sampled rows.

Words are cut at white space, put in lower case and freed of punctuation at
both ends. Defined results: a null or empty text scores by the bias alone; equal
texts score alike; an empty table gives no rows; without labels, or with one
class only, the score is the rate of that class. All columns of the input
are kept, and only the text is read.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import plain_text, text_blocks, words_of
from sedimenta.llm.labelled import training_sample

BITS = 20
TRAINING_ROWS = 12_000
# Bytes of text scored at a time: features take some twenty times as much.
TEXT_BYTES = 4 << 20
SCORE = "__toxicity"
# Odd multipliers that spread word hashes over 64 bits, one for each place in a feature.
FIRST, SECOND, SKIPPED = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass(frozen=True)
class FtrlModel:
    bias: float
    index: np.ndarray
    weight: np.ndarray
    bits: int = BITS

    def dense(self) -> np.ndarray:
        weights = np.zeros(1 << self.bits, np.float32)
        weights[self.index] = self.weight
        return weights


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, and the offsets of the texts; a mark of punctuation alone stays a word."""
    spaced = pc.replace_substring_regex(texts, r"\s+", " ")
    codes, words, offsets = words_of(spaced)
    plain = (w.lower() for w in words.to_pylist())
    known = np.fromiter((zlib.crc32((w.strip(string.punctuation) or w).encode()) for w in plain), np.uint64,
                        len(words))
    return (known + np.uint64(1))[codes], offsets


def features(hashes: np.ndarray, offsets: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, index) of the words, then of the word pairs, then of the pairs with a word between."""
    shift = np.uint64(64 - bits)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    first = hashes * FIRST
    yield row, ((first ^ first >> np.uint64(29)) * SECOND >> shift).astype(np.int64)
    for gap, factor in ((1, SECOND), (2, SKIPPED)):
        mixed = first[:-gap] + hashes[gap:] * factor
        mixed = (mixed ^ mixed >> np.uint64(31)) * FIRST >> shift
        same = row[:-gap] == row[gap:] if gap < len(row) else np.zeros(0, bool)
        yield row[:len(same)][same], mixed[:len(same)][same].astype(np.int64)


def _training_features(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "text", TEXT_BYTES):
        hashes, offsets = word_hashes(plain_text(block.column("text")))
        found = [np.zeros(0, np.int64)]
        for row, index in features(hashes, offsets, bits):
            found.append(np.unique(row << 32 | index))
        pairs = np.unique(np.concatenate(found))
        cuts = np.searchsorted(pairs >> 32, np.arange(block.num_rows + 1))
        index = (pairs & 0xFFFFFFFF).astype("<u4")
        yield pa.record_batch({
            "doc_id": block.column("doc_id"), "label": block.column("label"),
            "features": pa.array([index[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                                 pa.binary())})


def fit_ftrl(examples: list[tuple[np.ndarray, int]], bits: int = BITS, alpha: float = 2.0, beta: float = 1.0,
             l1: float = 4.0, l2: float = 0.1, epochs: int = 5) -> FtrlModel:
    """FTRL-proximal over (feature indices, label) in the given order; the last coordinate is the bias."""
    size = 1 << bits
    labels = [y for _, y in examples]
    rate = (sum(labels) + 0.5) / (len(labels) + 1)
    start = float(np.log(rate / (1 - rate)))
    if len(set(labels)) < 2:
        return FtrlModel(start, np.zeros(0, np.int64), np.zeros(0, np.float32), bits)
    z, n, bias, bias_n = np.zeros(size), np.zeros(size), start, 0.0

    def weights(at):
        away = np.maximum(np.abs(z[at]) - l1, 0)
        return -np.sign(z[at]) * away / ((beta + np.sqrt(n[at])) / alpha + l2)

    for _ in range(epochs):
        for at, y in examples:
            w = weights(at)
            gradient = 1 / (1 + np.exp(-np.clip(w.sum() + bias, -35, 35))) - y
            root = np.sqrt(n[at])
            n[at] += gradient * gradient
            z[at] += gradient - (np.sqrt(n[at]) - root) / alpha * w
            bias_n += gradient * gradient
            bias -= alpha * gradient / (beta + np.sqrt(bias_n))
    every = weights(slice(None))
    index = np.flatnonzero(every)
    return FtrlModel(float(bias), index, every[index].astype(np.float32), bits)


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, bits: int = BITS) -> FtrlModel:
    """Learn from at most ``rows`` labelled documents, whose hashed features alone come to the driver."""
    sample = training_sample(docs, labels, "toxic", rows)
    found = sample.mapInArrow(partial(_training_features, bits=bits), "doc_id long, label int, features binary")
    drawn = sorted(found.collect(), key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.features))
    return fit_ftrl([(np.frombuffer(r.features, "<u4"), int(r.label)) for r in drawn], bits)


def _score(batches: Iterator[pa.RecordBatch], text: str, model: FtrlModel) -> Iterator[pa.RecordBatch]:
    weights = model.dense()
    for block in text_blocks(batches, text, TEXT_BYTES):
        hashes, offsets = word_hashes(plain_text(block.column(text)))
        total = np.full(block.num_rows, model.bias)
        held = [np.zeros(0, np.int64)]
        for row, index in features(hashes, offsets, model.bits):
            heavy = weights[index] != 0
            held.append(row[heavy] << 32 | index[heavy])
        pairs = np.unique(np.concatenate(held))
        total += np.bincount(pairs >> 32, weights[pairs & 0xFFFFFFFF], block.num_rows)
        score = 1 / (1 + np.exp(-np.clip(total, -35, 35)))
        yield block.append_column(SCORE, pa.array(score))


def score(docs: DataFrame, model: FtrlModel, text: str = "text") -> DataFrame:
    """All columns of the documents, and their toxicity from 0 to 1; no shuffle."""
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])
    return docs.mapInArrow(partial(_score, text=text, model=model), schema)


def toxicity_filter(docs: DataFrame, model: FtrlModel, threshold: float = 0.5) -> DataFrame:
    """The documents below the threshold."""
    return score(docs, model).where(F.col(SCORE) < threshold).drop(SCORE)
