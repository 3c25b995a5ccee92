"""Document quality by a linear-chain conditional random field over lines.

Every line that is not empty is good or bad. A line is described by shares of
kinds of characters, by its words and by whether the document repeats it,
together with the same of the line before and after it; the chain adds a
weight for each pair of neighbouring labels. The forward-backward pass gives
each line its probability of being good given the whole document, and the quality of a document
is the mean of these, weighted by the lengths of the lines, put on the scale of the labels by a logistic
regression with two coefficients.

The labels are known for documents only: in training, a line has the label of its document.

Defined results: a text without any line, null or empty, has the rate of good documents in
the sample as its quality; equal texts score alike; an empty table gives no
rows; without labels, or with one class only, every score is the rate of that
class. Texts of any length and number of lines are scored whole. All columns
of the input are kept, and only the text is read.
"""

from __future__ import annotations

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

from sedimenta.llm.common import plain_text, text_blocks, utf8_bytes, words_of
from sedimenta.llm.labelled import training_sample

TRAINING_ROWS = 12_000
# Bytes of text whose lines are scored at a time.
TEXT_BYTES = 2 << 20
SCORE = "__quality"
FEATURES = 17


@dataclass(frozen=True)
class CrfModel:
    """Weights of a line and its neighbours for the good label, log weights of the label pairs, and the scale."""

    weights: np.ndarray
    pairs: np.ndarray
    mean: np.ndarray
    deviation: np.ndarray
    scale: tuple[float, float]
    rate: float


def _byte_kinds() -> np.ndarray:
    """Kind of every byte: 1 upper case, 2 lower case, 3 digit, 4 bar, 5 exclamation, 6 symbol, 7 not ASCII, 8 stop."""
    kinds = np.zeros(256, np.uint8)
    kinds[128:] = 7
    for kind, chars in ((1, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (2, b"abcdefghijklmnopqrstuvwxyz"), (3, b"0123456789"),
                        (4, b"|"), (5, b"!"), (6, b"#$%&*+/<=>@[\\]^_`{}~"), (8, b".,;:?")):
        kinds[np.frombuffer(chars, np.uint8)] = kind
    return kinds


KINDS = _byte_kinds()


def line_features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of every line that is not blank, its length in bytes, and the offsets of the texts in lines."""
    split = pc.split_pattern(texts, "\n")
    lines = split.flatten()
    row = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy(zero_copy_only=False)))
    filled = pc.not_equal(pc.utf8_trim_whitespace(lines), "")
    lines, row = lines.filter(filled), row[filled.to_numpy(zero_copy_only=False)]
    offsets = np.searchsorted(row, np.arange(len(texts) + 1))
    data, ends = utf8_bytes(lines)
    size = np.diff(ends).astype(np.float64)
    if not len(lines):
        return np.zeros((0, FEATURES)), size, offsets
    kinds = KINDS[data]
    share = {}
    for kind in range(1, 9):
        total = np.concatenate([[0], np.cumsum(kinds == kind, dtype=np.int32)])
        share[kind] = (total[ends[1:]] - total[ends[:-1]]) / size
    letters = np.maximum(share[1] + share[2], 1e-9)

    codes, words, cuts = words_of(lines)
    line_of = np.repeat(np.arange(len(lines)), np.diff(cuts))
    count = np.diff(cuts).astype(np.float64)
    again = np.concatenate([[False], (codes[1:] == codes[:-1]) & (line_of[1:] == line_of[:-1])])
    seen = np.unique(line_of.astype(np.int64) << 32 | codes)
    distinct = np.bincount(seen >> 32, minlength=len(lines)) / count
    same = np.asarray(lines.dictionary_encode().indices, np.int64) | row.astype(np.int64) << 32
    _, where, copies = np.unique(same, return_inverse=True, return_counts=True)
    last = data[ends[1:] - 1]
    columns = [
        share[1] / letters, share[3], share[4], share[5], share[6], share[7], share[8],
        share[4] > 0, share[5] > 0.01, share[6] > 0.03, share[1] > 0.5 * letters,
        np.log1p(size), size / count, np.bincount(line_of, again, len(lines)) / count, distinct,
        copies[where] > 1, np.isin(last, np.frombuffer(b".!?", np.uint8)),
    ]
    return np.column_stack([c.astype(np.float64) for c in columns]), size, offsets


def with_neighbours(features: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Features of a line, of the line before and of the line after it in its text (zeros where there is none), and 1."""
    before, after = np.zeros_like(features), np.zeros_like(features)
    before[1:], after[:-1] = features[:-1], features[1:]
    starts = offsets[:-1][np.diff(offsets) > 0]
    before[starts] = 0
    after[offsets[1:][np.diff(offsets) > 0] - 1] = 0
    return np.hstack([features, before, after, np.ones((len(features), 1))])


def forward_backward(good: np.ndarray, pairs: np.ndarray, offsets: np.ndarray
                     ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of the two labels of every line, expected label pairs of all lines, and each text's log normaliser.

    ``good`` is the score of the good label; the bad one scores 0. All texts
    take a step together, those with fewer lines leave earlier.
    """
    emit = np.column_stack([np.zeros_like(good), good])
    counts = np.diff(offsets)
    order = np.argsort(-counts, kind="stable")
    starts, counts = offsets[:-1][order], counts[order]
    alpha, beta = emit.copy(), np.zeros_like(emit)
    steps = int(counts.max(initial=0))
    active = [int(np.searchsorted(-counts, -t, side="left")) for t in range(steps + 1)]  # texts with more than t lines
    for t in range(1, steps):
        at = starts[:active[t]] + t
        step = alpha[at - 1][:, :, None] + pairs
        alpha[at] += np.logaddexp(step[:, 0], step[:, 1])
    for t in range(steps - 2, -1, -1):
        at = starts[:active[t + 1]] + t
        step = pairs + (emit[at + 1] + beta[at + 1])[:, None, :]
        beta[at] = np.logaddexp(step[:, :, 0], step[:, :, 1])
    norm = np.zeros(len(starts))
    filled = np.diff(offsets) > 0
    ends = offsets[1:][filled] - 1
    norm[filled] = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    of_line = np.repeat(norm, np.diff(offsets))
    marginals = np.exp(alpha + beta - of_line[:, None])
    follows = np.ones(len(good), bool)
    follows[offsets[:-1][filled]] = False
    at = np.flatnonzero(follows)
    both = (alpha[at - 1][:, :, None] + pairs + (emit[at] + beta[at])[:, None, :] - of_line[at, None, None])
    return marginals, np.exp(both).sum(0), norm


def document_means(marginals: np.ndarray, size: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probability of a good line, weighted by length; nan for a text without lines."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    total = np.bincount(row, size, len(offsets) - 1)
    good = np.bincount(row, marginals[:, 1] * size, len(offsets) - 1)
    return np.divide(good, total, out=np.full(len(total), np.nan), where=total > 0)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_crf(features: np.ndarray, size: np.ndarray, offsets: np.ndarray, labels: np.ndarray, l2: float = 1e-3,
            steps: int = 150, rate: float = 0.1) -> CrfModel:
    """Maximum likelihood of the lines' labels by Adam, each document weighing the same, then the scale."""
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    mean, deviation = features.mean(0) if len(features) else np.zeros(FEATURES), np.ones(FEATURES)
    if len(features):
        deviation = np.maximum(features.std(0), 1e-6)
    inputs = with_neighbours((features - mean) / deviation, offsets)
    weights, pairs = np.zeros(3 * FEATURES + 1), np.zeros((2, 2))
    if len(np.unique(labels)) < 2 or not len(features):
        return CrfModel(weights, pairs, mean, deviation, (0.0, float(_logit(np.array(share)))), float(share))
    lines = np.diff(offsets)
    weight = np.repeat(1 / np.maximum(lines, 1), lines)
    truth = np.repeat(labels, lines).astype(float)
    follows = np.maximum(lines - 1, 0)
    seen_pairs = np.array([[np.sum(follows * (1 - labels)), 0], [0, np.sum(follows * labels)]], float)
    first, second = np.zeros(weights.size + 4), np.zeros(weights.size + 4)
    for step in range(1, steps + 1):
        marginals, expected, _ = forward_backward(inputs @ weights, pairs, offsets)
        slope = inputs.T @ ((truth - marginals[:, 1]) * weight) / len(labels) - l2 * weights
        pair_slope = (seen_pairs - expected) / max(follows.sum(), 1) - l2 * 10 * pairs
        both = np.concatenate([slope, pair_slope.ravel()])
        first = 0.9 * first + 0.1 * both
        second = 0.999 * second + 0.001 * both * both
        move = rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, pairs = weights + move[:-4], pairs + move[-4:].reshape(2, 2)
    marginals, _, _ = forward_backward(inputs @ weights, pairs, offsets)
    means = document_means(marginals, size, offsets)
    known = ~np.isnan(means)
    return CrfModel(weights, pairs, mean, deviation, _fit_scale(_logit(means[known]), labels[known]), float(share))


def _fit_scale(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic regression of one variable, by Newton steps with a small penalty."""
    x = np.clip(x, -8, 8)
    a, b = 1.0, 0.0
    for _ in range(50):
        p = _sigmoid(a * x + b)
        g = np.array([np.sum((y - p) * x), np.sum(y - p)]) - 1e-2 * np.array([a, b])
        v = p * (1 - p)
        h = np.array([[np.sum(v * x * x), np.sum(v * x)], [np.sum(v * x), np.sum(v)]]) + 1e-2 * np.eye(2)
        move = np.linalg.solve(h, g)
        a, b = a + move[0], b + move[1]
    return float(a), float(b)


def _training_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, "text", TEXT_BYTES):
        features, size, offsets = line_features(plain_text(block.column("text")))
        both = np.hstack([features, size[:, None]]).astype("<f4")
        yield pa.record_batch({
            "doc_id": block.column("doc_id"), "label": block.column("label"),
            "lines": pa.array([both[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)],
                              pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> CrfModel:
    """Learn from at most ``rows`` labelled documents, whose line features alone come to the driver."""
    sample = training_sample(docs, labels, "quality", rows)
    found = sample.mapInArrow(_training_lines, "doc_id long, label int, lines binary").collect()
    drawn = sorted(found, key=lambda r: (zlib.crc32(str(r.doc_id).encode()), r.doc_id, r.lines))
    lines = [np.frombuffer(r.lines, "<f4").reshape(-1, FEATURES + 1) for r in drawn]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lines], dtype=np.int64)])
    every = np.vstack([np.zeros((0, FEATURES + 1)), *lines]).astype(float)
    return fit_crf(every[:, :-1], every[:, -1], offsets, np.array([int(r.label) for r in drawn], int))


def line_marginals(texts: pa.Array, model: CrfModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability of each line's labels, the length of each line, and the offsets of the texts in lines."""
    features, size, offsets = line_features(texts)
    inputs = with_neighbours((features - model.mean) / model.deviation, offsets)
    return forward_backward(inputs @ model.weights, model.pairs, offsets)[0], size, offsets


def document_scores(texts: pa.Array, model: CrfModel) -> np.ndarray:
    means = document_means(*line_marginals(texts, model))
    slope, intercept = model.scale
    scores = _sigmoid(slope * np.clip(_logit(means), -8, 8) + intercept)
    return np.where(np.isnan(means), model.rate, scores)


def _score(batches: Iterator[pa.RecordBatch], text: str, model: CrfModel) -> Iterator[pa.RecordBatch]:
    for block in text_blocks(batches, text, TEXT_BYTES):
        yield block.append_column(SCORE, pa.array(document_scores(plain_text(block.column(text)), model)))


def score(docs: DataFrame, model: CrfModel, text: str = "text") -> DataFrame:
    """All columns of the documents, and their quality from 0 to 1; no shuffle."""
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])
    return docs.mapInArrow(partial(_score, text=text, model=model), schema)


def quality_filter(docs: DataFrame, model: CrfModel, threshold: float = 0.3) -> DataFrame:
    """The documents at or above the threshold."""
    return score(docs, model).where(F.col(SCORE) >= threshold).drop(SCORE)
