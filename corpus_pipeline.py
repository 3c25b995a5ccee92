"""The corpus pipeline: toxicity, quality, near-dedup, repeated passages and packing of ``documents``.

Each stage works on all that the one before kept and returns the columns of documents, whatever they are called; the last one
returns pieces. Defined results: a null or empty text is scored like any other, and packed as its end token. Of rows with equal
texts one stays, that with the smallest id; rows with one id and one text stay or go together. A null id stays null. Without labels
the classifiers give every document their prior, and an empty table gives no piece.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sedimenta.llm import line_quality, packing, simhash, suffix_dedup, toxicity
from sedimenta.llm.common import read_table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below one half for toxicity, by a model learned from the labelled ones among them."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.toxicity_filter(docs, model)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.3 or more for quality, by a model learned from the labelled ones among them."""
    model = line_quality.fit(docs, read_table(spark, sf_dir, "labels"))
    return line_quality.quality_filter(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    return simhash.keep_one_of_each_component(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the bytes of strings of 200 bytes that occur more than once."""
    return suffix_dedup.without_repeats(docs)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of 2048 tokens."""
    # The workers have the other stages' memory to hold as well, so they keep less between their tasks than they would alone.
    return packing.digest(packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), text_bytes=8 << 20, kept_bytes=24 << 20))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality classifier", drop_low_quality),
    ("SimHash near-dedup", drop_near_copies),
    ("suffix-array dedup", cut_repeated_passages),
    ("packing", pack_documents),
]

# Classifiers, suffix sorting and tokenizers have no SQL; the tests compare each stage with a plain version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs)
    return docs
