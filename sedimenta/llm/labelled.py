"""The bounded training sample of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import least_hashed, within_bytes

FOLDS = 5
TRAINING_BYTES = 128 << 20


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether labels of this document are never learned; a null id is never learned either."""
    remainder = F.crc32(F.col(doc_id).cast("long").cast("string").cast("binary")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(True))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int = TRAINING_BYTES) -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents outside the held-out fold, and ``max_bytes`` of text.

    They are the documents whose ids have the smallest hashes, so the sample
    is spread over the corpus and is the same in every run. A document that
    is labelled more than once counts as 1 if any of its labels is 1. The chosen
    ids, at most ``rows`` of them, are broadcast.
    """
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = labels.where("doc_id is not null and label is not null").where(~held_out())
    single = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    chosen = least_hashed(single, F.xxhash64("doc_id"), rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sizes = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.sum(F.octet_length("text")).alias("size"))
    hashed = sizes.withColumn("place", F.xxhash64("doc_id"))
    fitting = within_bytes(hashed, "place", "size", max_bytes)
    return texts.join(F.broadcast(hashed.join(fitting, "place").select("doc_id", "label")), "doc_id")
