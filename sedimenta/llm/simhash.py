"""SimHash near-dedup by a byte-position inverted index with count filtering.

A fingerprint has eight bytes. Two that differ in at most ``d`` bits differ in
at most ``d`` bytes, so they share at least ``8 - d`` positional bytes. The
index holds, for each distinct fingerprint, its bytes at pairs of groups of
positions: with ``d + 2`` groups, at least two stay untouched, so each pair of
near fingerprints meets in one list. A pair met is kept if its tally of shared
positional bytes reaches ``8 - d`` and its bits differ in at most ``d`` places.

Equal fingerprints are one entry, so thousands of copies cost one. A list of
more than ``list_bound`` entries is not paired: its fingerprints are joined
through the values that differ from them in at most one bit, 65 for each. Two
fingerprints are within two bits exactly if they share such a value, so no
link is lost, and a list of any length costs only its own length.

Defined results: words are runs of anything but ASCII white space, A-Z in lower
case. A null or empty text has no words and fingerprint zero, and links like
any other. Fewer words than a shingle are one shingle. Rows with equal ids keep
a row each. A null id is never the smallest of a component that has another.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sedimenta.llm.common import free_name, give_back, written
from sedimenta.llm.components import connected_nodes

SHINGLE, MAX_BITS, SEED = 3, 2, 42
LIST_BOUND = 32
FINGERPRINT = "__fingerprint"


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Bit b is set if it is set in more than half of the XXH64 values of the text's word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined, size, digest = b" ".join(words), min(shingle, len(words)), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    spans = zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], seed) for a, b in spans), "<u8", len(words) - size + 1)
    bits = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        part = hashes[first:first + (1 << 16)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch], text: str, shingle: int, seed: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(text)), "<u8",
                            batch.num_rows)
        yield batch.append_column(FINGERPRINT, pa.array(found.view("<i8")))
        give_back()


def with_fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """All columns of the documents, and their fingerprint as a signed long."""
    schema = T.StructType([*docs.schema.fields, T.StructField(FINGERPRINT, T.LongType())])
    return docs.mapInArrow(partial(_fingerprints, text=text, shingle=shingle, seed=seed), schema)


def _byte(value: Column, position: int) -> Column:
    return F.shiftrightunsigned(value, 8 * position).bitwiseAND(255)


def _groups(max_bits: int) -> list[list[int]]:
    count = max_bits + 2
    return [list(range(8 * g // count, 8 * (g + 1) // count)) for g in range(count)]


def postings(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(fp, key): a fingerprint's bytes at every pair of groups of byte positions."""
    lists = []
    for number, pair in enumerate(combinations(_groups(max_bits), 2)):
        mask = sum(0xFF << 8 * position for group in pair for position in group)
        signed = mask - (1 << 64) if mask >> 63 else mask
        lists.append(F.struct(F.lit(number).alias("at"), F.col("fp").bitwiseAND(F.lit(signed)).alias("bytes")))
    return prints.select("fp", F.explode(F.array(*lists)).alias("key")).select("fp", "key.at", "key.bytes")


def near_links(prints: DataFrame, max_bits: int = MAX_BITS, list_bound: int = LIST_BOUND) -> DataFrame:
    """Edges (src, dst) between distinct fingerprints ``fp`` that connect all within ``max_bits`` bits."""
    if max_bits not in (0, 2):
        raise ValueError("fingerprints link at 0 or at up to 2 differing bits")
    if max_bits == 0:
        return prints.select(F.col("fp").alias("src"), F.col("fp").alias("dst")).where("false")
    posted = postings(prints, max_bits)
    shared = posted.groupBy("at", "bytes").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = written(posted.join(shared, ["at", "bytes"]))

    short = met.where(F.col("n") <= list_bound)
    a, b = short.alias("a"), short.alias("b")
    differ = F.col("a.fp").bitwiseXOR(F.col("b.fp"))
    tally = reduce(Column.__add__, [(_byte(differ, p) == 0).cast("int") for p in range(8)])
    pairs = a.join(b, (F.col("a.at") == F.col("b.at")) & (F.col("a.bytes") == F.col("b.bytes"))
                   & (F.col("a.fp") < F.col("b.fp")) & (tally >= 8 - max_bits) & (F.bit_count(differ) <= max_bits))

    long_lists = met.where(F.col("n") > list_bound).select("fp").distinct()
    masks = [F.lit(0), *[F.lit(1 << bit if bit < 63 else -(1 << 63)) for bit in range(64)]]
    around = long_lists.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(m) for m in masks])).alias("z"))
    hubs = around.groupBy("z").agg(F.min("fp").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    spokes = around.join(hubs, "z").where("fp <> hub").select(F.col("fp").alias("src"), F.col("hub").alias("dst"))
    return pairs.select(F.col("a.fp").alias("src"), F.col("b.fp").alias("dst")).unionAll(spokes.distinct())


def fingerprint_classes(prints: DataFrame, max_bits: int = MAX_BITS, list_bound: int = LIST_BOUND) -> DataFrame:
    """(fp, component_id): the smallest id of all rows (``doc_id``, ``fp``) connected to a fingerprint."""
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("smallest")))
    roots = connected_nodes(near_links(distinct.select("fp"), max_bits, list_bound))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("smallest").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id")


def simhash_components(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED,
                       list_bound: int = LIST_BOUND) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every document."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    prints = written(with_fingerprints(narrow, "text", shingle, seed).select(
        "doc_id", F.col(FINGERPRINT).alias("fp")))
    classes = fingerprint_classes(prints, max_bits, list_bound)
    return prints.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_of_each_component(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                               seed: int = SEED) -> DataFrame:
    """The documents with the smallest id of their component, one row for each id; rows without an id all stay."""
    prints = written(with_fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                                       "text", shingle, seed).select("doc_id", F.col(FINGERPRINT).alias("fp")))
    classes = fingerprint_classes(prints, max_bits)
    gone = prints.join(classes, "fp").where("doc_id <> component_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(docs.columns)
    repeated = prints.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select("doc_id")
    if repeated.isEmpty():
        return kept
    first, number = Window.partitionBy("doc_id").orderBy(F.xxhash64("text")), free_name(docs, "__number")
    numbered = kept.withColumn(number, F.row_number().over(first))
    return numbered.where(F.col("doc_id").isNull() | (F.col(number) == 1)).drop(number)
