"""Near-duplicate vectors by a pivot-permutation index.

Reference points (pivots) are drawn from the vectors. A vector is described by
its ``nearest`` pivots in order of nearness; vectors at a small angle see
nearly the same ones. The index lists, for each pivot, the vectors that name
it. A pair is a candidate if it shares at least ``shared`` pivots, and a link if
its cosine, in double precision, reaches the threshold.

A pair that shares ``shared`` of ``nearest`` pivots shares one of the
``nearest - shared + 1`` rarest of each, so a vector is listed under those
only, and a pair is tallied in the list of the rarest pivot it shares: once.
Lists are cut into blocks, and each pair of blocks is a group of its own, so
no group is larger than two blocks however many vectors name a pivot. A group
returns, for each vector with links, their number and a vector it is connected
with; the pairs themselves are never rows.

The number of pivots grows with the square root of the number of vectors, so
lists do too. Pivots closer to an earlier one than ``apart`` are
passed over: a large group of near copies gets one, not a share of them all.
At most ``MAX_PIVOTS`` pivots are used and at most four times as many vectors looked
at for them; beyond that lists grow in proportion, and nothing is dropped.

Equal vectors are one entry. Defined results: see ``vectors.usable_vectors``
for what takes part; every row of the table is returned, and one that takes no part has
no links and is its own component. Vectors of different lengths are never
linked. Copies of an id count once. An empty table gives no rows.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import least_hashed, written
from sedimenta.llm.components import connected_nodes
from sedimenta.llm.vectors import usable_vectors

COSINE = 0.95
NEAREST, SHARED, APART = 10, 3, 0.8
MIN_PIVOTS, MAX_PIVOTS = 64, 16_384
MIN_BLOCK, MAX_BLOCK = 256, 1024
DESCRIBED = "rep long, copies long, parts int, v binary, named binary"


def draw_pivots(entries: DataFrame, size: int) -> np.ndarray:
    """About four times the root of ``size`` vectors that are not near each other, shorter ones filled with zeros."""
    wanted = min(max(4 * math.isqrt(size), MIN_PIVOTS), MAX_PIVOTS)
    pool = least_hashed(entries.select("rep", "v"), F.xxhash64("rep"), 4 * wanted).collect()
    pool = [np.array(r.v) for r in sorted(pool, key=lambda r: zlib.crc32(str(r.rep).encode()))]
    parts = max(map(len, pool), default=0)
    points = np.stack([np.pad(p, (0, parts - len(p))) for p in pool]) if pool else np.zeros((0, 0))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    kept = np.zeros((min(wanted, len(points)), parts))
    count = 0
    for point in points:
        if count < len(kept) and (not count or (kept[:count] @ point).max() < APART):
            kept[count] = point
            count += 1
    return kept[:count]


def pack_vector(v: np.ndarray) -> bytes:
    """Four bytes a part where that loses nothing, else eight."""
    with np.errstate(over="ignore"):
        short = v.astype("<f4")
    return short.tobytes() if np.array_equal(short.astype(np.float64), v) else v.astype("<f8").tobytes()


def unpack_vector(data: bytes, parts: int) -> np.ndarray:
    return np.frombuffer(data, "<f4" if len(data) == 4 * parts else "<f8").astype(np.float64)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled by their largest part first, so no square overflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _describe(batches: Iterator[pa.RecordBatch], pivots: np.ndarray, nearest: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = [np.array(v) for v in batch.column("v").to_pylist()]
        named = []
        for first in range(0, len(vectors), 512):
            part = vectors[first:first + 512]
            padded = np.zeros((len(part), pivots.shape[1]))
            for row, v in enumerate(part):
                padded[row, :len(v)] = v[:pivots.shape[1]] / np.abs(v).max()
            order = np.argsort(-(padded @ pivots.T), axis=1, kind="stable")[:, :nearest]
            named += [row.astype("<i4").tobytes() for row in order]
        yield pa.record_batch({
            "rep": batch.column("rep"), "copies": batch.column("copies"), "parts": batch.column("parts"),
            "v": pa.array(map(pack_vector, vectors), pa.binary()), "named": pa.array(named, pa.binary())})


def _list(batches: Iterator[pa.RecordBatch], rank: np.ndarray, listed: int) -> Iterator[pa.RecordBatch]:
    """A row for each of the rarest pivots a vector names."""
    for batch in batches:
        named = [np.frombuffer(n, "<i4") for n in batch.column("named").to_pylist()]
        rarest = [n[np.argsort(rank[n])][:listed] for n in named]
        row = np.repeat(np.arange(len(named)), [len(r) for r in rarest])
        rows = batch.take(pa.array(row))
        yield rows.append_column("pivot", pa.array(np.concatenate([np.zeros(0, "<i4"), *rarest]).astype(np.int32)))


def tally(named: list[np.ndarray], pivot: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each pair of rows, how many pivots they share, and whether ``pivot`` is the rarest of these."""
    size = len(named)
    flat = np.concatenate(named)
    row = np.repeat(np.arange(size), [len(n) for n in named])
    order = np.argsort(flat, kind="stable")
    pivots, first, many = np.unique(flat[order], return_index=True, return_counts=True)
    row = row[order]
    shared, rarest = np.zeros((size, size), np.uint8), np.ones((size, size), bool)
    for at in np.flatnonzero(many > 1):
        here = row[first[at]:first[at] + many[at]]
        block = np.ix_(here, here)
        shared[block] += 1
        if rank[pivots[at]] < rank[pivot]:
            rarest[block] = False
    return shared, rarest


def local_roots(linked: np.ndarray) -> np.ndarray:
    """The smallest row each row is connected with."""
    roots = np.arange(len(linked))
    while True:
        least = np.where(linked, roots[None, :], len(linked)).min(1, initial=len(linked))
        new = np.minimum(roots, least)
        new = new[new]
        if np.array_equal(new, roots):
            return roots
        roots = new


def _links(group: pd.DataFrame, rank: np.ndarray, cosine: float, shared: int) -> pd.DataFrame:
    group = group.sort_values("rep", ignore_index=True)
    named = [np.frombuffer(n, "<i4") for n in group["named"]]
    vectors = unit(np.stack([unpack_vector(v, p) for v, p in zip(group["v"], group["parts"], strict=True)]))
    counts, rarest = tally(named, int(group["pivot"].iloc[0]), rank)
    linked = (counts >= shared) & rarest
    np.fill_diagonal(linked, False)
    block, low, high = group["block"].to_numpy(), group["low"].iloc[0], group["high"].iloc[0]
    if low != high:  # pairs inside a block belong to that block's own group
        linked &= block[:, None] != block[None, :]
    if linked.any():
        linked &= vectors @ vectors.T >= cosine
    links = linked @ group["copies"].to_numpy()
    roots = group["rep"].to_numpy()[local_roots(linked)]
    some = links > 0
    return pd.DataFrame({"rep": group["rep"][some], "links": links[some], "root": roots[some]})


def link_counts(entries: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED
                ) -> DataFrame:
    """(rep, links, root) of distinct vectors ``rep, copies, parts, v``, in parts: links add up, roots are connected."""
    spark = entries.sparkSession
    size = entries.count()
    pivots = draw_pivots(entries, size)
    shared = max(min(shared, len(pivots)), 1)
    described = written(entries.select("rep", "copies", "parts", "v").mapInArrow(
        partial(_describe, pivots=pivots, nearest=nearest), DESCRIBED))

    def sizes(lists: DataFrame) -> dict[int, int]:
        return {r.pivot: r["count"] for r in lists.groupBy("pivot").count().collect()}  # one row a pivot

    def listed(rank: np.ndarray, length: int) -> DataFrame:
        return described.mapInArrow(partial(_list, rank=rank, listed=length), f"{DESCRIBED}, pivot int")

    all_sizes = sizes(listed(np.arange(len(pivots)), nearest).select("pivot"))
    rank = np.empty(len(pivots), np.int64)
    rank[sorted(range(len(pivots)), key=lambda p: (all_sizes.get(p, 0), p))] = np.arange(len(pivots))
    postings = listed(rank, max(min(nearest, len(pivots)) - shared + 1, 1))
    lengths = sizes(postings.select("pivot"))
    block_rows = min(max(sum(lengths.values()) // max(2 * len(lengths), 1), MIN_BLOCK), MAX_BLOCK)
    blocks = spark.createDataFrame([(p, -(-n // block_rows)) for p, n in lengths.items()], "pivot int, blocks int")
    cut = postings.join(F.broadcast(blocks), "pivot").withColumn(
        "block", F.pmod(F.xxhash64("rep", "pivot"), "blocks").cast("int"))
    dealt = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"low": F.least("block", "other"), "high": F.greatest("block", "other")})
    return dealt.select("rep", "copies", "parts", "v", "named", "pivot", "block", "low", "high").groupBy(
        "parts", "pivot", "low", "high").applyInPandas(
        lambda group: _links(group, rank, cosine, shared), "rep long, links long, root long")


def near_duplicates(df: DataFrame, cosine: float = COSINE, nearest: int = NEAREST, shared: int = SHARED) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of the table."""
    ids = df.select(F.col("vec_id").cast("long").alias("vec_id"))
    vectors = written(usable_vectors(df))
    entries = written(vectors.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                      .withColumn("parts", F.size("v")))
    found = written(link_counts(entries, cosine, nearest, shared))
    roots = connected_nodes(found.select(F.col("rep").alias("src"), F.col("root").alias("dst")))
    least = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    component = roots.join(least, "root").select(F.col("node").alias("rep"), "component_id")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    # One row an entry, then one a vector.
    by_entry = written(entries.join(links, "rep", "left").join(component, "rep", "left").select(
        "v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component_id", "rep").alias("component_id")))
    by_vector = vectors.join(by_entry, "v").select("vec_id", "n_links", "component_id")
    every = ids.join(by_vector, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"))
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
