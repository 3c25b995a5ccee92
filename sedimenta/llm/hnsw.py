"""Nearest neighbours by largest inner product: one HNSW graph for each shard, results merged.

Equal vectors are one entry of a graph, known by their smallest ids; one more
than the number of neighbours asked for is enough of them. Entries are dealt
over shards by a hash. A shard's graph is a stack of layers, each one array of
neighbour numbers with a row for each entry. Entries are inserted in batches
that search the graph built so far; a batch takes every step of its beam
search together. Vectors get one more part that gives all of a shard the same
length, so that the largest inner product is the nearest point.

Graphs are built once and written as rows of flat arrays. A task gets a group of them, of bounded size, and then the
queries as a stream, block by block, and returns the best of the group for each query. Every query meets every group;
a graph goes to one task, or to a few on a cluster with more cores than groups, however many queries there are. The
best of all groups by (inner product, smaller id) are the result. The products are computed again in double
precision on the vectors as given.

Defined results: see ``vectors.usable_vectors`` for what takes part. Vectors of another length than a
query's are not its candidates. A query has fewer neighbours only if there are
fewer candidates, or its search met fewer. An empty table gives no rows.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sedimenta.llm.common import give_back, take_ragged, written
from sedimenta.llm.vectors import matrix, usable_vectors

SHARD_ROWS = 4096
LINKS, BEAM, WIDTH = 16, 96, 4
# The most shards a task holds and the most queries it searches at a time, about 2 MB and half a KB each at 64 parts.
GROUP_SHARDS, QUERY_BLOCK = 64, 16384
GRAPHS = "parts int, shard long, data binary"
HITS = "query_rep long, vec_id long, score double"


class Layer:
    """Neighbour numbers of every entry, -1 where there is none, closest first."""

    def __init__(self, size: int, links: int):
        self.near = np.full((size, links), -1, np.int32)


def beam_search(points: np.ndarray, near: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int
                ) -> tuple[np.ndarray, np.ndarray]:
    """Numbers and products of the best ``beam`` entries met from ``entry`` for each query, best first."""
    count = len(queries)
    row = np.arange(count)[:, None]
    visited = np.zeros((count, len(points) + 1), bool)  # the last column stands for "no entry"
    visited[:, -1] = True
    found = np.full((count, beam), -1)
    score = np.full((count, beam), -np.inf, np.float32)
    found[:, 0] = entry
    score[:, 0] = np.einsum("qd,qd->q", points[entry], queries)
    visited[row[:, 0], entry] = True
    opened = found < 0
    live = np.arange(count)
    while len(live):
        ahead = np.where(opened[live], -np.inf, score[live])
        pick = np.argsort(-ahead, axis=1)[:, :WIDTH]
        open_now = np.take_along_axis(ahead, pick, 1) > -np.inf
        going = open_now.any(1)
        live, pick, open_now = live[going], pick[going], open_now[going]
        if not len(live):
            break
        chosen = np.where(open_now, found[live[:, None], pick], -1)
        opened[live[:, None], pick] = True
        nxt = np.where(chosen[:, :, None] >= 0, near[chosen], -1).reshape(len(live), -1)
        nxt = np.sort(nxt, axis=1)
        nxt[:, 1:][nxt[:, 1:] == nxt[:, :-1]] = -1
        nxt[visited[live[:, None], nxt]] = -1
        visited[live[:, None], nxt] = True
        fresh = np.matmul(points[nxt], queries[live][:, :, None])[:, :, 0]
        fresh[nxt < 0] = -np.inf
        every = np.hstack([score[live], fresh])
        best = np.argsort(-every, axis=1, kind="stable")[:, :beam]
        found[live] = np.take_along_axis(np.hstack([found[live], nxt]), best, 1)
        score[live] = np.take_along_axis(every, best, 1)
        opened[live] = np.take_along_axis(np.hstack([opened[live], nxt < 0]), best, 1)
    return found, score


def spread_out(points: np.ndarray, found: np.ndarray, score: np.ndarray, links: int) -> np.ndarray:
    """For each row of candidates (best first) up to ``links``, preferring those closer to the row than to each other."""
    size = found.shape[1]
    held = points[found]
    between = np.matmul(held, held.transpose(0, 2, 1))
    kept = np.zeros(found.shape, bool)
    for j in range(size):
        rival = np.where(kept, between[:, j], -np.inf).max(1)
        kept[:, j] = (found[:, j] >= 0) & (rival < score[:, j]) & (kept.sum(1) < links)
    # Places left go to the best of the rest, as far as there are any.
    order = np.argsort(np.where(kept, 0, 1) + 2 * (found < 0), axis=1, kind="stable")[:, :links]
    out = np.take_along_axis(found, order, 1)
    return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)


def insert(points: np.ndarray, layer: Layer, batch: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
    """Link a batch to what its search found and to each other, and those back to it."""
    links = layer.near.shape[1]
    inside = points[batch] @ points[batch].T
    np.fill_diagonal(inside, -np.inf)
    order = np.argsort(-inside, axis=1)[:, :links]
    found = np.hstack([found, batch[order]])
    score = np.hstack([score, np.take_along_axis(inside, order, 1)])
    best = np.argsort(-score, axis=1, kind="stable")[:, :2 * links]
    found, score = np.take_along_axis(found, best, 1), np.take_along_axis(score, best, 1)
    found[score == -np.inf] = -1
    half = max(links // 2, 1)
    layer.near[batch, :half] = spread_out(points, found, score, half)

    source = np.repeat(batch, links)
    target = layer.near[batch].ravel()
    source, target = source[target >= 0], target[target >= 0]
    product = np.einsum("ed,ed->e", points[source], points[target])
    order = np.lexsort((-product, target))
    source, target = source[order], target[order]
    nodes, first, many = np.unique(target, return_index=True, return_counts=True)
    place = np.arange(len(target)) - np.repeat(first, many)
    few = place < links
    added = np.full((len(nodes), links), -1, np.int64)
    added[np.repeat(np.arange(len(nodes)), many)[few], place[few]] = source[few]
    every = np.hstack([layer.near[nodes], added])
    every = np.sort(every, axis=1)
    every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
    near = np.einsum("ncd,nd->nc", points[every], points[nodes])
    near[every < 0] = -np.inf
    best = np.argsort(-near, axis=1, kind="stable")
    every, near = np.take_along_axis(every, best, 1), np.take_along_axis(near, best, 1)
    layer.near[nodes] = spread_out(points, every, near, links)


class Hnsw:
    """A graph over the rows of a matrix, by inner product."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, beam: int = BEAM, seed: int = 0, batch: int = 256):
        self.points = self._lifted(vectors)
        self.beam, size = beam, len(vectors)
        draw = np.random.default_rng(seed).random(size)
        level = np.floor(-np.log(1 - draw) / np.log(links)).astype(int)
        order = np.argsort(-level, kind="stable")
        self.entry = int(order[0]) if size else 0
        self.layers: list[Layer] = []  # from the top to the ground
        for height in range(int(level.max(initial=0)), -1, -1):
            members = order[:int(np.sum(level >= height))]
            layer = Layer(size, 2 * links)
            done = 1
            while done < len(members):
                now = members[done:done + min(batch, done)]
                found, score = beam_search(self.points, layer.near, self.points[now], self._descend(
                    self.points[now]), beam)
                insert(self.points, layer, now, found, score)
                done += len(now)
            self.layers.append(layer)

    @staticmethod
    def _lifted(vectors: np.ndarray) -> np.ndarray:
        length = np.einsum("nd,nd->n", vectors, vectors)
        lift = np.sqrt(np.maximum(length.max(initial=0) - length, 0))
        scale = np.sqrt(length.max(initial=0)) or 1.0
        return (np.hstack([vectors, lift[:, None]]) / scale).astype(np.float32)

    @classmethod
    def of(cls, vectors: np.ndarray, layers: list[Layer], entry: int, beam: int) -> Hnsw:
        """A graph that was built before, from its layers."""
        graph = cls.__new__(cls)
        graph.points, graph.layers, graph.entry, graph.beam = cls._lifted(vectors), layers, entry, beam
        return graph

    def _descend(self, queries: np.ndarray) -> np.ndarray:
        at = np.full(len(queries), self.entry)
        for layer in self.layers:
            at = beam_search(self.points, layer.near, queries, at, 1)[0][:, 0]
        return at

    def search(self, queries: np.ndarray, beam: int, batch: int = 256) -> np.ndarray:
        """Numbers of the entries nearest to each query, -1 where fewer were met."""
        lifted = np.hstack([queries, np.zeros((len(queries), 1))]).astype(np.float32)
        out = [np.zeros((0, beam), int)]
        top, ground = self.layers[:-1], self.layers[-1]
        for first in range(0, len(lifted), batch):
            part = lifted[first:first + batch]
            at = np.full(len(part), self.entry)
            for layer in top:
                at = beam_search(self.points, layer.near, part, at, 1)[0][:, 0]
            out.append(beam_search(self.points, ground.near, part, at, beam)[0])
        return np.vstack(out)


def _whole(found: np.ndarray, size: int) -> np.ndarray:
    return found.astype(np.int16 if size < 1 << 15 else np.int32)


def _build_shard(entries: pd.DataFrame, beam: int, links: int) -> pd.DataFrame:
    """The flat arrays of a shard: its vectors, the ids of equal ones and the layers of its graph, as one row."""
    entries = entries.sort_values("rep", ignore_index=True)
    vectors = matrix(entries["v"])
    graph = Hnsw(vectors, links, beam)
    narrow = vectors.astype(np.float32)
    lengths = entries["ids"].map(len).to_numpy()
    arrays = {"vectors": narrow if np.array_equal(narrow, vectors) else vectors, "entry": np.array(graph.entry),
              "ids": np.concatenate(entries["ids"].to_list()), "starts": np.concatenate([[0], np.cumsum(lengths)])}
    for height, layer in enumerate(graph.layers):
        rows = np.flatnonzero((layer.near >= 0).any(1))
        arrays[f"rows{height}"] = rows
        arrays[f"near{height}"] = _whole(layer.near[rows], len(vectors))
    data = io.BytesIO()
    np.savez(data, **arrays)
    return pd.DataFrame({"parts": entries["parts"][:1], "shard": entries["shard"][:1], "data": [data.getvalue()]})


def _read_shard(data: bytes, beam: int) -> tuple[Hnsw, np.ndarray, np.ndarray, np.ndarray]:
    """The graph, the vectors, and the ids of each entry as a ragged array."""
    held = np.load(io.BytesIO(data))
    vectors = held["vectors"].astype(np.float64)
    layers = []
    for height in range(sum(name.startswith("rows") for name in held.files)):
        near = held[f"near{height}"]
        layer = Layer(len(vectors), near.shape[1])
        layer.near[held[f"rows{height}"]] = near
        layers.append(layer)
    return Hnsw.of(vectors, layers, int(held["entry"]), beam), vectors, held["ids"], held["starts"]


def _best_rows(asking: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best rows of each query by (score, smaller id)."""
    order = np.lexsort((ids, -score, asking))
    asking, ids, score = asking[order], ids[order], score[order]
    _, first, many = np.unique(asking, return_index=True, return_counts=True)
    kept = np.arange(len(asking)) - np.repeat(first, many) < k
    return asking[kept], ids[kept], score[kept]


def _search_group(shards: pd.DataFrame, queries: pd.DataFrame, k: int, beam: int) -> pd.DataFrame:
    """The ``k`` best ids of a group of shards for each query of a block."""
    best = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if len(shards) and len(queries):
        queries = queries.sort_values("asking", ignore_index=True)
        reps, asked = queries["asking"].to_numpy(np.int64), matrix(queries["asked_v"])
        beam = max(beam, k)
        for data in shards["data"]:
            graph, vectors, ids, starts = _read_shard(data, beam)
            hits = [best]
            for first in range(0, len(asked), 1024):
                part = asked[first:first + 1024]
                found = graph.search(part, beam)
                product = np.einsum("qcd,qd->qc", vectors[found], part)
                product[found < 0] = -np.inf
                # Entries are in the order of their smallest ids, so ties go to these.
                order = np.lexsort((found, -product), axis=1)[:, :k]
                found, product = np.take_along_axis(found, order, 1), np.take_along_axis(product, order, 1)
                hit = found >= 0
                own, ends = take_ragged(ids, starts, found[hit])
                many = np.diff(ends)
                hits.append((np.repeat(np.repeat(reps[first:first + 1024], hit.sum(1)), many), own,
                             np.repeat(product[hit], many)))
                hits[-1] = _best_rows(*hits[-1], k)
            best = _best_rows(*(np.concatenate(column) for column in zip(*hits, strict=True)), k)
        give_back()
    return pd.DataFrame(dict(zip(["query_rep", "vec_id", "score"], best, strict=True)))


def _search_stream(frames: Iterator[pd.DataFrame], search: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame],
                   block: int) -> Iterator[pd.DataFrame]:
    """Hits of the queries of one task, whose rows come after those of its graphs."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        is_query = frame["is_query"].to_numpy(bool)
        if not is_query.all():
            held = [pd.concat([*held, frame.loc[~is_query, ["parts", "data"]]], ignore_index=True)]
        asking = frame.loc[is_query, ["parts", "asking", "asked_v"]]
        for first in range(0, len(asking) if held else 0, block):
            for parts, queries in asking[first:first + block].groupby("parts"):
                yield search(held[0][held[0]["parts"] == parts], queries)


def _tasks(shards: int, queries: int, slots: int) -> tuple[int, int]:
    """Groups of shards, and tasks among which the queries of one group are divided.

    Groups grow in number with the shards once ``GROUP_SHARDS`` is reached. Below that, a graph is copied about a
    sixteenth as often as a query, as it is some sixteen times larger for each row of the table.
    """
    groups = max(-(-shards // GROUP_SHARDS), min(shards, 4 * math.isqrt(slots)))
    return groups, max(min(slots // groups, -(-queries // QUERY_BLOCK)), 1)


def nearest(df: DataFrame, is_query: Column, k: int, shard_rows: int = SHARD_ROWS, beam: int = BEAM,
            links: int = LINKS) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` nearest other rows to each row that ``is_query`` (of vec_id) marks."""
    vectors = written(usable_vectors(df))
    same = Window.partitionBy("v").orderBy("vec_id")
    few = vectors.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1)
    entries = written(few.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
                      .select(F.col("ids")[0].alias("rep"), "v", "ids", F.size("v").alias("parts")))
    shards = max(-(-entries.count() // shard_rows), 1)
    asked = vectors.where(is_query).select(F.col("vec_id").alias("query_id"), "v")
    asked = written(asked.join(entries.select("rep", "v"), "v").select("query_id", "rep"))
    queries = entries.join(asked.select("rep").distinct(), "rep", "left_semi").select(
        "parts", F.col("rep").alias("asking"), F.col("v").alias("asked_v"))
    placed = entries.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards)))
    graphs = written(placed.groupBy("parts", "shard").applyInPandas(
        lambda held: _build_shard(held, max(beam, k + 1), links), GRAPHS))
    groups, copies = _tasks(shards, queries.count(), df.sparkSession.sparkContext.defaultParallelism)
    group = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    copy = F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
    held = graphs.select(F.lit(False).alias("is_query"), "parts", "data", (F.col("shard") % groups).alias("group"),
                         copy.alias("copy"))
    asking = queries.select(F.lit(True).alias("is_query"), "*", F.pmod(
        F.xxhash64(F.lit(1), "asking"), F.lit(copies)).alias("copy"), group.alias("group"))
    # One task a partition: its graphs, then its queries.
    dealt = held.unionByName(asking, allowMissingColumns=True).repartitionById(
        groups * copies, (F.col("group") * copies + F.col("copy")).cast("int")).sortWithinPartitions("is_query", "asking")
    block = QUERY_BLOCK
    hits = dealt.select("is_query", "parts", "data", "asking", "asked_v").mapInPandas(
        lambda frames: _search_stream(frames, lambda shard, part: _search_group(shard, part, k + 1, beam), block), HITS)
    order = [F.desc("score"), F.asc("vec_id")]
    merged = hits.withColumn("n", F.row_number().over(Window.partitionBy("query_rep").orderBy(*order))).where(
        F.col("n") <= k + 1)
    # An entry's own ids are among its best k + 1 only if it is near itself; leaving one row out leaves k.
    lists = written(merged.groupBy("query_rep").agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score"))).alias("best")))
    joined = asked.join(lists, F.col("rep") == F.col("query_rep")).select(
        "query_id", F.expr(f"slice(filter(best, x -> x.vec_id <> query_id), 1, {int(k)})").alias("best"))
    return joined.select("query_id", F.posexplode("best").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        F.col("hit.score").alias("score"))
