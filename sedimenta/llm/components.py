"""Connected components of a graph given as edges, by contraction, all in joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.llm.common import written

MAX_ROUNDS = 60


def connected_nodes(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (``src``, ``dst``); nodes share a root if they are connected.

    Each round gives the nodes random priorities, moves every node onto the
    first of itself and its neighbours, and rewrites the edges; a constant
    part of the nodes is expected to go each time, whatever the shape of the
    graph, and a clique or a star goes in one round. What a round leaves is
    written to the shared folder. Loops and repeated edges are allowed.
    """
    both = edges.select("src", "dst").unionAll(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    left = written(both.where("src <> dst").distinct())
    moves = []
    while not left.isEmpty():
        if len(moves) == MAX_ROUNDS:
            raise RuntimeError(f"edges are left after {MAX_ROUNDS} rounds")
        seed = F.lit(len(moves))
        rank = F.struct(F.xxhash64("dst", seed).alias("p"), F.col("dst").alias("node"))
        own = F.struct(F.xxhash64("src", seed).alias("p"), F.col("src").alias("node"))
        move = written(left.groupBy("src").agg(F.min(rank).alias("best"))
                       .select("src", F.least(F.col("best"), own)["node"].alias("to")))
        moves.append(move)
        ahead = move.select(F.col("src").alias("dst"), F.col("to").alias("far"))
        left = written(left.join(move, "src").join(ahead, "dst")
                       .select(F.col("to").alias("src"), F.col("far").alias("dst")).where("src <> dst").distinct())
    if not moves:
        return left.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    roots = moves[0].select(F.col("src").alias("node"), F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("src").alias("root"), F.col("to").alias("next"))
        roots = roots.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return roots
