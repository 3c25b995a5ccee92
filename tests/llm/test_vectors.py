"""Pivot index and HNSW against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sedimenta.llm import hnsw, pivots

NAN = float("nan")


def clustered(seed=3, groups=12, each=25, dim=32):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim))
    rows = [c + rng.normal(size=dim) * rng.choice([0.02, 0.15, 0.4]) for c in centres for _ in range(each)]
    return np.array(rows + [rows[0]] * 30 + [rows[5] * 3.0], np.float32)


def table(spark, vectors, extra=True):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    n = len(rows)
    dim = len(vectors[0])
    rows += [(n, None), (n + 1, [0.0] * dim), (n + 2, [NAN] * dim), (n + 3, [1.0, None] * (dim // 2)), (n + 4, []),
             (n + 5, [float("inf")] * dim), (n + 6, [1.0] * 5), (None, [1.0] * dim)] if extra else []
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, label int, links string").repartition(3)


def test_links_and_components_equal_brute_force(spark):
    vectors = clustered()
    rows = {r.vec_id: r for r in pivots.near_duplicates(table(spark, vectors)).collect()}
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    want = linked.sum(1)
    got = np.array([rows[i].n_links for i in range(len(vectors))])
    assert (got <= want).all() and got.sum() >= 0.99 * want.sum()
    roots = np.arange(len(vectors))
    for _ in range(50):
        roots = np.where(linked, roots[None], len(vectors)).min(1, initial=len(vectors)).clip(max=roots)
    same = [rows[i].component_id == roots[i] for i in range(len(vectors))]
    assert np.mean(same) >= 0.99
    for i in range(len(vectors), len(vectors) + 7):
        assert (rows[i].n_links, rows[i].component_id, rows[i].kept) == (0, i, True)
    assert len(rows) == len(vectors) + 8 and rows[None].kept


def test_blocks_of_a_long_list_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(pivots, "MIN_BLOCK", 8)
    monkeypatch.setattr(pivots, "MAX_BLOCK", 8)
    rng = np.random.default_rng(1)
    centre = rng.normal(size=16)
    vectors = np.array([centre + rng.normal(size=16) * 0.01 for _ in range(90)], np.float32)
    rows = pivots.near_duplicates(table(spark, vectors, False)).collect()
    assert {r.n_links for r in rows} == {89} and {r.component_id for r in rows} == {0}


def test_neighbours_equal_brute_force(spark):
    vectors = clustered(4)
    vectors *= np.random.default_rng(2).uniform(0.5, 2, (len(vectors), 1)).astype(np.float32)
    vectors[-31:-1] = vectors[0]
    rows = hnsw.nearest(table(spark, vectors), F.col("vec_id") % 20 == 0, 10, shard_rows=64).collect()
    exact = vectors.astype(float)
    found, wanted = 0, 0
    for q in range(0, len(vectors), 20):
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 11)) and q not in [r.vec_id for r in mine]
        scores = exact @ exact[q]
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        assert np.allclose([r.score for r in mine], scores[[r.vec_id for r in mine]], rtol=1e-12)
        best = [i for i in np.lexsort((np.arange(len(scores)), -scores)) if i != q][:10]
        found += len(set(best) & {r.vec_id for r in mine})
        wanted += 10
    assert found >= 0.95 * wanted


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(0, None)]])
def test_few_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert hnsw.nearest(df, F.col("vec_id") >= 0, 3).count() == 0
    assert pivots.near_duplicates(df).count() == len(rows)


def test_groups_of_shards_and_blocks_of_queries_give_the_same(spark, monkeypatch):
    vectors = clustered(4)
    vectors[-31:-1] = vectors[0]
    df = table(spark, vectors)

    def answers(shards, queries):
        monkeypatch.setattr(hnsw, "GROUP_SHARDS", shards)
        monkeypatch.setattr(hnsw, "QUERY_BLOCK", queries)
        return sorted(map(tuple, hnsw.nearest(df, F.col("vec_id") % 4 == 0, 10, shard_rows=8).collect()))

    search = hnsw._search_group

    def searched(graphs, queries, k, beam):
        hits = search(graphs, queries, k, beam)
        assert len(graphs) <= 7 and len(queries) <= 40 and len(hits) <= k * len(queries)
        return hits

    alone = answers(1, 1 << 20)
    monkeypatch.setattr(hnsw, "_search_group", searched)
    assert answers(4, 16) == alone and len(alone) > 0


def test_graphs_are_not_copied_as_queries_grow():
    assert hnsw._tasks(shards=13, queries=2564, slots=6) == (8, 1)
    for queries in (10 ** 6, 10 ** 8):
        groups, copies = hnsw._tasks(10 ** 4, queries, 64)
        assert copies == 1 and -(-10 ** 4 // groups) <= hnsw.GROUP_SHARDS
    groups, copies = hnsw._tasks(1000, 10 ** 6, 1024)
    assert copies * 16 <= groups <= 1024 // copies
    assert hnsw._tasks(1, 0, 8) == (1, 1)
