"""Exact samples and order sketches."""

from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_jobs import config, put_raw

from sedimenta.operators.sampling import exact_sample, place_hash, value_hash
from sedimenta.operators.sketches import distinct_orders, order_sketches, relative_error
from sedimenta.plans.jobs import run_process
from sedimenta.sources.layers import read_sketches


@pytest.fixture
def table(spark, lake):
    """1000 rows in several files: 600 alike, 100 null, the rest all different."""
    rows = spark.range(1000).select(F.when(F.col("id") < 600, 7).when(F.col("id") >= 700, F.col("id")).alias("v"))
    rows.repartition(5).write.parquet(f"{lake}/rows")
    return spark.read.parquet(f"{lake}/rows")


@pytest.mark.parametrize("k", [-1, 0, 1, 37, 500, 999, 1000, 5000])
def test_a_sample_has_its_exact_size_whatever_repeats(table, k):
    for seed in (1, 2):
        sample = exact_sample(table, k, value_hash(table, seed), place_hash(seed))
        rows = [r.v for r in sample.collect()]
        assert len(rows) == min(max(k, 0), 1000)
        assert not Counter(rows) - Counter({7: 600, None: 100, **{n: 1 for n in range(700, 1000)}})
        assert sorted(map(str, rows)) == sorted(str(r.v) for r in sample.collect())


def test_a_sample_is_a_filter_over_the_scan(table):
    plan = exact_sample(table, 300, value_hash(table, 1), place_hash(1))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort" not in plan


def test_rows_are_drawn_evenly(table):
    drawn = Counter(r.v for seed in range(20) for r in exact_sample(
        table.where("v >= 700"), 100, value_hash(table, seed), place_hash(seed)).collect())
    assert len(drawn) > 290 and max(drawn.values()) < 17


def test_places_of_other_seeds_part_equal_rows_anew(table):
    alike = table.where("v = 7").withColumn("place", F.concat("_metadata.file_path", F.lit(":"), F.col("_metadata.row_index")))
    chosen = [{r.place for r in exact_sample(alike, 60, value_hash(table, 1, "v"), place_hash(seed)).collect()} for seed in (1, 2)]
    assert len(chosen[0]) == len(chosen[1]) == 60 and chosen[0] != chosen[1]


def test_rows_that_cannot_be_told_apart_are_refused(table):
    with pytest.raises(ValueError, match="told apart"):
        exact_sample(table, 5, F.lit(0).cast("long"), F.lit(0).cast("long"))


def test_sketches_add_up_over_groups_and_dates(spark):
    orders = spark.range(60_000).select(
        (F.col("id") % 40_000).alias("pedido_id"), F.when(F.col("id") % 3 == 0, "SP").otherwise("RJ").alias("uf"), F.lit("c").alias("categoria"))
    halves = [order_sketches(orders.where(F.col("pedido_id") % 2 == n)) for n in (0, 1)]
    both = halves[0].unionAll(halves[1])
    exact = {r.uf: r.n for r in orders.groupBy("uf").agg(F.count_distinct("pedido_id").alias("n")).collect()}
    for row in distinct_orders(both, "uf").collect():
        assert abs(row.qtd_pedidos_estimada - exact[row.uf]) <= 4 * relative_error() * exact[row.uf]
    total = distinct_orders(both, "categoria").first().qtd_pedidos_estimada
    assert abs(total - 40_000) <= 4 * relative_error() * 40_000
    assert max(len(r.pedidos_sketch) for r in both.collect()) < 5000


@pytest.mark.parametrize("versioned", [False, True])
def test_sketches_are_kept_only_on_request(spark, lake, versioned):
    cfg = config(lake, versioned=versioned)
    put_raw(cfg, "1,1,10,1,2026-01-01\n1,1,10,2,2026-01-01\n2,2,10,1,2026-01-01\n")
    run_process(spark, cfg)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_sketches(spark, cfg).count()
    run_process(spark, replace(cfg, order_sketches=True))
    assert {r.uf: r.qtd_pedidos_estimada for r in distinct_orders(read_sketches(spark, cfg)).collect()} == {"SP": 1, "RJ": 1}
