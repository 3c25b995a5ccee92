"""Generated data: exact anomaly counts, domains, determinism."""

import math

import generator as generate
import pytest
from generator import CITIES_BY_UF, PRODUCT_CATALOG, generate_customers, generate_orders, generate_products
from picks import exact_k_mask
from pyspark.sql import functions as F

from sedimenta.operators.quality import check_orders

D = "2026-09-20"


@pytest.mark.parametrize("n, k", [
    (1, 1), (2, 1), (12, 5), (5000, 150), (4096, 122), (99991, 3000), (1000, 0), (60, 60)])
@pytest.mark.parametrize("seed", [0, 42, 43, 44])
def test_mask_picks_exactly_k(spark, n, k, seed):
    ids = spark.range(1, n + 1)
    assert ids.where(exact_k_mask(F.col("id"), n, k, seed)).count() == k


def test_mask_arithmetic_is_exact_for_huge_ids(spark):
    """Positions computed in two limbs equal those of unbounded integers."""
    n, seed = (1 << 41) - 21, 42
    k = n // 33
    ids = [1, 2, 3, n // 2, n - 1, n] + [n - 7919 * i for i in range(1, 200)]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "id long").select(
        exact_k_mask(F.col("id"), n, k, seed)).collect()]
    a = int(n * (0.381966 + 0.0173 * (seed % 13))) % n
    while math.gcd(a, n) != 1:
        a += 1
    assert got == [((i - 1) * a + (seed * 7919) % n) % n < k for i in ids]


@pytest.mark.parametrize("n", [5000, 777])
def test_each_rule_finds_exactly_the_injected_rows(spark, n):
    generated = generate_orders(spark, n, 200, 50, D, 0.03, 42)
    checked = check_orders(generated.orders, generate_customers(spark, 200, D, 42), generate_products(spark, 50, 42))
    totals = {r.regra: r.violacoes for r in checked.rule_totals().collect()}
    assert totals == generated.injected == dict.fromkeys(totals, int(n * 0.03))


def test_anomalies_may_overlap(spark):
    generated = generate_orders(spark, 5000, 200, 50, D, 0.03, 42)
    checked = check_orders(generated.orders, generate_customers(spark, 200, D, 42), generate_products(spark, 50, 42))
    rejected = checked.rejected()
    assert 0 < rejected.where(F.col("motivo_rejeicao").contains("; ")).count() < 60


def test_absent_keys_stay_absent_in_large_dimensions(spark):
    generated = generate_orders(spark, 5000, 20_000, 12_000, D, 0.03, 42)
    assert generated.orders.where("cliente_id > 20000").count() == 150
    assert generated.orders.where("product_id > 12000").count() == 150


def test_absent_keys_of_small_dimensions(spark):
    bad = generate_orders(spark, 5000, 200, 50, D, 0.03, 42).orders.where("cliente_id > 200")
    assert bad.agg(F.min("cliente_id") >= 9000, F.max("cliente_id") < 9999).first() == (True, True)


def test_no_rows(spark):
    generated = generate_orders(spark, 0, 200, 50, D, 0.03, 42)
    assert generated.orders.count() == 0 and set(generated.injected.values()) == {0}


def test_values_do_not_depend_on_partitioning_but_on_the_seed(spark, monkeypatch):
    def total(rows_per_task, seed):
        monkeypatch.setattr(generate, "MAX_ROWS_PER_TASK", rows_per_task)
        rows = generate_orders(spark, 3000, 200, 50, D, 0.03, seed).orders
        return rows.rdd.getNumPartitions(), rows.agg(
            F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)"))).first()[0]

    (one, a), (many, b), (_, c) = total(10_000, 42), total(500, 42), total(10_000, 43)
    assert (one, many) == (1, 6) and a == b != c


def test_customers(spark):
    rows = generate_customers(spark, 2000, D, 42).collect()
    assert [r.cliente_id for r in rows] == list(range(1, 2001))
    assert {r.uf for r in rows} == set(CITIES_BY_UF)
    assert {(r.uf, r.cidade) for r in rows} == {(uf, c) for uf, cities in CITIES_BY_UF.items() for c in cities}
    assert all(r.email == f"{r.nome.lower().replace(' ', '.')}.{r.cliente_id}@exemplo.com" for r in rows)
    assert min(r.data_cadastro for r in rows) >= "2022-08-12" and max(r.data_cadastro for r in rows) <= "2026-08-21"


def test_products(spark):
    rows = generate_products(spark, 62, 42).collect()
    assert [r.nome_produto for r in rows[:13]][::12] == ["Item x0 Line0", "Item x0 Line1"]
    assert rows[59].nome_produto == "Item z3 Line4"
    assert rows[60].nome_produto == "Item x0 Line0 #60"
    assert rows[61].nome_produto == "Item x1 Line0 #61"
    for r in rows:
        _, low, high = PRODUCT_CATALOG[r.categoria]
        assert low <= r.preco <= high and round(r.preco, 2) == r.preco
