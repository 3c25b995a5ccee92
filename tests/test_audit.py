"""Audits and gold on sound, tampered and empty layers."""

import pytest
from frames import C, P, Q, customers, products

from sedimenta.operators import audit, gates
from sedimenta.operators.gold import build_gold, gold_top
from sedimenta.operators.silver import build_silver
from sedimenta.schemas import GOLD, PEDIDOS, QUARANTINE, SILVER


def silver(spark, rows):
    """Rows of (pedido_id, cliente_id, uf, product_id, categoria, quantidade, preco, valor_total)."""
    return spark.createDataFrame(
        [(o, "2026-01-01", c, "n", uf, "cid", p, "np", cat, q, price, total)
         for o, c, uf, p, cat, q, price, total in rows], SILVER)


SOUND = [(1, 1, "SP", 10, "Casa", 2, 2.5, 5.0), (1, 1, "SP", 10, "Casa", 1, 2.5, 2.5),
         (2, 2, "RJ", 10, "Casa", 4, 2.5, 10.0)]


def test_gold_counts_orders_once(spark):
    rows = [tuple(r) for r in build_gold(silver(spark, SOUND)).collect()]
    assert rows == [("RJ", "Casa", 1, 4, 10.0, 10.0), ("SP", "Casa", 1, 3, 7.5, 7.5)]


def test_gold_null_groups(spark):
    rows = silver(spark, [*SOUND, (3, 1, None, 10, "Casa", 1, 9.0, 9.0), (4, 1, "SP", 10, None, 1, 1.0, 1.0)])
    assert build_gold(rows).count() == 2
    assert build_gold(rows, drop_null_keys=False).count() == 4
    q7 = audit.silver_against_gold(rows, build_gold(rows)).first()
    assert (q7.receita_silver, q7.receita_gold, q7.diferenca) == (27.5, 17.5, 10.0)
    kept = audit.silver_against_gold(rows, build_gold(rows, drop_null_keys=False)).first()
    assert kept.diferenca == 0.0


def test_gold_without_prices_has_zero_revenue(spark):
    row = build_gold(silver(spark, [(1, 1, "SP", 11, "Casa", 2, None, None)])).first()
    assert (row.receita_total, row.ticket_medio, row.qtd_itens) == (0.0, 0.0, 2)


def test_gold_without_order_ids_has_no_ticket(spark):
    row = build_gold(silver(spark, [(None, 1, "SP", 10, "Casa", 2, 2.5, 5.0)])).first()
    assert (row.qtd_pedidos, row.receita_total, row.ticket_medio) == (0, 5.0, None)


def test_ticket_divides_the_unrounded_revenue_half_even(spark):
    rows = [(i, 1, "SP", 10, "Casa", 1, 0.01, 0.01) for i in range(8)] + [(0, 1, "SP", 10, "Casa", 1, 0.92, 0.92)]
    row = build_gold(silver(spark, rows)).first()
    assert (row.receita_total, row.qtd_pedidos, row.ticket_medio) == (1.0, 8, 0.12)


def test_gold_top_breaks_ties_by_name(spark):
    tied = [(uf, "Casa", 1, 1, 5.0, 5.0) for uf in "DBCA"]
    gold = spark.createDataFrame([*tied, ("Z", "Casa", 1, 1, 6.0, 6.0)], GOLD)
    assert [r.uf for r in gold_top(gold, 3).collect()] == ["Z", "A", "B"]


def test_validity_finds_tampered_rows(spark):
    rows = [*SOUND, (5, 1, "SP", 10, "Casa", 0, 2.5, 0.0), (6, 1, "SP", 10, "Casa", 1, 2.5, 2.52),
            (7, 1, "SP", 10, "Casa", 1, 2.5, 2.505), (8, 1, "SP", 11, "Casa", 1, None, None)]
    assert tuple(audit.silver_validity(silver(spark, rows)).first())[:3] == (7, 1, 1)


def test_orphans(spark):
    rows = silver(spark, [*SOUND, (5, 9, "SP", 10, "Casa", 1, 1.0, 1.0), (6, 9, "SP", 99, "Casa", 1, 1.0, 1.0),
                          (7, None, "SP", 10, "Casa", 1, 1.0, 1.0)])
    assert audit.silver_orphans(silver(spark, SOUND), customers(spark), products(spark)).first()[0] == 0
    assert audit.silver_orphans(rows, customers(spark), products(spark)).first()[0] == 3
    detail = audit.orphan_detail(rows, customers(spark), products(spark)).collect()
    assert sorted((r.pedido_id, r.dimensao, r.chave) for r in detail if r.chave) == [
        (5, "clientes", 9), (6, "clientes", 9), (6, "produtos", 99)]
    assert [r.pedido_id for r in detail if r.chave is None] == [7]


def test_orphans_count_joined_rows_of_duplicate_dimension_keys(spark):
    clientes = customers(spark, [(1, "", "", "", "", "")] * 2)
    rows = silver(spark, [(1, 1, "SP", 99, "Casa", 1, 1.0, 1.0), (2, 1, "SP", 10, "Casa", 1, 1.0, 1.0)])
    assert audit.silver_orphans(rows, clientes, products(spark)).first()[0] == 2


def test_reconciliation_shows_a_difference(spark):
    raw = spark.range(5).toDF("pedido_id")
    row = audit.reconciliation(raw, spark.range(3), spark.range(1)).first()
    assert tuple(row) == (5, 3, 1, 4, 1, "DIVERGENCIA")


def test_quarantine_sample_puts_null_ids_last(spark):
    rows = [(None, 1, 1, 0, "d", Q), (2, 1, 1, 0, "d", C), (1, 1, 1, 0, "d", P), (1, 1, 1, 0, "d", C)]
    got = audit.quarantine_sample(spark.createDataFrame(rows, QUARANTINE)).collect()
    assert [(r.pedido_id, r.motivo_rejeicao) for r in got] == [(1, C), (1, P), (2, C), (None, Q)]


def test_build_silver_gates(spark):
    valid = spark.createDataFrame([(1, 1, 10, 3, "2026-01-01"), (2, 7, 10, 3, "2026-01-01")], PEDIDOS)
    with pytest.raises(gates.JoinLossError):
        build_silver(valid, customers(spark), products(spark))
    assert build_silver(valid, customers(spark), products(spark), verify_count=False).count() == 1
    with pytest.raises(gates.DuplicateKeyError, match="produtos"):
        build_silver(valid, customers(spark), products(spark, [(10, "a", "b", 1.0)] * 2))


def test_duplicate_keys_count_nulls_as_one_key(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    assert sorted((r.k is None, r.ocorrencias) for r in gates.duplicate_keys(rows, "k").collect()) == [
        (False, 2), (True, 2)]


def test_measured_size_counts_rows_and_text(spark):
    small = gates.measure_dimensions(d=(products(spark), "product_id"))["d"]
    assert small.rows == 2 and small.bytes > sum(map(len, ("Mouse Pro", "Informatica", "Sem Preco", "Casa")))
    assert small.fits(1000) and not small.fits(10)
    empty = gates.measure_dimensions(d=(products(spark, []), "product_id"))["d"]
    assert (empty.rows, empty.bytes) == (0, 0)
