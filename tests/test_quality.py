"""Rules, reasons and routes on hand-written rows."""

import pytest
from frames import C, P, Q, customers, orders, products

from sedimenta.operators.quality import (
    ExistsRule, PositiveRule, apply_quality, check_and_enrich, check_orders, check_rows, order_rules, reason_counts,
)
from sedimenta.operators.silver import silver_projection

CASES = [
    # name, customer, product, quantity text, reasons
    ("ok", 1, 10, "3", ""),
    ("zero", 1, 10, "0", Q),
    ("negative", 1, 10, "-10", Q),
    ("null quantity", 1, 10, None, Q),
    ("empty", 1, 10, "", Q),
    ("text", 1, 10, "abc", Q),
    ("java suffix", 1, 10, "5d", Q),
    ("java suffix and blank", 1, 10, "5F ", Q),
    ("not a number", 1, 10, "NaN", Q),
    ("infinite", 1, 10, "inf", Q),
    ("infinite word", 1, 10, "Infinity", Q),
    ("beyond a long", 1, 10, "1e300", Q),
    ("fraction", 1, 10, "0.5", ""),
    ("exponent", 1, 10, "1e2", ""),
    ("blanks", 1, 10, " 4 ", ""),
    ("absent customer", 9001, 10, "1", C),
    ("null customer", None, 10, "1", C),
    ("absent product", 1, 9001, "1", P),
    ("null product", 1, None, "1", P),
    ("all three", 9001, 9001, "-1", f"{Q}; {C}; {P}"),
    ("quantity and product", 1, 9001, "0", f"{Q}; {P}"),
    ("null price", 1, 11, "2", ""),
]


@pytest.fixture(scope="module")
def flagged(spark):
    rows = [(i, c, p, q) for i, (_, c, p, q, _) in enumerate(CASES)]
    return check_orders(orders(spark, rows), customers(spark), products(spark))


def test_reasons(flagged):
    got = {r.pedido_id: r.motivo_rejeicao for r in flagged.flagged().collect()}
    assert {CASES[i][0]: reason for i, reason in got.items()} == {name: reason for name, *_, reason in CASES}


def test_routes_partition_the_rows(flagged):
    valid = [r.pedido_id for r in flagged.valid().collect()]
    rejected = [r.pedido_id for r in flagged.rejected().collect()]
    assert sorted(valid + rejected) == list(range(len(CASES)))
    assert {CASES[i][0] for i in valid} == {name for name, *_, reason in CASES if not reason}


def test_valid_rows_keep_only_their_columns(spark):
    valid, rejected = apply_quality(orders(spark, [(1, 1, 10, "1")]), customers(spark), products(spark))
    assert valid.columns == ["pedido_id", "cliente_id", "product_id", "quantidade", "data_pedido"]
    assert rejected.columns == [*valid.columns, "motivo_rejeicao"]
    assert rejected.count() == 0


def test_rule_totals_count_overlaps_once_per_rule(flagged):
    totals = {r.regra: r.violacoes for r in flagged.rule_totals().collect()}
    assert totals == {rule: sum(rule in reason for *_, reason in CASES) for rule in (Q, C, P)}


def test_duplicate_or_null_dimension_keys_do_not_multiply_rows(spark):
    clientes = customers(spark, [(1, "a", "", "", "", ""), (1, "b", "", "", "", ""), (None, "c", "", "", "", "")])
    checked = check_orders(orders(spark, [(1, 1, 10, "1"), (2, None, 10, "1")]), clientes, products(spark))
    assert sorted((r.pedido_id, r.motivo_rejeicao) for r in checked.flagged().collect()) == [(1, ""), (2, C)]


def test_rule_order_is_reason_order(spark):
    rules = list(reversed(order_rules(customers(spark), products(spark))))
    row = check_rows(orders(spark, [(1, 9, 9, "0")]), rules).flagged().first()
    assert row.motivo_rejeicao == f"{P}; {C}; {Q}"


def test_rules_work_on_any_table(spark):
    rows = spark.createDataFrame([(1, 2.0, "x"), (2, float("nan"), "x"), (3, 1.0, "z")], "id int, v double, k string")
    keys = spark.createDataFrame([("x",)], "k string")
    got = check_rows(rows, [PositiveRule("V", "v"), ExistsRule("K", "k", keys, "k")]).flagged().collect()
    assert {r.id: r.motivo_rejeicao for r in got} == {1: "", 2: "V", 3: "K"}


def test_attributes_need_unique_keys_and_free_names(spark):
    with pytest.raises(ValueError, match="unique keys"):
        ExistsRule("C", "cliente_id", customers(spark), "cliente_id", attributes={"x": "nome"})
    clash = ExistsRule("C", "cliente_id", customers(spark), "cliente_id", True, {"quantidade": "nome"})
    with pytest.raises(ValueError, match="clash"):
        check_rows(orders(spark, [(1, 1, 10, "1")]), [clash])


def test_reason_counts_are_ordered_with_a_tie_breaker(spark):
    rejected = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "motivo_rejeicao string")
    assert [(r.motivo_rejeicao, r.qtd) for r in reason_counts(rejected).collect()] == [("c", 2), ("a", 1), ("b", 1)]


def test_silver_values(spark):
    rows = orders(spark, [(1, 1, 10, "3"), (2, 1, 10, "0.5"), (3, 1, 11, "2")])
    enriched = check_and_enrich(rows, customers(spark), products(spark)).valid(with_attributes=True)
    got = {r.pedido_id: (r.quantidade, r.valor_total) for r in silver_projection(enriched).collect()}
    assert got == {1: (3, 7.5), 2: (0, 1.25), 3: (2, None)}
