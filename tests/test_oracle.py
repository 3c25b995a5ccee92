"""Every query against independent SQL on DuckDB."""

import pytest
from compare import MEDIUM, assert_same

import __spark_entry__ as contract
from sedimenta.plans.oracle import ORACLE
from sedimenta.plans.queries import QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    assert assert_same(QUERIES[name](spark, MEDIUM), ORACLE[name], MEDIUM) > 0


def test_entry_runs(spark):
    gold = contract.entry(spark)
    assert gold.columns == ["uf", "categoria", "qtd_pedidos", "qtd_itens", "receita_total", "ticket_medio"]
    assert gold.count() == 150


def test_known_split(spark):
    """The split of the injected anomalies, by reason."""
    counts = {r.motivo_rejeicao: r.qtd for r in QUERIES["dq_reason_counts"](spark, MEDIUM).collect()}
    q, c, p = "QUANTIDADE_INVALIDA", "CLIENTE_INEXISTENTE", "PRODUTO_INEXISTENTE"
    assert counts == {p: 1732, c: 1761, f"{c}; {p}": 51, q: 1779, f"{q}; {p}": 49, f"{q}; {c}": 53,
                      f"{q}; {c}; {p}": 2}
