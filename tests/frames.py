"""Small hand-written frames."""

from sedimenta.schemas import CLIENTES, PEDIDOS_TEXT, PRODUTOS

Q, C, P = "QUANTIDADE_INVALIDA", "CLIENTE_INEXISTENTE", "PRODUTO_INEXISTENTE"


def customers(spark, rows=((1, "Ana", "a@x", "SP", "Campinas", "2020-01-01"),
                           (2, "Rui", "r@x", "RJ", "Niteroi", "2020-01-01"))):
    return spark.createDataFrame(list(rows), CLIENTES)


def products(spark, rows=((10, "Mouse Pro", "Informatica", 2.50), (11, "Sem Preco", "Casa", None))):
    return spark.createDataFrame(list(rows), PRODUTOS)


def orders(spark, rows):
    """Rows of (pedido_id, cliente_id, product_id, quantity text)."""
    return spark.createDataFrame([(*r, "2026-01-01") for r in rows], PEDIDOS_TEXT)
