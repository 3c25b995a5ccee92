"""The revenue mart per state and category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.numeric import money_sum, round2
from sedimenta.operators.silver import tasks_for

GOLD_KEYS = ("uf", "categoria")
# Rows of one task of the distinct count: nearly each is an order of its own in the task's hash tables.
DISTINCT_ROWS = 250_000
# Rows of so many tasks are not worth a shuffle of their own.
UNDEALT_TASKS = 4


def build_gold(silver: DataFrame, drop_null_keys: bool = True, rows: int | None = None) -> DataFrame:
    """Orders, items, revenue and average ticket per (uf, categoria), highest revenue first.

    The average divides the unrounded revenue. Rows without a state or category
    are left out by default; the silver-to-gold audit then shows their revenue
    as a difference. Items are added as decimals; a total beyond a long is an error,
    which a run meets before it publishes anything. ``rows``, about how many silver has, bounds the rows, and with them the
    hash table, of a task: many are dealt by group and order to as many tasks as they need, where the tasks of a scan, or
    of a join, would hold as many as their bytes allow.
    """
    if drop_null_keys:
        silver = silver.dropna(subset=list(GOLD_KEYS))
    if rows and rows > UNDEALT_TASKS * DISTINCT_ROWS:
        silver = silver.select(*GOLD_KEYS, "pedido_id", "quantidade", "valor_total").repartition(
            tasks_for(rows, DISTINCT_ROWS), *GOLD_KEYS, "pedido_id")
    totals = silver.groupBy(*GOLD_KEYS).agg(
        F.count_distinct("pedido_id").alias("qtd_pedidos"),
        F.coalesce(F.sum(F.col("quantidade").cast("decimal(38,0)")), F.lit(0)).cast("long").alias("qtd_itens"),
        F.coalesce(money_sum(F.col("valor_total")), F.lit(0.0)).alias("receita_total"),
    )
    return totals.select(
        *GOLD_KEYS, "qtd_pedidos", "qtd_itens",
        round2(F.col("receita_total")).alias("receita_total"),
        round2(F.try_divide("receita_total", "qtd_pedidos")).alias("ticket_medio"),
    ).orderBy(F.desc("receita_total"), *[F.asc_nulls_last(k) for k in GOLD_KEYS])


def gold_top(gold: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` combinations with the highest revenue."""
    return gold.select(*GOLD_KEYS, "qtd_pedidos", "qtd_itens", "receita_total", "ticket_medio").orderBy(
        F.desc("receita_total"), *[F.asc_nulls_last(k) for k in GOLD_KEYS]).limit(n)
