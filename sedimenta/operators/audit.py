"""Audit queries Q1 to Q8 over the layers of one date.

The audits that combine totals of several layers tag the rows, union them and
aggregate once. Each branch is reduced inside its own scan tasks, and no join
of one-row results is needed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.numeric import cents, money_sum
from sedimenta.operators.gates import BROADCAST_LIMIT, Dimension, key_lookups
from sedimenta.operators.gold import GOLD_KEYS, gold_top
from sedimenta.operators.quality import REASON, reason_counts

# The verdicts of the reconciliation.
RECONCILED = "OK - INTEGRIDADE CONFIRMADA"
DIVERGENT = "DIVERGENCIA"
TOLERANCE = 0.01
SAMPLE_ROWS = 10


@dataclass(frozen=True)
class Layers:
    """The six tables of one ingest date, and the largest dimension that an audit may broadcast."""

    raw_clientes: DataFrame
    raw_produtos: DataFrame
    raw_pedidos: DataFrame
    quarantine_pedidos_rejeitados: DataFrame
    silver_fato_vendas: DataFrame
    gold_vendas_uf_categoria: DataFrame
    broadcast_limit: int = BROADCAST_LIMIT

    def tables(self) -> dict[str, DataFrame]:
        return {name: value for name, value in vars(self).items() if isinstance(value, DataFrame)}


def physical_files(layers: Layers) -> DataFrame:
    """Q1: path, size and rows of every file. The layers must be scans of files."""
    branches = [
        df.groupBy(
            F.col("_metadata.file_path").alias("arquivo_s3"),
            F.col("_metadata.file_size").alias("tamanho_bytes"),
        ).agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(name).alias("tabela"), "arquivo_s3", "tamanho_bytes", "linhas")
        for name, df in layers.tables().items()
    ]
    return reduce(DataFrame.unionByName, branches).orderBy("tabela", "arquivo_s3")


def _tagged(tag: str, df: DataFrame, *values: Column) -> DataFrame:
    return df.select(F.lit(tag).alias("camada"), *values)


def reconciliation(pedidos: DataFrame, silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Q2: raw rows against silver plus quarantined rows."""
    rows = _tagged("raw", pedidos).unionAll(_tagged("silver", silver)).unionAll(_tagged("quarantine", quarantine))
    return _reconciled(rows, *[F.col("camada") == tag for tag in ("raw", "silver", "quarantine")])


def reconciliation_of_flagged(flagged: DataFrame) -> DataFrame:
    """Q2 before anything is written: all checked rows against those without and with a reason, in one pass."""
    return _reconciled(flagged, F.lit(True), F.col(REASON) == "", F.col(REASON) != "")


def _reconciled(rows: DataFrame, *layers: Column) -> DataFrame:
    raw, good, bad = F.col("total_raw"), F.col("total_silver"), F.col("total_quarentena")
    return rows.agg(*[
        F.count(F.when(layer, 1)).alias(name)
        for layer, name in zip(layers, ("total_raw", "total_silver", "total_quarentena"), strict=True)
    ]).select(
        raw, good, bad,
        (good + bad).alias("silver_mais_quarentena"),
        (raw - (good + bad)).alias("diferenca"),
        F.when(raw == good + bad, RECONCILED).otherwise(DIVERGENT).alias("status"),
    )


def quarantine_sample(quarantine: DataFrame, *tie_breakers: str, n: int = SAMPLE_ROWS) -> DataFrame:
    """Q4: the first quarantined orders by id; equal ids follow the other columns."""
    columns = ["pedido_id", "cliente_id", "product_id", "quantidade", REASON]
    order = dict.fromkeys(["pedido_id", *tie_breakers, *columns])
    return quarantine.orderBy(*[F.asc_nulls_last(c) for c in order]).limit(n).select(*columns)


def silver_validity(silver: DataFrame) -> DataFrame:
    """Q5: silver rows, bad quantities, totals off by more than a cent, revenue. Sums are null without rows."""
    off = F.abs(F.col("valor_total") - F.col("quantidade") * F.col("preco")) > TOLERANCE
    return silver.agg(
        F.count(F.lit(1)).alias("linhas_silver"),
        F.sum(F.when(F.col("quantidade") <= 0, 1).otherwise(0)).alias("linhas_quantidade_invalida"),
        F.sum(F.when(off, 1).otherwise(0)).alias("linhas_valor_total_divergente"),
        money_sum(F.col("valor_total")).alias("receita_total"),
    )


def _with_markers(facts: DataFrame, clientes: DataFrame | Dimension, produtos: DataFrame | Dimension, broadcast_limit: int,
                  distinct: bool) -> DataFrame:
    """The facts with ``__customer`` and ``__product``, null where the key does not exist.

    Dimensions that have been measured, so their keys are unique, are not counted again.
    """
    sides = {"cliente_id": clientes, "product_id": produtos}
    lookups = {key: d.sized_for_join(broadcast_limit).select(key) for key, d in sides.items() if isinstance(d, Dimension)}
    unknown = {key: (d, key) for key, d in sides.items() if not isinstance(d, Dimension)}
    if unknown:
        lookups |= dict(zip(unknown, key_lookups(broadcast_limit, distinct, **unknown), strict=True))
    customers, products = lookups["cliente_id"], lookups["product_id"]
    customers = customers.withColumnRenamed("cliente_id", "__customer")
    products = products.withColumnRenamed("product_id", "__product")
    return (facts.join(customers, F.col("cliente_id") == F.col("__customer"), "left")
            .join(products, F.col("product_id") == F.col("__product"), "left"))


def silver_orphans(silver: DataFrame, clientes: DataFrame | Dimension, produtos: DataFrame | Dimension,
                   broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Q6: joined rows whose customer or product is missing; 0 for a sound silver layer."""
    joined = _with_markers(silver.select("cliente_id", "product_id"), clientes, produtos, broadcast_limit, False)
    missing = F.col("__customer").isNull() | F.col("__product").isNull()
    return joined.where(missing).agg(F.count(F.lit(1)).alias("silver_sem_cliente_ou_produto"))


def orphan_detail(facts: DataFrame, clientes: DataFrame | Dimension, produtos: DataFrame | Dimension,
                  broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Facts without their customer and facts without their product, one row for each missing key, in one pass."""
    joined = _with_markers(facts.select("pedido_id", "cliente_id", "product_id"), clientes, produtos, broadcast_limit, True)
    missing = [F.when(F.col(marker).isNull(), F.struct(F.lit(name).alias("dimensao"), F.col(key).alias("chave")))
               for marker, name, key in (("__customer", "clientes", "cliente_id"), ("__product", "produtos", "product_id"))]
    found = joined.select("pedido_id", F.explode(F.array_compact(F.array(*missing))).alias("falta"))
    return found.select("pedido_id", "falta.dimensao", "falta.chave")


def silver_against_gold(silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Q7: revenue of both layers and their difference."""
    rows = _tagged("silver", silver, cents(F.col("valor_total")).alias("centavos")).unionAll(
        _tagged("gold", gold, cents(F.col("receita_total")).alias("centavos")))
    return _revenues(rows, *[F.when(F.col("camada") == tag, F.col("centavos")) for tag in ("silver", "gold")])


def silver_against_its_gold(silver: DataFrame) -> DataFrame:
    """Q7 for the gold layer that ``build_gold`` makes of a silver frame, in one pass: gold is the
    sum of the groups with a state and a category."""
    groups = silver.groupBy(*GOLD_KEYS).agg(F.sum(cents(F.col("valor_total"))).alias("centavos"))
    named = reduce(Column.__and__, [F.col(k).isNotNull() for k in GOLD_KEYS])
    return _revenues(groups, F.col("centavos"), F.when(named, F.col("centavos")))


def _revenues(rows: DataFrame, silver: Column, gold: Column) -> DataFrame:
    totals = rows.agg(F.sum(silver).alias("silver"), F.sum(gold).alias("gold"))
    return totals.select(
        (F.col("silver") / 100).cast("double").alias("receita_silver"),
        (F.col("gold") / 100).cast("double").alias("receita_gold"),
        ((F.col("silver") - F.col("gold")) / 100).cast("double").alias("diferenca"),
    )


# The audits by report name.
AUDITS: dict[str, Callable[[Layers], DataFrame]] = {
    "Q1": physical_files,
    "Q2": lambda t: reconciliation(t.raw_pedidos, t.silver_fato_vendas, t.quarantine_pedidos_rejeitados),
    "Q3": lambda t: reason_counts(t.quarantine_pedidos_rejeitados),
    "Q4": lambda t: quarantine_sample(t.quarantine_pedidos_rejeitados),
    "Q5": lambda t: silver_validity(t.silver_fato_vendas),
    "Q6": lambda t: silver_orphans(t.silver_fato_vendas, t.raw_clientes, t.raw_produtos, t.broadcast_limit),
    "Q7": lambda t: silver_against_gold(t.silver_fato_vendas, t.gold_vendas_uf_categoria),
    "Q8": lambda t: gold_top(t.gold_vendas_uf_categoria),
}
