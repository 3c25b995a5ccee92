"""Distinct orders that add up: a mergeable sketch for each state and category, kept beside gold.

An exact distinct count of many dates has to read the silver rows of all of them. A sketch of each date has a fixed size,
and the union of sketches counts an order of several dates once, with a relative standard error of about
1.04 / sqrt(2 ** lg_k): 1.6 % for the 4096 registers used here. Gold's own counts stay exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sedimenta.operators.gold import GOLD_KEYS

LG_K = 12
SKETCH = "pedidos_sketch"


def relative_error(lg_k: int = LG_K) -> float:
    """One standard error of an estimate from a union of sketches."""
    return 1.04 / 2 ** (lg_k / 2)


def order_sketches(silver: DataFrame, drop_null_keys: bool = True, lg_k: int = LG_K) -> DataFrame:
    """One sketch of the order ids for each group of gold. Partial sketches are merged, so no group is gathered."""
    if drop_null_keys:
        silver = silver.dropna(subset=list(GOLD_KEYS))
    return silver.groupBy(*GOLD_KEYS).agg(F.hll_sketch_agg("pedido_id", F.lit(lg_k)).alias(SKETCH))


def distinct_orders(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct orders per ``keys`` (by default those of gold) from the sketches of any dates and groups."""
    return sketches.groupBy(*(keys or GOLD_KEYS)).agg(
        F.hll_sketch_estimate(F.hll_union_agg(SKETCH)).alias("qtd_pedidos_estimada"))
