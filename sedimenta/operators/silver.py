"""The enriched silver fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sedimenta.functions.numeric import round2, safe_number
from sedimenta.operators.gates import BROADCAST_LIMIT, Dimension, measure_dimensions, require_join_conserved
from sedimenta.schemas import SILVER, SILVER_COLUMNS


def silver_projection(enriched: DataFrame, *extra: str | Column) -> DataFrame:
    """Silver columns of valid rows that already carry their dimension columns.

    The total uses the quantity as read, fractions included; only then is the
    quantity cut to a whole number.
    """
    quantity = safe_number("quantidade", enriched.schema["quantidade"].dataType)
    priced = enriched.select(
        "*",
        round2(quantity * F.col("preco")).alias("valor_total"),
        quantity.try_cast("long").alias("__quantity"),
    )
    typed = [
        F.col("__quantity" if name == "quantidade" else name).cast(SILVER[name].dataType).alias(name)
        for name in SILVER_COLUMNS
    ]
    return priced.select(*typed, *extra)


# Dimension columns of the fact: name in the fact -> name in the dimension.
CUSTOMER_ATTRIBUTES = {"nome_cliente": "nome", "uf": "uf", "cidade": "cidade"}
PRODUCT_ATTRIBUTES = {"nome_produto": "nome_produto", "categoria": "categoria", "preco": "preco"}


def measure_order_dimensions(clientes: DataFrame, produtos: DataFrame) -> tuple[Dimension, Dimension]:
    """The two dimensions, cut to the columns of the fact, with unique keys and a counted size."""
    measured = measure_dimensions(
        clientes=(clientes.select("cliente_id", *CUSTOMER_ATTRIBUTES.values()), "cliente_id"),
        produtos=(produtos.select("product_id", *PRODUCT_ATTRIBUTES.values()), "product_id"))
    return measured["clientes"], measured["produtos"]


def join_dimensions(valid: DataFrame, customer: Dimension, product: Dimension, broadcast_limit: int) -> DataFrame:
    """Inner joins with each measured dimension whose columns the rows do not carry yet."""
    joined = valid
    for key, dimension, attributes in (("cliente_id", customer, CUSTOMER_ATTRIBUTES),
                                       ("product_id", product, PRODUCT_ATTRIBUTES)):
        if not set(attributes) <= set(valid.columns):
            columns = [F.col(source).alias(name) for name, source in attributes.items()]
            joined = joined.join(dimension.sized_for_join(broadcast_limit).select(key, *columns), key, "inner")
    return joined


def build_silver(valid: DataFrame, clientes: DataFrame, produtos: DataFrame, *extra: str,
                 verify_count: bool = True, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Silver fact of valid orders by inner joins. ``extra`` names order columns to keep beside the twelve.

    Raises if a dimension repeats a key or, with ``verify_count``, if the joins
    lose rows. That check is one pass that counts all rows and those a dimension is missing for;
    the process job takes the counts from the rows it stages instead.
    """
    customer, product = measure_order_dimensions(clientes, produtos)
    joined = join_dimensions(valid, customer, product, broadcast_limit)
    if verify_count:
        marked = valid.select("cliente_id", "product_id")
        for key, dimension in (("cliente_id", customer), ("product_id", product)):
            known = dimension.sized_for_join(broadcast_limit).select(key, F.lit(1).alias(f"__{key}"))
            marked = marked.join(known, key, "left")
        found = F.col("__cliente_id").isNotNull() & F.col("__product_id").isNotNull()
        rows, kept = marked.agg(F.count(F.lit(1)), F.count(F.when(found, 1))).first()
        require_join_conserved(rows, kept)
    return silver_projection(joined, *extra)


# A shuffle to so many partitions is written as the rows come (spark.shuffle.sort.bypassMergeThreshold); for more, a task
# holds the rows that it writes.
UNHELD_PARTITIONS = 200
# Rows of a task where there are more partitions than that.
MOST_ROWS = 1_000_000


def tasks_for(rows: int, few: int, most: int = MOST_ROWS) -> int:
    """Tasks of ``few`` rows as far as the shuffle to them holds no rows itself, of more, up to ``most``, beyond."""
    return max(-(-rows // most), min(-(-rows // few), UNHELD_PARTITIONS))


def range_by_order(rows: DataFrame, min_files: int = 1, spread: str | None = None) -> DataFrame:
    """Range-partition by ``pedido_id``, so that locally sorted pieces make a globally sorted table.

    There are as many pieces as the session's shuffle partitions, merged by AQE
    where small, which keeps all cores busy, or ``min_files`` if that is more than the partitions or the cores: AQE
    merges by bytes, and the rows of a merged piece may be many. A column of distinct values
    named by ``spread`` breaks ties, so the copies of one order id can span
    many pieces.
    """
    ranges = [F.col(k).asc_nulls_last() for k in ("pedido_id", spread) if k]
    spark = rows.sparkSession
    session_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if min_files > min(session_partitions, spark.sparkContext.defaultParallelism):
        return rows.repartitionByRange(min_files, *ranges)
    return rows.repartitionByRange(*ranges)
