"""The driver's sales tables seen as customers, products and orders.

The tables are clean, so violations are injected by arithmetic on their keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SIGNUP_DATE = "2020-01-01"

# Declared, so that reading a table looks at no file before the query runs.
TABLE_SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
}


@dataclass(frozen=True)
class RawFrames:
    clientes: DataFrame
    produtos: DataFrame
    pedidos: DataFrame


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left").select(
        F.col("c_custkey").alias("cliente_id"),
        F.col("c_name").alias("nome"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.col("n_name").alias("uf"),
        F.col("c_mktsegment").alias("cidade"),
        F.lit(SIGNUP_DATE).alias("data_cadastro"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("nome_produto"),
        F.col("p_type").alias("categoria"),
        F.col("p_retailprice").alias("preco"),
    )


def orders(spark: SparkSession, sf_dir: str, anomalies: bool = True) -> DataFrame:
    """Order lines; ``pedido_id`` repeats. With ``anomalies``, about 3 % of the rows break each rule."""
    lines = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    heads = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    order, line, part, supp = (F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))

    def hit(score):
        return (score % 33 == 0) if anomalies else F.lit(False)

    bad_quantity = F.element_at(F.array(*[F.lit(q) for q in (0, -1, -3, -10)]), (order % 4 + 1).cast("int"))
    return lines.join(heads, order == F.col("o_orderkey")).select(
        order.alias("pedido_id"),
        line.cast("long").alias("linha"),
        F.when(hit(order * 31 + line * 17 + part), -9000000 - F.col("o_custkey"))
        .otherwise(F.col("o_custkey")).alias("cliente_id"),
        F.when(hit(order * 13 + line * 7 + supp), -9000000 - part).otherwise(part).alias("product_id"),
        F.when(hit(order * 7 + line * 5 + part * 3), bad_quantity)
        .otherwise(F.col("l_quantity")).cast("long").alias("quantidade"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("data_pedido"),
    )


def raw_frames(spark: SparkSession, sf_dir: str, anomalies: bool = True) -> RawFrames:
    return RawFrames(customers(spark, sf_dir), products(spark, sf_dir), orders(spark, sf_dir, anomalies))
