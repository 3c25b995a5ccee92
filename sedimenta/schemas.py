"""Declared schemas and folders of every layer table.

Table, column, folder and rule names are the fixed data contract.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_LONG, _DOUBLE, _TEXT = T.LongType(), T.DoubleType(), T.StringType()

CLIENTES = _struct(
    ("cliente_id", _LONG), ("nome", _TEXT), ("email", _TEXT),
    ("uf", _TEXT), ("cidade", _TEXT), ("data_cadastro", _TEXT),
)
PRODUTOS = _struct(
    ("product_id", _LONG), ("nome_produto", _TEXT), ("categoria", _TEXT), ("preco", _DOUBLE),
)
PEDIDOS = _struct(
    ("pedido_id", _LONG), ("cliente_id", _LONG), ("product_id", _LONG),
    ("quantidade", _LONG), ("data_pedido", _TEXT),
)
# The raw scan keeps the quantity as text: a long would turn 0.5 or "abc" into null
# before the rules see them.
PEDIDOS_TEXT = T.StructType(
    [T.StructField(f.name, _TEXT if f.name == "quantidade" else f.dataType) for f in PEDIDOS]
)
# The line of an order as it was read, where its typed columns do not hold all of it.
RAW_LINE = "linha_raw"
QUARANTINE = T.StructType([*PEDIDOS.fields, T.StructField("motivo_rejeicao", _TEXT)])
SILVER = _struct(
    ("pedido_id", _LONG), ("data_pedido", _TEXT), ("cliente_id", _LONG), ("nome_cliente", _TEXT),
    ("uf", _TEXT), ("cidade", _TEXT), ("product_id", _LONG), ("nome_produto", _TEXT),
    ("categoria", _TEXT), ("quantidade", _LONG), ("preco", _DOUBLE), ("valor_total", _DOUBLE),
)
GOLD = _struct(
    ("uf", _TEXT), ("categoria", _TEXT), ("qtd_pedidos", _LONG), ("qtd_itens", _LONG),
    ("receita_total", _DOUBLE), ("ticket_medio", _DOUBLE),
)
SILVER_COLUMNS = SILVER.fieldNames()

# The texts that count as missing in a CSV file.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


@dataclass(frozen=True)
class LayerTable:
    """One table of one layer: its name, folder, partition column, schema and file format."""

    name: str
    folder: str
    partition: str
    schema: T.StructType
    format: str


RAW_CLIENTES = LayerTable("raw_clientes", "raw/clientes", "ingest_date", CLIENTES, "csv")
RAW_PRODUTOS = LayerTable("raw_produtos", "raw/produtos", "ingest_date", PRODUTOS, "csv")
RAW_PEDIDOS = LayerTable("raw_pedidos", "raw/pedidos", "ingest_date", PEDIDOS, "csv")
QUARANTINE_TABLE = LayerTable(
    "quarantine_pedidos_rejeitados", "quarantine/pedidos_rejeitados", "data", QUARANTINE, "json"
)
SILVER_TABLE = LayerTable("silver_fato_vendas", "processed/fato_vendas", "ingest_date", SILVER, "parquet")
GOLD_TABLE = LayerTable("gold_vendas_uf_categoria", "gold/vendas_uf_categoria", "ingest_date", GOLD, "parquet")

# Beside gold, where a run keeps sketches; not one of the layer tables.
GOLD_SKETCHES = LayerTable("gold_pedidos_sketch", "gold/pedidos_sketch", "ingest_date", T.StructType(
    [T.StructField("uf", _TEXT), T.StructField("categoria", _TEXT), T.StructField("pedidos_sketch", T.BinaryType())]), "parquet")

DERIVED_TABLES = (QUARANTINE_TABLE, SILVER_TABLE, GOLD_TABLE)
LAYER_TABLES = (RAW_CLIENTES, RAW_PRODUTOS, RAW_PEDIDOS, QUARANTINE_TABLE, SILVER_TABLE, GOLD_TABLE)
