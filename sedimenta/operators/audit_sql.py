"""The audits as SQL text with parameters, for a SQL client over the catalog tables.

Database and date are parameters of the statement, ``:db`` and ``:day``; a table
is named by ``IDENTIFIER``. Nothing is put together from strings, so a name or date cannot change a statement. The results
are those of ``operators.audit`` over the same tables, but for raw keys that only that one's reading rule takes as whole
numbers: SQL sees the declared columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sedimenta.config import PipelineConfig


def _of(table: str, partition: str = "ingest_date") -> str:
    return f"(SELECT * FROM IDENTIFIER(:db || '.{table}') WHERE {partition} = :day)"


RAW, CLIENTES, PRODUTOS = _of("raw_pedidos"), _of("raw_clientes"), _of("raw_produtos")
SILVER, GOLD = _of("silver_fato_vendas"), _of("gold_vendas_uf_categoria")
QUARANTINE = _of("quarantine_pedidos_rejeitados", "data")
_MONEY = "CAST(sum(CAST(rint({0} * 100) AS DECIMAL(38, 0))) / 100 AS DOUBLE)"

AUDIT_SQL: dict[str, str] = {
    # Rows of the three layers are tagged and counted in one aggregate, so no join of single rows is needed.
    "Q2": f"""WITH camadas AS (
  SELECT 'raw' AS camada FROM {RAW} UNION ALL SELECT 'silver' FROM {SILVER} UNION ALL SELECT 'quarentena' FROM {QUARANTINE}),
totais AS (
  SELECT count_if(camada = 'raw') AS total_raw, count_if(camada = 'silver') AS total_silver,
         count_if(camada = 'quarentena') AS total_quarentena FROM camadas)
SELECT *, total_silver + total_quarentena AS silver_mais_quarentena,
       total_raw - total_silver - total_quarentena AS diferenca,
       if(total_raw - total_silver = total_quarentena, 'OK - INTEGRIDADE CONFIRMADA', 'DIVERGENCIA') AS status
FROM totais""",
    "Q3": f"SELECT motivo_rejeicao, count(1) AS qtd FROM {QUARANTINE} GROUP BY ALL ORDER BY qtd DESC, motivo_rejeicao NULLS LAST",
    "Q4": f"""SELECT pedido_id, cliente_id, product_id, quantidade, motivo_rejeicao FROM {QUARANTINE}
ORDER BY ALL NULLS LAST LIMIT 10""",
    "Q5": f"""SELECT count(1) AS linhas_silver, sum(CAST(coalesce(quantidade <= 0, false) AS INT)) AS linhas_quantidade_invalida,
       sum(CAST(coalesce(abs(valor_total - preco * quantidade) > 0.01, false) AS INT)) AS linhas_valor_total_divergente,
       {_MONEY.format("valor_total")} AS receita_total FROM {SILVER}""",
    "Q6": f"""SELECT count_if(c.cliente_id IS NULL OR p.product_id IS NULL) AS silver_sem_cliente_ou_produto
FROM {SILVER} s LEFT JOIN {CLIENTES} c USING (cliente_id) LEFT JOIN {PRODUTOS} p USING (product_id)""",
    "Q7": f"""WITH receitas AS (
  SELECT valor_total AS silver, CAST(NULL AS DOUBLE) AS gold FROM {SILVER}
  UNION ALL SELECT NULL, receita_total FROM {GOLD}),
somas AS (
  SELECT sum(CAST(rint(silver * 100) AS DECIMAL(38, 0))) AS silver, sum(CAST(rint(gold * 100) AS DECIMAL(38, 0))) AS gold FROM receitas)
SELECT CAST(silver / 100 AS DOUBLE) AS receita_silver, CAST(gold / 100 AS DOUBLE) AS receita_gold,
       CAST((silver - gold) / 100 AS DOUBLE) AS diferenca FROM somas""",
    "Q8": f"""SELECT * EXCEPT (ingest_date) FROM {GOLD}
ORDER BY receita_total DESC, uf NULLS LAST, categoria NULLS LAST LIMIT 10""",
}


def audit_by_sql(spark: SparkSession, cfg: PipelineConfig, title: str) -> DataFrame:
    """One audit of the configured database and date by its SQL text."""
    return spark.sql(AUDIT_SQL[title], args={"db": cfg.database, "day": cfg.ingest_date})
