"""The queries as ANSI SQL over the same tables, for an independent check."""

from __future__ import annotations

_INJECTED = """
clientes AS (
  SELECT c_custkey AS cliente_id, c_name AS nome, lower(replace(c_name, '#', '.')) || '@example.com' AS email,
         n_name AS uf, c_mktsegment AS cidade, '2020-01-01' AS data_cadastro
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
produtos AS (
  SELECT p_partkey AS product_id, p_name AS nome_produto, p_type AS categoria, p_retailprice AS preco FROM part),
limpos AS (
  SELECT l_orderkey AS pedido_id, CAST(l_linenumber AS BIGINT) AS linha, o_custkey AS cliente_id,
         l_partkey AS product_id, CAST(l_quantity AS BIGINT) AS quantidade,
         strftime(o_orderdate, '%Y-%m-%d') AS data_pedido, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
pedidos AS (
  SELECT pedido_id, linha,
         CASE WHEN (pedido_id * 31 + linha * 17 + product_id) % 33 = 0
              THEN -9000000 - cliente_id ELSE cliente_id END AS cliente_id,
         CASE WHEN (pedido_id * 13 + linha * 7 + l_suppkey) % 33 = 0
              THEN -9000000 - product_id ELSE product_id END AS product_id,
         CASE WHEN (pedido_id * 7 + linha * 5 + product_id * 3) % 33 = 0
              THEN CASE pedido_id % 4 WHEN 0 THEN 0 WHEN 1 THEN -1 WHEN 2 THEN -3 ELSE -10 END
              ELSE quantidade END AS quantidade,
         data_pedido
  FROM limpos)"""

_CHECKED = _INJECTED + """,
marcados AS (
  SELECT p.*, NOT (coalesce(quantidade, 0) > 0) AS q,
         NOT EXISTS (SELECT 1 FROM clientes c WHERE c.cliente_id = p.cliente_id) AS c,
         NOT EXISTS (SELECT 1 FROM produtos d WHERE d.product_id = p.product_id) AS d
  FROM pedidos p),
avaliados AS (
  SELECT pedido_id, linha, cliente_id, product_id, quantidade, data_pedido, q, c, d,
         concat_ws('; ', CASE WHEN q THEN 'QUANTIDADE_INVALIDA' END, CASE WHEN c THEN 'CLIENTE_INEXISTENTE' END,
                   CASE WHEN d THEN 'PRODUTO_INEXISTENTE' END) AS motivo_rejeicao
  FROM marcados),
rejeitados AS (SELECT * EXCLUDE (q, c, d) FROM avaliados WHERE q OR c OR d),
validos AS (SELECT * EXCLUDE (q, c, d, motivo_rejeicao) FROM avaliados WHERE NOT (q OR c OR d))"""

_SILVER_FROM = """
  SELECT v.pedido_id, v.data_pedido, v.cliente_id, c.nome AS nome_cliente, c.uf, c.cidade, v.product_id,
         d.nome_produto, d.categoria, v.quantidade, d.preco,
         round_even(v.quantidade * d.preco * 100, 0) / 100 AS valor_total, v.linha
  FROM validos v JOIN clientes c ON v.cliente_id = c.cliente_id JOIN produtos d ON v.product_id = d.product_id"""

_SILVER = _CHECKED + f""",
silver AS ({_SILVER_FROM})"""

_SEM_UF = _SILVER + """,
sem_uf AS (SELECT * REPLACE (CASE WHEN cliente_id % 7 <> 0 THEN uf END AS uf) FROM silver)"""


def _gold(source: str, where: str = "") -> str:
    return f"""
  SELECT uf, categoria, qtd_pedidos, qtd_itens, receita_total,
         round_even(receita_total / qtd_pedidos * 100, 0) / 100 AS ticket_medio
  FROM (SELECT uf, categoria, count(DISTINCT pedido_id) AS qtd_pedidos,
               CAST(sum(quantidade) AS BIGINT) AS qtd_itens,
               CAST(sum(CAST(valor_total AS DECIMAL(18, 2))) AS DOUBLE) AS receita_total
        FROM {source} {where} GROUP BY uf, categoria) totais"""


_GOLD = _SILVER + f""",
gold AS ({_gold('silver')})"""


def _money(column: str, table: str) -> str:
    return f"(SELECT sum(CAST({column} AS DECIMAL(18, 2))) FROM {table})"


def _validity(source: str) -> str:
    return f"""SELECT count(*) AS linhas_silver,
       count(*) FILTER (WHERE quantidade <= 0) AS linhas_quantidade_invalida,
       count(*) FILTER (WHERE valor_total NOT BETWEEN quantidade * preco - 0.01 AND quantidade * preco + 0.01)
         AS linhas_valor_total_divergente,
       CAST(sum(CAST(valor_total AS DECIMAL(18, 2))) AS DOUBLE) AS receita_total
FROM {source}"""


def _orphans(source: str) -> str:
    return f"""SELECT count(*) AS silver_sem_cliente_ou_produto FROM {source}
WHERE cliente_id NOT IN (SELECT cliente_id FROM clientes) OR product_id NOT IN (SELECT product_id FROM produtos)"""


def _revenue(silver: str, gold: str) -> str:
    a, b = _money("valor_total", silver), _money("receita_total", gold)
    return (f"SELECT CAST({a} AS DOUBLE) AS receita_silver, CAST({b} AS DOUBLE) AS receita_gold, "
            f"CAST({a} - {b} AS DOUBLE) AS diferenca")


def _reconciled(raw: str, silver: str, quarantine: str) -> str:
    return f"""SELECT r AS total_raw, s AS total_silver, x AS total_quarentena, s + x AS silver_mais_quarentena,
       r - (s + x) AS diferenca,
       CASE WHEN r = s + x THEN 'OK - INTEGRIDADE CONFIRMADA' ELSE 'DIVERGENCIA' END AS status
FROM (SELECT (SELECT count(*) FROM {raw}) AS r, (SELECT count(*) FROM {silver}) AS s,
             (SELECT count(*) FROM {quarantine}) AS x) contagens"""


_QUARANTINE = "SELECT pedido_id, cliente_id, product_id, quantidade, data_pedido, motivo_rejeicao"
_SILVER_PLAIN = f"WITH {_SILVER} SELECT * EXCLUDE (linha) FROM silver"

_TEXTS = _INJECTED + """,
textos AS (
  SELECT pedido_id, linha, cliente_id, product_id,
         CASE pedido_id % 10 WHEN 0 THEN CAST(quantidade AS VARCHAR) WHEN 1 THEN quantidade || '.5' WHEN 2 THEN '0.5'
              WHEN 3 THEN 'abc' WHEN 4 THEN 'NaN' WHEN 5 THEN 'inf' WHEN 6 THEN quantidade || 'd'
              WHEN 7 THEN '-' || quantidade WHEN 8 THEN '' END AS texto
  FROM limpos),
numeros AS (
  SELECT t.*, CASE WHEN pedido_id % 10 IN (0, 1, 2, 7) THEN CAST(texto AS DOUBLE) END AS n FROM textos t)"""

ORACLE: dict[str, str] = {
    "dq_flagged": f"WITH {_CHECKED} SELECT * EXCLUDE (q, c, d) FROM avaliados",
    "dq_valid": f"WITH {_CHECKED} SELECT * FROM validos",
    "dq_rejected": f"WITH {_CHECKED} SELECT * FROM rejeitados",
    "dq_reason_counts": f"WITH {_CHECKED} SELECT motivo_rejeicao, count(*) AS qtd FROM rejeitados "
                        "GROUP BY motivo_rejeicao ORDER BY qtd DESC, motivo_rejeicao",
    "dq_rule_totals": f"""WITH {_CHECKED}
SELECT 'QUANTIDADE_INVALIDA' AS regra, count(*) AS violacoes FROM avaliados WHERE q
UNION ALL SELECT 'CLIENTE_INEXISTENTE', count(*) FROM avaliados WHERE c
UNION ALL SELECT 'PRODUTO_INEXISTENTE', count(*) FROM avaliados WHERE d""",
    "dq_customer_quality": """SELECT c_custkey, c_nationkey, c_acctbal,
  concat_ws('; ', CASE WHEN NOT (c_acctbal > 0) THEN 'SALDO_INVALIDO' END,
            CASE WHEN NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_regionkey <> 2)
                 THEN 'NACAO_INEXISTENTE' END) AS motivo_rejeicao
FROM customer""",
    "dq_text_quantities": f"""WITH {_TEXTS}
SELECT pedido_id, linha, CAST(trunc(n) AS BIGINT) AS quantidade,
       round_even(n * preco * 100, 0) / 100 AS valor_total, '' AS motivo_rejeicao
FROM numeros JOIN produtos USING (product_id) WHERE n > 0
UNION ALL
SELECT pedido_id, NULL, CAST(trunc(n) AS BIGINT), NULL, 'QUANTIDADE_INVALIDA'
FROM numeros WHERE n IS NULL OR NOT (n > 0)""",
    "silver_fato_vendas": f"WITH {_SILVER} SELECT * FROM silver",
    "silver_from_valid": f"WITH {_SILVER} SELECT * FROM silver",
    "gold_uf_categoria": f"WITH {_GOLD} SELECT * FROM gold ORDER BY receita_total DESC, uf, categoria",
    "gold_top10": f"WITH {_GOLD} SELECT * FROM gold ORDER BY receita_total DESC, uf, categoria LIMIT 10",
    "gold_null_keys": f"WITH {_SEM_UF} {_gold('sem_uf')}",
    "gate_duplicate_keys": "SELECT l_orderkey, l_linenumber, count(*) AS ocorrencias FROM lineitem "
                           "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
    "gate_reconciliation": f"WITH {_SILVER} {_reconciled('pedidos', 'silver', 'rejeitados')}",
    "audit_quarantine_sample": f"""WITH {_CHECKED}
SELECT pedido_id, cliente_id, product_id, quantidade, motivo_rejeicao FROM rejeitados
ORDER BY pedido_id, linha, cliente_id, product_id, quantidade, motivo_rejeicao LIMIT 10""",
    "audit_silver_validity": f"WITH {_SILVER} {_validity('silver')}",
    "audit_validity_tampered": f"""WITH {_SILVER} {_validity('''(SELECT * REPLACE (
  CASE WHEN pedido_id % 50 = 0 THEN 0 ELSE quantidade END AS quantidade,
  CASE WHEN pedido_id % 40 = 0 THEN valor_total + 1 ELSE valor_total END AS valor_total) FROM silver) t''')}""",
    "audit_silver_orphans": f"WITH {_SILVER} {_orphans('silver')}",
    "audit_orphans_tampered": f"WITH {_INJECTED} {_orphans('pedidos')}",
    "orphan_detail_left_anti": f"""WITH {_CHECKED}
SELECT pedido_id, 'clientes' AS dimensao, cliente_id AS chave FROM avaliados WHERE c
UNION ALL SELECT pedido_id, 'produtos', product_id FROM avaliados WHERE d""",
    "audit_silver_vs_gold": f"WITH {_GOLD} {_revenue('silver', 'gold')}",
    "audit_gold_lost_revenue": f"WITH {_SEM_UF}, gold AS ({_gold('sem_uf', 'WHERE uf IS NOT NULL')}) "
                               f"{_revenue('sem_uf', 'gold')}",
    "audit_files_rows": f"""WITH {_GOLD}
SELECT 'raw_clientes' AS tabela, count(*) AS linhas FROM clientes
UNION ALL SELECT 'raw_produtos', count(*) FROM produtos
UNION ALL SELECT 'raw_pedidos', count(*) FROM pedidos
UNION ALL SELECT 'quarantine_pedidos_rejeitados', count(*) FROM rejeitados
UNION ALL SELECT 'silver_fato_vendas', count(*) FROM silver
UNION ALL SELECT 'gold_vendas_uf_categoria', count(*) FROM gold""",
    "audit_reports_exported": f"WITH {_SILVER} {_reconciled('pedidos', 'silver', 'rejeitados')}",
    "roundtrip_raw_csv": f"WITH {_INJECTED} SELECT * EXCLUDE (linha) FROM pedidos",
    "roundtrip_quarantine_json": f"WITH {_CHECKED} {_QUARANTINE} FROM rejeitados",
    "roundtrip_silver_parquet": _SILVER_PLAIN,
    "published_gold": f"WITH {_GOLD} SELECT * FROM gold",
    "published_silver": _SILVER_PLAIN,
    "idempotent_overwrite": f"WITH {_INJECTED} "
                            f"{_reconciled('limpos', 'limpos', '(SELECT 1 WHERE false) vazia')}",
    "partition_append": f"""WITH {_SILVER}
SELECT '2026-09-20' AS ingest_date, count(*) AS linhas FROM silver
UNION ALL SELECT '2026-09-21', count(*) FROM limpos""",
    "silver_bucketed": f"WITH {_SILVER} SELECT * FROM silver",
    "orphans_bucketed": f"WITH {_INJECTED} {_orphans('pedidos')}",
    "sample_exact_lines": """WITH linhas AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS qtd,
         CAST(round_even(l_extendedprice * 100, 0) AS BIGINT) AS centavos FROM lineitem),
ordenadas AS (
  SELECT *, row_number() OVER (ORDER BY substr(md5(concat_ws('|', '42', l_orderkey, l_linenumber, l_partkey, l_suppkey, qtd,
                                                             centavos)), 1, 12)) AS lugar, count(*) OVER () AS n FROM linhas)
SELECT * EXCLUDE (lugar, n) FROM ordenadas WHERE lugar <= CAST(trunc(n * CAST(0.03 AS DOUBLE)) AS BIGINT)""",
    "sketch_distinct_orders": f"WITH {_GOLD} SELECT uf, categoria, qtd_pedidos, true AS dentro_do_erro FROM gold",
    "sketch_orders_of_two_dates": f"""WITH {_INJECTED}
SELECT uf, count(DISTINCT pedido_id) AS qtd_pedidos, true AS dentro_do_erro
FROM limpos JOIN clientes USING (cliente_id) GROUP BY uf""",
    "versioned_rerun": f"""WITH {_SILVER}
SELECT 'antes' AS momento, count(*) AS linhas, CAST(sum(CAST(valor_total AS DECIMAL(18, 2))) AS DOUBLE) AS receita FROM silver
UNION ALL
SELECT 'depois', count(*), CAST(sum(CAST(round_even(quantidade * preco * 100, 0) / 100 AS DECIMAL(18, 2))) AS DOUBLE)
FROM limpos JOIN produtos USING (product_id)""",
    "catalog_quarantine_scan": f"WITH {_CHECKED} {_QUARANTINE}, '2026-09-20' AS data FROM rejeitados",
    **{f"audit_report_q{n}": sql for n, sql in (
        (3, f"WITH {_CHECKED} SELECT motivo_rejeicao, count(*) AS qtd FROM rejeitados GROUP BY motivo_rejeicao"),
        (4, f"""WITH {_CHECKED}
SELECT pedido_id, cliente_id, product_id, quantidade, motivo_rejeicao FROM rejeitados
ORDER BY pedido_id, cliente_id, product_id, quantidade, motivo_rejeicao LIMIT 10"""),
        (5, f"WITH {_SILVER} {_validity('silver')}"),
        (6, f"WITH {_SILVER} {_orphans('silver')}"),
        (7, f"WITH {_GOLD} {_revenue('silver', 'gold')}"),
        (8, f"WITH {_GOLD} SELECT * FROM gold ORDER BY receita_total DESC, uf, categoria LIMIT 10"))},
    "audit_files": f"""WITH {_GOLD}
SELECT tabela, pasta, true AS com_bytes, linhas FROM (
  SELECT 'raw_clientes' AS tabela, 'raw/clientes/ingest_date=2026-09-20' AS pasta, count(*) AS linhas FROM clientes
  UNION ALL SELECT 'raw_produtos', 'raw/produtos/ingest_date=2026-09-20', count(*) FROM produtos
  UNION ALL SELECT 'raw_pedidos', 'raw/pedidos/ingest_date=2026-09-20', count(*) FROM pedidos
  UNION ALL SELECT 'quarantine_pedidos_rejeitados', 'quarantine/pedidos_rejeitados/data=2026-09-20', count(*)
            FROM rejeitados
  UNION ALL SELECT 'silver_fato_vendas', 'processed/fato_vendas/ingest_date=2026-09-20', count(*) FROM silver
  UNION ALL SELECT 'gold_vendas_uf_categoria', 'gold/vendas_uf_categoria/ingest_date=2026-09-20', count(*) FROM gold)""",
    "audit_text_keys": "SELECT CAST(0 AS BIGINT) AS silver_sem_cliente_ou_produto",
    "run_counts": f"""WITH {_GOLD}
SELECT 'raw' AS contagem, count(*) AS linhas FROM pedidos
UNION ALL SELECT 'valid', count(*) FROM validos UNION ALL SELECT 'rejected', count(*) FROM rejeitados
UNION ALL SELECT 'silver', count(*) FROM silver UNION ALL SELECT 'gold', count(*) FROM gold
UNION ALL SELECT motivo_rejeicao, count(*) FROM rejeitados GROUP BY motivo_rejeicao""",
    "silver_files_sorted": f"WITH {_SILVER} SELECT count(*) AS linhas, CAST(0 AS BIGINT) AS fora_de_ordem FROM silver",
    "dq_text_keys": f"""WITH {_INJECTED},
escritos AS (
  SELECT pedido_id, linha, cliente_id, product_id, data_pedido, pedido_id % 8 AS tipo,
         CASE pedido_id % 8 WHEN 1 THEN 'X' || pedido_id WHEN 2 THEN pedido_id || '.5' WHEN 3 THEN pedido_id || '.0'
              ELSE CAST(pedido_id AS VARCHAR) END AS id_texto,
         CASE pedido_id % 8 WHEN 4 THEN cliente_id || 'abc' WHEN 5 THEN cliente_id || '.0'
              ELSE CAST(cliente_id AS VARCHAR) END AS cliente_texto
  FROM limpos),
linhas AS (
  SELECT *, id_texto || ',' || cliente_texto || ',' || product_id || ',' || linha || ',' || data_pedido
         || CASE WHEN tipo = 6 THEN ',extra' ELSE '' END AS texto FROM escritos)
SELECT CASE WHEN tipo NOT IN (1, 2, 6) THEN pedido_id END AS pedido_id, CASE WHEN tipo <> 4 THEN cliente_id END AS cliente_id,
       product_id, linha AS quantidade,
       CASE WHEN tipo IN (1, 2, 6) THEN 'LINHA_ILEGIVEL' WHEN tipo = 4 THEN 'CLIENTE_INEXISTENTE' ELSE '' END
         AS motivo_rejeicao,
       CASE WHEN tipo IN (1, 2, 4, 6) THEN texto END AS linha_raw
FROM linhas""",
}

# The audits by their SQL text give what the exported reports give.
ORACLE |= {"audit_sql_q2": ORACLE["audit_reports_exported"], **{f"audit_sql_q{n}": ORACLE[f"audit_report_q{n}"] for n in range(3, 9)}}
