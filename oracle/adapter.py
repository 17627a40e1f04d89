"""The test-data adapter written as SQL CTEs (DuckDB dialect).

Independent of the Spark code path: the oracle re-derives the curated tables
from the provided tables with plain SQL, so a mistake in one side shows up as
a mismatch.  Views available to the oracle: region nation customer supplier
part orders lineitem events (and the others, unused here).
"""

from __future__ import annotations

ADAPTER_CTES: dict[str, str] = {
    "estado": """
        SELECT CAST(r_regionkey AS INTEGER) AS estado_ibge, r_name AS nome,
               substr(r_name, 1, 2) AS sigla
        FROM region""",
    "municipio": """
        SELECT CAST(n_nationkey AS INTEGER) AS municipio_ibge, n_name AS nome,
               CAST(n_regionkey AS INTEGER) AS estado_ibge
        FROM nation""",
    "notificacao": """
        SELECT o.o_orderkey AS notificacao_id,
               CAST(o.o_custkey AS VARCHAR) AS source_id,
               CAST(o.o_orderdate AS DATE) AS data_notificacao,
               CAST(c.c_nationkey AS INTEGER) AS municipio_notificacao_ibge,
               CAST(na.n_regionkey AS INTEGER) AS estado_notificacao_ibge,
               CASE WHEN o.o_orderpriority = '5-LOW' THEN TRUE
                    WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                    ELSE FALSE END AS excluido,
               o.o_orderpriority = '1-URGENT' AS validado
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation na ON c.c_nationkey = na.n_nationkey""",
    "dados_demograficos": """
        SELECT o.o_orderkey AS notificacao_id,
               CAST(CAST(o.o_orderkey % 130 AS INTEGER) - 5 AS SMALLINT) AS idade,
               CASE o.o_custkey % 3 WHEN 0 THEN 'Masculino' WHEN 1 THEN 'Feminino'
                    ELSE 'Ignorado' END AS sexo,
               c.c_mktsegment AS raca_cor,
               CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Sim' WHEN 'BUILDING' THEN 'SIM'
                    ELSE 'Não' END AS is_profissional_saude,
               'Não' AS is_profissional_seguranca,
               CAST(NULL AS VARCHAR) AS cbo,
               CAST(NULL AS BOOLEAN) AS pertence_comunidade_tradicional
        FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation na ON c.c_nationkey = na.n_nationkey""",
    "dados_clinicos": """
        SELECT o_orderkey AS notificacao_id,
               CAST(o_orderdate AS DATE) - CAST(o_orderkey % 15 AS INTEGER) AS data_inicio_sintomas,
               CAST(NULL AS DATE) AS data_encerramento,
               CASE WHEN o_orderstatus = 'F' THEN 'Confirmado Laboratorial'
                    WHEN o_orderstatus = 'O' THEN 'Descartado'
                    WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN 'CONFIRMADO CLÍNICO'
               END AS classificacao_final,
               CASE o_orderkey % 7 WHEN 0 THEN 'ÓBITO' WHEN 1 THEN 'Cura' END AS evolucao_caso,
               CAST(NULL AS VARCHAR) AS outros_sintomas,
               CAST(NULL AS VARCHAR) AS outras_condicoes,
               CAST(NULL AS INTEGER) AS total_testes_realizados
        FROM orders""",
    "teste_laboratorial": """
        SELECT l_orderkey AS notificacao_id,
               CAST(l_linenumber AS SMALLINT) AS numero_sequencial,
               CAST(l_suppkey % 5 AS VARCHAR) AS tipo_teste,
               CAST(l_suppkey % 3 AS VARCHAR) AS fabricante_teste,
               CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' WHEN 'N' THEN '3' END
                   AS resultado_teste,
               l_linestatus AS estado_teste,
               CAST(l_shipdate AS DATE) AS data_coleta
        FROM lineitem WHERE l_linenumber <= 4""",
    "vacina_aplicada": """
        SELECT l_orderkey AS notificacao_id,
               CAST(l_linenumber - 4 AS SMALLINT) AS dose_numero,
               CAST(l_shipdate AS DATE) AS data_aplicacao,
               'LAB' || CAST(l_partkey % 4 AS VARCHAR) AS laboratorio,
               CAST(l_partkey AS VARCHAR) AS lote
        FROM lineitem WHERE l_linenumber IN (5, 6)""",
    "sintoma_nomes": """
        SELECT DISTINCT notificacao_id,
               CASE w WHEN 'hot' THEN 'Febre' WHEN 'cold' THEN 'Tosse' WHEN 'old' THEN 'Dispneia'
                      WHEN 'new' THEN 'falta de ar' WHEN 'blue' THEN 'Dor de Garganta'
                      ELSE w END AS nome
        FROM (SELECT l.l_orderkey AS notificacao_id, unnest(string_split(p.p_name, ' ')) AS w
              FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
              WHERE l.l_linenumber = 7)""",
    "sintoma": """
        SELECT CAST(dense_rank() OVER (ORDER BY nome) AS INTEGER) AS sintoma_id, nome
        FROM (SELECT DISTINCT nome FROM sintoma_nomes)""",
    "notificacao_sintoma": """
        SELECT sn.notificacao_id, s.sintoma_id
        FROM sintoma_nomes sn JOIN sintoma s ON sn.nome = s.nome""",
}

# Order matters: a CTE may only use earlier ones.
ADAPTER_ORDER = ["estado", "municipio", "notificacao", "dados_demograficos", "dados_clinicos",
                 "teste_laboratorial", "vacina_aplicada", "sintoma_nomes", "sintoma",
                 "notificacao_sintoma"]


def with_ctes(extra: list[tuple[str, str]], body: str) -> str:
    """WITH <adapter CTEs>, <extra CTEs> <body>.  DuckDB drops unused CTEs."""
    parts = [f"{n} AS ({ADAPTER_CTES[n]}\n)" for n in ADAPTER_ORDER]
    parts += [f"{n} AS ({sql}\n)" for n, sql in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body
