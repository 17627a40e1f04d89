"""DuckDB oracle for the constraint checks (Q31) and the cascade purge (Q32).

The constraints are written out here from the model's schema, apart from the
engine's own lists: a constraint that the engine misses shows as a difference."""

from __future__ import annotations

from .adapter import with_ctes

TABLES = ["estado", "municipio", "notificacao", "dados_demograficos", "dados_clinicos",
          "dados_epidemiologicos", "dados_gestao_estrategia", "sintoma", "notificacao_sintoma",
          "teste_laboratorial", "vacina_aplicada"]

# The declared schema.  Of each table its primary key (pk), unique
# column (uq), lengths (column length), small integers (column small) and
# references (column > table.column).
SCHEMA = """
estado: pk estado_ibge; nome 100; sigla 2
municipio: pk municipio_ibge; nome 150; estado_ibge > estado.estado_ibge
notificacao: pk notificacao_id; source_id 100; municipio_notificacao_ibge > municipio.municipio_ibge; estado_notificacao_ibge > estado.estado_ibge
dados_demograficos: pk notificacao_id; notificacao_id > notificacao.notificacao_id; idade small; sexo 20; raca_cor 50; is_profissional_saude 20; is_profissional_seguranca 20; cbo 200
dados_clinicos: pk notificacao_id; notificacao_id > notificacao.notificacao_id; classificacao_final 150; evolucao_caso 150
dados_epidemiologicos: pk notificacao_id; notificacao_id > notificacao.notificacao_id; origem_dados 100; municipio_residencia_ibge > municipio.municipio_ibge; estado_residencia_ibge > estado.estado_ibge
dados_gestao_estrategia: pk notificacao_id; notificacao_id > notificacao.notificacao_id; codigo_estrategia_covid 100; codigo_busca_ativa_assintomatico 100; outro_busca_ativa_assintomatico 255; codigo_triagem_populacao_especifica 100; outro_triagem_populacao_especifica 255; codigo_local_realizacao_testagem 100; outro_local_realizacao_testagem 255
sintoma: pk sintoma_id; uq nome; nome 200
notificacao_sintoma: pk notificacao_id,sintoma_id; notificacao_id > notificacao.notificacao_id; sintoma_id > sintoma.sintoma_id
teste_laboratorial: notificacao_id > notificacao.notificacao_id; numero_sequencial small; tipo_teste 150; fabricante_teste 255; resultado_teste 150; estado_teste 100
vacina_aplicada: notificacao_id > notificacao.notificacao_id; dose_numero small; laboratorio 200; lote 100
"""
CHILDREN = ["dados_demograficos", "dados_clinicos", "dados_epidemiologicos", "dados_gestao_estrategia",
            "notificacao_sintoma", "teste_laboratorial", "vacina_aplicada"]


def declared():
    """(table, kind, columns or column, value) of every declared constraint."""
    for line in SCHEMA.strip().splitlines():
        table, rules = line.split(": ")
        for rule in rules.split("; "):
            words = rule.split(" ")
            if words[0] in ("pk", "uq"):
                yield table, words[0], words[1].split(","), None
            elif words[1] == ">":
                yield table, "fk", words[0], words[2].split(".")
            else:
                yield table, "small" if words[1] == "small" else "length", words[0], words[1]


EXTRA = [
    ("dados_epidemiologicos", """
        SELECT o.o_orderkey AS notificacao_id, 'notificacao-online' AS origem_dados,
               CAST(c.c_nationkey AS INTEGER) AS municipio_residencia_ibge,
               CAST(na.n_regionkey AS INTEGER) AS estado_residencia_ibge
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation na ON c.c_nationkey = na.n_nationkey"""),
    ("dados_gestao_estrategia", """
        SELECT o_orderkey AS notificacao_id, substr(o_orderpriority, 1, 1) AS codigo_estrategia_covid,
               CAST(NULL AS VARCHAR) AS codigo_busca_ativa_assintomatico,
               CAST(NULL AS VARCHAR) AS outro_busca_ativa_assintomatico,
               CAST(NULL AS VARCHAR) AS codigo_triagem_populacao_especifica,
               CAST(NULL AS VARCHAR) AS outro_triagem_populacao_especifica,
               CAST(NULL AS VARCHAR) AS codigo_local_realizacao_testagem,
               CAST(NULL AS VARCHAR) AS outro_local_realizacao_testagem
        FROM orders"""),
]


def _report() -> str:
    rows = []

    def check(name: str, table: str, columns: str, count: str) -> None:
        rows.append(f"SELECT '{name}' AS verificacao, '{table}' AS tabela, '{columns}' AS colunas, ({count}) AS violacoes")

    for table, kind, column, value in declared():
        if kind in ("pk", "uq"):
            keys = ", ".join(column)
            some = " AND ".join(f"{c} IS NOT NULL" for c in column) if kind == "uq" else "TRUE"
            check("chave_primaria" if kind == "pk" else "unico", table, ",".join(column),
                  f"SELECT COUNT(*) FROM (SELECT {keys} FROM {table} WHERE {some} GROUP BY {keys} HAVING COUNT(*) > 1)")
            for c in column if kind == "pk" else []:
                check("nao_nulo", table, c, f"SELECT COUNT(*) FROM {table} WHERE {c} IS NULL")
        elif kind == "fk":
            check("chave_estrangeira", table, column,
                  f"SELECT COUNT(*) FROM {table} ANTI JOIN (SELECT {value[1]} AS x FROM {value[0]}) ON {column} = x "
                  f"WHERE {column} IS NOT NULL")
        elif kind == "length":
            check("tamanho", table, column, f"SELECT COUNT(*) FROM {table} WHERE length({column}) > {value}")
        else:
            check("faixa_smallint", table, column, f"SELECT COUNT(*) FROM {table} WHERE {column} NOT BETWEEN -32768 AND 32767")
    return "\nUNION ALL\n".join(rows)


def _purge() -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabela, notificacao_id, COUNT(*) AS linhas FROM {t} "
        f"WHERE notificacao_id NOT IN (SELECT notificacao_id FROM purge_ids) GROUP BY ALL" for t in ["notificacao", *CHILDREN])


QUALITY_ORACLE = {
    "quality_report": with_ctes(EXTRA, _report()),
    "dq_test_slot_duplicates": with_ctes([], """
        SELECT notificacao_id, numero_sequencial, COUNT(*) AS n FROM teste_laboratorial
        GROUP BY notificacao_id, numero_sequencial HAVING COUNT(*) > 1"""),
    "purge_excluded": with_ctes(EXTRA + [("purge_ids", "SELECT notificacao_id FROM notificacao "
                                                       "WHERE excluido = TRUE")], _purge()),
}
