"""DuckDB oracle for the raw-file loader (Q1): the raw wide rows re-derived
from the provided tables, then normalised with the loader's rules in SQL."""

from __future__ import annotations

from .adapter import with_ctes

UF_CODES = [11, 12, 13, 14, 15, 16, 17, 21, 22, 23, 24, 25, 26, 27, 28, 29, 31, 32, 33, 35,
            41, 42, 43, 50, 51, 52, 53]
WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _slot_aggs() -> str:
    out = []
    for i in range(1, 5):
        w = f"l_linenumber = {i}"
        out += [
            f"max(CASE WHEN {w} THEN CAST(l_suppkey % 5 AS VARCHAR) || '.0' END) AS codigoTipoTeste{i}",
            f"max(CASE WHEN {w} THEN CAST(l_suppkey % 3 AS VARCHAR) END) AS codigoFabricanteTeste{i}",
            f"max(CASE WHEN {w} THEN CASE l_returnflag WHEN 'R' THEN '1' WHEN 'A' THEN '2' WHEN 'N' THEN '3' END END)"
            f" AS codigoResultadoTeste{i}",
            f"max(CASE WHEN {w} THEN l_linestatus END) AS codigoEstadoTeste{i}",
            f"max(CASE WHEN {w} THEN strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') END) AS dataColetaTeste{i}",
        ]
    for line, d in ((5, "PrimeiraDose"), (6, "SegundaDose")):
        w = f"l_linenumber = {line}"
        out += [
            f"max(CASE WHEN {w} THEN strftime(CAST(l_shipdate AS DATE), '%d/%m/%Y') END) AS data{d}",
            f"max(CASE WHEN {w} THEN 'LAB' || CAST(l_partkey % 4 AS VARCHAR) END) AS codigoLaboratorio{d}",
            f"max(CASE WHEN {w} THEN CAST(l_partkey AS VARCHAR) END) AS lote{d}",
        ]
    return ",\n".join(out)


RAW_CTES = [
    ("raw_w", f"""SELECT l_orderkey AS k, r, COUNT(*) FILTER (WHERE l_linenumber <= 4) AS n_tests,
                         {_slot_aggs()}
                  FROM (SELECT *, row_number() OVER (
                          PARTITION BY l_orderkey, l_linenumber
                          ORDER BY l_partkey, l_suppkey, l_shipdate, l_returnflag, l_linestatus) AS r
                        FROM lineitem WHERE l_linenumber <= 6)
                  GROUP BY l_orderkey, r"""),
    ("raw_s", """SELECT notificacao_id AS k, string_agg(nome, ', ' ORDER BY nome) AS s
                 FROM sintoma_nomes GROUP BY notificacao_id"""),
    ("raw", """
SELECT row_number() OVER (ORDER BY o.o_orderkey, w.r) AS notificacao_id,
  CASE o.o_orderkey % 3 WHEN 0 THEN strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d')
       WHEN 1 THEN strftime(CAST(o.o_orderdate AS DATE), '%d/%m/%Y')
       ELSE strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') || 'T08:30:00.000Z' END AS dataNotificacao,
  strftime(CAST(o.o_orderdate AS DATE) - CAST(o.o_orderkey % 15 AS INTEGER), '%d/%m/%Y') AS dataInicioSintomas,
  CAST(NULL AS VARCHAR) AS dataEncerramento,
  na.n_name AS municipio,
  CASE WHEN o.o_orderkey % 10 = 3 THEN NULL ELSE CAST(code AS VARCHAR) END AS municipioIBGE,
  CASE WHEN o.o_orderkey % 50 = 13 THEN 'Desconhecido' ELSE na.n_name END AS municipioNotificacao,
  CASE WHEN o.o_orderkey % 50 = 13 THEN '0'
       WHEN o.o_orderkey % 10 = 7 THEN CAST(code AS VARCHAR) || '.0'
       WHEN o.o_orderkey % 20 = 11 THEN NULL ELSE CAST(code AS VARCHAR) END AS municipioNotificacaoIBGE,
  CASE WHEN o.o_orderpriority = '5-LOW' THEN 'Sim' WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN NULL
       ELSE 'Não' END AS excluido,
  CASE WHEN o.o_orderpriority = '1-URGENT' THEN '1' ELSE '0' END AS validado,
  CAST(o.o_custkey AS VARCHAR) AS source_id,
  CASE WHEN o.o_orderkey % 9 = 4 THEN CAST(CAST(o.o_orderkey % 130 AS INTEGER) - 5 AS VARCHAR) || '.5'
       ELSE CAST(CAST(o.o_orderkey % 130 AS INTEGER) - 5 AS VARCHAR) END AS idade,
  CASE o.o_custkey % 3 WHEN 0 THEN 'Masculino' WHEN 1 THEN 'Feminino' ELSE 'Ignorado' END AS sexo,
  c.c_mktsegment AS racaCor,
  CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'Sim' WHEN 'BUILDING' THEN 'SIM' ELSE 'Não' END AS profissionalSaude,
  'Não' AS profissionalSeguranca, CAST(NULL AS VARCHAR) AS cbo,
  CASE o.o_custkey % 3 WHEN 0 THEN '1.0' WHEN 1 THEN '2' END AS codigoContemComunidadeTradicional,
  CASE WHEN o.o_orderstatus = 'F' THEN 'Confirmado Laboratorial' WHEN o.o_orderstatus = 'O' THEN 'Descartado'
       WHEN o.o_orderstatus = 'P' AND o.o_orderkey % 2 = 0 THEN 'CONFIRMADO CLÍNICO' END AS classificacaoFinal,
  CASE o.o_orderkey % 7 WHEN 0 THEN 'ÓBITO' WHEN 1 THEN 'Cura' END AS evolucaoCaso,
  CASE WHEN w.n_tests > 0 THEN CAST(w.n_tests AS VARCHAR) END AS totalTestesRealizados,
  CAST(NULL AS VARCHAR) AS outrosSintomas, CAST(NULL AS VARCHAR) AS outrasCondicoes,
  substr(o.o_orderpriority, 1, 1) || '.0' AS codigoEstrategiaCovid,
  CASE WHEN o.o_orderkey % 2 = 0 THEN '2' END AS codigoBuscaAtivaAssintomatico,
  CAST(NULL AS VARCHAR) AS outroBuscaAtivaAssintomatico,
  CAST(NULL AS VARCHAR) AS codigoTriagemPopulacaoEspecifica,
  CAST(NULL AS VARCHAR) AS outroTriagemPopulacaoEspecifica,
  CASE WHEN o.o_orderkey % 4 = 1 THEN '1e1' END AS codigoLocalRealizacaoTestagem,
  CAST(NULL AS VARCHAR) AS outroLocalRealizacaoTestagem,
  'notificacao-online' AS origem,
  CASE WHEN o.o_orderkey % 8 = 5 THEN s.s || ',' ELSE s.s END AS sintomas,
  w.* EXCLUDE (k, r, n_tests)
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN (SELECT *, (CASE n_regionkey WHEN 0 THEN 15 WHEN 1 THEN 13 WHEN 2 THEN 29 WHEN 3 THEN 35
                 WHEN 4 THEN 43 END) * 100000 + n_nationkey + 1 AS code FROM nation) na
  ON c.c_nationkey = na.n_nationkey
LEFT JOIN raw_w w ON w.k = o.o_orderkey
LEFT JOIN raw_s s ON s.k = o.o_orderkey"""),
]


def parse_date(x: str) -> str:
    return (f"COALESCE(CAST(TRY_STRPTIME(trim({x}), '%Y-%m-%d') AS DATE), "
            f"CAST(TRY_STRPTIME(trim({x}), '%d/%m/%Y') AS DATE), "
            f"CASE WHEN regexp_matches({x}, '^\\s*\\d{{4}}-\\d{{2}}-\\d{{2}}[T ]') "
            f"THEN TRY_CAST(substr(trim({x}), 1, 10) AS DATE) END)")


def clean_code(x: str) -> str:
    num = "'^\\s*[+-]?(\\d+\\.?\\d*|\\.\\d+)([eE][+-]?\\d+)?\\s*$'"
    as_long = f"TRY_CAST(trunc(TRY_CAST({x} AS DOUBLE)) AS BIGINT)"
    return (f"CASE WHEN {x} IS NULL OR {x} = '' THEN NULL "
            f"WHEN regexp_matches({x}, {num}) AND {as_long} IS NOT NULL THEN CAST({as_long} AS VARCHAR) "
            f"ELSE {x} END")


def clean_boolean(x: str) -> str:
    u = f"upper(trim({x}, {WS}))"
    return (f"CASE WHEN {u} IN ('TRUE','VERDADEIRO','SIM','S','1') THEN TRUE "
            f"WHEN {u} IN ('FALSE','FALSO','NAO','NÃO','N','0') THEN FALSE END")


def to_double(x: str) -> str:
    return f"CASE WHEN NOT isnan(TRY_CAST({x} AS DOUBLE)) THEN TRY_CAST({x} AS DOUBLE) END"


def code_int(x: str) -> str:
    return f"COALESCE(TRY_CAST(trunc({x}) AS INTEGER), 0)"


def uf(x: str) -> str:
    return f"CASE WHEN {x} > 99999 THEN CAST(substr(CAST({x} AS VARCHAR), 1, 2) AS INTEGER) END"


DATES = ["dataNotificacao", "dataInicioSintomas", "dataEncerramento", "dataColetaTeste1",
         "dataColetaTeste2", "dataColetaTeste3", "dataColetaTeste4", "dataPrimeiraDose",
         "dataSegundaDose"]

ETL_CTES = RAW_CTES + [
    ("typed", "SELECT * REPLACE (" + ", ".join(f"{parse_date(c)} AS {c}" for c in DATES) + ") FROM raw"),
    ("res_map", f"""SELECT nome, {to_double('code')} AS codigo FROM (
                      SELECT municipio AS nome, municipioIBGE AS code,
                             row_number() OVER (PARTITION BY municipio ORDER BY notificacao_id) AS rn
                      FROM typed WHERE municipio IS NOT NULL AND municipioIBGE IS NOT NULL) WHERE rn = 1"""),
    ("not_map", f"""SELECT nome, {to_double('code')} AS codigo FROM (
                      SELECT municipioNotificacao AS nome, municipioNotificacaoIBGE AS code,
                             row_number() OVER (PARTITION BY municipioNotificacao ORDER BY notificacao_id) AS rn
                      FROM typed WHERE municipioNotificacao IS NOT NULL
                                   AND municipioNotificacaoIBGE IS NOT NULL) WHERE rn = 1"""),
    ("name_map", """SELECT COALESCE(n.nome, r.nome) AS nome,
                           CASE WHEN n.nome IS NOT NULL THEN n.codigo ELSE r.codigo END AS codigo
                    FROM res_map r FULL JOIN not_map n ON r.nome = n.nome"""),
    ("rec", f"""SELECT t.* REPLACE (
          CASE WHEN {to_double('t.municipioIBGE')} > 99999 THEN {to_double('t.municipioIBGE')}
               WHEN t.municipio IS NOT NULL AND m1.nome IS NOT NULL THEN m1.codigo
               ELSE {to_double('t.municipioIBGE')} END AS municipioIBGE,
          CASE WHEN {to_double('t.municipioNotificacaoIBGE')} > 99999 THEN {to_double('t.municipioNotificacaoIBGE')}
               WHEN t.municipioNotificacao IS NOT NULL AND m2.nome IS NOT NULL THEN m2.codigo
               ELSE {to_double('t.municipioNotificacaoIBGE')} END AS municipioNotificacaoIBGE)
        FROM typed t LEFT JOIN name_map m1 ON t.municipio = m1.nome
        LEFT JOIN name_map m2 ON t.municipioNotificacao = m2.nome"""),
    ("mun_all", """SELECT municipioIBGE AS id, municipio AS nome, 0 AS src, notificacao_id FROM rec
                   UNION ALL
                   SELECT municipioNotificacaoIBGE, municipioNotificacao, 1, notificacao_id FROM rec"""),
    ("municipio_etl", f"""SELECT * FROM (
          SELECT {code_int('id')} AS municipio_ibge, nome, {uf(code_int('id'))} AS estado_ibge
          FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY src, notificacao_id) AS rn FROM mun_all)
          WHERE rn = 1)
        WHERE municipio_ibge > 99999 AND estado_ibge IN ({', '.join(map(str, UF_CODES))})"""),
    ("acc", f"""SELECT * FROM (SELECT *, {code_int('municipioNotificacaoIBGE')} AS mun_not FROM rec)
                WHERE mun_not IN (SELECT municipio_ibge FROM municipio_etl)"""),
    ("items", f"""SELECT notificacao_id, pos, trim(item, {WS}) AS nome FROM (
                    SELECT notificacao_id, generate_subscripts(arr, 1) AS pos, unnest(arr) AS item
                    FROM (SELECT notificacao_id, string_split(sintomas, ',') AS arr FROM acc
                          WHERE sintomas IS NOT NULL))"""),
    ("sintoma_etl", """SELECT CAST(row_number() OVER (ORDER BY f) AS INTEGER) AS sintoma_id, nome
                       FROM (SELECT nome, min(notificacao_id * 100000 + pos) AS f
                             FROM items GROUP BY nome)"""),
]


def _tests() -> str:
    parts = []
    for i in range(1, 5):
        parts.append(f"""SELECT notificacao_id, CAST({i} AS SMALLINT) AS numero_sequencial,
            {clean_code(f'codigoTipoTeste{i}')} AS tipo_teste,
            {clean_code(f'codigoFabricanteTeste{i}')} AS fabricante_teste,
            {clean_code(f'codigoResultadoTeste{i}')} AS resultado_teste,
            {clean_code(f'codigoEstadoTeste{i}')} AS estado_teste,
            dataColetaTeste{i} AS data_coleta
          FROM acc WHERE codigoTipoTeste{i} IS NOT NULL""")
    return "\nUNION ALL\n".join(parts)


def _doses() -> str:
    parts = []
    for i, d in ((1, "PrimeiraDose"), (2, "SegundaDose")):
        parts.append(f"""SELECT notificacao_id, CAST({i} AS SMALLINT) AS dose_numero,
            data{d} AS data_aplicacao, codigoLaboratorio{d} AS laboratorio, lote{d} AS lote
          FROM acc WHERE data{d} IS NOT NULL""")
    return "\nUNION ALL\n".join(parts)


def q(body: str) -> str:
    return with_ctes(ETL_CTES, body)


ETL_BODIES = {
    "etl_name_map": "SELECT nome, codigo FROM name_map",
    "etl_municipio": "SELECT * FROM municipio_etl",
    "etl_notificacao": f"""
        SELECT notificacao_id, source_id, dataNotificacao AS data_notificacao,
               mun_not AS municipio_notificacao_ibge, {uf('mun_not')} AS estado_notificacao_ibge,
               {clean_boolean('excluido')} AS excluido, {clean_boolean('validado')} AS validado
        FROM acc""",
    "etl_demograficos": f"""
        SELECT notificacao_id, CAST(round({to_double('idade')}) AS SMALLINT) AS idade,
               sexo, racaCor AS raca_cor, profissionalSaude AS is_profissional_saude,
               profissionalSeguranca AS is_profissional_seguranca, cbo,
               CASE {clean_code('codigoContemComunidadeTradicional')} WHEN '2' THEN TRUE WHEN '1' THEN FALSE END
                   AS pertence_comunidade_tradicional
        FROM acc""",
    "etl_clinicos": f"""
        SELECT notificacao_id, dataInicioSintomas AS data_inicio_sintomas,
               dataEncerramento AS data_encerramento, classificacaoFinal AS classificacao_final,
               evolucaoCaso AS evolucao_caso, outrosSintomas AS outros_sintomas,
               outrasCondicoes AS outras_condicoes,
               CAST(round({to_double('totalTestesRealizados')}) AS INTEGER) AS total_testes_realizados
        FROM acc""",
    "etl_gestao": f"""
        SELECT notificacao_id,
               {clean_code('codigoEstrategiaCovid')} AS codigo_estrategia_covid,
               {clean_code('codigoBuscaAtivaAssintomatico')} AS codigo_busca_ativa_assintomatico,
               outroBuscaAtivaAssintomatico AS outro_busca_ativa_assintomatico,
               {clean_code('codigoTriagemPopulacaoEspecifica')} AS codigo_triagem_populacao_especifica,
               outroTriagemPopulacaoEspecifica AS outro_triagem_populacao_especifica,
               {clean_code('codigoLocalRealizacaoTestagem')} AS codigo_local_realizacao_testagem,
               outroLocalRealizacaoTestagem AS outro_local_realizacao_testagem
        FROM acc""",
    "etl_epidemiologicos": f"""
        SELECT notificacao_id, origem AS origem_dados, k.municipio_ibge AS municipio_residencia_ibge,
               {uf('k.municipio_ibge')} AS estado_residencia_ibge
        FROM acc LEFT JOIN (SELECT DISTINCT municipio_ibge FROM municipio_etl) k
          ON {code_int('acc.municipioIBGE')} = k.municipio_ibge""",
    "etl_sintoma": "SELECT sintoma_id, nome FROM sintoma_etl",
    "etl_notificacao_sintoma": """SELECT DISTINCT i.notificacao_id, s.sintoma_id
                                    FROM items i JOIN sintoma_etl s ON i.nome = s.nome""",
    "etl_testes": _tests(),
    "etl_vacinas": _doses(),
}

ETL_ORACLE = {k: q(v) for k, v in ETL_BODIES.items()}

# The same load from CSV files whose free text is the documents' whole text.
_TEXT_CTES = [(name, body.replace(
    "CAST(NULL AS VARCHAR) AS outrosSintomas",
    "(SELECT '\"' || x.text || '\", \\' FROM documents x WHERE x.doc_id = o.o_orderkey) AS outrosSintomas"))
    for name, body in ETL_CTES]
ETL_ORACLE.update({name.replace("etl_", "etl_csv_", 1): with_ctes(_TEXT_CTES, body) for name, body in ETL_BODIES.items()
                   if name != "etl_name_map"})


def _estado_values() -> str:
    from vigia.functions.geo import UFS
    rows = ", ".join(f"({c}, '{n}', '{sg}')" for c, n, sg in UFS)
    return f"SELECT * FROM (VALUES {rows}) AS u(estado_ibge, nome, sigla)"


# The loader's curated tables as CTEs, for analytics over loaded data.
LOADED_CTES = ETL_CTES + [
    ("estado_etl", _estado_values()),
    ("notificacao_etl", ETL_BODIES["etl_notificacao"]),
    ("clinicos_etl", ETL_BODIES["etl_clinicos"]),
    ("demograficos_etl", ETL_BODIES["etl_demograficos"]),
    ("testes_etl", ETL_BODIES["etl_testes"]),
    ("vacinas_etl", ETL_BODIES["etl_vacinas"]),
]
