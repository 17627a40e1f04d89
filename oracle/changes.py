"""DuckDB oracle for changes between versions (U2, U1 by deltas), any periods,
the cube's tabs, ordered outputs, rejected rows and the derived tables' report."""

from __future__ import annotations

import re

from .adapter import with_ctes
from .etl import ETL_BODIES, ETL_CTES, clean_code, code_int, q, to_double, WS
from .queries import (AS_OF, CASES_BY_MUNICIPALITY, FILTER_END, FILTER_MUNICIPIOS, FILTER_START, FREQUENT_SYMPTOMS, ORACLE,
                      indicator_ctes, on_flat)

RESULT_DAYS = 10
TEST_COLUMNS = ["notificacao_id", "numero_sequencial", "tipo_teste", "fabricante_teste", "resultado_teste", "estado_teste", "data_coleta"]
CLINICAL_COLUMNS = ["notificacao_id", "data_inicio_sintomas", "data_encerramento", "classificacao_final", "evolucao_caso",
                    "outros_sintomas", "outras_condicoes", "total_testes_realizados"]
NOTIFICATION_COLUMNS = ["notificacao_id", "source_id", "data_notificacao", "municipio_notificacao_ibge", "estado_notificacao_ibge",
                        "excluido", "validado"]


def _image(a: str, columns: list[str]) -> str:
    return "CAST(to_json({" + ", ".join(f"'{c}': {a}.{c}" for c in columns) + "}) AS VARCHAR)"


# The older version: results are known RESULT_DAYS after the sample, a case is
# classified once a result is known.  The newer one: without the purged rows.
VERSIONS = [
    ("n_old", f"SELECT * FROM notificacao WHERE data_notificacao <= DATE '{AS_OF}'"),
    ("n_new", "SELECT * FROM notificacao WHERE excluido IS DISTINCT FROM TRUE"),
    ("t_seen", f"SELECT *, data_coleta + {RESULT_DAYS} <= DATE '{AS_OF}' AS known FROM teste_laboratorial "
               f"WHERE data_coleta <= DATE '{AS_OF}' AND notificacao_id IN (SELECT notificacao_id FROM n_old)"),
    ("t_old", "SELECT * EXCLUDE known REPLACE (CASE WHEN known THEN resultado_teste END AS resultado_teste) FROM t_seen"),
    ("t_new", "SELECT * FROM teste_laboratorial WHERE notificacao_id IN (SELECT notificacao_id FROM n_new)"),
    ("c_old", """SELECT * REPLACE (CASE WHEN k THEN classificacao_final END AS classificacao_final,
                                   CASE WHEN k THEN evolucao_caso END AS evolucao_caso) FROM (
                   SELECT *, notificacao_id IN (SELECT notificacao_id FROM t_seen WHERE known) AS k FROM dados_clinicos
                   WHERE notificacao_id IN (SELECT notificacao_id FROM n_old))"""),
    ("c_new", "SELECT * FROM dados_clinicos WHERE notificacao_id IN (SELECT notificacao_id FROM n_new)"),
]


def _ranked(a: str, b: str) -> str:
    """Rows of a that b has fewer of, numbered inside their slot."""
    order = ", ".join(f"{c} NULLS FIRST" for c in TEST_COLUMNS[2:])
    cols = ", ".join(TEST_COLUMNS)
    return (f"SELECT *, row_number() OVER (PARTITION BY notificacao_id, numero_sequencial ORDER BY {order}) AS r "
            f"FROM (SELECT {cols} FROM {a} EXCEPT ALL SELECT {cols} FROM {b})")


def _log(table: str, old: str, new: str, columns: list[str], on: str, keys: int, only_changed: bool = True) -> str:
    differs = " OR ".join(f"o.{c} IS DISTINCT FROM n.{c}" for c in columns[keys:])
    names = ", ".join(f"CASE WHEN o.{c} IS DISTINCT FROM n.{c} THEN '{c}' END" for c in columns[keys:])
    return f"""
SELECT '{table}' AS tabela_afetada,
       CASE WHEN o.notificacao_id IS NULL THEN 'I' WHEN n.notificacao_id IS NULL THEN 'D' ELSE 'U' END AS operacao,
       CASE WHEN o.notificacao_id IS NOT NULL THEN {_image('o', columns)} END AS dados_antigos,
       CASE WHEN n.notificacao_id IS NOT NULL THEN {_image('n', columns)} END AS dados_novos,
       coalesce(n.notificacao_id, o.notificacao_id) AS notificacao_id, concat_ws(',', {names}) AS colunas
FROM {old} o FULL JOIN {new} n ON {on}
WHERE o.notificacao_id IS NULL OR n.notificacao_id IS NULL OR {differs}"""


LOGS = VERSIONS + [
    ("t_gone", _ranked("t_old", "t_new")), ("t_come", _ranked("t_new", "t_old")),
    ("log_t", _log("teste_laboratorial", "t_gone", "t_come", TEST_COLUMNS,
                   "o.notificacao_id = n.notificacao_id AND o.numero_sequencial = n.numero_sequencial AND o.r = n.r", 2)),
    ("log_c", _log("dados_clinicos", "c_old", "c_new", CLINICAL_COLUMNS, "o.notificacao_id = n.notificacao_id", 1)),
    ("log_n", _log("notificacao", "n_old", "n_new", NOTIFICATION_COLUMNS, "o.notificacao_id = n.notificacao_id", 1)),
    ("purge", "\nUNION ALL\n".join(
        f"SELECT '{t}' AS tabela_afetada, 'D' AS operacao, {_image('x', cols)} AS dados_antigos, CAST(NULL AS VARCHAR) AS dados_novos, "
        f"x.notificacao_id FROM {t} x WHERE x.notificacao_id IN (SELECT notificacao_id FROM notificacao WHERE excluido)"
        for t, cols in (("notificacao", NOTIFICATION_COLUMNS), ("teste_laboratorial", TEST_COLUMNS), ("dados_clinicos", CLINICAL_COLUMNS)))),
]
_FOUR = "tabela_afetada, operacao, dados_antigos, dados_novos"
_EVERY = " UNION ALL ".join(f"SELECT tabela_afetada, operacao, notificacao_id FROM {x}" for x in ("log_t", "log_c", "log_n", "purge"))

# Every notification once for each period that holds it.
PERIODS = [
    ("periods", """SELECT m AS pi, m + d - 1 AS pf FROM (
                     SELECT DISTINCT CAST(date_trunc('month', data_notificacao) AS DATE) AS m FROM notificacao
                     WHERE data_notificacao IS NOT NULL), (VALUES (90), (365)) AS x(d)"""),
    ("n_p", "SELECT x.*, p.pi, p.pf FROM notificacao x JOIN periods p ON x.data_notificacao BETWEEN p.pi AND p.pf"),
]

FILTERED = [("flat_f", f"""SELECT * FROM flat WHERE data_notificacao BETWEEN DATE '{FILTER_START}' AND DATE '{FILTER_END}'
                            AND municipio_nome IN ({', '.join(repr(m) for m in FILTER_MUNICIPIOS)})""")]


def _filtered(name: str) -> str:
    """The statement of a dashboard tab over the filtered feature table."""
    body = ORACLE[name][len(on_flat("")):]
    return on_flat(re.sub(r"FROM flat\b", "FROM flat_f", body), FILTERED)


TABS = ["headline", "monthly_rate", "dist_sex", "dist_age_band", "dist_race", "vaccine_status_counts", "vaccine_status_x_target",
        "rate_by_vaccine_status", "top_vaccine_makers", "test_metrics", "top_test_types", "dist_test_result"]


def _in_order(sql: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) AS ordem FROM ({sql})"


def _kpi_log_report() -> str:
    rows = [
        ("chave_primaria", "municipio", "municipio_ibge", "SELECT COUNT(*) FROM (SELECT 1 FROM municipio GROUP BY municipio_ibge HAVING COUNT(*) > 1)"),
        ("nao_nulo", "municipio", "municipio_ibge", "SELECT COUNT(*) FROM municipio WHERE municipio_ibge IS NULL"),
        ("tamanho", "municipio", "nome", "SELECT COUNT(*) FROM municipio WHERE length(nome) > 150"),
        ("unico", "indicadores_regionais", "municipio_ibge,periodo_inicio,periodo_fim",
         "SELECT COUNT(*) FROM (SELECT 1 FROM ind GROUP BY municipio_ibge, periodo_inicio, periodo_fim HAVING COUNT(*) > 1)"),
        ("chave_estrangeira", "indicadores_regionais", "municipio_ibge",
         "SELECT COUNT(*) FROM ind WHERE municipio_ibge NOT IN (SELECT municipio_ibge FROM municipio)"),
        *[("faixa_decimal", "indicadores_regionais", c, f"SELECT COUNT(*) FROM ind WHERE abs({c}) >= {top}") for c, top in (
            ("taxa_positividade", 1000), ("tempo_medio_sintomas_teste", 10000), ("perc_prof_saude_infectados", 1000),
            ("media_doses_vacina", 100))],
        *[("nao_nulo", "log_alteracoes", c, f"SELECT COUNT(*) FROM log WHERE {c} IS NULL") for c in ("tabela_afetada", "operacao")],
        *[("tamanho", "log_alteracoes", c, f"SELECT COUNT(*) FROM log WHERE length({c}) > {n}") for c, n in (("tabela_afetada", 50), ("operacao", 1))],
    ]
    return "\nUNION ALL\n".join(f"SELECT '{k}' AS verificacao, '{t}' AS tabela, '{c}' AS colunas, ({x}) AS violacoes" for k, t, c, x in rows)


# The raw rows with values that their columns cannot hold, and the limits of the schema.
LENGTHS = [("source_id", 100), ("sexo", 20), ("racaCor", 50), ("profissionalSaude", 20), ("profissionalSeguranca", 20), ("cbo", 200),
           ("classificacaoFinal", 150), ("evolucaoCaso", 150), ("origem", 100), ("outroBuscaAtivaAssintomatico", 255),
           ("outroTriagemPopulacaoEspecifica", 255), ("outroLocalRealizacaoTestagem", 255), ("codigoLaboratorioPrimeiraDose", 200),
           ("codigoLaboratorioSegundaDose", 200), ("lotePrimeiraDose", 100), ("loteSegundaDose", 100)]
CODE_LENGTHS = [("codigoEstrategiaCovid", 100), ("codigoBuscaAtivaAssintomatico", 100), ("codigoTriagemPopulacaoEspecifica", 100),
                ("codigoLocalRealizacaoTestagem", 100),
                *[(f"{stem}{i}", n) for stem, n in (("codigoTipoTeste", 150), ("codigoFabricanteTeste", 255), ("codigoResultadoTeste", 150),
                                                    ("codigoEstadoTeste", 100)) for i in range(1, 5)]]
_FAULTS = """SELECT * EXCLUDE (okey) REPLACE (
  CASE okey % 97 WHEN 5 THEN '70000' WHEN 6 THEN '-40000.5' ELSE idade END AS idade,
  CASE WHEN okey % 103 = 11 THEN '3e9' ELSE totalTestesRealizados END AS totalTestesRealizados,
  CASE WHEN okey % 101 = 7 THEN repeat(racaCor, 9) ELSE racaCor END AS racaCor,
  CASE WHEN okey % 89 = 3 THEN concat_ws(', ', sintomas, repeat('x', 201)) ELSE sintomas END AS sintomas,
  CASE WHEN okey % 107 = 2 THEN repeat('9a', 51) ELSE codigoEstrategiaCovid END AS codigoEstrategiaCovid) FROM raw_plain"""
_NUMBER = "SELECT row_number() OVER (ORDER BY o.o_orderkey, w.r) AS notificacao_id,"


def _judged() -> list[tuple[str, str]]:
    ctes = []
    for name, body in ETL_CTES:
        if name == "raw":
            ctes += [("raw_plain", body.replace(_NUMBER, _NUMBER + " o.o_orderkey AS okey,")), ("raw", _FAULTS)]
        else:
            ctes.append((name, body))
    conditions = [("municipio_desconhecido", f"{code_int('municipioNotificacaoIBGE')} NOT IN (SELECT municipio_ibge FROM municipio_etl)"),
                  ("faixa:idade", f"round({to_double('idade')}) NOT BETWEEN -32768 AND 32767"),
                  ("faixa:totalTestesRealizados", f"round({to_double('totalTestesRealizados')}) NOT BETWEEN -2147483648 AND 2147483647"),
                  *[(f"tamanho:{c}", f"length({c}) > {n}") for c, n in LENGTHS],
                  *[(f"tamanho:{c}", f"length({clean_code(c)}) > {n}") for c, n in CODE_LENGTHS],
                  ("tamanho:sintomas", f"len(list_filter(string_split(sintomas, ','), lambda x: length(trim(x, {WS})) > 200)) > 0")]
    found = ", ".join(f"CASE WHEN {c} THEN '{name}' END" for name, c in conditions)
    return ctes + [("judged", f"SELECT notificacao_id, source_id, concat_ws(',', {found}) AS motivos FROM rec")]


CHANGES_ORACLE = {
    "audit_testes": with_ctes(LOGS, f"SELECT {_FOUR} FROM log_t"),
    "audit_clinicos": with_ctes(LOGS, f"SELECT {_FOUR} FROM log_c"),
    "audit_purge": with_ctes(LOGS, f"SELECT {_FOUR} FROM purge"),
    "audit_changed_columns": with_ctes(LOGS, """
        SELECT tabela_afetada, colunas, COUNT(*) AS linhas
        FROM (SELECT * FROM log_t UNION ALL SELECT * FROM log_c UNION ALL SELECT * FROM log_n) WHERE operacao = 'U' GROUP BY ALL"""),
    "audit_log_batches": with_ctes(LOGS, f"""
        SELECT tabela_afetada, operacao, notificacao_id, COUNT(*) AS linhas FROM ({_EVERY}) GROUP BY ALL"""),
    "upsert_by_delta": with_ctes(VERSIONS[:2] + indicator_ctes("", None, None, True, "n_new"), "SELECT * FROM ind"),
    "indicators_by_period": with_ctes(PERIODS + indicator_ctes("", None, None, False, "n_p", key="n.pi AS pi, n.pf AS pf"), "SELECT * FROM ind"),
    **{f"cube_{name}": _filtered(name) for name in TABS},
    "cube_top_municipalities": _filtered("top_municipalities_10"),
    "frequent_symptoms_ordered": _in_order(FREQUENT_SYMPTOMS, "frequencia_em_confirmados DESC, sintoma"),
    "facet_municipalities_ordered": _in_order(ORACLE["facet_municipalities"], "municipio_nome"),
    "vaccine_status_x_target_ordered": _in_order(ORACLE["vaccine_status_x_target"], "status_vacinal, target_confirmado"),
    "quality_report_kpi_log": with_ctes(
        LOGS + indicator_ctes("", None, None, True) + [("log", "SELECT * FROM log_n UNION ALL SELECT * FROM log_c")], _kpi_log_report()),
    "distinct_sources": with_ctes([], """
        SELECT strftime(data_notificacao, '%Y') AS ano, COUNT(DISTINCT source_id) AS fontes, TRUE AS dentro_do_limite
        FROM notificacao GROUP BY 1"""),
    "notification_defaults": with_ctes([], "SELECT * REPLACE (FALSE AS excluido, FALSE AS validado) FROM notificacao"),
    "cases_by_municipality_view": CASES_BY_MUNICIPALITY,
    "load_rejects": with_ctes(_judged(), "SELECT * FROM judged WHERE motivos <> ''"),
    "load_balance": with_ctes(_judged(), """
        SELECT motivo, COUNT(*) AS linhas FROM (
          SELECT unnest(CASE WHEN motivos = '' THEN ['aceita'] ELSE string_split(motivos, ',') END) AS motivo FROM judged) GROUP BY motivo"""),
    "symptom_ids_two_loads": q(ETL_BODIES["etl_sintoma"]),
}
