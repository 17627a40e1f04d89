"""The flat feature table for dashboards and ML (Q6-Q10).

Each 1:N child (symptoms, doses, tests) is aggregated to one row per
notification *before* it meets the fact table, so no join tree ever holds the
tests x doses x symptoms product.  The three aggregates come out hash
partitioned by notificacao_id, the key of every later join, so the left joins
to the fact add no further exchange of the children.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import iso_week, month_number
from ..functions.labels import (NO_SYMPTOMS, VAX_NONE, age_band, occupation, target, test_result,
                                valid_age, vax_status_flat)
from ..functions.predicates import not_excluded, positive_predicate
from ..operators.aggregates import any_flag, concat_distinct, concat_ordered, shares

# --- fixed values: symptom flag patterns and list separators -------------------
FEVER_PATTERNS = ["%Febre%"]
COUGH_PATTERNS = ["%Tosse%"]
THROAT_PATTERNS = ["%Garganta%"]
DYSPNEA_PATTERNS = ["%Dispneia%", "%falta de ar%"]
SYMPTOM_SEP = ", "
VACCINE_SEP = " / "
TEST_SEP = ", "
# -------------------------------------------------------------------------------

FLAT_COLUMNS = [
    "notificacao_id", "data_notificacao", "semana_epidemiologica", "mes_notificacao",
    "codigo_ibge", "municipio_nome", "uf_sigla", "idade", "sexo", "raca_cor", "ocupacao_cbo",
    "is_profissional_saude", "data_inicio_sintomas", "classificacao_final", "evolucao_caso",
    "sintomas_texto", "flg_febre", "flg_tosse", "flg_dispneia", "doses_vacina",
    "fabricantes_vacina", "status_vacinal", "testes_realizados", "tipos_testes_lista",
    "fabricantes_teste_lista", "resultado_teste_agregado", "faixa_etaria",
    "categoria_ocupacao", "target_confirmado",
]


def _ilike_any(c, patterns):
    out = None
    for p in patterns:
        m = F.col(c).ilike(p)
        out = m if out is None else (out | m)
    return out


def symptom_agg(t: dict[str, DataFrame]) -> DataFrame:
    """Q6: per notification, sorted symptom list and four any-match flags."""
    j = (t["notificacao_sintoma"].select("notificacao_id", "sintoma_id")
         .join(t["sintoma"].select("sintoma_id", "nome"), "sintoma_id"))
    return j.groupBy("notificacao_id").agg(
        concat_ordered("nome", SYMPTOM_SEP).alias("lista_sintomas"),
        any_flag(_ilike_any("nome", FEVER_PATTERNS)).alias("tem_febre"),
        any_flag(_ilike_any("nome", COUGH_PATTERNS)).alias("tem_tosse"),
        any_flag(_ilike_any("nome", THROAT_PATTERNS)).alias("tem_dor_garganta"),
        any_flag(_ilike_any("nome", DYSPNEA_PATTERNS)).alias("tem_dispneia"))


def vaccine_agg(t: dict[str, DataFrame]) -> DataFrame:
    """Q7: per notification, dose count, last dose date, distinct makers."""
    return t["vacina_aplicada"].groupBy("notificacao_id").agg(
        F.count(F.lit(1)).alias("total_doses"),
        F.max("data_aplicacao").alias("data_ultima_dose"),
        concat_distinct("laboratorio", VACCINE_SEP).alias("fabricantes_vacina"))


def test_agg(t: dict[str, DataFrame], positive: str = "text") -> DataFrame:
    """Q8: per notification, test count, distinct types/makers, positive flag,
    last sample date.  ``positive='text'`` is the extract's own rule (matches
    'Positivo'/'Detectável'), ``'code'`` the KPI rule (code '1')."""
    pos = positive_predicate(positive)
    return t["teste_laboratorial"].groupBy("notificacao_id").agg(
        F.count(F.lit(1)).alias("qtd_testes_realizados"),
        concat_distinct("tipo_teste", TEST_SEP).alias("tipos_testes_lista"),
        concat_distinct("fabricante_teste", TEST_SEP).alias("fabricantes_teste_lista"),
        any_flag(pos("resultado_teste")).alias("houve_teste_positivo"),
        F.max("data_coleta").alias("data_coleta_teste"))


def flat_dataset(t: dict[str, DataFrame], positive: str = "text") -> DataFrame:
    """Q9: one row per non-excluded notification, 29 columns (26 extracted +
    age band, occupation category and ML target)."""
    n = t["notificacao"].filter(not_excluded("excluido"))
    mun = t["municipio"].select(F.col("municipio_ibge"), F.col("nome").alias("municipio_nome"))
    est = t["estado"].select(F.col("estado_ibge"), F.col("sigla").alias("uf_sigla"))
    d = t["dados_demograficos"].select("notificacao_id", "idade", "sexo", "raca_cor", "cbo",
                                       "is_profissional_saude")
    c = t["dados_clinicos"].select("notificacao_id", "data_inicio_sintomas",
                                   "classificacao_final", "evolucao_caso")
    s = symptom_agg(t).drop("tem_dor_garganta")
    v = vaccine_agg(t).drop("data_ultima_dose")
    te = test_agg(t, positive).drop("data_coleta_teste")
    j = (n.join(d, "notificacao_id").join(c, "notificacao_id")
          .join(s, "notificacao_id", "left").join(v, "notificacao_id", "left")
          .join(te, "notificacao_id", "left")
          .join(mun, F.col("municipio_notificacao_ibge") == F.col("municipio_ibge"))
          .join(est, F.col("estado_notificacao_ibge") == F.col("estado_ibge")))
    idade = valid_age(F.col("idade"))
    return j.select(
        "notificacao_id", "data_notificacao",
        iso_week("data_notificacao").alias("semana_epidemiologica"),
        month_number("data_notificacao").alias("mes_notificacao"),
        F.col("municipio_ibge").alias("codigo_ibge"), "municipio_nome", "uf_sigla",
        idade.alias("idade"), "sexo", "raca_cor", F.col("cbo").alias("ocupacao_cbo"),
        "is_profissional_saude", "data_inicio_sintomas", "classificacao_final", "evolucao_caso",
        F.coalesce("lista_sintomas", F.lit(NO_SYMPTOMS)).alias("sintomas_texto"),
        F.coalesce("tem_febre", F.lit(0)).alias("flg_febre"),
        F.coalesce("tem_tosse", F.lit(0)).alias("flg_tosse"),
        F.coalesce("tem_dispneia", F.lit(0)).alias("flg_dispneia"),
        F.coalesce("total_doses", F.lit(0).cast("bigint")).alias("doses_vacina"),
        "fabricantes_vacina",
        vax_status_flat("total_doses").alias("status_vacinal"),
        F.coalesce("qtd_testes_realizados", F.lit(0).cast("bigint")).alias("testes_realizados"),
        "tipos_testes_lista", "fabricantes_teste_lista",
        test_result("houve_teste_positivo", "qtd_testes_realizados").alias("resultado_teste_agregado"),
        age_band(idade).alias("faixa_etaria"),
        occupation("is_profissional_saude").alias("categoria_ocupacao"),
        target("classificacao_final").alias("target_confirmado"))


def dataset_audit(flat: DataFrame) -> DataFrame:
    """Q10: the extract's requirement checks in one aggregation (one row)."""
    return flat.agg(
        F.count(F.lit(1)).alias("total_linhas"),
        F.lit(len(flat.columns)).alias("colunas"),
        F.count_if(F.col("status_vacinal") != F.lit(VAX_NONE)).alias("vacinados"),
        F.count_if(F.col("testes_realizados") > 0).alias("testados"),
        F.count_distinct("municipio_nome").alias("municipios"))


def target_balance(flat: DataFrame, digits: int | None = None) -> DataFrame:
    """Q10 (part 6): share of each target value among known targets."""
    return shares(flat, "target_confirmado", "proporcao", digits)
