"""Analytic views (Q3-Q5) as DataFrame functions.

Join shape: the notification fact and its 1:1 satellites share the key
notificacao_id, so Spark hash-partitions them on it once and merges them
without further exchanges; state / municipality / symptom-name dimensions
are small and joined by broadcast when the planner measures them under the
threshold (sort-merge otherwise).  Group keys that can be hot (a capital city)
are aggregated partially before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import UNDER_REVIEW, UNDER_TREATMENT, vax_status_view
from ..functions.predicates import is_confirmed, is_death, is_discarded, not_excluded
from ..operators.aggregates import count_where
from ..operators.joins import keyed


def cases_by_municipality(t: dict[str, DataFrame]) -> DataFrame:
    """Q3 vw_casos_por_municipio: (municipality name, UF, date) -> counts.

    Municipalities sharing name and UF are merged, as the view groups by name."""
    n = (t["notificacao"].filter(not_excluded("excluido"))
         .select("notificacao_id", "data_notificacao", "municipio_notificacao_ibge",
                 "estado_notificacao_ibge"))
    c = t["dados_clinicos"].select("notificacao_id", "classificacao_final", "evolucao_caso")
    m = t["municipio"].select(F.col("municipio_ibge"), F.col("nome").alias("municipio"))
    e = t["estado"].select(F.col("estado_ibge"), F.col("sigla").alias("uf"))
    j = (n.join(keyed(c), "notificacao_id")
          .join(m, F.col("municipio_notificacao_ibge") == F.col("municipio_ibge"))
          .join(e, F.col("estado_notificacao_ibge") == F.col("estado_ibge")))
    return j.groupBy("municipio", "uf", "data_notificacao").agg(
        F.count("notificacao_id").alias("total_notificacoes"),
        count_where(is_confirmed("classificacao_final")).alias("casos_confirmados"),
        count_where(is_discarded("classificacao_final")).alias("casos_descartados"),
        count_where(is_death("evolucao_caso")).alias("obitos"))


def doses_per_notification(t: dict[str, DataFrame]) -> DataFrame:
    """Doses counted per notification before any join (prevents fan-out)."""
    return (t["vacina_aplicada"].groupBy("notificacao_id")
            .agg(F.count(F.lit(1)).alias("qtd_doses")))


def vaccination_by_outcome(t: dict[str, DataFrame]) -> DataFrame:
    """Q4 vw_vacinacao_por_resultado: (vaccine status, classification, outcome) -> patients."""
    n = t["notificacao"].filter(not_excluded("excluido")).select("notificacao_id")
    c = t["dados_clinicos"].select("notificacao_id", "classificacao_final", "evolucao_caso")
    d = doses_per_notification(t)
    j = n.join(keyed(c), "notificacao_id").join(keyed(d), "notificacao_id", "left")
    return (j.select(vax_status_view("qtd_doses").alias("status_vacinal"),
                     F.coalesce("classificacao_final", F.lit(UNDER_REVIEW)).alias("classificacao"),
                     F.coalesce("evolucao_caso", F.lit(UNDER_TREATMENT)).alias("evolucao"))
             .groupBy("status_vacinal", "classificacao", "evolucao")
             .agg(F.count(F.lit(1)).alias("total_pacientes")))


def frequent_symptoms(t: dict[str, DataFrame], ordered: bool = False) -> DataFrame:
    """Q5 vw_sintomas_frequentes: symptom -> total and total among confirmed.

    The view's ORDER BY only matters for display; pass ordered=True to get it
    (with the name as tie-break)."""
    ns = t["notificacao_sintoma"].select("notificacao_id", "sintoma_id")
    s = t["sintoma"].select("sintoma_id", F.col("nome").alias("sintoma"))
    c = t["dados_clinicos"].select("notificacao_id", "classificacao_final")
    n = t["notificacao"].filter(not_excluded("excluido")).select("notificacao_id")
    j = ns.join(keyed(c), "notificacao_id").join(keyed(n), "notificacao_id").join(s, "sintoma_id")
    out = j.groupBy("sintoma").agg(
        F.count(F.lit(1)).alias("frequencia_total"),
        count_where(is_confirmed("classificacao_final")).alias("frequencia_em_confirmados"))
    if ordered:
        out = out.orderBy(F.col("frequencia_em_confirmados").desc(), F.col("sintoma").asc())
    return out


# --- fixed values: the analytic view names SQL users query --------------------
VIEW_NAMES = {
    "vw_casos_por_municipio": cases_by_municipality,
    "vw_vacinacao_por_resultado": vaccination_by_outcome,
    "vw_sintomas_frequentes": frequent_symptoms,
}
# ------------------------------------------------------------------------------


def register_analytic_views(t: dict[str, DataFrame]) -> list[str]:
    """S10 for the views: expose Q3-Q5 under their view names, so SQL users
    keep writing ``SELECT ... FROM vw_casos_por_municipio``.  Each is a lazy
    plan over the current tables, evaluated when queried."""
    for name, fn in VIEW_NAMES.items():
        fn(t).createOrReplaceTempView(name)
    return list(VIEW_NAMES)
