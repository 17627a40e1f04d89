"""Dashboard aggregates over the flat feature table.

Every tab of the dashboard is one small DataFrame computed from the feature
table with distributed aggregates; nothing is pulled to the driver to count.
The interactive filters compose as predicates in front of any of them.
Top-k lists order by count descending with the value as tie-break, so the
result is deterministic (pandas keeps first-seen order on ties).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import regex_literal, strip
from ..functions.dates import ano_mes, mes_ano
from ..functions.labels import RESULT_POSITIVE, VAX_COMPLETE, VAX_NONE, VAX_PARTIAL
from ..functions.numeric import pct, round_half_even
from ..functions.predicates import in_list
from ..functions.risk import percent, risk_band, risk_score
from ..operators.aggregates import corr_matrix, order_counts, top_k, value_counts

# --- fixed values: list separator the dashboard splits on, correlation inputs --
LIST_SEP = ";"
CORR_COLUMNS = {"febre": "flg_febre", "tosse": "flg_tosse", "dispneia": "flg_dispneia",
                "confirmado": "target_confirmado"}
# -------------------------------------------------------------------------------


def apply_filters(flat: DataFrame, start=None, end=None, municipios=None) -> DataFrame:
    """Inclusive date range (only when both ends are given) and a
    municipality list (an empty list means all)."""
    df = flat
    if start is not None and end is not None:
        d = F.col("data_notificacao")
        df = df.filter((d >= F.lit(start).cast("date")) & (d <= F.lit(end).cast("date")))
    if municipios:
        df = df.filter(in_list("municipio_nome", municipios))
    return df


def headline(df: DataFrame) -> DataFrame:
    """Q11: total notifications, confirmed (sum of target), confirmation rate %."""
    agg = df.agg(F.count(F.lit(1)).alias("total_notificacoes"),
                 F.coalesce(F.sum("target_confirmado"), F.lit(0).cast("bigint")).alias("casos_confirmados"))
    return agg.select("*", pct("casos_confirmados", "total_notificacoes").alias("taxa_confirmacao"))


def monthly_rate(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Q12: per month, total, confirmed (target = 1) and rate %, in one pass.
    ``ordered`` sorts chronologically (by the yyyy-MM label, D-7)."""
    g = (df.filter(F.col("data_notificacao").isNotNull())
         .groupBy(ano_mes("data_notificacao").alias("ano_mes"),
                  mes_ano("data_notificacao").alias("mes_ano"))
         .agg(F.count(F.lit(1)).alias("total"),
              F.count_if(F.col("target_confirmado") == 1).alias("confirmados")))
    out = g.select("ano_mes", "mes_ano", "total", "confirmados",
                   pct("confirmados", "total").alias("taxa_confirmacao"))
    return out.orderBy("ano_mes") if ordered else out


def top_municipalities(df: DataFrame, k: int = 10) -> DataFrame:
    """Q13 / Q26: municipalities with most notifications."""
    return top_k(df, "municipio_nome", k, "casos")


def distribution(df: DataFrame, c: str, k: int | None = None, ordered: bool = False) -> DataFrame:
    """Q14-Q17, Q20, Q25: value counts of one column (optionally top k);
    ``ordered`` gives the display order (count descending, value ascending)."""
    if k:
        return top_k(df, c, k, "total")
    out = value_counts(df, c, "total")
    return order_counts(out, c, "total") if ordered else out


def vaccine_status_counts(df: DataFrame) -> DataFrame:
    """Q18: the three vaccine-status counters, one job."""
    s = F.col("status_vacinal")
    return df.agg(F.count_if(s == VAX_NONE).alias("nao_vacinados"),
                  F.count_if(s == VAX_COMPLETE).alias("esquema_completo"),
                  F.count_if(s == VAX_PARTIAL).alias("parcial"))


def vaccine_status_x_target(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Q19: counts by (vaccine status, target); unknown targets are left out.
    ``ordered`` sorts by the group keys (O5)."""
    out = (df.filter(F.col("status_vacinal").isNotNull() & F.col("target_confirmado").isNotNull())
           .groupBy("status_vacinal", "target_confirmado").agg(F.count(F.lit(1)).alias("total")))
    return out.orderBy("status_vacinal", "target_confirmado") if ordered else out


def rate_by_vaccine_status(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Q21: per status, known targets, confirmed, rate % rounded to 1 decimal
    (ties to even).  The denominator is the number of known targets."""
    g = (df.filter(F.col("status_vacinal").isNotNull()).groupBy("status_vacinal")
         .agg(F.count("target_confirmado").alias("total"),
              F.coalesce(F.sum("target_confirmado"), F.lit(0).cast("bigint")).alias("confirmados")))
    rate = F.when(F.col("total") > 0,
                  round_half_even(F.col("confirmados").cast("double") / F.col("total").cast("double")
                                  * F.lit(100.0), 1))
    out = g.select("status_vacinal", "total", "confirmados", rate.alias("taxa"))
    return out.orderBy("status_vacinal") if ordered else out


def test_metrics(df: DataFrame) -> DataFrame:
    """Q22: tests done, notifications with a positive aggregate, and their ratio %."""
    agg = df.agg(F.coalesce(F.sum("testes_realizados"), F.lit(0).cast("bigint")).alias("total_testes"),
                 F.count_if(F.col("resultado_teste_agregado") == RESULT_POSITIVE).alias("positivos"))
    return agg.select("*", pct("positivos", "total_testes").alias("taxa_positividade"))


def list_item_counts(df: DataFrame, c: str, out: str, k: int = 10, sep: str = LIST_SEP) -> DataFrame:
    """Q23/Q24 (R4): split list cells on ``sep``, strip items, top k by count."""
    items = (df.filter(F.col(c).isNotNull())
             .select(F.explode(F.split(F.col(c), regex_literal(sep))).alias("_item"))
             .select(strip("_item").alias(out)))
    return top_k(items, out, k, "total")


def symptom_correlation(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Q27: Pearson matrix of the three symptom flags and the target (long form)."""
    return corr_matrix(df, CORR_COLUMNS, digits)


def score_risk(df: DataFrame) -> DataFrame:
    """Q28: risk probability, percent and band for every notification."""
    p = risk_score()
    return df.select("notificacao_id", p.alias("probabilidade")).select(
        "notificacao_id", "probabilidade", percent("probabilidade").alias("probabilidade_percent"),
        risk_band("probabilidade").alias("faixa_risco"))


def facet_municipalities(df: DataFrame, ordered: bool = False) -> DataFrame:
    """Q29: the municipality choices (distinct, non-null); ``ordered`` sorts
    them as the picker shows them (code-point order, O2)."""
    out = df.select("municipio_nome").filter(F.col("municipio_nome").isNotNull()).distinct()
    return out.orderBy("municipio_nome") if ordered else out


def facet_date_range(df: DataFrame) -> DataFrame:
    """Q29: the date picker bounds (one job)."""
    return df.agg(F.min("data_notificacao").alias("data_minima"),
                  F.max("data_notificacao").alias("data_maxima"))
