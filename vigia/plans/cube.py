"""The dashboard's filters answered from a cube (P18 with Q11-Q26).

``build_cube`` reduces the feature table once to additive measures by (day,
municipality, dimension, value); every tab then is a small aggregate over the
cube for any date range and list of municipalities, without reading the
feature table again.  The cube grows with days x municipalities x values of a
dimension, not with notifications.

Dimensions of the cube: the column of a distribution (sex, age band, race,
occupation, vaccine status, makers, test result), an item of a ';'-separated
list (test types and makers), and ``*``, the notifications themselves.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cleaning import regex_literal, strip
from ..functions.dates import ano_mes, mes_ano
from ..functions.labels import RESULT_POSITIVE, VAX_COMPLETE, VAX_NONE, VAX_PARTIAL
from ..functions.numeric import pct, round_half_even
from .dashboard import LIST_SEP, apply_filters

ALL = "*"
PAIRS = "array<struct<dimensao:string,valor:string>>"
DIMENSIONS = ["sexo", "faixa_etaria", "raca_cor", "categoria_ocupacao", "status_vacinal", "fabricantes_vacina",
              "resultado_teste_agregado"]
LISTS = ["tipos_testes_lista", "fabricantes_teste_lista"]
MEASURES = ["notificacoes", "alvos", "confirmados", "testes"]


def build_cube(flat: DataFrame) -> DataFrame:
    """data_notificacao, municipio_nome, dimensao, valor and the measures:
    notifications (of a list: items), known targets, confirmed, tests."""
    pair = lambda name, value: F.struct(F.lit(name).alias("dimensao"), value.alias("valor"))
    single = F.array(pair(ALL, F.lit(None).cast("string")), *[pair(c, F.col(c).cast("string")) for c in DIMENSIONS])
    def items(c: str):
        listed = F.transform(F.split(F.col(c), regex_literal(LIST_SEP)), lambda x: pair(c, strip(x)))
        return F.coalesce(listed, F.array().cast(PAIRS))

    every = F.concat(single, *[items(c) for c in LISTS])
    rows = flat.select("data_notificacao", "municipio_nome", "target_confirmado", "testes_realizados", F.explode(every).alias("_d"))
    return rows.groupBy("data_notificacao", "municipio_nome", F.col("_d.dimensao").alias("dimensao"), F.col("_d.valor").alias("valor")).agg(
        F.count(F.lit(1)).alias("notificacoes"), F.count("target_confirmado").alias("alvos"),
        F.coalesce(F.sum("target_confirmado"), F.lit(0).cast("bigint")).alias("confirmados"),
        F.coalesce(F.sum("testes_realizados"), F.lit(0).cast("bigint")).alias("testes"))


def write_cube(flat: DataFrame, path: str) -> None:
    """The cube in a folder for each dimension: a tab reads its own only."""
    build_cube(flat).repartition("dimensao", F.trunc("data_notificacao", "month")).write.mode("overwrite").partitionBy("dimensao").parquet(path)


def _slice(cube: DataFrame, dimension: str, start, end, municipios) -> DataFrame:
    return apply_filters(cube.filter(F.col("dimensao") == dimension), start, end, municipios)


def headline(cube: DataFrame, start=None, end=None, municipios=None) -> DataFrame:
    """Q11 under a filter."""
    zero = F.lit(0).cast("bigint")
    agg = _slice(cube, ALL, start, end, municipios).agg(
        F.coalesce(F.sum("notificacoes"), zero).alias("total_notificacoes"), F.coalesce(F.sum("confirmados"), zero).alias("casos_confirmados"))
    return agg.select("*", pct("casos_confirmados", "total_notificacoes").alias("taxa_confirmacao"))


def monthly_rate(cube: DataFrame, start=None, end=None, municipios=None) -> DataFrame:
    """Q12 under a filter."""
    days = _slice(cube, ALL, start, end, municipios).filter(F.col("data_notificacao").isNotNull())
    g = days.groupBy(ano_mes("data_notificacao").alias("ano_mes"), mes_ano("data_notificacao").alias("mes_ano")).agg(
        F.sum("notificacoes").alias("total"), F.sum("confirmados").alias("confirmados"))
    return g.select("*", pct("confirmados", "total").alias("taxa_confirmacao"))


def _top(counts: DataFrame, c: str, k: int | None, out: str) -> DataFrame:
    return counts if k is None else counts.orderBy(F.col(out).desc(), F.col(c).asc()).limit(k)


def top_municipalities(cube: DataFrame, k: int = 10, start=None, end=None, municipios=None) -> DataFrame:
    """Q13 / Q26 under a filter."""
    days = _slice(cube, ALL, start, end, municipios).filter(F.col("municipio_nome").isNotNull())
    return _top(days.groupBy("municipio_nome").agg(F.sum("notificacoes").alias("casos")), "municipio_nome", k, "casos")


def distribution(cube: DataFrame, c: str, k: int | None = None, start=None, end=None, municipios=None,
                 name: str | None = None) -> DataFrame:
    """Q14-Q17, Q20, Q23-Q25 under a filter: totals by value (items of a list),
    optionally the top k."""
    days = _slice(cube, c, start, end, municipios).filter(F.col("valor").isNotNull())
    counts = days.groupBy(F.col("valor").alias(name or c)).agg(F.sum("notificacoes").alias("total"))
    return _top(counts, name or c, k, "total")


def vaccine_status_counts(cube: DataFrame, start=None, end=None, municipios=None) -> DataFrame:
    """Q18 under a filter."""
    days = _slice(cube, "status_vacinal", start, end, municipios)
    total = lambda v: F.coalesce(F.sum(F.when(F.col("valor") == v, F.col("notificacoes"))), F.lit(0).cast("bigint"))
    return days.agg(total(VAX_NONE).alias("nao_vacinados"), total(VAX_COMPLETE).alias("esquema_completo"),
                    total(VAX_PARTIAL).alias("parcial"))


def vaccine_status_x_target(cube: DataFrame, start=None, end=None, municipios=None) -> DataFrame:
    """Q19 under a filter."""
    days = _slice(cube, "status_vacinal", start, end, municipios).filter(F.col("valor").isNotNull())
    g = days.groupBy("valor").agg(F.sum("confirmados").alias("c"), (F.sum("alvos") - F.sum("confirmados")).alias("n"))
    return g.select(F.col("valor").alias("status_vacinal"), F.inline(F.array(
        F.struct(F.lit(1).alias("target_confirmado"), F.col("c").alias("total")),
        F.struct(F.lit(0).alias("target_confirmado"), F.col("n").alias("total"))))).filter("total > 0")


def rate_by_vaccine_status(cube: DataFrame, start=None, end=None, municipios=None) -> DataFrame:
    """Q21 under a filter."""
    days = _slice(cube, "status_vacinal", start, end, municipios).filter(F.col("valor").isNotNull())
    g = days.groupBy(F.col("valor").alias("status_vacinal")).agg(F.sum("alvos").alias("total"), F.sum("confirmados").alias("confirmados"))
    rate = F.when(F.col("total") > 0, round_half_even(F.col("confirmados").cast("double") / F.col("total").cast("double") * F.lit(100.0), 1))
    return g.select("*", rate.alias("taxa"))


def test_metrics(cube: DataFrame, start=None, end=None, municipios=None) -> DataFrame:
    """Q22 under a filter."""
    days = _slice(cube, "resultado_teste_agregado", start, end, municipios)
    zero = F.lit(0).cast("bigint")
    agg = days.agg(F.coalesce(F.sum("testes"), zero).alias("total_testes"),
                   F.coalesce(F.sum(F.when(F.col("valor") == RESULT_POSITIVE, F.col("notificacoes"))), zero).alias("positivos"))
    return agg.select("*", pct("positivos", "total_testes").alias("taxa_positividade"))
