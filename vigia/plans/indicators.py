"""Regional indicators (Q2) and their upsert into the KPI table.

The stored procedure loops over municipalities and issues four aggregate
queries per municipality.  Here the loop disappears: the four measures are
computed for every municipality (and, optionally, every calendar month) in
one plan: tests and doses are reduced per notification, merged with the
notification and its satellites on notificacao_id, and one hash aggregation
by (municipality[, period]) produces all counts.  Spark runs it partially on
each input partition before the shuffle, so a municipality with a third of
all notifications is not a hot reduce task.

Scoping of the soft-delete flag follows the procedure exactly: only the
positivity counts require ``excluido = FALSE``; onset-to-test time, health
worker share and mean doses count every notification of the period.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import days_between, in_period
from ..functions.numeric import exact_ratio
from ..functions.predicates import is_confirmed, is_sim_ci, on_or_after, positive_by_code
from ..operators.joins import keyed

KEYS = ["municipio_ibge", "periodo_inicio", "periodo_fim"]
COUNTS = ["n_testes", "n_positivos", "soma_dias", "n_dias", "n_confirmados", "n_saude", "n_doses", "n_notificacoes"]
MEASURES = ["taxa_positividade", "tempo_medio_sintomas_teste",
            "perc_prof_saude_infectados", "media_doses_vacina"]


def _in_months(df: DataFrame, inicio, fim) -> DataFrame:
    """Rows in the months of the period, where the table is partitioned by the
    month of the notification (Spark prunes folders); else all rows."""
    if "mes_particao" not in df.columns:
        return df
    month = lambda d: F.date_format(F.lit(d).cast("date"), "yyyy-MM")
    if inicio is not None:
        df = df.filter(F.col("mes_particao") >= month(inicio))
    if fim is not None:
        df = df.filter(F.col("mes_particao") <= month(fim))
    return df


def _period_notifications(t, inicio, fim, monthly: bool, daily: bool = False) -> DataFrame:
    n = t["notificacao"].filter(F.col("municipio_notificacao_ibge").isNotNull())
    if inicio is not None or fim is not None:
        n = _in_months(n.filter(in_period("data_notificacao", inicio, fim)), inicio, fim)
    if daily:
        ini = end = F.col("data_notificacao")
    elif monthly:
        ini = F.trunc("data_notificacao", "month")
        end = F.last_day("data_notificacao")
    else:
        ini = F.lit(inicio).cast("date")
        end = F.lit(fim).cast("date")
    return n.select("notificacao_id", "excluido",
                    F.col("municipio_notificacao_ibge").alias("municipio_ibge"),
                    ini.alias("periodo_inicio"), end.alias("periodo_fim"))


def indicator_counts(t: dict[str, DataFrame], inicio=None, fim=None, monthly: bool = False,
                     daily: bool = False) -> DataFrame:
    """Integer numerators/denominators of the four indicators per group: the
    municipality and the period, or each month, or each day of notification.

    Plan shape: the period's notifications take their clinical and demographic
    rows (each table is read once), then their tests, which are reduced to one
    row per notification where they lie: every input is hash-partitioned on
    notificacao_id once.  Doses are cut to the period's notifications before
    they are counted.  On tables partitioned by month a period prunes the
    folders of all five.  The result feeds a single aggregation by
    (municipality[, month]): rows that reach the final shuffle are partially
    aggregated per task, so a hot municipality costs one partial row per task."""
    n = _period_notifications(t, inicio, fim, monthly, daily)
    clin = _in_months(t["dados_clinicos"], inicio, fim).select(
        "notificacao_id", "data_inicio_sintomas",
        is_confirmed("classificacao_final").alias("_conf"), F.lit(True).alias("_has_clin"))
    demo = _in_months(t["dados_demograficos"], inicio, fim).select(
        "notificacao_id", is_sim_ci("is_profissional_saude").alias("_saude"),
        F.lit(True).alias("_has_demo"))
    tests = _in_months(t["teste_laboratorial"], inicio, fim).select(
        "notificacao_id", "resultado_teste", "data_coleta", F.lit(True).alias("_has_test"))
    doses = _in_months(t["vacina_aplicada"], inicio, fim).select("notificacao_id")
    if inicio is not None or fim is not None:
        doses = doses.join(keyed(n.select("notificacao_id")), "notificacao_id", "left_semi")

    zero = F.lit(0).cast("bigint")
    base = n.join(keyed(clin), "notificacao_id", "left").join(keyed(demo), "notificacao_id", "left")
    timed = F.col("_has_clin") & on_or_after("data_coleta", "data_inicio_sintomas")
    per_notification = (base.join(keyed(tests), "notificacao_id", "left").groupBy(*base.columns).agg(
        F.count("_has_test").alias("_t"),
        F.count_if(positive_by_code("resultado_teste")).alias("_p"),
        F.coalesce(F.sum(F.when(timed, days_between("data_coleta", "data_inicio_sintomas"))
                         .cast("bigint")), zero).alias("_dias"),
        F.count_if(timed).alias("_nd")))
    per_dose = doses.groupBy("notificacao_id").agg(F.count(F.lit(1)).alias("_doses"))

    j = per_notification.join(keyed(per_dose), "notificacao_id", "left")
    valid = F.col("excluido") == F.lit(False)
    confirmed = F.col("_has_clin") & F.col("_has_demo") & F.col("_conf")
    nz = lambda c: F.coalesce(F.col(c), zero)
    return j.groupBy(*KEYS).agg(
        F.sum(F.when(valid, nz("_t")).otherwise(zero)).alias("n_testes"),
        F.sum(F.when(valid, nz("_p")).otherwise(zero)).alias("n_positivos"),
        F.sum(nz("_dias")).alias("soma_dias"),
        F.sum(nz("_nd")).alias("n_dias"),
        F.count_if(confirmed).alias("n_confirmados"),
        F.count_if(confirmed & F.col("_saude")).alias("n_saude"),
        F.sum(nz("_doses")).alias("n_doses"),
        F.count(F.lit(1)).alias("n_notificacoes"))


def regional_indicators(t: dict[str, DataFrame], inicio=None, fim=None, monthly: bool = False,
                        with_timestamp: bool = True) -> DataFrame:
    """Q2: one row per municipality with notifications in the period.

    * taxa_positividade: positive / total tests of non-excluded notifications x100, DECIMAL(5,2)
    * tempo_medio_sintomas_teste: mean days onset -> sample (sample on/after onset), DECIMAL(5,1)
    * perc_prof_saude_infectados: health workers among confirmed x100, DECIMAL(5,2)
    * media_doses_vacina: mean doses per notification (zero-dose included), DECIMAL(4,2)

    Zero denominators give 0.  ``monthly=True`` computes every calendar month
    at once (periodo_inicio/fim = month bounds) instead of one fixed period.
    Rounding is half-up on the exact quotient, as a DECIMAL assignment does.
    """
    return rates(indicator_counts(t, inicio, fim, monthly), with_timestamp)


def rates(counts: DataFrame, with_timestamp: bool = False) -> DataFrame:
    """The four indicators from their counts."""
    zero2, zero1 = F.lit(0).cast("decimal(5,2)"), F.lit(0).cast("decimal(5,1)")
    out = counts.select(
        *KEYS,
        F.coalesce(exact_ratio("n_positivos", "n_testes", 2, 5, times=100), zero2)
         .alias("taxa_positividade"),
        F.coalesce(exact_ratio("soma_dias", "n_dias", 1, 5), zero1)
         .alias("tempo_medio_sintomas_teste"),
        F.coalesce(exact_ratio("n_saude", "n_confirmados", 2, 5, times=100), zero2)
         .alias("perc_prof_saude_infectados"),
        F.coalesce(exact_ratio("n_doses", "n_notificacoes", 2, 4), F.lit(0).cast("decimal(4,2)"))
         .alias("media_doses_vacina"))
    if with_timestamp:
        out = out.withColumn("data_processamento", F.current_timestamp())
    return out


def upsert(target: DataFrame, new: DataFrame, keys=KEYS) -> DataFrame:
    """Rows of ``new`` replace rows of ``target`` with the same key; other
    target rows are kept (a municipality absent from a recompute survives).

    Keys present in ``new`` are removed from ``target`` with a left anti join
    (the KPI table has one row per municipality and period: small, AQE
    broadcasts the key side), then ``new`` is appended."""
    kept = target.join(new.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def upsert_table(spark, table_path: str | None, new: DataFrame, keys=KEYS,
                 out_path: str | None = None) -> DataFrame:
    """U1 on storage: write current+new as a new version and return it.

    The current version (``table_path``) is only read; the merged table goes
    to ``out_path`` (a new version folder of the KPI table) or, by default,
    to a fresh folder under the shared checkpoint folder.  A failed run
    leaves the current version intact; readers switch to the new folder."""
    from ..session import scratch_path
    current = spark.read.parquet(table_path) if table_path else None
    merged = new if current is None else upsert(current, new, keys)
    path = out_path or scratch_path(spark, "indicadores_regionais")
    merged.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def snapshot_as_of(t: dict[str, DataFrame], as_of) -> dict[str, DataFrame]:
    """The tables as they stood on ``as_of``: notifications made, samples
    collected and doses applied up to that day (later rows had not arrived).
    Used to replay a late-data recompute followed by an upsert."""
    d = F.lit(as_of).cast("date")
    out = dict(t)
    out["notificacao"] = t["notificacao"].filter(F.col("data_notificacao") <= d)
    out["teste_laboratorial"] = t["teste_laboratorial"].filter(F.col("data_coleta") <= d)
    out["vacina_aplicada"] = t["vacina_aplicada"].filter(F.col("data_aplicacao") <= d)
    return out


def tables_as_of(t: dict[str, DataFrame], as_of, result_days: int = 10) -> dict[str, DataFrame]:
    """``snapshot_as_of`` with what comes late: a test's result is known
    ``result_days`` days after the sample, a case's classification and outcome
    once one of its results is.  Children exist with their notification."""
    d = F.lit(as_of).cast("date")
    out = snapshot_as_of(t, as_of)
    ids = keyed(out["notificacao"].select("notificacao_id"))
    known = F.date_add("data_coleta", result_days) <= d
    tests = out["teste_laboratorial"].join(ids, "notificacao_id", "left_semi")
    out["vacina_aplicada"] = out["vacina_aplicada"].join(ids, "notificacao_id", "left_semi")
    out["teste_laboratorial"] = tests.withColumn("resultado_teste", F.when(known, F.col("resultado_teste")))
    closed = tests.filter(known).select("notificacao_id").distinct().withColumn("_known", F.lit(True))
    clinical = t["dados_clinicos"].join(ids, "notificacao_id", "left_semi").join(keyed(closed), "notificacao_id", "left")
    out["dados_clinicos"] = clinical.select(*[
        F.when(F.col("_known"), F.col(c)).alias(c) if c in ("classificacao_final", "evolucao_caso") else F.col(c)
        for c in t["dados_clinicos"].columns])
    out["dados_demograficos"] = t["dados_demograficos"].join(ids, "notificacao_id", "left_semi")
    return out


def calcular_indicadores(spark, t: dict[str, DataFrame], inicio, fim, table_path: str | None = None,
                         out_path: str | None = None) -> DataFrame:
    """The KPI procedure as one call: compute every municipality's indicators
    for [inicio, fim] and upsert them into the KPI table version at
    ``table_path`` (None = start a new table); returns the new version."""
    new = regional_indicators(t, inicio, fim)
    return upsert_table(spark, table_path, new, KEYS, out_path)
