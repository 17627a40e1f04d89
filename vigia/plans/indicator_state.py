"""Regional indicators kept by deltas, and for any set of periods.

The eight counts behind the four indicators are sums over notifications, so
they can be kept for every (municipality, day) and rolled up to any period:

* ``daily_counts``: the state, once from all tables;
* ``delta``: after inserts, updates and deletes, the signed change of the state
  from the changed notifications alone (their rows before, taken off, and
  after, put on), named by a change log;
* ``apply_delta``: the state after it; a day without notifications goes;
* ``rollup``: the indicators of every month or of one period from the state;
* ``period_indicators``: the indicators of a table of periods, overlapping or
  not, from prefix sums over the days: each municipality's days are read once,
  whatever the number of periods.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.audit import audit_tables, changed_keys
from ..session import reliable_checkpoint
from . import indicators as ind

STATE_KEYS = ["municipio_ibge", "dia"]
#: The tables that the indicators are computed from.
KPI_TABLES = ["notificacao", "dados_clinicos", "dados_demograficos", "teste_laboratorial", "vacina_aplicada"]


def daily_counts(t: dict[str, DataFrame]) -> DataFrame:
    """The state: the indicators' counts for each municipality and day."""
    counts = ind.indicator_counts(t, daily=True)
    return counts.select("municipio_ibge", F.col("periodo_inicio").alias("dia"), *ind.COUNTS)


def change_log(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """The change log of every table that the indicators read."""
    return audit_tables(old, new, KPI_TABLES, with_meta=False)


def _cut(t: dict[str, DataFrame], ids: DataFrame) -> dict[str, DataFrame]:
    """The rows of the changed notifications; where tables are partitioned by
    the notification's month, from the folders of these months only."""
    out = dict(t)
    if "mes_particao" in t["notificacao"].columns:
        months = [r[0] for r in t["notificacao"].join(ids, "notificacao_id", "left_semi").select("mes_particao").distinct().collect()]
        out = {n: df.filter(F.col("mes_particao").isin(months)) if n in KPI_TABLES and "mes_particao" in df.columns else df
               for n, df in out.items()}
    return {n: df.join(ids, "notificacao_id", "left_semi") if n in KPI_TABLES else df for n, df in out.items()}


def delta(old: dict[str, DataFrame], new: dict[str, DataFrame], log: DataFrame) -> DataFrame:
    """The signed change of the state between two versions of the tables, from
    the notifications that the log names."""
    ids = reliable_checkpoint(changed_keys(log), "changed-notifications")
    after = daily_counts(_cut(new, ids))
    before = daily_counts(_cut(old, ids)).select(*STATE_KEYS, *[(-F.col(c)).alias(c) for c in ind.COUNTS])
    return _summed(after.unionByName(before))


def _summed(rows: DataFrame) -> DataFrame:
    """Counts added up by municipality and day, without days that have nothing."""
    some = reduce(lambda a, b: a | b, [F.col(c) != 0 for c in ind.COUNTS])
    return rows.groupBy(*STATE_KEYS).agg(*[F.sum(c).alias(c) for c in ind.COUNTS]).filter(some)


def apply_delta(state: DataFrame, change: DataFrame) -> DataFrame:
    """The state after a change."""
    return _summed(state.select(*STATE_KEYS, *ind.COUNTS).unionByName(change.select(*STATE_KEYS, *ind.COUNTS)))


def rollup(state: DataFrame, inicio=None, fim=None, monthly: bool = False) -> DataFrame:
    """The indicators of one period, or of every month, from the state."""
    days = state.filter(ind.in_period("dia", inicio, fim))
    if monthly:
        first, last = F.trunc("dia", "month"), F.last_day("dia")
    else:
        first, last = F.lit(inicio).cast("date"), F.lit(fim).cast("date")
    counts = (days.withColumns({"periodo_inicio": first, "periodo_fim": last}).groupBy(*ind.KEYS)
              .agg(*[F.sum(c).alias(c) for c in ind.COUNTS]).filter("n_notificacoes > 0"))
    return ind.rates(counts)


def period_indicators(state: DataFrame, periods: DataFrame, max_periods: int = 2_000) -> DataFrame:
    """The indicators of every period (periodo_inicio, periodo_fim) for every
    municipality with notifications in it; a null end leaves that side open.

    A period's counts are the difference of two prefix sums: up to its last day
    and up to the day before its first.  Each of these ends is looked up among
    the municipality's days (the last one not after it) by one ordered pass over
    days and ends together.  The table of periods is sent to every task; more
    than ``max_periods`` are refused, to be taken in several calls."""
    periods = periods.select(F.col("periodo_inicio").cast("date"), F.col("periodo_fim").cast("date")).distinct()
    wanted = periods.limit(max_periods + 1).collect()  # bounded by the parameter
    if len(wanted) > max_periods:
        raise ValueError(f"more than {max_periods} periods: call with parts of the table")
    spark = state.sparkSession
    if not wanted:
        return ind.rates(state.filter(F.lit(False)).select(
            "municipio_ibge", F.col("dia").alias("periodo_inicio"), F.col("dia").alias("periodo_fim"), *ind.COUNTS))
    periods = spark.createDataFrame([(i, *r) for i, r in enumerate(wanted)], "p int, periodo_inicio date, periodo_fim date")
    # The two ends of every period; the open start has no prefix before it.
    ends = periods.select("p", F.explode(F.array(
        F.struct(F.lit(1).alias("sign"), F.coalesce("periodo_fim", F.lit("9999-12-31").cast("date")).alias("dia")),
        F.struct(F.lit(-1).alias("sign"), F.coalesce(F.date_sub("periodo_inicio", 1), F.lit("0001-01-01").cast("date")).alias("dia")))).alias("e"))
    listed = ends.agg(F.collect_set("e.dia")).first()[0]  # at most two days a period
    days = F.array(*[F.lit(d.isoformat()).cast("date") for d in sorted(listed)])
    asked = state.select("municipio_ibge").distinct().select(
        "municipio_ibge", F.explode(days).alias("dia"), *[F.lit(0).cast("long").alias(c) for c in ind.COUNTS], F.lit(True).alias("asked"))
    rows = state.select(*STATE_KEYS, *ind.COUNTS, F.lit(False).alias("asked")).unionByName(asked)
    # A municipality has one row a day and end: a bounded window.
    w = Window.partitionBy("municipio_ibge").orderBy("dia", "asked").rowsBetween(Window.unboundedPreceding, 0)
    prefix = (rows.select(*STATE_KEYS, "asked", *[F.sum(c).over(w).alias(c) for c in ind.COUNTS]).filter("asked")
              .select("municipio_ibge", F.col("dia").alias("end_day"), *ind.COUNTS))
    signed = prefix.join(F.broadcast(ends.select("p", F.col("e.sign").alias("sign"), F.col("e.dia").alias("end_day"))), "end_day")
    counts = (signed.groupBy("municipio_ibge", "p").agg(*[F.sum(F.col(c) * F.col("sign")).alias(c) for c in ind.COUNTS])
              .filter("n_notificacoes > 0"))
    return ind.rates(counts.join(F.broadcast(periods), "p"))


def rolling_periods(t: dict[str, DataFrame], lengths: tuple[int, ...] = (90, 365)) -> DataFrame:
    """Overlapping periods of the data: from every first of a month that has
    notifications, over so many days."""
    firsts = t["notificacao"].select(F.trunc("data_notificacao", "month").alias("periodo_inicio")).filter(
        F.col("periodo_inicio").isNotNull()).distinct()
    return firsts.select("periodo_inicio", F.explode(F.array(*[
        F.date_add("periodo_inicio", n - 1) for n in lengths])).alias("periodo_fim"))
