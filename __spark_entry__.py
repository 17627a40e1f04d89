"""

Every query reads the provided tables through the test-data adapter
(``vigia.sources.fixture``) and runs over all of them; the only filters are
the ones that are the feature itself (a KPI period, a dashboard filter, a
top-k report).
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import queries as oq  # noqa: E402
from oracle.cdc import AUDIT_CUTOFF, CDC_ORACLE  # noqa: E402
from oracle.etl import ETL_ORACLE  # noqa: E402
from oracle.changes import CHANGES_ORACLE  # noqa: E402
from oracle.loaded import LOADED_ORACLE  # noqa: E402
from oracle.quality import QUALITY_ORACLE  # noqa: E402
from vigia.operators import quality  # noqa: E402
from vigia.operators import aggregates, audit, keys, reshape  # noqa: E402
from vigia.plans import etl  # noqa: E402
from vigia.plans import cdc, cube  # noqa: E402
from vigia.plans import dashboard as dash  # noqa: E402
from vigia.plans import flat as flat_plan  # noqa: E402
from vigia.plans import indicator_state as state  # noqa: E402
from vigia.plans import indicators as ind  # noqa: E402
from vigia.plans import views  # noqa: E402
from vigia.sources.fixture import input_stamp, raw_fields, raw_notifications, raw_rows, read_source, session_tables  # noqa: E402
from vigia.session import compiled_methods, little_disk, reliable_checkpoint, scratch_path  # noqa: E402
from vigia.sources import catalog  # noqa: E402
from vigia.sources.raw import export_csv, read_flat, read_raw, write_raw  # noqa: E402
from vigia.streaming.audit_stream import run_audit_stream, run_in_batches  # noqa: E402

# The text operators are optional: without their folder (and the pipeline that
# calls them) everything else still works.
def _there(module: str) -> bool:
    spec = importlib.util.find_spec(module)
    return spec is not None and spec.origin is not None


corpus_pipeline = llm_queries = None
if _there("vigia.llm"):
    from vigia.llm import queries as llm_queries  # noqa: E402
    if _there("corpus_pipeline"):
        import corpus_pipeline  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return session_tables(spark, sf_dir)


_HELD: dict[str, tuple[tuple, object]] = {}


def _once(kind: str, spark: SparkSession, sf_dir: str, build: Callable[[], object]):
    """What ``build`` makes, once per live session and state of the input files."""
    key = (id(spark), id(spark.sparkContext), sf_dir, input_stamp(spark, sf_dir))
    if kind not in _HELD or _HELD[kind][0] != key:
        _HELD[kind] = (key, build())
    return _HELD[kind][1]


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table's (lazy) definition."""
    return _once("flat", spark, sf_dir, lambda: flat_plan.flat_dataset(_tables(spark, sf_dir)))


def _etl_run(spark: SparkSession, sf_dir: str):
    """Q1 over the raw-file view of the test data: the loader materialises its
    numbered and judged rows once and every curated output is read from them."""
    def build():
        stages = etl.etl_stages(spark, raw_notifications(spark, sf_dir))
        return stages, etl.etl_normalise(spark, None, stages=stages)
    return _once("etl", spark, sf_dir, build)


def _etl(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return _etl_run(spark, sf_dir)[1]


def _etl_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: _etl(spark, sf)[name]


def q_etl_name_map(spark: SparkSession, sf: str) -> DataFrame:
    return _etl_run(spark, sf)[0]["name_map"]


CSV_TABLES = {
    "clinicos": "dados_clinicos", "municipio": "municipio", "notificacao": "notificacao", "demograficos": "dados_demograficos",
    "gestao": "dados_gestao_estrategia", "epidemiologicos": "dados_epidemiologicos", "sintoma": "sintoma",
    "notificacao_sintoma": "notificacao_sintoma", "testes": "teste_laboratorial", "vacinas": "vacina_aplicada"}
def _csv_table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    """Q1 from real CSV files: the raw rows, with the documents' whole texts as
    free text (quotes, commas, line ends, backslashes), written as CSV files
    and loaded through the reader."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        def build():
            path = scratch_path(spark, "raw-csv")
            # Joined and sorted by two jobs, so that the shuffle files of the
            # joins are gone when those of the sort are written.
            with compiled_methods(spark), little_disk(spark):
                rows = reliable_checkpoint(raw_rows(spark, sf, free_text=True), "raw-rows")
                write_raw(raw_fields(rows), path, compression="gzip")
            return etl.etl_normalise(spark, read_raw(spark, path))
        return _once("csv", spark, sf, build)[name]
    return run


def q_purge_excluded(spark: SparkSession, sf: str) -> DataFrame:
    """Q32: purge soft-deleted notifications with their children (cascade);
    the rows that are left, by table and notification."""
    from functools import reduce
    t = _tables(spark, sf)
    ids = reliable_checkpoint(
        t["notificacao"].filter(F.col("excluido") == F.lit(True)).select("notificacao_id"), "purge-ids")
    names = ["notificacao"] + [c for c in quality.CASCADE_CHILDREN if c in t]
    # Adaptive execution merges partitions by their compressed bytes, and rows of
    # a key alone compress so well that one task would sort millions of them: the
    # ids are dealt into a number of partitions that it keeps, and so are the
    # tables that meet them.  Each table's counts are a job, so that no task
    # holds the sorts of all tables.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = quality.delete_notifications(t, ids.repartition(parts, "notificacao_id"))
    counts = [kept[n].groupBy("notificacao_id").agg(F.count(F.lit(1)).alias("linhas"))
              .select(F.lit(n).alias("tabela"), "notificacao_id", "linhas") for n in names]
    return reduce(lambda a, b: a.unionByName(b), [reliable_checkpoint(c, "purge-counts") for c in counts])


def q_audit_notificacao(spark: SparkSession, sf: str) -> DataFrame:
    """U2 on a curated table: notificacao as loaded on AS_OF versus today's
    table after the purge of soft-deleted rows (inserts and deletes)."""
    t = _tables(spark, sf)
    old = ind.snapshot_as_of(t, oq.AS_OF)["notificacao"]
    new = quality.delete_notifications(
        t, t["notificacao"].filter(F.col("excluido") == F.lit(True)))["notificacao"]
    return audit.audit_diff(old, new, ["notificacao_id"], "notificacao", with_meta=False)


def _versions(spark: SparkSession, sf: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """Two versions of the model: as it stood on AS_OF, with results and
    classifications still to come, and today's without the soft-deleted rows."""
    t = _tables(spark, sf)
    gone = t["notificacao"].filter(F.col("excluido") == F.lit(True))
    return ind.tables_as_of(t, oq.AS_OF), quality.delete_notifications(t, gone)


def _audit_of(name: str, with_changes: bool = False) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        old, new = _versions(spark, sf)
        return audit.audit_tables(old, new, [name], with_meta=False, with_changes=with_changes)
    return run


def q_audit_changed_columns(spark: SparkSession, sf: str) -> DataFrame:
    """How often each set of columns is changed by the updates of the three
    audited tables."""
    old, new = _versions(spark, sf)
    log = audit.audit_tables(old, new, with_meta=False, with_changes=True)
    return (log.filter("operacao = 'U'").groupBy("tabela_afetada", F.array_join(audit.CHANGED, ",").alias("colunas"))
            .agg(F.count(F.lit(1)).alias("linhas")))


def q_audit_purge(spark: SparkSession, sf: str) -> DataFrame:
    """U2 + C6: the D rows of the purge, notifications and audited children."""
    t = _tables(spark, sf)
    return audit.purge_log(t, t["notificacao"].filter(F.col("excluido") == F.lit(True)), with_meta=False)


def q_audit_log_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The log of the three audited tables appended as one batch and the
    purge's as another, the second delivered twice; rows of the written log."""
    old, new = _versions(spark, sf)
    path = scratch_path(spark, "log")
    catalog.append_log(audit.audit_tables(old, new, with_meta=False), path, "versoes")
    purge = reliable_checkpoint(q_audit_purge(spark, sf), "purge-log")  # one batch, delivered as it was
    for _ in range(2):
        catalog.append_log(purge, path, "expurgo")
    log = catalog.read_log(spark, path)
    return log.groupBy("tabela_afetada", "operacao", audit.logged_key().alias("notificacao_id")).agg(F.count(F.lit(1)).alias("linhas"))


def q_upsert_by_delta(spark: SparkSession, sf: str) -> DataFrame:
    """U1 + Q2 by deltas: the daily state of the older version, moved to today's
    by the change of the notifications that the log names, rolled up by month."""
    old, new = _versions(spark, sf)
    held = reliable_checkpoint(state.daily_counts(old), "daily-counts")
    change = state.delta(old, new, state.change_log(old, new))
    return state.rollup(reliable_checkpoint(state.apply_delta(held, change), "daily-counts"), monthly=True)


def q_indicators_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """P3 + Q2 for a table of overlapping periods (90 and 365 days from every
    month of the data), from prefix sums over the daily state."""
    t = _tables(spark, sf)
    return state.period_indicators(reliable_checkpoint(state.daily_counts(t), "daily-counts"), state.rolling_periods(t))


def _on_cube(fn) -> Callable[[SparkSession, str], DataFrame]:
    """A dashboard tab under the filter of oq, from the cube alone."""
    def run(spark: SparkSession, sf: str) -> DataFrame:
        def build():
            path = scratch_path(spark, "cube")
            cube.write_cube(_flat_table(spark, sf), path)
            return spark.read.parquet(path)
        return fn(_once("cube", spark, sf, build), start=oq.FILTER_START, end=oq.FILTER_END, municipios=oq.FILTER_MUNICIPIOS)
    return run


def _faulty_load(spark: SparkSession, sf: str) -> dict:
    return _once("faults", spark, sf, lambda: etl.etl_stages(spark, raw_notifications(spark, sf, faults=True)))


def q_load_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """C5 before the cast: the raw rows that a load puts aside, with the reasons."""
    return _faulty_load(spark, sf)["rejected"].select(
        "notificacao_id", "source_id", F.array_join("motivos", ",").alias("motivos"))


def q_symptom_ids_two_loads(spark: SparkSession, sf: str) -> DataFrame:
    """K1 over two loads: the dictionary of the file's first half, written, then
    extended by the second half."""
    accepted = _etl_run(spark, sf)[0]["accepted"]
    items = reshape.explode_list(accepted, "notificacao_id", "sintomas", etl.SYMPTOM_SEP, "nome", with_position=True)
    half = (accepted.agg(F.max("notificacao_id")).first()[0] or 0) // 2
    order = ["notificacao_id", "pos"]
    first = reliable_checkpoint(keys.dense_ids_by_first_appearance(
        items.filter(F.col("notificacao_id") <= half), "nome", order, "sintoma_id"), "symptom-ids")
    return keys.extend_ids(first, items.filter(F.col("notificacao_id") > half), "nome", order, "sintoma_id")


def q_quality_report_kpi_log(spark: SparkSession, sf: str) -> DataFrame:
    """Q31 on the derived tables: the KPI table and the audit log."""
    t = _tables(spark, sf)
    old, new = _versions(spark, sf)
    return quality.quality_report({
        "municipio": t["municipio"], "indicadores_regionais": ind.regional_indicators(t, monthly=True, with_timestamp=False),
        "log_alteracoes": audit.audit_tables(old, new, ["notificacao", "dados_clinicos"], with_meta=False)})


def q_distinct_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct sources of notifications by year, exactly and from the
    union of monthly sketches by place; whether the estimate is within three
    standard errors."""
    n = _tables(spark, sf)["notificacao"]
    n = n.select("source_id", "municipio_notificacao_ibge", F.date_format("data_notificacao", "yyyy-MM").alias("mes"))
    held = reliable_checkpoint(aggregates.distinct_sketches(n, ["municipio_notificacao_ibge", "mes"], "source_id"), "sketches")
    year = F.substring("mes", 1, 4).alias("ano")
    estimated = aggregates.distinct_from_sketches(held.select(year, "esboco"), ["ano"])
    exact = n.groupBy(year).agg(F.count_distinct("source_id").alias("fontes"))
    near = F.abs(F.col("distintos") - F.col("fontes")) <= 3 * aggregates.SKETCH_ERROR * F.col("fontes")
    return exact.join(estimated, "ano").select("ano", "fontes", near.alias("dentro_do_limite"))


def q_view_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """The analytic view read by its name in SQL."""
    views.register_analytic_views(_tables(spark, sf))
    return spark.sql("SELECT * FROM vw_casos_por_municipio")


def _ranked(order: list[str], source: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The rows with their place in the order of the columns (``-``: falling)."""
    return lambda spark, sf: keys.with_rank(
        source(spark, sf), [F.col(c[1:]).desc() if c[0] == "-" else F.col(c).asc() for c in order])


def q_notification_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Notifications whose flags were not provided get the declared defaults."""
    return quality.with_defaults(_tables(spark, sf)["notificacao"].drop("excluido", "validado"), "notificacao")


def q_audit_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """Changes of the user table between the cutoff and the end."""
    return cdc.audit_snapshots(read_source(spark, sf, "events"), AUDIT_CUTOFF)


def q_audit_events_log(spark: SparkSession, sf: str) -> DataFrame:
    """Trigger-style log of every change event (old and new images)."""
    return cdc.audit_events(read_source(spark, sf, "events"))


def q_audit_stream_batches(spark: SparkSession, sf: str) -> DataFrame:
    """U3 over several deliveries, the stream restarted for each."""
    return run_in_batches(spark, read_source(spark, sf, "events"))


def q_audit_stream_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same log produced by the streaming audit over the event files."""
    return run_audit_stream(spark, sf, glob="events.parquet")


def _flat_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table written once (S11) to the shared checkpoint folder
    and read back: the dashboard's aggregates all read this table, as the
    dashboard reads the exported extract instead of re-running the joins."""
    return _once("flat table", spark, sf_dir, lambda: catalog.materialize(spark, _flat(spark, sf_dir), "flat"))


def _on_flat(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf: fn(_flat_table(spark, sf))


def q_regional_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Q2 over one period: from the first to the last notification of the data."""
    t = _tables(spark, sf)
    first, last = t["notificacao"].agg(F.min("data_notificacao"), F.max("data_notificacao")).first()
    return ind.regional_indicators(t, first, last, with_timestamp=False)


def q_regional_indicators_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return ind.regional_indicators(_tables(spark, sf), monthly=True, with_timestamp=False)


def q_upsert_indicators(spark: SparkSession, sf: str) -> DataFrame:
    """Late data: the KPI table built from a snapshot as of AS_OF, then the
    months from RECOMPUTE_START recomputed on the full data and upserted."""
    t = _tables(spark, sf)
    stale = ind.regional_indicators(ind.snapshot_as_of(t, oq.AS_OF), monthly=True,
                                    with_timestamp=False)
    fresh = ind.regional_indicators(t, oq.RECOMPUTE_START, None, monthly=True, with_timestamp=False)
    return ind.upsert(stale, fresh)


def q_cases_from_written(spark: SparkSession, sf: str) -> DataFrame:
    """The view over tables written by month and read back."""
    t = _tables(spark, sf)
    base = scratch_path(spark, "curated")
    names = ["estado", "municipio", "notificacao", "dados_clinicos"]
    catalog.write_tables({n: t[n] for n in names}, base)
    return views.cases_by_municipality(catalog.read_tables(spark, base, names))


def q_flat_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The feature table exported as CSV and read back."""
    flat = _flat(spark, sf)
    path = scratch_path(spark, "flat-csv")
    export_csv(catalog.require_non_empty(flat), path)
    return read_flat(spark, path, flat.schema)


def q_filtered_headline(spark: SparkSession, sf: str) -> DataFrame:
    f = dash.apply_filters(_flat_table(spark, sf), oq.FILTER_START, oq.FILTER_END, oq.FILTER_MUNICIPIOS)
    return dash.headline(f)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: regional indicators for every municipality and month (Q2)."""
    return q_regional_indicators_monthly(spark, SMOKE_DIR)


def _llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if llm_queries is None:
        return {}
    pipeline = {"pipeline": corpus_pipeline.run} if corpus_pipeline is not None else {}
    return {**llm_queries.queries(), **pipeline}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        **_llm_queries(),
        # views (Q3-Q5)
        "cases_by_municipality": lambda s, sf: views.cases_by_municipality(_tables(s, sf)),
        "cases_from_written_tables": q_cases_from_written,
        "vaccination_by_outcome": lambda s, sf: views.vaccination_by_outcome(_tables(s, sf)),
        "frequent_symptoms": lambda s, sf: views.frequent_symptoms(_tables(s, sf)),
        # KPIs (Q2, U1)
        "regional_indicators": q_regional_indicators,
        "regional_indicators_monthly": q_regional_indicators_monthly,
        "upsert_indicators": q_upsert_indicators,
        # feature table (Q6-Q10)
        "symptom_agg": lambda s, sf: flat_plan.symptom_agg(_tables(s, sf)),
        "vaccine_agg": lambda s, sf: flat_plan.vaccine_agg(_tables(s, sf)),
        "test_agg": lambda s, sf: flat_plan.test_agg(_tables(s, sf)),
        "test_agg_by_code": lambda s, sf: flat_plan.test_agg(_tables(s, sf), positive="code"),
        "flat_dataset": _flat,
        "flat_dataset_by_code": lambda s, sf: flat_plan.flat_dataset(_tables(s, sf), positive="code"),
        "flat_csv": q_flat_csv,
        "dataset_audit": _on_flat(flat_plan.dataset_audit),
        "target_balance": _on_flat(lambda f: flat_plan.target_balance(f, digits=6)),
        # dashboard
        "headline": _on_flat(dash.headline),
        "filtered_headline": q_filtered_headline,
        "monthly_rate": _on_flat(dash.monthly_rate),
        "top_municipalities_10": _on_flat(lambda f: dash.top_municipalities(f, 10)),
        "top_municipalities_20": _on_flat(lambda f: dash.top_municipalities(f, 20)),
        "dist_sex": _on_flat(lambda f: dash.distribution(f, "sexo")),
        "dist_age_band": _on_flat(lambda f: dash.distribution(f, "faixa_etaria")),
        "dist_race": _on_flat(lambda f: dash.distribution(f, "raca_cor", 10)),
        "dist_occupation": _on_flat(lambda f: dash.distribution(f, "categoria_ocupacao")),
        "vaccine_status_counts": _on_flat(dash.vaccine_status_counts),
        "vaccine_status_x_target": _on_flat(dash.vaccine_status_x_target),
        "top_vaccine_makers": _on_flat(lambda f: dash.distribution(f, "fabricantes_vacina", 10)),
        "rate_by_vaccine_status": _on_flat(dash.rate_by_vaccine_status),
        "test_metrics": _on_flat(dash.test_metrics),
        "top_test_types": _on_flat(lambda f: dash.list_item_counts(f, "tipos_testes_lista", "tipo_teste")),
        "top_test_makers": _on_flat(lambda f: dash.list_item_counts(f, "fabricantes_teste_lista",
                                                                    "fabricante_teste")),
        "dist_test_result": _on_flat(lambda f: dash.distribution(f, "resultado_teste_agregado")),
        "symptom_correlation": _on_flat(lambda f: dash.symptom_correlation(f, digits=6)),
        "risk_score": _on_flat(dash.score_risk),
        "facet_municipalities": _on_flat(dash.facet_municipalities),
        "facet_date_range": _on_flat(dash.facet_date_range),
        # constraints and cascade
        "quality_report": lambda s, sf: quality.quality_report(_tables(s, sf)),
        "dq_test_slot_duplicates": lambda s, sf: quality.dq_unique(
            _tables(s, sf)["teste_laboratorial"], ["notificacao_id", "numero_sequencial"]),
        "purge_excluded": q_purge_excluded,
        # change audit (Q30: U2, U3)
        "audit_snapshots": q_audit_snapshots,
        "audit_notificacao": q_audit_notificacao,
        "audit_events_log": q_audit_events_log,
        "audit_stream_events": q_audit_stream_events,
        "audit_stream_batches": q_audit_stream_batches,
        "audit_testes": _audit_of("teste_laboratorial"),
        "audit_clinicos": _audit_of("dados_clinicos"),
        "audit_purge": q_audit_purge,
        "audit_changed_columns": q_audit_changed_columns,
        "audit_log_batches": q_audit_log_batches,
        # indicators kept by deltas, and for any periods
        "upsert_by_delta": q_upsert_by_delta,
        "indicators_by_period": q_indicators_by_period,
        # dashboard tabs under a filter, from the cube
        "cube_headline": _on_cube(cube.headline),
        "cube_monthly_rate": _on_cube(cube.monthly_rate),
        "cube_top_municipalities": _on_cube(lambda c, **f: cube.top_municipalities(c, 10, **f)),
        "cube_dist_sex": _on_cube(lambda c, **f: cube.distribution(c, "sexo", **f)),
        "cube_dist_age_band": _on_cube(lambda c, **f: cube.distribution(c, "faixa_etaria", **f)),
        "cube_dist_race": _on_cube(lambda c, **f: cube.distribution(c, "raca_cor", 10, **f)),
        "cube_vaccine_status_counts": _on_cube(cube.vaccine_status_counts),
        "cube_vaccine_status_x_target": _on_cube(cube.vaccine_status_x_target),
        "cube_rate_by_vaccine_status": _on_cube(cube.rate_by_vaccine_status),
        "cube_top_vaccine_makers": _on_cube(lambda c, **f: cube.distribution(c, "fabricantes_vacina", 10, **f)),
        "cube_test_metrics": _on_cube(cube.test_metrics),
        "cube_top_test_types": _on_cube(lambda c, **f: cube.distribution(c, "tipos_testes_lista", 10, name="tipo_teste", **f)),
        "cube_dist_test_result": _on_cube(lambda c, **f: cube.distribution(c, "resultado_teste_agregado", **f)),
        # ordered outputs with their rank
        "frequent_symptoms_ordered": _ranked(
            ["-frequencia_em_confirmados", "sintoma"], lambda s, sf: views.frequent_symptoms(_tables(s, sf))),
        "facet_municipalities_ordered": _ranked(["municipio_nome"], _on_flat(dash.facet_municipalities)),
        "vaccine_status_x_target_ordered": _ranked(["status_vacinal", "target_confirmado"], _on_flat(dash.vaccine_status_x_target)),
        # constraints of derived tables, defaults, views by name
        "distinct_sources": q_distinct_sources,
        "quality_report_kpi_log": q_quality_report_kpi_log,
        "notification_defaults": q_notification_defaults,
        "cases_by_municipality_view": q_view_by_name,
        # rejected rows and dictionaries of a load
        "load_rejects": q_load_rejects,
        "load_balance": lambda s, sf: etl.load_balance(_faulty_load(s, sf)),
        "symptom_ids_two_loads": q_symptom_ids_two_loads,
        # raw-file loader (Q1)
        "etl_name_map": q_etl_name_map,
        "etl_municipio": _etl_table("municipio"),
        "etl_notificacao": _etl_table("notificacao"),
        "etl_demograficos": _etl_table("dados_demograficos"),
        "etl_clinicos": _etl_table("dados_clinicos"),
        "etl_gestao": _etl_table("dados_gestao_estrategia"),
        "etl_epidemiologicos": _etl_table("dados_epidemiologicos"),
        "etl_sintoma": _etl_table("sintoma"),
        "etl_notificacao_sintoma": _etl_table("notificacao_sintoma"),
        "etl_testes": _etl_table("teste_laboratorial"),
        "etl_vacinas": _etl_table("vacina_aplicada"),
        **{f"etl_csv_{short}": _csv_table(name) for short, name in CSV_TABLES.items()},
        # analytics over the loader's output (raw -> load -> view / KPI)
        "etl_cases_by_municipality": lambda s, sf: views.cases_by_municipality(_etl(s, sf)),
        "etl_regional_indicators_monthly": lambda s, sf: ind.regional_indicators(
            _etl(s, sf), monthly=True, with_timestamp=False),
    }


def oracle_sql() -> dict[str, str]:
    llm = llm_queries.oracle_sql() if llm_queries else {}
    if corpus_pipeline is not None and corpus_pipeline.ORACLE_SQL is not None:
        llm["pipeline"] = corpus_pipeline.ORACLE_SQL
    return {**llm, **oq.ORACLE, **ETL_ORACLE, **QUALITY_ORACLE, **CDC_ORACLE, **LOADED_ORACLE,
            **CHANGES_ORACLE}
