"""Differential test: every registered query against its DuckDB oracle (sf0.001),
plus golden counts of the test-data adapter at sf0.01 and the stream/batch
equality of the audit log over several event files."""

import os
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "string": "VARCHAR",
                 "date": "DATE", "double": "DOUBLE", "boolean": "BOOLEAN"}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "benchmark"]
OWN = set(E.queries()) - set(E._llm_queries())  # the text operators have tests of their own


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, Decimal):
        return str(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF_SMALL)
    s_rows = sorted(tuple(_norm(x) for x in r) for r in sdf.collect())
    rel = duck.sql(E.oracle_sql()[name])
    order = [rel.columns.index(c) for c in sdf.columns]
    d_rows = sorted(tuple(_norm(r[i]) for i in order) for r in rel.fetchall())
    assert sorted(sdf.columns) == sorted(rel.columns)
    assert s_rows == d_rows
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    for col, t in sdf.dtypes:
        assert SPARK_TO_DUCK.get(t, t.upper()) == duck_types[col], (col, t, duck_types[col])


def test_every_query_has_an_oracle():
    assert set(E.oracle_sql()) >= OWN


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns[:3] == ["municipio_ibge", "periodo_inicio", "periodo_fim"]


def test_golden_counts_sf001(spark):
    q = E.queries()
    assert q["cases_by_municipality"](spark, SF_MID).count() == 8324
    assert q["vaccination_by_outcome"](spark, SF_MID).count() == 36
    assert q["flat_dataset"](spark, SF_MID).count() == 8984
    ind = {r.municipio_ibge: r for r in q["regional_indicators"](spark, SF_MID).collect()}
    assert len(ind) == 25
    fs = {r.sintoma: r for r in q["frequent_symptoms"](spark, SF_MID).collect()}
    assert (fs["Febre"].frequencia_total, fs["Febre"].frequencia_em_confirmados) == (645, 315)


def test_flat_invariants(spark):
    flat = E.queries()["flat_dataset"](spark, SF_MID)
    n = flat.count()
    bands = E.queries()["dist_age_band"](spark, SF_MID).agg({"total": "sum"}).first()[0]
    nulls = flat.filter("faixa_etaria IS NULL").count()
    assert bands + nulls == n
    cases = E.queries()["cases_by_municipality"](spark, SF_MID)
    tot = cases.agg({"total_notificacoes": "sum", "casos_confirmados": "sum"}).first()
    assert tot["sum(total_notificacoes)"] == n
    assert tot["sum(casos_confirmados)"] <= n


def test_stream_equals_batch_over_many_files(spark, tmpdir_path):
    from pyspark.sql import functions as F

    from vigia.plans import cdc
    from vigia.streaming.audit_stream import run_audit_stream
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    src = f"{tmpdir_path}/events"
    # one arrival file per week, appended in time order (the stream, like a
    # trigger, logs changes in arrival order)
    import time
    weeks = sorted(r[0] for r in ev.select(F.weekofyear("ts")).distinct().collect())
    for wk in weeks:
        ev.filter(F.weekofyear("ts") == wk).coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)
    streamed = run_audit_stream(spark, src, max_files_per_trigger=1)
    batch = cdc.audit_events(ev)
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert sorted(map(tuple, streamed.collect()), key=key) == sorted(map(tuple, batch.collect()), key=key)


def test_stream_restart_resumes_without_duplicates(spark, tmpdir_path):
    """Stop after two arrival files, restart on the same checkpoint / state /
    log folders after three more arrive: every change is logged exactly once
    and old images carry across the restart."""
    import time

    from pyspark.sql import functions as F

    from vigia.plans import cdc
    from vigia.streaming.audit_stream import audit_stream, read_log
    ev = spark.read.parquet(f"{SF_MID}/events.parquet")
    src, log = f"{tmpdir_path}/events", f"{tmpdir_path}/log"
    state, ckpt = f"{tmpdir_path}/state", f"{tmpdir_path}/ckpt"
    weeks = sorted(r[0] for r in ev.select(F.weekofyear("ts")).distinct().collect())

    def arrive(ws):
        for wk in ws:
            ev.filter(F.weekofyear("ts") == wk).coalesce(1).write.mode("append").parquet(src)
            time.sleep(1.1)

    arrive(weeks[:2])
    audit_stream(spark, src, log, state, ckpt).awaitTermination()
    first = read_log(spark, log).count()
    arrive(weeks[2:])
    audit_stream(spark, src, log, state, ckpt).awaitTermination()
    got = read_log(spark, log)
    want = cdc.audit_events(ev)
    key = lambda r: tuple("" if x is None else str(x) for x in r)
    assert 0 < first < got.count()
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)


@pytest.mark.parametrize("name,key", [("regional_indicators_monthly", "municipio_ibge"),
                                      ("cases_by_municipality", "municipio"),
                                      ("audit_snapshots", "user_id")])
def test_hot_key_groupings_aggregate_before_shuffle(spark, name, key):
    """A key holding a third of the rows must reach the shuffle as one partial
    row per task: the plan aggregates partially below the exchange on the key."""
    import io
    import re
    from contextlib import redirect_stdout
    df = E.queries()[name](spark, SF_SMALL)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    plan = buf.getvalue()
    lines = plan.splitlines()
    ex = [i for i, ln in enumerate(lines) if re.search(rf"Exchange hashpartitioning\({key}", ln)]
    assert ex, plan
    below = "\n".join(lines[ex[0] + 1:ex[0] + 4])
    # HashAggregate, or SortAggregate for struct-valued max_by: both map-side
    assert "Aggregate" in below and ("partial_" in below or "functions=[]" in below), plan


def test_fixture_golden_counts_of_the_feature_table(spark):
    """FIXTURES.md §5 (counted with positivity by code)."""
    from pyspark.sql import functions as F

    from vigia.plans import flat
    f = flat.flat_dataset(E._tables(spark, SF_MID), positive="code")
    assert f.count() == 8984
    status = {r[0]: r[1] for r in f.groupBy("status_vacinal").count().collect()}
    assert status == {"Esquema Completo": 2900, "Não Vacinado": 2803, "Parcial": 3281}
    res = {r[0]: r[1] for r in f.groupBy("resultado_teste_agregado").count().collect()}
    assert res == {"Positivo": 4785, "Negativo/Inconclusivo": 3321, "Não Testado": 878}
    tgt = {r[0]: r[1] for r in f.groupBy("target_confirmado").count().collect()}
    assert tgt == {1: 2958, 0: 4466, None: 1560}
    s = f.agg(F.sum("testes_realizados"), F.sum("doses_vacina"), F.sum("flg_febre"),
              F.sum("flg_tosse"), F.sum("flg_dispneia")).first()
    assert tuple(s) == (20374, 10401, 645, 556, 1161)
    n = E._tables(spark, SF_MID)["notificacao"]
    assert n.count() == 15000
    assert n.filter(F.col("excluido").isNull()).count() == 3020
    assert n.filter(F.col("excluido")).count() == 2996


def test_fixture_golden_indicators_1998(spark):
    from decimal import Decimal

    from vigia.plans import indicators
    rows = indicators.regional_indicators(E._tables(spark, SF_MID), "1998-01-01", "1998-12-31").collect()
    assert len(rows) == 25
    m0 = [r for r in rows if r.municipio_ibge == 0][0]
    assert (m0.taxa_positividade, m0.tempo_medio_sintomas_teste, m0.perc_prof_saude_infectados,
            m0.media_doses_vacina) == (Decimal("22.81"), Decimal("588.2"), Decimal("37.50"), Decimal("1.18"))


def test_no_python_in_any_plan(spark):
    """Every registered query runs in JVM operators only (no Python UDF,
    pandas UDF or mapInPandas node in its physical plan)."""
    import io
    from contextlib import redirect_stdout

    from tools.plan_report import PY_NODES
    for name, fn in E.queries().items():
        if name not in OWN:
            continue
        buf = io.StringIO()
        with redirect_stdout(buf):
            fn(spark, SF_SMALL).explain()
        assert not any(n in buf.getvalue() for n in PY_NODES), name
