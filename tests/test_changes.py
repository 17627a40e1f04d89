"""Change logs of multisets, bucketed stream state, repeatable log batches,
indicators by deltas and periods, the cube, rejected rows, dictionaries."""

import json
import os
import random
from collections import Counter

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_MID, SF_SMALL
from oracle.queries import AS_OF
from vigia.operators import audit, keys, quality, sequence
from vigia.plans import cube, dashboard, etl, indicator_state as state, indicators as ind
from vigia.sources import catalog
from vigia.sources.fixture import raw_notifications
from vigia.streaming.key_state import KeyState


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.collect()))


# -- ordered work inside a key ------------------------------------------------------

def test_running_total_matches_window_under_skew(spark):
    rng = random.Random(3)
    data = [(None if i % 11 == 0 else 0 if i % 3 == 0 else rng.randint(1, 30), "ab"[i % 2], i, rng.choice([1, 1, 2, 50])) for i in range(3000)]
    df = spark.createDataFrame(data, "k int, s string, o int, n long")
    w = Window.partitionBy("k", "s").orderBy("o")
    want = rows(df.withColumn("t", F.sum("n").over(w)))
    for parts in (1, 7, 64, None):
        got = sequence.running_total_by_key(df, ["k", "s"], ["o"], "n", "t", parts)
        assert got.columns == ["k", "s", "o", "n", "t"] and rows(got) == want
    assert sequence.running_total_by_key(df.limit(0), ["k"], ["o"], "n", "t").collect() == []


def test_previous_row_of_a_null_key(spark):
    df = spark.createDataFrame([(None, i, f"v{i}") for i in range(40)] + [(1, i, None) for i in range(5)], "k int, o int, v string")
    got = sequence.previous_by_key(df, "k", ["o"], ["v"], num_partitions=6)
    assert rows(got.filter("k is null").select("o", "prev_v")) == sorted((str(i), f"v{i - 1}" if i else "None") for i in range(40))
    assert {r[0] for r in got.filter("k = 1").select("prev_v").collect()} == {None}


# -- difference of multisets -----------------------------------------------------------

COLUMNS = "g long, slot int, a string, d string"


def applied(old, log):
    """The old rows after the log."""
    have = Counter(old)
    for r in log:
        for image, step in ((r.dados_antigos, -1), (r.dados_novos, 1)):
            if image is not None:
                v = json.loads(image)
                have[(v["g"], v["slot"], v["a"], v["d"])] += step
    assert min(have.values(), default=0) >= 0
    return +have


@pytest.mark.parametrize("seed", [1, 2])
def test_multiset_log_turns_old_into_new(spark, seed):
    rng = random.Random(seed)
    some = lambda n: [(rng.choice([1, 2, 3, None]), rng.choice([1, 2, None]), rng.choice(["x", "y", None]), rng.choice(["p", "q"]))
                      for _ in range(n)]
    old, new = some(120), some(120)
    old += [(9, 1, "hot", "p")] * 500  # one slot holds most rows: copies, and rows of their own
    new += [(9, 1, "hot", "q")] * 300 + [(9, 1, f"own{i}", "p") for i in range(150)]
    log = audit.audit_multiset(spark.createDataFrame(old, COLUMNS), spark.createDataFrame(new, COLUMNS), ["g", "slot"], "t",
                               with_meta=False, with_changes=True).collect()
    assert applied(old, log) == Counter(new)
    # As few rows as there can be: in every slot, min(deleted, inserted) updates.
    gone, come = Counter(old) - Counter(new), Counter(new) - Counter(old)
    slots = {k[:2] for k in [*gone, *come]}
    n = lambda c, s: sum(v for k, v in c.items() if k[:2] == s)
    kinds = Counter(r.operacao for r in log)
    assert kinds["U"] == sum(min(n(gone, s), n(come, s)) for s in slots) and len(log) == sum(max(n(gone, s), n(come, s)) for s in slots)
    for r in log:
        if r.operacao == "U":
            a, b = json.loads(r.dados_antigos), json.loads(r.dados_novos)
            assert a["g"] == b["g"] and a["slot"] == b["slot"]
            assert r.colunas_alteradas == [c for c in ("a", "d") if a[c] != b[c]] != []


def test_multiset_log_of_equal_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 1, "x", "p")] * 3, COLUMNS)
    run = lambda a, b: audit.audit_multiset(a, b, ["g", "slot"], "t").collect()
    assert run(df, df.repartition(3)) == [] and run(df.limit(0), df.limit(0)) == []
    assert [r.operacao for r in run(df.limit(0), df)] == ["I"] * 3 and [r.operacao for r in run(df, df.limit(0))] == ["D"] * 3


def test_purge_logs_the_audited_children(spark):
    t = E._tables(spark, SF_SMALL)
    gone = t["notificacao"].filter("excluido").select("notificacao_id")
    log = audit.purge_log(t, gone).groupBy("tabela_afetada", "operacao").count().collect()
    assert {(r[0], r[1]): r[2] for r in log} == {
        (n, "D"): t[n].join(gone, "notificacao_id", "left_semi").count() for n in audit.AUDITED_TABLES}


# -- repeatable log, bucketed state -------------------------------------------------------

def test_log_batch_written_twice_counts_once(spark, tmpdir_path):
    log = spark.createDataFrame([("a", "I", None, "{}"), ("a", "I", None, "{}"), ("b", "D", "{}", None)],
                                "tabela_afetada string, operacao string, dados_antigos string, dados_novos string")
    path = f"{tmpdir_path}/log"
    for batch in (1, 2, 1, "x", 2):
        catalog.append_log(log, path, batch)
    assert catalog.read_log(spark, path).count() == 9
    assert sorted(catalog.read_log(spark, path).columns) == sorted(log.columns)


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet"))


def test_state_writes_touched_buckets_only(spark, tmpdir_path):
    path = f"{tmpdir_path}/state"
    held = KeyState(spark, path, "k", buckets=32)
    everyone = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("image"))
    touched = held.touched(everyone, 0)
    held.write(everyone, 0, touched)
    whole = size(f"{path}/state/v=0")
    # A batch of some keys: the state of its buckets, with these keys changed.
    few = everyone.filter("k in (5, 77, 4321)").withColumn("image", F.lit("new"))

    def deliver(version, batch, state):
        t = state.touched(batch, version)
        before = state.read(version - 1, t)
        state.write(before.join(batch.select("k"), "k", "left_anti").unionByName(batch), version, t)
        return t

    t = deliver(1, few, held)
    assert 1 <= len(t) <= 3 and size(f"{path}/state/v=1") < whole * (len(t) + 0.5) / 32 * 1.3
    after = {r.k: r.image for r in held.read(1).collect()}
    assert len(after) == 20_000 and {k for k, v in after.items() if v == "new"} == {5, 77, 4321}
    # A replay rewrites the version; a restart with another bucket count keeps the stored one.
    deliver(1, few, KeyState(spark, path, "k", buckets=7))
    assert {r.k: r.image for r in held.read(1).collect()} == after
    for v in (2, 3, 4):
        deliver(v, everyone.filter(f"k = {v}").withColumn("image", F.lit(f"v{v}")), held)
        deliver(v, everyone.filter(f"k = {v}").withColumn("image", F.lit(f"v{v}")), held)
    last = {r.k: r.image for r in held.read(4).collect()}
    assert len(last) == 20_000 and [last[v] for v in (2, 3, 4, 5)] == ["v2", "v3", "v4", "new"]
    assert size(f"{path}/state") < 1.5 * whole and sorted(os.listdir(f"{path}/manifest")) == ["v=3", "v=4"]


# -- indicators by deltas, periods ------------------------------------------------------------

def versions(spark):
    t = E._tables(spark, SF_MID)
    return ind.tables_as_of(t, AS_OF), quality.delete_notifications(t, t["notificacao"].filter("excluido"))


def test_delta_equals_recompute_and_reads_changed_months(spark, tmpdir_path):
    t = E._tables(spark, SF_MID)
    base = t["notificacao"]
    moved = base.filter("notificacao_id % 10 = 3").select("notificacao_id")
    march = base.filter("data_notificacao between '1995-03-01' and '1995-03-31'").select("notificacao_id")
    ids = moved.join(march, "notificacao_id", "left_semi")
    assert ids.count() > 0
    # Inserts (rows missing before), deletes (tests gone) and updates (classification, place, day) in one month.
    old = {**t, "notificacao": base.join(ids.filter("notificacao_id % 3 = 0"), "notificacao_id", "left_anti")}
    hit = ids.withColumn("hit", F.lit(True))
    new = {**t, "teste_laboratorial": t["teste_laboratorial"].join(ids.filter("notificacao_id % 3 = 1"), "notificacao_id", "left_anti"),
           "dados_clinicos": t["dados_clinicos"].join(hit, "notificacao_id", "left").withColumn(
               "classificacao_final", F.when(F.col("hit"), "Confirmado").otherwise(F.col("classificacao_final"))).drop("hit"),
           "notificacao": base.join(hit, "notificacao_id", "left").withColumn(
               "data_notificacao", F.when(F.col("hit"), F.date_add("data_notificacao", -1)).otherwise(F.col("data_notificacao"))).drop("hit")}
    stored = []
    for k, version in enumerate((old, new)):
        catalog.write_tables({n: version[n] for n in state.KPI_TABLES}, f"{tmpdir_path}/{k}")
        stored.append({**t, **catalog.read_tables(spark, f"{tmpdir_path}/{k}", state.KPI_TABLES)})
    before, after = stored
    log = state.change_log(*({n: v[n].drop("mes_particao") for n in state.KPI_TABLES} for v in stored))
    change = state.delta(before, after, log)
    touched = audit.changed_keys(log).count()
    assert 0 < touched <= ids.count()
    got = state.apply_delta(state.daily_counts(before), change)
    assert rows(got) == rows(state.daily_counts(after).select(got.columns))
    assert rows(state.rollup(got, monthly=True)) == rows(ind.regional_indicators(after, monthly=True, with_timestamp=False))
    # Only the months of the changed notifications are read from the month folders.
    files = {f.split("mes_particao=")[1][:7] for n in ("dados_clinicos", "teste_laboratorial") for f in state._cut(
        after, audit.changed_keys(log))[n].inputFiles() if "mes_particao=" in f}
    plan = state._cut(after, audit.changed_keys(log))["teste_laboratorial"]._jdf.queryExecution().toString()
    assert files and "mes_particao" in plan.split("PartitionFilters: [")[1][:200]


def test_periods_of_any_kind(spark):
    t = E._tables(spark, SF_MID)
    days = state.daily_counts(t)
    d = lambda x: None if x is None else __import__("datetime").date.fromisoformat(x)
    wanted = [("1995-01-01", "1995-01-31"), ("1995-01-15", "1996-03-02"), ("1995-01-01", "1995-01-01"), ("1901-01-01", "1902-01-01"),
              (None, "1994-06-30"), ("1996-01-01", None), (None, None), ("1995-01-01", "1995-01-31"), ("1995-02-01", "1995-01-01")]
    got = state.period_indicators(days, spark.createDataFrame([(d(a), d(b)) for a, b in wanted], "periodo_inicio date, periodo_fim date"))
    for a, b in dict.fromkeys(wanted):
        want = ind.regional_indicators(t, a, b, with_timestamp=False)
        mine = got.filter(F.col("periodo_inicio").eqNullSafe(F.lit(d(a))) & F.col("periodo_fim").eqNullSafe(F.lit(d(b))))
        assert rows(mine.select(want.columns)) == rows(want), (a, b)
    assert state.period_indicators(days, spark.createDataFrame([], "periodo_inicio date, periodo_fim date")).collect() == []
    with pytest.raises(ValueError):
        state.period_indicators(days, state.rolling_periods(t), max_periods=3)


# -- the cube ------------------------------------------------------------------------------------

def test_cube_answers_any_filter_without_the_feature_table(spark, tmpdir_path):
    flat = E._flat_table(spark, SF_MID)
    cube.write_cube(flat, f"{tmpdir_path}/cube")
    c = spark.read.parquet(f"{tmpdir_path}/cube")
    for f in ({}, {"start": "1995-02-03", "end": "1995-02-03"}, {"municipios": ["NATION_7"]}, {"start": "1994-05-01"},
              {"start": "1994-05-01", "end": "1996-01-01", "municipios": ["NATION_2", "nowhere"]}, {"municipios": ["nowhere"]}):
        direct = dashboard.apply_filters(flat, **f)
        tabs = [(cube.headline(c, **f), dashboard.headline(direct)), (cube.monthly_rate(c, **f), dashboard.monthly_rate(direct)),
                (cube.distribution(c, "sexo", **f), dashboard.distribution(direct, "sexo")),
                (cube.distribution(c, "tipos_testes_lista", 10, name="x", **f), dashboard.list_item_counts(direct, "tipos_testes_lista", "x")),
                (cube.vaccine_status_counts(c, **f), dashboard.vaccine_status_counts(direct)),
                (cube.vaccine_status_x_target(c, **f), dashboard.vaccine_status_x_target(direct)),
                (cube.rate_by_vaccine_status(c, **f), dashboard.rate_by_vaccine_status(direct)),
                (cube.test_metrics(c, **f), dashboard.test_metrics(direct)),
                (cube.top_municipalities(c, 10, **f), dashboard.top_municipalities(direct, 10))]
        for mine, want in tabs:
            assert rows(mine.select(want.columns)) == rows(want), (f, want.columns)
            assert all("/cube/" in p for p in mine.inputFiles())


# -- rejected rows, constraints, dictionaries ---------------------------------------------------------

def test_every_raw_row_is_accepted_or_rejected(spark):
    raw = raw_notifications(spark, SF_SMALL, faults=True)
    stages = etl.etl_stages(spark, raw)
    total, good, bad = raw.count(), stages["accepted"].count(), stages["rejected"].count()
    assert good + bad == total and bad > 0
    assert stages["contagem"] == {"linhas": total, "aceitas": good, "rejeitadas": bad}
    balance = {r.motivo: r.linhas for r in etl.load_balance(stages).collect()}
    assert balance["aceita"] == good and sum(balance.values()) >= total
    assert {"municipio_desconhecido", "faixa:idade", "faixa:totalTestesRealizados", "tamanho:racaCor", "tamanho:sintomas",
            "tamanho:codigoEstrategiaCovid"} <= set(balance)
    out = etl.etl_normalise(spark, None, stages=stages)
    report = {(r.verificacao, r.tabela, r.colunas): r.violacoes for r in quality.quality_report(out).collect()}
    assert not any(v for (kind, _, _), v in report.items() if kind in ("tamanho", "faixa_smallint", "chave_estrangeira", "chave_primaria"))


def test_planted_violations_of_every_added_constraint(spark):
    t = {
        "municipio": spark.createDataFrame([(1, "A", 1)], "municipio_ibge int, nome string, estado_ibge int"),
        "notificacao": spark.createDataFrame([(1,), (2,)], "notificacao_id long"),
        "condicao": spark.createDataFrame([(1, "x" * 201), (1, "b"), (2, "b"), (None, None)], "condicao_id int, nome string"),
        "notificacao_condicao": spark.createDataFrame([(1, 1), (1, 1), (9, 2), (2, 7)], "notificacao_id long, condicao_id int"),
        "indicadores_regionais": spark.createDataFrame(
            [(1, "a", "b", 1000.0, 1.0, 1.0, 99.995), (1, "a", "b", 999.994, 9999.95, 1.0, 1.0), (3, "a", "b", 1.0, 1.0, -1000.0, 1.0)],
            "municipio_ibge int, periodo_inicio string, periodo_fim string, taxa_positividade double, tempo_medio_sintomas_teste double, "
            "perc_prof_saude_infectados double, media_doses_vacina double"),
        "log_alteracoes": spark.createDataFrame([(None, "I", "u"), ("t", None, "u" * 51), ("t" * 51, "UU", "u")],
                                                "tabela_afetada string, operacao string, usuario_db string"),
    }
    got = {(r.verificacao, r.tabela, r.colunas): r.violacoes for r in quality.quality_report(t).collect()}
    want = {("chave_primaria", "condicao", "condicao_id"): 1, ("nao_nulo", "condicao", "condicao_id"): 1, ("unico", "condicao", "nome"): 1,
            ("tamanho", "condicao", "nome"): 1, ("chave_primaria", "notificacao_condicao", "notificacao_id,condicao_id"): 1,
            ("chave_estrangeira", "notificacao_condicao", "notificacao_id"): 1, ("chave_estrangeira", "notificacao_condicao", "condicao_id"): 1,
            ("unico", "indicadores_regionais", "municipio_ibge,periodo_inicio,periodo_fim"): 1,
            ("chave_estrangeira", "indicadores_regionais", "municipio_ibge"): 1,
            ("faixa_decimal", "indicadores_regionais", "taxa_positividade"): 1,
            ("faixa_decimal", "indicadores_regionais", "tempo_medio_sintomas_teste"): 1,
            ("faixa_decimal", "indicadores_regionais", "perc_prof_saude_infectados"): 1,
            ("faixa_decimal", "indicadores_regionais", "media_doses_vacina"): 1,
            ("nao_nulo", "log_alteracoes", "tabela_afetada"): 1, ("nao_nulo", "log_alteracoes", "operacao"): 1,
            ("tamanho", "log_alteracoes", "tabela_afetada"): 1, ("tamanho", "log_alteracoes", "operacao"): 1,
            ("tamanho", "log_alteracoes", "usuario_db"): 1}
    assert {k: got.get(k) for k in want} == want


def test_two_loads_number_as_one(spark):
    names = ["b", "a", "b", None, "c", "a", "d", "e", "b", "f", "d"]
    items = spark.createDataFrame(list(enumerate(names)), "o int, nome string")
    whole = rows(keys.dense_ids_by_first_appearance(items, "nome", ["o"], "id"))
    for cut in (0, 1, 5, 11):
        first = keys.dense_ids_by_first_appearance(items.filter(F.col("o") < cut), "nome", ["o"], "id")
        both = keys.extend_ids(first, items.filter(F.col("o") >= cut), "nome", ["o"], "id")
        assert rows(both) == whole and set(rows(first)) <= set(rows(both))


def test_rank_is_the_order(spark):
    df = spark.range(500).select(F.xxhash64("id").alias("x"))
    got = keys.with_rank(df.repartition(7), [F.desc("x")]).collect()
    assert [r.x for r in sorted(got, key=lambda r: r.ordem)] == sorted((r.x for r in got), reverse=True)
    assert sorted(r.ordem for r in got) == list(range(1, 501))


def test_changed_input_files_are_read_again(spark, tmpdir_path):
    import shutil
    base = f"{tmpdir_path}/in"
    shutil.copytree(SF_SMALL, base, copy_function=shutil.copyfile)  # the inputs may be read-only files
    before = [E.queries()[q](spark, base).collect() for q in ("headline", "flat_dataset")]
    spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter("o_orderkey % 2 = 0").coalesce(1).write.parquet(f"{tmpdir_path}/half")
    shutil.copy(next(f"{tmpdir_path}/half/{f}" for f in os.listdir(f"{tmpdir_path}/half") if f.endswith(".parquet")), f"{base}/orders.parquet")
    after = [E.queries()[q](spark, base).collect() for q in ("headline", "flat_dataset")]
    assert after[0][0][0] == len(after[1]) < before[0][0][0] == len(before[1])
