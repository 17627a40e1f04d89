"""Storage helpers: curated tables round trip, flat CSV, views, upsert on disk, defaults."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from vigia.operators import quality
from vigia.plans import indicators, views
from vigia.sources import catalog, raw


def test_curated_tables_round_trip(spark, tmpdir_path):
    t = E._tables(spark, SF_SMALL)
    base = f"{tmpdir_path}/curated"
    catalog.write_tables(t, base)
    back = catalog.read_tables(spark, base)
    assert set(back) == set(catalog.CURATED_TABLES)
    a = sorted(map(tuple, views.cases_by_municipality(t).collect()))
    b = sorted(map(tuple, views.cases_by_municipality(back).collect()))
    assert a == b
    # notifications are partitioned by month on disk
    assert any(p.startswith("mes_particao=") for p in __import__("os").listdir(f"{base}/notificacao"))
    catalog.register_views(back)
    assert spark.sql("SELECT COUNT(*) FROM notificacao").first()[0] == t["notificacao"].count()


def test_flat_csv_round_trip(spark, tmpdir_path):
    flat = E._flat(spark, SF_SMALL)
    path = f"{tmpdir_path}/flat_csv"
    raw.export_csv(flat, path)
    back = raw.read_flat(spark, path, flat.schema)
    catalog.require_non_empty(back)
    norm = lambda df: sorted(tuple("" if x is None else str(x) for x in r) for r in df.collect())
    assert norm(back) == norm(flat.na.fill("", [c for c, t in flat.dtypes if t == "string"]))


def test_materialize_and_upsert_table(spark):
    t = E._tables(spark, SF_SMALL)
    ind = indicators.regional_indicators(t, monthly=True)
    first = indicators.upsert_table(spark, None, ind)
    path = first.inputFiles()[0].rsplit("/", 1)[0]
    again = indicators.upsert_table(spark, path, ind)
    assert again.count() == first.count() == ind.count()
    m = catalog.materialize(spark, ind.drop("data_processamento"), "ind")
    assert m.count() == ind.count()


def test_with_defaults_keeps_explicit_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, True)], "notificacao_id long, excluido boolean")
    out = quality.with_defaults(df, "notificacao").orderBy("notificacao_id").collect()
    assert [r.excluido for r in out] == [None, True]
    assert [r.validado for r in out] == [False, False]


def test_append_log(spark, tmpdir_path):
    from vigia.plans import cdc
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    log = cdc.audit_snapshots(ev, "2024-01-15 00:00:00", with_meta=True)
    catalog.append_log(log, f"{tmpdir_path}/log")
    catalog.append_log(log, f"{tmpdir_path}/log")
    back = spark.read.parquet(f"{tmpdir_path}/log")
    assert back.count() == 2 * log.count()
    assert back.filter(F.col("usuario_db").isNull()).count() == 0


def test_bucketed_catalog_joins_without_shuffle(spark):
    import io
    from contextlib import redirect_stdout
    t = E._tables(spark, SF_SMALL)
    catalog.save_bucketed(t, "vigia_test", 4)
    b = catalog.read_catalog(spark, "vigia_test")
    for df in (views.cases_by_municipality(b), indicators.regional_indicators(b, monthly=True)):
        buf = io.StringIO()
        with redirect_stdout(buf):
            df.explain()
        assert "hashpartitioning(notificacao_id" not in buf.getvalue()
    assert sorted(map(tuple, views.cases_by_municipality(b).collect())) == \
        sorted(map(tuple, views.cases_by_municipality(t).collect()))


def test_loader_from_csv_files_equals_in_memory(spark, tmpdir_path):
    """Q1 end to end: raw CSV part files (in file order) -> read_raw -> loader."""
    from vigia.plans import etl
    from vigia.sources.fixture import raw_notifications
    r = raw_notifications(spark, SF_SMALL)
    path = f"{tmpdir_path}/raw_csv"
    r.write.option("header", True).csv(path)          # sorted frame -> part files in key order
    from_csv = etl.etl_normalise(spark, raw.read_raw(spark, path))
    in_mem = etl.etl_normalise(spark, r)
    key = lambda row: tuple("" if x is None else str(x) for x in row)
    for name in ("notificacao", "dados_demograficos", "teste_laboratorial", "vacina_aplicada",
                 "sintoma", "notificacao_sintoma", "municipio"):
        a = sorted(map(tuple, from_csv[name].collect()), key=key)
        b = sorted(map(tuple, in_mem[name].collect()), key=key)
        assert a == b, name


def test_period_query_prunes_month_partitions(spark, tmpdir_path):
    import io
    from contextlib import redirect_stdout
    t = E._tables(spark, SF_SMALL)
    base = f"{tmpdir_path}/curated"
    catalog.write_tables(t, base)
    back = catalog.read_tables(spark, base)
    df = indicators.regional_indicators(back, "1995-01-01", "1995-03-31", with_timestamp=False)
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    assert "PartitionFilters: [isnotnull(mes_particao" in buf.getvalue()
    want = indicators.regional_indicators(t, "1995-01-01", "1995-03-31", with_timestamp=False)
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, want.collect()))


def test_sql_users_query_views_and_kpi_table(spark):
    t = E._tables(spark, SF_SMALL)
    assert views.register_analytic_views(t) == ["vw_casos_por_municipio", "vw_vacinacao_por_resultado",
                                                "vw_sintomas_frequentes"]
    a = sorted(map(tuple, spark.sql("SELECT * FROM vw_casos_por_municipio").collect()))
    assert a == sorted(map(tuple, views.cases_by_municipality(t).collect()))
    jan = indicators.calcular_indicadores(spark, t, "1995-01-01", "1995-01-31")
    path = jan.inputFiles()[0].rsplit("/", 1)[0]
    both = indicators.calcular_indicadores(spark, t, "1995-02-01", "1995-02-28", path)
    again = indicators.calcular_indicadores(spark, t, "1995-02-01", "1995-02-28",
                                            both.inputFiles()[0].rsplit("/", 1)[0])
    assert again.count() == both.count() == jan.count() + both.filter("periodo_inicio = '1995-02-01'").count()


def test_month_folders_prune_every_table_and_files_are_bounded(spark, tmpdir_path):
    """A one-month KPI reads one month's folders of all five tables; months
    have one file each, buckets one file each."""
    import glob
    import io
    import os
    from contextlib import redirect_stdout

    import __spark_entry__ as E
    from vigia.plans import indicators
    from vigia.sources import catalog
    t = E._tables(spark, "/root/testdata/sf0.001")
    base = f"{tmpdir_path}/m"
    catalog.write_tables({n: t[n].repartition(7) for n in ("notificacao", *catalog.MONTHLY_CHILDREN)}, base)
    names = ["notificacao", *catalog.MONTHLY_CHILDREN]
    for n in names:
        for month in glob.glob(f"{base}/{n}/mes_particao=*"):
            assert len(glob.glob(f"{month}/*.parquet")) == 1
    back = catalog.read_tables(spark, base, names)
    buf = io.StringIO()
    got = indicators.regional_indicators(back, "1996-03-01", "1996-03-31", with_timestamp=False)
    with redirect_stdout(buf):
        got.explain()
    assert "PartitionFilters: []" not in buf.getvalue()
    want = indicators.regional_indicators(t, "1996-03-01", "1996-03-31", with_timestamp=False)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    buckets = f"{tmpdir_path}/b"
    catalog.save_bucketed({"notificacao": t["notificacao"].repartition(9)}, "vigia_files", 4, base=buckets)
    assert len([f for f in os.listdir(f"{buckets}/notificacao") if f.endswith(".parquet")]) <= 4


def test_recovery_map_of_a_hot_name(spark):
    """A name on a third of the rows: the first code wins, no row of the wide
    table is sorted or shuffled by name."""
    import io
    from contextlib import redirect_stdout

    from pyspark.sql import functions as F

    from vigia.operators.joins import name_code_map, recover_code
    raw = spark.range(3000).select(
        F.col("id").alias("row"), F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("n"), F.col("id") % 50)).alias("nome"),
        F.when(F.col("id") % 7 != 0, (F.lit(1500000) + F.col("id")).cast("string")).alias("code"))
    names = name_code_map(raw, "nome", "code", "row")
    got = {r.nome: r.codigo for r in names.collect()}
    assert got["HOT"] == 1500003 and len(got) == 51
    from vigia.session import reliable_checkpoint
    done = recover_code(raw, "code", "nome", reliable_checkpoint(names))
    buf = io.StringIO()
    with redirect_stdout(buf):
        done.explain()
    assert "BroadcastHashJoin" in buf.getvalue() and "Exchange hashpartitioning" not in buf.getvalue()
    assert done.filter("code is null").count() == 0
    buf = io.StringIO()
    with redirect_stdout(buf):
        names.explain()
    assert "SortAggregate" not in buf.getvalue()
