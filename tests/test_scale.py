"""Shapes that let the loader, the purge and the log grow with their tables."""
import datetime
import os
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from vigia import session
from vigia.plans import etl, indicators, rejects, views
from vigia.sources import fixture

DAY = datetime.datetime(1995, 3, 4)
PRIORITIES = ["5-LOW", "4-NOT SPECIFIED", "1-URGENT", "2-HIGH"]


def small_tables(spark, base, orders=60):
    """Source tables of a few rows: order 1 has line 1 twice and one of every line."""
    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/{name}.parquet")
    write("region", [(0, "AFRICA"), (1, "AMERICA")], "r_regionkey int, r_name string")
    write("nation", [(0, "ALGERIA", 0), (1, "BRAZIL", 1)], "n_nationkey int, n_name string, n_regionkey int")
    write("customer", [(i, i % 2, "MACHINERY") for i in range(5)], "c_custkey long, c_nationkey int, c_mktsegment string")
    write("part", [(i, f"hot cold w{i}") for i in range(5)], "p_partkey long, p_name string")
    write("orders", [(i, i % 5, "FOP"[i % 3], DAY, PRIORITIES[i % 4]) for i in range(orders)],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string")
    lines = [(i, i % 5, 7, line, "R", "F", DAY) for i in range(orders) for line in range(1, 8)] + [(1, 4, 8, 1, "A", "O", None)]
    write("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, "
                             "l_linestatus string, l_shipdate timestamp")
    return base


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def sf(spark, tmpdir_path):
    return small_tables(spark, f"{tmpdir_path}/sf")


def test_tables_of_notifications_are_not_broadcast(spark, sf, tmpdir_path):
    made = fixture.domain_tables(spark, sf)
    for name in made:
        made[name].write.parquet(f"{tmpdir_path}/cur/{name}")
    t = {name: spark.read.parquet(f"{tmpdir_path}/cur/{name}") for name in made}
    for df in (indicators.regional_indicators(t, monthly=True, with_timestamp=False),
               indicators.regional_indicators(t, "1995-01-01", "1995-12-31", with_timestamp=False),
               views.vaccination_by_outcome(t)):
        assert "Broadcast" not in plan(df)
        assert df.count() > 0
    assert plan(views.cases_by_municipality(t)).count("BroadcastExchange") == 2  # the two dimensions


def test_raw_view_deals_line_items_once(spark, sf):
    raw = fixture.raw_notifications(spark, sf)
    dealt = [x for x in plan(raw).splitlines() if "hashpartitioning" in x and ("l_linenumber" in x or "_r#" in x)]
    assert dealt == []
    rows = raw.collect()
    assert len(rows) == 61
    one, again = [r for r in rows if r.codigoTipoTeste1 is not None and r.source_id == "1"][:2]
    assert (one.codigoTipoTeste1, one.codigoFabricanteTeste1, one.codigoResultadoTeste1, one.codigoEstadoTeste1, one.dataColetaTeste1) == \
        ("2.0", "1", "1", "F", "1995-03-04")
    assert (again.codigoTipoTeste1, again.codigoFabricanteTeste1, again.codigoResultadoTeste1, again.codigoEstadoTeste1,
            again.dataColetaTeste1, again.codigoTipoTeste2, again.lotePrimeiraDose) == ("3.0", "2", "2", "O", None, None, None)
    assert (one.dataPrimeiraDose, one.codigoLaboratorioPrimeiraDose, one.lotePrimeiraDose) == ("04/03/1995", "LAB1", "1")


def test_wide_rows_are_written_by_compiled_methods(spark, sf, monkeypatch):
    key, seen = "spark.sql.codegen.hugeMethodLimit", {}
    before = spark.conf.get(key)

    def record(df, name="stage"):
        seen[name] = spark.conf.get(key)
        return session.reliable_checkpoint(df, name)
    monkeypatch.setattr(etl, "reliable_checkpoint", record)
    stages = etl.etl_stages(spark, fixture.raw_notifications(spark, sf))
    assert seen["judged"] == session.COMPILED_METHOD == "8000"
    assert spark.conf.get(key) == before
    assert stages["contagem"]["linhas"] == 61


def test_reasons_of_long_codes(spark):
    texts = {"ok": "1.0", "short": "ab", "long": "a" * 101, "number": "0" * 100 + "7", "huge": "9" * 101, "none": None, "blank": ""}
    cols = [c for c in rejects.rules() if ":" in c]
    names = sorted({c.split(":")[1] for c in cols})
    rows = [(k, *[v if n == "codigoEstrategiaCovid" else None for n in names]) for k, v in texts.items()]
    df = spark.createDataFrame(rows, ", ".join(["k string", *[f"{n} string" for n in names]]))
    judged = df.select("k", rejects.reasons(F.col("k") != "ok").alias("m"))
    got = {r.k: r.m for r in judged.collect()}
    place, code = rejects.UNKNOWN_PLACE, "tamanho:codigoEstrategiaCovid"
    assert got["ok"] == [place]
    assert got["short"] == got["number"] == got["none"] == got["blank"] == []
    assert got["long"] == got["huge"] == [code]


def test_purge_counts_each_table_by_itself(spark, sf, monkeypatch):
    frames = []

    def record(df, name="stage"):
        frames.append((name, plan(df)))
        return session.reliable_checkpoint(df, name)
    monkeypatch.setattr(E, "reliable_checkpoint", record)
    got = {(r.tabela, r.notificacao_id): r.linhas for r in E.q_purge_excluded(spark, sf).collect()}
    counts = [p for name, p in frames if name == "purge-counts"]
    assert len(counts) == 8
    for p in counts:
        assert "Union" not in p and "REPARTITION_BY_NUM" in p
    assert not any(i % 4 == 0 for _, i in got)
    assert got[("teste_laboratorial", 1)] == 5 and got[("notificacao", 1)] == 1


def test_a_repeated_batch_is_computed_once(spark, sf, monkeypatch):
    calls, purge = [], E.q_audit_purge

    def counted(s, d):
        calls.append(d)
        return purge(s, d)
    monkeypatch.setattr(E, "q_audit_purge", counted)
    rows = E.q_audit_log_batches(spark, sf).collect()
    assert len(calls) == 1
    gone = [r for r in rows if r.tabela_afetada == "notificacao" and r.operacao == "D"]
    assert {r.notificacao_id for r in gone} >= set(range(0, 60, 4))


def shuffle_files(spark):
    """Shuffle files on disk that no removal has reached within ten seconds."""
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    for _ in range(100):
        files = found.getAllFiles()
        left = {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle_")}
        yield left
        time.sleep(0.1)


def gone_but(spark, before):
    return any(left <= before for left in shuffle_files(spark))


def test_csv_input_takes_little_disk(spark, sf, monkeypatch):
    texts = {1: 'a "quoted", text\nof two lines', 2: "back\\slash"}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").coalesce(1).write.parquet(f"{sf}/documents.parquet")
    before, seen = next(shuffle_files(spark)), {}

    def record(df, path, **options):
        seen.update(path=path, plan=plan(df), joins_gone=gone_but(spark, before))
        write_raw(df, path, **options)
    write_raw = E.write_raw
    monkeypatch.setattr(E, "write_raw", record)
    made = E.queries()["etl_csv_clinicos"](spark, sf)
    assert "Join" not in seen["plan"] and "rangepartitioning" in seen["plan"]
    assert seen["joins_gone"]
    parts = [f for f in os.listdir(seen["path"]) if f.startswith("part-")]
    assert parts and all(f.endswith(".csv.gz") for f in parts)
    assert gone_but(spark, before)
    rows = made.collect()
    assert len(rows) == 60  # of 61, one of an unknown place
    assert {r.outros_sintomas for r in rows} == {f'"{t}", \\' for t in texts.values()} | {None}
    pairs = E.queries()["etl_csv_notificacao_sintoma"](spark, sf)
    assert pairs.count() == pairs.distinct().count() == 3 * 60 + 6  # six lists end with a comma: an empty item


def test_load_leaves_no_shuffle_files(spark, sf):
    before, codec = next(shuffle_files(spark)), spark.conf.get("spark.sql.parquet.compression.codec")
    stages = etl.etl_stages(spark, fixture.raw_notifications(spark, sf))
    assert gone_but(spark, before)
    assert all(f.endswith(".zstd.parquet") for f in stages["accepted"].inputFiles())
    assert spark.conf.get("spark.sql.parquet.compression.codec") == codec
    assert stages["contagem"]["linhas"] == 61
