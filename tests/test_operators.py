"""Operators on small frames: dedup order, ids, skew-safe lag, upsert, diff, checks."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from vigia.operators import aggregates, audit, keys, quality, sequence
from vigia.plans import indicators
from vigia.sources import raw


def test_concat_distinct_and_ordered(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (1, None), (2, None)], "k int, v string")
    got = {r["k"]: (r["d"], r["o"]) for r in df.groupBy("k").agg(
        aggregates.concat_distinct("v", ", ").alias("d"),
        aggregates.concat_ordered("v", ", ").alias("o")).collect()}
    assert got == {1: ("a, b", "a, b, b"), 2: (None, None)}


def test_count_where_skips_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "v string")
    assert df.agg(aggregates.count_where(F.col("v") == "a")).first()[0] == 1


def test_corr_matrix_pairwise_and_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 3.0, 5.0), (3.0, 7.0, 5.0), (None, 9.0, 5.0)],
                               "x double, y double, c double")
    m = {(r.var1, r.var2): r.r for r in aggregates.corr_matrix(df, {"x": "x", "y": "y", "c": "c"}, digits=6).collect()}
    assert m[("x", "y")] == m[("y", "x")] == 0.944911
    assert m[("x", "c")] is None and m[("c", "c")] is None
    assert m[("x", "x")] == 1.0


def test_first_by_keeps_first_in_order(spark):
    df = spark.createDataFrame([("A", 20, 2), ("A", 10, 1), ("B", 30, 5)], "nome string, code int, row int")
    got = {r.nome: r.code for r in keys.first_by(df, ["nome"], "row", ["code"]).collect()}
    assert got == {"A": 10, "B": 30}


def test_dense_ids_independent_of_partitioning(spark):
    rows = [(i, p, f"s{(i * 7 + p) % 13}") for i in range(200) for p in range(3)]
    base = spark.createDataFrame(rows, "row int, pos int, nome string")
    results = []
    for n in (1, 4, 16):
        d = keys.dense_ids_by_first_appearance(base.repartition(n), "nome", ["row", "pos"], "id")
        results.append(sorted((r.id, r.nome) for r in d.collect()))
    assert results[0] == results[1] == results[2]
    assert [i for i, _ in results[0]] == list(range(1, 14))


def test_file_order_ids_dense_and_ordered(spark, tmpdir_path):
    df = spark.range(0, 1000, numPartitions=7).select(F.col("id").alias("k"))
    out = raw.with_file_order_id(df, "rid").orderBy("rid").collect()
    assert [r.rid for r in out] == list(range(1, 1001))
    assert [r.k for r in out] == list(range(1000))


def test_csv_read_multiline_and_ids(spark, tmpdir_path):
    path = f"{tmpdir_path}/raw.csv"
    with open(path, "w", encoding="utf-8") as f:
        f.write('dataNotificacao,municipio,sintomas,excluido\n')
        f.write('2024-01-02,"Cidade A",Febre,NA\n')
        f.write('05/03/2024,"Cidade Ç","Tosse,\nFebre",1\n')
        f.write('lixo,,,\n')
        f.write('2024-01-05,X,null,0\n')
    df = raw.read_raw(spark, path)
    rows = raw.with_file_order_id(df, "notificacao_id").orderBy("notificacao_id").collect()
    assert len(rows) == 4
    assert rows[1]["sintomas"] == "Tosse,\nFebre"
    assert rows[0]["excluido"] is None and rows[3]["sintomas"] is None
    assert rows[2]["municipio"] is None


def test_previous_by_key_matches_window_under_skew(spark):
    random.seed(7)
    rows = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else random.randint(1, 40)   # user 0 holds a third of rows
        rows.append((user, i, random.randint(0, 10 ** 6), f"v{i}"))
    df = spark.createDataFrame(rows, "u int, eid int, ts int, v string")
    w = Window.partitionBy("u").orderBy("ts", "eid")
    want = sorted(map(tuple, df.withColumn("prev_v", F.lag("v").over(w)).select("eid", "prev_v").collect()))
    for n in (8, 37, None):   # explicit range partitions, and AQE-sized
        got = sequence.previous_by_key(df, "u", ["ts", "eid"], ["v"], num_partitions=n)
        assert sorted(map(tuple, got.select("eid", "prev_v").collect())) == want


def test_upsert_keeps_absent_and_is_idempotent(spark):
    cols = "municipio_ibge int, periodo_inicio string, periodo_fim string, v int"
    target = spark.createDataFrame([(1, "a", "b", 10), (2, "a", "b", 20)], cols)
    new = spark.createDataFrame([(1, "a", "b", 11), (3, "a", "b", 30)], cols)
    once = indicators.upsert(target, new)
    twice = indicators.upsert(once, new)
    exp = [(1, "a", "b", 11), (2, "a", "b", 20), (3, "a", "b", 30)]
    assert sorted(map(tuple, once.collect())) == exp
    assert sorted(map(tuple, twice.collect())) == exp


def test_audit_diff(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 1), (3, "c", 1)], "id int, s string, n int")
    new = spark.createDataFrame([(1, "a", None), (2, "B", 1), (4, "d", 2)], "id int, s string, n int")
    log = audit.audit_diff(old, new, ["id"], "t", with_meta=False).collect()
    got = {r.operacao: (r.dados_antigos, r.dados_novos) for r in log}
    assert set(got) == {"I", "U", "D"} and len(log) == 3
    assert got["D"] == ('{"id":3,"s":"c","n":1}', None)
    assert got["I"] == (None, '{"id":4,"s":"d","n":2}')
    assert got["U"] == ('{"id":2,"s":"b","n":1}', '{"id":2,"s":"B","n":1}')
    assert audit.audit_diff(old, old, ["id"], "t").count() == 0


def test_quality_checks(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame([(1, 1), (2, 3), (3, None), (4, 1)], "cid int, pid int")
    assert [r.cid for r in quality.dq_orphans(child, parent, ["pid"], ["id"]).collect()] == [2]
    dup = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d")], "k int, v string")
    assert sorted((r.k, r.n) for r in quality.dq_unique(dup, ["k"]).collect()
                  if r.k is not None) == [(1, 2)]
    assert quality.dq_unique(dup, ["k"], nulls="distinct").count() == 1


def test_cascade_delete(spark):
    t = {"notificacao": spark.createDataFrame([(1,), (2,)], "notificacao_id long"),
         "teste_laboratorial": spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "notificacao_id long, s int")}
    ids = spark.createDataFrame([(1,)], "notificacao_id long")
    out = quality.delete_notifications(t, ids)
    assert [r[0] for r in out["notificacao"].collect()] == [2]
    assert out["teste_laboratorial"].count() == 1


def test_file_order_ids_follow_files_not_packing(tmpdir_path):
    """Several raw files of different sizes, packed into few partitions:
    ids must follow (file name, line)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    sizes = {"a.csv": 5, "b.csv": 300, "c.csv": 40}
    expected = []
    for fname, n in sizes.items():
        with open(f"{tmpdir_path}/{fname}", "w") as f:
            f.write("idade,sexo\n")
            for i in range(n):
                f.write(f"{i},{fname}\n")
                expected.append((fname, str(i)))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    df = raw.read_raw(spark, tmpdir_path, columns=["idade", "sexo"], multiline=True)
    rows = raw.with_file_order_id(df, "rid").orderBy("rid").collect()
    spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [r.rid for r in rows] == list(range(1, len(expected) + 1))
    assert [(r.sexo, r.idade) for r in rows] == expected


def test_quality_report_counts_violations(spark):
    S = spark.createDataFrame
    t = {
        "estado": S([(15, "Pará", "PA"), (15, "Dup", "PAX")], "estado_ibge int, nome string, sigla string"),
        "municipio": S([(1500001, "A", 15), (1500002, "B", 99)], "municipio_ibge int, nome string, estado_ibge int"),
        "notificacao": S([(1, 1500001, 15), (2, 1599999, 15), (2, 1500001, None)],
                         "notificacao_id long, municipio_notificacao_ibge int, estado_notificacao_ibge int"),
        "dados_clinicos": S([(1, "x" * 151), (1, "ok"), (7, None)], "notificacao_id long, classificacao_final string"),
        "teste_laboratorial": S([(1, 1), (9, 2)], "notificacao_id long, numero_sequencial smallint"),
    }
    got = {(r.verificacao, r.tabela, r.colunas): r.violacoes
           for r in quality.quality_report(t).collect()}
    assert got[("chave_primaria", "estado", "estado_ibge")] == 1
    assert got[("tamanho", "estado", "sigla")] == 1
    assert got[("chave_estrangeira", "municipio", "estado_ibge")] == 1
    assert got[("chave_primaria", "notificacao", "notificacao_id")] == 1
    assert got[("chave_estrangeira", "notificacao", "municipio_notificacao_ibge")] == 1
    assert got[("chave_estrangeira", "notificacao", "estado_notificacao_ibge")] == 0
    assert got[("chave_primaria", "dados_clinicos", "notificacao_id")] == 1
    assert got[("chave_estrangeira", "dados_clinicos", "notificacao_id")] == 1
    assert got[("tamanho", "dados_clinicos", "classificacao_final")] == 1
    assert got[("chave_estrangeira", "teste_laboratorial", "notificacao_id")] == 1


def test_first_by_and_maps_independent_of_partitioning(spark):
    from vigia.operators import joins
    rows = [(i, f"m{i % 17}", None if i % 5 == 0 else str(1500000 + (i * 7) % 23)) for i in range(2000)]
    base = spark.createDataFrame(rows, "rid long, nome string, code string")
    out = []
    for n in (1, 4, 64):
        m = joins.name_code_map(base.repartition(n), "nome", "code", "rid")
        out.append(sorted(map(tuple, m.collect())))
    assert out[0] == out[1] == out[2]
    # first row in order, not any row: name m1 first appears at rid 1 with a code
    assert dict(out[0])["m1"] == float(1500000 + 7 % 23)


def test_audit_diff_applied_to_old_gives_new(spark):
    import json
    random.seed(3)
    old_rows = [(i, random.choice("abc"), random.randint(0, 3)) for i in range(300)]
    new_rows = [(i, s if i % 7 else s.upper(), n) for i, s, n in old_rows if i % 11] + \
               [(i, "z", None) for i in range(300, 330)]
    schema = "id int, s string, n int"
    old = spark.createDataFrame(old_rows, schema)
    new = spark.createDataFrame(new_rows, schema)
    log = audit.audit_diff(old, new, ["id"], "t", with_meta=False).collect()
    state = {r[0]: r for r in old_rows}
    for r in log:
        if r.operacao == "D":
            del state[json.loads(r.dados_antigos)["id"]]
        else:
            img = json.loads(r.dados_novos)
            state[img["id"]] = (img["id"], img["s"], img["n"])
    assert sorted(state.values(), key=lambda x: x[0]) == sorted(new_rows, key=lambda x: x[0])


def test_dashboard_ordered_outputs(spark):
    from vigia.plans import dashboard
    import datetime as dt
    rows = [(dt.date(2021, m, 1), m % 2, "Parcial" if m % 3 else "Esquema Completo", "F" if m % 2 else "M")
            for m in range(1, 13)] + [(dt.date(2020, 12, 5), 1, "Parcial", "F")]
    f = spark.createDataFrame(rows, "data_notificacao date, target_confirmado int, status_vacinal string, sexo string")
    months = [r.ano_mes for r in dashboard.monthly_rate(f, ordered=True).collect()]
    assert months == sorted(months) and months[0] == "2020-12"
    keys = [(r.status_vacinal, r.target_confirmado) for r in dashboard.vaccine_status_x_target(f, ordered=True).collect()]
    assert keys == sorted(keys)
    d = [(r.sexo, r.total) for r in dashboard.distribution(f, "sexo", ordered=True).collect()]
    assert d == [("F", 7), ("M", 6)]


def test_facet_ordered(spark):
    from vigia.plans import dashboard
    f = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("Á",)], "municipio_nome string")
    assert [r[0] for r in dashboard.facet_municipalities(f, ordered=True).collect()] == sorted(["a", "b", "Á"])
