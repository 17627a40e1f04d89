"""Curated surveillance tables derived from the provided star-schema tables.

No notification data ships with the project, so the test tables are mapped
onto the surveillance model by fixed rules (one notification per order, test
and vaccine slots from line items, symptoms from part-name words).  The same
rules are written in SQL for the DuckDB oracle (``oracle/adapter.py``).

All frames are lazy; nothing is collected.  Every output grows with the input
tables, so the queries built on them do real work at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window
from pyspark.sql import functions as F

# --- fixed values: mapping rules of the test-data adapter ---------------------
SEX_BY_CUSTKEY_MOD3 = ["Masculino", "Feminino", "Ignorado"]
SEGMENT_HEALTH_WORKER = {"MACHINERY": "Sim", "BUILDING": "SIM"}
HEALTH_WORKER_OTHER = "Não"
STATUS_CLASSIFICATION = {"F": "Confirmado Laboratorial", "O": "Descartado"}
PENDING_EVEN_CLASSIFICATION = "CONFIRMADO CLÍNICO"
OUTCOME_BY_KEY_MOD7 = {0: "ÓBITO", 1: "Cura"}
RESULT_CODE_BY_FLAG = {"R": "1", "A": "2", "N": "3"}
SYMPTOM_WORDS = {"hot": "Febre", "cold": "Tosse", "old": "Dispneia",
                 "new": "falta de ar", "blue": "Dor de Garganta"}
TEST_SLOTS_MAX_LINE = 4
DOSE_LINES = (5, 6)
SYMPTOM_LINE = 7
ORIGIN = "notificacao-online"
# ------------------------------------------------------------------------------

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events"]


def read_source(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def input_stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """The state of the input files: names, sizes and times of change."""
    path = spark._jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


# Table definitions are lazy plans; defining them once per session and folder
# avoids re-listing files and re-analysing the same expressions for every
# query (the data itself is read by each query, nothing is cached).
_DEFINED: dict[tuple, dict[str, DataFrame]] = {}


def session_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """``domain_tables`` defined once per (live session, folder and its files)."""
    key = (id(spark), id(spark.sparkContext), sf_dir.rstrip("/"), input_stamp(spark, sf_dir))
    got = _DEFINED.get(key)
    if got is None or spark.sparkContext._jsc is None:
        got = domain_tables(spark, sf_dir)
        _DEFINED.clear()
        _DEFINED[key] = got
    return got


def _map(col, mapping: dict, default=None):
    out = None
    for k, v in mapping.items():
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default) if default is not None else F.lit(None).cast("string"))


def domain_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The curated model (banco.sql shape) over the test tables."""
    rd = lambda n: read_source(spark, sf_dir, n)
    region, nation, customer = rd("region"), rd("nation"), rd("customer")
    orders, lineitem, part = rd("orders"), rd("lineitem"), rd("part")

    estado = region.select(
        F.col("r_regionkey").cast("int").alias("estado_ibge"),
        F.col("r_name").alias("nome"),
        F.substring("r_name", 1, 2).alias("sigla"))

    municipio = nation.select(
        F.col("n_nationkey").cast("int").alias("municipio_ibge"),
        F.col("n_name").alias("nome"),
        F.col("n_regionkey").cast("int").alias("estado_ibge"))

    # One row per order with its customer's nation/region: shared by the
    # notification fact and its demographic / epidemiological satellites.
    oc = (orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
          .join(customer.select("c_custkey", "c_nationkey", "c_mktsegment"),
                F.col("o_custkey") == F.col("c_custkey"))
          .join(nation.select("n_nationkey", "n_regionkey"),
                F.col("c_nationkey") == F.col("n_nationkey")))

    prio = F.col("o_orderpriority")
    notificacao = oc.select(
        F.col("o_orderkey").alias("notificacao_id"),
        F.col("o_custkey").cast("string").alias("source_id"),
        F.col("o_orderdate").cast("date").alias("data_notificacao"),
        F.col("c_nationkey").cast("int").alias("municipio_notificacao_ibge"),
        F.col("n_regionkey").cast("int").alias("estado_notificacao_ibge"),
        F.when(prio == "5-LOW", F.lit(True))
         .when(prio == "4-NOT SPECIFIED", F.lit(None).cast("boolean"))
         .otherwise(F.lit(False)).alias("excluido"),
        (prio == "1-URGENT").alias("validado"))

    sexo = _map(F.col("o_custkey") % 3, dict(enumerate(SEX_BY_CUSTKEY_MOD3)))
    dados_demograficos = oc.select(
        F.col("o_orderkey").alias("notificacao_id"),
        ((F.col("o_orderkey") % 130).cast("int") - 5).cast("smallint").alias("idade"),
        sexo.alias("sexo"),
        F.col("c_mktsegment").alias("raca_cor"),
        _map(F.col("c_mktsegment"), SEGMENT_HEALTH_WORKER, HEALTH_WORKER_OTHER).alias("is_profissional_saude"),
        F.lit(HEALTH_WORKER_OTHER).alias("is_profissional_seguranca"),
        F.lit(None).cast("string").alias("cbo"),
        F.lit(None).cast("boolean").alias("pertence_comunidade_tradicional"))

    st, key = F.col("o_orderstatus"), F.col("o_orderkey")
    classificacao = (F.when(st == "F", F.lit(STATUS_CLASSIFICATION["F"]))
                      .when(st == "O", F.lit(STATUS_CLASSIFICATION["O"]))
                      .when((st == "P") & (key % 2 == 0), F.lit(PENDING_EVEN_CLASSIFICATION))
                      .otherwise(F.lit(None).cast("string")))
    dados_clinicos = orders.select(
        key.alias("notificacao_id"),
        F.date_sub(F.col("o_orderdate").cast("date"), (key % 15).cast("int")).alias("data_inicio_sintomas"),
        F.lit(None).cast("date").alias("data_encerramento"),
        classificacao.alias("classificacao_final"),
        _map(key % 7, OUTCOME_BY_KEY_MOD7).alias("evolucao_caso"),
        F.lit(None).cast("string").alias("outros_sintomas"),
        F.lit(None).cast("string").alias("outras_condicoes"),
        F.lit(None).cast("int").alias("total_testes_realizados"))

    dados_epidemiologicos = oc.select(
        F.col("o_orderkey").alias("notificacao_id"),
        F.lit(ORIGIN).alias("origem_dados"),
        F.col("c_nationkey").cast("int").alias("municipio_residencia_ibge"),
        F.col("n_regionkey").cast("int").alias("estado_residencia_ibge"))

    dados_gestao_estrategia = orders.select(
        key.alias("notificacao_id"),
        F.substring("o_orderpriority", 1, 1).alias("codigo_estrategia_covid"),
        *[F.lit(None).cast("string").alias(c) for c in (
            "codigo_busca_ativa_assintomatico", "outro_busca_ativa_assintomatico",
            "codigo_triagem_populacao_especifica", "outro_triagem_populacao_especifica",
            "codigo_local_realizacao_testagem", "outro_local_realizacao_testagem")])

    li = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                         "l_returnflag", "l_linestatus", "l_shipdate")
    teste_laboratorial = (li.filter(F.col("l_linenumber") <= TEST_SLOTS_MAX_LINE).select(
        F.col("l_orderkey").alias("notificacao_id"),
        F.col("l_linenumber").cast("smallint").alias("numero_sequencial"),
        (F.col("l_suppkey") % 5).cast("string").alias("tipo_teste"),
        (F.col("l_suppkey") % 3).cast("string").alias("fabricante_teste"),
        _map(F.col("l_returnflag"), RESULT_CODE_BY_FLAG).alias("resultado_teste"),
        F.col("l_linestatus").alias("estado_teste"),
        F.col("l_shipdate").cast("date").alias("data_coleta")))

    vacina_aplicada = (li.filter(F.col("l_linenumber").isin(*DOSE_LINES)).select(
        F.col("l_orderkey").alias("notificacao_id"),
        (F.col("l_linenumber") - 4).cast("smallint").alias("dose_numero"),
        F.col("l_shipdate").cast("date").alias("data_aplicacao"),
        F.concat(F.lit("LAB"), (F.col("l_partkey") % 4).cast("string")).alias("laboratorio"),
        F.col("l_partkey").cast("string").alias("lote")))

    word = F.explode(F.split(F.col("p_name"), " ")).alias("w")
    symptom_names = (li.filter(F.col("l_linenumber") == SYMPTOM_LINE)
                     .join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
                     .select(F.col("l_orderkey").alias("notificacao_id"), word)
                     .select("notificacao_id",
                             _map(F.col("w"), SYMPTOM_WORDS, None).alias("mapped"), "w")
                     .select("notificacao_id", F.coalesce("mapped", "w").alias("nome"))
                     .distinct())
    # Surrogate symptom ids of the test data are a deterministic function of
    # the name (no global numbering, no join back); the names are what every
    # query reports, and the quality report checks the ids stay unique.
    sid = F.xxhash64("nome").alias("sintoma_id")
    sintoma = symptom_names.select("nome").distinct().select(sid, "nome")
    notificacao_sintoma = symptom_names.select("notificacao_id", sid)

    return {
        "estado": estado,
        "municipio": municipio,
        "notificacao": notificacao,
        "dados_demograficos": dados_demograficos,
        "dados_clinicos": dados_clinicos,
        "dados_epidemiologicos": dados_epidemiologicos,
        "dados_gestao_estrategia": dados_gestao_estrategia,
        "sintoma": sintoma,
        "notificacao_sintoma": notificacao_sintoma,
        "teste_laboratorial": teste_laboratorial,
        "vacina_aplicada": vacina_aplicada,
    }


# --- fixed values: how the raw-file view of the test data is written ----------
UF_BY_REGION = [15, 13, 29, 35, 43]   # region key -> a federative-unit code
UNKNOWN_PLACE = "Desconhecido"
# ------------------------------------------------------------------------------


def raw_notifications(spark: SparkSession, sf_dir: str, free_text: bool = False, faults: bool = False) -> DataFrame:
    """The notification table as a raw file would carry it: one wide row of
    57 text fields per order, in order-key order (the "file order").  An order
    that has a line number more than once takes as many rows as that number
    occurs, so that every line item keeps its own slot in some row.

    ``free_text`` fills the free-text symptoms field: the text of the document
    whose id is the order key, between quotes, with a backslash at its end.

    ``faults`` writes values that their columns cannot hold, by rules on the
    order key: ages and test counts beyond the range, texts beyond the length.

    Values are written the way real exports mix them, by fixed rules on the
    order key: three date layouts, codes as '1.0' floats, blank municipality
    codes to be recovered from the name, an unknown municipality that the
    loader must reject, half-units of age, a trailing comma in the symptom
    list.  Test and dose slots are the line items pivoted wide (one shuffle
    by order key); symptoms are the part-name words per order.
    """
    return raw_fields(raw_rows(spark, sf_dir, free_text), faults)


def raw_rows(spark: SparkSession, sf_dir: str, free_text: bool = False) -> DataFrame:
    """What the fields of ``raw_notifications`` are made from: one slim row per
    raw row, in no order.  Line items are pivoted (one shuffle by order key)."""
    rd = lambda n: read_source(spark, sf_dir, n)
    orders, customer, nation = rd("orders"), rd("customer"), rd("nation")
    lineitem, part = rd("lineitem"), rd("part")

    ln = F.col("l_linenumber")
    # The aggregate carries the line items' own values (numbers, but for the
    # status); ``raw_fields`` makes their texts: slim rows in the sort.
    flag_code = _map(F.col("l_returnflag"), RESULT_CODE_BY_FLAG).cast("int")
    slot_values = {"_supp{i}": F.col("l_suppkey"), "_flag{i}": flag_code, "codigoEstadoTeste{i}": F.col("l_linestatus"),
                   "_ship{i}": F.col("l_shipdate").cast("date")}
    dose_values = {"_ship{i}": F.col("l_shipdate").cast("date"), "_part{i}": F.col("l_partkey")}
    aggs = [F.count_if(ln <= TEST_SLOTS_MAX_LINE).alias("_n_tests")]
    for i in range(1, TEST_SLOTS_MAX_LINE + 1):
        aggs += [F.max(F.when(ln == i, v)).alias(p.format(i=i)) for p, v in slot_values.items()]
    for line in DOSE_LINES:
        aggs += [F.max(F.when(ln == line, v)).alias(p.format(i=line)) for p, v in dose_values.items()]
    # Line numbers repeat within some orders: the r-th item of a number goes to
    # the order's r-th row (items of an order are few, so the window is small).
    # Dealt by order once: the window, the aggregate and the join below all
    # find their rows together.
    same_line = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    items = lineitem.filter(ln <= max(DOSE_LINES)).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag", "l_linestatus")
    numbered = items.repartition("l_orderkey").withColumn("_r", F.row_number().over(same_line))
    wide = numbered.groupBy(F.col("l_orderkey").alias("_k"), "_r").agg(*aggs)

    words = (lineitem.filter(ln == SYMPTOM_LINE)
             .join(part.select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
             .select(F.col("l_orderkey").alias("_k"), F.explode(F.split("p_name", " ")).alias("w"))
             .select("_k", F.coalesce(_map(F.col("w"), SYMPTOM_WORDS, None), F.col("w")).alias("nome")))
    symptoms = words.groupBy("_k").agg(F.array_join(F.array_sort(F.collect_set("nome")), ", ").alias("_s"))

    base = (orders.join(customer.select("c_custkey", "c_nationkey", "c_mktsegment"),
                        F.col("o_custkey") == F.col("c_custkey"))
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(wide, F.col("o_orderkey") == F.col("_k"), "left").drop("_k")
            .join(symptoms, F.col("o_orderkey") == F.col("_k"), "left"))

    if free_text:
        documents = read_source(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("_text"))
        base = base.join(documents, F.col("o_orderkey") == F.col("doc_id"), "left").drop("doc_id")
    else:
        base = base.withColumn("_text", F.lit(None).cast("string"))
    return base.select("o_orderkey", "_r", "o_custkey", "o_orderstatus", F.col("o_orderdate").cast("date").alias("o_orderdate"),
                       "o_orderpriority", "c_mktsegment", "n_nationkey", "n_name", "n_regionkey",
                       *[a for a in wide.columns if a not in ("_k", "_r")], "_s", "_text")


def raw_fields(base: DataFrame, faults: bool = False) -> DataFrame:
    """The 57 text fields of ``raw_rows``, in order-key order."""
    slot_texts = {}
    for i in range(1, TEST_SLOTS_MAX_LINE + 1):
        slot_texts |= {
            f"codigoTipoTeste{i}": F.concat((F.col(f"_supp{i}") % 5).cast("string"), F.lit(".0")),
            f"codigoFabricanteTeste{i}": (F.col(f"_supp{i}") % 3).cast("string"),
            f"codigoResultadoTeste{i}": F.col(f"_flag{i}").cast("string"),
            f"dataColetaTeste{i}": F.date_format(f"_ship{i}", "yyyy-MM-dd"),
        }
    for line, d in zip(DOSE_LINES, ("PrimeiraDose", "SegundaDose")):
        slot_texts |= {
            f"data{d}": F.date_format(f"_ship{line}", "dd/MM/yyyy"),
            f"codigoLaboratorio{d}": F.concat(F.lit("LAB"), (F.col(f"_part{line}") % 4).cast("string")),
            f"lote{d}": F.col(f"_part{line}").cast("string"),
        }
    key = F.col("o_orderkey")
    d = F.col("o_orderdate")
    iso = F.date_format(d, "yyyy-MM-dd")
    code = (_map(F.col("n_regionkey"), dict(enumerate(UF_BY_REGION)), None).cast("int") * 100000
            + F.col("n_nationkey") + 1).cast("string")
    unknown = key % 50 == 13
    age = (key % 130).cast("int") - 5
    prio, st = F.col("o_orderpriority"), F.col("o_orderstatus")
    null = F.lit(None).cast("string")
    fields = {
        **slot_texts,
        "dataNotificacao": F.when(key % 3 == 0, iso)
                            .when(key % 3 == 1, F.date_format(d, "dd/MM/yyyy"))
                            .otherwise(F.concat(iso, F.lit("T08:30:00.000Z"))),
        "dataInicioSintomas": F.date_format(F.date_sub(d, (key % 15).cast("int")), "dd/MM/yyyy"),
        "dataEncerramento": null,
        "municipio": F.col("n_name"),
        "municipioIBGE": F.when(key % 10 == 3, null).otherwise(code),
        "municipioNotificacao": F.when(unknown, F.lit(UNKNOWN_PLACE)).otherwise(F.col("n_name")),
        "municipioNotificacaoIBGE": F.when(unknown, F.lit("0"))
                                     .when(key % 10 == 7, F.concat(code, F.lit(".0")))
                                     .when(key % 20 == 11, null).otherwise(code),
        "excluido": F.when(prio == "5-LOW", F.lit("Sim")).when(prio == "4-NOT SPECIFIED", null)
                     .otherwise(F.lit("Não")),
        "validado": F.when(prio == "1-URGENT", F.lit("1")).otherwise(F.lit("0")),
        "source_id": F.col("o_custkey").cast("string"),
        "idade": F.when(key % 9 == 4, F.concat(age.cast("string"), F.lit(".5")))
                  .otherwise(age.cast("string")),
        "sexo": _map(F.col("o_custkey") % 3, dict(enumerate(SEX_BY_CUSTKEY_MOD3))),
        "racaCor": F.col("c_mktsegment"),
        "profissionalSaude": _map(F.col("c_mktsegment"), SEGMENT_HEALTH_WORKER, HEALTH_WORKER_OTHER),
        "profissionalSeguranca": F.lit(HEALTH_WORKER_OTHER),
        "cbo": null,
        "codigoContemComunidadeTradicional": F.when(F.col("o_custkey") % 3 == 0, F.lit("1.0"))
                                              .when(F.col("o_custkey") % 3 == 1, F.lit("2")),
        "classificacaoFinal": F.when(st == "F", F.lit(STATUS_CLASSIFICATION["F"]))
                               .when(st == "O", F.lit(STATUS_CLASSIFICATION["O"]))
                               .when((st == "P") & (key % 2 == 0), F.lit(PENDING_EVEN_CLASSIFICATION)),
        "evolucaoCaso": _map(key % 7, OUTCOME_BY_KEY_MOD7),
        "totalTestesRealizados": F.when(F.col("_n_tests") > 0, F.col("_n_tests").cast("string")),
        "outrosSintomas": F.concat(F.lit('"'), F.col("_text"), F.lit('", \\')),
        "outrasCondicoes": null,
        "codigoEstrategiaCovid": F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0")),
        "codigoBuscaAtivaAssintomatico": F.when(key % 2 == 0, F.lit("2")),
        "outroBuscaAtivaAssintomatico": null,
        "codigoTriagemPopulacaoEspecifica": null,
        "outroTriagemPopulacaoEspecifica": null,
        "codigoLocalRealizacaoTestagem": F.when(key % 4 == 1, F.lit("1e1")),
        "outroLocalRealizacaoTestagem": null,
        "origem": F.lit(ORIGIN),
        "sintomas": F.when(key % 8 == 5, F.concat(F.col("_s"), F.lit(","))).otherwise(F.col("_s")),
    }
    if faults:
        fields["idade"] = F.when(key % 97 == 5, F.lit("70000")).when(key % 97 == 6, F.lit("-40000.5")).otherwise(fields["idade"])
        fields["totalTestesRealizados"] = F.when(key % 103 == 11, F.lit("3e9")).otherwise(fields["totalTestesRealizados"])
        fields["racaCor"] = F.when(key % 101 == 7, F.repeat(fields["racaCor"], 9)).otherwise(fields["racaCor"])
        fields["sintomas"] = F.when(key % 89 == 3, F.concat_ws(", ", fields["sintomas"], F.repeat(F.lit("x"), 201))).otherwise(fields["sintomas"])
        fields["codigoEstrategiaCovid"] = F.when(key % 107 == 2, F.repeat(F.lit("9a"), 51)).otherwise(fields["codigoEstrategiaCovid"])
    from .raw import RAW_COLUMNS
    cols = [fields[c].cast("string").alias(c) if c in fields else F.col(c) for c in RAW_COLUMNS]
    return base.orderBy("o_orderkey", "_r").select(*cols)
