"""Raw notifications -> curated normalised tables (Q1).

Steps, all as DataFrame transformations over the whole file:

1. number rows in file order (S3) after materialising the raw frame once;
2. parse the nine date columns (F3);
3. build the name -> code recovery maps of residence and notification
   municipalities (W1, J5) and repair missing / invalid codes (J4);
4. municipality dimension from both columns, first occurrence per code,
   residence before notification (E1, W1), valid codes of known states only;
5. notifications whose municipality is in the dimension (J1) and whose values
   fit their columns; the same row filter restricts every satellite (J2), and
   the other rows are kept with the reasons against them (``rejects``);
6. satellites, symptom vocabulary with ids by first appearance (K1) and the
   notification-symptom bridge (R3, J6, W2), test and dose slots (R1, R2).

Materialised (a table written to the shared checkpoint folder): the
provisional row positions before numbering, the place columns, from which the
recovery map and the municipality dimension are made, the small dimension, and
the judged rows, which ten outputs read.  Row ids must not change if a task is
re-run after an executor loss.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.cleaning import as_int, as_smallint, clean_boolean, clean_code
from ..functions.dates import parse_date
from ..functions.geo import UF_CODES, dim_estado, uf_from_ibge, valid_ibge
from ..functions.labels import tradicional
from ..operators.joins import merge_maps, name_code_map, recover_code
from ..operators.keys import dense_ids_by_first_appearance, distinct_pairs, first_by
from ..operators.reshape import explode_list, rename_select, unpivot_doses, unpivot_tests
from ..session import compiled_methods, little_disk, reliable_checkpoint
from ..sources.raw import with_file_order_id
from .rejects import reasons

# --- fixed values: raw date columns and curated column names --------------------
DATE_COLUMNS = ["dataNotificacao", "dataInicioSintomas", "dataEncerramento",
                "dataColetaTeste1", "dataColetaTeste2", "dataColetaTeste3", "dataColetaTeste4",
                "dataPrimeiraDose", "dataSegundaDose"]
DEMOGRAPHIC_COLUMNS = {"idade": "idade", "sexo": "sexo", "racaCor": "raca_cor",
                       "profissionalSaude": "is_profissional_saude",
                       "profissionalSeguranca": "is_profissional_seguranca", "cbo": "cbo"}
MANAGEMENT_COLUMNS = {
    "codigoEstrategiaCovid": "codigo_estrategia_covid",
    "codigoBuscaAtivaAssintomatico": "codigo_busca_ativa_assintomatico",
    "outroBuscaAtivaAssintomatico": "outro_busca_ativa_assintomatico",
    "codigoTriagemPopulacaoEspecifica": "codigo_triagem_populacao_especifica",
    "outroTriagemPopulacaoEspecifica": "outro_triagem_populacao_especifica",
    "codigoLocalRealizacaoTestagem": "codigo_local_realizacao_testagem",
    "outroLocalRealizacaoTestagem": "outro_local_realizacao_testagem",
}
MANAGEMENT_CODES = ["codigo_estrategia_covid", "codigo_busca_ativa_assintomatico",
                    "codigo_triagem_populacao_especifica", "codigo_local_realizacao_testagem"]
SYMPTOM_SEP = ","
# ---------------------------------------------------------------------------------


def _code_as_int(c) -> F.Column:
    """A recovered (double) code as the loader's integer: unparsable -> 0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.try_cast("int"), F.lit(0))


def number_rows(raw: DataFrame, stable: bool = False) -> DataFrame:
    """S3 + F3: file-order ids and parsed dates."""
    df = with_file_order_id(raw, "notificacao_id", start=1, stable=stable)
    return df.select(*[parse_date(c).alias(c) if c in DATE_COLUMNS else F.col(c)
                       for c in df.columns])


def recovery_map(df: DataFrame) -> DataFrame:
    """J5 over W1: merged name -> code map (notification names win)."""
    res = name_code_map(df, "municipio", "municipioIBGE", "notificacao_id")
    noti = name_code_map(df, "municipioNotificacao", "municipioNotificacaoIBGE", "notificacao_id")
    return merge_maps(res, noti)


def recover_codes(df: DataFrame, name_map: DataFrame) -> DataFrame:
    """J4 on both municipality columns (values become numeric codes)."""
    df = recover_code(df, "municipioIBGE", "municipio", name_map)
    return recover_code(df, "municipioNotificacaoIBGE", "municipioNotificacao", name_map)


def municipality_dim(rec: DataFrame) -> DataFrame:
    """E1 + W1 + F5 + P16: one row per code, first name seen (residence rows
    before notification rows, then file order); valid codes of known states."""
    # Both columns of every row from one scan; the order is one number, the
    # residence rows (0) before the notification rows.
    both = rec.select(F.inline(F.array(
        F.struct(F.col("municipioIBGE").alias("id"), F.col("municipio").alias("nome"),
                 F.col("notificacao_id").alias("place")),
        F.struct(F.col("municipioNotificacaoIBGE").alias("id"), F.col("municipioNotificacao").alias("nome"),
                 (F.col("notificacao_id") + F.lit(1 << 62)).alias("place")))))
    first = first_by(both, ["id"], "place", ["nome"])
    code = _code_as_int("id")
    dim = first.select(code.alias("municipio_ibge"), "nome", uf_from_ibge(code).alias("estado_ibge"))
    return dim.filter(valid_ibge("municipio_ibge") & F.col("estado_ibge").isin(*UF_CODES))


PLACE_COLUMNS = ["notificacao_id", "municipio", "municipioIBGE", "municipioNotificacao", "municipioNotificacaoIBGE"]


def etl_stages(spark: SparkSession, raw: DataFrame, stable: bool = False) -> dict:
    """The loader's intermediate frames: numbered/typed rows, recovery map,
    municipality dimension, and the judged rows, written once: the accepted ones
    (ten outputs read them, and the ids in them must not change on a re-run) and
    the rejected ones with their reasons (``motivos``).  ``contagem`` holds the
    numbers of both, observed in the pass that writes them."""
    with compiled_methods(spark), little_disk(spark):
        typed = number_rows(raw, stable=stable)
        # The map and the dimension need five slim columns: the wide rows are read
        # once for them and once to be judged.
        places = reliable_checkpoint(typed.select(*PLACE_COLUMNS), "places")
        name_map = reliable_checkpoint(recovery_map(places), "name-map")
        municipio = reliable_checkpoint(municipality_dim(reliable_checkpoint(recover_codes(places, name_map), "recovered-places")))
        valid_ids = municipio.select(F.col("municipio_ibge").alias("_known_mun")).distinct()
        rec = recover_codes(typed, name_map).withColumn("_mun_not", _code_as_int("municipioNotificacaoIBGE"))
        judged = (rec.join(valid_ids, F.col("_mun_not") == F.col("_known_mun"), "left")
                  .withColumn("motivos", reasons(F.col("_known_mun").isNotNull())).drop("_known_mun"))
        fine = F.size("motivos") == 0
        seen = Observation("carga")
        judged = reliable_checkpoint(judged.observe(
            seen, F.count(F.lit(1)).alias("linhas"), F.count_if(fine).alias("aceitas"), F.count_if(~fine).alias("rejeitadas")), "judged")
    return {"typed": typed, "name_map": name_map, "municipio": municipio, "accepted": judged.filter(fine).drop("motivos"),
            "rejected": judged.filter(~fine), "contagem": dict(seen.get)}


def load_balance(stages: dict) -> DataFrame:
    """Rows of a load by what became of them: accepted, and each reason (a row
    with two reasons counts for both)."""
    accepted = stages["accepted"].agg(F.lit("aceita").alias("motivo"), F.count(F.lit(1)).alias("linhas"))
    return accepted.unionByName(
        stages["rejected"].select(F.explode("motivos").alias("motivo")).groupBy("motivo").agg(F.count(F.lit(1)).alias("linhas")))


def etl_normalise(spark: SparkSession, raw: DataFrame, stable: bool = False,
                  stages: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Q1: every curated table from one raw frame.  ``raw`` holds the 57 raw
    text columns in file order."""
    st = stages or etl_stages(spark, raw, stable)
    municipio, accepted = st["municipio"], st["accepted"]
    valid_ids = municipio.select("municipio_ibge").distinct()

    notificacao = accepted.select(
        "notificacao_id", "source_id", F.col("dataNotificacao").alias("data_notificacao"),
        F.col("_mun_not").alias("municipio_notificacao_ibge"),
        uf_from_ibge("_mun_not").alias("estado_notificacao_ibge"),
        clean_boolean("excluido").alias("excluido"), clean_boolean("validado").alias("validado"))

    dados_demograficos = accepted.select(
        "notificacao_id", as_smallint("idade").alias("idade"),
        *[F.col(a).alias(b) for a, b in DEMOGRAPHIC_COLUMNS.items() if a != "idade"],
        tradicional(clean_code("codigoContemComunidadeTradicional")).alias("pertence_comunidade_tradicional"))

    dados_clinicos = accepted.select(
        "notificacao_id", F.col("dataInicioSintomas").alias("data_inicio_sintomas"),
        F.col("dataEncerramento").alias("data_encerramento"),
        F.col("classificacaoFinal").alias("classificacao_final"),
        F.col("evolucaoCaso").alias("evolucao_caso"),
        F.col("outrosSintomas").alias("outros_sintomas"),
        F.col("outrasCondicoes").alias("outras_condicoes"),
        as_int("totalTestesRealizados").alias("total_testes_realizados"))

    gestao = rename_select(accepted, {"notificacao_id": "notificacao_id", **MANAGEMENT_COLUMNS})
    dados_gestao_estrategia = gestao.select(
        "notificacao_id", *[clean_code(c).alias(c) if c in MANAGEMENT_CODES else F.col(c)
                            for c in MANAGEMENT_COLUMNS.values()])

    # Residence kept only when it is a known municipality (row kept either way).
    res = accepted.select("notificacao_id", F.col("origem").alias("origem_dados"),
                          _code_as_int("municipioIBGE").alias("_res"))
    known = valid_ids.select(F.col("municipio_ibge").alias("_known_id"))
    epi = res.join(known, F.col("_res") == F.col("_known_id"), "left")
    dados_epidemiologicos = epi.select(
        "notificacao_id", "origem_dados", F.col("_known_id").alias("municipio_residencia_ibge"),
        uf_from_ibge("_known_id").alias("estado_residencia_ibge"))

    items = explode_list(accepted, "notificacao_id", "sintomas", SYMPTOM_SEP, "nome", with_position=True)
    with little_disk(spark):
        sintoma = dense_ids_by_first_appearance(items, "nome", ["notificacao_id", "pos"], "sintoma_id")
    notificacao_sintoma = distinct_pairs(items.join(sintoma, "nome"), ["notificacao_id", "sintoma_id"])

    return {
        "estado": dim_estado(spark),
        "municipio": municipio,
        "notificacao": notificacao,
        "dados_demograficos": dados_demograficos,
        "dados_clinicos": dados_clinicos,
        "dados_epidemiologicos": dados_epidemiologicos,
        "dados_gestao_estrategia": dados_gestao_estrategia,
        "sintoma": sintoma,
        "notificacao_sintoma": notificacao_sintoma,
        "teste_laboratorial": unpivot_tests(accepted),
        "vacina_aplicada": unpivot_doses(accepted),
    }


def load(spark: SparkSession, raw_path: str, out_base: str) -> dict[str, str]:
    """The loader end to end: read raw CSV files, normalise, write every table,
    and the rejected rows beside them."""
    from ..sources.catalog import write_tables
    from ..sources.raw import read_raw
    stages = etl_stages(spark, read_raw(spark, raw_path))
    out = write_tables(etl_normalise(spark, None, stages=stages), out_base)
    out["rejeitadas"] = f"{out_base.rstrip('/')}/rejeitadas"
    stages["rejected"].write.mode("overwrite").parquet(out["rejeitadas"])
    return out
