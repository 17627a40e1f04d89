"""IBGE code helpers (F5, P16) and the fixed state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: the 27 federative units (IBGE code, name, abbreviation) ----
UFS = [
    (11, "Rondônia", "RO"), (12, "Acre", "AC"), (13, "Amazonas", "AM"),
    (14, "Roraima", "RR"), (15, "Pará", "PA"), (16, "Amapá", "AP"),
    (17, "Tocantins", "TO"), (21, "Maranhão", "MA"), (22, "Piauí", "PI"),
    (23, "Ceará", "CE"), (24, "Rio Grande do Norte", "RN"), (25, "Paraíba", "PB"),
    (26, "Pernambuco", "PE"), (27, "Alagoas", "AL"), (28, "Sergipe", "SE"),
    (29, "Bahia", "BA"), (31, "Minas Gerais", "MG"), (32, "Espírito Santo", "ES"),
    (33, "Rio de Janeiro", "RJ"), (35, "São Paulo", "SP"), (41, "Paraná", "PR"),
    (42, "Santa Catarina", "SC"), (43, "Rio Grande do Sul", "RS"),
    (50, "Mato Grosso do Sul", "MS"), (51, "Mato Grosso", "MT"), (52, "Goiás", "GO"),
    (53, "Distrito Federal", "DF"),
]
# A municipality code is valid only above this value (6- or 7-digit codes).
MIN_VALID_CODE = 99999
# ------------------------------------------------------------------------------

UF_CODES = [u[0] for u in UFS]

ESTADO_SCHEMA = T.StructType([
    T.StructField("estado_ibge", T.IntegerType(), False),
    T.StructField("nome", T.StringType(), True),
    T.StructField("sigla", T.StringType(), True),
])


def valid_ibge(c) -> Column:
    """P16."""
    c = F.col(c) if isinstance(c, str) else c
    return c > F.lit(MIN_VALID_CODE)


def uf_from_ibge(c) -> Column:
    """first two digits of a valid code, else null."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(valid_ibge(c), F.substring(c.cast("string"), 1, 2).cast("int"))


def dim_estado(spark: SparkSession) -> DataFrame:
    """The literal 27-row state dimension (fixed size, always broadcast)."""
    return F.broadcast(spark.createDataFrame(UFS, ESTADO_SCHEMA))
