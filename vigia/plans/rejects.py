"""Raw rows that the declared columns cannot hold (C4, C5 before the cast).

A relational store refuses such a row at its insert.  Here each raw row gets
the list of its reasons in the same pass that writes the loader's rows, so a
load accounts for every row: accepted, or put aside with the reasons.

* ``municipio_desconhecido``: the municipality is not in the dimension;
* ``faixa:<column>``: a number beyond the range of its integer column;
* ``tamanho:<column>``: a text longer than its column (a code: after cleaning;
  the symptom list: any of its items).

Text that is no number in a numeric column is null, as the loader reads it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.cleaning import clean_code, out_of_range, regex_literal, strip
from ..operators.quality import SMALLINT_RANGE, VARCHAR_LIMITS

UNKNOWN_PLACE = "municipio_desconhecido"

# --- fixed values: where raw columns go (curated table, column) -------------------
INTEGER_RANGE = (-2147483648, 2147483647)
NUMBERS = {"idade": SMALLINT_RANGE, "totalTestesRealizados": INTEGER_RANGE}
TEXTS = {
    "source_id": ("notificacao", "source_id"), "sexo": ("dados_demograficos", "sexo"),
    "racaCor": ("dados_demograficos", "raca_cor"),
    "profissionalSaude": ("dados_demograficos", "is_profissional_saude"),
    "profissionalSeguranca": ("dados_demograficos", "is_profissional_seguranca"),
    "cbo": ("dados_demograficos", "cbo"),
    "classificacaoFinal": ("dados_clinicos", "classificacao_final"),
    "evolucaoCaso": ("dados_clinicos", "evolucao_caso"), "origem": ("dados_epidemiologicos", "origem_dados"),
    "outroBuscaAtivaAssintomatico": ("dados_gestao_estrategia", "outro_busca_ativa_assintomatico"),
    "outroTriagemPopulacaoEspecifica": ("dados_gestao_estrategia", "outro_triagem_populacao_especifica"),
    "outroLocalRealizacaoTestagem": ("dados_gestao_estrategia", "outro_local_realizacao_testagem"),
    "codigoLaboratorioPrimeiraDose": ("vacina_aplicada", "laboratorio"),
    "codigoLaboratorioSegundaDose": ("vacina_aplicada", "laboratorio"),
    "lotePrimeiraDose": ("vacina_aplicada", "lote"), "loteSegundaDose": ("vacina_aplicada", "lote"),
}
CODES = {
    "codigoEstrategiaCovid": ("dados_gestao_estrategia", "codigo_estrategia_covid"),
    "codigoBuscaAtivaAssintomatico": ("dados_gestao_estrategia", "codigo_busca_ativa_assintomatico"),
    "codigoTriagemPopulacaoEspecifica": ("dados_gestao_estrategia", "codigo_triagem_populacao_especifica"),
    "codigoLocalRealizacaoTestagem": ("dados_gestao_estrategia", "codigo_local_realizacao_testagem"),
}
TEST_CODES = {"codigoTipoTeste": "tipo_teste", "codigoFabricanteTeste": "fabricante_teste",
              "codigoResultadoTeste": "resultado_teste", "codigoEstadoTeste": "estado_teste"}
TEST_SLOTS = range(1, 5)
BIGINT_CHARS = 20  # of the longest bigint's text, a minus sign included
# ------------------------------------------------------------------------------------


def rules(symptom_sep: str = ",") -> dict[str, Column]:
    """Each reason with its condition (null counts as false)."""
    out = {}
    for c, (low, high) in NUMBERS.items():
        out[f"faixa:{c}"] = out_of_range(c, low, high)
    for c, (table, column) in TEXTS.items():
        out[f"tamanho:{c}"] = F.length(c) > VARCHAR_LIMITS[table][column]
    codes = dict(CODES)
    for stem, column in TEST_CODES.items():
        codes.update({f"{stem}{i}": ("teste_laboratorial", column) for i in TEST_SLOTS})
    for c, (table, column) in codes.items():
        limit = VARCHAR_LIMITS[table][column]
        long = F.length(clean_code(c)) > limit
        # A cleaned text is the text itself or a bigint: where the column holds
        # every bigint, the patterns are tried only on texts beyond its length.
        out[f"tamanho:{c}"] = (F.length(c) > limit) & long if limit >= BIGINT_CHARS else long
    longest = VARCHAR_LIMITS["sintoma"]["nome"]
    out["tamanho:sintomas"] = F.exists(F.split("sintomas", regex_literal(symptom_sep)), lambda x: F.length(strip(x)) > longest)
    return out


def reasons(known_place: Column) -> Column:
    """The reasons against a row, an empty list if it can be loaded."""
    found = {UNKNOWN_PLACE: ~known_place, **rules()}
    # The list is put together (by an interpreted function) only where there is
    # a reason; most rows have none and take the compiled conditions alone.
    some = reduce(lambda a, b: a | b, [F.coalesce(condition, F.lit(False)) for condition in found.values()])
    named = F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in found.items()]))
    return F.when(some, named).otherwise(F.array().cast("array<string>"))
