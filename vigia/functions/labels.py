"""Categorical labels of the feature table and the views."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import null_where, is_confirmed_cs

# --- fixed values: labels shown to users --------------------------------------
# Age bands, right-closed: (0,12] (12,19] (19,39] (39,59] (59,79] (79,120].
AGE_BANDS = [
    (0, 12, "Criança (0-12)"),
    (12, 19, "Adolescente (13-19)"),
    (19, 39, "Jovem Adulto (20-39)"),
    (39, 59, "Adulto (40-59)"),
    (59, 79, "Idoso (60-79)"),
    (79, 120, "Super Idoso (80+)"),
]
AGE_MIN, AGE_MAX = 0, 120
HEALTH_WORKER = "Profissional de Saúde"
OTHER_OCCUPATION = "Outros"
# Feature-table vaccine status.
VAX_COMPLETE = "Esquema Completo"
VAX_PARTIAL = "Parcial"
VAX_NONE = "Não Vacinado"
# View vaccine status (partial label differs from the feature table).
VAX_PARTIAL_VIEW = "Parcial (1 Dose)"
# Aggregated test result.
RESULT_POSITIVE = "Positivo"
RESULT_NEGATIVE = "Negativo/Inconclusivo"
RESULT_NOT_TESTED = "Não Testado"
# Null defaults.
NO_SYMPTOMS = "Assintomático/Não Informado"
UNDER_REVIEW = "Em Análise"
UNDER_TREATMENT = "Em Tratamento/Ignorado"
# Traditional-community codes.
TRADITIONAL_YES_CODE = "2"
TRADITIONAL_NO_CODE = "1"
# ------------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_age(c="idade") -> Column:
    """ages below 0 or above 120 become null."""
    c = _c(c)
    return null_where(c, (c < AGE_MIN) | (c > AGE_MAX))


def age_band(c="idade", include_zero: bool = False) -> Column:
    """right-closed bands; age 0 has no band unless include_zero."""
    c = _c(c)
    out = F
    for i, (lo, hi, label) in enumerate(AGE_BANDS):
        lower = (c >= lo) if (include_zero and i == 0) else (c > lo)
        cond = lower & (c <= hi)
        out = out.when(cond, F.lit(label))
    return out.otherwise(F.lit(None).cast("string"))


def occupation(c="is_profissional_saude") -> Column:
    """exactly 'Sim' is a health worker; anything else, null included, is 'Outros'."""
    return F.when(_c(c) == F.lit("Sim"), F.lit(HEALTH_WORKER)).otherwise(F.lit(OTHER_OCCUPATION))


def target(c="classificacao_final") -> Column:
    """null -> null, contains Confirmado/Laboratorial (case-sensitive) -> 1, else 0."""
    c = _c(c)
    return (F.when(c.isNull(), F.lit(None).cast("int"))
             .when(is_confirmed_cs(c), F.lit(1))
             .otherwise(F.lit(0)))


def vax_status_flat(n="total_doses") -> Column:
    """>=2 complete, 1 partial, otherwise (null included) not vaccinated."""
    n = _c(n)
    return (F.when(n >= 2, F.lit(VAX_COMPLETE))
             .when(n == 1, F.lit(VAX_PARTIAL))
             .otherwise(F.lit(VAX_NONE)))


def vax_status_view(n="qtd_doses") -> Column:
    """F16: null/0 not vaccinated, 1 'Parcial (1 Dose)', >=2 complete."""
    n = _c(n)
    return (F.when(n.isNull() | (n == 0), F.lit(VAX_NONE))
             .when(n == 1, F.lit(VAX_PARTIAL_VIEW))
             .when(n >= 2, F.lit(VAX_COMPLETE)))


def test_result(flag="houve_teste_positivo", n="qtd_testes_realizados") -> Column:
    """F17."""
    return (F.when(_c(flag) == 1, F.lit(RESULT_POSITIVE))
             .when(_c(n) > 0, F.lit(RESULT_NEGATIVE))
             .otherwise(F.lit(RESULT_NOT_TESTED)))


def tradicional(c) -> Column:
    """code '2' -> true, '1' -> false, anything else -> null."""
    c = _c(c)
    return (F.when(c == F.lit(TRADITIONAL_YES_CODE), F.lit(True))
             .when(c == F.lit(TRADITIONAL_NO_CODE), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))
