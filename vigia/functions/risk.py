"""Batch risk score.

The dashboard scores one person typed into a form; here every notification of
the feature table is scored with the same rule, as one projection.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import HEALTH_WORKER, VAX_COMPLETE, VAX_PARTIAL

# --- fixed values: score weights and bands ------------------------------------
BASE = 0.3
AGE_60_PLUS = 0.15
AGE_40_PLUS = 0.08
FEVER = 0.20
COUGH = 0.15
DYSPNEA = 0.25
VAX_COMPLETE_DISCOUNT = 0.20
VAX_PARTIAL_DISCOUNT = 0.10
HEALTH_WORKER_EXTRA = 0.05
CEILING = 0.95
FLOOR = 0.0
LOW_BELOW = 0.3
MODERATE_BELOW = 0.6
BAND_LOW = "Baixa probabilidade"
BAND_MODERATE = "Probabilidade moderada"
BAND_HIGH = "Alta probabilidade"
# ------------------------------------------------------------------------------


def risk_score(idade="idade", febre="flg_febre", tosse="flg_tosse", dispneia="flg_dispneia",
               status_vacinal="status_vacinal", ocupacao="categoria_ocupacao") -> Column:
    """adjustments added in the form's order, then clamped to [0, 0.95].

    Absent factors add 0.0, which leaves a double unchanged, so the sum is
    bit-identical to adding only the factors present.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    zero = F.lit(0.0)
    age = col(idade)
    adj = (zero
           + F.when(age >= 60, F.lit(AGE_60_PLUS)).when(age >= 40, F.lit(AGE_40_PLUS)).otherwise(zero)
           + F.when(col(febre) == 1, F.lit(FEVER)).otherwise(zero)
           + F.when(col(tosse) == 1, F.lit(COUGH)).otherwise(zero)
           + F.when(col(dispneia) == 1, F.lit(DYSPNEA)).otherwise(zero)
           - F.when(col(status_vacinal) == VAX_COMPLETE, F.lit(VAX_COMPLETE_DISCOUNT))
              .when(col(status_vacinal) == VAX_PARTIAL, F.lit(VAX_PARTIAL_DISCOUNT)).otherwise(zero)
           + F.when(col(ocupacao) == HEALTH_WORKER, F.lit(HEALTH_WORKER_EXTRA)).otherwise(zero))
    return F.least(F.greatest(F.lit(BASE) + adj, F.lit(FLOOR)), F.lit(CEILING))


def risk_band(p="probabilidade") -> Column:
    """F27."""
    p = F.col(p) if isinstance(p, str) else p
    return (F.when(p < LOW_BELOW, F.lit(BAND_LOW))
             .when(p < MODERATE_BELOW, F.lit(BAND_MODERATE))
             .otherwise(F.lit(BAND_HIGH)))


def percent(p="probabilidade") -> Column:
    """F30."""
    p = F.col(p) if isinstance(p, str) else p
    return p * F.lit(100.0)
