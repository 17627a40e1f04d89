"""Row predicates used by the views, KPIs and the feature table.

Two families differ on purpose and are kept apart by name:
case-insensitive pattern matches (views and KPIs) and case-sensitive
substring tests (the ML target).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: classification / outcome / result patterns ---------------
CONFIRMED_PATTERNS = ["%Confirmado%", "%Laboratorial%"]
DISCARDED_PATTERNS = ["%Descartado%"]
DEATH_PATTERNS = ["%Óbito%", "%Falecimento%"]
POSITIVE_TEXT_PATTERNS = ["%Positivo%", "%Detectável%"]
CONFIRMED_SUBSTRINGS = ["Confirmado", "Laboratorial"]
POSITIVE_CODE = "1"
HEALTH_WORKER_YES = "Sim"
# -----------------------------------------------------------------------------


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _any_ilike(c, patterns) -> Column:
    c = _c(c)
    out = None
    for p in patterns:
        m = c.ilike(p)
        out = m if out is None else (out | m)
    return out


def not_excluded(c="excluido") -> Column:
    """`excluido = FALSE` with SQL three-valued logic (null is dropped)."""
    return _c(c) == F.lit(False)


def is_confirmed(c="classificacao_final") -> Column:
    """ILIKE '%Confirmado%' OR ILIKE '%Laboratorial%'."""
    return _any_ilike(c, CONFIRMED_PATTERNS)


def is_discarded(c="classificacao_final") -> Column:
    """P5."""
    return _any_ilike(c, DISCARDED_PATTERNS)


def is_death(c="evolucao_caso") -> Column:
    """Folds case (Ó/ó) but not accents."""
    return _any_ilike(c, DEATH_PATTERNS)


def is_sim_ci(c="is_profissional_saude") -> Column:
    """Whole-value case-insensitive 'Sim'."""
    return _c(c).ilike(HEALTH_WORKER_YES)


def is_confirmed_cs(c="classificacao_final") -> Column:
    """Case-sensitive substring test used by the ML target."""
    c = _c(c)
    return c.contains(CONFIRMED_SUBSTRINGS[0]) | c.contains(CONFIRMED_SUBSTRINGS[1])


def positive_by_code(c="resultado_teste") -> Column:
    """Result code '1' is positive."""
    return _c(c) == F.lit(POSITIVE_CODE)


def positive_by_text(c="resultado_teste") -> Column:
    """P10: textual positive ('Positivo' / 'Detectável', also matches 'Não Detectável')."""
    return _any_ilike(c, POSITIVE_TEXT_PATTERNS)


def in_list(c, values) -> Column:
    """Membership; an empty or missing list means no filter."""
    if not values:
        return F.lit(True)
    return _c(c).isin(*list(values))


def on_or_after(a, b) -> Column:
    """P14."""
    return _c(a) >= _c(b)


def null_where(c, mask: Column) -> Column:
    """Conditional overwrite with null."""
    return F.when(mask, F.lit(None)).otherwise(_c(c))


def positive_predicate(kind: str):
    """D-1: choose how a test result counts as positive ('text' or 'code')."""
    if kind == "text":
        return positive_by_text
    if kind == "code":
        return positive_by_code
    raise ValueError(f"positive must be 'text' or 'code', not {kind!r}")
