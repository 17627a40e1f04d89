"""DuckDB oracle for analytics over the loader's own output (raw -> load -> views/KPIs)."""

from __future__ import annotations

from .adapter import with_ctes
from .etl import LOADED_CTES
from .queries import cases_sql, indicator_ctes

LOADED_ORACLE = {
    "etl_cases_by_municipality": with_ctes(
        LOADED_CTES, cases_sql("notificacao_etl", "municipio_etl", "estado_etl", "clinicos_etl")),
    "etl_regional_indicators_monthly": with_ctes(
        LOADED_CTES + indicator_ctes("", None, None, True, "notificacao_etl", "testes_etl",
                                     "vacinas_etl", "clinicos_etl", "demograficos_etl"),
        "SELECT * FROM ind"),
}
