"""Wide -> long reshapes and list explosion.

Slots of a wide raw row (four tests, two doses) become rows with one
``stack`` generator: a single scan, no union of per-slot scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cleaning import clean_code, regex_literal, strip
from ..functions.dates import parse_date

# --- fixed values: raw column names of the slot groups ------------------------
TEST_SLOT_COLUMNS = {  # output column -> raw column pattern ({i} = slot 1..4)
    "tipo_teste": "codigoTipoTeste{i}",
    "fabricante_teste": "codigoFabricanteTeste{i}",
    "resultado_teste": "codigoResultadoTeste{i}",
    "estado_teste": "codigoEstadoTeste{i}",
    "data_coleta": "dataColetaTeste{i}",
}
TEST_SLOTS = (1, 2, 3, 4)
DOSE_SLOT_COLUMNS = {  # output column -> raw column pattern ({d} = dose name)
    "data_aplicacao": "data{d}",
    "laboratorio": "codigoLaboratorio{d}",
    "lote": "lote{d}",
}
DOSE_SLOTS = ((1, "PrimeiraDose"), (2, "SegundaDose"))
# ------------------------------------------------------------------------------


def _stack(df: DataFrame, key: str, slots: list[tuple[int, dict[str, str]]], slot_col: str,
           out_cols: list[str]) -> DataFrame:
    n = len(slots)
    args = []
    for i, cols in slots:
        args.append(str(i))
        args += [f"`{cols[c]}`" for c in out_cols]
    expr = f"stack({n}, {', '.join(args)}) as ({slot_col}, {', '.join(out_cols)})"
    return df.selectExpr(key, expr)


def _date(df: DataFrame, c: str):
    """The column as a date: parsed if it is text, as it is if it was parsed before."""
    return F.col(c) if df.schema[c].dataType == T.DateType() else parse_date(c).alias(c)


def unpivot_tests(raw: DataFrame, key: str = "notificacao_id") -> DataFrame:
    """Four test slots -> rows; slots without a test type are skipped;
    codes cleaned ('1.0' -> '1'); the sample date is parsed."""
    out = list(TEST_SLOT_COLUMNS)
    slots = [(i, {c: p.format(i=i) for c, p in TEST_SLOT_COLUMNS.items()}) for i in TEST_SLOTS]
    long = _stack(raw, key, slots, "numero_sequencial", out).filter(F.col("tipo_teste").isNotNull())
    return long.select(
        key, F.col("numero_sequencial").cast("smallint").alias("numero_sequencial"),
        *[clean_code(c).alias(c) for c in ("tipo_teste", "fabricante_teste", "resultado_teste",
                                            "estado_teste")],
        _date(long, "data_coleta"))


def unpivot_doses(raw: DataFrame, key: str = "notificacao_id") -> DataFrame:
    """R2: two dose slots -> rows; a dose without a parsable date is skipped.
    The maker code is kept as text (the loader does not clean it)."""
    out = list(DOSE_SLOT_COLUMNS)
    slots = [(i, {c: p.format(d=d) for c, p in DOSE_SLOT_COLUMNS.items()}) for i, d in DOSE_SLOTS]
    long = _stack(raw, key, slots, "dose_numero", out)
    return (long.select(key, F.col("dose_numero").cast("smallint").alias("dose_numero"),
                        _date(long, "data_aplicacao"), "laboratorio", "lote")
            .filter(F.col("data_aplicacao").isNotNull()))


def explode_list(df: DataFrame, key: str, c: str, sep: str, out: str = "nome",
                 with_position: bool = False) -> DataFrame:
    """A delimited text cell -> one stripped item per row.

    Python's str.split semantics: a trailing separator yields an empty item,
    which is kept.  ``with_position`` adds the item's index in its cell."""
    src = df.filter(F.col(c).isNotNull())
    parts = F.split(F.col(c), regex_literal(sep))
    if with_position:
        ex = src.select(key, F.posexplode(parts).alias("pos", "_item"))
        return ex.select(key, "pos", strip("_item").alias(out))
    ex = src.select(key, F.explode(parts).alias("_item"))
    return ex.select(key, strip("_item").alias(out))


def rename_select(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep and rename columns by a {source: target} mapping, in its order."""
    return df.select(*[F.col(f"`{a}`").alias(b) for a, b in mapping.items()])
