"""Text cleaning of raw notification fields (all Column -> Column, JVM-side).

Raw files are read with every column as string; these expressions give the
typed values.  Each one reproduces what the loader does to a single field, but
as a vectorised expression instead of a per-row Python call.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the loader's behaviour) -----------------------
# Missing-value tokens that pandas' CSV reader turns into NaN by default.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# Boolean spellings accepted by the loader (compared after upper + strip).
TRUE_TOKENS = ["TRUE", "VERDADEIRO", "SIM", "S", "1"]
FALSE_TOKENS = ["FALSE", "FALSO", "NAO", "NÃO", "N", "0"]
# -----------------------------------------------------------------------------

# Characters Python's str.strip() removes, derived from str.isspace().
PY_WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())

# Text Python's float() accepts, restricted to plain decimal/exponent forms
# (inf/nan are excluded on purpose: int(float('nan')) fails, text is kept).
_NUMERIC_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_tokens(c, tokens=NA_TOKENS) -> Column:
    """A field equal to one of the missing-value tokens becomes null."""
    c = _c(c)
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def nullify_tokens(df, tokens=NA_TOKENS):
    """S2 over every string column of a raw frame."""
    return df.select(*[null_tokens(F.col(f"`{n}`"), tokens).alias(n)
                       if t == "string" else F.col(f"`{n}`") for n, t in df.dtypes])


def strip(c) -> Column:
    """Python-style strip of surrounding whitespace."""
    return F.btrim(_c(c), F.lit(PY_WHITESPACE))


def clean_boolean(c) -> Column:
    """TRUE/VERDADEIRO/SIM/S/1 -> true, FALSE/FALSO/NAO/NÃO/N/0 -> false, else null."""
    u = F.upper(strip(c))
    return (F.when(u.isin(*TRUE_TOKENS), F.lit(True))
             .when(u.isin(*FALSE_TOKENS), F.lit(False))
             .otherwise(F.lit(None).cast("boolean")))


def clean_code(c) -> Column:
    """'' / null -> null; numeric text -> integer text (toward zero); other text kept.

    The regex guard matters: Spark's cast accepts '1d', '1f', 'nan', 'inf',
    which Python's float() either rejects or cannot turn into an int.  Values
    beyond the bigint range keep their text.
    """
    c = _c(c)
    as_long = c.try_cast("double").try_cast("bigint")
    return (F.when(c.isNull() | (c == ""), F.lit(None).cast("string"))
             .when(c.rlike(_NUMERIC_TEXT) & as_long.isNotNull(), as_long.cast("string"))
             .otherwise(c))



def to_double(c) -> Column:
    """Lenient numeric keeping null for unparsable text (pandas to_numeric coerce)."""
    d = _c(c).try_cast("double")
    return F.when(d.isNotNull() & ~F.isnan(d), d)


def as_smallint(c) -> Column:
    """Numeric text assigned to a SMALLINT column: round half away from zero,
    then narrow, as a numeric value is assigned; unparsable text is null.

    A number beyond the column's range is null here; ``out_of_range`` tells
    such rows before the cast."""
    d = to_double(c)
    return F.round(d, 0).try_cast("smallint")


def out_of_range(c, low: int, high: int) -> Column:
    """True for a numeric text whose rounded value does not fit the column."""
    d = F.round(to_double(c), 0)
    return F.coalesce((d < low) | (d > high), F.lit(False))


def as_int(c) -> Column:
    d = to_double(c)
    return F.round(d, 0).try_cast("int")


def regex_literal(sep: str) -> str:
    """Escape a literal separator for Spark's regex-based split."""
    return re.escape(sep)
