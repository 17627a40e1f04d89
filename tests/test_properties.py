"""Property tests: Spark expressions vs Python models of the loader's field rules.

Each hypothesis example is a list of values evaluated in one Spark job."""

import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigia.functions import cleaning, dates

NUMERIC_ALPHABET = "0123456789.-+eE x"


def model_clean_code(v):
    """Numeric text -> integer text truncated toward zero; other text unchanged."""
    if v is None or v == "":
        return None
    try:
        x = float(v)
    except ValueError:
        return v
    if math.isnan(x) or math.isinf(x):
        return v
    return str(math.trunc(x))


def model_clean_boolean(v):
    if v is None:
        return None
    u = v.upper().strip()
    if u in {"TRUE", "VERDADEIRO", "SIM", "S", "1"}:
        return True
    if u in {"FALSE", "FALSO", "NAO", "NÃO", "N", "0"}:
        return False
    return None


def model_parse_date(v):
    if v is None:
        return None
    s = v.strip()
    for fmt in ("%Y-%m-%d", "%d/%m/%Y"):
        try:
            if fmt == "%Y-%m-%d" and len(s) != 10:
                raise ValueError
            return dt.datetime.strptime(s, fmt).date()
        except ValueError:
            pass
    return None


def evaluate(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def _fits_long(v):
    try:
        return abs(float(v)) < 9e18
    except ValueError:
        return True


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=NUMERIC_ALPHABET, max_size=8).filter(_fits_long), min_size=1, max_size=60))
def test_clean_code_matches_model(spark, values):
    assert evaluate(spark, values, cleaning.clean_code) == [model_clean_code(v) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.one_of(st.none(),
                          st.sampled_from(["sim", " SIM ", "Não", "nao", "s", "n", "1", "0", "true",
                                           "Falso", "verdadeiro", "x", "", "1.0", "talvez"])),
                min_size=1, max_size=40))
def test_clean_boolean_matches_model(spark, values):
    assert evaluate(spark, values, cleaning.clean_boolean) == [model_clean_boolean(v) for v in values]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31))
                .flatmap(lambda d: st.sampled_from([d.strftime("%Y-%m-%d"), d.strftime("%d/%m/%Y"),
                                                    f"{d.day}/{d.month}/{d.year}",
                                                    d.strftime("%Y-%m-%d") + "T10:00:00.000Z",
                                                    d.strftime("%d-%m-%Y"), str(d.year)])),
                min_size=1, max_size=40))
def test_parse_date_matches_model(spark, values):
    got = evaluate(spark, values, dates.parse_date)
    want = []
    for v in values:
        m = model_parse_date(v)
        if m is None and "T" in v:
            m = dt.date.fromisoformat(v[:10])
        want.append(m)
    assert got == want
