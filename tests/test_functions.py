"""Scalar expressions on literal edge-case rows (FIXTURES section 4)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from vigia.functions import cleaning, dates, geo, labels, numeric, predicates, risk


def col_values(spark, values, expr_fn, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(expr_fn(F.col("v"))).collect()]


def test_clean_boolean(spark):
    vals = ["1", " sim ", "não", "N", "0", "1.0", "x", "", None, "VERDADEIRO", "falso"]
    assert col_values(spark, vals, cleaning.clean_boolean) == [
        True, True, False, False, False, None, None, None, None, True, False]


def test_clean_code(spark):
    vals = ["1.0", "1e3", "-1.9", "x", "1d", "nan", "", None, "007", " 2.5 "]
    assert col_values(spark, vals, cleaning.clean_code) == [
        "1", "1000", "-1", "x", "1d", "nan", None, None, "7", "2"]


def test_null_tokens(spark):
    vals = ["NA", "null", "", "N/A", "ok", "none"]
    assert col_values(spark, vals, cleaning.null_tokens) == [None, None, None, None, "ok", "none"]


def test_parse_date(spark):
    vals = ["2024-01-02", "05/03/2024", "5/3/2024", "2024-01-02T03:00:00.000Z", "31/02/2024",
            "2024-13-01", "lixo", "", "2024", None]
    d = dt.date
    assert col_values(spark, vals, dates.parse_date) == [
        d(2024, 1, 2), d(2024, 3, 5), d(2024, 3, 5), d(2024, 1, 2), None, None, None, None, None, None]


def test_iso_week_and_labels(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2021, 1, 4),)], "d date")
    rows = df.select(dates.iso_week("d"), dates.mes_ano("d"), dates.ano_mes("d")).collect()
    assert [tuple(r) for r in rows] == [(53, "01/2021", "2021-01"), (1, "01/2021", "2021-01")]


def test_uf_from_ibge(spark):
    assert col_values(spark, [1501402, 150140, 99999, 0, None], geo.uf_from_ibge, "int") == [
        15, 15, None, None, None]


def test_age_band(spark):
    vals = [0.0, 0.5, 12.0, 12.5, 13.0, 80.0, 120.0, None]
    got = col_values(spark, vals, labels.age_band, "double")
    assert got == [None, "Criança (0-12)", "Criança (0-12)", "Adolescente (13-19)",
                   "Adolescente (13-19)", "Super Idoso (80+)", "Super Idoso (80+)", None]
    assert col_values(spark, [0.0], lambda c: labels.age_band(c, include_zero=True), "double") == [
        "Criança (0-12)"]
    assert col_values(spark, [121, -1, 5], labels.valid_age, "int") == [None, None, 5]


def test_target_and_status(spark):
    assert col_values(spark, [None, "Confirmado Laboratorial", "CONFIRMADO", "Descartado"],
                      labels.target) == [None, 1, 0, 0]
    # the view's predicate is case-insensitive
    assert col_values(spark, ["CONFIRMADO"], predicates.is_confirmed) == [True]
    assert col_values(spark, [None, 1, 2, 3], labels.vax_status_flat, "bigint") == [
        "Não Vacinado", "Parcial", "Esquema Completo", "Esquema Completo"]
    assert col_values(spark, [None, 0, 1, 2], labels.vax_status_view, "bigint") == [
        "Não Vacinado", "Não Vacinado", "Parcial (1 Dose)", "Esquema Completo"]


def test_predicates(spark):
    assert col_values(spark, [True, False, None], predicates.not_excluded, "boolean") == [False, True, None]
    assert col_values(spark, ["ÓBITO por covid", "óbito", "Obito"], predicates.is_death) == [True, True, False]
    assert col_values(spark, ["Não Detectável", "Negativo"], predicates.positive_by_text) == [True, False]


def test_exact_ratio_half_up(spark):
    df = spark.createDataFrame([(33335, 1000), (225, 100), (1, 8), (5, 0)], "n long, d long")
    got = [r[0] for r in df.select(numeric.exact_ratio("n", "d", 2, 5)).collect()]
    assert got == [Decimal("33.34"), Decimal("2.25"), Decimal("0.13"), None]
    got1 = [r[0] for r in df.select(numeric.exact_ratio("n", "d", 1, 6)).collect()]
    assert got1[1] == Decimal("2.3")


def test_round_half_even_matches_numpy(spark):
    import numpy as np
    vals = [2.25, 12.35, 0.05, 2.675, 0.15, 33.35, 66.65, 1 / 3 * 100, 2 / 3 * 100, 50.05]
    vals += [k / 7 * 100 for k in range(1, 7)] + [k / 40 * 100 for k in range(1, 40)]
    got = col_values(spark, vals, lambda c: numeric.round_half_even(c, 1), "double")
    assert got == [float(np.round(v, 1)) for v in vals]


def test_risk_score(spark):
    rows = [(0, 1, 1, 0, "Não Vacinado", "Outros"),
            (60, 0, 1, 0, "Não Vacinado", "Outros"),
            (0, 0, 0, 0, "Esquema Completo", "Outros"),
            (60, 1, 1, 1, "Não Vacinado", "Profissional de Saúde")]
    df = spark.createDataFrame(rows, "idade int, flg_febre int, flg_tosse int, flg_dispneia int, "
                                     "status_vacinal string, categoria_ocupacao string")
    out = df.select(risk.risk_score().alias("p")).select("p", risk.risk_band("p")).collect()
    assert round(out[0][0], 9) == 0.65 and out[0][1] == "Alta probabilidade"
    assert out[1][0] == 0.3 + (0.0 + 0.15 + 0.15) and out[1][1] == "Alta probabilidade"
    assert round(out[2][0], 9) == 0.1 and out[2][1] == "Baixa probabilidade"
    assert out[3][0] == 0.95


def test_split_keeps_trailing_empty(spark):
    from vigia.operators.reshape import explode_list
    df = spark.createDataFrame([(1, "Febre, Tosse,")], "id int, s string")
    got = [r[0] for r in explode_list(df, "id", "s", ",").select("nome").collect()]
    assert got == ["Febre", "Tosse", ""]


def test_in_period_open_ended(spark):
    vals = [dt.date(2024, 1, 1), dt.date(2024, 6, 1), None]
    assert col_values(spark, vals, lambda c: dates.in_period(c, "2024-02-01", None), "date") == [False, True, None]
    assert col_values(spark, vals, lambda c: dates.in_period(c, None, "2024-02-01"), "date") == [True, False, None]
    assert col_values(spark, vals, lambda c: dates.in_period(c, "2024-01-01", "2024-01-31"), "date") == [True, False, None]
