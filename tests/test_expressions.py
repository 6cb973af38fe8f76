from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from finledger.functions import expressions as X


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()[0]


@pytest.mark.parametrize(
    "code, digits, parent, ancestors",
    [
        ("1", 1, "1", []),
        ("1.01", 3, "1", ["1"]),
        ("1.01.02.01", 7, "1.01.02", ["1", "1.01", "1.01.02"]),
        ("1.01.02.01.02", 9, "1.01.02.01", ["1", "1.01", "1.01.02", "1.01.02.01"]),
    ],
)
def test_account_codes(spark, code, digits, parent, ancestors):
    c = F.lit(code)
    assert value(spark, X.digits(c)) == digits
    assert value(spark, X.parent_code(c)) == parent
    assert value(spark, X.ancestors(c)) == ancestors
    assert value(spark, X.prefix(c, 1)) == "1"
    assert value(spark, X.prefix(c, 5)) == (code if digits == 9 else None)


@pytest.mark.parametrize(
    "account, scale, raw, expected",
    [
        ("1.01", "MIL", "1000.47", 1000000.0),
        ("1.01", "UNIDADE", "1000.47", 1000.47),
        ("1.01", "MIL", "-1000.97", -1000000.0),
        ("3.99.01.01", "MIL", "0.47", 0.47),
    ],
)
def test_scale(spark, account, scale, raw, expected):
    column = X.scaled_value(F.lit(account), F.lit(scale), X.staged_number(F.lit(raw)))
    assert float(value(spark, column)) == expected


def test_staged_number_knows_missing_text(spark):
    for text in ("nan", "", "  ", "abc"):
        assert value(spark, X.staged_number(F.lit(text))) is None


@pytest.mark.parametrize(
    "group, expected",
    [
        ("DF CONSOLIDADO - DEMONSTRAÇÃO DE RESULTADO ABRANGENTE", "DRA"),
        ("DF CONSOLIDADO - DEMONSTRAÇÃO DO RESULTADO", "DRE"),
        ("DF CONSOLIDADO - BALANÇO PATRIMONIAL ATIVO", "BP"),
        ("DF CONSOLIDADO - OUTRAS", "VALIDAR"),
    ],
)
def test_statement_class(spark, group, expected):
    assert value(spark, X.statement_class(F.lit(group))) == expected


@pytest.mark.parametrize("x, note", [(0.8, 0.0), (0.5, 0.0), (2.0, 10.0), (9.0, 10.0), (1.4, 5.0), (None, None)])
def test_rising_note(spark, x, note):
    assert value(spark, X.linear_note(F.lit(x).cast("double"), 0.8, 2.0)) == note


@pytest.mark.parametrize("x, note", [(5.0, 0.0), (0.5, 10.0), (2.75, 5.0), (-1.0, 10.0), (None, None)])
def test_falling_note(spark, x, note):
    assert value(spark, X.linear_note(F.lit(x).cast("double"), 5.0, 0.5)) == note


@pytest.mark.parametrize("x, note", [(-0.1, 0.0), (0.3, 10.0), (0.15, 5.0), (0.45, 5.0), (2.0, 0.0), (None, None)])
def test_target_note(spark, x, note):
    assert value(spark, X.target_note(F.lit(x).cast("double"), 0.3)) == note


def test_missing_dimension_renormalises_weights(spark):
    df = spark.createDataFrame([(8.0, None, 4.0)], "a double, b double, c double")
    weighted = df.select(X.weighted_mean_of_present({"a": 0.25, "b": 0.25, "c": 0.5}).alias("v")).first()[0]
    assert weighted == pytest.approx((0.25 * 8 + 0.5 * 4) / 0.75)
    assert df.select(X.mean_of_present(["b"]).alias("v")).first()[0] is None


def test_ratio_guards(spark):
    def r(n, d, guard):
        return value(spark, X.ratio(F.lit(n).cast("double"), F.lit(d).cast("double"), guard))

    assert r(400.0, 350.0, "positive") == pytest.approx(1.142857, abs=1e-6)
    assert r(1.0, -2.0, "positive") is None
    assert r(1.0, -2.0, "nonzero") == -0.5
    assert r(1.0, 0.0, "nonzero") is None


def test_profiles(spark):
    def profile(cgl, ncg, st):
        return value(spark, X.working_capital_profile(*[F.lit(v).cast("double") for v in (cgl, ncg, st)]))

    assert profile(1.0, -1.0, 1.0).startswith("I ")
    assert profile(-1.0, 1.0, -1.0).startswith("IV")
    assert profile(0.0, 1.0, 1.0) == "Indefinido"
    assert profile(None, 1.0, 1.0) == "Indefinido"


def test_bands(spark):
    got = [value(spark, X.score_band(F.lit(v).cast("double"))) for v in (7.0, 5.0, 3.0, 2.99, None)]
    assert got == ["Saudavel", "Moderado", "Alerta", "Critico", None]
