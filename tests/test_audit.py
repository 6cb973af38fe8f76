from __future__ import annotations

import datetime

import pytest

from finledger.operators import audit
from finledger.plans import serving

DAY = datetime.date(2021, 12, 31)
SCHEMA = (
    "CNPJ_CIA string, DENOM_CIA string, DT_REFER date, CD_CONTA string, CD_CONTA_QTD_DIGITOS int, DS_CONTA string,"
    " VL_CONTA_TRATADO double, FLAG_RECONSTRUCAO boolean, IS_LEAF boolean, STATUS_MATH string, DT_REFER_ANO int, DT_FIM_EXERC_ANO int"
)


def table(spark, rows, entity="A", day=DAY, rebuilt=False, status="OK"):
    data = [
        (entity, entity, day, c, len(c.replace(".", "")), c, float(v), rebuilt, True, status, day.year, day.year) for c, v in rows
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_currency_effect(spark):
    flows = [("6.01", 1989161000), ("6.02", -339053000), ("6.03", -1033476000), ("6.05", 617460000)]
    row = audit.cash_identity(table(spark, flows)).first()
    assert row["DIFERENCA"] == -828000 and row["PCT_DIVERGENCIA"] == pytest.approx(0.1341)
    assert row["STATUS_IDENTIDADE"] == "EFEITO_CAMBIAL"
    assert audit.cash_identity(table(spark, flows, rebuilt=True)).first()["STATUS_IDENTIDADE"] == "DIVERGE"


@pytest.mark.parametrize(
    "saldo, c1, c2, rebuilt, expected",
    [
        (553_500_000, 11_600_000, 541_900_000, False, "EQUIVALENTES"),
        (11_600_500, 11_600_000, 0, False, "IDENTICO"),
        (5_000, 11_600_000, 0, False, "CAIXA_RESTRITO"),
        (900_000_000, 11_600_000, 541_900_000, False, "MANTIDO_PARA_VENDA"),
        (900_000_000, 11_600_000, 541_900_000, True, "ERRO_RECONSTRUIDO"),
    ],
)
def test_cash_reconciliation(spark, saldo, c1, c2, rebuilt, expected):
    dfc = table(spark, [("6.05.02", saldo)], rebuilt=rebuilt)
    bp = table(spark, [("1.01.01", c1), ("1.01.02", c2)])
    assert audit.cash_reconciliation(dfc, bp).first()["DIAGNOSTICO"] == expected


def test_cash_reconciliation_without_balance_sheet(spark):
    got = audit.cash_reconciliation(table(spark, [("6.05.02", 1)]), table(spark, [("1.01.01", 1)], entity="B")).first()
    assert got["DIAGNOSTICO"] == "SEM_BP"


def test_balance_equation(spark):
    df = table(spark, [("1", 10), ("2", 10)]).union(table(spark, [("1", 10), ("2", 9)], "B")).union(table(spark, [("1", 0)], "C"))
    got = {r["CNPJ_CIA"]: r["STATUS_EQUACAO"] for r in audit.balance_equation(df).collect()}
    assert got == {"A": "OK", "B": "DESBALANCEADO", "C": "OK"}


def test_parent_child(spark):
    df = table(spark, [("3.04", 100), ("3.04.01", 60), ("3.04.02", 39), ("3.04.02.01", 5000)])
    got = {r["CD_CONTA"]: r for r in audit.parent_child_check(df).collect()}
    assert got["3.04"]["SOMA_FILHOS"] == 99 and got["3.04"]["STATUS_PAR"] == "OK"
    assert got["3.04.02"]["STATUS_PAR"] == "DESBALANCEADO"
    assert set(got) == {"3.04", "3.04.02"}


def test_waterfall_accepts_either_sign_of_cost(spark):
    good = table(spark, [("3.01", 100), ("3.02", 40), ("3.03", 60), ("3.04", -10), ("3.05", 50)])
    assert audit.waterfall_check(good).first()["BRUTO_OK"]
    assert audit.publish_gate(good).first()["APROVADO"]
    bad = table(spark, [("3.01", 100), ("3.02", -40), ("3.03", 90), ("3.05", 50)])
    gate = audit.publish_gate(bad.union(bad)).first()
    assert not gate["APROVADO"] and gate["CHAVES_DUPLICADAS"] == 4


def test_refused_table_is_not_written(spark, tmp_path):
    good = table(spark, [("3.01", 100), ("3.02", 40), ("3.03", 60), ("3.04", -10), ("3.05", 50)])
    assert audit.write_if_approved(good, str(tmp_path / "a"))
    assert not audit.write_if_approved(good.union(good), str(tmp_path / "b"))
    assert not (tmp_path / "b").exists()


def test_crosscheck(spark):
    left = table(spark, [("1", 1)]).union(table(spark, [("1", 1)], "B"))
    right = table(spark, [("3.01", 1)], "B").union(table(spark, [("3.01", 1)], "C"))
    got = {r["SITUACAO"]: r["QTD_PARES"] for r in audit.coverage_crosscheck(left, right, "BP", "DRE").collect()}
    assert got == {"SO_BP": 1, "SO_DRE": 1, "AMBOS": 1}


def test_gap_candidates(spark):
    df = table(spark, [("1", 287), ("2", 100), ("2.03", 187.5), ("2.01", 100)])
    assert [r["CD_CONTA"] for r in audit.gap_candidates(df).collect()] == ["2.03"]


def test_checklist(spark):
    df = table(spark, [("1", 1), ("1.01", 1)])
    got = {r["TESTE"]: r["APROVADO"] for r in audit.audit_checklist(df, df["STATUS_MATH"] == "DESBALANCEADO").collect()}
    assert got.pop("sinteticas") is False
    assert all(got.values()) and len(got) == 6


def test_missing_years(spark):
    def filed(years):
        out = None
        for y in years:
            part = table(spark, [("1", 1)], day=datetime.date(y, 12, 31))
            out = part if out is None else out.union(part)
        return out

    got = audit.missing_periods({"BP": filed([2018, 2020]), "DRE": filed([2018, 2019, 2020])})
    assert [(r["ANO"], r["DEMONSTRATIVO"]) for r in got.collect()] == [(2019, "BP")]


def test_growth(spark):
    rows = [("A", datetime.date(2018 + i, 12, 31), v) for i, v in enumerate([100.0, 110.0, 121.0])]
    rows += [("B", datetime.date(2018, 12, 31), 0.0), ("B", datetime.date(2019, 12, 31), 5.0)]
    series = spark.createDataFrame(rows, "CNPJ_CIA string, DT_REFER date, VALOR double")
    got = {(r["CNPJ_CIA"], r["DT_REFER"].year): r["VARIACAO"] for r in serving.period_growth(series).collect()}
    assert got[("A", 2018)] == 0.0 and got[("A", 2019)] == pytest.approx(0.1) and got[("B", 2019)] == 0.0
    rates = {r["CNPJ_CIA"]: r["CAGR"] for r in serving.compound_growth(series).collect()}
    assert rates["A"] == pytest.approx(0.1) and rates["B"] == 0.0


def test_statement_parameters(spark):
    df = table(spark, [("1", 1000), ("1.01", 400), ("1.01.01", 300)]).union(table(spark, [("1", 5)], "B"))
    assert serving.statement(df, entity="A", max_level=2, scale="mil").count() == 2
    assert serving.statement(df, accounts=["1"]).count() == 2
    assert serving.statement(df, entity="A", dates=["2021-12-31"], accounts=["1"], scale="mil").first()["VALOR"] == 1.0
    assert serving.entities(df).count() == 2
