from __future__ import annotations

import datetime

import pytest

from finledger import schema as S
from finledger.plans import benchmark, lake, mart

FIRST = {"CNPJ_CIA": "string", "ANO_FISCAL": "int", "DT_REFER": "date", "RAZAO_SOCIAL": "string", "SETOR": "string", "CD_CVM": "int"}
ACCOUNTS = [*S.MART_ACCOUNTS, "DEP_AMORT"]


def first_order(spark, rows):
    """Rows of ``(company, year, {balance: value})``."""
    schema = ", ".join(f"{k} {t}" for k, t in FIRST.items()) + ", " + ", ".join(f"{a} double" for a in ACCOUNTS)
    data = [
        (c, y, datetime.date(y, 12, 31), c, values.get("SETOR", "Energia"), 1, *[values.get(a) for a in ACCOUNTS])
        for c, y, values in rows
    ]
    return spark.createDataFrame(data, schema)


def one(spark, **values):
    values.setdefault("DEP_AMORT", 0.0)
    return mart.indicator_mart(first_order(spark, [("A", 2020, values)])).first()


def test_worked_examples(spark):
    row = one(
        spark, AC=300.0, RLP=100.0, PC=200.0, PNC=150.0, ESTOQUES=60.0, CPV=-300.0, CLIENTES=60.0, REC_LIQ=300.0,
        FORNECEDORES=50.0,
    )
    assert row["LIQ_GERAL"] == pytest.approx(1.142857, abs=1e-6)
    assert row["PMRE"] == 72.0 and row["PMRV"] == 72.0 and row["PMPC"] == 60.0
    assert row["CICLO_FINANCEIRO"] == 84.0 and row["CCC"] == 84.0


def test_without_inventory(spark):
    row = one(spark, AC=300.0, PC=200.0, CPV=-300.0, CLIENTES=60.0, REC_LIQ=300.0)
    assert row["PMRE"] is None and row["CICLO_ECONOMICO"] is None
    assert row["LIQ_SECA"] == row["LIQ_CORRENTE"] == 1.5


def test_negative_equity(spark):
    assert one(spark, PL=-10.0, LUCRO_LIQ=5.0)["ROE"] is None


def test_missing_parts_count_as_zero(spark):
    row = one(spark, AC=100.0)
    assert row["CGL"] == 100.0 and row["NCG"] == 100.0 and row["ST"] == 0.0
    assert row["EFEITO_TESOURA"] is False


def test_earnings_per_share_fallback(spark):
    assert one(spark, LPA_DILUIDO_ON=1.0, LPA_BASICO_ON=2.0, LPA_3_99=3.0)["LPA"] == 1.0
    assert one(spark, LPA_BASICO_ON=2.0, LPA_3_99=3.0)["LPA"] == 2.0
    assert one(spark, LPA_3_99=3.0)["LPA"] == 3.0


def test_scissors_effect(spark):
    rows = [("A", 2018 + i, {"EMP_FIN_CP": v, "DEP_AMORT": 0.0}) for i, v in enumerate([10.0, 40.0, 80.0])]
    rows += [("B", y, {"EMP_FIN_CP": v, "DEP_AMORT": 0.0}) for y, v in ((2010, 10.0), (2015, 40.0), (2020, 80.0))]
    got = {(r["CNPJ_CIA"], r["ANO_FISCAL"]): r["EFEITO_TESOURA"] for r in mart.indicator_mart(first_order(spark, rows)).collect()}
    assert [got[("A", y)] for y in (2018, 2019, 2020)] == [False, False, True]
    assert got[("B", 2020)] is True
    strict = mart.indicator_mart(first_order(spark, rows), consecutive_years=True).collect()
    assert {r["CNPJ_CIA"] for r in strict if r["EFEITO_TESOURA"]} == {"A"}


def test_working_capital_identity(spark, data_dir):
    rows = lake.mart(spark, data_dir).select("CGL", "NCG", "ST").collect()
    assert rows
    for r in rows:
        assert r["CGL"] == pytest.approx(r["NCG"] + r["ST"], rel=1e-9, abs=1e-3)


def test_notes_and_scores_stay_in_range(spark, data_dir):
    notes = [n for n, *_ in S.LINEAR_NOTES] + [n for n, *_ in S.TARGET_NOTES]
    for row in benchmark.risk_scores(lake.mart(spark, data_dir)).collect():
        for name in [*notes, "SCORE_IPRF", *[d for d, *_ in S.SCORE_DIMENSIONS]]:
            assert row[name] is None or 0.0 <= row[name] <= 10.0


def test_unpivot_keeps_every_value(spark, data_dir):
    wide = lake.mart(spark, data_dir)
    present = sum(sum(v is not None for v in r) for r in wide.select(*S.BENCHMARK_INDICATORS).collect())
    assert benchmark.unpivot_indicators(wide).count() == present


def test_peer_ranks_with_ties(spark):
    rows = [(c, c, "S", 2020, s, "x") for c, s in (("a", 2.0), ("b", 2.0), ("c", 1.0))] + [("n", "n", None, 2020, 5.0, "x")]
    df = spark.createDataFrame(rows, "CNPJ_CIA string, DENOM_CIA string, SETOR string, ANO_FISCAL int, SCORE_IPRF double, FAIXA_IPRF string")
    got = {r["CNPJ_CIA"]: r for r in benchmark.score_peers(df).collect()}
    assert [got[c]["RANK_IPRF_SETOR_ANO"] for c in "abc"] == [1, 1, 2]
    assert [got[c]["PERCENTIL_IPRF_SETOR_ANO"] for c in "abc"] == [50.0, 50.0, 0.0]
    assert got["a"]["MEDIANA_IPRF_SETOR_ANO"] == 2.0
    assert got["n"]["MEDIANA_IPRF_SETOR_ANO"] is None and got["n"]["RANK_IPRF_SETOR_ANO"] == 1


def lines(spark, rows):
    return spark.createDataFrame(
        [("A", datetime.date(2020, 12, 31), code, value, rebuilt) for code, value, rebuilt in rows],
        "CNPJ_CIA string, DT_REFER date, CD_CONTA string, VL_CONTA_TRATADO double, FLAG_RECONSTRUCAO boolean",
    )


def test_simple_mart(spark):
    companies = spark.createDataFrame([("A", "Cia A", "Energia", "BOLSA")], "CNPJ_CIA string, DENOM_SOCIAL string, SETOR_ATIV string, TP_MERC string")
    bp = lines(spark, [("1.01", 300.0, False), ("2.01", 200.0, True), ("2.01", 150.0, False), ("2.03", -10.0, False), ("1.01.01", 30.0, False)])
    dre = lines(spark, [("3.11", 5.0, False), ("3.99.02.01", -2.7e16, False), ("3.99.01.01", 0.4, False)])
    dfc = lines(spark, [("6.05.02", 25.0, False)])
    row = mart.simple_mart(bp, dre, dfc, companies).first()
    assert row["V10_PASSIVO_CIRC"] == 150.0
    assert row["IND_LIQUIDEZ_CORRENTE"] == 2.0
    assert row["IND_LIQUIDEZ_IMEDIATA"] == 0.2
    assert row["IND_ROE"] == -0.5
    assert row["IND_LPA_DILUIDO"] == 0.4
    assert row["IND_PMRE"] is None and row["V06_ESTOQUES"] == 0.0
    assert row["AUX_DIVIDA_LIQUIDA"] == -25.0
    assert len([c for c in row.asDict() if c.startswith("IND_")]) == 30
    assert len([c for c in row.asDict() if c.startswith("V")]) == 25
    assert len([c for c in row.asDict() if c.startswith("AUX_")]) == 6
