from __future__ import annotations

import datetime
import random
from decimal import Decimal

import pytest

from finledger.operators import hierarchy
from finledger.plans import curation

DAY = datetime.date(2020, 12, 31)
SCHEMA = "CNPJ_CIA string, DT_REFER date, CD_CONTA string, CD_CONTA_QTD_DIGITOS int, VL_CONTA_TRATADO decimal(28,6), DENOM_CIA string"


def ledger(spark, rows, entity="A"):
    data = [(entity, DAY, code, len(code.replace(".", "")), Decimal(str(v)), "Cia " + entity) for code, v in rows]
    return spark.createDataFrame(data, SCHEMA)


def repaired(spark, rows, rule="safe", lowest=2):
    out = hierarchy.roll_up(hierarchy.collapse_accounts(ledger(spark, rows)), rule, lowest)
    return {r["CD_CONTA"]: (float(r["VL_CONTA_TRATADO"]), r["ACAO"]) for r in out.collect()}


def test_duplicates_are_added(spark):
    assert repaired(spark, [("1", 3), ("1", 4)]) == {"1": (7.0, "kept")}


def test_missing_parents_are_inserted(spark):
    assert repaired(spark, [("1.01.02.01", 5)]) == {
        "1.01.02.01": (5.0, "kept"),
        "1.01.02": (5.0, "inserted"),
        "1.01": (5.0, "inserted"),
        "1": (5.0, "inserted"),
    }


def test_trees_without_root_stop_at_level_two(spark):
    assert repaired(spark, [("6.01.01", 5)], lowest=3) == {"6.01.01": (5.0, "kept"), "6.01": (5.0, "inserted")}


def test_depth_gap_reaches_all_levels(spark):
    got = repaired(spark, [("1.01.02.01.02", 2), ("1.01.03", 3)])
    assert {k: v for k, (v, _) in got.items()} == {
        "1.01.02.01.02": 2.0, "1.01.02.01": 2.0, "1.01.02": 2.0, "1.01.03": 3.0, "1.01": 5.0, "1": 5.0,
    }


def test_parent_that_disagrees(spark):
    rows = [("3.04", 100), ("3.04.01", 60), ("3.04.02", 30)]
    assert repaired(spark, rows, "safe", 3)["3.04"] == (100.0, "protected")
    assert repaired(spark, rows, "force", 3)["3.04"] == (90.0, "forced")


def test_zero_parent_is_filled(spark):
    assert repaired(spark, [("1", 0), ("1.01", 8)])["1"] == (8.0, "filled")


def test_close_parent_is_left_alone(spark):
    rows = [("3.04", 100.5), ("3.04.01", 100)]
    assert repaired(spark, rows, "force", 3)["3.04"] == (100.5, "kept")


@pytest.mark.parametrize("rule", ["safe", "force"])
def test_against_plain_python(spark, rule):
    rng = random.Random(7)
    data, expected = [], {}
    for entity in range(25):
        values: dict[str, float] = {}
        for _ in range(rng.randint(1, 14)):
            code = ".".join([rng.choice("12")] + [f"{rng.randint(1, 3):02d}" for _ in range(rng.randint(0, 4))])
            value = rng.choice([0, 0, 1, 5, 10, 100])
            values[code] = values.get(code, 0) + value
            data.append((str(entity), DAY, code, len(code.replace(".", "")), Decimal(value), "x"))
        for level in (5, 4, 3, 2):
            sums: dict[str, float] = {}
            for code, value in values.items():
                if len(code.split(".")) == level:
                    parent = code.rsplit(".", 1)[0]
                    sums[parent] = sums.get(parent, 0) + value
            for parent, total in sums.items():
                if parent not in values:
                    values[parent] = total
                elif rule == "safe" and abs(values[parent]) < 0.01 and abs(total) > 0.01:
                    values[parent] = total
                elif rule == "force" and total != 0 and abs(total - values[parent]) > 1 + 1e-5 * abs(values[parent]):
                    values[parent] = total
        expected |= {(str(entity), c): float(v) for c, v in values.items()}
    out = hierarchy.roll_up(hierarchy.collapse_accounts(spark.createDataFrame(data, SCHEMA)), rule, 2)
    assert {(r["CNPJ_CIA"], r["CD_CONTA"]): float(r["VL_CONTA_TRATADO"]) for r in out.collect()} == expected


def test_global_leaf_and_entity_leaf(spark):
    df = ledger(spark, [("1", 1), ("1.01", 1)]).union(ledger(spark, [("1.01.01", 1)], "B"))
    table = {(r["CNPJ_CIA"], r["CD_CONTA"]): r["IS_LEAF"] for r in hierarchy.mark_global_leaves(df).collect()}
    assert table == {("A", "1"): False, ("A", "1.01"): False, ("B", "1.01.01"): True}
    entity = {(r["CNPJ_CIA"], r["CD_CONTA"]): r["IS_LEAF"] for r in hierarchy.mark_global_leaves(df, "entity").collect()}
    assert entity[("A", "1.01")] is True


CONSOLIDATED = (
    "CNPJ_CIA string, DT_REFER date, VERSAO int, DENOM_CIA string, CD_CVM int, GRUPO_DFP_TRATADO string,"
    " DT_FIM_EXERC_TRATADO date, DT_FIM_EXERC_ANO int, CD_CONTA string, CD_CONTA_QTD_DIGITOS int, DS_CONTA string,"
    " VL_CONTA_TRATADO decimal(28,6), ST_CONTA_FIXA string, SETOR_ATIV string, LINE_ID long, LINE_SEQ long"
)


def consolidated(spark, rows, statement):
    data = [
        ("A", DAY, 1, "Cia A", 7, statement, DAY, 2020, code, len(code.replace(".", "")), name, Decimal(str(v)), "S", "Energia", i, 0)
        for i, (code, name, v) in enumerate(rows)
    ]
    return spark.createDataFrame(data, CONSOLIDATED)


def test_same_code_with_two_names_is_summed(spark):
    rows = [("1.01.01", "Caixa", 10), ("1.01.01", "Caixa Restrito", 5), ("1.01.01", "Caixa", 10)]
    curated = curation.curate(consolidated(spark, rows, "BP"), "BP")
    got = {r["CD_CONTA"]: r for r in curated.collect()}
    assert got["1.01.01"]["VL_CONTA_TRATADO"] == 15.0
    assert got["1"]["FLAG_RECONSTRUCAO"] and got["1"]["DS_CONTA"] == "ATIVO TOTAL"
    assert got["1.01"]["DS_CONTA"] == "CONTA RECONSTRUÍDA - 1.01"
    assert got["1"]["STATUS_MATH"] == "DESBALANCEADO"
    assert curated.columns == [name for name, _ in curation.S.GOLDEN_COLUMNS]


def test_income_keeps_one_line(spark):
    rows = [("3.01", "Receita", 10), ("3.01", "Receita Liquida", 20)]
    got = curation.curate(consolidated(spark, rows, "DRE"), "DRE").collect()
    assert [(r["CD_CONTA"], r["VL_CONTA_TRATADO"], r["STATUS_MATH"]) for r in got] == [("3.01", 20.0, "NAO_APLICAVEL")]


def test_missing_metadata_comes_from_neighbouring_dates(spark):
    data = [
        ("A", datetime.date(year, 12, 31), 1, "Cia A", 7 if year == 2019 else None, "BP", DAY, year, "1", 1, "Ativo", Decimal(5), "S",
         "Energia" if year == 2021 else None, year, 0)
        for year in (2019, 2020, 2021)
    ]
    curated = curation.curate(spark.createDataFrame(data, CONSOLIDATED), "BP").collect()
    assert {(r["CD_CVM"], r["SETOR_ATIV"]) for r in curated} == {(7, "Energia")}


def test_statuses(spark):
    balanced = consolidated(spark, [("1", "a", 10), ("2", "b", 10.5)], "BP")
    assert curation.curate(balanced, "BP").first()["STATUS_MATH"] == "OK"
    flows = consolidated(spark, [("6.01", "a", 10), ("6.02", "b", -4), ("6.05", "c", 6)], "DFC")
    row = curation.curate(flows, "DFC").first()
    assert row["STATUS_MATH"] == "OK" and row["DS_NIVEL_1"] == "DEMONSTRAÇÃO DO FLUXO DE CAIXA"
    untotalled = consolidated(spark, [("6.01", "a", 10)], "DFC")
    assert curation.curate(untotalled, "DFC").first()["STATUS_MATH"] == "SEM_TOTALIZADOR"


@pytest.mark.parametrize("rule, lowest", [("safe", 2), ("force", 2)])
def test_every_depth_is_rolled_up(spark, rule, lowest):
    rows = [("1.01.02.03.04.05", 70.0), ("1.01.02.03.04.05.06.07", 0.0), ("1", 0.0)]
    out = hierarchy.roll_up(hierarchy.collapse_accounts(ledger(spark, rows)), rule, lowest)
    values = {r["CD_CONTA"]: float(r["VL_CONTA_TRATADO"]) for r in out.collect()}
    for code in ("1", "1.01", "1.01.02", "1.01.02.03", "1.01.02.03.04", "1.01.02.03.04.05"):
        assert values[code] == 70.0
