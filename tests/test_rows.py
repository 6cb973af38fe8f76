from __future__ import annotations

from pyspark.sql import functions as F

from finledger.operators import normalise, rows
from tests.conftest import as_dict


def test_version_is_a_number(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 9, 2.0), ("A", 10, 3.0)], "k string, VERSAO int, v double")
    assert rows.newest_row(df, ["k"], rows.newest_first("VERSAO")).first()["v"] == 3.0
    assert [r["VERSAO"] for r in rows.latest_filing(df, ["k"]).collect()] == [10]


def test_latest_filing_keeps_all_lines_of_the_version(spark):
    df = spark.createDataFrame([("A", 2, "x"), ("A", 2, "y"), ("A", 1, "z"), ("B", 1, "w")], "k string, VERSAO int, n string")
    assert sorted(r["n"] for r in rows.latest_filing(df, ["k"]).collect()) == ["w", "x", "y"]


def test_modal_value_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("1", "b"), ("1", "a"), ("2", "c"), ("2", "c"), ("2", "a"), ("3", None)], "k string, v string")
    assert {r["k"]: r["v"] for r in rows.modal_value(df, "k", "v").collect()} == {"1": "a", "2": "c"}


def test_latest_non_null_is_per_column(spark):
    df = spark.createDataFrame(
        [("A", 1, 1.0, 5.0), ("A", 2, None, 6.0), ("A", 3, None, None)], "k string, y int, a double, b double"
    )
    assert as_dict(rows.latest_non_null(df, "k", "y", ["a", "b"]), "k") == {"A": {"y": 3, "a": 1.0, "b": 6.0}}


def test_gaps_do_not_leak_between_companies(spark):
    df = spark.createDataFrame(
        [("A", 1, None), ("A", 2, None), ("B", 1, None), ("B", 2, "s"), ("B", 3, None)], "k string, d int, s string"
    )
    filled = {(r["k"], r["d"]): r["s"] for r in rows.fill_gaps(df, "k", "d", ["s"]).collect()}
    assert filled == {("A", 1): None, ("A", 2): None, ("B", 1): "s", ("B", 2): "s", ("B", 3): "s"}


REGISTRY = "CNPJ_CIA string, SIT string, TP_MERC string, SIT_EMISSOR string, SETOR_ATIV string, REG_SEQ int"


def registry(spark):
    ok = ("ATIVO", "BOLSA", "FASE OPERACIONAL")
    return spark.createDataFrame(
        [
            ("1", *ok, "Energia", 2),
            ("1", *ok, "Energia antiga", 1),
            ("2", *ok, "Bancos", 2),
            ("3", *ok, None, 2),
            ("4", "CANCELADO(A)", "BOLSA", "FASE OPERACIONAL", "Energia", 2),
            ("5", *ok, "Emp. Adm. de Imóveis", 2),
        ],
        REGISTRY,
    )


def test_eligible_entities(spark):
    eligible = normalise.eligible_entities(registry(spark))
    assert sorted(r["CNPJ_CIA"] for r in eligible.collect()) == ["1", "3"]
    assert eligible.filter("CNPJ_CIA = '1'").first()["SETOR_ATIV"] == "Energia"
    wide = normalise.eligible_entities(registry(spark), exclude_real_estate=False)
    assert sorted(r["CNPJ_CIA"] for r in wide.collect()) == ["1", "3", "5"]


def test_funnel_counts_down(spark):
    steps = normalise.filter_funnel(registry(spark)).orderBy("PASSO").collect()
    assert [r["N"] for r in steps] == [6, 5, 5, 5, 5, 4, 4, 4, 4]
    assert [r["EXCLUIDAS"] for r in steps] == [0, 1, 0, 0, 0, 1, 0, 0, 0]


def test_leaf_by_filing(spark):
    df = spark.createDataFrame(
        [("A", "d", 1, "1", 5.0), ("A", "d", 1, "1.01", 5.0), ("A", "d", 1, "1.02.03", 1.0), ("A", "d", 2, "1.01.01", 2.0)],
        "CNPJ_CIA string, DT_REFER string, VERSAO int, CD_CONTA string, VL_CONTA_TRATADO double",
    )
    leaves = {(r["VERSAO"], r["CD_CONTA"]): r["IS_LEAF"] for r in normalise.mark_leaves(df).collect()}
    assert leaves == {(1, "1"): False, (1, "1.01"): True, (1, "1.02.03"): True, (2, "1.01.01"): True}


def test_equity_total(spark):
    df = spark.createDataFrame(
        [
            ("dfp_cia_aberta_dmpl_con", "Patrimônio Líquido Consolidado"),
            ("dfp_cia_aberta_dmpl_con", "PATRIMÔNIO LÍQUIDO CONSOLIDADO"),
            ("dfp_cia_aberta_dmpl_con", "Capital Social"),
            ("dfp_cia_aberta_bpa_con", None),
        ],
        "TABLE_NAME string, COLUNA_DF string",
    )
    assert normalise.equity_total_only(df).count() == 3


def test_current_period_takes_a_predicate(spark):
    df = spark.createDataFrame([("ÚLTIMO", 1), ("ÚLTIMO", 2), ("PENÚLTIMO", 1)], "ORDEM_EXERC string, n int")
    assert normalise.current_period(df).count() == 2
    assert normalise.current_period(df, F.col("n") == 2).count() == 1
