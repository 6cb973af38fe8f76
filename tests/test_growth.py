"""Work and memory that must not grow faster than the input."""

from __future__ import annotations

import datetime
import re
import zipfile

import pandas as pd
from pyspark.sql import functions as F

from finledger.operators import hierarchy
from finledger.plans import curation, lake
from finledger.queries import gold, intake
from finledger.sources import members, ranges

DAY = datetime.date(2020, 12, 31)


def plan_of(df) -> str:
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def accounts(spark):
    rows = [(f"{i:03}", DAY, code, float(i % 3 and len(code))) for i in range(40) for code in ("1.01", "1.01.01", "1.02.03", "2.01")]
    lines = spark.createDataFrame(rows, "CNPJ_CIA string, DT_REFER date, CD_CONTA string, v double")
    return lines.select("*", F.lit("x").alias("DENOM_CIA"), F.col("v").cast("decimal(28,6)").alias("VL_CONTA_TRATADO")).drop("v")


def test_repair_is_dealt_by_its_lines(spark, monkeypatch):
    """More lines are more tasks, not larger ones; the result does not depend on it."""
    lines = accounts(spark).withColumn("CD_CONTA_QTD_DIGITOS", hierarchy.digits("CD_CONTA"))
    few = hierarchy.roll_up(hierarchy.collapse_accounts(lines), "safe", 2)
    monkeypatch.setattr(hierarchy, "LINES_PER_TASK", 10)
    many = hierarchy.roll_up(hierarchy.collapse_accounts(lines), "safe", 2)
    assert "REPARTITION_BY_NUM" not in plan_of(few)
    assert re.search(r"hashpartitioning\(CNPJ_CIA[^)]*, 16\), REPARTITION_BY_NUM", plan_of(many))
    assert sorted(map(repr, few.collect())) == sorted(map(repr, many.collect()))
    assert many.count() > lines.count()


def test_levels_share_one_sort(spark):
    """Each sort holds a page of its own for as long as the task runs, so one for each level is memory by depth."""
    lines = accounts(spark).withColumn("CD_CONTA_QTD_DIGITOS", hierarchy.digits("CD_CONTA"))
    collapsed = hierarchy.collapse_accounts(lines)
    plans = [plan_of(hierarchy.roll_up(collapsed, "safe", 2, deepest)) for deepest in (2, 5)]
    sorts = [len(re.findall(r"^\(\d+\) Sort$", p, flags=re.M)) for p in plans]
    windows = [len(re.findall(r"^\(\d+\) Window$", p, flags=re.M)) for p in plans]
    assert sorts[0] == sorts[1] and windows[0] < windows[1]


def test_codes_that_sort_between_an_account_and_those_below_it(spark):
    codes = {"1": 0, "1.01": 0, "1.01-5": 3, "1.01 ": 4, "1.01.01": 5, "1.01.01.2": 7, "1.01/": 8, "1.01-5.1": 9, "1.02.": 2, "1.010.1": 6}
    rows = [("a", DAY, c, float(v)) for c, v in codes.items()] + [(None, None, c, float(v)) for c, v in codes.items()]
    lines = spark.createDataFrame(rows, "CNPJ_CIA string, DT_REFER date, CD_CONTA string, v double")
    lines = lines.select("*", F.lit("x").alias("DENOM_CIA"), F.col("v").cast("decimal(28,6)").alias("VL_CONTA_TRATADO")).drop("v")
    collapsed = hierarchy.collapse_accounts(lines.withColumn("CD_CONTA_QTD_DIGITOS", hierarchy.digits("CD_CONTA")))
    for company in ("a", None):
        found = hierarchy.roll_up(collapsed, "force", 2).filter(F.col("CNPJ_CIA").eqNullSafe(F.lit(company))).collect()
        value = {r.CD_CONTA: float(r.VL_CONTA_TRATADO) for r in found}
        assert value["1.01.01"] == 7 and value["1.01"] == 7 and value["1.01-5"] == 9 and value["1.010"] == 6
        assert value["1"] == 7 + 9 + 4 + 8 + 6
        assert {r.CD_CONTA: r.ACAO for r in found}["1.010"] == "inserted"


def test_values_are_repaired_without_names_and_metadata(spark, data_dir):
    lines = lake.silver_lines(spark, data_dir)
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan_of(curation.repaired_values(lines, "DRE", 4))).group(1)
    names = set(re.findall(r"(\w+):", read))
    assert names <= set(curation.VALUE_COLUMNS) - {"DS_CONTA"}


def test_values_need_only_their_columns_stored(spark, data_dir):
    narrow, wide = lake.silver_lines(spark, data_dir, curation.VALUE_COLUMNS), lake.silver_lines(spark, data_dir)
    assert sorted(narrow.columns) == sorted(curation.VALUE_COLUMNS)
    for code in curation.STATEMENTS:
        one, other = (sorted(map(repr, curation.repaired_values(x, code).collect())) for x in (narrow, wide))
        assert one == other and one


def test_earlier_lines_come_from_one_scan(spark, data_dir):
    rows = [(y, 1, 10.0) for y in (None, 2000, 2001, 2002, 2003, 2003)]
    lines = spark.createDataFrame(rows, "DT_FIM_EXERC_ANO int, VERSAO int, v double")
    lines = lines.select("DT_FIM_EXERC_ANO", "VERSAO", F.col("v").cast("decimal(28,6)").alias("VL_CONTA_TRATADO"))
    found = sorted((r[0], r[1], float(r[2])) for r in gold._earlier(lines).collect())
    assert found == [(2001, 1, 10.0), (2001, 2, 30.0), (2002, 1, 10.0), (2003, 1, 10.0), (2003, 1, 10.0), (2102, 1, 10.0)]
    assert gold._earlier(lines).schema["VL_CONTA_TRATADO"].dataType == lines.schema["VL_CONTA_TRATADO"].dataType
    plan = plan_of(gold._earlier(lake.typed_lines(spark, data_dir)))
    assert len(re.findall(r"^\(\d+\) Scan parquet", plan, flags=re.M)) == 1


def test_archives_hold_many_batches(monkeypatch):
    monkeypatch.setattr(intake, "ARCHIVE_LINES", 5)
    batches = [pd.DataFrame({"n": [i, i]}) for i in range(7)]
    found = [list(b["n"]) for b in intake._gathered(iter(batches))]
    assert found == [[0, 0, 1, 1, 2, 2], [3, 3, 4, 4, 5, 5], [6, 6]]
    assert list(intake._gathered(iter([]))) == []


def test_members_of_an_archive_are_read_by_few_tasks(spark, tmp_path):
    """Else a table laid out by archive has a file from every task for every archive."""
    for a in range(8):
        with zipfile.ZipFile(tmp_path / f"a{a}.zip", "w") as archive:
            for m in range(32):
                archive.writestr(f"m{m}.csv", "CD_CONTA\n1\n")
    plan = members.planned(ranges.listed(spark, str(tmp_path), "*.zip"))
    dealt = members._dealt(plan, 256).withColumn("p", F.spark_partition_id())
    assert dealt.count() == 256 and dealt.select("p").distinct().count() > 8
    pieces = dealt.select("arquivo", "p").distinct().count()
    assert pieces <= 8 + 16
