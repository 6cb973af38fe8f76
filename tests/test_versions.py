"""Published versions, replaced parts, the mart kept up to date, and profiles from footers."""

from __future__ import annotations

import glob
import os

import pytest
from pyarrow import parquet
from pyspark.sql import functions as F

from finledger.operators import audit
from finledger.operators.normalise import current_period, normalise_lines
from finledger.plans import incremental, lake, mart
from finledger.queries import intake
from finledger.sources import catalog, tables
from tests.test_audit import table


def ids(spark, path, df):
    return sorted(r["id"] for r in tables.published(spark, path, df.schema).collect())


def test_a_version_replaces_the_old_one_at_once(spark, tmp_path):
    path = str(tmp_path / "t")
    assert tables.parts(spark, path) == [] and tables.published(spark, path, spark.range(1).schema).count() == 0
    assert tables.publish(spark.range(3), path)
    before = tables.published(spark, path, spark.range(1).schema)
    assert tables.publish(spark.range(5), path)
    assert ids(spark, path, spark.range(1)) == list(range(5))
    assert before.count() == 3  # a reader of the old version keeps its files
    assert tables.forget(spark, path) == 1 and ids(spark, path, spark.range(1)) == list(range(5))


def test_failing_write_and_refused_table_leave_the_old_one(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    tables.publish(spark.range(3), path)
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.publish(spark.range(100, 105).select((F.lit(1) / (F.col("id") - 102)).cast("long").alias("id")), path)
    assert not tables.publish(spark.range(9), path, lambda written: written.count() == 8)
    monkeypatch.setattr(tables, "_point", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        tables.publish(spark.range(9), path)
    monkeypatch.undo()
    assert ids(spark, path, spark.range(1)) == [0, 1, 2]
    tables.forget(spark, path)
    assert ids(spark, path, spark.range(1)) == [0, 1, 2] and len(glob.glob(f"{path}/versao=*")) == 1


def test_gated_table_is_written_once(spark, tmp_path):
    good = table(spark, [("3.01", 100), ("3.02", 40), ("3.03", 60), ("3.04", -10), ("3.05", 50)])
    path = str(tmp_path / "t")
    assert audit.write_if_approved(good, path) and not audit.write_if_approved(good.union(good), path)
    assert tables.published(spark, path, good.schema).count() == 5
    assert len(glob.glob(f"{path}/versao=*")) == 1


def test_parts_are_replaced_and_others_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(20).withColumn("b", (F.col("id") % 4).cast("int"))
    tables.publish(df, path, by="b")
    read = lambda: {(r["id"], r["b"]) for r in tables.published(spark, path, df.schema, by="b").collect()}
    assert read() == {(i, i % 4) for i in range(20)}
    tables.replace_parts(df.filter("b = 1 AND id > 10"), path, "b", [1, 2])  # part 2 has no rows any more
    assert read() == {(i, i % 4) for i in range(20) if i % 4 in (0, 3) or i % 4 == 1 and i > 10}
    assert {r["id"] for r in tables.published(spark, path, df.schema, "b", [1]).collect()} == {13, 17}
    assert len(tables.parts(spark, path)) == 3


def test_rebuilt_table_stays_when_its_write_fails(spark):
    tables.rebuild_table(spark.range(3), "finledger_kept")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.rebuild_table(spark.range(3).select((F.lit(1) / (F.col("id") - 1)).cast("long").alias("id")), "finledger_kept")
    assert spark.table("finledger_kept").count() == 3
    tables.rebuild_table(spark.range(4).withColumn("more", F.lit(1)), "finledger_kept")
    assert spark.table("finledger_kept").columns == ["id", "more"]
    spark.sql("DROP TABLE finledger_kept")


def test_update_equals_full_build(spark, data_dir, tmp_path):
    lines = normalise_lines(current_period(lake.raw_lines(spark, data_dir)))
    path, year, company = str(tmp_path / "m"), F.col("DT_FIM_EXERC_ANO"), F.substring("CNPJ_CIA", -1, 1).cast("int")
    states = [
        lines.filter(year < 1995),  # later filings arrive
        lines,
        lines.unionByName(lines.filter(company == 3).withColumn("VERSAO", F.col("VERSAO") + 9)),  # corrected
        lines.filter((company != 4) | (year != 1996)),  # withdrawn
        lines.filter(F.lit(False)),
        lines.repartition(3),  # the same lines in other files
        lines,
    ]
    schema = incremental.first_order_schema(lines)
    incremental.build(states[0], path, buckets=8)
    for state in states[1:]:
        parts = set(tables.parts(spark, path))
        changes = incremental.update(state, path, buckets=8)
        want = mart.mart_from_lines(state, lake.companies(spark, data_dir))
        found = incremental.read(spark, path, schema, lake.companies(spark, data_dir)).select(*want.columns)
        assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))
        if not changes.count():
            assert set(tables.parts(spark, path)) == parts  # nothing was written
    assert incremental.update(lines, path, buckets=8).count() == 0


def test_update_touches_only_what_changed(spark, data_dir, tmp_path):
    lines = normalise_lines(current_period(lake.raw_lines(spark, data_dir)))
    path = str(tmp_path / "m")
    incremental.build(lines, path, buckets=16)
    one = mart.mart_lines(lines).select("CNPJ_CIA", "ANO_FISCAL").orderBy("CNPJ_CIA", "ANO_FISCAL").first()
    this = (F.col("CNPJ_CIA") == one["CNPJ_CIA"]) & (F.col("DT_FIM_EXERC_ANO") == one["ANO_FISCAL"])
    before = set(tables.parts(spark, path))
    changes = incremental.update(lines.filter(~this), path, buckets=16).collect()
    assert [tuple(r) for r in changes] == [(one["CNPJ_CIA"], one["ANO_FISCAL"], "RETIRADO")]
    assert len(set(tables.parts(spark, path)) - before) == 1


def test_profile_reads_footers(spark, data_dir, tmp_path):
    spark.range(1000).repartition(3).write.parquet(str(tmp_path / "many.parquet"))
    paths = {n: f"{data_dir}/{n}.parquet" for n in intake.LAKE} | {"many": str(tmp_path / "many.parquet")}
    got = {r["TABELA"]: tuple(r)[1:] for r in catalog.profile(catalog.parquet_files(spark, paths)).collect()}
    want = {}
    for name, path in paths.items():
        files = glob.glob(f"{path}/*.parquet") if os.path.isdir(path) else [path]
        want[name] = (sum(parquet.ParquetFile(f).metadata.num_rows for f in files), len(files), sum(map(os.path.getsize, files)))
    total = got.pop(None)
    assert got == want and got["many"][:2] == (1000, 3)
    assert total == tuple(map(sum, zip(*want.values(), strict=True)))
    first = catalog.profile(catalog.parquet_files(spark, paths), top=2).collect()
    assert len(first) == 3 and first[-1]["LINHAS"] == total[0] and first[0]["BYTES"] >= first[1]["BYTES"]
    plan = catalog.parquet_files(spark, paths)._jdf.queryExecution().toString()
    assert "content" not in plan.split("== Physical Plan ==")[1]
