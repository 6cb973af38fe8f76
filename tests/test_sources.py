from __future__ import annotations

import io
import os
import zipfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.schema import LOAD_LOG
from finledger.sources import catalog, extracts, loader, tables
from finledger.streaming.intake import stage_new_files

LINES = 'A;B;C\n1;x;y\n2;short\n3;a;b;c\n4;"q;q";z\n5;d – e;f\n6;;g\n'


def test_bad_lines_and_encoding(spark, tmp_path):
    path = str(tmp_path / "extract.csv")
    with open(path, "wb") as handle:
        handle.write(LINES.encode("cp1252"))
    rows = {r["A"]: r for r in extracts.read_delimited(spark, path, ["A", "B", "C"]).collect()}
    assert set(rows) == {"1", "2", "4", "5", "6"}
    assert rows["2"]["C"] is None
    assert rows["4"]["B"] == "q;q"
    assert rows["5"]["B"] == "d – e"
    assert rows["6"]["B"] is None
    assert rows["1"]["metadata_arquivo_origem"] == "extract.csv"
    assert extracts.column_names(extracts.file_headers(spark, path).first()["cabecalho"]) == ["A", "B", "C"]


def test_columns_are_bound_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("A;B\n1;x\n".encode("cp1252"))
    (tmp_path / "b.csv").write_bytes('"B";"A";"C"\ny – z;2;new\n'.encode("cp1252"))
    (tmp_path / "c.csv").write_bytes("B\nw\nq;too long\n".encode("cp1252"))
    rows = {tuple(r) for r in extracts.read_delimited(spark, str(tmp_path), ["A", "B"]).collect()}
    assert rows == {("1", "x", "a.csv"), ("2", "y – z", "b.csv"), (None, "w", "c.csv")}
    drift = extracts.header_drift(extracts.file_headers(spark, str(tmp_path)), ["A", "B"]).collect()
    assert {(r["caminho"][-5:], r["COLUNA"], r["SITUACAO"]) for r in drift} == {("b.csv", "C", "NOVA"), ("c.csv", "A", "AUSENTE")}


def archive(path, members, damaged=()):
    with zipfile.ZipFile(path, "w") as out:
        for name, text in members.items():
            out.writestr(name, text.encode("cp1252"))
    content = path.read_bytes()
    for name in damaged:
        content = content.replace(members[name].encode("cp1252"), members[name].encode("cp1252").swapcase())
    path.write_bytes(content)


def test_archives(spark, tmp_path):
    archive(tmp_path / "good.zip", {"one.csv": LINES, "two.csv": "C;B;A;D\ny;x;9;more\n", "notes.txt": "ignored", "none.csv": "A;B;C\n"})
    archive(tmp_path / "empty.zip", {"notes.txt": "ignored"})
    archive(tmp_path / "half.zip", {"ok.csv": "A;B;C\n7;ok;ok\n", "hurt.csv": "A;B;C\n8;hurt;hurt\n"}, damaged=["hurt.csv"])
    (tmp_path / "bad.zip").write_bytes(b"not an archive")
    lines = extracts.read_archives(spark, str(tmp_path))
    parsed = extracts.parse_members(lines, ["A", "B", "C"])
    got = sorted((r["metadata_membro"], r["A"], r["B"]) for r in parsed.collect())
    assert got == [
        ("ok.csv", "7", "ok"), ("one.csv", "1", "x"), ("one.csv", "2", "short"), ("one.csv", "4", "q;q"),
        ("one.csv", "5", "d – e"), ("one.csv", "6", None), ("two.csv", "9", "x"),
    ]
    events = {(r["arquivo"], r["membro"], r["nivel"]): r["LINHAS"] for r in extracts.archive_events(lines).collect()}
    assert events == {
        ("good.zip", "one.csv", "INFO"): 6, ("good.zip", "two.csv", "INFO"): 1, ("good.zip", "none.csv", "INFO"): 0,
        ("empty.zip", None, "WARNING"): 0, ("bad.zip", None, "ERROR"): 0, ("half.zip", "ok.csv", "INFO"): 1,
        ("half.zip", "hurt.csv", "ERROR"): 0,
    }


def test_intake_loop_loads_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    target, log = str(tmp_path / "table"), str(tmp_path / "log")
    archive(folder / "dfp_2010.zip", {"a.csv": "A;B\n1;x\n2;y\n", "b.csv": "B;A;C\nz;3;new\n"})
    archive(folder / "dfp_2011.zip", {"a.csv": "A;B\n4;ok\n", "b.csv": "A;B\n5;hurt\n"}, damaged=["b.csv"])

    def load():
        events = loader.load_archives(spark, str(folder), target, log, ["A", "B"], "dfp").collect()
        return sorted((r["arquivo_origem"], r["nivel_log"], r["tabela_destino"], r["schema_drift_detectado"]) for r in events)

    first = load()
    assert first == [
        ("dfp_2010.zip", "INFO", "dfp:a.csv", False), ("dfp_2010.zip", "INFO", "dfp:b.csv", True),
        ("dfp_2010.zip", "SUCCESS", "dfp", True), ("dfp_2011.zip", "ERROR", "dfp:b.csv", False),
        ("dfp_2011.zip", "INFO", "dfp:a.csv", False),
    ]
    assert {e[0] for e in load()} == {"dfp_2011.zip"}
    assert sorted(r["A"] for r in spark.read.parquet(target).collect()) == ["1", "2", "3", "4"]
    archive(folder / "dfp_2011.zip", {"a.csv": "A;B\n4;ok\n", "b.csv": "A;B\n5;fine\n"})
    assert ("dfp_2011.zip", "SUCCESS", "dfp", False) in load()
    assert load() == []
    assert sorted(r["A"] for r in spark.read.parquet(target).collect()) == ["1", "2", "3", "4", "5"]


def test_large_member_is_streamed_in_blocks():
    import pandas as pd

    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as out:
        out.writestr("big.csv", "A\n" + "12345678\n" * 300_000 + "last")
    frames = list(extracts._expand(iter([pd.DataFrame({"path": ["/x/big.zip"], "content": [buffer.getvalue()]})])))
    assert [len(f) for f in frames] == [1] * len(frames) and len(frames) == 4
    assert "\n".join(f["bloco"][0] for f in frames) == "12345678\n" * 300_000 + "last"
    assert max(len(f["bloco"][0]) for f in frames) <= (1 << 20) + 10


def test_table_names(spark):
    rows = [("DFP_cia_aberta_BPA_con_2011.csv", 2011), ("cia_aberta_2012.csv", 2012), ("dfp_x.csv", 0)]
    df = spark.createDataFrame(rows, "f string, y int")
    got = [r[0] for r in df.select(catalog.table_name("f", "y", F.lit("dfp_cia_aberta"))).collect()]
    assert got == ["dfp_cia_aberta_bpa_con", "dfp_cia_aberta", "dfp_x"]


def test_expected_and_pending_files(spark):
    years = spark.createDataFrame([(2010,), (2011,)], "ANO int")
    expected = catalog.expected_files(years)
    assert expected.count() == 7
    log = spark.createDataFrame(
        [(1, None, "SUCCESS", 2010, "dfp_cia_aberta_2010.zip", "TODAS", "Processamento do arquivo finalizado.", False),
         (2, None, "ERROR", 2011, "dfp_cia_aberta_2011.zip", "-", "Erro", False)],
        LOAD_LOG,
    )
    pending = {r["ARQUIVO"] for r in catalog.pending_files(expected, log).collect()}
    assert "dfp_cia_aberta_2010.zip" not in pending and "dfp_cia_aberta_2011.zip" in pending


def test_drift(spark):
    known = spark.createDataFrame([(1, 2)], "a int, b int")
    incoming = spark.createDataFrame([(1, None), (2, 5)], "a int, c int")
    got = {(r["COLUNA"], r["SITUACAO"]): r["PREENCHIDAS"] for r in catalog.schema_drift(known.columns, incoming).collect()}
    assert got == {("c", "NOVA"): 1, ("b", "AUSENTE"): 0}
    assert catalog.schema_drift(known.columns, known).count() == 0
    assert catalog.align_to(known, incoming).columns == ["a", "b", "c"]


def test_staging_keeps_missing_values(spark):
    df = spark.createDataFrame([(1, None), (2, 2.5)], "a int, v double")
    staged = extracts.stage_as_text(df, F.lit("f.csv"))
    assert [f.dataType for f in staged.schema.fields[:2]] == [T.StringType(), T.StringType()]
    assert {r["v"] for r in staged.collect()} == {None, "2.5"}


def test_write_and_read_back(spark, tmp_path):
    df = spark.range(100).withColumn("y", (F.col("id") % 3).cast("int"))
    checked = tables.written_rows(df, str(tmp_path / "t"), ["y"])
    assert checked.filter("CONFERE").count() == 3
    tables.append_by_year(df, str(tmp_path / "b"), "y")
    tables.append_by_year(df, str(tmp_path / "b"), "y")
    assert spark.read.parquet(str(tmp_path / "b")).count() == 200
    tables.export_csv(df, str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 100
    tables.publish_view(df, "numbers")
    assert spark.sql("SELECT count(*) FROM numbers").first()[0] == 100


def test_a_table_is_rebuilt_under_its_name(spark):
    for n in (3, 5):
        tables.rebuild_table(spark.range(n), "finledger_rebuilt")
        assert spark.table("finledger_rebuilt").count() == n
    spark.sql("DROP TABLE finledger_rebuilt")


def test_log(spark, tmp_path):
    staged = extracts.stage_as_text(spark.range(5), F.lit("dfp_cia_aberta_2011.zip"))
    tables.append_log(tables.load_events(staged, "dfp"), str(tmp_path / "log"))
    row = tables.log_counts(tables.read_log(spark, str(tmp_path / "log"))).first()
    assert (row["EVENTOS"], row["LINHAS"]) == (1, 5)


def test_stream_takes_each_file_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    os.makedirs(source)
    schema = spark.range(1).schema
    spark.range(10).coalesce(1).write.mode("append").parquet(source)
    assert stage_new_files(spark, source, schema, target, checkpoint, glob="*.parquet") == 10
    spark.range(5).coalesce(1).write.mode("append").parquet(source)
    stage_new_files(spark, source, schema, target, checkpoint, glob="*.parquet")
    stage_new_files(spark, source, schema, target, checkpoint, glob="*.parquet")
    assert spark.read.parquet(target).count() == 15
