"""Archives by member, delimited files by range, and loads that break off."""

from __future__ import annotations

import io
import os
import random
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from finledger.sources import extracts, loader, members, ranges, tables
from finledger.streaming.intake import load_new_archives
from tests.test_sources import archive

LINES = 'A;B;C\n1;x;y\n2;short\n3;a;b;c\n4;"q;q";z\n5;d – e;f\n6;;g\n'


def staged(spark, folder, columns):
    return members.staged(members.planned(ranges.listed(spark, str(folder), "*.zip")), columns)


def test_members_by_name_and_damage(spark, tmp_path):
    archive(tmp_path / "good.zip", {"one.csv": LINES, "two.csv": "C;B;A;D\r\ny;x;9;more\r\n", "notes.txt": "ignored", "none.csv": "A;B;C\n"})
    archive(tmp_path / "empty.zip", {"notes.txt": "ignored"})
    archive(tmp_path / "half.zip", {"ok.csv": "A;B;C\n7;ok;ok", "hurt.csv": "A;B;C\n8;hurt;hurt\n"}, damaged=["hurt.csv"])
    (tmp_path / "bad.zip").write_bytes(b"not an archive")
    archive(tmp_path / "none.zip", {})
    found = staged(spark, tmp_path, ["A", "B", "C"])
    rows = sorted((r["metadata_membro"], r["A"], r["B"], r["C"]) for r in members.rows_of(found).collect())
    assert rows == [
        ("ok.csv", "7", "ok", "ok"), ("one.csv", "1", "x", "y"), ("one.csv", "2", "short", None), ("one.csv", "4", "q;q", "z"),
        ("one.csv", "5", "d – e", "f"), ("one.csv", "6", None, "g"), ("two.csv", "9", "x", "y"),
    ]
    events = {(r["arquivo"], r["membro"], r["nivel"]): r["LINHAS"] for r in members.events_of(found).collect()}
    assert events == {
        ("good.zip", "one.csv", "INFO"): 5, ("good.zip", "two.csv", "INFO"): 1, ("good.zip", "none.csv", "INFO"): 0,
        ("empty.zip", None, "WARNING"): 0, ("none.zip", None, "WARNING"): 0, ("bad.zip", None, "ERROR"): 0, ("half.zip", "ok.csv", "INFO"): 1,
        ("half.zip", "hurt.csv", "ERROR"): 0,
    }


def test_same_rows_as_by_blocks(spark, tmp_path):
    archive(tmp_path / "a.zip", {"one.csv": LINES, "two.csv": "C;B;A;D\ny;x;9;more\n"})
    archive(tmp_path / "b.zip", {"ok.csv": "B\nw\n", "hurt.csv": "A;B;C\n8;hurt;hurt\n"}, damaged=["hurt.csv"])
    by_blocks = members.from_blocks(extracts.read_archives(spark, str(tmp_path)), ["A", "B"])
    by_member = staged(spark, tmp_path, ["A", "B"])
    for of in (members.rows_of, members.events_of):
        a, b = ([tuple(r) for r in of(s).drop("mensagem").collect()] for s in (by_blocks, by_member))
        assert sorted(a, key=repr) == sorted(b, key=repr)


def test_large_archive_and_many_members(spark, tmp_path):
    """More than 2 GB before the members (a hole in the file), and a thousand of them in many tasks."""
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as out:
        for i in range(1000):
            out.writestr(f"m{i}.csv", "A;B\n" + f"{i};x\n" * 3)
    path = tmp_path / "large.zip"
    with open(path, "wb") as handle:
        handle.truncate((2 << 30) + 12345)
        handle.seek(0, os.SEEK_END)
        handle.write(buffer.getvalue())
    assert path.stat().st_size > 2 << 30
    plan = members.planned(ranges.listed(spark, str(tmp_path), "*.zip"))
    found = members.staged(plan, ["A", "B"])
    assert members.rows_of(found).agg(F.count("*"), F.sum(F.col("A").cast("int"))).first()[:] == (3000, 3 * 499500)
    assert members._dealt(plan, 1000).rdd.getNumPartitions() >= 4 * spark.sparkContext.defaultParallelism


def test_member_bytes(tmp_path):
    content = os.urandom(3 << 20) + b"x" * (9 << 20)
    for method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        path = tmp_path / f"{method}.zip"
        with zipfile.ZipFile(path, "w", method) as out:
            out.writestr("a.csv", content)
        i = zipfile.ZipFile(path).infolist()[0]
        place = [i.header_offset, i.compress_size, i.compress_type, i.flag_bits, i.CRC]
        with ranges.opened(str(path)) as handle:
            parts = list(members.inflated(handle, *place))
            assert b"".join(parts) == content and max(map(len, parts)) <= 4 << 20
            for at, wrong in ((1, place[1] - 9), (2, 99), (3, 1), (4, 7)):
                with pytest.raises(members._FAULTS):
                    list(members.inflated(handle, *[wrong if k == at else v for k, v in enumerate(place)]))


def test_ranges_of_any_size_read_each_line_once():
    rng = random.Random(4)
    body = b"".join(b"%d;%s\n" % (i, b"v" * rng.randrange(0, 30)) for i in range(60))
    for text in (body, body + b"last;without end", b"one line only", b"\n\n;\n", b"x" * 200 + b"\n1;2\n"):
        content = b"A;B\n" + text
        for size in (1, 2, 3, 7, 16, 64, 1000, 10000):
            found, taken = b"", 0
            for start in range(0, len(content), size):
                handle = pa.BufferReader(content)
                header = ranges._first_line(handle)
                before = handle.tell()
                found += b"".join(ranges._range_chunks(handle, max(start, len(header)), min(start + size, len(content))))
                taken += max(0, handle.tell() - max(0, start - 1)) if handle.tell() != before else 0
            assert found == text
            if size >= 1000:
                assert taken <= len(content) + 2


def test_fields_of_a_block():
    def rows(text, names, columns):
        table = ranges.parsed(text.encode("cp1252"), names, columns)
        return sorted(zip(*(c.to_pylist() for c in table.columns), strict=True), key=repr)

    assert rows('1;"a";x\n2;"open;y\n\n \n3;"q""q";\n4\n5;b;c;d\n', ["A", "B", "C"], ["C", "A", "B"]) == sorted(
        [("x", "1", "a"), (None, "2", "open;y\n".strip()), (None, "3", 'q"q'), (None, "4", None)], key=repr
    )
    assert rows("1;2\r\n;\r\n", ["A", "B"], ["B", "Z"]) == [("2", None), (None, None)]
    assert rows("1;2\n3;4\n", ["A", "B"], ["Z"]) == [(None,), (None,)]
    assert rows("", ["A"], ["A"]) == []
    assert rows("€;–\n", ["A", "B"], ["A", "B"]) == [("€", "–")]


def test_files_by_range(spark, tmp_path):
    (tmp_path / "a b.csv").write_bytes(b"A;B\n" + b"".join(b"%d;x\n" % i for i in range(5000)))
    (tmp_path / "b.csv").write_bytes(b'"B";"C";"A"\ny;new;7\n')
    (tmp_path / "empty.csv").write_bytes(b"")
    found = ranges.read_ranges(spark, str(tmp_path), ["A", "B"], 1000)
    assert found.agg(F.count("*"), F.sum(F.col("A").cast("int"))).first()[:] == (5001, 12497500 + 7)
    assert {r[0] for r in found.select("metadata_arquivo_origem").distinct().collect()} == {"a b.csv", "b.csv"}
    by_spark = extracts.read_by_header(spark, [str(tmp_path / "a b.csv"), str(tmp_path / "b.csv")], ["A", "B"])
    assert sorted(map(tuple, found.select("A", "B").collect())) == sorted(map(tuple, by_spark.select("A", "B").collect()))
    assert ranges.reachable(spark, str(tmp_path)) and not ranges.reachable(spark, "viewfs:///x")
    (tmp_path / "none").mkdir()
    assert ranges.read_ranges(spark, str(tmp_path / "none"), ["A"]).count() == 0


@pytest.fixture
def place(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    return folder, str(tmp_path / "table"), str(tmp_path / "log")


def values(spark, target, *columns):
    return sorted((tuple(r) for r in tables.read_table(spark, target).select(*columns).collect()), key=repr)


def test_added_columns_stay_in_the_table(spark, place):
    folder, target, log = place
    archive(folder / "x_2010.zip", {"a.csv": "A;B\n1;x\n"})
    loader.load_archives(spark, str(folder), target, log, ["A", "B"], "t")
    archive(folder / "x_2011.zip", {"a.csv": "B;NEW;A\ny;n;2\n", "b.csv": "A\n3\n"})
    archive(folder / "x_hurt.zip", {"c.csv": "not.a;col`umn;A\n9;9;9\n"}, damaged=["c.csv"])
    events = loader.load_archives(spark, str(folder), target, log, ["A", "B"], "t").collect()
    assert [r["nivel_log"] for r in events if r["arquivo_origem"] == "x_hurt.zip"] == ["ERROR"]
    events = [r for r in events if r["arquivo_origem"] != "x_hurt.zip"]
    assert {(r["tabela_destino"], r["schema_drift_detectado"]) for r in events} == {("t:a.csv", True), ("t:b.csv", True), ("t", True)}
    assert values(spark, target, "A", "B", "NEW") == [("1", "x", None), ("2", "y", "n"), ("3", None, None)]
    (folder / "x_hurt.zip").unlink()
    archive(folder / "x_2012.zip", {"a.csv": "a;B;new\n4;z;m\n", "b.csv": "A;B;odd.name\n5;w;o\n"})
    events = loader.load_archives(spark, str(folder), target, log, ["A", "B"], "t").collect()
    assert {r["tabela_destino"]: r["schema_drift_detectado"] for r in events} == {"t:a.csv": False, "t:b.csv": True, "t": True}
    assert values(spark, target, "A", "NEW", "`odd.name`")[3:] == [("4", "m", None), ("5", None, "o")]


def test_nothing_is_logged_when_rows_are_missing(spark, place, monkeypatch):
    folder, target, log = place
    archive(folder / "x_2010.zip", {"a.csv": "A\n1\n2\n"})
    monkeypatch.setattr(loader, "_stored", lambda *a: 1)
    with pytest.raises(RuntimeError, match="2 rows were read"):
        loader.load_archives(spark, str(folder), target, log, ["A"], "t")
    assert tables.read_log(spark, log).count() == 0
    monkeypatch.undo()
    assert loader.load_archives(spark, str(folder), target, log, ["A"], "t").count() == 2
    assert values(spark, target, "A") == [("1",), ("2",)]


def test_stream_that_breaks_off_between_table_and_log(spark, place, tmp_path, monkeypatch):
    folder, target, log = place
    where = [str(folder), target, log, ["A"], "t"]
    archive(folder / "x_2010.zip", {"a.csv": "A\n1\n2\n"})

    def broken(*a):
        raise OSError("lost")

    monkeypatch.setattr(loader.tables, "append_log", broken)
    with pytest.raises(Exception, match="lost"):
        load_new_archives(spark, *where, str(tmp_path / "ck"))
    monkeypatch.undo()
    assert tables.read_log(spark, log).count() == 0 and len(values(spark, target, "A")) == 2
    assert load_new_archives(spark, *where, str(tmp_path / "ck")) == 2
    assert load_new_archives(spark, *where, str(tmp_path / "ck")) == 0
    assert values(spark, target, "A") == [("1",), ("2",)] and tables.read_log(spark, log).count() == 2


def test_loaders_in_turn(spark, place, tmp_path):
    folder, target, log = place
    where = [str(folder), target, log, ["A"], "t"]
    archive(folder / "x_2010.zip", {"a.csv": "A\n1\n"})
    assert load_new_archives(spark, *where, str(tmp_path / "one")) == 2
    archive(folder / "x_2011.zip", {"a.csv": "A\n2\n"})
    assert loader.load_archives(spark, *where).count() == 2
    archive(folder / "x_2012.zip", {"a.csv": "A\n3\n", "b.csv": "A\n4\n"}, damaged=["b.csv"])
    assert load_new_archives(spark, *where, str(tmp_path / "two")) == 2
    assert load_new_archives(spark, *where, str(tmp_path / "one")) == 2  # the damaged archive, tried again
    assert values(spark, target, "A") == [("1",), ("2",), ("3",)]
    archive(folder / "x_2012.zip", {"a.csv": "A\n3\n", "b.csv": "A\n5\n"})
    loader.load_archives(spark, *where)
    assert values(spark, target, "A") == [("1",), ("2",), ("3",), ("5",)]
    done = tables.read_log(spark, log).filter("nivel_log = 'SUCCESS'")
    assert sorted(r["arquivo_origem"] for r in done.collect()) == ["x_2010.zip", "x_2011.zip", "x_2012.zip"]


def test_a_repeated_load_replaces_its_log_rows(spark, tmp_path):
    log = str(tmp_path / "log")
    staged = extracts.stage_as_text(spark.range(5), F.lit("dfp_2011.zip"))
    for _ in range(2):
        tables.append_log(tables.load_events(staged, "dfp"), log, "one")
    tables.append_log(tables.load_events(staged, "dfp"), log)
    assert tables.read_log(spark, log).count() == 2 and tables.read_log(spark, log, without="one").count() == 1
