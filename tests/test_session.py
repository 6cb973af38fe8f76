"""The shared folder: named by the session, a local one only for a local session, gone when the application ends."""

from __future__ import annotations

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from finledger import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
RUN = """
from finledger.session import build_session, materialise, run_dir
spark = build_session("t", "local[1]", **{"spark.checkpoint.dir": "file:%s"})
assert materialise(spark.range(5), "five").count() == 5
print("DIR", run_dir(spark))
spark.stop()
"""


def fake(master, conf=None):
    chosen = []
    context = SimpleNamespace(
        master=master, getCheckpointDir=lambda: chosen[-1] if chosen else None, setCheckpointDir=chosen.append
    )
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: conf))


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("yarn"))
    with pytest.raises(RuntimeError):
        session.shared_dir(fake("local-cluster[2,1,1024]"))
    assert session.shared_dir(fake("yarn", "hdfs://store/work/")) == "hdfs://store/work"
    assert os.path.isdir(session.shared_dir(fake("local[4]")))


def test_a_finished_application_leaves_nothing(tmp_path):
    out = subprocess.run([sys.executable, "-c", RUN % tmp_path], cwd=ROOT, capture_output=True, text=True, timeout=120)
    folder = out.stdout.split("DIR ")[1].strip().removeprefix("file:")
    assert folder.startswith(str(tmp_path)) and not os.path.exists(folder)


def test_functions_run_where_the_package_is_not_installed(tmp_path):
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from finledger.session import build_session
from finledger.sources import extracts
import io, zipfile
spark = build_session("t", "local[1]")
data = io.BytesIO()
with zipfile.ZipFile(data, "w") as out:
    out.writestr("a.csv", "A;B\\n1;x\\n")
files = spark.createDataFrame([("/x/a.zip", data.getvalue())], "path string, content binary")
print("ROWS", extracts.parse_members(extracts.expand_archives(files), ["B"]).collect()[0]["B"])
spark.stop()
"""
    clean = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=clean, capture_output=True, text=True, timeout=120)
    assert "ROWS x" in out.stdout, out.stderr[-2000:]
