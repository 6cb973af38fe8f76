from __future__ import annotations

import datetime
import decimal
import math
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from finledger.session import build_session  # noqa: E402

DATA = os.environ.get("FINLEDGER_TESTDATA", "/root/testdata/sf0.001")
TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
]


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    return con


@pytest.fixture(scope="session")
def data_dir():
    return DATA


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def table_of(columns, rows):
    """Columns by name, rows in any order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i].lower())
    return [columns[i].lower() for i in order], sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def as_dict(df, *keys):
    """Rows by key."""
    out = {}
    for row in df.collect():
        record = row.asDict()
        key = tuple(plain(record.pop(k)) for k in keys)
        out[key[0] if len(key) == 1 else key] = record
    return out
