"""Quantiles and ranks over sorted parts give what numpy and ranking windows give."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from finledger.operators import distribution as D


def sample(spark):
    rng = random.Random(3)
    rows = []
    for group, size in (("hot", 4000), ("mid", 300), ("one", 1), (None, 50), ("two", 2)):
        for _ in range(size):
            # A third of the rows share one value; some are missing.
            draw = rng.random()
            value = None if draw < 0.05 else 7.5 if draw < 0.4 else round(rng.lognormvariate(0, 3) * rng.choice([1, -1]), 4)
            rows.append((group, value))
    rows.append(("two", 1.0))
    return rows, spark.createDataFrame(rows, "g string, v double")


def test_quantiles(spark):
    rows, df = sample(spark)
    wanted = {"p02": 0.02, "p50": 0.5, "p90": 0.9}
    found = {r["g"]: r for r in D.group_quantiles(df, ["g"], "v", wanted).collect()}
    assert found.keys() == {g for g, v in rows if v is not None}
    for group, row in found.items():
        values = np.array([v for g, v in rows if g == group and v is not None])
        for name, p in wanted.items():
            assert row[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)


def test_ranks(spark):
    _, df = sample(spark)
    group = Window.partitionBy("g")
    direct = df.withColumns(
        {
            "_dense_desc": F.dense_rank().over(group.orderBy(F.col("v").desc_nulls_last())),
            "_percent": F.percent_rank().over(group.orderBy(F.col("v").asc_nulls_first())),
        }
    )
    spread = D.group_ranks(df, ["g"], "v")
    assert spread.columns == direct.columns and direct.filter("v is null").count() > 100

    def key(r):
        return (str(r["g"]), str(r["v"]), r["_dense_desc"], round(r["_percent"], 12))

    assert sorted(map(key, spread.collect())) == sorted(map(key, direct.collect()))


def test_global_quantile(spark):
    _, df = sample(spark)
    one = D.group_quantiles(df.filter("g = 'hot'"), ["g"], "v", {"m": 0.5}).first()["m"]
    assert one == 7.5 or isinstance(one, float)


def test_fractional_rank_is_not_percent_rank(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None)], "s string, v double")
    df = df.withColumn("k", F.lit(1))
    up = {r["s"]: r["r"] for r in D.fractional_rank(df, ["k"], "v", "r").collect()}
    assert up["a"] == pytest.approx(1 / 3) and up["b"] == up["c"] == pytest.approx(2.5 / 3) and up["d"] is None


def test_positions(spark):
    _, df = sample(spark)
    df = df.withColumn("id", F.monotonically_increasing_id())
    want = df.withColumn("p", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert sorted(map(str, D.group_positions(df, ["g"], ["v", "id"], "p").collect())) == sorted(map(str, want.collect()))
    assert D.group_positions(df, ["g"], ["v", "id"], "p", top=2).count() == 9


def test_one_value_may_be_missing_in_a_group(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 2.0), ("a", None)], "g string, v double")
    got = sorted((r["v"] or 0, r["_dense_desc"], round(r["_percent"], 2)) for r in D.group_ranks(df, ["g"], "v").collect())
    assert got == [(0, 3, 0.0), (1.0, 2, 0.33), (2.0, 1, 0.67), (2.0, 1, 0.67)]


def test_clip(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)] + [("a", None)], "g string, v double")
    clipped = D.clip_to_quantiles(df, ["g"], "v", "c", 0.02, 0.98).collect()
    assert {r["c"] for r in clipped if r["v"] is not None and r["v"] < 2} == {2.0}
    assert max(r["c"] for r in clipped if r["c"] is not None) == 98.0
    assert [r["c"] for r in clipped if r["v"] is None] == [None]


def test_describe(spark):
    _, df = sample(spark)
    rows = {r["g"]: r for r in D.describe_group(df, ["g"], "v").collect()}
    assert rows["hot"]["N"] > 3000 and rows["hot"]["P25"] <= rows["hot"]["P50"] <= rows["hot"]["P75"]
