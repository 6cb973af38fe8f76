import numpy as np
import pytest
from pyspark.sql import functions as F

from finledger.llm import queries, vptree


def plain_nearest(ids, points, asked, k):
    out = set()
    for q in asked:
        score = np.zeros(len(points))
        for c in range(points.shape[1]):
            score += points[q, c] * points[:, c]
        order = sorted((-s, i) for s, i in zip(score.tolist(), ids, strict=True) if i != ids[q])[:k]
        out |= {(ids[q], rank, i, -s) for rank, (s, i) in enumerate(order, 1)}
    return out


def rows_of(df):
    return {tuple(r) for r in df.select("query_id", "rank", "vec_id", "score").collect()}


@pytest.mark.parametrize("shard_rows, block_rows", [(4096, 2048), (300, 20)])
def test_factor_one_is_exact(spark, shard_rows, block_rows):
    rng = np.random.default_rng(8)
    points = rng.normal(size=(900, 6)) * rng.uniform(0.2, 3, size=(900, 1))
    points[100:160] = points[100]
    points = np.round(points, 3)
    ids = list(range(900))
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in zip(ids, points, strict=True)], "vec_id long, embedding array<double>")
    found = vptree.nearest(frame, F.col("vec_id") % 20 == 0, k=7, factor=1.0, shard_rows=shard_rows, block_rows=block_rows)
    assert rows_of(found) == plain_nearest(ids, points, range(0, 900, 20), 7)


def test_pruning_is_relaxed_by_the_factor():
    rng = np.random.default_rng(2)
    points, ids = rng.normal(size=(2000, 3)), np.arange(2000)
    tree = vptree.Tree.build(points)
    sizes = {}
    for factor in (0.0, 0.3, 1.0):
        search = vptree.Search(tree, points, ids, 5, factor)
        looked = []
        plain = search._distances
        search._distances = lambda own, rows, plain=plain, looked=looked: (looked.append(len(own) * len(rows)), plain(own, rows))[1]
        found, _ = search.run(points[:50], ids[:50])
        sizes[factor] = sum(looked)
        if factor == 1.0:
            exact = ((points[:50, None] - points[None]) ** 2).sum(-1)
            exact[np.arange(50), np.arange(50)] = np.inf
            assert (np.sort(found, axis=1) == np.sort(np.argsort(exact, axis=1)[:, :5], axis=1)).all()
    assert sizes[0.0] < sizes[0.3] < sizes[1.0] < 50 * 2000


def recall(spark, frame, **options):
    rows = frame.select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, points = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    asked = np.flatnonzero(ids % 20 == 0)
    product = points[asked] @ points.T
    product[np.arange(len(asked)), asked] = -np.inf
    best = np.argpartition(-product, 20, axis=1)[:, :20]
    want = {(int(ids[q]), int(ids[i])) for q, row in zip(asked, best, strict=True) for i in row}
    found = vptree.nearest(frame, F.col("vec_id") % 20 == 0, k=20, **options)
    return len(want & {(r.query_id, r.vec_id) for r in found.collect()}) / len(want)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
@pytest.mark.parametrize("options", [{}, {"shard_rows": 300}, {"shard_rows": 900, "block_rows": 40}])
def test_recall_on_larger_tables(spark, sf, options):
    frame = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    assert recall(spark, frame, **options) >= 0.95


def test_recall_over_several_bands_of_norm(spark):
    """Norms from 1e-4 to 1e4: queries and rows of any norm are searched on the same sphere."""
    frame = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    scale = F.pow(F.lit(10.0), (F.col("vec_id") % 5 - 2) * 2)
    own = F.transform("embedding", lambda x: x.cast("double") * F.when(F.col("vec_id") % 20 == 0, scale).otherwise(1.0))
    assert recall(spark, frame.withColumn("embedding", own), shard_rows=200) >= 0.95
    query = F.transform("embedding", lambda x: x.cast("double") * scale)
    assert recall(spark, frame.withColumn("embedding", query), shard_rows=200) >= 0.95


def test_recall_of_the_query(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/embeddings.parquet").orderBy("vec_id").collect()
    ids, points = [r.vec_id for r in rows], np.array([r.embedding for r in rows], dtype=float)
    asked = [k for k, i in enumerate(ids) if i % 20 == 0]
    want = plain_nearest(ids, points, asked, 20)
    found = rows_of(queries.QUERIES["op3_nearest"](spark, data_dir))
    pairs = {(q, v) for q, _, v, _ in want}
    assert len(pairs & {(q, v) for q, _, v, _ in found}) >= 0.9 * len(pairs)
    assert {(q, r) for q, r, _, _ in found} == {(q, r) for q, r, _, _ in want}
    scores = {(ids[q], v): s for q in asked for v, s in zip(ids, (points[q] * points).sum(axis=1).tolist(), strict=True)}
    assert all(abs(scores[q, v] - s) < 1e-12 for q, _, v, s in found)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]), (0, [1.0, 0.0]), (20, [0.0, 2.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0]),
        (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (None, [1.0, 1.0]), (9, []),
        (10, [1.0, 1.0, 1.0]), (40, [0.0, 0.0]), (11, [0.5, 0.5]), (11, [0.1, 0.1]),
    ]
    frame = spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, score int")
    asked = F.col("vec_id") % 20 == 0
    found = sorted(rows_of(vptree.nearest(frame, asked, k=20, factor=1.0)))
    assert [f[:3] for f in found] == [
        (0, 1, 1), (0, 2, 2), (0, 3, 11), (0, 4, 20), (0, 5, 3), (20, 1, 1), (20, 2, 2), (20, 3, 11), (20, 4, 0), (20, 5, 3),
    ]
    empty = vptree.nearest(frame.limit(0), asked)
    assert empty.columns == ["query_id", "rank", "vec_id", "score"] and empty.collect() == []
    assert vptree.nearest(frame.filter("vec_id = 5"), asked).collect() == []
    assert vptree.nearest(frame.filter("vec_id = 20"), asked).collect() == []
    assert vptree.nearest(frame.filter("vec_id in (1, 2)"), asked).collect() == []


@pytest.mark.parametrize("norm", [1e9, 1e200, 1e-9])
def test_one_row_of_another_norm_changes_no_other(spark, norm):
    rng = np.random.default_rng(4)
    points = rng.normal(size=(1500, 16))
    points /= np.sqrt((points**2).sum(axis=1))[:, None]
    points[7] *= norm
    points[40] *= norm**0.4
    ids = list(range(1500))
    frame = spark.createDataFrame([(i, p.tolist()) for i, p in zip(ids, points, strict=True)], "vec_id long, embedding array<double>")
    found = rows_of(vptree.nearest(frame, F.col("vec_id") % 20 == 0, k=20, factor=1.0, shard_rows=400))
    assert found == plain_nearest(ids, points, range(0, 1500, 20), 20)
