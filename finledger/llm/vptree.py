"""Nearest neighbours by inner product: a vantage-point tree in each shard.

Largest inner products become smallest distances by one more component, ``sqrt(M^2 - |x|^2)`` with M the largest norm of
the shard (0 for queries). Distances are those of queries brought to the norm M, which keeps the order of their products:
so they lie on the sphere that the rows lie on, whatever their own norm. Rows are dealt by bands of norm into shards of
bounded size, so that a row of very large norm is with its like; shard and queries are scaled by powers of two, which
change no product. A shard's tree halves its rows again and again by their distance from a vantage point; it is built
once and stored with the rows. Queries are searched in blocks, all queries of a block at once: a node's nearer half comes
first, and the other half is entered only by queries for which

    |d(query, vantage) - boundary|  <=  factor * distance of the k-th nearest so far .

By the triangle inequality nothing is lost at factor 1; a smaller factor prunes more. Distances only prune: rows are
chosen by their products with the query, and scored on the original vectors in double precision.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from finledger.session import materialise

LEAF = 128
# Powers of two of the largest component in a band of norms.
BAND = 10
# Pairs of a shard and a block that are tasks of their own; beyond them a task takes several, one after the other.
TASKS = 20000
# What rounding adds to distances near 0, for norms about 1.
SLACK = 1e-7


@dataclass
class Tree:
    """Rows in leaf order; inner nodes with vantage row, boundary and the two halves; leaves with a slice of rows."""

    order: np.ndarray
    vantage: list[int]
    boundary: list[float]
    inner: list[int]
    outer: list[int]
    start: list[int]
    end: list[int]

    @classmethod
    def build(cls, points: np.ndarray, leaf: int = LEAF, seed: int = 5) -> Tree:
        tree = cls(np.arange(len(points)), [], [], [], [], [], [])
        rng = np.random.default_rng(seed)
        todo = [(0, len(points), None, False)]
        while todo:
            a, b, parent, far = todo.pop()
            node = len(tree.start)
            if parent is not None:
                (tree.outer if far else tree.inner)[parent] = node
            tree.start.append(a)
            tree.end.append(b)
            tree.inner.append(-1)
            tree.outer.append(-1)
            rows = tree.order[a:b]
            if b - a <= leaf:
                tree.vantage.append(-1)
                tree.boundary.append(0.0)
                continue
            vantage = int(rng.choice(rows))
            distance = np.sqrt(np.maximum(0, ((points[rows] - points[vantage]) ** 2).sum(axis=1)))
            half = (b - a) // 2
            parted = np.argpartition(distance, half)
            tree.order[a:b] = rows[parted]
            tree.vantage.append(vantage)
            tree.boundary.append(float(distance[parted[half]]))
            todo += [(a + half, b, node, True), (a, a + half, node, False)]
        return tree

    def packed(self) -> dict[str, bytes]:
        nodes = np.array([self.vantage, self.inner, self.outer, self.start, self.end], dtype="<i4")
        return {"order": self.order.astype("<i4").tobytes(), "nodes": nodes.tobytes(), "boundary": np.array(self.boundary, dtype="<f8").tobytes()}

    @classmethod
    def unpacked(cls, order: bytes, nodes: bytes, boundary: bytes) -> Tree:
        vantage, inner, outer, start, end = np.frombuffer(nodes, "<i4").reshape(5, -1).tolist()
        return cls(np.frombuffer(order, "<i4"), vantage, np.frombuffer(boundary, "<f8").tolist(), inner, outer, start, end)


class Search:
    """The ``k`` nearest rows of one tree for a block of queries.

    With ``lifted``, the norm that all points have, rows are chosen by the product alone, for squared distances would
    round small products away; distances, for the pruning, are those of the query brought to that norm.
    """

    def __init__(self, tree: Tree, points: np.ndarray, ids: np.ndarray, k: int, factor: float, lifted: float | None = None):
        self.tree, self.points, self.ids, self.k, self.factor, self.lifted = tree, points, ids, k, factor, lifted
        self.squares = (points**2).sum(axis=1)

    def run(self, queries: np.ndarray, query_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers (-1: none) and what they are compared by, nearest first; a query's own id is no candidate."""
        n = len(queries)
        self.queries, self.query_ids = queries, query_ids
        self.query_squares = (queries**2).sum(axis=1)
        if self.lifted is not None:
            self.stretch = self.lifted / np.sqrt(self.query_squares)
        self.rows = np.full((n, self.k), -1)
        self.best = np.full((n, self.k), np.inf)
        self._visit(0, np.arange(n))
        return self.rows, self.best

    def _distances(self, own: np.ndarray, rows: np.ndarray) -> np.ndarray:
        product = self.queries[own] @ self.points[rows].T
        if self.lifted is not None:
            return -2 * product
        return np.maximum(self.query_squares[own][:, None] + self.squares[rows] - 2 * product, 0)

    def _root(self, own: np.ndarray, compared: np.ndarray) -> np.ndarray:
        """The distance."""
        if self.lifted is not None:
            compared = compared * self.stretch[own] + 2 * self.lifted**2
        return np.sqrt(np.maximum(compared, 0))

    def _visit(self, node: int, own: np.ndarray) -> None:
        if not len(own):
            return
        tree = self.tree
        if tree.vantage[node] < 0:
            rows = tree.order[tree.start[node] : tree.end[node]]
            found = self._distances(own, rows)
            found[self.query_ids[own][:, None] == self.ids[rows]] = np.inf
            merged = np.concatenate([self.best[own], found], axis=1)
            names = np.concatenate([self.rows[own], np.broadcast_to(rows, found.shape)], axis=1)
            names[np.isinf(merged)] = -1
            ids = np.where(names >= 0, self.ids[names], np.iinfo(np.int64).max)
            order = np.lexsort((ids, merged), axis=1)[:, : self.k]
            self.best[own] = np.take_along_axis(merged, order, axis=1)
            self.rows[own] = np.take_along_axis(names, order, axis=1)
            return
        distance = self._root(own, self._distances(own, np.array([tree.vantage[node]]))[:, 0])
        gap = distance - tree.boundary[node]
        near = gap < 0
        self._visit(tree.inner[node], own[near])
        self._visit(tree.outer[node], own[~near])
        reach = np.abs(gap) <= self.factor * self._root(own, self.best[own, -1]) + SLACK
        self._visit(tree.outer[node], own[near & reach])
        self._visit(tree.inner[node], own[~near & reach])


def usable(vector: Column) -> Column:
    """Neither null, empty or zero nor with null or non-finite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _packed(arrays: pd.Series) -> bytes:
    return np.array(arrays.tolist(), dtype="<f8").tobytes()


def _matrix(packed: bytes, rows: int) -> np.ndarray:
    return np.frombuffer(packed, dtype="<f8").reshape(rows, -1)


def _scaled(rows: np.ndarray, exponent: np.ndarray | int) -> np.ndarray:
    return np.ldexp(rows, -np.asarray(exponent, dtype=np.int64))


def _lifted(own: np.ndarray) -> tuple[np.ndarray, float]:
    """Rows with one more component, so that all have the norm of the longest."""
    squares = (own**2).sum(axis=1)
    longest = float(np.sqrt(squares.max()))
    return np.column_stack([own, np.sqrt(np.maximum(0, longest**2 - squares))]), longest


def nearest(
    vectors: DataFrame,
    queries: Column,
    k: int = 20,
    factor: float = 0.2,
    shard_rows: int = 8192,
    block_rows: int = 8192,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """For each row that meets ``queries`` its ``k`` nearest other rows: query_id, rank, key, score.

    Every usable row is indexed; vectors of other lengths than the most frequent one are not comparable and take no
    part. Repeated rows of one key and vector count once; a key with several vectors takes part with the smallest. Rows
    without a key take no part. Ties go to the smaller key; scores beyond the range of doubles are infinite and tie. Each
    task holds one shard and one block of queries, both of bounded size, however many rows are equal. Every query looks
    into every shard: tasks and what they are sent grow with the number of shards times that of blocks, and the pruning
    works inside a shard.
    """
    clean = vectors.filter(F.col(key).isNotNull() & usable(F.col(vector)) & (F.size(vector) > 0))
    clean = clean.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), queries.alias("q"))
    clean = clean.groupBy("id").agg(F.min("v").alias("v"), F.max("q").alias("q"))
    clean = materialise(clean, "vectors")
    widths = clean.groupBy(F.size("v").alias("w")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "w").first()
    if widths is None:
        return clean.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias(key), F.lit(0.0).alias("score")
        )
    clean = clean.filter(F.size("v") == widths.w)
    largest = F.array_max(F.transform("v", F.abs))
    clean = clean.withColumn("band", F.floor(F.log2(largest) / BAND).cast("int"))
    # A few hundred bands at most, by the range of doubles.
    bands = clean.groupBy("band").agg(F.count("*").alias("rows"), F.count_if("q").alias("queries")).orderBy("band").collect()
    blocks = max(1, -(-sum(b.queries for b in bands) // block_rows))
    dims, start, ranges = widths.w, 0, []
    for band in bands:
        shards = -(-band.rows // shard_rows)
        ranges += [F.lit(band.band), F.struct(F.lit(start).alias("start"), F.lit(shards).alias("shards"))]
        start += shards
    place = F.element_at(F.create_map(*ranges), F.col("band"))

    def index(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        packed = _packed(group["v"])
        own = _matrix(packed, len(group))
        points, _ = _lifted(_scaled(own, np.frexp(np.abs(own).max())[1]))
        shard, ids = int(group["shard"].iloc[0]), group["id"].to_numpy("<i8").tobytes()
        return pd.DataFrame([{"shard": shard, "ids": ids, "vectors": packed, **Tree.build(points).packed()}])

    def block_of(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("id")
        block, ids = int(group["block"].iloc[0]), group["id"].to_numpy("<i8").tobytes()
        return pd.DataFrame([{"block": block, "query_ids": ids, "queries": _packed(group["v"])}])

    dealt = clean.withColumn("place", place)
    dealt = dealt.withColumn("shard", (F.col("place.start") + F.pmod(F.xxhash64("id"), F.col("place.shards"))).cast("int"))
    stored = "shard int, ids binary, vectors binary, order binary, nodes binary, boundary binary"
    trees = dealt.select("id", "v", "shard").groupBy("shard").applyInPandas(index, stored)
    asked = clean.filter("q").withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    asked = asked.select("id", "v", "block").groupBy("block")
    asked = materialise(asked.applyInPandas(block_of, "block int, query_ids binary, queries binary"), "blocks")
    trees = materialise(trees, "shards").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def search(row: dict) -> pd.DataFrame:
        ids, query_ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["query_ids"], "<i8")
        own, asked = _matrix(row["vectors"], len(ids)), _matrix(row["queries"], len(query_ids))
        exponent, exponents = np.frexp(np.abs(own).max())[1], np.frexp(np.abs(asked).max(axis=1))[1]
        own, asked = _scaled(own, exponent), _scaled(asked, exponents[:, None])
        points, longest = _lifted(own)
        tree = Tree.unpacked(row["order"], row["nodes"], row["boundary"])
        block = np.column_stack([asked, np.zeros(len(asked))])
        rows, _ = Search(tree, points, ids, k, factor, longest).run(block, query_ids)
        q, _ = found = np.nonzero(rows >= 0)
        picks = rows[found]
        score = np.zeros(len(picks))
        for c in range(dims):
            score += asked[q, c] * own[picks, c]
        with np.errstate(over="ignore"):
            score = np.ldexp(score, exponents[q].astype(np.int64) + exponent)
        return pd.DataFrame({"query_id": query_ids[q], "id": ids[picks], "score": score})

    def searched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                yield search(row)

    # The work is in the search, not in the bytes: each pair of a shard and a block is a task, as far as there are tasks.
    pairs = trees.join(asked, "block").withColumn("pair", F.col("shard") * blocks + F.col("block"))
    dealt = pairs.repartitionById(max(1, min(TASKS, start * blocks)), "pair")
    found = dealt.mapInPandas(searched, T.StructType.fromDDL("query_id long, id long, score double"))
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    ranked = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(key), "score")
