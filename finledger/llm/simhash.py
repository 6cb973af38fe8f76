"""SimHash near-duplicates: an inverted index on byte positions, count filtering, verification, components.

Two 64-bit fingerprints that differ in at most three bits agree in at least five of their eight bytes, position by
position. Of five byte positions three lie in one half of the word, so the index lists fingerprints under each three
positions of a half, with the bytes found there: eight lists for a fingerprint, 24 bits each, and every linked pair
meets in one. Inside a list the shared positional bytes of a pair are tallied; pairs with the guaranteed five are
verified by their bit distance. A list gives a spanning star for each group it links, never its pairs. Lists of more
than ``block`` fingerprints are compared block by block in separate tasks, so no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.session import materialise

SEED = 42
SLICE = 1 << 16


def fingerprint_of(text: str, shingle: int) -> int:
    """Signed 64-bit fingerprint of the word shingles of a text; 0 where there are no words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        hashes = [digest(joined, SEED)]
    else:
        ends, at = [], -1
        for word in words:
            at += len(word) + 1
            ends.append(at)
        starts = [0, *(e + 1 for e in ends)]
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
    ones = np.zeros(64, dtype=np.int64)
    values = np.array(hashes, dtype="<u8")
    for at in range(0, len(values), SLICE):
        part = values[at : at + SLICE]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(ones * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint(text: str = "text", shingle: int = 3) -> Column:
    """The fingerprint of a text as a long; null counts as empty."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint_of(t or "", shingle) for t in texts], dtype="int64")

    return of(F.col(text))


def linked_stars(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest fingerprint of its group) for the groups that links inside ``values`` form."""
    values = np.unique(values)
    shared_least = 8 - max_bits
    group = np.arange(len(values))
    for i in range(len(values) - 1):
        differing = values[i + 1 :] ^ values[i]
        shared = (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)
        near = np.flatnonzero(shared >= shared_least)
        near = near[np.bitwise_count(differing[near].view(np.uint64)) <= max_bits] + i + 1
        if len(near):
            met = np.unique(np.append(group[near], group[i]))
            if len(met) > 1:
                group[np.isin(group, met)] = met[0]
    return [(int(values[k]), int(values[g])) for k, g in enumerate(group) if k != g]


def near_edges(prints: DataFrame, max_bits: int = 3, block: int = 1024) -> DataFrame:
    """Edges (u, v), u > v, that connect whatever fingerprints differ in ``max_bits`` bits or fewer (3 at most)."""
    if not 0 <= max_bits <= 3:
        raise ValueError("three positions of a half are guaranteed for a distance of 0 to 3 bits only")
    masks = []
    for half in (0, 4):
        for left_out in range(4):
            kept = sum(0xFF << 8 * (half + k) for k in range(4) if k != left_out)
            masks.append(kept - (1 << 64) if kept >> 63 else kept)
    places = F.array(*[F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("bytes")) for i, m in enumerate(masks)])
    postings = prints.select("fp", F.explode(places).alias("p")).select("fp", "p.list", "p.bytes")
    sizes = postings.groupBy("list", "bytes").agg(F.count("*").alias("entries")).filter("entries > 1")
    # Written, like the minima below: the join then has plain shuffles on both sides, and a long list is split.
    sizes = materialise(sizes, "sizes")
    met = postings.join(sizes, ["list", "bytes"])
    blocks = F.ceil(F.col("entries") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    met = met.withColumn("blocks", blocks).withColumn("own", own)
    other = F.explode(F.expr("sequence(0, blocks - 1)"))
    met = met.withColumn("other", other)
    met = met.select("list", "bytes", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    lists = met.groupBy("list", "bytes", "i", "j").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)

    @F.pandas_udf("array<struct<u: long, v: long>>")
    def stars(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for found in batches:
            yield pd.Series([linked_stars(np.asarray(fps, dtype=np.int64), max_bits) for fps in found])

    return lists.select(F.explode(stars("fps")).alias("e")).select("e.u", "e.v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component of edges (u, v) with u > v.

    Large stars and small stars by turns, until nothing changes. Every round is written to the shared folder. The
    minima are combined before the shuffle, written and joined back, so a hub of any size is never one task's group.
    """
    edges = materialise(edges.select("u", "v"), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        least = materialise(least, "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialise(least.select("u", F.col("m").alias("v")).union(hung).distinct(), "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        state = now


def simhash_components(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3, block: int = 1024
) -> DataFrame:
    """Every row's key, ``fp`` (long), ``root`` (smallest fingerprint of its component) and ``component_id`` (smallest
    key of its component).

    Repeated rows stay repeated. A null key keeps its row; the component is named by the smallest known key, or null
    where no row of it has one. Null and empty texts have the fingerprint 0. Other columns are left behind.
    """
    members = materialise(docs.select(F.col(key), fingerprint(text, shingle).alias("fp")), "prints")
    roots = _roots(members, max_bits, block)
    prints = members.groupBy("fp").agg(F.min(key).alias("first"))
    placed = prints.join(roots, prints["fp"] == roots["node"], "left")
    placed = placed.select("fp", F.coalesce("root", "fp").alias("root"), "first")
    named = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    found = materialise(placed.select("fp", "root").join(named, "root"), "components")
    return members.join(found, "fp").select(key, "fp", "root", "component_id")


def _roots(members: DataFrame, max_bits: int, block: int) -> DataFrame:
    return components(near_edges(members.select("fp").distinct(), max_bits, block))


def keep_one_per_component(
    docs: DataFrame, shingle: int = 3, max_bits: int = 3, key: str = "doc_id", text: str = "text", block: int = 1024
) -> DataFrame:
    """The documents without their near-duplicates, with all their columns.

    Of each component the row of the smallest key stays (rows without a key come last). Rows that share this key are
    told apart by a hash of all columns, the smallest stays; of equal rows one stays.
    """
    own, keyless = "_row_hash", F.col(key).isNull()
    while own in docs.columns:
        own = f"_{own}"
    marked = docs.withColumn(own, F.xxhash64(*[F.col(c) for c, kind in docs.dtypes if "map<" not in kind]))
    members = materialise(marked.select(F.col(key), F.col(own).alias("row"), fingerprint(text, shingle).alias("fp")), "prints")
    roots = _roots(members, max_bits, block)
    least = F.min(F.struct(keyless.alias("keyless"), F.col(key).alias("id"), F.col("row"))).alias("first")
    prints = members.groupBy("fp").agg(least)
    placed = prints.join(roots, prints["fp"] == roots["node"], "left")
    kept = placed.groupBy(F.coalesce("root", "fp")).agg(F.min("first").alias("first"))
    kept = materialise(kept.select(F.col("first.id").alias("kept_id"), F.col("first.row").alias("kept_row")), "kept")
    stays = marked[own].eqNullSafe(kept["kept_row"]) & marked[key].eqNullSafe(kept["kept_id"])
    return marked.join(kept, stays, "left_semi").dropDuplicates([key, own]).drop(own)
