"""Byte-level BPE: encoding and decoding whole texts by a public rank file.

A text is cut into pieces by the pattern of the vocabulary; the distinct pieces of a batch that are no token themselves
are bucketed by length into padded numpy matrices. In every round each row merges its leftmost pair of minimum rank: the
rank matrix gives the position, the merged token takes the place of the pair, both matrices are compacted by one column,
and only the two pairs beside the new token are looked up again, in a hash table of all mergeable pairs. Rows without a
mergeable pair leave the matrix.

Encoded ids are packed as little-endian unsigned 32-bit integers, four bytes an id, the form in which token files are
kept; ``ids_array`` unpacks them.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NONE = np.int32(2**31 - 1)
CELLS = 1 << 19
LONG = 4096
CHARS = 1 << 20
SHIFT = 20


@dataclass
class Vocabulary:
    """Tokens by id, and the pairs of ids that join to a token, hashed with linear probing."""

    tokens: dict[bytes, int]
    byte_ids: np.ndarray
    flat: np.ndarray
    offsets: np.ndarray
    keys: np.ndarray
    merged: np.ndarray
    probes: int

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, "rb") as lines:
            return cls.of({base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())})

    @classmethod
    def of(cls, tokens: dict[bytes, int]) -> Vocabulary:
        byte_ids = np.array([tokens[bytes([b])] for b in range(256)], dtype=np.int32)
        by_id = {i: t for t, i in tokens.items()}
        sizes = np.zeros(max(by_id) + 2, dtype=np.int64)
        for i, t in by_id.items():
            sizes[i + 1] = len(t)
        flat = np.frombuffer(b"".join(by_id.get(i, b"") for i in range(len(sizes) - 1)), dtype=np.uint8)
        pairs, ranks = [], []
        for token, rank in tokens.items():
            for cut in range(1, len(token)):
                left, right = tokens.get(token[:cut]), tokens.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left << SHIFT | right)
                    ranks.append(rank)
        size = 1 << max(4, (4 * len(pairs)).bit_length())
        keys, merged = np.full(size, -1, dtype=np.int64), np.full(size, NONE, dtype=np.int32)
        todo, values, step = np.array(pairs, dtype=np.int64), np.array(ranks, dtype=np.int32), 0
        while len(todo):
            slots = (_hashed(todo, size) + step) & (size - 1)
            free = np.flatnonzero(keys[slots] == -1)
            _, first = np.unique(slots[free], return_index=True)
            placed = free[first]
            keys[slots[placed]], merged[slots[placed]] = todo[placed], values[placed]
            left = np.ones(len(todo), dtype=bool)
            left[placed] = False
            todo, values, step = todo[left], values[left], step + 1
        return cls(tokens, byte_ids, flat, np.cumsum(sizes), keys, merged, step)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank, which is the id, of the token that each pair joins to; ``NONE`` where there is none."""
        wanted = left.astype(np.int64) << SHIFT | right
        mask = len(self.keys) - 1
        slots = _hashed(wanted, len(self.keys))
        found = self.keys[slots]
        out = np.where(found == wanted, self.merged[slots], NONE)
        open_ = np.flatnonzero((found != wanted) & (found != -1))
        for step in range(1, self.probes):
            if not len(open_):
                break
            slot = (slots[open_] + step) & mask
            found = self.keys[slot]
            hit = found == wanted[open_]
            out[open_[hit]] = self.merged[slot[hit]]
            open_ = open_[~hit & (found != -1)]
        return out


def _hashed(keys: np.ndarray, size: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


def merge_matrix(pieces: list[bytes], vocabulary: Vocabulary) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, ids) by and by, ids one matrix for rows of the same number of tokens; pieces of similar lengths."""
    width = max(map(len, pieces))
    rows = np.arange(len(pieces))
    sizes = np.array([len(p) for p in pieces])
    raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8).reshape(-1, width)
    ids = vocabulary.byte_ids[raw]
    ranks = np.full(ids.shape, NONE, dtype=np.int32)
    if width > 1:
        pairs = vocabulary.pair_ranks(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        ranks[:, :-1] = np.where(np.arange(1, width) < sizes[:, None], pairs, NONE)
    while len(rows):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        over = best == NONE
        if over.any():
            for size in np.unique(sizes[over]):
                own = over & (sizes == size)
                yield rows[own], ids[own, :size]
            going = ~over
            rows, sizes, ids, ranks, at, best = rows[going], sizes[going], ids[going], ranks[going], at[going], best[going]
            if not len(rows):
                return
        n, width = ids.shape
        line, columns = np.arange(n), np.arange(width)
        ids[line, at] = best
        ids = ids[columns != (at + 1)[:, None]].reshape(n, width - 1)
        ranks = ranks[columns != at[:, None]].reshape(n, width - 1)
        sizes = sizes - 1
        after = at < sizes - 1
        right = np.full(n, NONE, dtype=np.int32)
        right[after] = vocabulary.pair_ranks(best[after], ids[line[after], at[after] + 1])
        ranks[line, at] = right
        before = at > 0
        ranks[line[before], at[before] - 1] = vocabulary.pair_ranks(ids[line[before], at[before] - 1], best[before])


def merge_long(piece: bytes, vocabulary: Vocabulary) -> np.ndarray:
    """The same merges for one very long piece, where compaction would be quadratic: a heap of (rank, position) over a
    linked list. A heap entry is stale when the pair at its position has another rank by now."""
    ids = vocabulary.byte_ids[np.frombuffer(piece, dtype=np.uint8)]
    ranks = [*vocabulary.pair_ranks(ids[:-1], ids[1:]).tolist(), int(NONE)]
    ids, end = ids.tolist(), len(piece)
    after, before = list(range(1, end + 1)), list(range(-1, end - 1))
    heap = [(r, i) for i, r in enumerate(ranks) if r != NONE]
    heapq.heapify(heap)

    def rank(i: int, j: int) -> None:
        found = int(vocabulary.pair_ranks(np.array([ids[i]]), np.array([ids[j]]))[0])
        ranks[i] = found
        if found != NONE:
            heapq.heappush(heap, (found, i))

    while heap:
        r, i = heapq.heappop(heap)
        if ranks[i] != r or ids[i] is None:
            continue
        j = after[i]
        ids[i], ids[j], ranks[j] = r, None, int(NONE)
        after[i] = k = after[j]
        ranks[i] = int(NONE)
        if k < end:
            before[k] = i
            rank(i, k)
        if before[i] >= 0:
            rank(before[i], i)
    return np.array([x for x in ids if x is not None], dtype=np.int32)


def encode_pieces(pieces: list[str], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of all pieces, and where each begins (one more entry than pieces)."""
    raw = [p.encode("utf-8", "surrogatepass") for p in pieces]
    whole = [vocabulary.tokens.get(p, -1) for p in raw]
    sizes = np.ones(len(raw), dtype=np.int64)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    known = np.array(whole, dtype=np.int32)
    single = np.flatnonzero(known >= 0)
    found.append((single, known[single][:, None]))
    lengths = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw))
    rest = np.flatnonzero((known < 0) & (lengths <= LONG))
    rest = rest[np.argsort(lengths[rest], kind="stable")]
    start = 0
    while start < len(rest):
        fits = np.searchsorted(lengths[rest[start:]] * np.arange(1, len(rest) - start + 1), CELLS, "right")
        bucket = rest[start : start + max(1, int(fits))]
        for rows, ids in merge_matrix([raw[i] for i in bucket], vocabulary):
            found.append((bucket[rows], ids))
        start += len(bucket)
    for i in np.flatnonzero((known < 0) & (lengths > LONG)):
        found.append((np.array([i]), merge_long(raw[i], vocabulary)[None, :]))
    for rows, ids in found:
        sizes[rows] = ids.shape[1]
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.zeros(offsets[-1], dtype=np.int32)
    for rows, ids in found:
        flat[offsets[rows][:, None] + np.arange(ids.shape[1])] = ids
    return flat, offsets


def gathered(flat: np.ndarray, offsets: np.ndarray, picks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The slices ``picks`` of ``flat`` one after another, and where each begins."""
    sizes = offsets[picks + 1] - offsets[picks]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(offsets[picks] - starts[:-1], sizes) + np.arange(starts[-1])], starts


def encode_texts(texts: list[str], vocabulary: Vocabulary, pattern: regex.Pattern) -> list[bytes]:
    """Packed ids of whole texts; texts are taken together up to ``CHARS`` characters, a longer one alone."""
    out: list[bytes] = []
    start = 0
    while start < len(texts):
        end, chars = start, 0
        while end < len(texts) and (end == start or chars + len(texts[end]) <= CHARS):
            chars += len(texts[end])
            end += 1
        pieces: list[str] = []
        marks = [0]
        for text in texts[start:end]:
            pieces += pattern.findall(text)
            marks.append(len(pieces))
        if pieces:
            codes, distinct = pd.factorize(np.array(pieces, dtype=object))
            flat, offsets = encode_pieces(list(distinct), vocabulary)
            ids, starts = gathered(flat, offsets, codes)
            packed = ids.astype("<u4").tobytes()
            at = starts[marks] * 4
            out += [packed[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        else:
            out += [b""] * (end - start)
        start = end
    return out


def decode_ids(packed: bytes, vocabulary: Vocabulary) -> bytes:
    """The bytes of packed ids."""
    ids = np.frombuffer(packed, dtype="<u4").astype(np.int64)
    if len(ids) and ids.max() >= len(vocabulary.offsets) - 1:
        raise ValueError(f"id {ids.max()} is not in the vocabulary")
    return gathered(vocabulary.flat, vocabulary.offsets, ids)[0].tobytes()


def slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch, some at a time, about ``CHARS`` bytes; null counts as empty."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)
    part = np.cumsum(sizes) // CHARS
    edges = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(texts)], strict=True):
        yield [t or "" for t in texts.slice(a, b - a).to_pylist()]


class ByteBpe:
    """Columns that encode and decode by one vocabulary, which is read on the driver and sent to the executors once.

    The vocabulary's size bounds what is broadcast: tens of thousands of tokens, a few megabytes. A batch stays in its
    Arrow buffer and is turned into Python texts a slice at a time.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        self.vocabulary = spark.sparkContext.broadcast(Vocabulary.load(path))
        self.pattern = pattern

    def encode(self, text: str = "text") -> Column:
        """Packed ids of the whole text; null and empty texts have no ids."""
        shared, pattern = self.vocabulary, self.pattern

        @F.arrow_udf("binary")
        def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary, pieces = shared.value, regex.compile(pattern)
            for texts in batches:
                parts = [pa.array(encode_texts(t, vocabulary, pieces), pa.binary()) for t in slices(texts)]
                yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

        return encoded(F.col(text))

    def decode(self, ids: str = "ids") -> Column:
        """The bytes that packed ids stand for; null stays null. An id outside the vocabulary is an error."""
        shared = self.vocabulary

        @F.arrow_udf("binary")
        def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary = shared.value
            for rows in batches:
                yield pa.array([None if r is None else decode_ids(r.as_py(), vocabulary) for r in rows], pa.binary())

        return decoded(F.col(ids))

    def round_trip(self, text: str = "text") -> Column:
        """struct<ids, decoded>: the packed ids, and the bytes that decoding these ids gives, in one pass."""
        shared, pattern = self.vocabulary, self.pattern
        kind = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])

        @F.arrow_udf("struct<ids: binary, decoded: binary>")
        def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            vocabulary, pieces = shared.value, regex.compile(pattern)
            for texts in batches:
                parts = []
                for some in slices(texts):
                    ids = encode_texts(some, vocabulary, pieces)
                    back = [decode_ids(i, vocabulary) for i in ids]
                    columns = [pa.array(ids, pa.binary()), pa.array(back, pa.binary())]
                    parts.append(pa.StructArray.from_arrays(columns, fields=list(kind)))
                yield pa.concat_arrays(parts) if parts else pa.array([], kind)

        return both(F.col(text))


def ids_array(ids: str = "ids") -> Column:
    """Packed ids as an array of longs."""

    @F.pandas_udf("array<long>")
    def unpacked(rows: pd.Series) -> pd.Series:
        return rows.map(lambda r: None if r is None else np.frombuffer(r, dtype="<u4").astype(np.int64))

    return unpacked(F.col(ids))


def tokenised(docs: DataFrame, bpe: ByteBpe, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Key, packed ids and the decoded bytes of every row; repeated rows stay, other columns are left behind."""
    return docs.select(F.col(key), bpe.round_trip(text).alias("_both")).select(key, "_both.ids", "_both.decoded")


def digests(tokens: DataFrame, key: str = "doc_id") -> DataFrame:
    """Number of ids, SHA-256 of the packed ids and of the decoded bytes."""
    return tokens.select(
        key,
        F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
