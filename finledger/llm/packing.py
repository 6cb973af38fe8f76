"""Lexical retrieval packing: sharded BM25 inverted indexes fill each seed document's window with its neighbours.

Texts become token ids. Whole windows of a document are sequences of their own; what remains, less than a window, is an
entry of a shard's index. Entries are dealt to shards by range of a MinHash of their token trigrams, so like texts meet,
and shards have bounded size whatever the number of copies. Token ids are the terms of BM25, and their document
frequencies and the mean length come from all entries of all shards. In a shard each seed asks the index for the unused
entries that are nearest to it; the best ones are put into its window whole, the one that reaches the end is cut there,
and its rest is the next seed. The last window of a shard is cut into powers of two, so that nothing is padded.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyspark
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from finledger.session import materialise

K1, B = 1.2, 0.75
BATCH_BYTES = 1 << 23
# The pattern of the rank file can't cross longer runs of white space; such texts go to the other library.
LONG_BLANK, LONG_TEXT = re.compile(r"\s{50000}"), 50000
# The library looks for special tokens before it splits a text; without any it finds an empty one at every character,
# which costs a third of the time. This one is not allowed anywhere, so it is ordinary text where it occurs.
UNUSED = "<|\x00unused\x00|>"


class Encoder:
    """Texts to token ids, special tokens taken as text. Both libraries give the same ids for the same vocabulary
    (tests); the rank file's is several times faster."""

    def __init__(self, vocabulary: str, ranks: dict[bytes, int], pattern: str):
        self.vocabulary, self.full = vocabulary, None
        special = {UNUSED: max(ranks.values(), default=0) + 1}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)

    def __call__(self, text: str) -> np.ndarray:
        if len(text) > LONG_TEXT and LONG_BLANK.search(text):
            if self.full is None:
                self.full = Tokenizer.from_str(self.vocabulary)
                self.full.encode_special_tokens = True
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def likeness(ids: np.ndarray) -> int:
    """The least hash of three ids in a row (or of all, where there are fewer): texts that share much often share it."""
    ids = ids.astype(np.uint64)
    hashes = ids[: max(1, len(ids) - 2)].copy()
    for k in (1, 2):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15)
        if len(ids) > k:
            hashes ^= ids[k : len(hashes) + k] if len(ids) >= 3 else ids[k]
        hashes ^= hashes >> np.uint64(29)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    return int((hashes >> np.uint64(1)).min())


def encoded(make, end_id: int, window: int, width: str, key: pa.DataType):
    """(key, text) to pieces (key, start, ids, doc_tokens, sequence, like): whole windows with the sequence they make,
    and the rest with its MinHash."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, made = make(), pyspark.TaskContext.get().partitionId(), 0
        names = ["key", "start", "ids", "doc_tokens", "sequence", "like"]
        kinds = [key, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        rows: list[tuple] = []
        held = 0

        def packed() -> pa.RecordBatch:
            return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            keys, texts = batch.columns
            for i in range(batch.num_rows):
                name, text = keys[i].as_py(), texts[i].as_py()
                ids = np.append(encode(text or ""), end_id).astype(width)
                for start in range(0, len(ids), window):
                    own = ids[start : start + window]
                    if len(own) == window:
                        # Odd numbers; those of the shards are even.
                        rows.append((name, start, own.tobytes(), len(ids), ((part << 31) + made) * 2 + 1, None))
                        made += 1
                    else:
                        rows.append((name, start, own.tobytes(), len(ids), None, likeness(own)))
                    held += own.nbytes
                    if held > BATCH_BYTES:
                        yield packed()
                        rows, held = [], 0
        if rows:
            yield packed()

    return of


def token_statistics(width: str, vocabulary: int):
    """Entries to (token, entries that have it), added up within a task; token -1 has the number of entries and ids."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, entries, length = np.zeros(vocabulary, dtype=np.int64), 0, 0
        seen, held = np.zeros((256, vocabulary), dtype=np.uint8), 0
        for batch in batches:
            for ids in batch.column(0):
                own = np.frombuffer(ids.as_buffer(), dtype=width)
                if held == len(seen):
                    counts += seen.sum(axis=0, dtype=np.int64)
                    seen[:], held = 0, 0
                seen[held, own] = 1
                entries, length, held = entries + 1, length + len(own), held + 1
        counts += seen.sum(axis=0, dtype=np.int64)
        tokens = np.flatnonzero(counts)
        columns = [np.append(tokens, -1), np.append(counts[tokens], entries), np.append(np.zeros(len(tokens), dtype=np.int64), length)]
        yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], names=["token", "entries", "length"])

    return of


class Index:
    """A BM25 inverted index: postings by token, each with its weight."""

    def __init__(self, entries: list[np.ndarray], idf: np.ndarray, mean: float):
        self.idf, self.size = idf, len(entries)
        lengths = np.array([len(e) for e in entries])
        token = np.concatenate(entries)
        # Stable, so the entries of a token stay in order; on 16 bits numpy sorts by digits.
        order = np.argsort(token, kind="stable")
        token, entry = token[order], np.repeat(np.arange(self.size, dtype=np.int32), lengths)[order]
        new = np.ones(len(token), dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (entry[1:] != entry[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(token)))
        token, self.entry = token[first], entry[first]
        scale = K1 * (1 - B + B * lengths[self.entry] / mean)
        self.weight = idf[token] * times * (K1 + 1) / (times + scale)
        self.at = np.searchsorted(token, np.arange(len(idf) + 1))

    def scores(self, ids: np.ndarray, terms: int, used: np.ndarray) -> np.ndarray:
        """What each entry scores for the ``terms`` rarest tokens of ``ids``; 0 where it is used or shares none."""
        own = np.unique(ids)
        own = own[self.at[own + 1] - self.at[own] > 0]
        own = own[np.argsort(-self.idf[own], kind="stable")[:terms]]
        spans = [slice(self.at[t], self.at[t + 1]) for t in own]
        if not spans:
            return np.zeros(self.size)
        entry = np.concatenate([self.entry[s] for s in spans])
        score = np.bincount(entry, np.concatenate([self.weight[s] for s in spans]), minlength=self.size)
        score[used] = 0
        return score

    def ranked(self, ids: np.ndarray, terms: int, used: np.ndarray, first: int = 32) -> Iterator[int]:
        """Unused entries that share one of the rarest tokens, by score; ties to the earlier. All but the ``first`` are
        put in order only when they are asked for."""
        score = self.scores(ids, terms, used)
        found = np.flatnonzero(score > 0)
        least = np.partition(score[found], -first)[-first] if len(found) > first else 0
        best = score[found] >= least
        for some in (found[best], found[~best]):
            yield from some[np.argsort(-score[some], kind="stable")].tolist()


def pack_shard(entries: list[np.ndarray], idf: np.ndarray, mean: float, window: int, terms: int) -> list[list[tuple]]:
    """Sequences of (entry, start, end): each seed's window filled with its neighbours, then with the entries that come
    next; all but the parts of the last are full."""
    index = Index(entries, idf, mean)
    used, following = np.zeros(len(entries), dtype=bool), 0
    sequences: list[list[tuple]] = []
    rest = None
    while True:
        if rest is None:
            while following < len(entries) and used[following]:
                following += 1
            if following == len(entries):
                return sequences
            rest = (following, 0, len(entries[following]))
            used[following] = True
        filled, space = [rest], window - (rest[2] - rest[1])
        seed, rest = entries[rest[0]], None
        neighbours = index.ranked(seed, terms, used) if space else iter(())
        while space:
            pick = next(neighbours, None)
            if pick is None:
                while following < len(entries) and used[following]:
                    following += 1
                if following == len(entries):
                    break
                pick = following
            if used[pick]:
                continue
            used[pick] = True
            size = len(entries[pick])
            filled.append((pick, 0, min(size, space)))
            if size > space:
                rest = (pick, space, size)
            space -= min(size, space)
        if not space:
            sequences.append(filled)
        else:
            sequences += powers_of_two(filled, window - space)


def powers_of_two(pieces: list[tuple], length: int) -> list[list[tuple]]:
    """The pieces cut into sequences whose lengths are the powers of two of ``length``, the largest first."""
    out = []
    pieces = list(pieces)
    for size in (1 << k for k in reversed(range(length.bit_length())) if length >> k & 1):
        own = []
        while size:
            entry, start, end = pieces.pop(0)
            take = min(size, end - start)
            own.append((entry, start, start + take))
            if take < end - start:
                pieces.insert(0, (entry, start + take, end))
            size -= take
        out.append(own)
    return out


def packed_shards(statistics, window: int, terms: int, width: str, key: pa.DataType):
    """Entries of a shard (key, start, ids, doc_tokens) to pieces (key, start, ids, doc_tokens, sequence, place), with ids
    of 32 bits."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "start", "ids", "doc_tokens", "sequence", "place"]
        kinds = [key, pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        columns = [[], [], [], []]
        for batch in batches:
            for own, more in zip(columns, batch.columns, strict=True):
                own += more.to_pylist()
        if not columns[0]:
            return
        # The same order whatever the order of arrival.
        order = sorted(range(len(columns[0])), key=lambda i: (columns[0][i] is not None, columns[0][i] or 0, columns[2][i], columns[1][i]))
        keys, starts, packed, totals = ([c[i] for i in order] for c in columns)
        entries = [np.frombuffer(p, dtype=width) for p in packed]
        idf, mean = statistics.value
        part = pyspark.TaskContext.get().partitionId()
        rows, held = [], 0
        for made, pieces in enumerate(pack_shard(entries, idf, mean, window, terms)):
            place = 0
            for entry, a, b in pieces:
                ids = entries[entry][a:b]
                rows.append((keys[entry], starts[entry] + a, ids.astype("<u4").tobytes(), totals[entry], ((part << 31) + made) * 2, place))
                place += b - a
                held += ids.nbytes
            if held > BATCH_BYTES:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows, held = [], 0
        if rows:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return of


def packed_sequences(
    docs: DataFrame,
    vocabulary: str,
    ranks: str,
    pattern: str,
    window: int = 2048,
    end_id: int = 1,
    terms: int = 32,
    shard_tokens: int = 1 << 21,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, start, length, ids, doc_tokens, sequence_id, offset): the pieces of all documents' ids, packed.

    ``ids`` are little-endian unsigned 32-bit integers. A document's ids are those of its whole text (null: empty) and
    ``end_id``; each lies in one piece. Sequences are ``window`` ids long, and at the end of a shard as long as smaller
    powers of two, so none is padded. A seed asks for entries by its ``terms`` rarest tokens; where no unused entry
    shares one, the shard's next entries fill the window, so every entry is packed. Repeated rows are documents of their
    own; rows without a key keep their ids. Other columns are left behind.

    ``vocabulary`` is the tokenizer's file, ``ranks`` the same vocabulary as ranks; both go to the tasks, as does one
    number for each token: all are bounded by the vocabulary. ``window`` must be a power of two.
    """
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    context = docs.sparkSession.sparkContext
    with open(vocabulary, encoding="utf-8") as file:
        content = file.read()
    size = max(Tokenizer.from_str(content).get_vocab_size(), end_id + 1)
    width = "<u2" if size <= 1 << 16 else "<u4"
    shared = context.broadcast((content, read_ranks(ranks), pattern))
    name = docs.schema[key].dataType
    kind = f"key {name.simpleString()}, start long, ids binary, doc_tokens long, "
    texts = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    made = encoded(lambda: Encoder(*shared.value), end_id, window, width, to_arrow_type(name))
    pieces = materialise(texts.mapInArrow(made, kind + "sequence long, like long"), "tokens")

    entries = pieces.filter("sequence IS NULL")
    counted = entries.select("ids").mapInArrow(token_statistics(width, size), "token long, entries long, length long")
    # A row for each token of the vocabulary at most.
    found = counted.groupBy("token").agg(F.sum("entries").alias("entries"), F.sum("length").alias("length")).toPandas()
    whole = found[found["token"] < 0]
    total, length = int(whole["entries"].sum()), int(whole["length"].sum())
    idf = np.zeros(size)
    found = found[found["token"] >= 0]
    idf[found["token"]] = np.log(1 + (total - found["entries"] + 0.5) / (found["entries"] + 0.5))
    statistics = context.broadcast((idf, max(1.0, length / max(1, total))))

    shards = max(1, -(-length // shard_tokens))
    routed = entries.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(shards, "like", "key", "_at")
    packing = packed_shards(statistics, window, terms, width, to_arrow_type(name))
    filled = routed.select("key", "start", "ids", "doc_tokens").mapInArrow(packing, kind + "sequence long, place long")

    @F.arrow_udf("binary")
    def widened(ids: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(i.as_buffer(), dtype=width).astype("<u4").tobytes() for i in ids], pa.binary())

    whole = pieces.filter("sequence IS NOT NULL")
    alone = whole.select("key", "start", widened("ids").alias("ids"), "doc_tokens", "sequence", F.lit(0).cast("long").alias("place"))
    return filled.union(alone).select(
        F.col("key").alias(key),
        "start",
        F.floor(F.octet_length("ids") / 4).cast("long").alias("length"),
        "ids",
        "doc_tokens",
        F.col("sequence").alias("sequence_id"),
        F.col("place").alias("offset"),
    )
