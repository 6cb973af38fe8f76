"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

The benchmark is read in blocks of at most ``block_chars`` characters. For a block, one pass over all documents counts
in how many of them each word n-gram of the block occurs. In every run of ``window`` consecutive n-grams of an item the
one in the fewest documents becomes a seed, so whatever shares ``window + n - 1`` words in a row with an item meets a
seed, also for items that are copied everywhere. A second pass joins the seeds to the passages, inside the tasks against
the block's bounded seed table, and aligns each item with the words around its seeds. The score of a leak is the local
alignment score (match 2, mismatch -1, gap -1) as a share of that of a perfect copy; edits and paraphrases lower it.

What is met by chance is a number of words, which hardly depends on the item: half the alignment score, the matched words
less half a word for each edit, must be at least ``CHANCE`` as well, or nearly the whole of a shorter item. Of a long item
a part is enough: ``PART`` words under penalties that end an alignment where it is no longer a copy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.session import materialise

WORD = re.compile(r"\w+")
BITS = 21
MATCH, MISMATCH, GAP = 2, -1, -1
# Matched words beyond chance; the share of an item with fewer words that counts as all of it.
CHANCE, WHOLE = 10, 0.9
# Matched words of a part of a long item, and what a mismatch or a gap costs there.
PART, STRICT = 20, -3
CHARS = 1 << 22
CELLS = 1 << 18
LEAKS = "array<struct<item_id: long, score: double, char_start: int, char_end: int>>"


@dataclass
class Block:
    """Items of a benchmark by number, their words as ids (from 1), and their distinct n-grams, sorted."""

    n: int
    items: list[int | None]
    words: dict[str, int]
    texts: list[np.ndarray]
    grams: np.ndarray
    seeds: dict[int, list[tuple[int, int]]] = field(default_factory=dict)
    is_seed: np.ndarray | None = None

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]], n: int) -> Block:
        words: dict[str, int] = {}
        texts = [
            np.array([words.setdefault(w, len(words) + 1) for w in WORD.findall(text.lower())], dtype=np.int64)
            for _, text in rows
        ]
        keys = [gram_keys(t, n)[1] for t in texts]
        return cls(n, [i for i, _ in rows], words, texts, np.unique(np.concatenate([np.zeros(0, np.int64), *keys])))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Number of each n-gram in ``grams``, -1 for others."""
        if not len(self.grams):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
        return np.where(self.grams[at] == keys, at, -1)

    def choose_seeds(self, frequency: np.ndarray, window: int) -> None:
        """The rarest n-gram of each ``window`` in a row (all of a shorter item count as one run); ties to the first."""
        self.is_seed = np.zeros(len(self.grams), dtype=bool)
        for text in self.texts:
            numbers = self.find(gram_keys(text, self.n)[1])
            if len(numbers):
                span = min(window, len(numbers))
                runs = np.lib.stride_tricks.sliding_window_view(frequency[numbers], span)
                self.is_seed[numbers[np.arange(len(runs)) + runs.argmin(axis=1)]] = True
        for item, text in enumerate(self.texts):
            for at, number in enumerate(self.find(gram_keys(text, self.n)[1])):
                if self.is_seed[number]:
                    self.seeds.setdefault(int(number), []).append((item, at))


def gram_keys(ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and keys of the n-grams that have known words only (id 0 is an unknown word)."""
    if len(ids) < n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    known = ids > 0
    whole = known[: len(ids) - n + 1].copy()
    for k in range(1, n):
        whole &= known[k : len(ids) - n + 1 + k]
    at = np.flatnonzero(whole)
    keys = np.zeros(len(at), dtype=np.int64)
    for k in range(n):
        keys = keys << BITS | ids[at + k]
    return at, keys


def numbered(texts: list[str], words: dict[str, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, word ids of some texts in a row, where each begins); a 0 stands between texts."""
    start = 0
    while start < len(texts):
        end, chars, parts, marks = start, 0, [], [0]
        while end < len(texts) and (end == start or chars + len(texts[end]) <= CHARS):
            chars += len(texts[end])
            found = WORD.findall(texts[end].lower())
            found.append("")
            parts.append(found)
            marks.append(marks[-1] + len(found))
            end += 1
        ids = np.fromiter(map(words.get, chain.from_iterable(parts), repeat(0)), dtype=np.int64, count=marks[-1])
        yield start, ids, np.array(marks)
        start = end


def document_frequency(docs: DataFrame, block: Block, text: str) -> np.ndarray:
    """In how many documents each n-gram of the block occurs; counted in the tasks first."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(block.grams), dtype=np.int64)
        for batch in batches:
            for _, ids, marks in numbered([t or "" for t in batch["text"]], block.words):
                at, keys = gram_keys(ids, block.n)
                numbers = block.find(keys)
                at, numbers = at[numbers >= 0], numbers[numbers >= 0]
                doc = np.searchsorted(marks, at, "right")
                once = np.unique(doc * len(block.grams) + numbers)
                np.add.at(total, once % max(1, len(block.grams)), 1)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"gram": seen, "docs": total[seen]})

    found = docs.select(F.col(text).alias("text")).mapInPandas(counted, "gram long, docs long")
    frequency = np.zeros(len(block.grams), dtype=np.int64)
    for row in found.groupBy("gram").agg(F.sum("docs").alias("docs")).collect():
        frequency[row.gram] = row.docs
    return frequency


def align(
    items: list[np.ndarray], windows: list[np.ndarray], mismatch: int = MISMATCH, gap: int = GAP
) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman score of each item in its window of words, and where the best alignment ends.

    Many pairs at once, one row of the tables a step; a run of gaps along a row is a running maximum. Pairs of similar
    lengths go together, padded by ids that match nothing.
    """
    scores, ends = np.zeros(len(items), dtype=np.int64), np.zeros(len(items), dtype=np.int64)
    order = sorted(range(len(items)), key=lambda k: (len(windows[k]), len(items[k])))
    start = 0
    while start < len(order):
        end = start + 1
        while end < len(order) and len(windows[order[end]]) * (end - start + 1) <= CELLS:
            end += 1
        own = order[start:end]
        height, width = max(len(items[k]) for k in own), max(len(windows[k]) for k in own)
        rows, columns = np.full((len(own), height), -1), np.full((len(own), width), -2)
        for line, k in enumerate(own):
            rows[line, : len(items[k])] = items[k]
            columns[line, : len(windows[k])] = windows[k]
        table = np.zeros((len(own), width + 1), dtype=np.int32)
        ramp = np.arange(width, dtype=np.int32) * -gap
        best, at = np.zeros(len(own), dtype=np.int32), np.zeros(len(own), dtype=np.int64)
        for r in range(height):
            step = np.where(columns == rows[:, r, None], np.int32(MATCH), np.int32(mismatch))
            now = np.maximum(np.maximum(table[:, :-1] + step, table[:, 1:] + gap), 0)
            now = np.maximum.accumulate(now + ramp, axis=1) - ramp
            table[:, 1:] = now
            top = now.argmax(axis=1)
            value = now[np.arange(len(own)), top]
            better = value > best
            best[better], at[better] = value[better], top[better] + 1
        scores[own], ends[own] = best, at
        start = end
    return scores, ends


def leaking(items: list[np.ndarray], windows: list[np.ndarray], scores: np.ndarray, least: float) -> np.ndarray:
    """Which pairs are a leak: ``least`` of the item and more words than chance gives, all of a short item, or a part."""
    sizes, matched = np.array([len(i) for i in items]), scores / MATCH
    good = matched >= np.minimum(np.maximum(least * sizes, CHANCE), np.maximum(WHOLE, least) * sizes)
    # The strict score is never above the other one.
    rest = np.flatnonzero(~good & (matched >= PART)).tolist()
    if rest:
        strict, _ = align([items[k] for k in rest], [windows[k] for k in rest], STRICT, STRICT)
        good[rest] = strict / MATCH >= PART
    return good


def leaks_of(texts: list[str], block: Block, least: float) -> list[list[tuple[int | None, float, int, int]]]:
    """For each text the items it holds: (item, score, first and last character), by item."""
    out: list[list[tuple[int | None, float, int, int]]] = [[] for _ in texts]
    for first, ids, marks in numbered(texts, block.words):
        at, keys = gram_keys(ids, block.n)
        numbers = block.find(keys)
        hit = (numbers >= 0) & block.is_seed[numbers]
        met: dict[tuple[int, int], list[int]] = {}
        for place, number in zip(at[hit].tolist(), numbers[hit].tolist(), strict=True):
            doc = int(np.searchsorted(marks, place, "right")) - 1
            for item, offset in block.seeds[number]:
                met.setdefault((doc, item), []).append(place - offset)
        pairs, items, windows, starts = [], [], [], []
        for (doc, item), begins in met.items():
            size = len(block.texts[item])
            begins.sort()
            low = high = begins[0]
            for begin in [*begins[1:], None]:
                if begin is not None and begin - high <= size:
                    high = begin
                    continue
                a = max(int(marks[doc]), low - size // 2)
                b = min(int(marks[doc + 1]) - 1, high + size + size // 2)
                pairs.append((doc, item))
                items.append(block.texts[item])
                windows.append(ids[a:b])
                starts.append(a)
                low = high = begin
        if not pairs:
            continue
        scores, ends = align(items, windows)
        shares = scores / (MATCH * np.array([len(i) for i in items]))
        good = np.flatnonzero(leaking(items, windows, scores, least)).tolist()
        if not good:
            continue
        _, back = align([items[k][::-1] for k in good], [windows[k][: ends[k]][::-1] for k in good])
        found: dict[tuple[int, int], tuple[float, int, int]] = {}
        for k, size in zip(good, back.tolist(), strict=True):
            last = starts[k] + int(ends[k])
            span = (float(shares[k]), -(last - size), -last)
            found[pairs[k]] = max(span, found.get(pairs[k], span))
        for doc in sorted({d for d, _ in found}):
            text = texts[first + doc].lower()
            words = [m.span() for m in WORD.finditer(text)]
            for (d, item), (share, a, b) in found.items():
                if d == doc:
                    a, b = -a - int(marks[doc]), -b - int(marks[doc])
                    out[first + doc].append((block.items[item], share, words[a][0], words[b - 1][1]))
    return [sorted(found, key=lambda x: (x[0] is None, x[0] or 0, x[2])) for found in out]


def leak_column(block: Block, text: str, least: float) -> Column:
    @F.pandas_udf(LEAKS)
    def leaks(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(leaks_of([t or "" for t in texts], block, least), dtype=object)

    return leaks(F.col(text))


def blocks(benchmark: DataFrame, item: str, text: str, n: int, block_chars: int) -> Iterator[Block]:
    """The benchmark by blocks: the driver holds one at a time. An item longer than a block is a block of its own."""
    rows, chars = [], 0
    for row in benchmark.select(F.col(item).cast("long"), F.coalesce(F.col(text), F.lit(""))).toLocalIterator():
        if rows and chars + len(row[1]) > block_chars:
            yield Block.of(rows, n)
            rows, chars = [], 0
        rows.append((row[0], row[1]))
        chars += len(row[1])
    if rows:
        yield Block.of(rows, n)


def with_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    out: str = "leaks",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    n: int = 3,
    window: int = 4,
    least: float = 0.4,
    block_chars: int = 1 << 20,
) -> DataFrame:
    """All rows and columns of ``docs`` with ``out``: the benchmark items whose alignment reaches ``least``, in words enough
    not to be chance, and those of which a long part is copied, whose score can be any.

    An item of fewer than ``n`` words has no n-gram and marks nothing; equal items are all reported; null texts count as
    empty, null item ids are reported as null. Between blocks of the benchmark the rows are written.
    """
    nothing = F.array().cast(LEAKS)
    marked, first = docs.withColumn(out, nothing), True
    for block in blocks(benchmark, item, item_text, n, block_chars):
        if not len(block.grams):
            continue
        marked = marked if first else materialise(marked, "leaks")
        block.choose_seeds(document_frequency(docs, block, text), window)
        found = leak_column(block, text, least)
        marked = marked.withColumn(out, found if first else F.concat(F.col(out), found))
        first = False
    return marked


def leaked(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", **options) -> DataFrame:
    """A row for each document and item found in it: key, ``item_id``, ``score`` and the span in characters of the
    lower-cased text. Repeated documents repeat their rows."""
    found = with_leaks(docs.select(key, options.get("text", "text")), benchmark, out="_leaks", **options)
    return found.select(key, F.explode("_leaks").alias("leak")).select(key, "leak.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    out = "_leaks"
    while out in docs.columns:
        out = f"_{out}"
    return with_leaks(docs, benchmark, out=out, **options).filter(F.size(out) == 0).drop(out)
