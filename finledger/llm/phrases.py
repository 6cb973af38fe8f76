"""Phrase collocation mining: suffix pointers routed by their leading words, sorted by multikey quicksort.

A suffix is a word with up to four words after it in its piece. Words below the minimum count end a suffix, since no
phrase with such a word is frequent. All suffixes are routed by range of language and leading words, so equal beginnings
stand in one range, or in neighbouring ones where there are too many for one. Before, each task adds up the equal ones of
some million words, so a suffix that is everywhere is a few rows. In a range the pointers to the suffixes are sorted by
three-way multikey quicksort to the maximum depth, all open partitions side by side; the size of an equal partition is
the count of the phrase that its words make, and a partition below the minimum count is abandoned. Beginnings that a
neighbouring range may hold too, those of a range's first and last suffix, are counted as they stand and added up
afterwards.

Each candidate phrase is scored by its weakest cut, and candidates that a longer one explains are dropped.
"""

from __future__ import annotations

import bisect
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finledger.operators.distribution import group_positions
from finledger.session import materialise

PIECES = re.compile(rb"[.,;:!?\x0a-\x0d]")
# Entries of a task's word counts, and words of its vocabulary, before they are handed on or forgotten.
WORDS_HELD = 1 << 19
# Bits of the set of frequent words that is sent to the tasks: 2 MB whatever the vocabulary.
FILTER_BITS = 1 << 24
# Words of a task whose suffixes are sorted and handed on together; a longer piece is taken in sections.
RUN_WORDS, SECTION = 3 << 19, 1 << 18
# One word in so many begins a suffix of the sample that the ranges are cut from, and samples for each range.
SAMPLE_STEP, SAMPLES_A_RANGE = 1024, 32
DEPTH_MOST = 5
# Bits of a word's code in a packed suffix, three words and two; added to the code of a word that begins no suffix.
CODE_BITS, GHOST = 21, 1 << 30


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
    for row in range(batch.num_rows):
        text = batch.column(1)[row].as_py()
        if text:
            yield batch.column(0)[row].as_py(), text.lower()


def count_words(depth: int):
    """(lang, text as bytes) to (lang, word, lead, n): words added up within a task, and one suffix in ``SAMPLE_STEP``
    as a ``lead`` of up to ``depth`` words."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", "word", "lead", "n"]
        counts: dict[str, Counter] = {}
        leads: list[tuple[str, bytes]] = []
        ahead = SAMPLE_STEP // 2

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, found in counts.items():
                if found:
                    columns = [pa.array([lang] * len(found), pa.string()), pa.array(found.keys(), pa.binary())]
                    columns += [pa.nulls(len(found), pa.binary()), pa.array(found.values(), pa.int64())]
                    yield pa.record_batch(columns, names=names)
            columns = [pa.array([x for x, _ in leads], pa.string()), pa.nulls(len(leads), pa.binary())]
            yield pa.record_batch([*columns, pa.array([x for _, x in leads], pa.binary()), pa.array([1] * len(leads), pa.int64())], names=names)
            counts.clear()
            leads.clear()

        for batch in batches:
            for lang, text in _texts(batch):
                own = counts.setdefault(lang, Counter())
                for piece in PIECES.split(text):
                    words = piece.split()
                    own.update(words)
                    while ahead < len(words):
                        leads.append((lang, b" ".join(words[ahead : ahead + depth])))
                        ahead += SAMPLE_STEP
                    ahead -= len(words)
                if sum(map(len, counts.values())) > WORDS_HELD:
                    yield from handed_on()
        yield from handed_on()

    return of


def may_be_frequent(word: bytes, lang: bytes, bits: np.ndarray) -> bool:
    """By the set of hashes; a wrong yes costs some suffixes and no result."""
    at = zlib.crc32(word, zlib.crc32(lang + b" ")) % FILTER_BITS
    return bool(bits[at >> 3] >> (at & 7) & 1)


class _Codes(dict):
    """A number for each frequent word of a language, -1 for the others."""

    def __init__(self, lang: str, bits: np.ndarray):
        self.lang, self.bits, self.words = lang.encode(), bits, []

    def __missing__(self, word: bytes) -> int:
        code = -1
        if may_be_frequent(word, self.lang, self.bits):
            code = len(self.words)
            self.words.append(word)
        self[word] = code
        return code


def _of(codes: dict[str, _Codes], lang: str, bits: np.ndarray) -> _Codes:
    if lang not in codes:
        codes[lang] = _Codes(lang, bits)
    return codes[lang]


def _packed(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Five columns of codes as two numbers that are in the same order."""
    codes = codes.astype(np.int64)
    return codes[0] << 2 * CODE_BITS | codes[1] << CODE_BITS | codes[2], codes[3] << CODE_BITS | codes[4]


def sorted_suffixes(flat: np.ndarray, words: list[bytes], depth: int) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """The words in order, and the different suffixes of a run of codes in order of their words, packed, with how often
    each stands. A negative code ends a piece; a word without a frequent one after it begins no suffix."""
    ghost = flat >= GHOST
    flat = np.where(ghost, flat - GHOST, flat)
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.zeros(len(words) + 1, dtype=np.int32)
    rank[order] = np.arange(1, len(words) + 1, dtype=np.int32)
    codes = np.concatenate([rank[flat], np.zeros(DEPTH_MOST, dtype=np.int32)])
    columns = [codes[: len(flat)]]
    for k in range(1, DEPTH_MOST):
        columns.append(np.where(columns[-1] > 0, codes[k : k + len(flat)], 0) if k < depth else np.zeros(len(flat), dtype=np.int32))
    begins = (columns[1] > 0) & ~ghost
    high, low = _packed(np.array([c[begins] for c in columns]))
    by = np.lexsort((low, high))
    high, low = high[by], low[by]
    new = np.ones(len(high), dtype=bool)
    new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
    at = np.flatnonzero(new)
    return [words[i] for i in order], high[at], low[at], np.diff(np.append(at, len(high)))


def _cut(bound: tuple[bytes, ...], words: list[bytes], high: np.ndarray, low: np.ndarray) -> int:
    """How many of the sorted suffixes come before a bound."""
    codes = []
    for word in bound:
        at = bisect.bisect_left(words, word) if word else -1
        known = not word or at < len(words) and words[at] == word
        codes.append(at + 1)
        if not known:
            break
    a, b = _packed(np.array(codes + [0] * (DEPTH_MOST - len(codes))))
    start, end = np.searchsorted(high, a, "left"), np.searchsorted(high, a, "right")
    return int(start + np.searchsorted(low[start:end], b, "left"))


def routed_suffixes(bits: np.ndarray, bounds: list[tuple[bytes, tuple[bytes, ...]]], depth: int):
    """(lang, text as bytes) to runs (range, lang, words, codes, times): the suffixes of some million words that belong to
    one range of ``bounds``, sorted and with equal ones counted, as codes of the words they have."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes: dict[str, _Codes] = {}
        flat: dict[str, list[int]] = {}
        held = 0

        def runs() -> Iterator[pa.RecordBatch]:
            for lang, run in flat.items():
                words, high, low, times = sorted_suffixes(np.array(run, dtype=np.int32), codes[lang].words, depth)
                before = bisect.bisect_left(bounds, (lang.encode(), ()))
                after = bisect.bisect_left(bounds, (lang.encode() + b"\0", ()))
                cuts = [0, *(_cut(b, words, high, low) for _, b in bounds[before:after]), len(high)]
                rows = []
                for place, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if a < b:
                        mask = (1 << CODE_BITS) - 1
                        own = [high[a:b] >> 2 * CODE_BITS, high[a:b] >> CODE_BITS & mask, high[a:b] & mask, low[a:b] >> CODE_BITS, low[a:b] & mask]
                        own = np.array(own[:depth])
                        used = np.unique(own)
                        used = used[used > 0]
                        width = np.uint16 if len(used) < 1 << 16 else np.uint32
                        # 0 stays 0: searchsorted gives the place among the used words.
                        short = np.where(own > 0, np.searchsorted(used, own) + 1, 0).astype(width)
                        count = times[a:b].astype(np.uint8 if times[a:b].max() < 256 else np.int64)
                        rows.append((before + place, lang, b"\n".join(words[i - 1] for i in used), short.tobytes(), count.tobytes(), b - a))
                if rows:
                    kinds = [pa.int32(), pa.string(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
                    yield pa.record_batch(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                        names=["range", "lang", "words", "codes", "times", "n"],
                    )
            flat.clear()
            for lang in [x for x, c in codes.items() if len(c) > WORDS_HELD or len(codes) > 64]:
                del codes[lang]  # so a run has fewer words than codes have room for

        for batch in batches:
            for lang, text in _texts(batch):
                code, run = _of(codes, lang, bits), flat.setdefault(lang, [])
                for piece in PIECES.split(text):
                    words = piece.split()
                    for start in range(0, len(words) - 1, SECTION):
                        own = words[start : start + SECTION]
                        run.extend(map(code.__getitem__, own))
                        if start + SECTION < len(words):
                            ahead = map(code.__getitem__, words[start + SECTION : start + SECTION + depth - 1])
                            run.extend(c + GHOST if c >= 0 else c for c in ahead)
                        run.append(-1)
                        held += len(own)
                        if held >= RUN_WORDS:
                            yield from runs()
                            code, run, held = _of(codes, lang, bits), flat.setdefault(lang, []), 0
        yield from runs()

    return of


def quicksort_counts(keys: np.ndarray, least: int, times: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(row, depth, size) of each equal partition of size ``least`` or more: the first ``depth`` keys of that row occur
    ``size`` times, a row counting as often as ``times`` says. A negative key ends a row.

    Three-way multikey quicksort of row pointers. All partitions of a pass are parted together: a pass moves the
    pointers that are smaller, equal and larger than the middle one of three keys to the beginning, middle and end of
    their partition; the equal ones go on with the next key, and partitions below ``least`` are abandoned.
    """
    rows, deepest = keys.shape
    times = np.ones(rows, dtype=np.int64) if times is None else times
    found: list[tuple[int, int, int]] = []
    pointers = np.arange(rows)
    sizes = np.array([rows] if rows and times.sum() >= least else [], dtype=np.int64)
    depth = np.zeros(len(sizes), dtype=np.int64)
    while len(sizes):
        starts = np.cumsum(sizes) - sizes
        own = keys[pointers, np.repeat(depth, sizes)]
        first, middle, last = own[starts], own[starts + sizes // 2], own[starts + sizes - 1]
        pivot = np.maximum(np.minimum(first, middle), np.minimum(np.maximum(first, middle), last))
        against = np.repeat(pivot, sizes)
        side = np.repeat(np.arange(1, 3 * len(sizes), 3), sizes) + (own > against) - (own < against)
        split = np.bincount(side, minlength=3 * len(sizes))
        weight = np.bincount(side, times[pointers], minlength=3 * len(sizes)).astype(np.int64)
        place = np.cumsum(split) - split
        moved = np.empty_like(pointers)
        for k, mine in enumerate((own < against, own == against, own > against)):
            part = split[k::3]
            moved[np.repeat(place[k::3] - (np.cumsum(part) - part), part) + np.arange(part.sum())] = pointers[mine]
        deeper = np.repeat(depth, 3)
        deeper[1::3] += 1
        goes_on = weight >= least
        goes_on[1::3] &= pivot >= 0
        for p in np.flatnonzero(goes_on[1::3]) * 3 + 1:
            found.append((int(moved[place[p]]), int(deeper[p]), int(weight[p])))
        goes_on &= deeper < deepest
        pointers = moved[np.repeat(goes_on, split)]
        sizes, depth = split[goes_on], deeper[goes_on]
    return found


def counted_phrases(runs: list[tuple[list[bytes], np.ndarray, np.ndarray]], least: int) -> list[tuple[list[bytes], int]]:
    """(words, size) of the phrases of two words or more in sorted runs (words, codes, times) of one range and language.

    Counts are whole but for the beginnings of the first and the last suffix, which a neighbouring range may have too;
    they are given whatever their size.
    """
    numbers: dict[bytes, int] = {}
    keys, edges = [], []
    for words, codes, _ in runs:
        number = np.array([-1, *(numbers.setdefault(w, len(numbers)) for w in words)], dtype=np.int32)
        keys.append(number[codes].T)
        edges += [tuple(words[c - 1] if c else b"" for c in codes[:, at]) for at in (0, -1)]
    keys = np.concatenate(keys)
    times = np.concatenate([t.astype(np.int64) for _, _, t in runs])
    shared: dict[tuple, int] = {}
    for edge in {min(edges), max(edges)}:
        own, there = tuple(numbers[w] for w in edge if w), np.ones(len(keys), dtype=bool)
        for k, code in enumerate(own):
            there &= keys[:, k] == code
            if k:
                shared[own[: k + 1]] = int(times[there].sum())
    names = list(numbers)
    found = [(tuple(keys[row, :depth].tolist()), n) for row, depth, n in quicksort_counts(keys, least, times) if depth > 1]
    found = [x for x in found if x[0] not in shared] + list(shared.items())
    return [([names[c] for c in phrase], n) for phrase, n in found]


def phrase_counts(least: int, depth: int):
    """Runs in order of their range to (lang, phrase, words, n): one range at a time is held."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, runs = None, {}

        def counted() -> pa.RecordBatch:
            rows = [(lang, b" ".join(w), len(w), n) for lang, own in runs.items() for w, n in counted_phrases(own, least)]
            kinds = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
            columns = zip(*rows, strict=True) if rows else [[]] * 4
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["lang", "phrase", "words", "n"])

        for batch in batches:
            for place, lang, words, codes, times, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if place != current and runs:
                    yield counted()
                    runs = {}
                current = place
                width = np.uint16 if len(codes) == 2 * depth * n else np.uint32
                count = np.uint8 if len(times) == n else np.int64
                run = words.split(b"\n"), np.frombuffer(codes, width).reshape(depth, n), np.frombuffer(times, count)
                runs.setdefault(lang, []).append(run)
        if runs:
            yield counted()

    return of


def _bounds(sample: DataFrame, bits: np.ndarray, total: int, depth: int, task_rows: int) -> list[tuple[bytes, tuple[bytes, ...]]]:
    """Where ranges of about ``task_rows`` suffixes part, by a sample of them: ``SAMPLES_A_RANGE`` for each reach the
    driver. An uneven sample makes ranges uneven and changes no result."""
    space = 1 << 20
    share = min(1.0, -(-max(1, total) // task_rows) * SAMPLES_A_RANGE * SAMPLE_STEP / max(1, total))
    picked = sample.filter(F.pmod(F.xxhash64("lang", "lead"), F.lit(space)) < int(share * space) + 1).toArrow()
    leads = Counter()
    for lang, lead, n in zip(*(picked.column(c).to_pylist() for c in ("lang", "lead", "n")), strict=True):
        lang = lang.encode()
        words = list(itertools.takewhile(lambda w: may_be_frequent(w, lang, bits), lead.split()))
        if len(words) > 1:
            leads[lang, tuple(words + [b""] * (depth - len(words)))] += n
    held = sum(leads.values())
    ranges = max(1, -(-int(held * SAMPLE_STEP / share) // task_rows))
    bounds, seen = [], 0
    for lead in sorted(leads):
        # A lead that fills a range by itself begins one.
        if seen * ranges // max(1, held) != (seen + leads[lead]) * ranges // max(1, held) and seen:
            bounds.append(lead)
        seen += leads[lead]
    return bounds


def _filter_bits(frequent: DataFrame) -> np.ndarray:
    """The set of frequent words as bits by hash: at most ``FILTER_BITS`` / 64 rows reach the driver."""
    at = F.crc32(F.concat(F.col("lang").cast("binary"), F.lit(b" "), F.col("word"))) % FILTER_BITS
    hashed = frequent.select(at.alias("at"))
    mask = F.expr("shiftleft(1L, cast(at % 64 as int))")
    rows = hashed.groupBy(F.floor(F.col("at") / 64).cast("int").alias("slot")).agg(F.bit_or(mask).alias("mask")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, dtype="<i8")
    bits[np.asarray(rows.column("slot"))] = np.asarray(rows.column("mask"))
    return bits.view(np.uint8)


def frequent_phrases(
    docs: DataFrame, least: int = 100, depth: int = 5, lang: str = "lang", text: str = "text", task_rows: int = 1 << 20
) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, n) of all phrases of 1 to ``depth`` words that occur ``least`` times or more, and (lang, n),
    the number of all words.

    A missing language is ``und``, a missing text empty. ``task_rows`` is about what one task sorts; phrases have five
    words at most.
    """
    if depth > DEPTH_MOST:
        raise ValueError(f"phrases have {DEPTH_MOST} words at most")
    read = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("text"))
    words = read.mapInArrow(count_words(depth), "lang string, word binary, lead binary, n long")
    words = materialise(words.groupBy("lang", "word", "lead").agg(F.sum("n").alias("n")), "words")
    sample, words = words.filter("word IS NULL"), words.filter("word IS NOT NULL")
    totals = materialise(words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    frequent = words.filter(F.col("n") >= least)
    bits = _filter_bits(frequent)
    bounds = _bounds(sample, bits, totals.agg(F.sum("n")).first()[0] or 0, depth, task_rows)
    shared = docs.sparkSession.sparkContext.broadcast((bits, bounds))

    def shipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return routed_suffixes(*shared.value, depth)(batches)

    runs = read.mapInArrow(shipped, "range int, lang string, words binary, codes binary, times binary, n long")
    routed = runs.repartitionById(len(bounds) + 1, "range").sortWithinPartitions("range")
    counted = routed.mapInArrow(phrase_counts(least, depth), "lang string, phrase binary, words int, n long")
    whole = counted.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    single = frequent.select("lang", F.col("word").alias("phrase"), F.lit(1).alias("words"), "n")
    found = single.unionByName(whole).select("lang", F.decode("phrase", "utf-8").alias("phrase"), "words", "n")
    return materialise(found, "phrases"), totals


def collocations(
    docs: DataFrame,
    least: int = 100,
    depth: int = 5,
    share: int = 100,
    lang: str = "lang",
    text: str = "text",
    task_rows: int = 1 << 20,
) -> DataFrame:
    """(lang, phrase, words, a, l, r, n, score) of the candidates that no longer one explains.

    Candidates are the phrases of 2 to ``depth`` words that occur ``least`` times or more (a) within a language of n
    words. A cut after the first k words gives the counts l and r of its parts and the score floor(1000 a n / (l r)); the
    lowest counts, ties to the smallest k. A candidate inside a longer one goes if the longer one has ``share`` percent of
    its occurrences. Texts are lower-cased in A-Z and split at ``.,;:!?`` and line ends into pieces, at blanks and tabs
    into words; phrases do not cross pieces. Repeated rows count as often as they stand; other columns are not read.
    """
    phrases, totals = frequent_phrases(docs, least, depth, lang, text, task_rows)
    return scored(phrases, totals, share)


def scored(phrases: DataFrame, totals: DataFrame, share: int = 100) -> DataFrame:
    """Candidates with the scores of their weakest cuts, from the counts of all frequent phrases."""
    named = phrases.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    cut = named.select("*", F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cut = cut.withColumns(
        {"left": F.concat_ws(" ", F.expr("slice(w, 1, k)")), "right": F.concat_ws(" ", F.expr("slice(w, k + 1, words - k)"))}
    )
    counts = phrases.select("lang", "phrase", "n")
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    cut = cut.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    exact = "cast(a as decimal(19,0)) * 1000 * cast(n as decimal(19,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))"
    cut = cut.withColumn("score", F.expr(exact))
    weakest = cut.groupBy("lang", "phrase", "words").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("c"))
    inner = F.expr(
        "flatten(transform(sequence(2, words - 1), m -> transform(sequence(0, words - m), s -> concat_ws(' ', slice(w, s + 1, m)))))"
    )
    inside = named.filter("words > 2").select("lang", F.explode(F.array_distinct(inner)).alias("phrase"), "a")
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(longer, ["lang", "phrase"], "left")
    kept = kept.filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("c.a") * share))
    return kept.select("lang", "phrase", "words", "c.a", "c.l", "c.r", "c.n", "c.score")


def top_collocations(found: DataFrame, limit: int = 2000) -> DataFrame:
    """The first ``limit`` of each language by score, count and phrase (byte order), with their rank. A language is put in
    order by many tasks."""
    falling = found.withColumns({"_score": -F.col("score"), "_a": -F.col("a")})
    ranked = group_positions(falling, ["lang"], ["_score", "_a", "phrase"], "rank", limit)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
