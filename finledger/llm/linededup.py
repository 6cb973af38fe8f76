"""Line deduplication by pairwise alignment.

Lines are hashed. A line of at least ``least_words`` words is rare by its length: two documents do not share it by
chance. The same holds for the shortest run of shorter lines in a row, empty ones left out, that reaches as many words,
and for a whole text of fewer words. These are the seeds: each that several documents hold links every later holder to
its first holder only, so a seed of any frequency gives a link for each holder and never all pairs. Each linked pair is
aligned with patience diff over its line hashes, and the aligned blocks are deleted from the later document, as are runs
of lines of enough words that the first holder has elsewhere. The first holder of a seed always keeps it.

Words are what blanks separate; where there are few blanks, every ``WORD_CHARS`` characters count as a word, so that
long codes and scripts without spaces have words too.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finledger.session import materialise

WORD_CHARS = 6
# Scripts that put no spaces between words: a word is about two characters.
UNSPACED = r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}]"


def longest_rising(places: list[int]) -> list[int]:
    """Indexes of a longest strictly rising subsequence."""
    tails: list[int] = []
    tops: list[int] = []
    before = []
    for k, place in enumerate(places):
        at = bisect_left(tails, place)
        before.append(tops[at - 1] if at else -1)
        if at == len(tails):
            tails.append(place)
            tops.append(k)
        else:
            tails[at], tops[at] = place, k
    out, k = [], tops[-1] if tops else -1
    while k >= 0:
        out.append(k)
        k = before[k]
    return out[::-1]


def _once(lines: list, start: int, end: int) -> dict:
    counts = Counter(lines[start:end])
    return {lines[i]: i for i in range(start, end) if counts[lines[i]] == 1}


def _by_turn(lines: list, start: int, end: int) -> dict:
    seen: Counter = Counter()
    out = {}
    for i in range(start, end):
        seen[lines[i]] += 1
        out[(lines[i], seen[lines[i]])] = i
    return out


def patience(later: list, first: list) -> list[tuple[int, int]]:
    """Aligned lines (index in ``later``, index in ``first``), both rising.

    Equal beginnings and ends are matched, then the longest rising run of lines that are unique on both sides; what lies
    between its members is aligned in the same way. Where no line is unique, equal lines are told apart by their turn.
    """
    out = []
    todo = [(0, len(later), 0, len(first))]
    while todo:
        a, b, c, d = todo.pop()
        while a < b and c < d and later[a] == first[c]:
            out.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and later[b - 1] == first[d - 1]:
            b, d = b - 1, d - 1
            out.append((b, d))
        if a == b or c == d:
            continue
        for names in (_once, _by_turn):
            there = names(first, c, d)
            common = [(i, there[line]) for line, i in names(later, a, b).items() if line in there]
            if common:
                break
        else:
            continue
        common.sort()
        anchors = [common[k] for k in longest_rising([j for _, j in common])]
        edges = [(a - 1, c - 1), *anchors, (b, d)]
        out += anchors
        todo += [(i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges[:-1], edges[1:], strict=True)]
    return sorted(out)


def _windows(lines: list[int], words: list[int], own: list[int], least_words: int) -> Iterator[tuple[int, int]]:
    """Shortest runs (start and end in ``own``, the lines that are not empty) of enough words, from each line on and up
    to each line."""
    start, total = 0, 0
    ends: list[tuple[int, int]] = []
    for end, i in enumerate(own):
        total += words[i]
        reached = total >= least_words
        while total - words[own[start]] >= least_words:
            # The shortest run from ``start`` ends at this line or before it.
            if not ends or ends[-1][0] < start:
                ends.append((start, end + 1))
            total -= words[own[start]]
            start += 1
        if reached:
            if not ends or ends[-1][0] < start:
                ends.append((start, end + 1))
            yield start, end + 1
    yield from ends


def shared_runs(later: list[int], words: list[int], first: list[int], first_words: list[int], least_words: int) -> set[int]:
    """Indexes of the lines of ``later`` in a run of enough words that ``first`` holds as well, wherever; empty lines do
    not part a run, and go with it where ``first`` has empty lines."""
    there = [i for i, n in enumerate(first_words) if n]
    held = {tuple(first[i] for i in there[a:b]) for a, b in _windows(first, first_words, there, least_words)}
    own = [i for i, n in enumerate(words) if n]
    blank = len(there) < len(first)
    out: set[int] = set()
    for a, b in _windows(later, words, own, least_words):
        if tuple(later[i] for i in own[a:b]) in held:
            out.update(range(own[a], own[b - 1] + 1) if blank else own[a:b])
    return out


def shared_blocks(
    later: list[int], words: list[int], first: list[int], least_words: int, first_words: list[int] | None = None
) -> list[int]:
    """Indexes of the lines of ``later`` in aligned blocks of at least ``least_words`` words.

    What stands in another order is found by aligning the rest again. Where short lines alone are aligned, the long ones
    that are left are aligned without them, so every long line that ``first`` holds is found in the end. With the words
    of ``first`` runs of short lines are found in any order too, and a copy of the whole text of any length.
    """
    if first_words is not None and later == first:
        return list(range(len(later)))
    left = list(range(len(later)))
    gone: list[int] = []
    known = set(first)
    again = first_words is not None
    while again or any(later[i] in known and words[i] >= least_words for i in left):
        again = False
        found: list[int] = []
        for lines in (left, [i for i in left if words[i] >= least_words]):
            pairs = [(lines[i], j) for i, j in patience([later[i] for i in lines], first)]
            block: list[int] = []
            for k, (i, j) in enumerate(pairs):
                if k and (i, j) != (pairs[k - 1][0] + 1, pairs[k - 1][1] + 1):
                    found += block if sum(words[x] for x in block) >= least_words else []
                    block = []
                block.append(i)
            found += block if sum(words[x] for x in block) >= least_words else []
            if found:
                break
        gone += found
        taken = set(found)
        left = [i for i in left if i not in taken]
    if first_words is not None and any(words[i] and later[i] in known for i in left):
        gone = list({*gone, *shared_runs(later, words, first, first_words, least_words)})
    return sorted(gone)


def _sheets(docs: DataFrame, key: str, text: str) -> DataFrame:
    """A row for each document: its place in the order (``k``, ``h``), hashes and word counts of its lines.

    Documents are ordered by key, those without one last, and by a hash of the text where keys repeat; equal rows are
    one document.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = docs.select(
        F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("k"),
        F.xxhash64(whole).alias("h"),
        F.transform(F.split(whole, "\n", -1), F.trim).alias("lines"),
    )
    spaces = lambda line: F.length(line) - F.length(F.replace(line, F.lit(" "), F.lit("")))
    parted = lambda line: F.size(F.filter(F.split(line, r"(?U)\s+"), lambda word: word != ""))
    unspaced = lambda line: F.when(
        F.octet_length(line) > F.length(line), F.length(line) - F.length(F.regexp_replace(line, UNSPACED, ""))
    ).otherwise(0)
    # A line of blanks of any kind has no words.
    count = lambda line: F.when(parted(line) == 0, 0).otherwise(
        F.greatest(spaces(line) + 1, parted(line), F.floor(F.length(line) / WORD_CHARS), F.floor(unspaced(line) / 2))
    )
    return lines.select(
        "k",
        "h",
        F.transform("lines", lambda line: F.xxhash64(line)).alias("hashes"),
        F.transform("lines", lambda line: count(line).cast("int")).alias("words"),
    )


def _seeds(least_words: int) -> Column:
    """Seeds of a sheet: long lines, the shortest runs of shorter lines with enough words, and a whole text with fewer."""
    full = F.filter(F.arrays_zip("hashes", "words"), lambda x: x["words"] > 0)
    start = F.struct(F.lit(0).alias("words"), F.lit(0).cast("long").alias("key"))

    def step(state: Column, line: Column) -> Column:
        # A long line is a seed of its own and ends a run without one.
        over = (state["words"] >= least_words) | (state["words"] < 0)
        cut = (state["words"] > 0) & (line["words"] >= least_words)
        words = F.when(over, state["words"]).when(cut, -1).otherwise(state["words"] + line["words"])
        key = F.when(over, state["key"]).otherwise(F.xxhash64(state["key"], line["hashes"]))
        return F.struct(words.alias("words"), key.alias("key"))

    def seed(lines: Column, i: Column) -> Column:
        run = F.aggregate(F.slice(lines, i + 1, least_words), start, step)
        return F.when(run["words"] >= least_words, run["key"])

    seeds = F.transform(full, lambda x, i: F.when(x["words"] >= least_words, F.xxhash64(F.lit(0).cast("long"), x["hashes"])).otherwise(seed(full, i)))
    total = F.aggregate("words", F.lit(0), lambda s, x: s + x)
    whole = F.when((total > 0) & (total < least_words), F.array(F.xxhash64(F.lit("whole"), "hashes")))
    return F.coalesce(whole, F.filter(seeds, lambda x: x.isNotNull()))


def deleted_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 5) -> DataFrame:
    """For each document that loses lines: ``k``, ``h``, the line numbers ``gone`` (from 0) and ``partners``, the keys
    of the earlier documents."""
    # Documents once each, written: what joins them below is a plain shuffle on both sides, which a first holder that
    # many documents follow can be split in.
    sheets = materialise(_sheets(docs, key, text).dropDuplicates(["k", "h"]), "sheets")
    place = F.struct("k", "h")
    lines = sheets.select("k", "h", F.explode(F.array_distinct(_seeds(least_words))).alias("line"))
    held = lines.groupBy("line").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last")
    # Written, so that the join below has plain shuffles on both sides and a line that many hold is split.
    held = materialise(held.select("line", "first"), "held")
    links = lines.join(held, "line").filter(place > F.col("first"))
    links = links.select("k", "h", F.col("first.k").alias("fk"), F.col("first.h").alias("fh")).distinct()
    later = links.join(sheets, ["k", "h"])
    firsts = sheets.select(F.col("k").alias("fk"), F.col("h").alias("fh"), F.col("hashes").alias("first"), F.col("words").alias("first_words"))
    pairs = later.join(firsts, ["fk", "fh"])

    @F.pandas_udf("array<int>")
    def blocks(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hashes, words, first, first_words in batches:
            yield pd.Series(
                [
                    shared_blocks(a.tolist(), w.tolist(), b.tolist(), least_words, n.tolist())
                    for a, w, b, n in zip(hashes, words, first, first_words, strict=True)
                ],
                dtype=object,
            )

    found = pairs.select("k", "h", "fk", blocks("hashes", "words", "first", "first_words").alias("gone"))
    return found.groupBy("k", "h").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("gone")))).alias("gone"),
        F.array_sort(F.collect_set("fk")).alias("partners"),
    )


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_words: int = 5, report: bool = False
) -> DataFrame:
    """All rows with all their columns; shared blocks of lines are cut out of the text of later documents.

    A text without a loss is unchanged, a null one stays null; a copy of a whole earlier text becomes empty. Rows that
    repeat key and text are one document and lose the same lines. ``n_chars`` is set anew where the table has it. With
    ``report`` the columns ``lines_removed`` (line numbers) and ``partners`` (keys of earlier documents) are added.
    """
    names = {}
    for name in ("k", "h", "gone", "partners"):
        names[name] = f"_{name}"
        while names[name] in docs.columns:
            names[name] = f"_{names[name]}"
    lost = deleted_lines(docs, key, text, least_words).withColumnsRenamed(names)
    k, h, gone = names["k"], names["h"], names["gone"]
    place = docs.withColumn(k, F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)))
    place = place.withColumn(h, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))
    joined = place.join(lost, [k, h], "left")
    lines = F.filter(F.split(F.col(text), "\n", -1), lambda _, i: ~F.array_contains(F.col(gone), i))
    changed = F.when(F.size(gone) > 0, F.array_join(lines, "\n")).otherwise(F.col(text))
    out = joined.withColumn(text, changed)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        new = F.when(F.size(gone) > 0, F.length(text).cast(kind)).otherwise(F.col("n_chars"))
        out = out.withColumn("n_chars", new)
    if not report:
        return out.select(*docs.columns)
    removed = F.coalesce(F.col(gone), F.array().cast("array<int>")).alias("lines_removed")
    partners = F.coalesce(F.col(names["partners"]), F.array().cast("array<long>")).alias("partners")
    return out.select(*docs.columns, removed, partners)
