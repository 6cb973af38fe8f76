from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from finledger.llm import oracles, phrases, queries
from tests.conftest import table_of


def plain(rows, least, depth=5, share=100):
    """Every phrase by slicing: lang, phrase, a, l, r, n, score."""
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = (text or "").translate({i: i + 32 for i in range(65, 91)})
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for i in range(len(words)):
                for k in range(1, min(depth, len(words) - i) + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = []
    for lang, own in counts.items():
        candidates = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for q, b in candidates.items():
            for m in range(2, len(q)):
                for i in range(len(q) - m + 1):
                    longer[q[i : i + m]] = max(longer[q[i : i + m]], b)
        for p, a in candidates.items():
            if p in longer and 100 * longer[p] >= share * a:
                continue
            score, k = min((1000 * a * total[lang] // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            out.append((lang, " ".join(p), a, own[p[:k]], own[p[k:]], total[lang], score))
    return sorted(out)


def mined(df, **options):
    found = phrases.collocations(df, **options)
    return sorted(tuple(r) for r in found.select("lang", "phrase", "a", "l", "r", "n", "score").collect())


def texts(spark, rows):
    return spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "doc_id long, lang string, text string, phrase string")


def test_query_against_sql(spark, data_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{data_dir}/documents.parquet'")
    want = con.execute(oracles.PHRASES)
    want = table_of([c[0] for c in want.description], want.fetchall())
    found = queries.QUERIES["op11_collocations"](spark, data_dir)
    assert table_of(found.columns, found.collect()) == want
    assert want[1]


def test_small_tasks_against_brute_force(spark, data_dir):
    """Phrases that cross the ranges of several tasks are added up."""
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    want = plain([(r.lang, r.text) for r in docs.select("lang", "text").collect()], 12, 4)
    assert mined(docs, least=12, depth=4, task_rows=2000) == want and len(want) > 100


def test_many_runs_sections_and_ranges(spark, data_dir, monkeypatch):
    """Long pieces in sections, many runs of a task, ranges of a hundred suffixes."""
    for name, value in (("SECTION", 7), ("RUN_WORDS", 500), ("SAMPLE_STEP", 16), ("WORDS_HELD", 300)):
        monkeypatch.setattr(phrases, name, value)
    docs = spark.read.parquet(f"{data_dir}/documents.parquet").limit(60)
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    rows += [("en", " ".join(f"w{i % 13} x{i % 5}" for i in range(900)))] + [("xx", "a b " * 50)] * 3
    assert mined(texts(spark, rows), least=8, task_rows=100) == plain(rows, 8)


def test_ranges_part_sorted_suffixes():
    words = [b"a", b"b", b"d"]
    flat = np.array([2, 0, 1, -1, 0, 1, 2, 0, 1, -1, 1, -1, 0, phrases.GHOST + 1, phrases.GHOST + 2, -1])
    names, high, low, times = phrases.sorted_suffixes(flat, [b"b", b"d", b"a"], 5)
    assert names == words and times.sum() == 2 + 4 + 1
    mask = (1 << phrases.CODE_BITS) - 1
    got = [tuple(words[c - 1] if c else b"" for c in (h >> 42, h >> 21 & mask, h & mask, x >> 21, x & mask)) for h, x in zip(high, low, strict=True)]
    assert got == sorted(got)
    for bound in [(b"", b"", b"", b"", b""), (b"a", b"b", b"", b"", b""), (b"aa", b"z", b"", b"", b""), (b"b", b"c", b"a", b"", b""), *got, (b"z", b"", b"", b"", b"")]:
        assert phrases._cut(bound, words, high, low) == sum(g < bound for g in got), bound


def test_hot_words_and_one_hot_suffix(spark):
    rng = np.random.default_rng(3)
    rows = [("a", "z " * 4000), ("a", " ".join(rng.choice(["p", "q", "r"], 3000))), ("b", "z z z. z z")]
    rows += [(None, "the end of the day, the end of it")] * 9
    for task_rows in (100, 1 << 20):
        assert mined(texts(spark, rows), least=5, task_rows=task_rows) == plain(rows, 5)


def test_odd_rows(spark):
    rows = [
        ("en", None), ("en", ""), (None, " \t "), ("und", "A\tB a  b\x0bA b!a B"), (None, "a b"), ("en", "naïve Äpfel naïve Äpfel"),
        ("en", "\x01 x \x01 x"), ("", "a b a b"), ("en nl", "a b a b"), ("en", ". , ;"), ("en", "é" * 100000 + " k"),
    ]
    assert mined(texts(spark, rows), least=2) == plain(rows, 2)
    assert mined(texts(spark, rows), least=2, share=50) == plain(rows, 2, share=50)
    assert mined(texts(spark, []), least=2) == []


def test_exact_beyond_64_bits(spark):
    """Counts near 10^10 with texts of 10^10 words: the score's products pass 64 bits."""
    phrases_of = spark.createDataFrame(
        [("en", "x", 1, 9_000_000_001), ("en", "y", 1, 8_000_000_003), ("en", "x y", 2, 7_000_000_009)],
        "lang string, phrase string, words int, n long",
    )
    totals = spark.createDataFrame([("en", 90_000_000_007)], "lang string, n long")
    found = phrases.scored(phrases_of, totals).first()
    assert found.score == 1000 * 7_000_000_009 * 90_000_000_007 // (9_000_000_001 * 8_000_000_003)


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(1)
    keys = rng.integers(-1, 4, (500, 3)).astype(np.int32)
    keys[keys[:, 1] < 0, 2] = -1
    want = Counter()
    for row in keys.tolist():
        for k in range(1, 4):
            if row[k - 1] >= 0:
                want[tuple(row[:k])] += 1
            else:
                break
    got = {tuple(keys[r, :d].tolist()): n for r, d, n in phrases.quicksort_counts(keys, 20)}
    assert got == {k: n for k, n in want.items() if n >= 20}
    assert phrases.quicksort_counts(keys[:5], 20) == []
    assert sorted(n for _, d, n in phrases.quicksort_counts(keys[:5], 20, np.full(5, 20)) if d == 1) == sorted(
        20 * n for k, n in Counter(keys[:5, 0].tolist()).items() if k >= 0
    )


def test_rank_and_limit(spark):
    rows = [("en", "a b", 5, 7), ("en", "a c", 5, 7), ("en", "d", 6, 7), ("en", "Z", 5, 7), ("de", "q", 1, 1)]
    found = spark.createDataFrame([(*r, 0, 0, 0) for r in rows], "lang string, phrase string, a long, score long, l long, r long, n long")
    got = sorted((r.lang, r["rank"], r.phrase) for r in phrases.top_collocations(found, 3).collect())
    assert got == [("de", 1, "q"), ("en", 1, "d"), ("en", 2, "Z"), ("en", 3, "a b")]
