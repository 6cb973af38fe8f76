import random

import numpy as np

from finledger.llm import decontaminate as d
from finledger.llm import queries


def plain_alignment(item, window):
    """Smith-Waterman, cell by cell."""
    table = [[0] * (len(window) + 1) for _ in range(len(item) + 1)]
    best = (0, 0)
    for i in range(1, len(item) + 1):
        for j in range(1, len(window) + 1):
            same = d.MATCH if item[i - 1] == window[j - 1] else d.MISMATCH
            table[i][j] = max(0, table[i - 1][j - 1] + same, table[i - 1][j] + d.GAP, table[i][j - 1] + d.GAP)
            best = max(best, (table[i][j], -j))
    return best[0]


def test_alignment_against_cells(monkeypatch):
    monkeypatch.setattr(d, "CELLS", 60)
    rng = random.Random(4)
    items = [np.array([rng.randrange(1, 5) for _ in range(rng.randrange(1, 12))]) for _ in range(80)]
    windows = [np.array([rng.randrange(0, 5) for _ in range(rng.randrange(1, 25))]) for _ in range(80)]
    scores, ends = d.align(items, windows)
    for item, window, score, end in zip(items, windows, scores, ends, strict=True):
        assert score == plain_alignment(item, window)
        assert not score or plain_alignment(item, window[:end]) == score


def words(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def edited(rng, item, share):
    out = []
    for w in item:
        if rng.random() < share:
            out += rng.choice([[], [f"e{rng.randrange(99)}"], [w, f"e{rng.randrange(99)}"]])
        else:
            out.append(w)
    return out


def test_copies_and_edited_copies_are_found(spark):
    rng = random.Random(9)
    items = [words(rng, 30) for _ in range(20)]
    docs, want = [], set()
    for key in range(200):
        text = words(rng, 150)
        if key % 4 == 0:
            item = rng.randrange(20)
            text[50:50] = edited(rng, items[item], (0, 0.08, 0.15)[key // 4 % 3])
            want.add((key, item))
        docs.append((key, " ".join(text).upper().replace(" W5", ", W5")))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    for chars in (1 << 20, 700):
        found = d.leaked(docs, benchmark, block_chars=chars).collect()
        assert {(r.doc_id, r.item_id) for r in found} == want
        assert all(0.4 <= r.score <= 1 for r in found)
    clean = d.decontaminated(docs, benchmark)
    assert {r.doc_id for r in clean.collect()} == set(range(200)) - {k for k, _ in want}


def test_an_item_in_every_document(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.range(100).selectExpr("id AS doc_id", f"concat('text ', id, ' begins. {item}. and ends') AS text")
    benchmark = spark.createDataFrame([(1, item), (2, "other words that no document holds at all")], "item_id long, text string")
    found = d.leaked(docs, benchmark).collect()
    assert len(found) == 100 and {r.score for r in found} == {1.0}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(texts[r.doc_id][r.char_start : r.char_end] == item for r in found)


def test_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta"
    docs = spark.createDataFrame(
        [(1, item, 1), (1, item, 1), (None, item, 2), (3, "", 3), (4, None, 4), (5, "alpha beta", 5), (6, "x " * 50000 + item, 6)],
        "doc_id long, text string, leaks int",
    )
    benchmark = spark.createDataFrame(
        [(7, item, "a"), (7, item, "a"), (None, item, "b"), (8, None, "c"), (9, "", "d"), (10, "alpha beta", "e")],
        "item_id long, text string, doc_id string",
    )
    found = d.leaked(docs, benchmark).collect()
    assert sorted((r.doc_id, r.item_id) for r in found if r.doc_id and r.item_id) == [(1, 7)] * 4 + [(6, 7)] * 2
    assert sum(r.doc_id is None for r in found) == 3 and sum(r.item_id is None for r in found) == 4
    clean = d.decontaminated(docs, benchmark)
    assert clean.columns == docs.columns and sorted(r.leaks for r in clean.collect()) == [3, 4, 5]
    assert d.leaked(docs.limit(0), benchmark).collect() == []
    assert d.leaked(docs, benchmark.limit(0)).collect() == []


def test_query_against_plain_search(spark, data_dir):
    """Whole items, as word sequences, are found; nothing is found in documents that share no three words with one."""
    texts = {r.doc_id: d.WORD.findall(r.text.lower()) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    items = {r.item_id: d.WORD.findall(r.text.lower()) for r in spark.read.parquet(f"{data_dir}/benchmark.parquet").collect()}
    rows = {(r.doc_id, r.item_id): r.score for r in queries.QUERIES["op2_benchmark_leaks"](spark, data_dir).collect()}
    whole = {(k, i) for k, t in texts.items() for i, w in items.items() if f" {' '.join(w)} " in f" {' '.join(t)} "}
    assert whole and whole <= set(rows) and all(rows[p] == 1.0 for p in whole)
    for (k, i), score in rows.items():
        assert abs(plain_alignment(items[i], texts[k]) / (2 * len(items[i])) - score) < 1e-9


def test_parts_of_long_items_short_items_and_chance(spark):
    rng = random.Random(12)
    long, middle, short = words(rng, 500), words(rng, 15), "what is the capital"
    part = long[200:350]
    texts = {
        1: words(rng, 100) + part + words(rng, 100),
        2: words(rng, 100) + edited(rng, part, 0.1) + words(rng, 2000),
        3: words(rng, 50) + long[:12] + words(rng, 50),
        4: words(rng, 20) + "this is what is the matter".split() + words(rng, 20),
        5: words(rng, 20) + "what is the capital of".split() + words(rng, 20),
        6: words(rng, 20) + middle[3:9] + words(rng, 20),
        7: words(rng, 20) + middle[:4] + ["edit"] + middle[5:] + words(rng, 20),
        8: words(rng, 20) + long[40:70] + words(rng, 20),
    }
    docs = spark.createDataFrame([(k, " ".join(t)) for k, t in texts.items()], "doc_id long, text string")
    items = [(1, " ".join(long)), (2, " ".join(middle)), (3, short)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in d.leaked(docs, benchmark).collect()}
    assert set(found) == {(1, 1), (2, 1), (5, 3), (7, 2), (8, 1)}
    text, r = " ".join(texts[1]), found[1, 1]
    assert " ".join(part) in text[r.char_start : r.char_end] and r.score < 0.4


def test_large_clean_text_is_no_leak():
    """Texts and items of words as frequent as in a language meet by chance only."""
    rng = random.Random(3)
    weights = [1 / (rank + 3) for rank in range(5000)]
    items = [rng.choices(range(5000), weights, k=n) for n in (8, 15, 18, 30, 59, 500) for _ in range(10)]
    text = " ".join(f"s{w}" for w in rng.choices(range(5000), weights, k=300000))
    block = d.Block.of([(k, " ".join(f"s{w}" for w in x)) for k, x in enumerate(items)], 3)
    block.choose_seeds(np.ones(len(block.grams)), 1)
    assert d.leaks_of([text], block, 0.4) == [[]]
