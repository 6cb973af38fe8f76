import random

from finledger.llm import linededup, queries


def test_patience_aligns_unique_lines_first():
    later = ["a", "x", "b", "c", "x", "d"]
    first = ["x", "a", "b", "x", "c", "d", "x"]
    pairs = linededup.patience(later, first)
    assert all(later[i] == first[j] for i, j in pairs)
    assert [i for i, _ in pairs] == sorted({i for i, _ in pairs}) and [j for _, j in pairs] == sorted({j for _, j in pairs})
    assert {(0, 1), (2, 2), (3, 4), (5, 5)} <= set(pairs)
    assert linededup.patience([], ["a"]) == [] and linededup.patience(["a"], ["b"]) == []
    assert linededup.longest_rising([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])


def test_blocks_in_another_order_and_repeated():
    first = [1, 2, 3, 4, 5, 6]
    assert linededup.shared_blocks([4, 5, 9, 1, 2], [5] * 5, first, 5) == [0, 1, 3, 4]
    assert linededup.shared_blocks([1, 1, 1], [5] * 3, first, 5) == [0, 1, 2]
    assert linededup.shared_blocks([7, 2, 8], [9, 1, 9], first, 5) == []
    rng = random.Random(2)
    for _ in range(300):
        later, first = ([rng.randrange(9) for _ in range(rng.randrange(12))] for _ in range(2))
        words = [1 if line < 4 else 6 for line in later]
        gone = linededup.shared_blocks(later, words, first, 5)
        assert {i for i, line in enumerate(later) if line >= 4 and line in first} <= set(gone)
        assert all(later[i] in first for i in gone)


def test_query_against_first_holders(spark, data_dir):
    """Every long line that an earlier document holds goes; whatever goes is held by an earlier document."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    first = {}
    for key in sorted(texts):
        for line in texts[key].split("\n"):
            first.setdefault(line.strip(" "), key)
    removed = 0
    for r in queries.QUERIES["op8_line_dedup"](spark, data_dir).collect():
        lines = texts[r.doc_id].split("\n")
        gone = set(r.lines_removed)
        long = {i for i, x in enumerate(lines) if x.strip(" ").count(" ") >= 4 and first[x.strip(" ")] < r.doc_id}
        assert long <= gone
        assert all(first[lines[i].strip(" ")] < r.doc_id for i in gone)
        assert r.text == "\n".join(x for i, x in enumerate(lines) if i not in gone)
        removed += len(gone)
    assert removed


def test_odd_rows(spark):
    passage = "one two three four five six"
    docs = spark.createDataFrame(
        [
            (1, f"{passage}\nown line of document number one", 9, "a"),
            (2, f"short\n{passage}\nshort", 0, "b"),
            (2, f"short\n{passage}\nshort", 0, "b"),
            (None, f"{passage}\n{passage}", 0, "c"),
            (5, "", 0, "d"),
            (6, None, 0, "e"),
            (7, f"{passage}\nown line of document number one", 0, "f"),
            (8, "a clean text of several words here", 77, "g"),
        ],
        "doc_id long, text string, n_chars long, gone string",
    )
    out = linededup.dedup_lines(docs)
    assert out.columns == docs.columns
    rows = {(r.doc_id, r.gone): (r.text, r.n_chars) for r in out.collect()}
    assert out.count() == 8
    assert rows[(1, "a")] == (f"{passage}\nown line of document number one", 9)
    assert rows[(2, "b")] == ("short\nshort", 11)
    assert rows[(None, "c")] == ("", 0)
    assert rows[(5, "d")] == ("", 0) and rows[(6, "e")] == (None, 0)
    assert rows[(7, "f")] == ("", 0) and rows[(8, "g")] == ("a clean text of several words here", 77)
    assert linededup.dedup_lines(docs.limit(0)).collect() == []
    reported = linededup.dedup_lines(docs, report=True).filter("doc_id = 7").first()
    assert reported.lines_removed == [0, 1] and reported.partners == [1]


def test_a_line_that_every_document_holds(spark):
    docs = spark.range(300).selectExpr(
        "id AS doc_id", "concat('this very common line is everywhere\nonly ', id, ' has these five words') AS text"
    )
    texts = {r.doc_id: r.text for r in linededup.dedup_lines(docs).collect()}
    assert texts[0].startswith("this very") and all("common" not in texts[i] for i in range(1, 300))


def test_shared_runs_of_short_lines_against_all_runs():
    """Every line of every run of enough words that both hold goes, empty lines apart."""
    rng = random.Random(6)
    for _ in range(500):
        later, first = ([rng.randrange(6) for _ in range(rng.randrange(14))] for _ in range(2))
        words = [0, 1, 2, 2, 4, 5]
        later_words, first_words = [words[x] for x in later], [words[x] for x in first]
        gone = set(linededup.shared_blocks(later, later_words, first, 5, first_words))
        own, there = [i for i, x in enumerate(later) if x], [x for x in first if x]
        runs = {tuple(there[a:b]) for a in range(len(there)) for b in range(a + 1, len(there) + 1)}
        for a in range(len(own)):
            for b in range(a + 1, len(own) + 1):
                run = own[a:b]
                if sum(later_words[i] for i in run) >= 5 and tuple(later[i] for i in run) in runs:
                    assert set(run) <= gone
        assert all(later[i] in first for i in gone)


def test_blocks_without_a_long_line(spark):
    verse = "\n".join(f"four {a} words {b}" for a in "abcde" for b in "fghijk")
    table = "\n".join(f"{a}\t{a}{a}" for a in "pqrst")
    chinese = "\u4eca\u5929\u5929\u6c14\u5f88\u597d\u6211\u4eec\u53bb\u516c\u56ed"
    thai = "\u0e27\u0e31\u0e19\u0e19\u0e35\u0e49\u0e2d\u0e32\u0e01\u0e32\u0e28\u0e14\u0e35"
    code = "x9" * 20
    shared = [verse, table, chinese, thai, code, "one\n\ntwo\n \t\nthree four\n\nfive"]
    rows = []
    for n, block in enumerate(shared):
        rows.append((10 * n, f"first {n}\n{block}\nend {n}"))
        rows.append((10 * n + 1, f"later {n}\n{block}\nstop {n}"))
        rows.append((10 * n + 2, f"first {n}\n{block}\nend {n}"))
    rows += [(100, "a few"), (101, "a few"), (102, "a few\nmore"), (103, "one\ntwo"), (104, "\t"), (105, "\t")]
    out = {r.doc_id: r for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), report=True).collect()}
    texts = dict(rows)
    for n in range(len(shared)):
        assert out[10 * n].text == texts[10 * n]
        assert out[10 * n + 1].text == f"later {n}\nstop {n}" and out[10 * n + 1].partners == [10 * n]
        assert out[10 * n + 2].text == ""
    assert [out[k].text for k in range(100, 106)] == ["a few", "", "a few\nmore", "one\ntwo", "\t", "\t"]
