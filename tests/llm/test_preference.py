import duckdb

from finledger.llm import oracles, preference, queries
from tests.conftest import table_of


def test_query_against_sql(spark, data_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{data_dir}/conversations.parquet'")
    want = con.execute(oracles.PREFERENCE)
    want = table_of([c[0] for c in want.description], want.fetchall())
    found = queries.QUERIES["op6_preference_pairs"](spark, data_dir)
    assert table_of(found.columns, found.collect()) == want
    rows = found.collect()
    assert all(r.rendered[r.loss_start : r.loss_end].endswith("<|end|>\n") for r in rows if r.loss_end)


def side(spark, rows):
    return spark.createDataFrame(rows, "pair_id long, turn long, role string, text string, part string")


def test_prefix_completions_and_odd_rows(spark):
    chosen = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "hello", "x"), (1, 1, "assistant", "hello", "x"),
        (1, 2, "user", "more", "x"), (2, 0, "user", "same", "x"), (3, 0, None, None, "x"), (None, 0, "user", "lost", "x"),
        (4, None, "assistant", "late", "x"), (4, 0, "user", "b", "x"), (4, 0, "user", "a", "x"),
    ]
    rejected = [
        (1, 0, "user", "hi", "x"), (1, 1, "assistant", "go away", "x"), (1, 2, "user", "more", "x"),
        (2, 0, "user", "same", "x"), (4, 0, "user", "a", "x"), (5, 0, "assistant", "alone", "x"),
    ]
    rows = preference.preference_segments(side(spark, chosen), side(spark, rejected)).collect()
    got = sorted((r.pair_id, r.part, r.turn, r.rendered, r.rendered[r.loss_start : r.loss_end]) for r in rows)
    last = 2**63 - 1
    assert got == [
        (1, "chosen", 1, "<|assistant|>\nhello<|end|>\n", "hello<|end|>\n"),
        (1, "chosen", 2, "<|user|>\nmore<|end|>\n", ""),
        (1, "prompt", 0, "<|user|>\nhi<|end|>\n", ""),
        (1, "rejected", 1, "<|assistant|>\ngo away<|end|>\n", "go away<|end|>\n"),
        (1, "rejected", 2, "<|user|>\nmore<|end|>\n", ""),
        (2, "prompt", 0, "<|user|>\nsame<|end|>\n", ""),
        (3, "chosen", 0, "<|unknown|>\n<|end|>\n", ""),
        (4, "chosen", last, "<|assistant|>\nlate<|end|>\n", "late<|end|>\n"),
        (4, "prompt", 0, "<|user|>\na<|end|>\n", ""),
        (5, "rejected", 0, "<|assistant|>\nalone<|end|>\n", "alone<|end|>\n"),
    ]
    empty = side(spark, [])
    assert preference.preference_segments(empty, empty).collect() == []


def test_swapped_replies(spark):
    rows = [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (0, 2, "user", "thanks"), (1, 0, "user", "q1"),
        (1, 1, "assistant", "a1"), (2, 0, "user", "q2"), (2, 1, "assistant", "a2"), (3, 0, "user", "no reply"),
    ]
    chosen, rejected = preference.swapped_replies(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    assert sorted(tuple(r) for r in chosen.collect()) == [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a0"), (1, 0, "user", "q1"), (1, 1, "assistant", "a1"),
        (2, 0, "user", "q2"), (2, 1, "assistant", "a2"),
    ]
    assert sorted(tuple(r) for r in rejected.collect()) == [
        (0, 0, "user", "q0"), (0, 1, "assistant", "a1"), (1, 0, "user", "q1"), (1, 1, "assistant", "a0"), (2, 0, "user", "q2"),
    ]
