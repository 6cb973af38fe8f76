import numpy as np

from finledger.llm import queries
from finledger.llm import toxicity as t
from finledger.llm.common import fold

MACHINE = t.grammar()


def weight(text, lexicon=None):
    return t.clause_features([text], lexicon or {}, MACHINE)[0]


def test_clauses_not_words():
    plain, aimed = weight("an idiot came by")[0], weight("you are an idiot")[0]
    assert 0 < weight("you are not an idiot")[0] < plain < aimed
    assert 0 < weight("she said some idiot came")[0] < plain
    assert weight("an idiot. you came")[0] == plain
    assert weight("i will kill you")[0] > 1 > weight("kill the process")[0] > 0
    assert weight("do not kill them")[0] < 0.5
    assert weight("nothing of the kind")[0] == weight("")[0] == 0
    assert weight("never mind. idiot")[0] == plain


def test_long_sentences_are_read_on():
    """Target, negation and report hold over any number of words, as in a short sentence."""
    for gap in (0, 1, 38, 39, 40, 45, 90, 3000):
        assert weight("kill " + "word " * gap + "you")[0] == weight("kill you")[0] == 1.7
        assert weight("word " * gap + "do not kill them")[0] == weight("do not kill them")[0]
        assert weight("word " * gap + "she said some idiot came")[0] == weight("she said some idiot came")[0]
        assert weight("you " + "word " * gap + "idiot")[0] == weight("you word idiot")[0]


def test_composition_is_running_one_after_the_other():
    rng = np.random.default_rng(3)
    parts = [t.scoped(t.NEGATION, 3), t.scoped(t.REPORT, 8), t.matcher(t.INSULT, 1.0, 0.5), t.matcher(t.WEAK, 0.2, 0.0)]
    whole = parts[0].then(parts[1]).then(parts[2]).then(parts[3])
    for _ in range(50):
        word = rng.integers(0, t.SYMBOLS, 12)
        state, total = 0, 0.0
        for symbol in word:
            total += whole.weight[state, symbol]
            state = whole.to[state, symbol]
        states, plain = [0] * 4, 0.0
        for symbol in word:
            for k, part in enumerate(parts):
                plain += part.weight[states[k], symbol]
                states[k], symbol = part.to[states[k], symbol], part.out[states[k], symbol]
        assert abs(total - plain) < 1e-9


def test_features_do_not_depend_on_chunks(monkeypatch):
    texts = ["you idiot. fine day", "", "word " * 100 + "scum", "kill\nyou", "no! idiot; you", "schlimmwort du"]
    whole = t.clause_features(texts, {"schlimm*": 1.5}, MACHINE)
    monkeypatch.setattr(t, "CHARS", 3)
    assert np.allclose(t.clause_features(texts, {"schlimm*": 1.5}, MACHINE), whole)
    assert whole[2][1] == 3 and whole[5][0] == 1.5 + 0.5 and whole[1].tolist() == [0] * 5


def test_held_out(spark):
    found = queries.QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = found.join(labels, "doc_id").filter("held_out").collect()
    toxic = [r.predicted for r in held if r.toxic]
    clean = [r.predicted for r in held if not r.toxic]
    assert sum(toxic) / len(toxic) > 0.85 and sum(clean) / len(clean) < 0.01


def test_copies_count_once(spark):
    rows = [("alpha beta gamma delta", 1)] * 5 + [("alpha beta gamma delta", 0), ("", 0), ("", 0), ("b", 0)]
    kept = t.without_copies(spark.createDataFrame(rows, "text string, label int")).collect()
    assert sorted(map(tuple, kept)) == [("", 0), ("alpha beta gamma delta", 0), ("alpha beta gamma delta", 1), ("b", 0)]


def test_odd_rows(spark):
    rows = [(i, f"you are an idiot and a moron. go away {i}" if i % 2 else f"a calm day at the sea. fine {i}", i % 2) for i in range(60)]
    docs = [(i, text, 1) for i, text, _ in rows] + [(1, rows[1][1], 1), (None, None, 2), (99, "", 3), (98, ". \n!", 4)]
    docs = spark.createDataFrame(docs, "doc_id long, text string, label int")
    labels = [(i, y) for i, _, y in rows] + [(1, 1), (None, 1), (99, None)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = t.fit_toxicity(docs, labels, fold("doc_id", 3) != 1)
    found = t.score_toxicity(docs, model).collect()
    assert len(found) == 64 and all(0 <= r.score <= 1 for r in found)
    assert all(r.predicted == r.doc_id % 2 for r in found if r.doc_id is not None and r.doc_id < 60)
    nothing = t.fit_toxicity(docs.limit(0), labels.limit(0), fold("doc_id", 3) != 1)
    assert t.score_toxicity(docs.limit(0), nothing).collect() == []
    assert {r.predicted for r in t.score_toxicity(docs, nothing).collect()} == {0}
