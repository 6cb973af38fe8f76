import hashlib

import numpy as np
import public_tokenizers
import regex

import corpus_pipeline
from finledger.llm import bpe, linededup, queries
from tests.llm.test_simhash import plain_components, plain_fingerprint


def test_stages_against_brute_force(spark, data_dir):
    docs = spark.read.parquet(f"{data_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, data_dir)
        if k < 4:
            assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept.append({r.doc_id: r for r in docs.collect()})
    source = {r.doc_id: r.text for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    scored = queries.QUERIES["op1_quality_ranking"](spark, data_dir).collect()
    assert set(kept[0]) == {r.doc_id for r in scored if r.predicted}
    assert all(kept[0][i].text == source[i] for i in kept[0])

    first = {}
    for i in sorted(kept[0]):
        for line in source[i].split("\n"):
            first.setdefault(line.strip(" "), i)
    assert set(kept[1]) == set(kept[0])
    for i, r in kept[1].items():
        own = [x for x in source[i].split("\n") if x.strip(" ").count(" ") < 4 or first[x.strip(" ")] == i]
        left = r.text.split("\n") if r.text else []
        assert [x for x in left if x.strip(" ").count(" ") >= 4] == [x for x in own if x.strip(" ").count(" ") >= 4]
        assert r.n_chars == len(r.text)

    prints = [(i, plain_fingerprint(r.text)) for i, r in kept[1].items()]
    assert set(kept[2]) == {c for _, c in plain_components(prints)}
    assert all(kept[2][i].text == kept[1][i].text for i in kept[2])
    assert set(kept[3]) <= set(kept[2]) and all(kept[3][i].text == kept[2][i].text for i in kept[3])
    vocabulary = bpe.Vocabulary.load(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    pieces = regex.compile(public_tokenizers.PATTERN)
    assert set(kept[4]) == set(kept[3])
    for i, r in kept[4].items():
        packed = bpe.encode_texts([kept[3][i].text], vocabulary, pieces)[0]
        assert (bytes(r.ids), r.n_tokens) == (packed, len(np.frombuffer(packed, "<u4")))
        assert r.decoded_sha256 == hashlib.sha256(kept[3][i].text.encode()).hexdigest()


def test_run_is_the_stages_one_after_the_other(spark, data_dir):
    rows = corpus_pipeline.run(spark, data_dir).collect()
    assert rows and len({r.doc_id for r in rows}) == len(rows)


def test_empty_and_odd_tables(spark):
    passage = "one two three four five six"
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    rows = [(1, passage, "en", "s", 27, "a"), (1, passage, "en", "s", 27, "a"), (None, None, None, None, None, None), (2, "", "en", "s", 0, "b")]
    docs = spark.createDataFrame(rows, schema)
    for frame, want in ((docs, [1, 1, None, 2]), (docs.limit(0), [])):
        out = linededup.dedup_lines(frame)
        assert sorted((r.doc_id for r in out.collect()), key=str) == sorted(want, key=str)
    once = corpus_pipeline.simhash_stage(spark, docs, "").collect()
    assert sorted(r.doc_id for r in once) == [1, 2]
