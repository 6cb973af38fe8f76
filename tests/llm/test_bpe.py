import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from finledger.llm import bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECES = regex.compile(public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.load(PATH)


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(packed):
    return np.frombuffer(packed, dtype="<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=6))
def test_any_text_is_encoded_like_the_reference_and_comes_back(vocabulary, reference, texts):
    for text, packed in zip(texts, bpe.encode_texts(texts, vocabulary, PIECES), strict=True):
        assert ids(packed) == reference.encode_ordinary(text)
        assert bpe.decode_ids(packed, vocabulary) == text.encode()


def test_long_pieces_take_the_same_merges(vocabulary, reference):
    letters = np.random.default_rng(3).choice(list("etaoinshrdlé"), 9000)
    for text in ["".join(letters), "ab" * 5000, " " * 5001 + "x", "0123456789" * 500, "!" * 6000]:
        assert ids(bpe.encode_texts([text], vocabulary, PIECES)[0]) == reference.encode_ordinary(text)


def test_chunks_do_not_change_the_result(vocabulary, monkeypatch):
    texts = ["one two three", "", "vier fünf sechs " * 40, "…", "neuf dix"]
    whole = bpe.encode_texts(texts, vocabulary, PIECES)
    monkeypatch.setattr(bpe, "CHARS", 5)
    monkeypatch.setattr(bpe, "CELLS", 7)
    assert bpe.encode_texts(texts, vocabulary, PIECES) == whole


def test_rows(spark, reference):
    docs = spark.createDataFrame(
        [(1, "it's a test", "x"), (1, "it's a test", "x"), (None, "", "y"), (3, None, None)],
        "doc_id long, text string, ids string",
    )
    coder = bpe.ByteBpe(spark, PATH, public_tokenizers.PATTERN)
    found = bpe.digests(bpe.tokenised(docs, coder)).collect()
    known = reference.encode_ordinary("it's a test")
    assert [r.n_tokens for r in found] == [len(known), len(known), 0, 0]
    assert found[0].ids_sha256 == hashlib.sha256(np.array(known, "<u4").tobytes()).hexdigest()
    assert found[0].decoded_sha256 == hashlib.sha256(b"it's a test").hexdigest()
    assert found[3].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    unpacked = docs.select(coder.encode("text").alias("ids")).select(bpe.ids_array().alias("a")).first().a
    assert unpacked == known
    back = docs.select(coder.encode("text").alias("ids")).select(coder.decode("ids").alias("b")).collect()
    assert [bytes(r.b) for r in back] == [b"it's a test"] * 2 + [b""] * 2
    assert bpe.digests(bpe.tokenised(docs.limit(0), coder)).collect() == []


def test_query_against_the_reference_library(spark, reference, data_dir):
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for r in rows:
        known = reference.encode_ordinary(r.text or "")
        want[r.doc_id] = (
            len(known),
            hashlib.sha256(np.array(known, "<u4").tobytes()).hexdigest(),
            hashlib.sha256((r.text or "").encode()).hexdigest(),
        )
    found = queries.QUERIES["op4_byte_bpe"](spark, data_dir).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == want


def test_unknown_id(vocabulary):
    with pytest.raises(ValueError):
        bpe.decode_ids(np.array([10**6], "<u4").tobytes(), vocabulary)
