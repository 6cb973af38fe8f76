from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from finledger.llm import packing, queries

FILES = [public_tokenizers.path(f) for f in queries.PACKING_FILES]


@pytest.fixture(scope="module")
def tokenizer():
    tokenizer = Tokenizer.from_file(FILES[0])
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [1]


def packed(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, sequence string")
    return packing.packed_sequences(df, *FILES, public_tokenizers.PATTERN, **options).collect()


def check(rows, want, window):
    """Every id in one piece, sequences without gaps, each a window or a smaller power of two long."""
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        docs[r.doc_id].append((r.start, r.ids, r.doc_tokens))
        assert len(r.ids) == 4 * r.length > 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= window and at & (at - 1) == 0
    for key, texts in want.items():
        found = b"".join(ids for _, ids, _ in sorted(docs.pop(key)))
        if len(texts) == 1:
            assert np.frombuffer(found, "<u4").tolist() == texts[0]
        assert len(found) == 4 * sum(map(len, texts))
    assert not docs
    return sequences


def test_query_on_whole_table(spark, data_dir, tokenizer):
    docs = {r.doc_id: ids_of(tokenizer, r.text) for r in spark.read.parquet(f"{data_dir}/documents.parquet").collect()}
    rows = queries.QUERIES["op12_retrieval_packing"](spark, data_dir).collect()
    by, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = docs[r.doc_id][r.start : r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(own, dtype="<u4").tobytes()) and len(own) == r.length
        assert r.doc_tokens == len(docs[r.doc_id])
        by[r.doc_id].append((r.start, r.length))
        sequences[r.sequence_id].append((r.offset, r.length))
    for key, ids in docs.items():
        at = 0
        for start, length in sorted(by[key]):
            assert start == at
            at += length
        assert at == len(ids)
    sizes = []
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        sizes.append(at)
    assert all(s & (s - 1) == 0 and s <= 2048 for s in sizes)
    assert sum(s < 2048 for s in sizes) <= 11


def test_odd_rows(spark, tokenizer):
    rows = [
        (1, None), (2, ""), (3, "a word"), (3, "a word"), (None, "no key"), (4, "x " * 5000), (5, "é𝄞 <|endoftext|> ünï"),
        (6, " " * 120000 + "z"), (7, "y" * 20000), (8, "   \x1c\x85"),
    ]
    want = defaultdict(list)
    for key, text in rows:
        want[key].append(ids_of(tokenizer, text))
    check(packed(spark, rows, window=256), want, 256)
    check(packed(spark, rows, window=64, shard_tokens=100), want, 64)
    assert packed(spark, []) == []
    with pytest.raises(ValueError):
        packed(spark, rows, window=100)


def test_texts_are_not_searched_for_empty_special_tokens(tokenizer):
    """With no special token the library stops at every character; the one it has instead is ordinary text."""
    with open(FILES[0], encoding="utf-8") as file:
        encode = packing.Encoder(file.read(), packing.read_ranks(FILES[1]), public_tokenizers.PATTERN)
    assert encode.fast.special_tokens_set == {packing.UNUSED}
    for text in ("", "plain words", packing.UNUSED, f"a {packing.UNUSED}b é𝄞{packing.UNUSED * 3}", "<|\x00", "'s it's 12  \n\n x  "):
        assert [*encode(text), 1] == ids_of(tokenizer, text) and encode(text).max(initial=0) < encode.fast.n_vocab - 1


def test_copies_fill_many_shards(spark, tokenizer):
    rows = [(i, "the same text of some words, again and again.") for i in range(500)] + [(1000 + i, f"text {i} " * 9) for i in range(40)]
    want = {key: [ids_of(tokenizer, text)] for key, text in rows}
    sequences = check(packed(spark, rows, window=128, shard_tokens=600), want, 128)
    assert max(sum(n for _, n in s) for s in sequences.values()) == 128


def test_neighbours_share_the_window():
    """By plain BM25 over all entries the seed's best unused neighbours fill its window."""
    rng = np.random.default_rng(2)
    entries = [np.concatenate([rng.integers(0, 50, 20), 100 + 10 * (i % 6) + rng.integers(0, 10, 20)]).astype("<u2") for i in range(30)]
    counts = np.zeros(200)
    for e in entries:
        counts[np.unique(e)] += 1
    idf = np.log(1 + (len(entries) - counts + 0.5) / (counts + 0.5))
    index = packing.Index(entries, idf, 40.0)
    used = np.zeros(30, dtype=bool)
    used[[0, 7]] = True
    terms = np.unique(entries[0])
    terms = terms[np.argsort(-idf[terms], kind="stable")[:8]]
    want = []
    for i, e in enumerate(entries):
        score = sum(idf[t] * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(e) / 40)) for t in terms if (n := int((e == t).sum())))
        if score > 0 and not used[i]:
            want.append((-score, i))
    got = list(index.ranked(entries[0], 8, used, first=4))
    assert got == list(index.ranked(entries[0], 8, used))
    assert len(got) == len(want) and set(got) == {i for _, i in want}
    assert [round(-s, 9) for s, _ in sorted(want)] == [round(-dict((i, s) for s, i in want)[i], 9) for i in got]
    window = [e for e, _, _ in packing.pack_shard(entries, idf, 40.0, 128, 8)[0]]
    nearest = list(index.ranked(entries[0], 8, np.arange(30) == 0))
    assert window == [0, *nearest[:3]]


def test_likeness_of_copies():
    a = np.arange(1000, dtype="<u2")
    near = np.concatenate([a[:500], [7], a[501:]]).astype("<u2")
    assert packing.likeness(a) == packing.likeness(a.copy())
    assert sum(packing.likeness(np.roll(a, k)) == packing.likeness(np.roll(near, k)) for k in range(0, 1000, 10)) > 80
    assert len({packing.likeness(np.array(x, dtype="<u2")) for x in ([1], [2], [1, 2], [2, 1], [1, 2, 3])}) == 5
