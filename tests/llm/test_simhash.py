import random

import numpy as np
import xxhash

from finledger.llm import queries, simhash


def plain_fingerprint(text):
    words = text.translate({c: c + 32 for c in range(65, 91)}).encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{(id, fingerprint)} to component, by comparing all pairs."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(prints):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return sorted(((key, least.get(find(i))) for i, (key, _) in enumerate(prints)), key=str)


def test_query_against_all_pairs(spark, data_dir):
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").select("doc_id", "text").collect()
    prints = [(r.doc_id, plain_fingerprint(r.text or "")) for r in rows]
    found = queries.QUERIES["op10_simhash"](spark, data_dir).collect()
    assert {r.doc_id: int(r.fingerprint, 16) for r in found} == dict(prints)
    assert sorted(((r.doc_id, r.component_id) for r in found), key=str) == plain_components(prints)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_and_blocks_against_all_pairs(spark):
    rng = random.Random(5)
    prints = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(rng.choice([1, 3, 30])):
            for bit in rng.sample(range(64), rng.choice([0, 1, 2, 3, 4, 5])):
                base ^= 1 << bit
            prints.add(base)
    prints = sorted(prints)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    want = {}
    for key, component in plain_components([(signed(p), p) for p in prints]):
        want[key] = component
    for block in (2, 1000):
        roots = simhash.components(simhash.near_edges(frame, 3, block)).collect()
        got = {r.node: r.root for r in roots}
        assert {k: got.get(k, k) for k in want} == want


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i + 1, i) for i in range(40)] + [(1000 + i, 500) for i in range(200)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[1000 + i] == 500 for i in range(200))
    assert simhash.components(spark.createDataFrame([], "u long, v long")).collect() == []


def test_odd_rows(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame(
        [(7, text, 1), (3, text.upper(), 2), (3, text, 2), (None, text, 3), (9, "", 4), (8, None, 5), (2, "hi THERE", 6),
         (None, "alone here", 7), (None, "alone here", 7)],
        "doc_id long, text string, fp int",
    )
    found = sorted(simhash.simhash_components(docs).select("doc_id", "component_id").collect(), key=str)
    want = [(7, 3), (3, 3), (3, 3), (None, 3), (9, 8), (8, 8), (2, 2), (None, None), (None, None)]
    assert [tuple(r) for r in found] == sorted([tuple(w) for w in want], key=lambda w: f"Row(doc_id={w[0]}, component_id={w[1]})")
    kept = simhash.keep_one_per_component(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted((r.doc_id for r in rows), key=str) == [2, 3, 8, None]
    assert simhash.simhash_components(docs.limit(0)).collect() == []
    assert simhash.keep_one_per_component(docs.limit(0)).collect() == []


def test_fingerprint_of_long_texts_and_white_space():
    text = "a\tb\x0bc d  e\nÀ" * 30000
    assert simhash.fingerprint_of(text, 3) % (1 << 64) == plain_fingerprint(text)
    assert simhash.fingerprint_of(" \n", 3) == 0


def test_stars_are_spanning():
    values = np.array([0b0, 0b111, 0b111111, 1 << 40 | 1 << 41 | 1 << 42 | 1 << 43], dtype=np.int64)
    assert sorted(simhash.linked_stars(values, 3)) == [(0b111, 0), (0b111111, 0)]
