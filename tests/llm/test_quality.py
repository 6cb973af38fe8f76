import zlib

import numpy as np
import pytest

from finledger.llm import quality, queries
from finledger.llm.common import fold, labelled_sample


def test_pairs_rank_good_over_bad_and_the_cut_is_the_quantile():
    rng = np.random.default_rng(1)
    good = (np.arange(300) % 5 > 0).astype(int)
    features = rng.normal(size=(300, len(quality.FEATURES)))
    features[:, 0] += 6 * good
    model = quality.fit_pairs(features, good, 0.3, 5, 1e-3)
    scores = model.score(features)
    assert scores[good == 1].min() > scores[good == 0].max()
    assert (scores < 0.3).sum() == (good == 0).sum()


@pytest.mark.parametrize("labels", [[], [1, 1], [0]])
def test_without_comparisons_everything_passes(labels):
    features = np.zeros((len(labels), len(quality.FEATURES)))
    model = quality.fit_pairs(features, np.array(labels), 0.3, 5, 1e-3)
    assert model.score(np.zeros((1, len(quality.FEATURES))))[0] >= 0.3


def test_held_out_accuracy(spark, data_dir):
    found = queries.QUERIES["op1_quality_ranking"](spark, data_dir)
    labels = spark.read.parquet(f"{data_dir}/labels.parquet")
    rows = found.join(labels, "doc_id").collect()
    assert found.count() == spark.read.parquet(f"{data_dir}/documents.parquet").count()
    assert sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    held = [r for r in rows if r.held_out]
    assert held and sum(r.predicted == r.quality for r in held) / len(held) > 0.9


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, "a fine text of some words.", 1), (1, "a fine text of some words.", 1), (2, "", 2), (None, None, 3),
         (4, "BAD!! BAD!! BAD!!" * 500, 4), (5, "\n \t", 5)],
        "doc_id long, text string, score int",
    )
    labels = spark.createDataFrame(
        [(1, 1), (1, 1), (4, 0), (None, 1), (5, None), (9, 0)], "doc_id long, quality int"
    )
    model = quality.fit_quality(docs, labels, fold("doc_id", 5) >= 0)
    found = quality.score_quality(docs, model).collect()
    assert len(found) == 6 and all(0 <= r.score <= 1 for r in found)
    by_id = {r.doc_id: r.predicted for r in found}
    assert by_id[1] == 1 and by_id[4] == 0
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns and 4 not in {r.doc_id for r in kept.collect()}
    nothing = quality.fit_quality(docs.limit(0), labels.limit(0), fold("doc_id", 5) >= 0)
    assert quality.score_quality(docs.limit(0), nothing).collect() == []


def test_the_sample_is_bounded_and_the_same_for_any_layout(spark):
    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    docs = spark.range(3000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "'x' AS label")
    docs = docs.union(docs.filter("doc_id < 10"))
    training = fold("doc_id", 5) != 0
    samples = [
        sorted(tuple(r) for r in labelled_sample(docs, labels.repartition(n), "quality", training, 200).collect()) for n in (1, 7)
    ]
    assert samples[0] == samples[1] and len(samples[0]) == 200
    assert all(zlib.crc32(text.split()[1].encode()) % 5 and int(text.split()[1]) % 2 == label for text, label in samples[0])
    assert labelled_sample(docs, labels, "quality", training, 10**6).count() == labels.filter(training).count()
