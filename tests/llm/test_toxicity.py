import math

import numpy as np
from pyspark.sql import functions as F

from scorelake.llm import toxicity
from tests.llm.docs import awkward, prose, table


def corpus():
    texts = [(i, prose(i, 60) + (" vilething" * (1 + i % 3) + " nastyword" if i % 5 == 0 else "")) for i in range(400)]
    return texts, [(i, int(i % 5 == 0)) for i in range(400)]


def test_held_out_documents_are_told_apart(spark):
    texts, labels = corpus()
    marked = spark.createDataFrame(labels + [(0, None), (5, 1)], "doc_id bigint, toxic int")
    got = toxicity.score(table(spark, texts + [(1000, None), (1001, "")]), marked).collect()
    assert len(got) == 402
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == (r.doc_id % 5 == 0) for r in held if r.doc_id < 1000)
    assert all(0 <= r.score <= 1 for r in got) and all(r.predicted == 0 for r in got if r.doc_id >= 1000)


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    terms, examples = 40, 300
    vectors = []
    for _ in range(examples):
        ids = np.sort(rng.choice(terms, rng.integers(1, 8), replace=False))
        w = rng.random(len(ids))
        vectors.append((ids, w / math.sqrt((w**2).sum())))
    index = toxicity.Index([str(i) for i in range(terms)], np.ones(terms), np.arange(examples), np.zeros(examples), np.ones(examples), 0.1, vectors)
    dense = np.zeros((examples, terms))
    for e, (ids, w) in enumerate(vectors):
        dense[e, ids] = w
    for ids, w in vectors[:60]:
        near, cosine = index.nearest(ids, w, 15)
        scores = dense[:, ids] @ w
        want = np.sort(scores[scores > 0])[::-1][:15]
        assert np.allclose(cosine, want) and np.allclose(scores[near], cosine)


def test_labels_of_the_held_out_fold_are_never_used(spark):
    texts, labels = corpus()
    docs = table(spark, texts)
    fold = {r.doc_id for r in docs.where(toxicity.held_out()).collect()}
    turned = [(i, 1 - t if i in fold else t) for i, t in labels]
    one = {r.doc_id: r.score for r in toxicity.score(docs, spark.createDataFrame(labels, "doc_id bigint, toxic int")).collect()}
    other = {r.doc_id: r.score for r in toxicity.score(docs, spark.createDataFrame(turned, "doc_id bigint, toxic int")).collect()}
    assert one == other


def test_awkward_rows_and_no_labels(spark):
    docs = table(spark, awkward())
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    kept = toxicity.drop_toxic(docs, none)
    assert kept.schema == docs.schema and kept.count() == len(awkward())
    assert toxicity.score(docs.where(F.lit(False)), none).count() == 0
