import math

from pyspark.sql import functions as F

from scorelake.llm import topk


def test_matches_brute_force(spark, monkeypatch):
    import random

    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "RANGE_ROWS", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    r = random.Random(4)
    rows = [(i, [r.gauss(0, 1) for _ in range(6)], "x") for i in range(300)]
    rows += [(1000 + i, [0.5] * 6, "same") for i in range(60)]
    rows += [(2000, None, "n"), (2050, [1.0, None, 1.0, 1.0, 1.0, 1.0], "n"), (2100, [math.nan] * 6, "n"), (2150, [math.inf] * 6, "n"), (None, [1.0] * 6, "n"), (2200, [], "e"), (2250, [1.0, 2.0], "short")]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, uid string").repartition(5)
    got = topk.top_k(topk.integer_vectors(frame), F.col("vec_id") % 50 == 0, 5).collect()
    vectors = {r.vec_id: [math.floor(256 * float(x)) for x in r.embedding] for r in frame.collect() if r.vec_id is not None and r.embedding is not None and all(x is not None and math.isfinite(x) for x in r.embedding)}
    want = []
    for q in (v for v in vectors if v % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q]))
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:5])]
    assert sorted(tuple(r) for r in got) == sorted(want)


def test_repeated_rows_and_huge_components(spark):
    frame = spark.createDataFrame([(0, [1.0]), (0, [1.0]), (1, [3e38]), (2, [-3e38])], "vec_id bigint, embedding array<float>")
    got = topk.top_k(topk.integer_vectors(frame), F.col("vec_id") == 0, 5).collect()
    assert sorted(r.rank for r in got) == [1, 1, 2, 2, 3, 3]
    assert {(r.rank, r.vec_id) for r in got} == {(1, 1), (2, 0), (3, 2)}


def test_empty_table(spark):
    frame = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert topk.top_k(topk.integer_vectors(frame), F.col("vec_id") % 50 == 0, 5).count() == 0
