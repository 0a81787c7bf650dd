import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelake.llm import hard_negatives

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, uid string, range string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, "x", "u", "r") for i, v, l in rows], SCHEMA).repartition(5)


def run(spark, rows, every=10, **settings):
    taken = hard_negatives.labelled_vectors(frame(spark, rows))
    return sorted(tuple(r) for r in hard_negatives.mine(taken, F.col("vec_id") % every == 0, **settings).collect())


def brute_force(rows, every=10, positives=5, negatives=10):
    kept = []
    for i, v, l in rows:
        if i is not None and l is not None and v is not None and all(c is not None and math.isfinite(np.float32(c)) for c in v):
            kept.append((i, [math.floor(256 * float(np.float32(c))) for c in v], l))
    result = []
    for at, (anchor, v, label) in enumerate(kept):
        if anchor % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), i, n, l) for n, (i, w, l) in enumerate(kept) if n != at and len(w) == len(v)]
        for minus, positive, _, _ in sorted(s for s in scored if s[3] == label)[:positives]:
            fit = sorted(s for s in scored if s[3] != label and 30 * -minus <= 100 * -s[0] <= 90 * -minus)
            result += [(anchor, positive, r + 1, i, -minus, -s) for r, (s, i, _, _) in enumerate(fit[:negatives])]
    return sorted(result)


def clustered(seed, n, d, labels=4):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(d)] for _ in range(labels)]
    rows = []
    for i in range(n):
        l = r.randrange(labels)
        size = math.exp(r.gauss(0, 0.7))
        rows.append((i, [size * (0.6 * c + r.gauss(0, 0.5)) for c in centres[r.randrange(labels)]], l))
    return rows


@pytest.mark.parametrize("bucket,cells", [(8, 200), (16, 1 << 16)])
def test_matches_brute_force(spark, monkeypatch, bucket, cells):
    monkeypatch.setattr(hard_negatives, "BUCKET", bucket)
    monkeypatch.setattr(hard_negatives, "LEAST_CELLS", cells)
    monkeypatch.setattr(hard_negatives, "RANGE_CELLS", cells)
    monkeypatch.setattr(hard_negatives, "CHUNK", 3)
    monkeypatch.setattr(hard_negatives, "VISITORS", 7)
    rows = clustered(2, 400, 8)
    rows += [(1000 + i, [0.5] * 8, 9) for i in range(120)] + [(2000 + i, [0.5] * 8, 3) for i in range(40)]
    rows += [(3000, None, 1), (3010, [1.0, None] * 4, 1), (3020, [math.nan] * 8, 1), (3030, [math.inf] * 8, 1), (None, [1.0] * 8, 1), (3040, [1.0] * 8, None)]
    rows += [(3050, [], 1), (3051, [], 1), (3060, [1.0, 2.0], 1), (3061, [1.0, 1.0], 1), (3062, [0.5, 0.5], 2), (3070, [0.0] * 8, 1), (3080, [-1.0] * 8, 2)]
    assert run(spark, rows) == brute_force(rows)


def test_pruning_keeps_every_row_that_reaches_the_score(monkeypatch):
    monkeypatch.setattr(hard_negatives, "BUCKET", 200)
    r = np.random.default_rng(4)
    x = np.round(r.normal(size=(3000, 5)) * np.exp(r.normal(size=(3000, 1))) * 256).astype(np.int64)
    index = hard_negatives.Index(np.arange(3000), np.arange(3000), np.zeros(3000, np.int64), x)
    scored = {20: 0, 300: 0, 1500: 0}
    for q in x[:40]:
        scores = index.x @ q
        for n in scored:
            least = np.sort(scores)[-n]
            met = {int(i): int(s) for rows, found in index.visit(q, lambda least=least: least) for i, s in zip(rows, found)}
            scored[n] += len(met)
            assert all(met.get(i) == s for i, s in enumerate(scores.tolist()) if s >= least)
    assert scored[20] < 0.2 * 40 * 3000 and scored[300] < 0.5 * 40 * 3000


def test_repeated_rows_few_matches_and_huge_entries(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (5, [0.5, 0.0], 2), (6, [0.5, 0.5], 2)]
    assert run(spark, rows) == sorted(2 * [(0, 0, 1, 5, 65536, 32768), (0, 0, 2, 6, 65536, 32768)])
    got = run(spark, [(0, [3e38], 1), (1, [3e38], 1), (2, [1.0], 2), (3, [-3e38], 2)])
    assert got == []
    rows = [(0, [4e6], 1), (1, [3e6], 1), (2, [2e6], 2), (3, [1.0], 2)]
    assert run(spark, rows) == brute_force(rows)


def test_one_label_and_empty_table(spark):
    assert run(spark, [(i, [1.0, i / 50], 3) for i in range(30)]) == []
    assert run(spark, []) == []
