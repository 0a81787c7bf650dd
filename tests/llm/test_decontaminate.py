import random

from pyspark.sql import functions as F

from scorelake.llm import decontaminate
from tests.llm.docs import awkward, prose, table


def bench(spark, extra=()):
    items = [(i, prose(1000 + i, 25) + ". " + prose(2000 + i, 6) + ".") for i in range(30)]
    return spark.createDataFrame([*items, (None, prose(5, 30)), (90, None), (91, ""), *extra], "item_id bigint, text string"), dict(items)


def test_copies_and_paraphrases_are_found_and_clean_documents_stay(spark):
    benchmark, items = bench(spark, [(95, "zzqa zzqb zzqc")])
    texts, want = [], {}
    for i in range(30):
        if i % 3 == 0:
            text = prose(i, 100 + 13 * i) + " " + items[i].upper() + " " + prose(50 + i, 80)
        elif i % 3 == 1:  # one word in six replaced, the answer kept
            r, (body, answer) = random.Random(i), items[i].split(". ")
            text = prose(i, 70) + " " + " ".join("other" if r.random() < 1 / 6 else w for w in body.split()) + ". " + answer + " " + prose(i + 1, 90)
        else:
            text = prose(i, 400)
        texts.append((i, text))
        want[i] = [i] if i % 3 < 2 else []
    texts += [(200, prose(3, 40) + " zzqa zzqb zzqc " + prose(4, 40)), (201, prose(3, 40) + " zzqa zzqc zzqb " + prose(4, 40))]
    want |= {200: [95], 201: []}
    got = {r.doc_id: r.leaked_items for r in decontaminate.find_leaks(table(spark, texts), benchmark, "doc_id").collect()}
    found = sum(got[i] == want[i] for i in want if want[i])
    assert all(got[i] == [] for i in want if not want[i]) and found >= 0.9 * sum(map(bool, want.values()))
    assert all(got[i] == want[i] for i in range(0, 30, 3))


def test_benchmarks_in_parts_give_the_same(spark, monkeypatch):
    benchmark, items = bench(spark)
    docs = table(spark, [(i, prose(i, 60) + " " + items[i] + " " + prose(i, 60)) for i in range(10)])
    monkeypatch.setattr(decontaminate, "ITEMS_AT_ONCE", 7)
    assert all(r.leaked_items == [r.doc_id] for r in decontaminate.find_leaks(docs, benchmark, "doc_id").collect())


def test_items_longer_than_a_window_are_found(spark):
    long = [(200 + i, prose(7000 + i, n)) for i, n in enumerate((70, 100, 130, 150, 200, 300, 700))]
    benchmark, _ = bench(spark, long)
    texts = [(k, prose(k, 90 + k % 37) + " " + text + " " + prose(k + 50, 100)) for k, text in long] + [(1, prose(1, 900)), (2, prose(2, 40) + " " + " ".join(long[4][1].split()[:100]))]
    got = {r.doc_id: r.leaked_items for r in decontaminate.find_leaks(table(spark, texts), benchmark, "doc_id").collect()}
    assert got == {k: [k] for k, _ in long} | {1: [], 2: []}


def test_the_space_is_fitted_on_all_documents(spark, monkeypatch):
    import numpy as np

    r = random.Random(8)
    vocabulary = [f"w{i}" for i in range(3000)]
    some = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    items = decontaminate.Items.of([(i, some(40)) for i in range(40)])
    texts = [*(some(r.choice([3, 60, 64, 65, 150])) for _ in range(2300)), *[some(70)] * 3, "", None, "nothing known here"]
    docs = table(spark, list(enumerate(texts)))
    got = decontaminate.latent_space(docs, "text", items)
    weights, terms = decontaminate.term_weights(docs, "text", items), len(items.terms)
    passages = [n[s : s + 64] for n in [*items.texts, *map(items.numbers, texts)] for s in range(0, len(n), 64)]
    counts = np.array([np.bincount(p[p >= 0], minlength=terms) for p in passages], dtype=float) * (weights > 0)
    test = np.random.default_rng(6).standard_normal((terms, min(decontaminate.RANK, terms))) * (weights > 0)[:, None]
    basis, _ = np.linalg.qr(weights[:, None] * (counts.T @ (counts @ test)))
    want = weights[:, None] * basis
    assert (weights > 0).sum() > decontaminate.RANK and np.allclose(got @ got.T, want @ want.T, rtol=1e-3, atol=1e-3 * np.abs(want @ want.T).max())
    known = [items.numbers(t) for t in texts]
    paired, n = decontaminate._gram(iter(known), test)
    monkeypatch.setattr(decontaminate, "PAIRED", 0)
    multiplied, m = decontaminate._gram(iter(known), test)
    assert n == m == len(passages) - len(items.texts) and np.allclose(paired, multiplied)


def test_subsequence_length():
    import numpy as np

    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in "ab")
        table_ = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table_[i + 1][j + 1] = table_[i][j] + 1 if x == y else max(table_[i][j + 1], table_[i + 1][j])
        assert decontaminate.common_subsequence(np.array(a), np.array(b)) == table_[-1][-1]


def test_awkward_rows(spark):
    docs = table(spark, awkward())
    benchmark, _ = bench(spark)
    kept = decontaminate.drop_leaks(docs, benchmark)
    assert kept.schema.fieldNames() == docs.schema.fieldNames() and kept.count() == len(awkward())
    assert decontaminate.drop_leaks(docs, benchmark.where(F.lit(False))).count() == len(awkward())
    assert decontaminate.drop_leaks(docs.where(F.lit(False)), benchmark).count() == 0
