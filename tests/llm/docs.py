"""Small document tables with the awkward cases, and brute-force versions of the operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, row string, fp string, shard int"
WORDS = [a + b for a in ("an", "be", "co", "du", "el", "fo", "gri", "hu") for b in ("ra", "ten", "lik", "mos", "pu", "sto", "vi")]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) for _ in range(n))


def rows(texts):
    return [(i, t, "en", "s", len(t or ""), "u", "r", "f", 1) for i, t in texts]


def awkward():
    """Null and empty texts, null keys, repeated rows, a very long text, a long word."""
    return [
        (1, None), (2, ""), (3, "  \n\t "), (None, prose(1, 30)), (None, None), (4, prose(2, 40)), (4, prose(2, 40)), (5, prose(2, 40)),
        (6, prose(3, 20_000)), (7, "x" * 30_000), (8, "word"), (9, "two words"), (10, "Ünïcödé 日本語 🙂 text\x00\x1f"), (11, "1" * 5000 + " " + "1-" * 3000),
    ]


def table(spark, texts):
    return spark.createDataFrame(rows(texts), SCHEMA).repartition(3)
