import re

import xxhash
from pyspark.sql import functions as F

from scorelake.llm import simhash
from tests.llm.docs import awkward, prose, table


def plain_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    """{position: smallest position reachable}"""
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_components_match_brute_force(spark):
    base = prose(7, 200)
    texts = [(100 + i, base.replace(" ", "  ", i) + " tail" * (i % 3)) for i in range(12)] + awkward()
    got = simhash.near_duplicates(table(spark, texts)).collect()
    assert len(got) == len(texts)
    prints = [plain_fingerprint(t) for _, t in texts]
    of = plain_components(prints)
    least = {r: min((k for (k, _), q in zip(texts, of) if q == r and k is not None), default=None) for r in set(of)}
    want = sorted((str(k), p, str(least[r])) for (k, _), p, r in zip(texts, prints, of))
    assert sorted((str(r.doc_id), r.fp & (2**64 - 1), str(r.component_id)) for r in got) == want


def test_large_groups_are_dealt_over_cells(spark, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 8)
    prints = [(1 << 40) ^ (1 << i) ^ (1 << j) for i in range(20) for j in range(i)] + [0xFFFF << 48 >> 16]
    nodes = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    found = simhash.components(simhash.links(nodes)).collect()
    assert {r.node for r in found} == set(prints[:-1]) and len({r.root for r in found}) == 1


def test_one_of_each_group_stays_with_all_columns(spark):
    docs = table(spark, awkward())
    kept = simhash.drop_near_duplicates(docs)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(1) == 1 and 2 not in ids and 3 not in ids  # wordless texts are one group
    assert ids.count(4) == 1 and 5 not in ids and ids.count(None) == 1


def test_empty_table(spark):
    empty = table(spark, awkward()).where(F.lit(False))
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
