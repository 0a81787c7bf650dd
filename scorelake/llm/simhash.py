"""SimHash near-duplicates with pivot distance tables.

A fingerprint holds the majority bit of the XXH64 values of all 4-word shingles. Equal
fingerprints are one node. Links between nodes (at most 4 differing bits) are found without
comparing all: 64 bits are cut into blocks, and since 4 differing bits touch at most 4
blocks, two linked nodes agree on all other blocks of some choice; each choice is a grouping
by those bits. Within a group a table of Hamming distances to reference fingerprints (pivots)
is made; rows are ordered by the first distance, and a pair is compared only while every
coordinate differs by at most 4 (the triangle inequality); survivors are verified bit by bit.

Groups above ``CELL_ROWS`` nodes are dealt over a triangle of cells, so that each pair still
meets in some cell and no task holds the group. Tasks send on one link per node at most (to
the smallest node it reaches there), not the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import default_partitions, fresh_name, release, stored, text_batches
from scorelake.llm.graph import components

WORDS = 4
SEED = 42
NEAR = 4
PIVOTS = 24
CELL_ROWS = 1024
_AT_ONCE = 1 << 16
_REFERENCES = np.random.default_rng(20).integers(0, 2**64, PIVOTS, dtype=np.uint64)


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """The unsigned fingerprint of one text; without a word (null, empty, white space) zero."""
    parts = (text or b"").lower().split()  # bytes: ASCII letters and ASCII white space only
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    width = min(words, len(parts))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, len(parts) - width + 1)
    counts = np.zeros(64, np.int64)
    for cut in range(0, len(hashes), _AT_ONCE):
        some = hashes[cut : cut + _AT_ONCE]
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The kept columns and fp, the fingerprint as a signed long."""
    content = fresh_name(docs, "__text")
    plain = text_batches(docs).select(*keep, F.col(text).cast("binary").alias(content))
    schema = docs.select(*keep, F.lit(0).cast("long").alias("fp")).schema

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = np.fromiter((fingerprint(t) for t in batch.pop(content)), np.uint64, len(batch))
            yield batch.assign(fp=made.view(np.int64))
        release()

    return plain.mapInPandas(of, schema)


def _masks(nodes: int) -> list[int]:
    """A mask of agreeing bits per choice of blocks; more blocks, and so smaller groups, for more nodes."""
    blocks = 6 if nodes < 1 << 25 else 7 if nodes < 1 << 29 else 8
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [(1 << cuts[i + 1]) - (1 << cuts[i]) for i in range(blocks)]
    return [sum(choice) - (1 << 64 if sum(choice) >> 63 else 0) for choice in combinations(parts, blocks - NEAR)]


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every linked node with the smallest node it reaches over the links a-b."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        before = root.copy()
        low = np.minimum(root[x], root[y])
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            return nodes, nodes[root]


def near_pairs(group: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One link per node and smallest node it reaches, among fingerprints of equal group."""
    table = np.bitwise_count(fp[:, None] ^ _REFERENCES[None, :]).astype(np.int8)
    order = np.lexsort((table[:, 0], group))
    group, fp, table = group[order], fp[order], table[order]
    active, step = np.arange(len(fp)), 0
    found: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    while len(active):
        step += 1
        active = active[active + step < len(fp)]
        other = active + step
        inside = (group[other] == group[active]) & (table[other, 0] - table[active, 0] <= NEAR)
        active = active[inside]
        left, right = active, other[inside]
        for pivot in range(1, PIVOTS):
            if not len(left):
                break
            close = np.abs(table[left, pivot] - table[right, pivot]) <= NEAR
            left, right = left[close], right[close]
        close = np.bitwise_count(fp[left] ^ fp[right]) <= NEAR
        found.append((fp[left[close]], fp[right[close]]))
        waiting += int(close.sum())
        if waiting > 2_000_000:  # hold links to roots only
            found, waiting = [_roots(*map(np.concatenate, zip(*found, strict=True)))], 0
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    nodes, roots = _roots(*map(np.concatenate, zip(*found, strict=True)))
    return nodes[nodes != roots], roots[nodes != roots]


def links(nodes: DataFrame) -> DataFrame:
    """a, b: links between the distinct fingerprints ``fp`` that join all nodes within reach of each other."""
    masks = _masks(nodes.count())
    choices = F.array(*[F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(masks)])
    keyed = nodes.select("fp", F.inline(choices))
    large = keyed.groupBy("choice", "bits").count().where(F.col("count") > CELL_ROWS).select("choice", "bits", F.ceil(F.col("count") / CELL_ROWS).cast("int").alias("side"))
    own = F.pmod(F.xxhash64("fp"), F.col("side")).cast("int")
    cells = F.transform(F.sequence(F.lit(0), F.col("side") - 1), lambda other: F.least(own, other) * F.col("side") + F.greatest(own, other))
    dealt = keyed.join(large, ["choice", "bits"], "left").select("fp", "choice", "bits", F.explode(F.coalesce(cells, F.array(F.lit(0)))).alias("cell"))

    def match(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = [(b.group.to_numpy(), b.fp.to_numpy().view(np.uint64)) for b in batches]
        if rows:
            a, b = near_pairs(*map(np.concatenate, zip(*rows, strict=True)))
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    parts = default_partitions(nodes.sparkSession) * 2
    # the 64-bit group number only bounds what is compared: a clash adds comparisons, never a link
    grouped = dealt.select("fp", F.xxhash64("choice", "bits", "cell").alias("group")).repartition(parts, "group")
    return grouped.mapInPandas(match, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", *keep: str) -> DataFrame:
    """key, fp, root, component_id for every row: root names the component, component_id is the smallest key in it.

    Null and wordless texts have fingerprint zero and link like any other. Rows with a null
    key take part in links; they never give the component its id, which is null if no row of
    the component has a key. Repeated rows are rows of their own. An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, key, *keep, text=text), "simhash-rows")
    nodes = rows.groupBy("fp").agg(F.min(key).alias("least"))
    found = components(links(nodes), "simhash-links")
    of_node = nodes.join(found, nodes.fp == found.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = of_node.groupBy("root").agg(F.min("least").alias("component_id")).withColumnRenamed("root", "of")
    named = of_node.join(least, F.col("root") == F.col("of")).select(F.col("fp").alias("node"), "root", "component_id")
    return rows.join(named, F.col("fp") == F.col("node"), "left").drop("node")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-copies: of each component the row with the smallest key stays (first of equal keys; null keys last)."""
    uid = fresh_name(docs, "uid")
    numbered = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "simhash-docs")
    classes = near_duplicates(numbered, key, text, uid)
    first = F.min(F.struct(F.col(key).isNull(), F.col(key), F.col(uid)))
    chosen = classes.groupBy("root").agg(first.alias("first")).select(F.col(f"first.{uid}").alias(uid))
    return numbered.join(chosen, uid, "left_semi").drop(uid)
