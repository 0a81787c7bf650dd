"""Toxicity by the nearest labelled examples under exact TF-IDF cosine.

Labelled examples are a bounded sample (``PER_CLASS`` of either label, those whose hashed id is
smallest). Terms are kept where the sample shows them to go with the label, all that reach
``MIN_CHI2``, however many; document frequencies are counted over the whole corpus. The examples form an inverted index whose
postings lie in blocks of ``BLOCK`` examples with the largest weight of each term in each
block. A document visits blocks by falling bound (the sum over its terms) until no block can
hold a nearer example than the k-th found, so the k nearest are exact. They vote by cosine;
votes are calibrated on the examples themselves, each scored without its own vote.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import fresh_name, release, stored, text_batches

PER_CLASS = 2000
MIN_CHI2 = 30.0
NEIGHBOURS = 15
BLOCK = 64
STEMS = (5, 6, 7)
RATES = (1 / 400, 1 / 200, 1 / 100, 1 / 50, 1 / 25)
PRIOR = 1.0  # weight of the base rate among the votes
REJECT_FROM = 0.3
_TO_SPACE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Lower-case runs of letters and digits (all non-ASCII characters count as letters)."""
    return (text or "").lower().encode("utf-8", "replace").translate(_TO_SPACE).split()


def features(text: str | None, known: dict[bytes, int] | None = None, bases: set[bytes] | None = None) -> Counter:
    """Counts of words and stems (their first ``STEMS`` bytes), and one term ``stem@level`` for each of ``RATES`` that a stem met twice or more reaches.

    The levels let a cosine, which knows no lengths, tell a text full of a stem from one that
    happens to hold it. With ``known`` only its terms are counted, under their numbers; ``bases`` are their stems.
    """
    all_words = words(text)
    found: Counter = Counter()
    for word, n in Counter(all_words).items():
        for stem in (word, *[word[:size] for size in STEMS if size < len(word)]):
            if bases is None or stem in bases:
                found[stem] += n
    for stem, n in list(found.items()):
        if n > 1:
            for level, rate in enumerate(RATES):
                if n >= rate * len(all_words):
                    found[b"%s@%d" % (stem, level)] = 1
    return found if known is None else Counter({known[t]: n for t, n in found.items() if t in known})


def held_out(key: str = "doc_id") -> Column:
    """The rows whose labels no model may see; a null key is never held out."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Index:
    """Examples with their postings by term and block, and what turns votes into scores."""

    terms: list[str]
    idf: np.ndarray
    ids: np.ndarray
    toxic: np.ndarray
    share: np.ndarray  # of the corpus that an example stands for, by its label
    base_rate: float
    vectors: list[tuple[np.ndarray, np.ndarray]]
    raw_at: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))
    score_at: np.ndarray = field(default_factory=lambda: np.array([0.0, 1.0]))

    def __post_init__(self) -> None:
        self.index()

    def index(self) -> None:
        blocks = -(-len(self.ids) // BLOCK)
        self.largest = np.zeros((len(self.terms), blocks))
        rows = sorted((t, e, w) for e, (terms, weights) in enumerate(self.vectors) for t, w in zip(terms.tolist(), weights.tolist(), strict=True))
        self.example = np.array([e for _, e, _ in rows], dtype=np.int64)
        self.weight = np.array([w for *_, w in rows], dtype=float)
        term = np.array([t for t, *_ in rows], dtype=np.int64)
        np.maximum.at(self.largest, (term, self.example // BLOCK), self.weight)
        place = term * blocks + self.example // BLOCK
        self.start = np.searchsorted(place, np.arange(len(self.terms) * blocks + 1)).reshape(-1) if blocks else np.zeros(1, np.int64)
        self.blocks = blocks

    def unit(self, terms: np.ndarray, counts: np.ndarray) -> np.ndarray:
        weights = (1 + np.log(counts)) * self.idf[terms]
        norm = np.sqrt((weights**2).sum())
        return weights / norm if norm else weights

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Example positions and cosines of the k nearest with any term in common; equal cosines go to the smaller position."""
        near, cosine = np.zeros(0, np.int64), np.zeros(0)
        if not len(terms) or not self.blocks:
            return near, cosine
        bounds = weights @ self.largest[terms]
        for block in np.argsort(-bounds, kind="stable"):
            if bounds[block] <= 0 or len(near) == k and bounds[block] * (1 + 1e-9) < cosine[-1]:
                break
            scores = np.zeros(BLOCK)
            for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
                at = t * self.blocks + block
                span = slice(self.start[at], self.start[at + 1])
                scores[self.example[span] - block * BLOCK] += w * self.weight[span]
            hit = np.flatnonzero(scores > 0)
            near = np.concatenate([near, hit + block * BLOCK])
            cosine = np.concatenate([cosine, scores[hit]])
            mine = near != without
            near, cosine = near[mine], cosine[mine]
            best = np.lexsort((near, -cosine))[:k]
            near, cosine = near[best], cosine[best]
        return near, cosine

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        """Cosine-weighted share of toxic neighbours, drawn to the base rate by ``PRIOR``."""
        weight = cosine * self.share[near]
        return float(((weight * self.toxic[near]).sum() + PRIOR * self.base_rate) / (weight.sum() + PRIOR))

    def calibrated(self, raw: float) -> float:
        # a small part of the raw vote keeps the order among equally calibrated documents
        return min(1.0, max(0.0, 0.98 * float(np.interp(raw, self.raw_at, self.score_at)) + 0.02 * raw))

    def calibrate(self) -> None:
        """Isotonic regression of the labels on the examples' votes without themselves."""
        raws = np.array([self.vote(*self.nearest(t, w, NEIGHBOURS, without=e)) for e, (t, w) in enumerate(self.vectors)])
        if not len(raws):
            return
        pools: list[list[float]] = []  # mean label, weight, lowest and highest vote
        for e in np.argsort(raws, kind="stable"):
            pools.append([float(self.toxic[e]), float(self.share[e]), raws[e], raws[e]])
            while len(pools) > 1 and (pools[-2][0] >= pools[-1][0] or pools[-2][3] == pools[-1][2]):
                mean, weight, _, high = pools.pop()
                total = pools[-1][1] + weight
                pools[-1] = [(pools[-1][0] * pools[-1][1] + mean * weight) / total, total, pools[-1][2], high]
        self.raw_at = np.array([v for p in pools for v in p[2:]])
        self.score_at = np.array([p[0] for p in pools for _ in "ab"])


def _counted(docs: DataFrame, terms: list[str], *keep: str, text: str = "text") -> DataFrame:
    """The kept columns with the ids and counts of the known terms in each whole text."""
    place = {t.encode("latin-1"): i for i, t in enumerate(terms)}
    words_in = fresh_name(docs, "__text")
    bases = {t.rpartition(b"@")[0] or t for t in place}
    schema = docs.select(*keep, F.array(F.lit(0)).alias("terms"), F.array(F.lit(0)).alias("counts")).schema

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [sorted(features(t, place, bases).items()) for t in batch.pop(words_in)]
            yield batch.assign(terms=[[t for t, _ in f] for f in found], counts=[[n for _, n in f] for f in found])
        release()

    return text_batches(docs).select(*keep, F.col(text).alias(words_in)).mapInPandas(count, schema)


def _sample(docs: DataFrame, labels: DataFrame, key: str, text: str) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``PER_CLASS`` examples of either label (doc_id, toxic, text), and how many rows carry each label."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = known.where(~held_out("doc_id"))
    totals = {t: n for t, n in known.groupBy("toxic").count().collect()}
    chosen = [r for t in totals for r in known.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id"), "doc_id").limit(PER_CLASS).collect()]
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id bigint, toxic int")  # at most two times PER_CLASS rows
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(picked), "doc_id")
    return rows, totals


def _chosen_terms(sample: DataFrame, positive: int, negative: int) -> list[str]:
    """The terms that go with label 1 most strongly by chi-square over the sample."""
    if not positive or not negative:
        return []

    def distinct(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # one count per term and label from each batch; bytes as characters, since a stem may end within one
        for batch in batches:
            seen: Counter = Counter()
            for toxic, text in zip(batch.toxic, batch.text, strict=True):
                seen.update((t, toxic == 1) for t in features(text))
            yield pd.DataFrame([(t.decode("latin-1"), n * one, n * (not one)) for (t, one), n in seen.items()], columns=["term", "pos", "neg"])

    a, b, n = F.col("pos"), F.col("neg"), float(positive + negative)
    c, d = positive - a, negative - b
    chi2 = n * (a * d - b * c) ** 2 / ((a + b) * (c + d) * float(positive) * float(negative))
    counted = sample.select("toxic", "text").mapInPandas(distinct, "term string, pos long, neg long").groupBy("term").agg(
        F.sum("pos").cast("double").alias("pos"), F.sum("neg").cast("double").alias("neg")
    )
    strong = counted.where((a + b < n) & (a / float(positive) > b / float(negative))).withColumn("chi2", chi2).where(F.col("chi2") >= MIN_CHI2)
    return [r.term for r in strong.orderBy(F.desc("chi2"), "term").collect()]


def score(docs: DataFrame, labels: DataFrame, *keep: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, kept columns, held_out, score, predicted, and the nearest examples (ids, labels, cosines) as evidence.

    Null, empty and term-free texts get the calibrated base rate. Without labels of both
    kinds there is nothing to tell apart and every score is the share of label 1 (0 without
    labels). A repeated label row counts once, with its largest label; rows whose label is
    null are not examples. Rows with a null key are scored like any other. An empty table
    gives no rows.
    """
    spark = docs.sparkSession
    sample, totals = _sample(docs, labels, key, text)
    sizes = {t: n for t, n in sample.groupBy("toxic").count().collect()}
    terms = _chosen_terms(sample, sizes.get(1, 0), sum(n for t, n in sizes.items() if t != 1))
    counted = stored(_counted(docs, terms, key, *keep, text=text), "toxicity-terms")
    total = counted.count()
    frequency = {t: n for t, n in counted.select(F.explode("terms").alias("t")).groupBy("t").count().collect()}
    idf = np.array([np.log((1 + total) / (1 + frequency.get(i, 0))) + 1 for i in range(len(terms))])
    examples = sorted(_counted(sample, terms, "doc_id", "toxic").collect(), key=lambda r: (-r.toxic, r.terms, r.counts, r.doc_id))  # at most two times PER_CLASS rows; like ones share blocks
    labelled = sum(totals.values())
    toxic = np.array([r.toxic == 1 for r in examples], dtype=float)
    share = np.array([totals[r.toxic] / sizes[r.toxic] for r in examples], dtype=float)
    share = share / share.max() if len(share) else share
    index = Index(terms, idf, np.array([r.doc_id for r in examples], dtype=np.int64), toxic, share, totals.get(1, 0) / labelled if labelled else 0.0, [])
    index.vectors = [(np.array(r.terms, dtype=np.int64), index.unit(np.array(r.terms, dtype=np.int64), np.array(r.counts, dtype=float))) for r in examples]
    index.index()
    index.calibrate()
    shared = spark.sparkContext.broadcast(index)
    extra = "score double, near_ids array<bigint>, near_toxic array<int>, near_cosine array<double>"
    schema = counted.select(key, *keep).schema

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        seen: dict[tuple, tuple] = {}
        for batch in batches:
            found = []
            for t, n in zip(batch.pop("terms"), batch.pop("counts"), strict=True):
                at = (tuple(t), tuple(n))
                if at not in seen:
                    if len(seen) > 100_000:
                        seen.clear()
                    ids = np.asarray(t, dtype=np.int64)
                    near, cosine = known.nearest(ids, known.unit(ids, np.asarray(n, dtype=float)), NEIGHBOURS)
                    seen[at] = (known.calibrated(known.vote(near, cosine)), known.ids[near].tolist(), known.toxic[near].astype(int).tolist(), cosine.tolist())
                found.append(seen[at])
            yield batch.assign(**{c: [f[i] for f in found] for i, c in enumerate(("score", "near_ids", "near_toxic", "near_cosine"))})
        release()

    judged = counted.mapInPandas(judge, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema) + ", " + extra)
    return judged.withColumns({"held_out": held_out(key), "predicted": (F.col("score") >= REJECT_FROM).cast("int")})


def drop_toxic(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not predicted toxic."""
    uid = fresh_name(docs, "uid")
    numbered = stored(docs.withColumn(uid, F.monotonically_increasing_id()), "toxicity-docs")
    rejected = score(numbered, labels, uid, key=key, text=text).where("predicted = 1").select(uid)
    return numbered.join(rejected, uid, "left_anti").drop(uid)
