"""Benchmark decontamination by latent semantic retrieval.

Passages of ``PASSAGE`` words are TF-IDF vectors over the benchmark's vocabulary. One pass
over all documents counts passages per term. The latent space is fitted on the benchmark and
all documents by a randomised SVD: in a second pass tasks multiply the passages' Gram matrix
with a random test matrix, and the leading right singular vectors follow from that product
(Nystrom form). A third pass moves a window over every document, takes items whose latent
cosine reaches ``MIN_COSINE`` as candidates, and checks them on the words: a document
leaks an item if a stretch of it holds ``COPIED`` of the item's words in order (longest common
subsequence), or ``PARAPHRASED`` of them in order together with the item's answer (its last
sentence) word for word. Items under ``SHORT`` words must be found word for word.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import fresh_name, release, text_batches
from scorelake.llm.toxicity import words

PASSAGE = 64
PART = 32  # words of a part of an item longer than a passage; parts overlap by half, and each lies within one window
RANK = 256
COMMON = 0.05
RAREST = 8
MIN_COSINE = 0.35
COPIED = 0.8
PARAPHRASED = 0.55
MIN_SHARED = 0.5  # of an item's latent vector, and of its weighty terms in any order
SHORT = 8
ANSWER_WORDS = 3
ITEMS_AT_ONCE = 2000
VOCABULARY_CHUNK = 512
TASKS_PER_CORE = 2
STRETCH = 256 * PASSAGE
PAIRED = 5000  # terms; a task then holds counts of 100 MB
_FOUND = "leaked_items array<bigint>, leaked_shares array<double>"


@dataclass
class Items:
    """The benchmark's items as word numbers; about ``ITEMS_AT_ONCE`` of them and their parts at most."""

    ids: list[int]
    terms: dict[bytes, int]
    texts: list[np.ndarray]
    answers: list[np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple[int, str]]) -> Items:
        terms: dict[bytes, int] = {}
        number = lambda ws: np.array([terms.setdefault(w, len(terms)) for w in ws], dtype=np.int64)
        ids, texts, answers = [], [], []
        for item, text in rows:
            found = number(words(text))
            if len(found):
                sentences = [s for s in map(words, re.split(r"[.!?]+(?:\s+|$)", text)) if len(s) >= ANSWER_WORDS]
                ids.append(item)
                texts.append(found)
                answers.append(number(sentences[-1]) if len(sentences) > 1 else found)
        return cls(ids, terms, texts, answers)

    def numbers(self, text: str | None) -> np.ndarray:
        """Word numbers of a text; words outside the vocabulary are -1."""
        found = words(text)
        return np.fromiter(map(self.terms.get, found, repeat(-1)), np.int64, len(found))


def _sums(rows: np.ndarray, numbers: np.ndarray, cell: int) -> np.ndarray:
    """For each run of ``cell`` words the sum of their rows."""
    known = np.flatnonzero(numbers >= 0)
    cells = -(-len(numbers) // cell)
    out = np.zeros((cells, rows.shape[1]), rows.dtype)
    if len(known):
        at = known // cell
        starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        out[at[starts]] = np.add.reduceat(rows[numbers[known]], starts, axis=0)
    return out


def _pieces(texts: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of many short texts or of a stretch of a long one, and the number of each word's passage."""
    held, size = [], 0
    for numbers in texts:
        for cut in range(0, len(numbers), STRETCH):
            held.append(numbers[cut : cut + STRETCH])
            size += len(held[-1])
            if size >= STRETCH:
                yield _joined(held)
                held, size = [], 0
    if held:
        yield _joined(held)


def _joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(n) for n in texts])
    passages = -(-lengths // PASSAGE)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.concatenate(texts), np.repeat(np.cumsum(passages) - passages, lengths) + place // PASSAGE


def _gram(texts: Iterator[np.ndarray], test: np.ndarray) -> tuple[np.ndarray, int]:
    """Sum over all passages t of t (t' test), and the passage count; terms without a row in the test matrix weigh nothing and are left out.

    Up to ``PAIRED`` terms, it is counted how often each two meet in a passage, and the counts are
    multiplied once; above, each passage is multiplied.
    """
    weighty = np.flatnonzero(test.any(axis=1))
    column = np.full(len(test), -1)
    column[weighty] = np.arange(len(weighty))
    rows, product, count = test[weighty], np.zeros((len(weighty), test.shape[1])), 0
    met = np.zeros((len(weighty), len(weighty)), dtype=np.int32) if len(weighty) <= PAIRED else None
    pairs, words_met = 0, np.zeros(len(weighty))

    def multiply() -> None:
        """The counts of pairs in either order, a few rows at a time."""
        for cut in range(0, len(met), VOCABULARY_CHUNK):
            some = met[cut : cut + VOCABULARY_CHUNK].astype(np.float64)
            product[cut : cut + VOCABULARY_CHUNK] += some @ rows
            np.add(product, some.T @ rows[cut : cut + VOCABULARY_CHUNK], out=product)

    for numbers, passage in _pieces(texts):
        count += int(passage[-1]) + 1
        term = np.where(numbers >= 0, column[numbers], -1)
        term, passage = term[term >= 0], passage[term >= 0]
        if not len(term):
            continue
        if met is not None:
            here = np.arange(len(term))
            later = np.searchsorted(passage, passage, side="right") - here - 1
            one = np.repeat(here, later)
            other = np.arange(len(one)) - np.repeat(np.cumsum(later) - later, later) + one + 1
            np.add.at(met.reshape(-1), term[one] * len(met) + term[other], np.int32(1))
            words_met += np.bincount(term, minlength=len(met))
            pairs += len(one)
            if pairs > 1 << 30:  # long before a count is too large
                multiply()
                met[:], pairs = 0, 0
        else:
            begins = np.diff(passage, prepend=-1) > 0
            projected = np.add.reduceat(rows[term], np.flatnonzero(begins), axis=0)
            order = np.argsort(term, kind="stable")
            starts = np.flatnonzero(np.diff(term[order], prepend=-1))
            product[term[order][starts]] += np.add.reduceat(projected[(np.cumsum(begins) - 1)[order]], starts, axis=0)
    out = np.zeros(test.shape)
    if met is not None:
        multiply()
    out[weighty] = product + words_met[:, None] * rows
    return out, count


def _streamed_sum(docs: DataFrame, text: str, shared: object, of: Callable) -> tuple[np.ndarray, int]:
    """The sum of ``of(texts, *shared) -> (rows per term, count)`` over all tasks.

    Tasks send their sums in vocabulary chunks, which are added as they stream by; the
    driver gets one row per term.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, *rest = shared.value
        full, count = of((items.numbers(t) for b in batches for t in b["text"]), *rest)
        if count:
            chunks = range(0, len(full), VOCABULARY_CHUNK)
            yield pd.DataFrame({"chunk": range(len(chunks)), "count": [count] + [0] * (len(chunks) - 1), "data": [full[c : c + VOCABULARY_CHUNK].tobytes() for c in chunks]})
        release()

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            for chunk, count, data in batch.itertuples(index=False):
                one = np.frombuffer(data)
                sums[chunk] = sums[chunk] + one if chunk in sums else one
                counts[chunk] = counts.get(chunk, 0) + count
        if sums:
            yield pd.DataFrame({"chunk": list(sums), "count": [counts[c] for c in sums], "data": [v.tobytes() for v in sums.values()]})

    schema = "chunk int, count bigint, data binary"
    terms = len(shared.value[0].terms)
    sent = docs.select(F.col(text).alias("text")).mapInPandas(partial, schema)
    rows = sorted(sent.repartition(-(-terms // VOCABULARY_CHUNK), "chunk").mapInPandas(total, schema).collect())
    if not rows:
        return np.zeros(0), 0
    return np.concatenate([np.frombuffer(r.data) for r in rows]).reshape(terms, -1), sum(r["count"] for r in rows)


def _frequency(texts: Iterator[np.ndarray], terms: int) -> tuple[np.ndarray, int]:
    """Passages per term, and passages."""
    frequency, count = np.zeros(terms), 0
    for numbers, passage in _pieces(texts):
        passages = int(passage[-1]) + 1
        known = numbers >= 0
        pairs = np.sort(numbers[known] * passages + passage[known])
        frequency += np.bincount(pairs[np.diff(pairs, prepend=-1) > 0] // passages, minlength=terms)
        count += passages
    return frequency, count


def term_weights(docs: DataFrame, text: str, items: Items) -> np.ndarray:
    """Squared IDF of every term over the passages of all documents and items.

    Terms in more than ``COMMON`` of all passages weigh nothing, except an item's
    ``RAREST`` rarest, so that each item keeps terms to be found by.
    """
    terms = len(items.terms)
    shared = docs.sparkSession.sparkContext.broadcast((items, terms))
    frequency, count = _frequency(iter(items.texts), terms)
    more, passages = _streamed_sum(docs, text, shared, _frequency)
    if passages:
        frequency, count = frequency + more[:, 0], count + passages
    kept = frequency <= COMMON * count
    for numbers in items.texts:
        distinct = np.unique(numbers)
        kept[distinct[np.argsort(frequency[distinct], kind="stable")[:RAREST]]] = True
    return np.where(kept, (np.log((1 + count) / (1 + frequency)) + 0.01) ** 2, 0.0)


def latent_space(docs: DataFrame, text: str, items: Items) -> np.ndarray:
    """For every term its weighted row of the leading right singular vectors.

    The weights and the space come from the items and all documents.
    """
    weights = term_weights(docs, text, items)
    rank = min(RANK, len(items.terms))
    test = np.random.default_rng(6).standard_normal((len(items.terms), rank)) * (weights > 0)[:, None]
    shared = docs.sparkSession.sparkContext.broadcast((items, test))
    tasks = docs.coalesce(TASKS_PER_CORE * docs.sparkSession.sparkContext.defaultParallelism)  # each sends one matrix, so their number does not grow with the input
    product, _ = _gram(iter(items.texts), test)
    more, passages = _streamed_sum(tasks, text, shared, _gram)
    if passages:
        product = product + more
    core = test.T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    sound = values > values.max() * 1e-10
    half = (weights[:, None] * product) @ (vectors[:, sound] / np.sqrt(values[sound]))
    basis, _, _ = np.linalg.svd(half, full_matrices=False)
    return (weights[:, None] * basis).astype(np.float32)


def common_subsequence(item: np.ndarray, stretch: np.ndarray) -> int:
    """Length of the longest common subsequence, one bit per word of the item."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    row = full
    for w in stretch.tolist():
        match = masks.get(w)
        if match is not None:
            met = row & match
            row = ((row + met) | (row - met)) & full
    return len(item) - row.bit_count()


def _holds(stretch: np.ndarray, phrase: np.ndarray) -> bool:
    """Whether the phrase stands in the stretch word for word."""
    if len(phrase) > len(stretch):
        return False
    starts = np.flatnonzero(stretch[: len(stretch) - len(phrase) + 1] == phrase[0])
    return any((stretch[s : s + len(phrase)] == phrase).all() for s in starts)


def _parts(numbers: np.ndarray) -> list[np.ndarray]:
    """The item, and if it is longer than a passage its overlapping parts; the last ends with the item."""
    if len(numbers) <= PASSAGE:
        return [numbers]
    last = len(numbers) - PART
    return [numbers, *(numbers[s : s + PART] for s in [*range(0, last, PART // 2), last])]


class Search:
    """The latent vectors of the items and of the parts of long ones, and the checks of a document against them."""

    def __init__(self, items: Items, rows: np.ndarray):
        self.items, self.rows = items, rows
        self.weighty = (rows != 0).any(axis=1)
        parts = [(i, part) for i, t in enumerate(items.texts) for part in _parts(t)]
        self.item = np.array([i for i, _ in parts])
        latent = np.array([rows[part].sum(axis=0) for _, part in parts])
        self.norms = np.maximum(np.linalg.norm(latent, axis=1), 1e-12)
        self.latent = latent / self.norms[:, None]
        self.reach = max(map(len, items.texts))
        self.rare = [frozenset(t[self.weighty[t]].tolist()) for t in items.texts]

    def candidates(self, numbers: np.ndarray) -> list[tuple[int, int]]:
        """(item, first word of the window) for every cosine of ``MIN_COSINE`` or more with the item or a part of it where the window also covers ``MIN_SHARED`` of that latent vector; windows overlap by half."""
        half = PASSAGE // 2
        told = np.where((numbers >= 0) & self.weighty[numbers], numbers, -1)
        cells = _sums(self.rows, told, half)
        windows = cells.copy()
        windows[:-1] += cells[1:]
        norms = np.linalg.norm(windows, axis=1)
        some = np.flatnonzero(norms > 0)
        along = windows[some] @ self.latent.T
        window, part = np.nonzero((along >= MIN_COSINE * norms[some, None]) & (along >= MIN_SHARED * self.norms))
        return sorted(set(zip(self.item[part].tolist(), (some[window] * half).tolist(), strict=True)))

    def share(self, item: int, start: int, numbers: np.ndarray, seen: frozenset) -> float:
        """The item's share found in order around the window, or 0 if that does not make a leak; seen: the terms around the window."""
        wanted, answer = self.items.texts[item], self.items.answers[item]
        if len(self.rare[item] & seen) < MIN_SHARED * len(self.rare[item]):
            return 0.0
        whole = numbers[max(0, start - len(wanted)) : start + PASSAGE + len(wanted)]
        if len(wanted) < SHORT:
            return 1.0 if _holds(whole, wanted) else 0.0
        share = common_subsequence(wanted, whole[whole >= 0]) / len(wanted)
        return share if share >= COPIED or share >= PARAPHRASED and _holds(whole, answer) else 0.0

    def leaks(self, text: str | None) -> dict[int, float]:
        numbers = self.items.numbers(text)
        if not len(numbers) or not self.items.ids:
            return {}
        best: dict[int, float] = {}
        around: dict[int, frozenset] = {}
        for item, start in self.candidates(numbers):
            if best.get(item, 0.0) < 1.0:
                if start not in around:
                    around[start] = frozenset(numbers[max(0, start - self.reach) : start + PASSAGE + self.reach].tolist())
                share = self.share(item, start, numbers, around[start])
                if share:
                    best[item] = max(best.get(item, 0.0), share)
        return {self.items.ids[i]: s for i, s in sorted(best.items())}


def find_leaks(docs: DataFrame, benchmark: DataFrame, *keep: str, text: str = "text", item: str = "item_id") -> DataFrame:
    """The kept columns of every document, with leaked_items and leaked_shares (empty where nothing leaks).

    Items without a word and items with a null id are left out; without items nothing leaks.
    Null and empty texts leak nothing. Repeated rows are judged alike. Benchmarks above
    ``ITEMS_AT_ONCE`` items and parts of items are searched in parts, one more pass over the documents each, so
    what is broadcast stays bounded. An empty table gives no rows.
    """
    usable = benchmark.where(F.col(item).isNotNull() & F.col("text").isNotNull()).select(F.col(item).cast("bigint").alias("item"), "text")
    count = F.size(F.split("text", r"[^\p{L}\p{N}]+"))
    vectors = F.when(count <= PASSAGE, 1).otherwise(F.ceil(count / (PART // 2)) + 1)
    parts = max(1, -(-(usable.agg(F.sum(vectors)).first()[0] or 0) // ITEMS_AT_ONCE))
    none = [F.array().cast(kind).alias(name) for name, kind in (("leaked_items", "array<bigint>"), ("leaked_shares", "array<double>"))]
    content = fresh_name(docs, "__text")
    result = text_batches(docs).select(*keep, F.col(text).alias(content), *none)
    for part in range(parts):
        rows = usable.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).orderBy("item", "text").collect()
        items = Items.of([(r["item"], r["text"]) for r in rows])
        if items.ids:
            shared = docs.sparkSession.sparkContext.broadcast(Search(items, latent_space(docs, text, items)))

            def judge(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
                for batch in batches:
                    found = [shared.value.leaks(t) for t in batch[content]]
                    more = {"leaked_items": [list(a) + list(f) for a, f in zip(batch.leaked_items, found, strict=True)],
                            "leaked_shares": [list(a) + list(f.values()) for a, f in zip(batch.leaked_shares, found, strict=True)]}
                    yield batch.assign(**more)
                release()

            result = result.mapInPandas(judge, result.schema)
    return result.drop(content)


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that leak no benchmark item, unchanged."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # whatever the columns are called
    plain = docs.toDF(*names)
    kept = find_leaks(plain, benchmark, *names, text=names[docs.columns.index(text)]).where(F.size("leaked_items") == 0)
    return kept.select(*names).toDF(*docs.columns)
