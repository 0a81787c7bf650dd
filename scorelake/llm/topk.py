"""Exact top-k inner products by block-at-a-time pruning.

A component of an integer vector is a term with a weight. Candidates are cut into blocks of
neighbouring ids; a block keeps, for every component, its largest and smallest weight and a
forward index (the block's matrix). The bound of a block for a query is the sum of each
component's best product. A task holds one range of blocks and one batch of queries, visits
blocks by falling bound and stops for a query once the bound is below its k-th score (an
equal bound is still scored, since ties go to smaller ids). The k best of each range meet in
one merge per query.

Ranges and batches have fixed sizes, so a task's memory does not grow with the table; each
range is sent to every batch in blocks, as the stated query set asks. A sweep of each query
over its own range first gives a k-th score to start from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import stored

BLOCK = 256
RANGE_ROWS = 8192
QUERY_ROWS = 1024
_LONG = (-(2**63), 2**63 - 1)


def integer_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and v, the array of floor(256 * x); rows that are null, empty of an id, or hold null or non-finite components are left out."""
    finite = F.forall(F.col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    kept = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False)))
    scaled = F.transform(F.col(embedding), lambda x: F.floor(F.lit(256.0) * x.cast("double")).cast("double"))
    return kept.select(F.col(vec_id).cast("long").alias("vec_id"), scaled.alias("v"))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


def _products(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Exact integer products as float64 below 2**53, else as Python integers held within the long range."""
    if queries.size == 0 or np.abs(queries).max() * np.abs(block).max() * block.shape[1] < 2**53:
        return queries @ block.T
    exact = np.array([[int(x) for x in q] for q in queries], dtype=object) @ np.array([[int(x) for x in b] for b in block], dtype=object).T
    return np.vectorize(lambda x: min(max(x, _LONG[0]), _LONG[1]), otypes=[object])(exact)


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by score, ties to the smaller id."""
    if len(ids) > 4 * k and scores.dtype != object:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
        return near[np.lexsort((ids[near], -scores[near]))[:k]]
    order = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))
    return np.array(order[:k], dtype=int)


def _sweep(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> Iterator[tuple]:
    """(query row, vec_id, score) of the k best in the range, for each query."""
    rows = rows.sort_values(["vec_id", "uid"], kind="stable")
    ids, uids, vectors = rows.vec_id.to_numpy(), rows.uid.to_numpy(), _matrix(rows.v)
    cuts = range(0, len(ids), BLOCK)
    top = np.stack([vectors[c : c + BLOCK].max(0) for c in cuts])
    low = np.stack([vectors[c : c + BLOCK].min(0) for c in cuts])
    asked = _matrix(queries.v)
    slack = 1e-9  # of the float sums in a bound
    bounds = np.maximum(asked, 0) @ top.T + np.minimum(asked, 0) @ low.T
    bounds = bounds + slack * (np.abs(asked) @ np.maximum(np.abs(top), np.abs(low)).T)
    order = np.argsort(-bounds, axis=1, kind="stable")
    kth = queries.floor.to_numpy(dtype=float, na_value=-np.inf)
    found: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, object), np.zeros(0, np.int64)) for _ in range(len(asked))]
    alive = np.arange(len(asked))
    for step in range(len(top)):
        alive = alive[bounds[alive, order[alive, step]] >= kth[alive]]
        if not len(alive):
            break
        at = order[alive, step]
        for b in np.unique(at):
            who = alive[at == b]
            cut = slice(b * BLOCK, (b + 1) * BLOCK)
            scores = _products(asked[who], vectors[cut])
            for q, line in zip(who, scores, strict=True):
                mine = uids[cut] != queries.uid.iat[q]
                s = np.concatenate([found[q][0], line[mine]])
                i = np.concatenate([found[q][1], ids[cut][mine]])
                s = s if scores.dtype == object else s.astype(float)
                keep = _best(s, i, k)
                found[q] = (s[keep], i[keep])
                if len(keep) == k:
                    kth[q] = max(kth[q], float(s[keep][-1]))
    for q, (s, i) in enumerate(found):
        for score, vec in zip(s, i, strict=True):
            yield queries.uid.iat[q], queries.query_id.iat[q], int(vec), int(score)


def top_k(vectors: DataFrame, is_query: object, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the k best other rows by integer inner product for every row of ``vectors`` where ``is_query`` holds.

    vectors has vec_id and v (see ``integer_vectors``). Only vectors of equal length meet.
    Rows that repeat an id are rows of their own: each repeated query row gets its own
    answer and may find its twin. Fewer than k candidates give fewer rows, an empty table
    none. Scores beyond the long range are held at its ends.
    """
    spark = vectors.sparkSession
    numbered = stored(
        vectors.select("vec_id", "v", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("uid"), is_query.alias("asked")),
        "topk-rows",
    )
    dims = numbered.groupBy("dim").count()
    sizes = {d: n for d, n in dims.collect()}  # one row per vector length
    ranges = spark.createDataFrame([(d, -(-n // RANGE_ROWS)) for d, n in sizes.items()], "dim int, ranges int")
    # uid order follows the stored rows, so a range is a run of neighbours within one partition or a part of it
    with_range = numbered.join(F.broadcast(ranges), "dim").withColumn("range", F.pmod(F.xxhash64(F.shiftright("uid", 8)), F.col("ranges")).cast("int"))
    queries = with_range.where("asked").select(
        F.col("vec_id").alias("query_id"), "v", "dim", "uid", "range", "ranges", F.pmod(F.xxhash64("uid", F.lit(7)), F.greatest(F.lit(1), F.ceil(F.col("ranges") * RANGE_ROWS / 50 / QUERY_ROWS))).cast("int").alias("batch")
    )
    output = "query_uid long, query_id long, vec_id long, score long"

    def swept(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_uid", "query_id", "vec_id", "score")})
        right = right.rename(columns=lambda c: c.removeprefix("c_"))
        return pd.DataFrame(list(_sweep(left, right, k)), columns=["query_uid", "query_id", "vec_id", "score"])

    candidates = with_range.select(*[F.col(c).alias(f"c_{c}") for c in ("dim", "range", "uid", "vec_id", "v")])
    home = queries.withColumn("floor", F.lit(None).cast("double")).groupBy("dim", "range").cogroup(candidates.groupBy("c_dim", "c_range")).applyInPandas(swept, output)
    first = stored(home, "topk-home")
    floors = first.groupBy(F.col("query_uid").alias("uid")).agg(F.min("score").cast("double").alias("least"), F.count("*").alias("n"))
    floors = floors.select("uid", F.when(F.col("n") >= k, F.col("least")).alias("floor"))
    others = F.explode(F.filter(F.sequence(F.lit(0), F.col("ranges") - 1), lambda r: r != F.col("range")))
    away = queries.join(floors, "uid", "left").select("query_id", "v", "dim", "uid", "batch", "floor", others.alias("range"))
    batches = queries.select(F.col("dim").alias("c_dim"), F.col("batch").alias("c_batch")).distinct()
    sent = candidates.join(batches, "c_dim")
    rest = away.groupBy("dim", "range", "batch").cogroup(sent.groupBy("c_dim", "c_range", "c_batch")).applyInPandas(swept, output)
    place = Window.partitionBy("query_uid").orderBy(F.desc("score"), "vec_id")
    return first.unionByName(rest).withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
