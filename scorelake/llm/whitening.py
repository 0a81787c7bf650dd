"""Whitening of integer vectors by eigenvectors refined in mixed precision.

Spark adds up the sums and the second moments of the distinct vectors; only these (one vector
and one square matrix per vector length) reach the driver. Moments are taken about the whole
number next to the mean and are exact integers, so the covariance has no rounding but its
last one. Its eigenvectors are found in float32 and corrected by iterations of matrix products
in extended precision (Ogita and Aishima); where eigenvalues lie too close for the iteration
to part them, the eigenvectors of the small matrix between the vectors of such a cluster,
shifted by its middle, turn them into place. Vectors are projected in batches, in Spark.

Rules: rows whose vector is null or holds null or non-finite entries have no result; vectors of
different lengths are whitened apart, each length with its own n; empty vectors have no
component and so no row. Repeated rows count once in the fit and each get their result; null
and repeated ids are kept. A component whose variance is zero (to double precision of the
largest) cannot be scaled: its ``whitened`` is null and it takes no part in ``identity_error``. An empty
table gives no rows. Entries beyond 2**40 about the mean are rounded to 40 leading bits of the largest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.llm.common import stored

_LIMB = 20  # products of two limbs, added over _ROWS rows, stay exact in float64
_ROWS = 4096
_FLUSH = 1 << 20  # rows whose limb products still add up within int64
_WIDEST = 40
_ROUNDS = 30


@dataclass
class Fit:
    """The whitening of one vector length: n, exact sums, components (columns) and their eigenvalues."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Components whose variance is more than rounding."""
        largest = self.values.max(initial=0.0)
        return self.values > largest * len(self.sums) * np.finfo(np.float64).eps


def scaled_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x, the longs floor(256 * c) of every vector without null or non-finite entries."""
    finite = F.forall(F.col(embedding), lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    kept = vectors.where(F.col(embedding).isNotNull() & F.coalesce(finite, F.lit(False)))
    return kept.select(F.col(vec_id).alias("vec_id"), F.transform(F.col(embedding), lambda c: F.floor(F.lit(256.0) * c.cast("double"))).alias("x"))


def refine(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors (columns) of a symmetric matrix, to double precision.

    Starts from float32 eigenvectors. A round measures how far the vectors are from
    orthogonal (R = I - X'X) and from diagonalising (S = X'AX), and corrects every pair whose
    eigenvalues differ by more than the remaining error; pairs that do not are a cluster,
    made orthogonal by the round and parted by a sub-solve.
    """
    a = np.asarray(matrix, np.longdouble)
    size = len(a)
    scale = np.abs(a).max(initial=0)
    if not size or scale == 0:
        return np.zeros(size), np.eye(size)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one = np.eye(size, dtype=np.longdouble)
    noise = np.finfo(np.longdouble).eps * 4 * _norm(a)
    best, least = x, np.inf
    for _ in range(_ROUNDS):
        rest = one - x.T @ x
        inside = x.T @ (a @ x)
        values = np.diag(inside) / (1 - np.diag(rest))
        wrong = inside + values[None, :] * rest
        np.fill_diagonal(wrong, 0)
        left = max(np.abs(rest).max(), np.abs(wrong).max())
        if left < least:
            best, least, behind = x, left, 0
        else:
            behind += 1
        if left <= noise or behind > 2:
            break
        off = inside - np.diag(np.diag(inside))
        error = 2 * (_norm(off) + _norm(a) * _norm(rest)) + noise
        apart = values[None, :] - values[:, None]
        far = np.abs(apart) > error
        change = np.where(far, wrong / np.where(far, apart, 1), rest / 2)
        x = x + x @ change
        for cluster in _clusters(values, error):
            some = x[:, cluster]
            middle = values[cluster].mean()
            small = some.T @ (a @ some - middle * some)
            small = (small + small.T) / 2
            width = np.abs(small).max()
            if width > noise:
                turn = np.linalg.eigh((small / width).astype(np.float64))[1].astype(np.longdouble)
                x[:, cluster] = some @ turn
    x = best
    for _ in range(2):  # the nearest orthogonal vectors: what is left of second order in close pairs
        x = x + x @ (one - x.T @ x) / 2
    values = np.diag(x.T @ (a @ x)) / np.diag(x.T @ x)
    order = np.argsort(-values, kind="stable")
    x = x[:, order] / np.sqrt((x[:, order] ** 2).sum(0))
    sign = np.where(x[np.abs(x).argmax(0), np.arange(size)] < 0, -1, 1)
    return (values[order] * scale).astype(np.float64), (x * sign).astype(np.float64)


def _norm(matrix: np.ndarray) -> np.longdouble:
    """A bound of the spectral norm of a symmetric matrix."""
    return np.abs(matrix).sum(0).max(initial=np.longdouble(0))


def _clusters(values: np.ndarray, error: np.longdouble) -> list[np.ndarray]:
    """Runs of at least two eigenvalues that follow each other within the error."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > error) + 1
    return [np.sort(run) for run in np.split(order, cuts) if len(run) > 1]


def _by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, matrix) for every vector length of a batch."""
    lengths = np.diff(column.offsets.to_numpy())
    flat, starts = column.values.to_numpy(), column.offsets.to_numpy()[:-1]
    for d in np.unique(lengths[lengths > 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        for cut in range(0, len(rows), _ROWS):
            some = rows[cut : cut + _ROWS]
            yield d, some, flat[starts[some][:, None] + np.arange(d)]


def _sums(spark_vectors: DataFrame) -> dict[int, tuple[int, list[int], int]]:
    """Per vector length: n, the exact sum of every entry, and the largest distance from entry to entry."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _by_length(batch.column(0)):
                low = (x & 0xFFFFFFFF).sum(0)  # halves, so that no sum leaves the long range
                high = (x >> 32).sum(0)
                yield pa.RecordBatch.from_pydict(
                    {"d": [d] * d, "at": list(range(d)), "rows": [len(rows)] * d, "high": high, "low": low, "least": x.min(0), "most": x.max(0)},
                    schema=pa.schema([("d", pa.int32()), ("at", pa.int32())] + [(c, pa.int64()) for c in ("rows", "high", "low", "least", "most")]),
                )

    parts = spark_vectors.select("x").mapInArrow(add, "d int, at int, rows long, high long, low long, least long, most long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = parts.groupBy("d", "at").agg(F.sum("rows").alias("rows"), whole("high"), whole("low"), F.min("least").alias("least"), F.max("most").alias("most"))
    result: dict[int, tuple[int, list[int], int]] = {}
    for r in found.orderBy("d", "at").collect():  # one row per vector entry
        n, sums, widest = result.get(r.d, (r.rows, [], 0))
        result[r.d] = (n, [*sums, (int(r.high) << 32) + int(r.low)], max(widest, r.most - r.least))
    return result


def _moments(fit_list: DataFrame, sums: dict[int, tuple[int, list[int], int]]) -> dict[int, np.ndarray]:
    """Per vector length the exact covariance, as extended floats."""
    centre = {d: [round(Fraction(s, n)) for s in total] for d, (n, total, _) in sums.items()}
    shift = {d: max(0, widest.bit_length() + 1 - _WIDEST) for d, (_, _, widest) in sums.items()}

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        rows_in: dict[int, int] = {}
        schema = pa.schema([("d", pa.int32()), ("power", pa.int32()), ("at", pa.int32()), ("line", pa.list_(pa.int64()))])

        def flush(d: int) -> Iterator[pa.RecordBatch]:
            for limb, gram in enumerate(held.pop(d)):
                if gram.any():
                    yield pa.RecordBatch.from_pydict({"d": [d] * d, "power": [limb * _LIMB] * d, "at": list(range(d)), "line": list(gram)}, schema=schema)
            rows_in[d] = 0

        for batch in batches:
            for d, rows, x in _by_length(batch.column(0)):
                if shift[d]:
                    middle = np.array(centre[d], dtype=object)
                    y = np.array([[(int(v) + (1 << shift[d] >> 1)) >> shift[d] for v in line] for line in x.astype(object) - middle], dtype=np.int64)
                else:
                    y = x - np.array(centre[d], dtype=np.int64)
                high = (y >> _LIMB).astype(np.float64)
                low = (y & ((1 << _LIMB) - 1)).astype(np.float64)
                grams = [low.T @ low, high.T @ low, high.T @ high]
                grams[1] = grams[1] + grams[1].T
                whole = [g.astype(np.int64) for g in grams]
                held[d] = [a + b for a, b in zip(held[d], whole, strict=True)] if d in held else whole
                rows_in[d] = rows_in.get(d, 0) + len(rows)
                if rows_in[d] >= _FLUSH:
                    yield from flush(d)
        for d in list(held):
            yield from flush(d)

    parts = fit_list.select("x").mapInArrow(multiply, "d int, power int, at int, line array<bigint>")
    cells = parts.select("d", "power", "at", F.posexplode("line").alias("other", "value"))
    added = cells.groupBy("d", "power", "at", "other").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    grams = {d: np.zeros((d, d), dtype=object) for d in sums}
    for r in added.toLocalIterator():  # the square matrix of a vector length, at most three parts
        grams[r.d][r.at, r.other] += int(r.value) << r.power
    result = {}
    for d, (n, total, _) in sums.items():
        left = np.array([s - n * c for s, c in zip(total, centre[d], strict=True)], dtype=object)  # the mean's distance from the centre, times n
        if shift[d]:
            exact = grams[d] * n << (2 * shift[d])  # entries were rounded: the distance of the mean, below 1, is lost in that
        else:
            exact = grams[d] * n - left[:, None] * left[None, :]
        result[d] = np.array([[_quotient(int(v), n * n) for v in line] for line in exact], dtype=np.longdouble)
    return result


def _quotient(over: int, under: int) -> np.longdouble:
    """The quotient of two integers, to more than double precision."""
    first = over / under if abs(over).bit_length() < 1000 else float(Fraction(over, under))
    rest = Fraction(over, under) - Fraction(first)
    return np.longdouble(first) + np.longdouble(float(rest))


def fit(fit_list: DataFrame, components: int) -> dict[int, Fit]:
    """The whitening of every vector length in the column x of a table of distinct vectors."""
    sums = _sums(fit_list)
    found = {}
    for d, covariance in _moments(fit_list, sums).items():
        values, vectors = refine(covariance)
        n, total, _ = sums[d]
        found[d] = Fit(n, total, vectors[:, :components], values[:components], float(np.trace(covariance)))
    return found


def _projected(known: Fit, x: np.ndarray) -> np.ndarray:
    """Vectors less their mean, on the components, over the square roots of the eigenvalues (NaN where zero)."""
    centre = [round(Fraction(s, known.n)) for s in known.sums]
    rest = np.array([float(Fraction(s, known.n) - c) for s, c in zip(known.sums, centre, strict=True)])
    around = (x - np.array(centre, dtype=np.int64)).astype(np.float64) - rest
    with np.errstate(divide="ignore", invalid="ignore"):
        return (around @ known.vectors) / np.where(known.usable, np.sqrt(known.values.clip(0)), np.nan)


def _identity_errors(fit_list: DataFrame, fits: dict[int, Fit]) -> dict[int, float | None]:
    """Per vector length the largest absolute entry of the whitened fit list's covariance minus the identity."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("d", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("square", pa.list_(pa.float64()))])
        held: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for d, rows, x in _by_length(batch.column(0)):
                z = _projected(fits[d], x)[:, fits[d].usable]
                mean = z.mean(0)
                part = (len(rows), mean, (z - mean).T @ (z - mean))
                held[d] = _joined(held[d], part) if d in held else part
        for d, (n, mean, square) in held.items():
            yield pa.RecordBatch.from_pydict({"d": [d], "n": [n], "mean": [mean], "square": [square.ravel()]}, schema=schema)

    parts = fit_list.select("x").mapInArrow(spread, "d int, n long, mean array<double>, square array<double>")
    whole: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for r in parts.orderBy("d", "n", "mean").toLocalIterator():  # one small row per partition and vector length
        k = len(r["mean"])
        part = (r.n, np.array(r["mean"]), np.array(r.square).reshape(k, k))
        whole[r.d] = _joined(whole[r.d], part) if r.d in whole else part
    return {d: float(np.abs(square / n - np.eye(len(mean))).max(initial=0.0)) if len(mean) else None for d, (n, mean, square) in whole.items()}


def _joined(one: tuple, other: tuple) -> tuple[int, np.ndarray, np.ndarray]:
    """Count, mean and centred products of two parts together."""
    (n, mean, square), (m, mean2, square2) = one, other
    gap = mean2 - mean
    return n + m, mean + gap * (m / (n + m)), square + square2 + np.outer(gap, gap) * (n * m / (n + m))


def _deviations(known: Fit, x: np.ndarray) -> list[int | None]:
    """The sum over entries of (n * x - S) ** 2, exact; null where it is no long."""
    n, sums = known.n, known.sums
    if n * int(np.abs(x).max(initial=0)) + max(map(abs, sums), default=0) < 1 << 31 and len(sums) < 1 << 20:
        apart = n * x - np.array(sums, dtype=np.int64)
        if int(np.abs(apart).max(initial=0)) ** 2 * len(sums) < 1 << 63:
            return (apart * apart).sum(1).tolist()
    found = []
    for line in x.tolist():
        total = sum((n * v - s) ** 2 for v, s in zip(line, sums, strict=True))
        found.append(total if total < 1 << 63 else None)
    return found


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error for every row of ``scaled_vectors``.

    Components are numbered from 1 by falling eigenvalue, at most as many as a vector has entries.
    """
    fit_list = stored(vectors.select("x").distinct(), "whitening-fit")
    fits = fit(fit_list, components)
    errors = _identity_errors(fit_list, fits)
    output = vectors.select(
        "vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("deviation"),
        F.lit(None).cast("double").alias("whitened"), F.lit(None).cast("double").alias("explained"), F.lit(None).cast("double").alias("identity_error"),
    ).schema

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, rows, x in _by_length(batch.column(1)):
                known = fits[d]
                z = _projected(known, x)
                k = z.shape[1]
                repeat = np.repeat(np.arange(len(rows)), k)
                flat = z.ravel()
                share = known.values / known.trace if known.trace > 0 else np.full(k, np.nan)
                shares = np.tile(share, len(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(rows[repeat])),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                        pa.array(np.full(len(flat), known.n, np.int64)),
                        pa.array(_deviations(known, x), pa.int64()).take(pa.array(repeat)),
                        pa.array(flat, mask=np.isnan(flat)),
                        pa.array(shares, mask=np.isnan(shares)),
                        pa.array([errors[d]] * len(flat), pa.float64()),
                    ],
                    names=output.fieldNames(),
                )

    return vectors.mapInArrow(project, output)
