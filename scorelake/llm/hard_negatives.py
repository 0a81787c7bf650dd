"""Hard negatives by exact inner products, pruned by length and by coordinate.

Candidates are sorted by label and falling length and cut into ranges. A range's longest
vector and its smallest and largest value of each coordinate bound what an anchor can score
there; these bounds travel first, and an anchor visits only the ranges that can reach the
score it already has. Within a range, vectors lie in buckets of falling length. A bucket
whose longest vector cannot reach the score ends the visit; else, with t the cosine still
needed there, a candidate's value of a coordinate f lies within arccos t of the anchor's as
an angle, so each focus coordinate (the anchor's largest) gives a run of the bucket's sorted
list of that coordinate. The runs are intersected, and what is left is scored exactly.

Two searches follow each other: an anchor's positives (same label, first k), then for every
positive the first rows of other labels whose score lies in its window. Each search first
visits one range per anchor, which gives a score to start from.

A task holds one range at a time and reads its visitors in batches, so memory depends on
the size of a range alone. Ranges are cut by rows, not by keys: a hot label, length or vector fills
more ranges, not larger ones.

Rules: rows with a null id or label, and vectors that are null or hold null or non-finite entries, take
no part; only vectors of equal length meet. Rows that repeat an id are rows of their own: a repeated
anchor row has its own answers, and may find its twin. Fewer matches give fewer rows, an empty table none.
Products beyond the long range are held at its ends.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import default_partitions, stored
from scorelake.llm.whitening import scaled_vectors

RANGE_CELLS = 1 << 20  # vector entries in a range, at most
LEAST_CELLS = 1 << 16
BUCKET = 1024
FOCUS = 4
CHUNK = 4096  # bounds of ranges that one task compares with anchors
VISITORS = 100_000  # anchors that meet one chunk of bounds in a task
_SLACK = 1e-9
_LONG = 1 << 63
_ROW = (1 << 33) - 1


def labelled_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: Column | str = "label") -> DataFrame:
    """vec_id, label and x (longs floor(256 * c)) of the rows that take part."""
    label = F.col(label) if isinstance(label, str) else label
    kept = vectors.select(F.struct(F.col(vec_id).cast("long").alias("i"), label.cast("long").alias("l")).alias("row"), F.col(embedding).alias("embedding"))
    return scaled_vectors(kept, "row").select(F.col("vec_id.i").alias("vec_id"), F.col("vec_id.l").alias("label"), "x").where("vec_id IS NOT NULL AND label IS NOT NULL")


class Index:
    """The vectors of one range and length: buckets of falling length with sorted coordinate lists."""

    def __init__(self, ids: np.ndarray, uids: np.ndarray, labels: np.ndarray, x: np.ndarray):
        length = np.sqrt((x.astype(np.float64) ** 2).sum(1))
        order = np.argsort(-length, kind="stable")
        self.ids, self.uids, self.labels, self.x = ids[order], uids[order], labels[order], x[order]
        self.length = length[order]
        self.plain = self.x.astype(np.float64)
        self.largest = int(np.abs(self.plain).max(initial=0))
        self.lists: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def _sorted(self, bucket: int, f: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a bucket by their value of a coordinate, as unit vectors, and these values."""
        if (bucket, f) not in self.lists:
            cut = slice(bucket * BUCKET, (bucket + 1) * BUCKET)
            values = self.plain[cut, f] / np.maximum(self.length[cut], 1e-300)
            order = np.argsort(values, kind="stable")
            self.lists[bucket, f] = (order, values[order])
        return self.lists[bucket, f]

    def _feasible(self, bucket: int, unit: np.ndarray, focus: np.ndarray, needed: float) -> np.ndarray | None:
        """Rows of a bucket that every focus coordinate allows; None where that is most of them."""
        width = math.acos(min(1.0, needed))
        runs = []
        for f in focus.tolist():
            own = math.acos(max(-1.0, min(1.0, float(unit[f]))))
            order, values = self._sorted(bucket, f)
            first = np.searchsorted(values, math.cos(min(math.pi, own + width)) - _SLACK)
            last = np.searchsorted(values, math.cos(max(0.0, own - width)) + _SLACK, "right")
            runs.append(order[first:last])
        runs.sort(key=len)
        size = min(BUCKET, len(self.ids) - bucket * BUCKET)
        if len(runs[0]) * 2 > size:
            return None
        seen = np.zeros(size, np.int8)
        for run in runs:
            seen[run] += 1
        return np.flatnonzero(seen == len(runs))

    def visit(self, query: np.ndarray, least: Callable[[], float]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, exact scores) of every bucket, without rows that cannot reach ``least``, asked again for each bucket."""
        plain = query.astype(np.float64)
        own = float(np.sqrt((plain**2).sum()))
        unit = plain / own if own else plain
        focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        exact = int(np.abs(plain).max(initial=0)) * self.largest * len(plain) < 1 << 53
        for bucket in range(-(-len(self.ids) // BUCKET)):
            start = bucket * BUCKET
            rows = np.arange(start, min(start + BUCKET, len(self.ids)))
            floor = least()
            if floor > 0:
                reach = own * self.length[start] * (1 + _SLACK)
                if reach < floor:
                    return
                some = self._feasible(bucket, unit, focus, floor / reach)
                rows = rows if some is None else start + some
            if exact:
                yield rows, (self.plain[rows] @ plain).astype(np.int64)
            else:
                numbers = [int(v) for v in query]
                yield rows, np.array([max(-_LONG, min(_LONG - 1, sum(a * int(b) for a, b in zip(numbers, self.x[r].tolist(), strict=True)))) for r in rows], dtype=np.int64)


def _first_positives(index: Index, anchor: dict, k: int) -> Iterator[tuple]:
    """(uid, id, score) of the first k other rows of the anchor's label."""
    floor = -math.inf if anchor["floor"] is None else anchor["floor"]
    scores, ids, uids = (np.zeros(0, np.int64) for _ in range(3))

    def least() -> float:
        return max(floor, scores[-1]) if len(scores) == k else floor

    for rows, found in index.visit(anchor["x"], least):
        mine = (index.labels[rows] == anchor["label"]) & (index.uids[rows] != anchor["uid"]) & (found >= least())
        scores, ids, uids = (np.concatenate(p) for p in ((scores, found[mine]), (ids, index.ids[rows][mine]), (uids, index.uids[rows][mine])))
        best = np.lexsort((uids, ids, ~scores))[:k]  # ~s falls as s rises, without overflow
        scores, ids, uids = scores[best], ids[best], uids[best]
    yield from zip(uids.tolist(), ids.tolist(), scores.tolist(), strict=True)


def _first_negatives(index: Index, anchor: dict, k: int) -> Iterator[tuple]:
    """(window, uid, id, score) of the first k rows of other labels in each of the anchor's windows."""
    windows = anchor["windows"]  # lowest and highest score allowed, and a floor already reached
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [tuple(np.zeros(0, np.int64) for _ in range(3)) for _ in windows]
    floors = [max(low, -_LONG if reached is None else reached) for low, _, reached in windows]

    def least() -> float:
        return min(floors)

    for rows, scores in index.visit(anchor["x"], least):
        other = np.flatnonzero((index.labels[rows] != anchor["label"]) & (scores >= least()))
        order = other[np.lexsort((index.uids[rows][other], index.ids[rows][other], ~scores[other]))]
        rows, scores = rows[order], scores[order]
        for w, (_, high, _) in enumerate(windows):
            first = int(np.searchsorted(~scores, ~high))
            last = int(np.searchsorted(~scores, ~floors[w], "right"))
            some = slice(first, max(first, min(last, first + k)))
            if some.start == some.stop:
                continue
            s, i, u = (np.concatenate(p) for p in zip(found[w], (scores[some], index.ids[rows[some]], index.uids[rows[some]]), strict=True))
            best = np.lexsort((u, i, ~s))[:k]
            found[w] = (s[best], i[best], u[best])
            if len(best) == k:
                floors[w] = max(floors[w], int(s[best][-1]))
    for w, (s, i, u) in enumerate(found):
        yield from zip([w] * len(s), u.tolist(), i.tolist(), s.tolist(), strict=True)


_CARRIED = "range long, kind int, uid long, vec_id long, label long, x array<bigint>, floor long, windows array<struct<low:bigint,high:bigint,reached:bigint>>"


def _met(candidates: DataFrame, visitors: DataFrame, work: Callable[[Index, dict], Iterator[tuple]], parts: int) -> DataFrame:
    """uid and window of every visitor with the uid, id and score of what it finds in the range it visits.

    Within a partition rows are sorted by range, candidates before visitors: a task holds one
    range and lets its visitors pass.
    """
    both = candidates.selectExpr(
        "range", "0 AS kind", "uid", "vec_id", "label", "x", "CAST(NULL AS long) AS floor", "CAST(NULL AS array<struct<low:bigint,high:bigint,reached:bigint>>) AS windows"
    ).unionByName(visitors.selectExpr("range", "1 AS kind", "uid", "vec_id", "label", "x", "floor", "windows"))
    names = ["uid", "window", "found_uid", "found_id", "score"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: int | None = None
        held: list[pa.RecordBatch] = []
        indexes: dict[int, Index] | None = None
        for batch in batches:
            ranges, kinds = (batch.column(c).to_numpy() for c in (0, 1))
            cuts = np.flatnonzero(np.diff(ranges) | np.diff(kinds)) + 1
            for first, last in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ranges)], strict=True):
                if first == last:
                    continue
                some = batch.slice(first, last - first)
                if kinds[first] == 0:
                    if ranges[first] != at:
                        at, held, indexes = ranges[first], [], None
                    held.append(some)
                    continue
                if ranges[first] != at:
                    continue
                if indexes is None:
                    indexes, held = _indexes(held), []
                result: list[tuple] = []
                for visitor in _visitors(some):
                    index = indexes.get(len(visitor["x"]))
                    if index is not None:
                        result += ((visitor["uid"], *found) for found in work(index, visitor))
                columns = list(zip(*result, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=names)

    return both.repartition(parts, "range").sortWithinPartitions("range", "kind").mapInArrow(meet, "uid long, window int, found_uid long, found_id long, score long")


def _indexes(batches: list[pa.RecordBatch]) -> dict[int, Index]:
    """The index of a range for every vector length in it."""
    columns = pa.Table.from_batches(batches).combine_chunks()
    uids, ids, labels = (columns[c].to_numpy() for c in ("uid", "vec_id", "label"))
    x = columns["x"].combine_chunks()
    offsets, flat = x.offsets.to_numpy(), x.values.to_numpy()
    lengths = np.diff(offsets)
    found = {}
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        found[d] = Index(ids[rows], uids[rows], labels[rows], flat[offsets[rows][:, None] + np.arange(d)])
    return found


def _visitors(batch: pa.RecordBatch) -> Iterator[dict]:
    """The visitors of a batch, with their windows as tuples."""
    columns = {c: batch.column(i) for i, c in enumerate(batch.schema.names)}
    uids, labels, floors, windows = (columns[c].to_pylist() for c in ("uid", "label", "floor", "windows"))
    offsets, flat = columns["x"].offsets.to_numpy(), columns["x"].values.to_numpy()
    for i, uid in enumerate(uids):
        own = [(w["low"], w["high"], w["reached"]) for w in windows[i]] if windows[i] else []
        yield {"uid": uid, "label": labels[i], "x": flat[offsets[i] : offsets[i + 1]], "floor": floors[i], "windows": own}


def _bounds(candidates: DataFrame) -> DataFrame:
    """Per range and vector length: the longest vector, the smallest and largest label and entries.

    A range that two tasks read gives two rows, each right for its own vectors.
    """
    names = ["range", "d", "longest", "label_low", "label_high", "low", "high"]

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}
        for batch in batches:
            ranges, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            offsets, flat = batch.column(2).offsets.to_numpy(), batch.column(2).values.to_numpy()
            lengths = np.diff(offsets)
            for r, d in sorted(set(zip(ranges.tolist(), lengths.tolist(), strict=True))):
                rows = np.flatnonzero((ranges == r) & (lengths == d))
                x = flat[offsets[rows][:, None] + np.arange(d)]
                part = [float(np.sqrt((x.astype(np.float64) ** 2).sum(1).max())), labels[rows].min(), labels[rows].max(), x.min(0), x.max(0)]
                if (r, d) in held:
                    old = held[r, d]
                    part = [max(old[0], part[0]), min(old[1], part[1]), max(old[2], part[2]), np.minimum(old[3], part[3]), np.maximum(old[4], part[4])]
                held[r, d] = part
        for (r, d), part in held.items():
            yield pa.RecordBatch.from_pydict(dict(zip(names, [[r], [d], *[[p] for p in part]], strict=True)), schema=schema)

    schema = pa.schema([("range", pa.int64()), ("d", pa.int32()), ("longest", pa.float64()), ("label_low", pa.int64()), ("label_high", pa.int64()), ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))])
    return candidates.select("range", "label", "x").mapInArrow(bound, "range long, d int, longest double, label_low long, label_high long, low array<bigint>, high array<bigint>")


def _open_ranges(bounds: DataFrame, anchors: DataFrame, least: Column, same: bool, done: str) -> DataFrame:
    """A row per anchor and range it still has to visit: the bound of the range reaches ``least`` (null: any).

    Bounds come in chunks and anchors in batches, so neither meets the other whole.
    """
    chunks = max(1, -(-bounds.count() // CHUNK))
    batches = max(1, -(-anchors.count() // VISITORS))
    kept = [c for c in anchors.columns if c != "range"]
    carried = [F.col(c) for c in kept]
    left = bounds.select(
        F.pmod(F.xxhash64("range"), F.lit(chunks)).alias("chunk"), F.explode(F.sequence(F.lit(0), F.lit(batches - 1))).alias("batch"), F.lit(0).alias("kind"), "range", "d", "longest",
        "label_low", "label_high", "low", "high", F.lit(None).cast("double").alias("least"), F.lit(None).cast("long").alias("done"), F.lit(None).cast(anchors.select(F.struct(*carried)).schema[0].dataType).alias("anchor"),
    )
    right = anchors.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(chunks - 1).cast("long"))).alias("chunk"), F.pmod(F.xxhash64("uid"), F.lit(batches)).cast("int").alias("batch"), F.lit(1).alias("kind"),
        F.lit(None).cast("long").alias("range"), F.size("x").alias("d"), F.lit(None).cast("double").alias("longest"), F.col("label").alias("label_low"), F.col("label").alias("label_high"),
        F.col("x").alias("low"), F.lit(None).cast("array<bigint>").alias("high"), least.cast("double").alias("least"), F.col(done).alias("done"), F.struct(*carried).alias("anchor"),
    )
    output = anchors.select(F.lit(0).cast("long").alias("range"), F.struct(*carried).alias("anchor")).schema

    def select(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key: tuple | None = None
        tops: dict[int, list] = {}
        for batch in batches:
            kinds = batch.column(2).to_pylist()
            keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            cols = {c: batch.column(i).to_pylist() for i, c in enumerate(batch.schema.names) if c in ("range", "d", "longest", "label_low", "label_high", "least", "done")}
            low, high = batch.column(batch.schema.get_field_index("low")), batch.column(batch.schema.get_field_index("high"))
            rows, ranges = [], []
            for i, kind in enumerate(kinds):
                if keys[i] != key:
                    key, tops = keys[i], {}
                if kind == 0:
                    tops.setdefault(cols["d"][i], []).append((cols["range"][i], cols["longest"][i], cols["label_low"][i], cols["label_high"][i], low[i].values.to_numpy(), high[i].values.to_numpy()))
                    continue
                mine = tops.get(cols["d"][i])
                if not mine:
                    continue
                if isinstance(mine, list):
                    mine = tops[cols["d"][i]] = tuple(np.array([m[k] for m in mine]) for k in range(6))
                where, longest, label_low, label_high, least_x, most_x = mine
                q = low[i].values.to_numpy().astype(np.float64)
                label = cols["label_low"][i]
                open_ = (label_low <= label) & (label <= label_high) if same else (label_low != label) | (label_high != label)
                if cols["least"][i] is not None:
                    each = np.maximum(q, 0) @ most_x.T.astype(np.float64) + np.minimum(q, 0) @ least_x.T.astype(np.float64)
                    size = np.sqrt((q**2).sum()) * longest
                    open_ &= np.minimum(each, size) + _SLACK * size >= cols["least"][i]
                if cols["done"][i] is not None:
                    open_ &= where != cols["done"][i]
                found = np.unique(where[open_])
                rows += [i] * len(found)
                ranges += found.tolist()
            for cut in range(0, len(rows), 1000):
                some = pa.array(rows[cut : cut + 1000], pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(ranges[cut : cut + 1000], pa.int64()), batch.column(batch.num_columns - 1).take(some)], names=["range", "anchor"])

    spread = left.unionByName(right).repartition(chunks * batches, "chunk", "batch").sortWithinPartitions("chunk", "batch", "kind")
    return spread.mapInArrow(select, output).select("range", "anchor.*")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the anchors of ``labelled_vectors``.

    A positive is one of the first ``positives`` other rows of the anchor's label by score, ties by
    smaller id. A negative of it is a row of another label with low * positive_score <= 100 *
    negative_score <= high * positive_score; the first ``negatives`` are returned.
    """
    spark = vectors.sparkSession
    named = vectors.select("vec_id", "label", "x", is_anchor.alias("asked"), F.size("x").alias("d"), F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double")).alias("square"))
    rows = stored(named, "negatives-rows")
    cells = rows.agg(F.sum("d")).first()[0] or 0
    width = max(rows.agg(F.max("d")).first()[0] or 1, 1)
    target = min(RANGE_CELLS, max(LEAST_CELLS, cells // (2 * default_partitions(spark))))
    each = max(1, target // width)  # rows of a range
    order = [F.col("d"), F.col("label"), F.col("square").desc(), F.col("vec_id")]
    files = max(1, -(-cells // (8 * RANGE_CELLS)))
    sorted_rows = rows.repartitionByRange(files, *order, F.rand(7)).sortWithinPartitions(*order).withColumn("uid", F.monotonically_increasing_id())
    numbered_rows = stored(sorted_rows.select("uid", "vec_id", "label", "x", F.coalesce("asked", F.lit(False)).alias("asked"), F.shiftright("uid", 33).alias("part")), "negatives-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered_rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))  # one row per written partition
    place = F.floor((F.col("offset") + F.col("uid").bitwiseAND(F.lit(_ROW))) / each)
    ranged = numbered_rows.join(F.broadcast(offsets), "part").withColumn("range", place).drop("part", "offset")
    candidates, anchors = ranged.drop("asked"), ranged.where("asked").drop("asked")
    bounds = stored(_bounds(candidates), "negatives-bounds")
    ranges = max(1, bounds.agg(F.max("range") + 1).first()[0] or 0)  # numbered without gaps
    parts = min(ranges, 8 * default_partitions(spark))
    none, no_windows = F.lit(None).cast("long"), F.lit(None).cast("array<struct<low:bigint,high:bigint,reached:bigint>>")

    def positives_of(index: Index, anchor: dict) -> Iterator[tuple]:
        return ((0, *found) for found in _first_positives(index, anchor, positives))

    def negatives_of(index: Index, anchor: dict) -> Iterator[tuple]:
        return _first_negatives(index, anchor, negatives)

    # positives: the anchor's own range, then those that can beat what it has
    home = stored(_met(candidates, anchors.withColumns({"floor": none, "windows": no_windows}), positives_of, parts), "negatives-home")
    floors = home.groupBy("uid").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).select("uid", F.when(F.col("n") >= positives, F.col("least")).alias("floor"))
    waiting = anchors.join(floors, "uid", "left").withColumns({"windows": no_windows, "home": F.col("range")})
    away = _met(candidates, _open_ranges(bounds, waiting, F.col("floor"), True, "home"), positives_of, parts)
    by_score = Window.partitionBy("uid").orderBy(F.desc("score"), "found_id", "found_uid")
    best = stored(home.unionByName(away).withColumn("place", F.row_number().over(by_score)).where(F.col("place") <= positives), "negatives-positives")

    # negatives: a range per anchor to start from, then those that can reach one of the windows
    whole = F.col("score").cast("decimal(38,0)")
    window = F.struct(
        F.ceil(whole * low / 100).cast("long").alias("low"), F.floor(whole * high / 100).cast("long").alias("high"), F.lit(None).cast("long").alias("reached"),
        F.col("place").alias("place"), F.col("found_uid").alias("positive_uid"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score"),
    )
    windows = best.withColumn("window", window).where("window.low <= window.high").groupBy("uid").agg(F.sort_array(F.collect_list("window")).alias("listed"))  # at most ``positives`` an anchor
    facing = stored(anchors.drop("range").join(windows, "uid"), "negatives-facing")
    plain = F.transform("listed", lambda w: F.struct(w["low"].alias("low"), w["high"].alias("high"), w["reached"].alias("reached")))
    start = facing.withColumn("range", F.pmod(F.xxhash64("uid"), F.lit(ranges)))
    seeded = stored(_met(candidates, start.withColumns({"floor": none, "windows": plain}), negatives_of, parts), "negatives-seeds")
    reached = seeded.groupBy("uid", "window").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= negatives)
    known = reached.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("window", "least"))).alias("known"))
    raised = F.transform("listed", lambda w, i: F.struct(w["low"].alias("low"), w["high"].alias("high"), F.try_element_at("known", i.cast("int")).alias("reached")))
    on = start.select("uid", F.col("range").alias("home"))
    ready = facing.join(known, "uid", "left").join(on, "uid").withColumns({"floor": none, "windows": raised}).drop("known", "listed")
    lowest = F.array_min(F.transform("windows", lambda w: F.greatest(w["low"], w["reached"])))
    rest = _met(candidates, _open_ranges(bounds, ready, lowest, False, "home"), negatives_of, parts)

    titles = facing.select("uid", F.col("vec_id").alias("anchor_id"), F.posexplode("listed").alias("window", "w"))
    in_window = Window.partitionBy("uid", "window").orderBy(F.desc("score"), "found_id", "found_uid")
    ranked = seeded.unionByName(rest).withColumn("rank", F.row_number().over(in_window)).where(F.col("rank") <= negatives)
    return ranked.join(titles, ["uid", "window"]).select(
        "anchor_id", F.col("w.positive_id").alias("positive_id"), "rank", F.col("found_id").alias("negative_id"), F.col("w.positive_score").alias("positive_score"), F.col("score").alias("negative_score")
    )
