"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents that belong to the same sources form a pattern; Spark adds up the words of every
pattern, and only these totals meet at the driver. Each pattern offers its words once for
nothing, a second time at cost 1 a word, a third time at cost 2 and so on, and may route them
to any of its sources; each source asks for its target. The cheapest way to fill the targets
gives every pattern a number of words: whole repetitions of all its documents and a rest.

The rest is filled with documents in the order of a seeded hash: those before the word count
is reached. What the document at the cut leaves open is filled in the same way by later
documents that fit, and so on, until a ten-thousandth of the pattern's words is open at most
or no document fits; then one more document is taken if that comes nearer. A cut is found from
a histogram of the hashes, so only the documents of one bucket are put in order.

Rules: a null text has no words; a null source is a source, the last in order; documents without any source and those
without words are never taken. Rows with equal key and text are alike, and any of them may be
taken first; all others are told apart by their hash, so reruns agree. An empty table gives no rows.
"""

from __future__ import annotations

import json
import math
from collections import deque
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorelake.llm.common import stored

WORD = r"[^\x20\x09-\x0D]+"
OPEN_SHARE = 1e-4
BUCKET_ROWS = 5000
BROADCAST_ROWS = 20_000
_PASSES = 64
_LAST = (1 << 63) - 1


def targets(sizes: list[int], weights: list[int], total: int, most: int) -> list[Fraction]:
    """The share of every source in ``total`` by weight, at most ``most`` times its size; what is over goes to the others by weight."""
    order = sorted(range(len(sizes)), key=lambda i: Fraction(most * sizes[i], weights[i]))
    left, weight = Fraction(total), sum(weights)
    found = [Fraction(0)] * len(sizes)
    for i in order:  # those that stop first come first
        found[i] = min(left * weights[i] / weight, Fraction(most * sizes[i]))
        left -= found[i]
        weight -= weights[i]
    return found


def route(patterns: list[tuple[tuple[int, ...], int]], quotas: list[int], levels: int) -> list[dict[int, int]]:
    """Words that each pattern (its sources, its words) sends to each source, filling quotas at the least repetition cost.

    The k-th repetition of a word costs k - 1. All cheapest paths use first repetitions, the
    next second ones, and so on, so each level's capacity is added in turn and the flow
    augmented along shortest paths. Patterns that share no source are independent.
    """
    flows: list[dict[int, int]] = [{} for _ in patterns]
    of_source: dict[int, list[int]] = {}
    for p, (members, _) in enumerate(patterns):
        for s in members:
            of_source.setdefault(s, []).append(p)
    seen: set[int] = set()
    for first in range(len(patterns)):
        if first in seen or not patterns[first][0]:
            continue
        group, todo, sources = [], [first], set()
        seen.add(first)
        while todo:
            p = todo.pop()
            group.append(p)
            for s in patterns[p][0]:
                if s not in sources:
                    sources.add(s)
                    new = [o for o in of_source[s] if o not in seen]
                    seen.update(new)
                    todo += new
        _augment(sorted(group), patterns, of_source, {s: quotas[s] for s in sorted(sources)}, levels, flows)
    return flows


def _augment(group: list[int], patterns: list, of_source: dict, need: dict[int, int], levels: int, flows: list[dict[int, int]]) -> None:
    spare = dict.fromkeys(group, 0)
    for _ in range(levels):
        for p in group:
            spare[p] += patterns[p][1]
        while True:
            came: dict[tuple, tuple | None] = {("p", p): None for p in group if spare[p] > 0}
            queue = deque(came)
            end = None
            while queue and end is None:
                kind, at = node = queue.popleft()
                if kind == "p":
                    steps = [("s", s) for s in patterns[at][0]]
                elif need[at] > 0:
                    end = node
                    break
                else:
                    steps = [("p", p) for p in of_source[at] if flows[p].get(at, 0) > 0]  # give back what another pattern sends here
                for step in steps:
                    if step not in came:
                        came[step] = node
                        queue.append(step)
            if end is None:
                break
            path = [end]
            while came[path[-1]] is not None:
                path.append(came[path[-1]])
            path.reverse()
            amount = min(spare[path[0][1]], need[end[1]])
            for (kind, a), (_, b) in zip(path, path[1:]):
                if kind == "s":
                    amount = min(amount, flows[b][a])
            for (kind, a), (_, b) in zip(path, path[1:]):
                if kind == "p":
                    flows[a][b] = flows[a].get(b, 0) + amount
                else:
                    flows[b][a] -= amount
            spare[path[0][1]] -= amount
            need[end[1]] -= amount


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table of driver rows, marked for broadcast while it is small; beyond that Spark chooses the join."""
    made = spark.createDataFrame(rows, schema)
    return F.broadcast(made) if len(rows) <= BROADCAST_ROWS else made


def words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def _chosen(conditions: Column) -> Column:
    """Whether a row is among those that the passes so far took."""
    h, uid, size = F.col("h"), F.col("uid"), F.col("size")
    before = lambda c: ~c["alone"] & (size <= c["most"]) & ((h < c["h"]) | ((h == c["h"]) & (uid <= c["uid"])))
    one = lambda c: c["alone"] & (uid == c["uid"])
    return (size > 0) & F.exists(conditions, lambda c: before(c) | one(c))


_CONDITION = "array<struct<most:bigint,h:bigint,uid:bigint,alone:boolean>>"


class _Selection:
    """Documents of every pattern chosen so far, as conditions on size, hash and row id."""

    def __init__(self, rows: DataFrame, rest: dict[str, int]):
        self.rows, self.left = rows, dict(rest)
        self.taken: dict[str, list[tuple]] = {p: [] for p in rest}
        self.close = {p: max(1, int(n * OPEN_SHARE)) for p, n in rest.items()}
        bits = min(40, max(6, math.ceil(math.log2(rows.count() / BUCKET_ROWS + 1))))
        self.bucket = F.shiftright("h", 64 - bits)
        self.session = rows.sparkSession

    def _waiting(self, open_: list[str]) -> DataFrame:
        """Rows not chosen yet of the open patterns, with what is left to fill."""
        wanted = _small(self.session, [(p, self.left[p], self.taken[p]) for p in open_], f"pattern string, open long, taken {_CONDITION}")
        return self.rows.join(wanted, "pattern").where(~_chosen(F.col("taken")) & (F.col("size") > 0)).drop("taken")

    def fill(self) -> None:
        open_ = [p for p, n in self.left.items() if n > 0]
        for _ in range(_PASSES):
            if not open_:
                break
            open_ = [p for p in self._pass(open_) if self.left[p] >= self.close[p]]
        open_ = [p for p, n in self.left.items() if n >= self.close[p]]
        if open_:
            smallest = F.min(F.struct("size", "h", "uid")).alias("m")
            for r in self._waiting(open_).where(F.col("size") < 2 * F.col("open")).groupBy("pattern").agg(smallest).collect():  # a row per pattern
                self.taken[r.pattern].append((r.m.size, r.m.h, r.m.uid, True))
                self.left[r.pattern] -= r.m.size

    def _pass(self, open_: list[str]) -> list[str]:
        """Take the documents before the cut; the patterns in which some fitted."""
        fitting = self._waiting(open_).where(F.col("size") <= F.col("open")).withColumn("bucket", self.bucket)
        along = Window.partitionBy("pattern").orderBy("bucket")
        sums = fitting.groupBy("pattern", "bucket").agg(F.sum("size").alias("words"), F.max("open").alias("open")).withColumn("upto", F.sum("words").over(along))
        over = F.col("upto") > F.col("open")
        cut = sums.groupBy("pattern").agg(F.max("upto").alias("all"), F.min(F.when(over, F.struct("bucket", (F.col("upto") - F.col("words")).alias("before")))).alias("cut"))
        cuts = {r.pattern: (r["all"], r.cut) for r in cut.collect()}  # a row per pattern
        for p, (everything, at) in cuts.items():
            if at is None:
                self.taken[p].append((self.left[p], _LAST, _LAST, False))
                self.left[p] -= everything
        inside = [(p, c.bucket, c.before) for p, (_, c) in cuts.items() if c is not None]
        if inside:
            some = fitting.join(_small(self.session, inside, "pattern string, bucket long, before long"), ["pattern", "bucket"])
            units = some.groupBy("pattern", "h").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"), F.max("open").alias("open"), F.max("before").alias("before"))
            upto = F.col("before") + F.sum(F.col("size") * F.col("n")).over(Window.partitionBy("pattern").orderBy("h"))
            first = units.withColumn("upto", upto).where("upto > open").groupBy("pattern").agg(F.min(F.struct("h", "size", "n", (F.col("upto") - F.col("size") * F.col("n")).alias("before"))).alias("u"))
            partly = []
            for p, u in ((r.pattern, r.u) for r in first.collect()):  # a row per pattern
                copies = (self.left[p] - u.before) // u.size
                self.taken[p].append([self.left[p], u.h, -1, False])
                self.left[p] -= u.before + copies * u.size
                if copies:
                    partly.append((p, u.h, copies))
            for p, uid in self._numbered(some, partly).items():
                self.taken[p][-1][2] = uid
            for p, *_ in inside:
                self.taken[p][-1] = tuple(self.taken[p][-1])
        return list(cuts)

    def _numbered(self, rows: DataFrame, partly: list[tuple[str, int, int]]) -> dict[str, int]:
        """The id of the n-th of the rows with a pattern and hash, counted by partition first."""
        if not partly:
            return {}
        wanted = _small(self.session, partly, "pattern string, h long, copies long")
        alike = rows.join(wanted, ["pattern", "h"]).withColumn("part", F.shiftright("uid", 33))
        counts = alike.groupBy("pattern", "part").agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("copies"))
        upto = F.sum("n").over(Window.partitionBy("pattern").orderBy("part"))
        at = counts.withColumn("upto", upto).where("upto >= copies").groupBy("pattern").agg(F.min(F.struct("part", (F.col("copies") - F.col("upto") + F.col("n")).alias("nth"))).alias("at"))
        mine = alike.join(at.select("pattern", F.col("at.part").alias("part"), F.col("at.nth").alias("nth")), ["pattern", "part"])
        place = F.row_number().over(Window.partitionBy("pattern", "part").orderBy("uid"))
        return {r.pattern: r.uid for r in mine.withColumn("place", place).where("place = nth").select("pattern", "uid").collect()}


def mix(docs: DataFrame, sources: Column, key: str = "doc_id", text: str = "text", weights: tuple[int, ...] = (1, 2, 3), most: int = 3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(rows, quotas). ``sources`` is the array of sources a document belongs to.

    rows: doc_id, size, sources (sorted, each once) and taken for every document. quotas: source,
    source_size, target and routed (words the flow gives the source). Sources weigh ``weights``
    in turn, in code point order; together they ask for the words of all documents that have a source.
    """
    spark = docs.sparkSession
    member = F.array_sort(F.array_distinct(F.coalesce(sources, F.array().cast("array<string>"))))
    slim = docs.select(
        F.col(key).alias("doc_id"), words(text).alias("size"), F.to_json(member, {"ignoreNullFields": "false"}).alias("pattern"),
        F.xxhash64(F.lit(seed), F.col(key), F.isnull(key), F.col(text)).alias("h"), F.monotonically_increasing_id().alias("uid"),
    )
    rows = stored(slim, "mixing-rows")
    found = sorted((r.pattern, r.words) for r in rows.groupBy("pattern").agg(F.sum("size").alias("words")).collect())  # one row per set of sources
    members = [json.loads(p) for p, _ in found]
    names = sorted({s for m in members for s in m}, key=lambda s: (s is None, s or ""))
    place = {s: i for i, s in enumerate(names)}
    patterns = [(tuple(place[s] for s in m), n) for m, (_, n) in zip(members, found, strict=True)]
    sizes = [0] * len(names)
    for member_places, n in patterns:
        for s in member_places:
            sizes[s] += n
    wanted = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], sum(n for m, n in patterns if m), most) if names else []
    flows = route(patterns, [int(t + Fraction(1, 2)) for t in wanted], most)
    whole: dict[str, int] = {}
    rest: dict[str, int] = {}
    for (pattern, n), flow in zip(found, flows, strict=True):
        whole[pattern], rest[pattern] = divmod(sum(flow.values()), n) if n else (0, 0)
    selection = _Selection(rows, rest)
    selection.fill()
    plan = _small(spark, [(p, whole[p], selection.taken[p]) for p, _ in found], f"pattern string, whole int, conditions {_CONDITION}")
    taken = F.col("size") * (F.col("whole") + _chosen(F.col("conditions")).cast("int"))
    result = rows.join(plan, "pattern").select("doc_id", "size", F.from_json("pattern", "array<string>").alias("sources"), taken.cast("long").alias("taken"))
    routed = [0] * len(names)
    for flow in flows:
        for s, n in flow.items():
            routed[s] += n
    quotas = [(s, sizes[i], float(wanted[i]), routed[i]) for i, s in enumerate(names)]
    return result, _small(spark, quotas, "source string, source_size long, target double, routed long")


def mix_sources(docs: DataFrame, source: str = "source", **settings: object) -> DataFrame:
    """doc_id, size, source_size, target and taken, where every document has the one source of a column."""
    rows, quotas = mix(docs, F.array(source), **settings)
    own = rows.withColumn("source", F.col("sources")[0]).drop("sources")
    return own.join(quotas, own["source"].eqNullSafe(quotas["source"])).select("doc_id", "size", "source_size", "target", "taken")
