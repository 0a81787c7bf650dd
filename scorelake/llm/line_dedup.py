"""Line dedup with a tree of line templates, in DataFrame operations only.

Tokens are what white space of any kind parts, and the characters of a long line without any.
Fields that hold a digit are masked at once in lines of ``MIN_TOKENS`` tokens or more. The tree has fixed depth: token count,
then the first ``LEADING`` masked tokens. A line has ``SEGMENTS`` segments; two variants of a
node are similar if they agree in segments of ``SIMILAR`` of all tokens or more. For every
set of segments that similar lines may differ in, the others make a leaf, so variants meet
in a leaf if and only if they are similar. A variant that is seen in most documents of all
its leaves is a seed, and what meets it takes its template, in which what differs is
variable. This is repeated over the variants that no seed took until no leaf holds two.

A template recurs if documents of at least ``MIN_DOCUMENTS`` different contents hold it. A
document's content is the set of templates of all its other lines. Copies of one document
have one content, and so have near-copies whose edited lines share a template; hence such
copies make no template recur (they are the business of near-duplicate removal), however
many there are, and a template's verdict does not depend on how many documents hold it.
"""

from __future__ import annotations

from itertools import combinations, pairwise

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import fresh_name, stored

LEADING = 3
SIMILAR = 0.8
MIN_DOCUMENTS = 5
MIN_TOKENS = 3  # shorter lines are neither masked nor merged
SEGMENTS = 10
UNBROKEN = 12  # a line without a blank has its characters as tokens from this length on
_LOW = (1 << 32) - 1
_SPACE = r"\s\u0085\p{Z}"
_FIELD = rf"(?<![^{_SPACE}])[^{_SPACE}0-9]*+[0-9][^{_SPACE}]*+"


def _identity(key: str, text: str) -> list[Column]:
    """A row's identity in 96 bits: hashes of its key and whole text. Repeated rows share it, so they count once and fare alike."""
    of = F.coalesce(F.col(key).cast("string"), F.lit("\u0000")), F.col(text)
    return [F.xxhash64(*of).alias("row"), F.hash(*of).alias("row_check")]


def _lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row, row_check, pos, variant, node, count and the hashed segments of every line with a token.

    A line is known by 64-bit hashes from here on. ``SEGMENTS`` hashes stand for its tokens;
    they are packed two by two, so that plain aggregates can carry them.
    """
    exploded = docs.where(F.col(text).isNotNull()).select(*_identity(key, text), F.posexplode(F.split(text, "\n")).alias("pos", "line")).where(F.col("line").rlike(f"[^{_SPACE}]"))
    bare = exploded.select("row", "row_check", "pos", F.regexp_replace("line", f"^[{_SPACE}]++|(?<![{_SPACE}])[{_SPACE}]++$", "").alias("line")).withColumn("words", F.split("line", f"[{_SPACE}]+"))
    unbroken = (F.size("words") == 1) & (F.length("line") >= UNBROKEN)
    digits = F.col("line").rlike("[0-9]")
    characters = F.split(F.when(digits, F.regexp_replace("line", "[0-9]+", "0")).otherwise(F.col("line")), "")
    masked = F.split(F.regexp_replace("line", _FIELD, "<*>"), f"[{_SPACE}]+")
    chosen = F.when(unbroken, characters).when((F.size("words") >= MIN_TOKENS) & digits, masked).otherwise(F.col("words"))
    tokens = bare.select("row", "row_check", "pos", chosen.alias("tokens"))
    count = F.size("tokens")
    edges = [F.floor(count * i / SEGMENTS).cast("int") for i in range(SEGMENTS + 1)]
    hashes = [F.hash(F.slice("tokens", edges[i] + 1, edges[i + 1] - edges[i])).cast("bigint") for i in range(SEGMENTS)]
    packed = [F.shiftleft(hashes[2 * i], 32).bitwiseOR(hashes[2 * i + 1].bitwiseAND(_LOW)).alias(f"p{i}") for i in range(SEGMENTS // 2)]
    lead = F.xxhash64(F.slice("tokens", 1, LEADING))
    return tokens.select("row", "row_check", "pos", F.xxhash64("tokens").alias("variant"), F.xxhash64(count, lead).alias("node"), count.alias("count"), *packed)


def _rests() -> list[tuple[int, list[tuple[int, ...]]]]:
    """For every class of token counts (the count itself, from 40 on 40 + count % 10) the sets of segments that similar lines may differ in.

    Only the largest sets, and only of segments that reach beyond the leading tokens. From
    20 tokens on which sets fit depends on the last digit of the count alone.
    """
    found = []
    for count in range(LEADING + 1, 50):
        edges = [count * i // SEGMENTS for i in range(SEGMENTS + 1)]
        size = [b - a for a, b in pairwise(edges)]
        free = [i for i in range(SEGMENTS) if size[i] and edges[i + 1] > LEADING]
        fits = [set(c) for n in (1, 2, 3) for c in combinations(free, n) if count - sum(size[i] for i in c) >= SIMILAR * count]
        found.append((count, [tuple(sorted(c)) for c in fits if not any(c < d for d in fits)]))
    return found


def _merged(lines: DataFrame, variants: DataFrame) -> DataFrame:
    """variant, template: the variants that take the template of a seed."""
    spark = lines.sparkSession
    nodes = variants.groupBy("node").agg(F.count("*").alias("n"), F.sum("docs").alias("total"))
    nodes = nodes.where((F.col("n") > 1) & (F.col("total") >= MIN_DOCUMENTS)).select("node")
    shared = variants.join(nodes, "node", "left_semi")
    packed = [f"p{i}" for i in range(SEGMENTS // 2)]
    segments = lines.groupBy("variant").agg(*[F.min(p).alias(p) for p in packed])  # before the join: a frequent line is one row per task
    shared = shared.join(segments, "variant")
    rests = spark.createDataFrame([(count, [[*c, *[SEGMENTS] * (3 - len(c))] for c in sets]) for count, sets in _rests() if sets], "class int, sets array<array<int>>")
    hashes = [F.shiftright(p, 32) if half == 0 else F.shiftright(F.shiftleft(p, 32), 32) for p in packed for half in (0, 1)]
    parts = F.array(*[F.xxhash64(F.lit(i), h) for i, h in enumerate(hashes)], F.lit(0).cast("bigint"))  # the last for no segment
    whole = F.col("parts")[0]
    for i in range(1, SEGMENTS):
        whole = whole.bitwiseXOR(F.col("parts")[i])
    classes = F.when(F.col("count") < 40, F.col("count")).otherwise(40 + F.col("count") % 10)
    spread = shared.select("variant", "docs", "node", classes.cast("int").alias("class"), parts.alias("parts")).join(F.broadcast(rests), "class")
    spread = spread.withColumn("whole", whole).select("variant", "docs", "node", "parts", "whole", F.explode("sets").alias("set"))
    cut = F.col("whole")
    for i in range(3):
        cut = cut.bitwiseXOR(F.col("parts")[F.col("set")[i]])
    leaf = F.xxhash64("node", cut, *[F.col("set")[i] for i in range(3)])
    left = stored(spread.select(leaf.alias("leaf"), "variant", "docs"), "lines-leaves")
    taken = None
    while True:
        tops = left.groupBy("leaf").agg(F.max(F.struct("docs", "variant")).alias("top"), F.count("*").alias("n")).where(F.col("n") > 1).select("leaf", "top")
        met = stored(left.join(tops, "leaf"), "lines-met")
        if met.isEmpty():
            break
        # a seed is the most frequent variant in all of its leaves
        seeds = met.groupBy("variant").agg(F.min(F.col("top.variant") == F.col("variant")).alias("seed")).where("seed").select("variant")
        founded = met.join(seeds.withColumnRenamed("variant", "founder"), F.col("top.variant") == F.col("founder"))
        new = stored(founded.groupBy("variant").agg(F.max("top").alias("top")).select("variant", F.col("top.variant").alias("template")), "lines-taken")
        taken = new if taken is None else taken.unionByName(new)
        left = met.join(new, "variant", "left_anti").select("leaf", "variant", "docs")
    if taken is None:
        return spark.createDataFrame([], "variant bigint, template bigint")
    return taken.where(F.col("variant") != F.col("template"))


def recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """row, row_check, pos, template for every line of a recurring template (the first two: see ``_identity``)."""
    lines = stored(_lines(docs, key, text), "lines")
    held_by = lines.groupBy("variant", "node", "count", "row", "row_check").agg(F.lit(1).alias("one"))
    variants = stored(held_by.groupBy("variant", "node", "count").agg(F.count("*").alias("docs")), "lines-variants")
    named = variants.join(_merged(lines, variants), "variant", "left").select("variant", "docs", F.coalesce("template", "variant").alias("template"))
    named = stored(named, "lines-named")
    frequent = named.groupBy("template").agg(F.sum("docs").alias("n")).where(F.col("n") >= MIN_DOCUMENTS).select("template", F.lit(True).alias("frequent"))
    templates = named.join(frequent, "template", "left").where((F.col("template") != F.col("variant")) | F.col("frequent")).select("variant", "template", "frequent")
    placed = lines.select("row", "row_check", "pos", "variant").join(templates, "variant", "left").withColumn("template", F.coalesce("template", "variant"))
    # repeated rows give the same lines; a template counts once in a document
    once = placed.repartition("row", "row_check").groupBy("row", "row_check", "template", "pos").agg(F.max("frequent").alias("frequent"))
    first = F.row_number().over(Window.partitionBy("row", "row_check", "template").orderBy("pos")) == 1
    own = F.xxhash64("template")
    content = F.bit_xor(F.when(F.col("first"), own)).over(Window.partitionBy("row", "row_check"))
    rest = once.withColumn("first", first).withColumn("rest", content.bitwiseXOR(own))
    held = stored(rest.where("frequent").select("row", "row_check", "pos", "template", "rest"), "lines-held")
    contents = held.select("template", "rest").distinct().groupBy("template").agg(F.count("*").alias("n"))
    # written first: both sides of the join are then dealt by it, and Spark can split a frequent template
    recurring = stored(contents.where(F.col("n") >= MIN_DOCUMENTS).select("template"), "lines-recurring")
    return held.join(recurring, "template", "left_semi").select("row", "row_check", "pos", "template")


def drop_recurring_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", dropped: str | None = None) -> DataFrame:
    """The rows of ``docs`` with recurring lines taken out of the text.

    Lines end at ``\\n``; blank lines always
    stay, as does the order of the rest. A null text stays null, an empty one empty; a text of nothing
    but recurring lines becomes empty. ``dropped`` names a column for the number of lines
    taken out (0 if none). Repeated rows fare alike, null keys are no special case, and an
    empty table gives no rows. A column ``n_chars`` follows the new text where it has changed.
    """
    row, check, out = fresh_name(docs, "row_identity"), fresh_name(docs, "row_check"), fresh_name(docs, "row_dropped")
    places = recurring_lines(docs, key, text).groupBy("row", "row_check").agg(F.collect_set("pos").alias(out))
    places = places.select(F.col("row").alias(row), F.col("row_check").alias(check), out)
    joined = docs.withColumns(dict(zip((row, check), _identity(key, text), strict=True))).join(places, [row, check], "left")
    parts = F.split(text, "\n")
    numbered = F.arrays_zip(F.sequence(F.lit(0), F.size(parts) - 1).alias("i"), parts.alias("x"))
    # a line that goes becomes null, and array_join leaves nulls out
    rest = F.array_join(F.transform(numbered, lambda p: F.when(~F.array_contains(F.col(out), p["i"]), p["x"])), "\n")
    changed = F.col(out).isNotNull()
    result = joined.withColumn(text, F.when(changed, rest).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.when(changed, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    names = list(docs.columns)
    if dropped:
        result, names = result.withColumn(dropped, F.coalesce(F.size(out), F.lit(0))), [*names, dropped]
    return result.select(*names)
