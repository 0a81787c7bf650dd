"""Personal data: fixed forms as seeds, and contexts learnt from them, in DataFrame operations only.

One scan of the texts finds the base spans (email, ip, card, phone by their patterns and
checks) and the candidates: addresses with an at sign and runs of digits, over several tokens
where single blanks, dots, dashes, slashes or brackets join them, each with the words around
it. Only these leave the scan; texts are not shuffled. Places follow from the lengths of what
lies between matches, summed along each document.

Bootstrapping runs on the graph of patterns and instances. A pattern is context alone: the
word before, the two words before, or the word before with the one after (lower case, digits
as 9). An instance is what a candidate says, blanks and dashes of numbers left out. Instances
that base spans begin in are seeds of confidence 1. A pattern's confidence for a kind is the
sum of its known instances' over the number of its instances; it is trusted from ``TRUSTED`` and
``SUPPORT`` distinct known instances, seeds or learnt ones. Instances of the kind's loose form
in a trusted pattern are learnt, with the noisy or of such patterns' confidences, and count in
the next round; rounds end when patterns and confidences stay, after ``ROUNDS`` at the latest. Candidates
outside all base spans in a trusted pattern become spans of its kind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorelake.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
# A run that cannot match from its start cannot match from within, so each run is tried once:
# at its start, or where the match before ended. Possessive loops keep long runs linear.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
HINTS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
# letters that follow a run of digits are taken along, so that such a run fits no kind
CANDIDATE = (
    r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}.-]++"
    r"|(?<![\p{L}\p{N}._+(@/-])[+(]{0,2}+[0-9](?:[\x20().\-/]{0,3}+[0-9])*+[\p{L}\p{N}_@]*+"
)
# the loose form of each kind, over instances, and how many digits it may have
LOOSE = {
    "email": r"^[^@]++@[\p{L}\p{N}]",
    "ip": r"^[0-9]++(?:\.[0-9]++){2,}+$",
    "card": r"^[0-9]++$",
    "phone": r"^(?![0-9]++(?:\.[0-9]++){2,}+$)[+(]*+[0-9][0-9().\/]*+$",
}
DIGITS = {"card": (8, 24), "phone": (6, 18)}
CONTEXT = 64  # characters next to a candidate that are searched for its neighbour words
TRUSTED = 0.9
SUPPORT = 10
ROUNDS = 5


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    turned = F.reverse(digits)
    value = lambda i: F.substr(turned, i + 1, F.lit(1)).cast("int")
    doubled = lambda d: 2 * d - F.when(d > 4, 9).otherwise(0)
    total = F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda acc, i: acc + F.when(i % 2 == 1, doubled(value(i))).otherwise(value(i)))
    return total % 10 == 0


def _valid(kind: Column, match: Column) -> Column:
    """Whether a match passes its kind's check."""
    digits = _digits(match)
    part = lambda p: F.regexp_replace(p, "^0+", "")
    small = F.forall(F.split(match, r"\."), lambda p: (F.length(part(p)) <= 3) & (F.coalesce(part(p).try_cast("int"), F.lit(0)) <= 255))
    card = F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(F.lit(False))
    return F.when(kind == "email", F.lit(True)).when(kind == "ip", small).when(kind == "card", card).otherwise(F.length(digits).between(9, 15))


def _fits(kind: Column, instance: Column) -> Column:
    """Whether an instance has the loose form of a kind."""
    form = F.lit(False)
    for name, pattern in LOOSE.items():
        fits = instance.rlike(pattern)
        if name in DIGITS:
            fits = fits & F.length(_digits(instance)).between(*DIGITS[name])
        form = F.when(kind == name, fits).otherwise(form)
    return form


def _matches(text: Column, pattern: str, hint: str) -> Column:
    """Per match its text and the length of what lies between it and the match before; null without the hint."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), F.length)
    return F.when(text.rlike(hint), F.arrays_zip(found.alias("match"), F.slice(between, 1, F.size(found)).alias("gap")))


def _candidates(text: Column) -> Column:
    """Per candidate: its text, what lies before it (length, last word, last two words), and the first word of what lies behind."""
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    around = F.transform(
        F.split(text, CANDIDATE, -1),
        lambda p: F.struct(
            F.length(p).alias("gap"),
            F.regexp_extract(F.right(p, F.lit(CONTEXT)), r"(\S+)\s*$", 1).alias("one"),
            F.regexp_extract(F.right(p, F.lit(CONTEXT)), r"(\S+\s+\S+)\s*$", 1).alias("two"),
            F.regexp_extract(F.left(p, F.lit(CONTEXT)), r"^[^\p{L}\p{N}]*+([\p{L}\p{N}]++)", 1).alias("next"),
        ),
    )
    n = F.size(found)
    return F.when(text.rlike("[0-9@]"), F.arrays_zip(found.alias("match"), F.slice(around, 1, n).alias("before"), F.slice(around, 2, n).alias("behind")))


def _placed(exploded: DataFrame, *by: str) -> DataFrame:
    """start and end, from the gaps and matches before in the same document; in code points."""
    order = Window.partitionBy(*by).orderBy("i")
    through = order.rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.length("match")).over(through)
    return exploded.withColumn("end", end).withColumn("start", F.col("end") - F.length("match"))


def _base(found: DataFrame) -> DataFrame:
    """uid, kind, order, start, end of the base spans."""
    kinds = F.array(*[F.struct(F.lit(i).alias("order"), F.lit(k).alias("kind"), F.col(k).alias("found")) for i, k in enumerate(KINDS)])
    listed = found.select("uid", F.inline(kinds)).where(F.size("found") > 0)
    rows = listed.select("uid", "order", "kind", F.posexplode("found").alias("i", "m")).select("uid", "order", "kind", "i", "m.match", "m.gap")
    return _placed(rows, "uid", "kind").where(_valid(F.col("kind"), F.col("match"))).select("uid", "order", "kind", "start", "end")


def _normal(words: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(words), "[0-9]+", "9"), r"\s+", " ")


def _occurrences(found: DataFrame, base: DataFrame) -> DataFrame:
    """uid, start, end, instance, patterns and the kind of the base span that begins in a candidate (null outside all spans).

    Candidates in the rest of a base span, and those with no word before them, say nothing. Spans and
    candidates of a document are put in order once each way: the largest end so far tells whether a span
    from before reaches into a candidate, the smallest start from there on whether one begins in it.
    """
    rows = found.where(F.size("candidates") > 0).select("uid", F.posexplode("candidates").alias("i", "c"))
    rows = _placed(rows.select("uid", "i", "c.match", F.col("c.before.gap").alias("gap"), F.col("c.before.one").alias("one"), F.col("c.before.two").alias("two"), F.col("c.behind.next").alias("next")), "uid")
    core = F.regexp_replace("match", r"(?<![.-])[.-]++$", "")
    rows = rows.withColumn("end", F.col("start") + F.length(core))
    instance = F.when(core.contains("@"), F.lower(core)).otherwise(F.regexp_replace(core, r"[\x20-]+", ""))
    one, two, behind = _normal(F.col("one")), _normal(F.col("two")), _normal(F.col("next"))
    patterns = F.filter(
        F.array(F.concat(one, F.lit(" _")), F.when(F.col("two") != "", F.concat(two, F.lit(" _"))), F.when(F.col("next") != "", F.concat(one, F.lit(" _ "), behind))),
        lambda p: p.isNotNull(),
    )
    nothing = F.lit(None).cast("struct<start:bigint,order:int,kind:string,end:bigint>")
    told = rows.where("one <> ''").select("uid", "start", "end", instance.alias("instance"), patterns.alias("patterns"), nothing.alias("span"))
    span = F.struct(F.col("start").cast("bigint").alias("start"), "order", "kind", F.col("end").cast("bigint").alias("end")).alias("span")
    every = told.unionByName(base.select("uid", "start", "end", F.lit(None).cast("string").alias("instance"), F.lit(None).cast("array<string>").alias("patterns"), span))
    document = Window.partitionBy("uid")
    reach = F.max("span.end").over(document.orderBy("start"))
    begun = F.min("span").over(document.orderBy(F.col("start").desc()))
    known = every.withColumn("reach", reach).withColumn("begun", begun).where("span IS NULL")
    kind = F.when(F.col("begun.start") < F.col("end"), F.col("begun.kind"))
    known = known.withColumn("kind", kind).where("kind IS NOT NULL OR reach IS NULL OR reach <= start")
    return known.select("uid", "start", "end", "instance", "patterns", "kind")


def learn_patterns(occurrences: DataFrame) -> DataFrame:
    """pattern, kind, confidence and the round it was first trusted in, of the trusted patterns."""
    met = occurrences.select(F.explode("patterns").alias("pattern"), "instance", "kind")
    edges = stored(met.groupBy("pattern", "instance").agg(F.min("kind").alias("seed")), "pii-edges")
    seeds = edges.where("seed IS NOT NULL").groupBy("instance").agg(F.min("seed").alias("kind")).withColumn("confidence", F.lit(1.0))
    totals = edges.groupBy("pattern").agg(F.count("*").alias("total"))
    known, trusted, before = seeds, None, None
    for turn in range(1, ROUNDS + 1):
        scored = edges.join(known, "instance").groupBy("pattern", "kind").agg(F.sum("confidence").alias("weight"), F.count("*").alias("support"))
        scored = scored.where(F.col("support") >= SUPPORT).join(totals, "pattern").withColumn("confidence", F.round(F.col("weight") / F.col("total"), 9))
        now = scored.where(F.col("confidence") >= TRUSTED).select("pattern", "kind", "confidence")
        first = F.lit(turn)
        if trusted is not None:
            now = now.join(trusted.select("pattern", "kind", "round"), ["pattern", "kind"], "left")
            first = F.coalesce("round", first)
        trusted = stored(now.withColumn("round", first), "pii-patterns")
        state = trusted.agg(F.count("*"), F.round(F.sum("confidence"), 6)).first()
        if state == before:
            break
        before = state
        reached = edges.join(seeds.select("instance"), "instance", "left_anti").join(trusted, "pattern").where(_fits(F.col("kind"), F.col("instance")))
        noisy_or = 1 - F.exp(F.sum(F.log(F.greatest(1 - F.col("confidence"), F.lit(1e-6)))))
        learnt = reached.groupBy("instance", "kind").agg(F.round(noisy_or, 9).alias("confidence"))
        best = learnt.groupBy("instance").agg(F.max(F.struct("confidence", "kind")).alias("best"))  # an instance is of its likelier kind
        known = stored(seeds.unionByName(best.select("instance", F.col("best.kind").alias("kind"), F.col("best.confidence").alias("confidence"))), "pii-instances")
    best = F.max(F.struct("confidence", "kind", "round")).alias("best")
    return trusted.groupBy("pattern").agg(best).select("pattern", "best.kind", "best.confidence", "best.round")


def _learnt(occurrences: DataFrame, patterns: DataFrame) -> DataFrame:
    """uid, kind, start, end of the candidates outside base spans that stand in a trusted pattern and fit its kind; the likelier kind counts."""
    open_ones = occurrences.where("kind IS NULL").select("uid", "start", "end", "instance", F.explode("patterns").alias("pattern"))
    met = open_ones.join(patterns, "pattern").where(_fits(F.col("kind"), F.col("instance")))
    best = F.max(F.struct("confidence", "kind")).alias("best")
    return met.groupBy("uid", "start", "end").agg(best).select("uid", F.col("best.kind").alias("kind"), "start", "end")


def find_personal_data(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, the number of base spans per kind, base_sha256, spans (base and learnt), n_learnt: one row per row of ``docs``.

    Spans are ``kind:start:end``, by start and then kind, comma-joined; a text without any
    (null and empty ones too) has the empty string. Places are code points, ends exclusive.
    Numbers that one blank parts are one candidate, so a learnt span may take a number that
    follows the identifier with it. Null and repeated keys get rows of their own, other
    columns are ignored, an empty table gives no rows.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    scan = docs.select(
        F.col(key).alias("doc_id"),
        F.monotonically_increasing_id().alias("uid"),
        *[_matches(content, PATTERNS[k], HINTS[k]).alias(k) for k in KINDS],
        _candidates(content).alias("candidates"),
    )
    found = stored(scan, "pii-scan")
    base = stored(_base(found), "pii-base")
    occurrences = stored(_occurrences(found, base), "pii-occurrences")
    learnt = _learnt(occurrences, learn_patterns(occurrences))
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    spans = base.withColumn("base", F.lit(True)).unionByName(learnt.select("uid", order.alias("order"), "kind", "start", "end", F.lit(False).alias("base")))
    listed = spans.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "order", "end", "kind", "base"))).alias("spans"))
    joined = lambda of: F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    own = F.filter("spans", lambda s: s["base"])
    none = F.coalesce(F.col("spans"), F.array().cast(listed.schema["spans"].dataType))
    result = found.select("doc_id", "uid").join(listed, "uid", "left").withColumn("spans", none)

    def of_kind(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    return result.select(
        "doc_id", *map(of_kind, KINDS), F.sha2(joined(own).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
        (F.size("spans") - F.size(own)).cast("bigint").alias("n_learnt"),
    )
