"""Row numbers, lags and rolling frames that do not need a whole group in one task.

A window over ``PARTITION BY key`` sends every row of a key to one task. Here each key is
cut into buckets that follow the sort order, work is done per (key, bucket), and only one
summary row per bucket is looked at per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorelake.session import pinned

_ROW = (1 << 33) - 1


def number_rows(df: DataFrame, order: list, as_: str = "row_id", start: Column | int = 1) -> DataFrame:
    """Dense numbers over the whole result in ``order``, counting from ``start``.

    Rows are range-partitioned and sorted; each partition numbers its own rows and adds the
    row count of the partitions before it. The sorted rows are written out once, so both
    reads see the same partitions.
    """
    marked = pinned(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mark", F.monotonically_increasing_id())
    )
    part, row = F.shiftright("_mark", 33), F.col("_mark").bitwiseAND(F.lit(_ROW))
    sizes = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    base = start if isinstance(start, Column) else F.lit(start)
    # one row per partition, so the broadcast is bounded by the partition count
    return (
        marked.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(as_, (row + F.col("_before") + base).cast("long"))
        .drop("_mark", "_part", "_before")
    )


def number_in_groups(
    df: DataFrame, keys: list[str], order: list, bucket: Column, as_: str = "row_id", descending: bool = False, nulls_first: bool | None = None
) -> DataFrame:
    """``ROW_NUMBER`` per ``keys``.

    ``bucket`` must never decrease along ``order``, or never increase where ``descending``; its
    NULLs stand where ``order`` puts them: first when ascending and last when descending, as
    Spark sorts, unless ``nulls_first`` says otherwise. The window and the join share the
    partitioning by ``_k``, so the rows are shuffled once.
    """
    first = (not descending) if nulls_first is None else nulls_first
    bucketed = _with_bucket(df, keys, bucket)
    local = bucketed.withColumn("_local", F.row_number().over(Window.partitionBy("_k").orderBy(*order)))
    sizes = bucketed.groupBy("_k").agg(F.count(F.lit(1)).alias("_n"))
    place = F.col("_k._bucket")
    along = (place.desc_nulls_first() if first else place.desc_nulls_last()) if descending else (place.asc_nulls_first() if first else place.asc_nulls_last())
    before = Window.partitionBy(*(F.col(f"_k.{k}") for k in keys)).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_k", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return local.join(offsets, "_k").withColumn(as_, (F.col("_local") + F.col("_before")).cast("long")).drop("_k", "_local", "_before")


def range_buckets(df: DataFrame, keys: list[str], order: list[str], as_: str = "bucket", parts: int | None = None) -> DataFrame:
    """The rows with a bucket that follows ascending ``order`` within each key, for the functions of this module.

    Spark samples keys and order together and cuts the rows into ranges of like size, so a hot
    key, month or hour is cut like any other, and buckets need no knowledge of the data. ``order``
    should be total. The rows are written out once, which fixes their ranges.
    """
    along = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    cut = df.repartitionByRange(parts, *along) if parts else df.repartitionByRange(*along)
    return pinned(cut.withColumn(as_, F.spark_partition_id()))


def lag_in_groups(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column, as_: str) -> DataFrame:
    """``LAG(value)`` per ``keys`` in ascending ``order``, which should be total; ``bucket`` must never decrease along it."""
    bucketed = _with_bucket(df, keys, bucket)
    inside = Window.partitionBy("_k").orderBy(*order)
    local = bucketed.withColumns({"_lag": F.lag(value).over(inside), "_first": F.row_number().over(inside) == 1})
    last = bucketed.groupBy("_k").agg(F.max(F.struct(*order, F.col(value).alias("_value")))["_value"].alias("_last"))
    across = Window.partitionBy(*(F.col(f"_k.{k}") for k in keys)).orderBy(F.col("_k._bucket").asc_nulls_first())
    carried = last.select("_k", F.lag("_last").over(across).alias("_carry"))
    return local.join(carried, "_k").withColumn(
        as_, F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_lag"))
    ).drop("_k", "_lag", "_first", "_carry")


def rolling_in_groups(
    df: DataFrame, keys: list[str], position: str, size: int, aggregates: dict[str, Column], chunk: int = 50_000
) -> DataFrame:
    """Aggregates over the current and the ``size - 1`` rows before it, per ``keys``.

    ``position`` is a dense row number per key. Rows are cut into chunks of consecutive
    positions; the last ``size - 1`` rows of a chunk are copied into the next one.
    """
    own = F.floor((F.col(position) - 1) / chunk)
    reaches_next = (F.col(position) - 1) % chunk >= chunk - (size - 1)
    spread = df.withColumn("_own", own).withColumn(
        "_chunk", F.explode(F.when(reaches_next, F.array(own, own + 1)).otherwise(F.array(own)))
    )
    frame = Window.partitionBy(*keys, "_chunk").orderBy(position).rowsBetween(-(size - 1), 0)
    computed = spread.withColumns({name: agg.over(frame) for name, agg in aggregates.items()})
    return computed.filter(F.col("_own") == F.col("_chunk")).drop("_own", "_chunk")


def rolling_sums(df: DataFrame, keys: list[str], order: list, bucket: Column, value: str, size: int, sum_as: str, count_as: str, nulls_first: bool = True) -> DataFrame:
    """Sum and count of ``value`` over the current and the ``size - 1`` rows before it, per ``keys`` in ``order``.

    ``bucket`` must never decrease along ``order``; its NULLs stand where ``nulls_first`` says. The rows are
    shuffled once, by bucket and key, and written out. Only the first ``size - 1`` rows of a bucket lack
    rows, the last ones of the buckets before it, so only these few are joined.
    """
    within = Window.partitionBy("_bucket", *keys).orderBy(*order)
    frame = within.rowsBetween(-(size - 1), 0)
    local = df.withColumn("_bucket", bucket).withColumns(
        {"_local": F.row_number().over(within), sum_as: F.sum(value).over(frame), count_as: F.count(value).over(frame), "_more": F.lead(F.lit(True), size - 1).over(within)}
    )
    rows = pinned(local)
    place = F.struct("_bucket", *keys)
    ends = rows.filter(F.col("_more").isNull()).groupBy(place.alias("_k")).agg(F.sort_array(F.collect_list(F.struct("_local", F.col(value).alias("v")))).alias("_ends"))
    along = F.col("_k._bucket").asc_nulls_first() if nulls_first else F.col("_k._bucket").asc_nulls_last()
    across = Window.partitionBy(*(F.col(f"_k.{k}") for k in keys)).orderBy(along).rowsBetween(-(size - 1), -1)
    before = ends.select("_k", F.reverse(F.flatten(F.collect_list("_ends").over(across))).alias("_before"))  # the nearest row first
    missing = F.filter(F.slice("_before", 1, F.lit(size) - F.col("_local")), lambda r: r["v"].isNotNull())
    total = F.col(count_as) + F.size(missing)
    added = F.coalesce(F.col(sum_as), F.lit(0)) + F.aggregate(missing, F.lit(0).cast(local.schema[sum_as].dataType), lambda a, r: a + r["v"])
    first = rows.filter(F.col("_local") < size).withColumn("_k", place).join(before, "_k")
    filled = first.withColumns({sum_as: F.when(total > 0, added).cast(local.schema[sum_as].dataType), count_as: total.cast("long")}).select(*rows.columns)
    return rows.filter(F.col("_local") >= size).unionByName(filled).drop("_bucket", "_local", "_more")


def top_rows(df: DataFrame, keys: list[str], order: list, n: int, as_: str | None = None) -> DataFrame:
    """The first ``n`` rows per key.

    Spark cuts every group to ``n`` rows before the shuffle, so a hot key sends at most
    ``n`` rows per map task.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col("_rank") <= n)
    return kept.withColumnRenamed("_rank", as_) if as_ else kept.drop("_rank")


def best_by(value: str, measure: str) -> Column:
    """Aggregate giving (largest measure, its value); ties go to the smallest value.

    Unlike ``ROW_NUMBER() = 1`` this combines on the map side.
    """
    best = F.min(F.struct((-F.col(measure)).alias("m"), F.col(value).alias("v")))
    return F.struct((-best["m"]).alias(measure), best["v"].alias(value))


def _with_bucket(df: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    """Key and bucket as one struct column; a struct is never NULL itself, so NULL keys join like others."""
    return df.withColumn("_k", F.struct(*keys, bucket.alias("_bucket")))
