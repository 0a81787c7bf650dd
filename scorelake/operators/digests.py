"""Reconciliation of two tables by keyed multiset digests.

Rows are dealt into buckets by key. A bucket's digest is its row count with two order-free
sums of row hashes, so equal contents give equal digests however the rows are stored, and
one lost and one doubled row do not cancel out. Only buckets whose digests differ are read
again, and only there are keys compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), *_nulls(keys), *keys), F.lit(buckets)).cast("int")


def _nulls(columns: list[str]) -> list[Column]:
    """Which columns are NULL: hashes pass over NULLs, so (NULL, 1) and (1, NULL) would be alike."""
    return [F.isnull(c) for c in columns]


def _digest(columns: list[str]) -> list[Column]:
    ordered = sorted(columns)
    hashes = [F.xxhash64(F.lit(seed), *_nulls(ordered), *ordered).cast("decimal(38,0)") for seed in (2, 3)]
    return [F.count(F.lit(1)).alias("rows"), *(F.sum(h).alias(name) for h, name in zip(hashes, ("one", "two"), strict=True))]


def bucket_digests(df: DataFrame, keys: list[str], buckets: int = 1024, columns: list[str] | None = None) -> DataFrame:
    """bucket, rows, one, two: mergeable, so the digests of parts of a table add up to those of the whole."""
    return df.groupBy(_bucket(keys, buckets).alias("bucket")).agg(*_digest(columns or df.columns))


def differing_buckets(left: DataFrame, right: DataFrame) -> DataFrame:
    """The buckets whose digests are not the same on both sides."""
    sides = left.withColumn("side", F.lit(1)).unionByName(right.withColumn("side", F.lit(-1)))
    net = sides.groupBy("bucket").agg(*(F.sum(F.col(c) * F.col("side")).alias(c) for c in ("rows", "one", "two")))
    return net.filter("rows <> 0 OR one <> 0 OR two <> 0").select("bucket")


def differences(source: DataFrame, target: DataFrame, keys: list[str], buckets: int = 1024, columns: list[str] | None = None) -> DataFrame:
    """keys, kind, source_rows, target_rows for every key whose rows differ: lost, added, repeated, dropped (fewer rows) or changed."""
    compared = columns or [c for c in source.columns if c in target.columns]
    differing = differing_buckets(bucket_digests(source, keys, buckets, compared), bucket_digests(target, keys, buckets, compared))
    suspects = [r.bucket for r in differing.collect()]  # at most ``buckets``
    of = lambda df, side: df.select(*compared).filter(_bucket(keys, buckets).isin(suspects)).groupBy(*keys).agg(*_digest(compared)).withColumn("side", F.lit(side))
    both = of(source, "s").unionByName(of(target, "t"))
    mine = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    held = both.groupBy(*keys).agg(
        F.coalesce(mine("s", "rows"), F.lit(0)).alias("source_rows"), F.coalesce(mine("t", "rows"), F.lit(0)).alias("target_rows"),
        *(mine(side, c).alias(f"{side}_{c}") for side in "st" for c in ("one", "two")),
    )
    s, t = F.col("source_rows"), F.col("target_rows")
    same = F.col("s_one").eqNullSafe(F.col("t_one")) & F.col("s_two").eqNullSafe(F.col("t_two"))
    kind = F.when(t == 0, "lost").when(s == 0, "added").when(t > s, "repeated").when(t < s, "dropped").otherwise("changed")
    return held.filter((s != t) | ~same).select(*keys, kind.alias("kind"), "source_rows", "target_rows")
