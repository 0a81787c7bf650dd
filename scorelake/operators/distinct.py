"""Exact distinct counts that roll up: bitmaps over dense ids, united level by level.

Counts of distinct members cannot be added over days; their bitmaps can be united. A value
gets a dense id once; a bitmap holds 32,768 ids, so a group has one row per 32,768 ids it
met, whatever its number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.operators.positions import number_rows


def dense_ids(values: DataFrame, column: str, as_: str = "id") -> DataFrame:
    """Each distinct value that is not NULL with a number from 0."""
    return number_rows(values.select(column).filter(F.col(column).isNotNull()).distinct(), [F.col(column)], as_, start=0)


def distinct_bitmaps(df: DataFrame, groups: list[str], ids: str) -> DataFrame:
    """groups, page, bits: which ids of a dense numbering each group met."""
    at = F.col(ids) + 1  # pages count from 1
    return df.groupBy(*groups, F.bitmap_bucket_number(at).alias("page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits"))


def rolled_up(bitmaps: DataFrame, groups: list[str]) -> DataFrame:
    """The bitmaps of coarser groups, which are columns of the finer ones."""
    return bitmaps.groupBy(*groups, "page").agg(F.bitmap_or_agg("bits").alias("bits"))


def distinct_counts(bitmaps: DataFrame, groups: list[str], as_: str) -> DataFrame:
    return bitmaps.groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(as_))
