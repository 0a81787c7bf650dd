"""Tables laid out by several columns at once along a space-filling curve, and lookups by bloom filters.

A range layout prunes by its leading column alone. Here every column is cut into equally full
ranges, the bits of the range numbers are interleaved, and the table is range-partitioned by
the interleaved number: a filter on any of the columns leaves a small share of the files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_RANGE = 24  # expected rows of the sample at the driver, per range of a column
MOST_BITS = 10  # of a range number: 1,024 ranges a column


def _range_starts(sample: list, bits: int) -> list:
    """Where the ranges after the first begin: values that cut a sorted sample into equal parts."""
    known = sorted(v for v in sample if v is not None)
    return [known[len(known) * i >> bits] for i in range(1, 1 << bits)] if known else []


def _range_number(column: Column, starts: list, kind: str, bits: int) -> Column:
    """How many ranges begin at or before the value, by halving steps; 0 for NULL."""
    if not starts:
        return F.lit(0)
    known = F.array(*map(F.lit, starts)).cast(f"array<{kind}>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(bits))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(known, at + step - 1) <= column, step).otherwise(0))


def with_curve_key(df: DataFrame, columns: list[str], bits: int, name: str = "_curve") -> DataFrame:
    """The table with the place of each row on the curve through ``columns``.

    The ranges come from a sample of some 24 rows a range, whatever the table's size; they decide
    the layout only, never which rows are kept.
    """
    rows = df.count()
    share = min(1.0, SAMPLE_PER_RANGE * (1 << bits) / max(rows, 1))
    sample = df.select(*columns).sample(share, seed=7).collect()
    kinds = dict(df.dtypes)
    numbers = [f"{name}_{i}" for i in range(len(columns))]
    for i, (number, column) in enumerate(zip(numbers, columns, strict=True)):
        df = df.withColumn(number, _range_number(F.col(column), _range_starts([r[i] for r in sample], bits), kinds[column], bits))
    width = len(columns)
    spread = [
        F.shiftleft(F.shiftright(number, b).bitwiseAND(F.lit(1)).cast("long"), b * width + width - 1 - i)
        for i, number in enumerate(numbers) for b in range(bits)
    ]
    return df.withColumn(name, reduce(Column.bitwiseOR, spread)).drop(*numbers)


def curve_layout(df: DataFrame, columns: list[str], files: int) -> DataFrame:
    """Range-partition along the curve into ``files`` parts of about equal size.

    Rows of one place on the curve, however many, may be split over several parts.
    """
    bits = min(MOST_BITS, 62 // len(columns), max(1, -(-(files - 1).bit_length() // len(columns)) + 2))
    placed = with_curve_key(df, columns, bits).withColumn("_row", F.monotonically_increasing_id())
    return placed.repartitionByRange(files, "_curve", "_row").sortWithinPartitions("_curve").drop("_curve", "_row")


def bloom_options(columns: list[str], rows: int) -> dict[str, str]:
    """Writer options for a bloom filter on each column, sized for ``rows`` distinct values a file."""
    sized = {f"parquet.bloom.filter.expected.ndv#{c}": str(max(rows, 1)) for c in columns}
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns} | sized


def files_holding(df: DataFrame) -> DataFrame:
    """The files that the rows of a (filtered) table come from, with the rows of each."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
