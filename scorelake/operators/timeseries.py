"""Analyses over long-format series: one row per (series, time, value)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.functions.dates import bucket_date, chart_parts, one_year_before
from scorelake.operators.positions import lag_in_groups


def bucket_average(df: DataFrame, unit: str, day: str, value: str, bucket_as: str, value_as: str, distinct: dict[str, str] | None = None, digits: int = 2) -> DataFrame:
    """Rounded average per month or week, optionally with distinct counts such as reporting stations."""
    extra = [F.count_distinct(F.col(c)).alias(name) for c, name in (distinct or {}).items()]
    return df.groupBy(bucket_date(unit, F.col(day)).alias(bucket_as)).agg(
        F.round(F.avg(value), digits).alias(value_as), *extra
    )


def with_chart_parts(df: DataFrame, day: str, season: tuple[int, int] = (6, 11)) -> DataFrame:
    return df.withColumns(chart_parts(F.col(day), season))


def series_extract(df: DataFrame, series: str, names: list[str], day: str, first: str, after_last: str) -> DataFrame:
    """Rows of some series in a half-open date range, sorted by series and time."""
    return df.filter(F.col(series).isin(names) & between_dates(day, first, after_last)).orderBy(series, day)


def between_dates(day: str, first: str, after_last: str) -> Column:
    """Half-open range with plain literals, so that it reaches the parquet scan."""
    return (F.col(day) >= F.lit(first).cast("timestamp_ntz")) & (F.col(day) < F.lit(after_last).cast("timestamp_ntz"))


def returns(df: DataFrame, series: str, day: str, value: str, bucket: Column, as_: str, ties: tuple[str, ...] = ()) -> DataFrame:
    """Relative change against the previous observation of the same series; ``ties`` order observations of one time."""
    lagged = lag_in_groups(df, [series], [day, *ties], value, bucket, "_previous")
    change = F.col(value) / F.nullif(F.col("_previous"), F.lit(0)) - 1
    return lagged.withColumn(as_, change).drop("_previous")


def weekly_volatility(df: DataFrame, series: str, day: str, value: str, bucket: Column, min_rows: int = 3, ties: tuple[str, ...] = ()) -> DataFrame:
    """Sample deviation of returns per week, in percent; weeks with few observations are left out."""
    changes = returns(df, series, day, value, bucket, "_return", ties).filter(F.col("_return").isNotNull())
    return (
        changes.groupBy(bucket_date("week", F.col(day)).alias("week_start"), F.col(series))
        .agg(F.round(F.stddev_samp("_return") * 100, 4).alias("volatility_pct"), F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") >= min_rows)
        .drop("_n")
    )


def year_over_year(df: DataFrame, day: str, value: str, as_: str, digits: int = 2) -> DataFrame:
    """Percent change against the same day one year earlier, by a shifted self join."""
    now = df.select(F.col(day), F.col(value).alias("_now"), one_year_before(F.col(day)).alias("_then_day"))
    then = df.select(F.col(day).alias("_then_day"), F.col(value).alias("_then"))
    change = F.round((F.col("_now") / F.nullif(F.col("_then"), F.lit(0)) - 1) * 100, digits)
    return now.join(then, "_then_day").select(day, change.alias(as_))


def align_outer(left: DataFrame, right: DataFrame, day: str) -> DataFrame:
    """Two series side by side on all dates of either."""
    other = right.withColumnRenamed(day, "_day")
    return (
        left.join(other, F.col(day) == F.col("_day"), "full")
        .withColumn(day, F.coalesce(F.col(day), F.col("_day")))
        .drop("_day")
    )


def attach_correlation(df: DataFrame, x: str, y: str, as_: str = "pearson_corr") -> DataFrame:
    """Pearson correlation of the whole result on each row, as a scalar subquery instead of an unpartitioned window."""
    return df.withColumn(as_, df.agg(F.corr(x, y)).scalar())


def above(df: DataFrame, rate: str, reference: str, as_: str) -> DataFrame:
    return df.withColumn(as_, F.col(rate) > F.col(reference))


def values_on(df: DataFrame, day: str, dates: DataFrame) -> DataFrame:
    """Rows on the given dates, with the labels that belong to them."""
    return df.join(dates, day)


def split_series(df: DataFrame, series: Column) -> DataFrame:
    """The series key as its own column, so that a consumer can draw one line per key."""
    return df.withColumn("series", series)
