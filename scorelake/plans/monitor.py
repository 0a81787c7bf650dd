"""Run log, counts, freshness, reconciliation and alerts."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorelake.fixed_values import ALERT_THRESHOLDS, RUN_MARKS, SLA_LABELS, STALE_MINUTES, VALID
from scorelake.functions.ball import freshness_class
from scorelake.functions.dates import as_of_literal, minutes_between, within_hours

RUN_LOG = (
    "task_name string, execution_ts timestamp_ntz, status string, rows_processed long, rows_affected long, "
    "dynamic_table_lag_minutes long, stream_lag_hours double, data_quality_score double, records_checked long, "
    "error_message string, duration_seconds long"
)


def stack(parts: list[DataFrame]) -> DataFrame:
    """``UNION ALL`` by column name."""
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@dataclass
class StepResult:
    """What a stage tells about itself; ``affected`` is ``rows`` where it is not given."""

    rows: int | None = None
    affected: int | None = None
    checked: int | None = None
    score: float | None = None
    lag_minutes: int | None = None
    stream_lag_hours: float | None = None
    status: str = "SUCCESS"


def log_row(spark, task: str, result: StepResult, error: str | None = None, seconds: int = 0, as_of=None) -> DataFrame:
    affected = result.rows if result.affected is None else result.affected
    values = (task, result.status, result.rows, affected, result.lag_minutes, result.stream_lag_hours, result.score, result.checked, error, seconds)
    typed = [part for part in RUN_LOG.split(", ") if not part.startswith("execution_ts")]
    names = [part.split()[0] for part in RUN_LOG.split(", ")]
    return spark.createDataFrame([values], ", ".join(typed)).withColumn("execution_ts", as_of_literal(as_of)).select(*names)


def logged(lake, task: str, step, log: str = "run_log"):
    """Run one stage and log it; a failure is logged and raised again.

    ``step`` returns a ``StepResult``, or the number of rows it handled, or None. What the stage
    wrote is in ``lake.counts`` when it ends.
    """
    started = time.time()
    lake.counts.reset()
    try:
        found = step()
    except Exception as error:
        lake.append(log, log_row(lake.spark, task, StepResult(status="FAILED"), str(error), int(time.time() - started)))
        raise
    result = found if isinstance(found, StepResult) else StepResult(found)
    lake.append(log, log_row(lake.spark, task, result, seconds=int(time.time() - started)))
    return result.rows


def recent_runs(log: DataFrame, n: int = 20, as_of=None) -> DataFrame:
    return (
        log.select("task_name", "execution_ts", "status", "rows_processed", "duration_seconds",
                   minutes_between(F.col("execution_ts"), as_of_literal(as_of)).alias("minutes_ago"))
        .orderBy(F.col("execution_ts").desc_nulls_first(), "task_name")
        .limit(n)
    )


def failed_runs(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == "FAILED").orderBy(F.col("execution_ts").desc_nulls_first(), "task_name")


def task_status(log: DataFrame, hours: int | None = 24, as_of=None) -> DataFrame:
    """Status of the last run of each task."""
    recent = log if hours is None else log.filter(within_hours(F.col("execution_ts"), hours, as_of))
    last = recent.groupBy("task_name").agg(F.max(F.struct("execution_ts", "status", "duration_seconds")).alias("last"))
    return last.select(
        "task_name",
        F.col("last.execution_ts").alias("last_run"),
        F.when(F.col("last.status") == "SUCCESS", RUN_MARKS[0]).otherwise(RUN_MARKS[1]).alias("status"),
        minutes_between(F.col("last.execution_ts"), as_of_literal(as_of)).alias("minutes_since_run"),
        F.col("last.duration_seconds").alias("duration_seconds"),
    ).orderBy(F.col("last_run").desc_nulls_first(), "task_name")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    return stack([df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()])


def quality_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and quality status."""
    return stack([
        df.groupBy("data_quality_status").agg(F.count(F.lit(1)).alias("record_count")).select(F.lit(name).alias("table_name"), "data_quality_status", "record_count")
        for name, df in tables.items()
    ])


def quality_shares(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer and status with their percent of the layer."""
    counts = quality_report(layers).withColumnRenamed("table_name", "layer")
    whole = F.sum("record_count").over(Window.partitionBy("layer"))
    return counts.withColumn("pct", F.round(F.col("record_count") * 100.0 / whole, 1)).orderBy("layer", "data_quality_status")


def freshness(tables: dict[str, tuple[DataFrame, str]], as_of=None, lag: str | None = "query_refresh_lag_minutes") -> DataFrame:
    """Last load, minutes since, and average recorded lag per table."""
    now = as_of_literal(as_of)
    parts = []
    for name, (df, loaded_at) in tables.items():
        average = F.round(F.avg(lag), 1) if lag and lag in df.columns else F.lit(None).cast("double")
        parts.append(
            df.agg(F.count(F.lit(1)).alias("record_count"), F.max(loaded_at).alias("last_refresh"), average.alias("avg_lag_minutes"))
            .select(F.lit(name).alias("layer"), "record_count", "last_refresh",
                    minutes_between(F.col("last_refresh"), now).alias("minutes_since_refresh"), "avg_lag_minutes")
        )
    return stack(parts)


def freshness_lights(tables: dict[str, tuple[DataFrame, str]], as_of=None) -> DataFrame:
    report = freshness(tables, as_of, lag=None)
    return report.select("layer", "record_count", "last_refresh", F.col("minutes_since_refresh").alias("lag_minutes"),
                         freshness_class(F.col("minutes_since_refresh")).alias("freshness_status"))


def fresh_enough(last: Column, now: Column, limit_minutes: int = STALE_MINUTES) -> Column:
    """Whether the last load is at most ``limit_minutes`` old; without any load there is no age to exceed."""
    return ~F.coalesce(minutes_between(last, now) > limit_minutes, F.lit(False))


def healthy(df: DataFrame, loaded_at: str, limit_minutes: int = STALE_MINUTES, as_of=None) -> DataFrame:
    """One boolean for the table: see ``fresh_enough``."""
    return df.agg(F.max(loaded_at).alias("last")).select(fresh_enough(F.col("last"), as_of_literal(as_of), limit_minutes).alias("healthy"))


def check_data_freshness(df: DataFrame, loaded_at: str, limit_minutes: int = STALE_MINUTES, as_of=None) -> bool:
    return healthy(df, loaded_at, limit_minutes, as_of).first()[0]


def retention(stages: dict[str, DataFrame]) -> DataFrame:
    """Row counts along the layers and the percent kept from each stage to the next.

    The window runs over one row per stage.
    """
    counts = stack([
        df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(i).alias("_order"), F.lit(name).alias("stage"), "cnt")
        for i, (name, df) in enumerate(stages.items())
    ])
    previous = F.lag("cnt").over(Window.orderBy("_order"))
    return counts.withColumn("prev_cnt", previous).select(
        "stage", "cnt", "prev_cnt", F.round(F.col("cnt") * 100.0 / F.nullif(F.col("prev_cnt"), F.lit(0)), 1).alias("retention_pct")
    )


def valid_only(df: DataFrame) -> DataFrame:
    return df.filter(F.col("data_quality_status") == VALID)


def latency(bronze: DataFrame, silver: DataFrame, gold: DataFrame, limit_minutes: int = STALE_MINUTES) -> DataFrame:
    """Lag between the layers and whether the whole way met its limit; each side is a one-row subquery."""
    b = bronze.agg(F.max("ingestion_ts")).scalar()
    s = silver.agg(F.max("silver_load_ts")).scalar()
    g = gold.agg(F.max("gold_load_ts")).scalar()
    times = bronze.sparkSession.range(1).select(b.alias("b"), s.alias("s"), g.alias("g"))
    lags = times.select(
        minutes_between(F.col("b"), F.col("s")).alias("bronze_to_silver_lag_min"),
        minutes_between(F.col("s"), F.col("g")).alias("silver_to_gold_lag_min"),
        minutes_between(F.col("b"), F.col("g")).alias("end_to_end_lag_min"),
    )
    return lags.withColumn("sla_status", F.when(F.col("end_to_end_lag_min") <= limit_minutes, SLA_LABELS[0]).otherwise(SLA_LABELS[1]))


def mart_validation(required: dict[str, DataFrame], others: dict[str, DataFrame]) -> DataFrame:
    """SUCCESS when no required table is empty, with the rows of all tables."""
    counts = row_counts({**required, **others}).withColumn("_required", F.col("table_name").isin(list(required)))
    return counts.agg(
        F.when(F.min(F.when(F.col("_required"), F.col("row_count"))) > 0, "SUCCESS").otherwise("WARNING").alias("status"),
        F.sum("row_count").alias("rows_processed"),
    )


def alerts(metrics: DataFrame) -> DataFrame:
    """Metrics (``metric``, ``value``) beyond their threshold."""
    pairs = [part for name, limit in ALERT_THRESHOLDS.items() for part in (F.lit(name), F.lit(limit))]
    limits = F.create_map(*pairs)
    return metrics.withColumn("threshold", limits[F.col("metric")]).withColumn("alert", F.col("value") > F.col("threshold"))


def log_metrics(log: DataFrame) -> DataFrame:
    """Longest run and failed runs as alert metrics."""
    one = log.agg(F.max("duration_seconds").cast("double").alias("task_duration_seconds"), F.count_if(F.col("status") == "FAILED").cast("double").alias("failed_runs"))
    return one.unpivot([], ["task_duration_seconds", "failed_runs"], "metric", "value")


def layer_metrics(quality: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Percent of invalid rows, and of rows lost between two tables."""
    invalid = quality.agg(F.count_if(F.col("data_quality_status") != VALID) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))).scalar()
    n_before, n_after = before.agg(F.count(F.lit(1))).scalar(), after.agg(F.count(F.lit(1))).scalar()
    one = quality.sparkSession.range(1).select(
        invalid.cast("double").alias("invalid_pct"),
        ((n_before - n_after) * 100.0 / F.nullif(n_before, F.lit(0))).cast("double").alias("row_drop_pct"),
    )
    return one.unpivot([], ["invalid_pct", "row_drop_pct"], "metric", "value")


def invalid_rows(df: DataFrame, n: int | None = None) -> DataFrame:
    rows = df.filter(F.col("data_quality_status") != VALID)
    return rows if n is None else rows.limit(n)
