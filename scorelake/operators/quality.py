"""Rules, scores, gates and key checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.fixed_values import INVALID, SCORE_GATE_INVALID, SCORE_VALID, VALID
from scorelake.sources.tables import update_where


@dataclass(frozen=True)
class Rule:
    """A named condition every row should meet; NULL counts as a violation."""

    name: str
    holds: Column

    @property
    def broken(self) -> Column:
        return ~F.coalesce(self.holds, F.lit(False))


def any_broken(rules: list[Rule]) -> Column:
    condition = F.lit(False)
    for rule in rules:
        condition = condition | rule.broken
    return condition


def status_and_score(rules: list[Rule], invalid_score: float) -> dict[str, Column]:
    """VALID/INVALID and a score, from critical rules."""
    broken = any_broken(rules)
    return {
        "data_quality_status": F.when(broken, INVALID).otherwise(VALID),
        "data_quality_score": F.when(broken, F.lit(invalid_score)).otherwise(F.lit(SCORE_VALID)),
    }


def graded_score(critical: list[Rule], optional: list[Rule]) -> Column:
    """0.0 when a critical rule is broken, 0.5 when only an optional one is, else 1.0."""
    return F.when(any_broken(critical), F.lit(0.0)).when(any_broken(optional), F.lit(0.5)).otherwise(F.lit(1.0))


def valid_current(df: DataFrame) -> DataFrame:
    """Rows allowed into the next layer."""
    return df.filter(F.col("is_current_record") & (F.col("data_quality_status") == VALID))


def null_in(columns: list[str]) -> Column:
    condition = F.lit(False)
    for column in columns:
        condition = condition | F.col(column).isNull()
    return condition


def null_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: rows with a NULL in ``columns``, all rows, and their share."""
    bad, total = F.count_if(null_in(columns)), F.count(F.lit(1))
    return df.agg(
        bad.alias("null_rows"),
        total.alias("all_rows"),
        F.coalesce(bad / F.nullif(total, F.lit(0)), F.lit(0.0)).alias("null_share"),
    )


def apply_null_gate(df: DataFrame, columns: list[str], threshold: float, score: float | None = SCORE_GATE_INVALID) -> DataFrame:
    """Mark rows with NULLs as INVALID when their share exceeds ``threshold``.

    The share is a scalar subquery, so the decision is part of the plan and no row leaves the cluster.
    """
    share = null_share(df, columns).select("null_share").scalar()
    hit = null_in(columns) & (share > F.lit(threshold))
    changes = {"data_quality_status": F.lit(INVALID)}
    if score is not None:
        changes["data_quality_score"] = F.lit(score)
    return update_where(df, hit, changes)


def null_profile(df: DataFrame, columns: list[str], by: str, score: float | None = SCORE_GATE_INVALID) -> DataFrame:
    """Per storage bucket: rows, valid rows, rows with NULLs, and those of them a gate has not marked yet.

    Profiles of different buckets add up, so a load has to look at the buckets it wrote only.
    """
    marked = F.col("data_quality_status") == INVALID
    if score is not None:
        marked = marked & F.col("data_quality_score").eqNullSafe(F.lit(score))
    return df.groupBy(F.col(by).cast("string").alias(by)).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("data_quality_status") == VALID).alias("valid"),
        F.count_if(null_in(columns)).alias("null_rows"), F.count_if(null_in(columns) & ~F.coalesce(marked, F.lit(False))).alias("unmarked"),
    )


def mark_nulls(df: DataFrame, columns: list[str], score: float | None = SCORE_GATE_INVALID) -> DataFrame:
    """Mark all rows with NULLs in these columns as INVALID."""
    changes = {"data_quality_status": F.lit(INVALID)}
    if score is not None:
        changes["data_quality_score"] = F.lit(score)
    return update_where(df, null_in(columns), changes)


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column, how many rows are NULL."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    return counts.unpivot([], columns, "column_name", "null_rows")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-NULL key has no parent."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return child.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti").select(*child.columns)


def rule_violations(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Per rule, how many rows break it; one pass over the data."""
    counts = df.agg(*(F.count_if(rule.broken).alias(rule.name) for rule in rules))
    return counts.unpivot([], [rule.name for rule in rules], "rule", "violations")


def split_rejects(df: DataFrame, key: Column, reason: str, source: str, target: str) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected ones with source, target and reason."""
    rejects = df.filter(key.isNull()).withColumns(
        {"source_table": F.lit(source), "target_table": F.lit(target), "rejection_reason": F.lit(reason)}
    )
    return df.filter(key.isNotNull()), rejects
