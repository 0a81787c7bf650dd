"""Analytical questions over gold tables and marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.fixed_values import NONE, UNKNOWN, VALID
from scorelake.functions.casts import percent, ratio
from scorelake.functions.dates import hierarchy_parts, within_days
from scorelake.plans.gold import DOCUMENT


def top_strike_rates(performance: DataFrame, n: int = 10, min_balls: int = 20) -> DataFrame:
    return (
        performance.filter((F.col("balls_faced") >= min_balls) & (F.col("strike_rate") > 0))
        .select("player_name", "country", "balls_faced", "runs_scored", "strike_rate", "boundaries_4", "boundaries_6", "form_status")
        .orderBy(F.col("strike_rate").desc_nulls_first(), "player_name", "country", "balls_faced", "runs_scored", "boundaries_4", "boundaries_6", "form_status")
        .limit(n)
    )


def top_economies(performance: DataFrame, n: int = 10, min_balls: int = 10) -> DataFrame:
    return (
        performance.filter((F.col("balls_bowled") >= min_balls) & (F.col("bowling_econ") > 0))
        .select("player_name", "country", "balls_bowled", "runs_conceded", "wickets_taken", "bowling_econ", "dot_balls_bowled", "form_status")
        .orderBy(F.col("bowling_econ").asc_nulls_last(), "player_name", "country", "balls_bowled", "runs_conceded", "wickets_taken", "dot_balls_bowled", "form_status")
        .limit(n)
    )


def team_wins(matches: DataFrame) -> DataFrame:
    """Wins per team with their share of all matches; matches without a winner count in the whole only."""
    everything = matches.agg(F.count(F.lit(1))).scalar()
    return (
        matches.filter(~F.col("winner").isin(NONE, UNKNOWN))
        .groupBy("winner")
        .agg(
            F.count(F.lit(1)).alias("matches_won"),
            F.avg("margin_value").alias("avg_winning_margin"),
            F.min("event_date").alias("first_win_date"),
            F.max("event_date").alias("last_win_date"),
        )
        .select("winner", "matches_won", percent(F.col("matches_won"), everything).alias("win_percentage"), "avg_winning_margin", "first_win_date", "last_win_date")
        .orderBy(F.col("matches_won").desc_nulls_first(), "winner")
    )


def performance_by_match_type(performance: DataFrame, n: int = 30) -> DataFrame:
    return (
        performance.filter(F.col("role_type").isin("Batter", "Bowler", "All-rounder"))
        .select("player_name", "match_type_number", "role_type", "matches_count", "batting_avg", "strike_rate", "bowling_econ", "wickets_taken")
        .orderBy(F.col("matches_count").desc_nulls_first(), F.col("batting_avg").desc_nulls_first(), "player_name", "match_type_number", "role_type", "strike_rate", "bowling_econ", "wickets_taken")
        .limit(n)
    )


def daily_summary(summary: DataFrame, days: int | None = 30, as_of=None) -> DataFrame:
    recent = summary if days is None else summary.filter(within_days(F.col("event_date"), days, as_of))
    return (
        recent.groupBy("event_date")
        .agg(
            F.count(F.lit(1)).alias("matches_played"),
            F.sum("total_deliveries").alias("total_balls_played"),
            F.round(ratio(F.sum("total_runs_scored") * 6, F.sum("total_deliveries")), 2).alias("run_rate"),
            F.sum("total_boundaries_4").alias("total_fours"),
            F.sum("total_boundaries_6").alias("total_sixes"),
            F.count_distinct("first_team").alias("teams_participated"),
        )
        .orderBy(F.col("event_date").desc_nulls_first())
    )


def team_delivery_stats(deliveries: DataFrame) -> DataFrame:
    return (
        deliveries.groupBy("team_name")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.sum("runs").alias("total_runs"),
            percent(F.sum("runs"), F.count(F.lit(1))).alias("avg_runs_per_delivery"),
            F.sum("boundary_4_count").alias("fours"),
            F.sum("boundary_6_count").alias("sixes"),
            F.sum("dot_ball_count").alias("dot_balls"),
            F.sum("wicket_flag").alias("wickets_lost"),
        )
        .orderBy(F.col("total_runs").desc_nulls_first(), "team_name")
    )


def player_match_counts(silver_players: DataFrame) -> DataFrame:
    return (
        silver_players.filter((F.col("data_quality_status") == VALID) & (F.col("player_name") != UNKNOWN))
        .groupBy("player_name", "country")
        .agg(F.count_distinct("match_type_number").alias("matches"))
        .orderBy(F.col("matches").desc_nulls_first(), "player_name", "country")
    )


def runs_per_ball_by_team(silver_deliveries: DataFrame) -> DataFrame:
    return (
        silver_deliveries.filter(F.col("data_quality_status") == VALID)
        .groupBy("team_name")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.sum("runs").alias("total_runs"),
            F.round(ratio(F.sum("runs"), F.count(F.lit(1))), 2).alias("avg_runs_per_ball"),
        )
        .orderBy(F.col("total_runs").desc_nulls_first(), "team_name")
    )


def match_timeline(silver_matches: DataFrame) -> DataFrame:
    return (
        silver_matches.filter(F.col("data_quality_status") == VALID)
        .groupBy("event_year", "event_month")
        .agg(F.count(F.lit(1)).alias("matches"), F.round(F.avg("won_by_runs"), 1).alias("avg_winning_runs_margin"))
        .orderBy(F.col("event_year").desc_nulls_first(), F.col("event_month").desc_nulls_first())
    )


def daily_performance(matches: DataFrame, deliveries: DataFrame, performance: DataFrame, days: int | None = 7, as_of=None) -> DataFrame:
    """Matches, teams, runs per ball, flags and the best form label per day.

    The performance table is reduced to one label per batter before the join, so it cannot
    multiply deliveries.
    """
    recent = matches if days is None else matches.filter(within_days(F.col("event_date"), days, as_of))
    form = performance.groupBy("player_name").agg(F.max("form_status").alias("form_status"))
    per_batter = deliveries.groupBy(*DOCUMENT, "batter").agg(
        F.count(F.lit(1)).alias("balls"),
        *(F.sum(c).alias(c) for c in ("runs", "boundary_4_count", "boundary_6_count", "dot_ball_count")),
    )
    rows = recent.join(per_batter, DOCUMENT).join(form, F.col("batter") == F.col("player_name"), "left")
    return (
        rows.groupBy("event_date")
        .agg(
            F.count_distinct(*DOCUMENT).alias("matches_played"),
            (F.count_distinct("first_team") + F.count_distinct("second_team")).alias("teams_involved"),
            F.round(ratio(F.sum("runs"), F.sum("balls")), 2).alias("avg_runs_per_ball"),
            F.sum("boundary_4_count").alias("total_fours"),
            F.sum("boundary_6_count").alias("total_sixes"),
            F.sum("dot_ball_count").alias("total_dots"),
            F.max("form_status").alias("top_performers_form"),
        )
        .orderBy(F.col("event_date").desc_nulls_first())
    )


def rows_and_balls_per_over(flattened: DataFrame, ball: list[str]) -> DataFrame:
    """Rows of a flatten against distinct parents, which shows its fan-out."""
    return flattened.groupBy("over").agg(
        F.count(F.lit(1)).alias("raw_delivery_rows"), F.count_distinct(*(F.col(c) for c in ball)).alias("distinct_deliveries")
    )


def boundary_count(deliveries: DataFrame, player: Column | str) -> DataFrame:
    return deliveries.filter(F.col("batter") == player).agg(
        F.sum(F.col("boundary_4_count") + F.col("boundary_6_count")).alias("boundary_count")
    )


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).distinct()


def last_load(df: DataFrame, loaded_at: str) -> DataFrame:
    return df.agg(F.max(loaded_at).alias("last_load"), F.count(F.lit(1)).alias("record_count"))


def date_rollup(df: DataFrame, day: str, measures: dict[str, Column]) -> DataFrame:
    """Totals on every level of year > quarter > month > day; NULL marks the levels added up."""
    parts = hierarchy_parts(F.col(day))
    staged = df.select("*", *(parts[p].alias(f"_{p}") for p in ("year", "quarter", "month_no", "day")))
    rolled = staged.rollup("_year", "_quarter", "_month_no", "_day").agg(
        F.grouping_id().alias("level"), *(expr.alias(name) for name, expr in measures.items())
    )
    return rolled.select(
        F.col("_year").alias("year"), F.col("_quarter").alias("quarter"), F.col("_month_no").alias("month_no"), F.col("_day").alias("day"),
        F.col("level").cast("int").alias("level"), *measures,
    )
