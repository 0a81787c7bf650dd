"""Ball-level measures and small classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scorelake.fixed_values import FRESH_MINUTES, FRESHNESS_LABELS, NONE, STALE_MINUTES


def flag(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def six_over_block(over: Column) -> Column:
    """Number of the six-over block, 0 for over 0."""
    return F.when(over > 0, F.floor((over - 1) / 6).cast("int") + 1).otherwise(F.lit(0))


def ball_flags(runs: Column, extras: Column, player_out: Column) -> dict[str, Column]:
    return {
        "boundary_4_count": flag(runs == 4),
        "boundary_6_count": flag(runs == 6),
        "dot_ball_count": flag((runs == 0) & (extras == 0)),
        "wicket_flag": flag(player_out != NONE),
    }


def margin_type(won_by_runs: Column, won_by_wickets: Column) -> Column:
    return F.when(won_by_runs > 0, "runs").when(won_by_wickets > 0, "wickets").otherwise("tie/super_over")


def margin_value(won_by_runs: Column, won_by_wickets: Column) -> Column:
    """The number that belongs to the margin type; NULL without a margin."""
    return F.when(won_by_runs > 0, won_by_runs).when(won_by_wickets > 0, won_by_wickets)


def role_type(runs_scored: Column, wickets_taken: Column) -> Column:
    return (
        F.when((runs_scored > 0) & (wickets_taken > 0), "All-rounder")
        .when(runs_scored > 0, "Batter")
        .when(wickets_taken > 0, "Bowler")
        .otherwise("None")
    )


def form_status(batting_avg: Column, bowling_econ: Column, balls_bowled: Column) -> Column:
    """Economy counts only for players who bowled."""
    bowled = balls_bowled > 0
    return (
        F.when((batting_avg > 40) | (bowled & (bowling_econ < 7)), "Hot")
        .when((batting_avg > 30) | (bowled & (bowling_econ < 8)), "In-form")
        .otherwise("Struggling")
    )


def match_result(winner: Column, result: Column) -> Column:
    return (
        F.when(winner.isNotNull(), "Result Declared")
        .when(result == "tie", "Tie")
        .when(result == "no result", "No Result")
        .otherwise(result)
    )


def freshness_class(lag_minutes: Column) -> Column:
    fresh, stale, late = FRESHNESS_LABELS
    return F.when(lag_minutes <= FRESH_MINUTES, fresh).when(lag_minutes <= STALE_MINUTES, stale).otherwise(late)
