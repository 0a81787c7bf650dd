"""The queries behind the dashboard pages, over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How each fact column is summarised by default on a visual.
_SUMS = [
    "total_overs", "balls_per_over",
    *(
        f"{measure}_by_team_{side}"
        for side in ("a", "b")
        for measure in ("overs_played", "bowls_played", "extra_bowls_played", "extra_runs_scored", "fours", "sixes", "total_score", "wicket_lost")
    ),
]
DEFAULT_SUMMARY = {
    "match_fact": {
        **{c: "sum" for c in _SUMS},
        **{c: "count" for c in ("referee_id", "team_a_id", "team_b_id", "toss_winner_team_id", "winner_team_id")},
    },
    "delivery_fact": {
        **{c: "sum" for c in ("over", "runs", "extra_runs")},
        **{c: "count" for c in ("bowler_id", "batter_id", "non_striker_id")},
    },
}
_AGGREGATES = {"sum": F.sum, "count": F.count, "distinct": F.count_distinct, "first": F.min}


def summarise(df: DataFrame, table: str, by: list[str], columns: list[str] | None = None, registry: dict | None = None) -> DataFrame:
    """Group by ``by`` and apply each column's default summary."""
    registry = (registry or DEFAULT_SUMMARY)[table]
    chosen = columns or [c for c in registry if c in df.columns]
    return df.groupBy(*by).agg(*(_AGGREGATES[registry[c]](F.col(c)).alias(f"{registry[c]}_{c}") for c in chosen))


def team_of_matches(match_fact: DataFrame, delivery_fact: DataFrame, team_dim: DataFrame) -> DataFrame:
    """Each match with every team that batted in it, through the delivery fact."""
    bridge = delivery_fact.select("match_id", "team_id").distinct()
    return bridge.join(team_dim, "team_id").join(match_fact, "match_id")


def team_match_counts(bridged: DataFrame) -> DataFrame:
    return (
        bridged.groupBy("team_name")
        .agg(F.count("match_id").alias("match_count"), F.count("match_result").alias("result_count"))
        .orderBy(F.col("match_count").desc_nulls_first(), "team_name")
    )


def player_ball_counts(delivery_fact: DataFrame, match_fact: DataFrame, player_dim: DataFrame) -> DataFrame:
    """Per player, distinct balls-per-over and extra-ball values of the matches of the player's team."""
    teams = delivery_fact.select("match_id", "team_id").distinct()
    measures = match_fact.select("match_id", "balls_per_over", "extra_bowls_played_by_team_a")
    per_team = teams.join(measures, "match_id").select("team_id", "balls_per_over", "extra_bowls_played_by_team_a").distinct()
    return (
        player_dim.join(per_team, "team_id")
        .groupBy("player_name")
        .agg(F.count_distinct("balls_per_over").alias("balls_per_over_count"), F.count_distinct("extra_bowls_played_by_team_a").alias("extra_bowls_count"))
        .orderBy(F.col("balls_per_over_count").desc_nulls_first(), F.col("extra_bowls_count").desc_nulls_first(), "player_name")
    )


def slice_by(df: DataFrame, **chosen) -> DataFrame:
    """Keep rows whose columns are among the chosen values, as slicers and filters do."""
    for column, values in chosen.items():
        df = df.filter(F.col(column).isin(list(values)))
    return df


def team_table(bridged: DataFrame, venue_dim: DataFrame) -> DataFrame:
    rows = bridged.join(venue_dim.select("venue_id", "city"), "venue_id")
    columns = ["team_name", "team_a_id", "team_b_id", "toss_winner_team_id", "city"]
    return rows.select(*columns).distinct().orderBy(F.col("city").desc_nulls_first(), *columns[:4])


def match_table(bridged: DataFrame, venue_dim: DataFrame) -> DataFrame:
    rows = bridged.join(venue_dim.select("venue_id", "venue_name"), "venue_id")
    columns = ["match_id", "team_name", "team_a_id", "team_b_id", "toss_winner_team_id", "venue_name"]
    return rows.select(*columns).distinct().orderBy(F.col("team_a_id").desc_nulls_first(), *(c for c in columns if c != "team_a_id"))


def team_cities(bridged: DataFrame, venue_dim: DataFrame) -> DataFrame:
    return bridged.join(venue_dim.select("venue_id", "city"), "venue_id").select("team_name", "city").distinct()


def first_team(team_dim: DataFrame) -> DataFrame:
    return team_dim.agg(F.min("team_name").alias("first_team_name"))


def match_choices(match_fact: DataFrame) -> DataFrame:
    return match_fact.select("match_id").distinct().orderBy("match_id")


def date_choices(match_fact: DataFrame, date_dim: DataFrame, first: Column | str | None = None, last: Column | str | None = None) -> DataFrame:
    """Dates in ascending order with their distinct count, optionally within a range."""
    rows = match_fact.join(date_dim.select("date_id", "full_dt"), "date_id")
    if first is not None:
        rows = rows.filter(F.col("full_dt") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col("full_dt") <= F.lit(last).cast("date"))
    return rows.groupBy("full_dt").agg(F.count_distinct("full_dt").alias("dates")).orderBy("full_dt")


def on_calendar(df: DataFrame, day: str, calendar: DataFrame) -> DataFrame:
    """Join to a calendar on the date part."""
    return df.join(calendar, F.col(day).cast("date") == F.col("date"))
