"""Silver rows to the gold dimensions, fact and views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.fixed_values import MISSING_NUMBER
from scorelake.functions.ball import ball_flags, margin_type, margin_value, six_over_block
from scorelake.functions.dates import as_of_literal, minutes_between
from scorelake.operators.positions import number_in_groups
from scorelake.operators.quality import valid_current
from scorelake.session import pinned

# what tells one match document from another, whether it is numbered or not
DOCUMENT = ["stg_file_hashkey", "stg_file_row_number", "stg_file_name"]
PLAYER_VIEW = ["match_type_number", "country", "player_name"]
DELIVERY_VIEW = [
    "match_type_number", "team_name", "over", "bowler", "batter", "non_striker", "runs", "extras", "total", "extra_type",
    "player_out", "player_out_kind", "player_out_fielder", "review_by_team", "review_decision", "review_type",
]
MATCH_VIEW = [
    "match_type_number", "event_name", "match_number", "event_date", "event_year", "event_month", "event_day",
    "match_type", "season", "team_type", "overs", "city", "venue", "gender", "first_team", "second_team", "winner",
    "won_by_runs", "won_by_wickets", "player_of_match", "match_referee", "reserve_umpires", "tv_umpires",
    "first_umpire", "second_umpire", "toss_winner", "toss_decision",
]


def player_view(silver: DataFrame) -> DataFrame:
    return silver.select(*PLAYER_VIEW)


def delivery_view(silver: DataFrame) -> DataFrame:
    return silver.select(*DELIVERY_VIEW)


def match_view(silver: DataFrame) -> DataFrame:
    return silver.select(*MATCH_VIEW)


def register_views(players: DataFrame, deliveries: DataFrame, matches: DataFrame) -> None:
    player_view(players).createOrReplaceTempView("player")
    delivery_view(deliveries).createOrReplaceTempView("delivery")
    match_view(matches).createOrReplaceTempView("match")


def _audit(source: str, as_of) -> list[Column]:
    now = as_of_literal(as_of)
    return [
        F.col("ingestion_ts"),
        now.alias("gold_load_ts"),
        F.col("data_quality_status"),
        minutes_between(F.col("silver_load_ts"), now).alias("query_refresh_lag_minutes"),
        F.lit(source).alias("record_source"),
        F.lit(True).alias("is_latest"),
    ]


def player_dim(silver: DataFrame, as_of=None, name_prefix: int = 3) -> DataFrame:
    """One row per match and player, with the player's match count and rank in the country.

    Ranks number the distinct players of a country by name; names are bucketed by prefix,
    so one large country is ranked by many tasks. The distinct rows are read three times, so they are
    written out once.
    """
    rows = pinned(valid_current(silver).select(
        F.coalesce("match_type_number", F.lit(MISSING_NUMBER)).alias("match_type_number"),
        "country", "player_name", "ingestion_ts", "data_quality_status", "silver_load_ts",
    ).distinct())
    players = rows.groupBy("country", "player_name").agg(F.count_distinct("match_type_number").alias("matches_participated"))
    ranked = number_in_groups(
        players, ["country"], [F.col("player_name").asc()], F.substring("player_name", 1, name_prefix), "player_rank_in_country"
    )
    return rows.join(ranked, ["country", "player_name"]).select(
        "match_type_number", "country", "player_name", "matches_participated", "player_rank_in_country",
        *_audit("player", as_of),
    )


def delivery_fact(silver: DataFrame, as_of=None) -> DataFrame:
    flags = ball_flags(F.col("runs"), F.col("extras"), F.col("player_out"))
    return valid_current(silver).select(
        "match_type_number", "team_name", "over",
        six_over_block(F.col("over")).alias("session_id"),
        "bowler", "batter", "non_striker", "runs", "extras",
        *(value.alias(name) for name, value in flags.items()),
        "total", "extra_type", "player_out", "player_out_kind", "player_out_fielder",
        "review_by_team", "review_decision", "review_type", *DOCUMENT,
        *_audit("delivery", as_of),
    )


def match_dim(silver: DataFrame, as_of=None) -> DataFrame:
    runs, wickets = F.col("won_by_runs"), F.col("won_by_wickets")
    return valid_current(silver).select(
        *MATCH_VIEW[:19],
        margin_type(runs, wickets).alias("margin_type"),
        margin_value(runs, wickets).alias("margin_value"),
        "player_of_match", "match_referee", "toss_winner", "toss_decision", *DOCUMENT,
        *_audit("match", as_of),
    )
