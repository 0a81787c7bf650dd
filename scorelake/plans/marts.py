"""KPI marts over the gold layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorelake.fixed_values import VALID
from scorelake.functions.ball import form_status, role_type
from scorelake.functions.casts import ratio
from scorelake.functions.dates import as_of_literal
from scorelake.operators.positions import number_rows, rolling_sums
from scorelake.plans.gold import DOCUMENT
from scorelake.session import pinned
from scorelake.sources.tables import typed_empty

PLAYER_PERFORMANCE = (
    "player_name string, country string, match_type_number int, team_name string, matches_count long, balls_faced long, "
    "runs_scored long, batting_avg double, strike_rate double, boundaries_4 long, boundaries_6 long, wickets_taken long, "
    "balls_bowled long, runs_conceded long, bowling_econ double, dot_balls_bowled long, role_type string, "
    "rolling_5_match_avg double, form_status string, last_match_date date, ingestion_ts timestamp_ntz, "
    "gold_load_ts timestamp_ntz, data_quality_status string, query_refresh_lag_minutes long, record_source string, is_latest boolean"
)
MATCH_SUMMARY = (
    "match_summary_id long, event_date date, event_year int, event_month int, match_type string, venue string, "
    "first_team string, second_team string, toss_winner string, toss_decision string, winner string, margin_type string, "
    "margin_value int, player_of_match string, first_team_runs long, second_team_runs long, first_team_wickets long, "
    "second_team_wickets long, highest_wicket_taker string, wickets_taken long, highest_run_scorer string, runs_scored long, "
    "total_deliveries long, total_runs_scored long, total_boundaries_4 long, total_boundaries_6 long, total_dot_balls long, "
    "ingestion_ts timestamp_ntz, gold_load_ts timestamp_ntz, data_quality_status string, query_refresh_lag_minutes long, "
    "record_source string, is_latest boolean"
)


def empty_player_performance(spark) -> DataFrame:
    return typed_empty(spark, PLAYER_PERFORMANCE)


def empty_match_summary(spark) -> DataFrame:
    return typed_empty(spark, MATCH_SUMMARY)


def _audit(df: DataFrame, source: str, as_of) -> DataFrame:
    now = as_of_literal(as_of)
    return df.withColumns(
        {
            "ingestion_ts": now,
            "gold_load_ts": now,
            "data_quality_status": F.lit(VALID),
            "query_refresh_lag_minutes": F.lit(0).cast("long"),
            "record_source": F.lit(source),
            "is_latest": F.lit(True),
        }
    )


_PLAYER_MEASURES = [
    "balls_faced", "runs_scored", "boundaries_4", "boundaries_6", "balls_bowled", "runs_conceded", "wickets_taken", "dot_balls_bowled",
]


def batting_stats(deliveries: DataFrame) -> DataFrame:
    """Per batter, match and team: balls, runs, average, strike rate, boundaries."""
    balls, runs = F.col("balls_faced"), F.col("runs_scored")
    return (
        deliveries.groupBy(F.col("batter").alias("player_name"), "match_type_number", "team_name")
        .agg(
            F.count(F.lit(1)).alias("balls_faced"),
            F.sum("runs").alias("runs_scored"),
            F.sum("boundary_4_count").alias("boundaries_4"),
            F.sum("boundary_6_count").alias("boundaries_6"),
        )
        .withColumns({"batting_avg": F.round(ratio(runs, balls), 2), "strike_rate": F.round(ratio(runs * 100, balls), 2)})
    )


def bowling_stats(deliveries: DataFrame) -> DataFrame:
    """Per bowler, match and batting team: balls, runs conceded, economy, wickets, dot balls."""
    return (
        deliveries.groupBy(F.col("bowler").alias("player_name"), "match_type_number", "team_name")
        .agg(
            F.count(F.lit(1)).alias("balls_bowled"),
            F.sum(F.col("runs") + F.col("extras")).alias("runs_conceded"),
            F.sum("wicket_flag").alias("wickets_taken"),
            F.sum("dot_ball_count").alias("dot_balls_bowled"),
        )
        .withColumn("bowling_econ", F.round(ratio(F.col("runs_conceded") * 6, F.col("balls_bowled")), 2))
    )


def player_stats(deliveries: DataFrame, matches: DataFrame) -> DataFrame:
    """Batting and bowling of each name per match document in one row, with the player's own team.

    A batter's team is the batting team, a bowler's the other one of the match (unknown where
    the match is). Both sides are stacked and added up once, which gives the result of a full
    outer join on (name, document). The deliveries of a document are brought together once; all
    sums are per document, so none of them is shuffled again. ``_day`` is the date of the match.
    """
    teams = matches.groupBy(*DOCUMENT).agg(F.min("first_team").alias("_one"), F.min("second_team").alias("_two"), F.min("event_date").alias("_day"))
    measures = ["runs", "extras", "wicket_flag", "boundary_4_count", "boundary_6_count", "dot_ball_count"]
    parts = int(deliveries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    balls = deliveries.select(*DOCUMENT, "match_type_number", "team_name", "bowler", "batter", *measures).repartition(parts, *DOCUMENT)
    per_pair = balls.groupBy("batter", "bowler", "match_type_number", *DOCUMENT, "team_name").agg(
        F.count(F.lit(1)).alias("balls"), F.sum("runs").alias("runs"), F.sum(F.col("runs") + F.col("extras")).alias("conceded"),
        F.sum("boundary_4_count").alias("fours"), F.sum("boundary_6_count").alias("sixes"),
        F.sum("wicket_flag").alias("wickets"), F.sum("dot_ball_count").alias("dots"),
    )
    other = F.when(F.col("team_name") == F.col("_one"), F.col("_two")).when(F.col("team_name") == F.col("_two"), F.col("_one"))
    placed = per_pair.join(teams, DOCUMENT, "left").withColumn("_other", other)
    part = lambda name, team, own, **measures: F.struct(
        F.col(name).alias("player_name"), F.col(team).alias("own_team"), F.lit(own).alias("batting"),
        *((F.col(measures[m]) if m in measures else F.lit(0)).cast("long").alias(m) for m in _PLAYER_MEASURES),
    )
    both = F.array(
        part("batter", "team_name", True, balls_faced="balls", runs_scored="runs", boundaries_4="fours", boundaries_6="sixes"),
        part("bowler", "_other", False, balls_bowled="balls", runs_conceded="conceded", wickets_taken="wickets", dot_balls_bowled="dots"),
    )
    rows = placed.select("match_type_number", *DOCUMENT, "_day", F.inline(both))
    own = F.coalesce(F.min(F.when(F.col("batting"), F.col("own_team"))), F.min("own_team"))
    # sorted for the sums by the digest of the document first, which tells rows apart soonest
    return rows.groupBy(*DOCUMENT, "player_name", "match_type_number").agg(own.alias("team_name"), F.min("_day").alias("_day"), *(F.sum(m).alias(m) for m in _PLAYER_MEASURES))


def player_performance(players: DataFrame, deliveries: DataFrame, matches: DataFrame, as_of=None) -> DataFrame:
    """KPIs per player and match, with role, form and a rolling average over five matches."""
    members = pinned(players.filter("is_latest").select("player_name", "country").distinct())  # of known size, so the join needs no shuffle where they are few
    stats = player_stats(deliveries, matches).withColumnRenamed("player_name", "_name")
    # namesakes of other countries keep their own rows; a name whose team is unknown goes to all who bear it
    same = (F.col("player_name") == F.col("_name")) & (F.coalesce("team_name", "country") == F.col("country"))
    keys = ["player_name", "country"]
    order = [F.col(c).asc_nulls_last() for c in ("_day", "match_type_number", "stg_file_name", "stg_file_hashkey", "stg_file_row_number")]
    found = stats.join(members, same).drop("_name").withColumn("runs_scored", F.coalesce("runs_scored", F.lit(0)))
    rolled = rolling_sums(found, keys, order, F.trunc("_day", "month"), "runs_scored", 5, "_sum", "_cnt", nulls_first=False)
    # members without a match have one row, of nothing
    alone = members.join(rolled.select(*keys).distinct(), keys, "left_anti").withColumns({"_sum": F.lit(0).cast("long"), "_cnt": F.lit(1).cast("long")})
    filled = rolled.unionByName(alone, allowMissingColumns=True).withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in _PLAYER_MEASURES}).withColumns(
        {
            "matches_count": F.when(F.col("match_type_number").isNotNull(), 1).otherwise(0).cast("long"),
            "batting_avg": F.coalesce(F.round(ratio(F.col("runs_scored"), F.col("balls_faced")), 2), F.lit(0.0)),
            "strike_rate": F.coalesce(F.round(ratio(F.col("runs_scored") * 100, F.col("balls_faced")), 2), F.lit(0.0)),
            "bowling_econ": F.coalesce(F.round(ratio(F.col("runs_conceded") * 6, F.col("balls_bowled")), 2), F.lit(0.0)),
        }
    )
    shaped = filled.withColumns(
        {
            "rolling_5_match_avg": F.round(ratio(F.col("_sum"), F.col("_cnt")), 2),
            "role_type": role_type(F.col("runs_scored"), F.col("wickets_taken")),
            "form_status": form_status(F.col("batting_avg"), F.col("bowling_econ"), F.col("balls_bowled")),
            "last_match_date": as_of_literal(as_of).cast("date"),
        }
    )
    columns = [part.split()[0] for part in PLAYER_PERFORMANCE.split(", ")]
    return _audit(shaped, "player_performance", as_of).select(*columns)


def team_totals(deliveries: DataFrame) -> DataFrame:
    """Per match document and team: runs, wickets, balls and flags."""
    return deliveries.groupBy(*DOCUMENT, "team_name").agg(
        F.sum("runs").alias("runs"),
        F.sum("wicket_flag").alias("wickets"),
        F.count(F.lit(1)).alias("balls"),
        F.sum(F.col("runs") + F.col("extras")).alias("all_runs"),
        F.sum("boundary_4_count").alias("fours"),
        F.sum("boundary_6_count").alias("sixes"),
        F.sum("dot_ball_count").alias("dots"),
    )


_MATCH_ATTRIBUTES = [
    "match_type_number", "event_date", "event_year", "event_month", "match_type", "venue", "first_team", "second_team",
    "toss_winner", "toss_decision", "winner", "margin_type", "margin_value", "player_of_match", *DOCUMENT,
]


def _latest(matches: DataFrame) -> DataFrame:
    return matches.filter("is_latest").select(*_MATCH_ATTRIBUTES)


def _with_teams(matches: DataFrame, sums: DataFrame, *more: str) -> DataFrame:
    """Match attributes with both teams' totals, from one row of sums per document."""
    side = lambda team, c: F.coalesce(F.try_element_at("_teams", F.col(team))[c], F.lit(0))
    return matches.join(sums, DOCUMENT, "left").select(
        *matches.columns,
        side("first_team", "runs").alias("first_team_runs"),
        side("second_team", "runs").alias("second_team_runs"),
        side("first_team", "wickets").alias("first_team_wickets"),
        side("second_team", "wickets").alias("second_team_wickets"),
        F.coalesce("balls", F.lit(0)).alias("total_deliveries"),
        "total_runs_scored", "total_boundaries_4", "total_boundaries_6", "total_dot_balls", *more,
    )


def match_team_stats(matches: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Match attributes with both teams' totals.

    Deliveries are added up per team, and the few teams of a document put into one row, before the
    join; a document has one row in ``matches``, so nothing is grouped by the attributes after it.
    """
    named = F.when(F.col("team_name").isNotNull(), F.struct("team_name", F.struct("runs", "wickets").alias("total")))
    teams = team_totals(deliveries).groupBy(*DOCUMENT).agg(
        F.map_from_entries(F.collect_list(named)).alias("_teams"),
        F.sum("balls").alias("balls"),
        F.sum("all_runs").alias("total_runs_scored"),
        F.sum("fours").alias("total_boundaries_4"),
        F.sum("sixes").alias("total_boundaries_6"),
        F.sum("dots").alias("total_dot_balls"),
    )
    return _with_teams(_latest(matches), teams)


_LEADERS = ["highest_wicket_taker", "wickets_taken", "highest_run_scorer", "runs_scored"]


def document_sums(deliveries: DataFrame) -> DataFrame:
    """One row per document: the totals of its teams, its leading wicket taker and run scorer; ties go to the first name.

    The deliveries of a document are brought together once. The sums per team, bowler and batter
    and what is chosen from them are all per document, so none of them is shuffled again.
    """
    roles = F.array(*(F.struct(F.lit(r).alias("_role"), F.col(c).alias("_name")) for r, c in enumerate(("team_name", "bowler", "batter"))))
    measures = ["runs", "extras", "wicket_flag", "boundary_4_count", "boundary_6_count", "dot_ball_count"]
    # a fixed number of partitions is not merged into fewer, whose sums would spill
    parts = int(deliveries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    balls = deliveries.select(*DOCUMENT, "team_name", "bowler", "batter", *measures).repartition(parts, *DOCUMENT)
    sums = balls.select(*DOCUMENT, *measures, F.inline(roles)).groupBy(*DOCUMENT, "_role", "_name").agg(
        F.sum("runs").alias("runs"),
        F.sum("wicket_flag").alias("wickets"),
        F.count(F.lit(1)).alias("balls"),
        F.sum(F.col("runs") + F.col("extras")).alias("all_runs"),
        F.sum("boundary_4_count").alias("fours"),
        F.sum("boundary_6_count").alias("sixes"),
        F.sum("dot_ball_count").alias("dots"),
    )
    team = F.col("_role") == 0
    entry = F.when(team & F.col("_name").isNotNull(), F.struct("_name", F.struct("runs", "wickets").alias("total")))
    total = lambda c: F.sum(F.when(team, F.col(c)))
    leader = lambda role, c: F.min(F.when(F.col("_role") == role, F.struct((-F.col(c)).alias("m"), F.col("_name").alias("v"))))
    lines = sums.groupBy(*DOCUMENT).agg(
        F.map_from_entries(F.collect_list(entry)).alias("_teams"),
        total("balls").alias("balls"),
        total("all_runs").alias("total_runs_scored"),
        total("fours").alias("total_boundaries_4"),
        total("sixes").alias("total_boundaries_6"),
        total("dots").alias("total_dot_balls"),
        leader(1, "wickets").alias("_bowl"),
        leader(2, "runs").alias("_bat"),
    )
    return lines.withColumns(
        {
            "highest_wicket_taker": F.col("_bowl.v"), "wickets_taken": -F.col("_bowl.m"),
            "highest_run_scorer": F.col("_bat.v"), "runs_scored": -F.col("_bat.m"),
        }
    ).drop("_bowl", "_bat")


def match_lines(matches: DataFrame, deliveries: DataFrame) -> DataFrame:
    """:func:`match_team_stats` with the leaders of each document."""
    return _with_teams(_latest(matches), document_sums(deliveries), *_LEADERS)


def match_summary(matches: DataFrame, deliveries: DataFrame, as_of=None) -> DataFrame:
    """Executive summary, one row per match document, numbered from the latest match back.

    The numbers follow from the matches alone, so those are numbered before the sums are joined to
    them; the ranges of the numbering would have the joined rows computed twice.
    """
    order = [F.col(c).desc() for c in ("event_date", "match_type_number", "stg_file_name", "stg_file_hashkey", "stg_file_row_number")]
    numbered = number_rows(_latest(matches), order, "match_summary_id")
    columns = [part.split()[0] for part in MATCH_SUMMARY.split(", ")]
    return _audit(_with_teams(numbered, document_sums(deliveries), *_LEADERS), "match_summary", as_of).select(*columns)
