"""Clean tables, dimensions and facts of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.fixed_values import BALLS_PER_OVER, NONE, NOT_AVAILABLE, REFEREE_ID, TOTAL_OVERS, UNKNOWN
from scorelake.functions.ball import match_result
from scorelake.functions.casts import safe_date, safe_int
from scorelake.functions.dates import date_parts, hierarchy_parts
from scorelake.functions.text import clean_text, title_case
from scorelake.operators.joins import lookup
from scorelake.operators.nested import path
from scorelake.operators.positions import number_rows
from scorelake.operators.upsert import absent_facts, missing_members
from scorelake.plans.bronze import flat_deliveries, flat_players, match_number
from scorelake.sources.documents import LINEAGE
from scorelake.sources.tables import date_list, typed_empty

VENUE_DETAILS = {
    "state": "string", "country": "string", "continent": "string", "end_names": "string", "capacity": "decimal(38,0)",
    "pitch": "string", "flood_light": "boolean", "established_dt": "date", "playing_area": "string",
    "other_sports": "string", "curator": "string", "lattitude": "decimal(10,6)", "longitude": "decimal(10,6)",
}


# --- clean tables -----------------------------------------------------------------------------


def clean_match_detail(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Match attributes with stage, result class and winner; documents without a number are left out.

    ``strict`` fails on numbers or dates of the wrong type instead of treating them as missing.
    """
    number = path("info", "$.match_type_number", "int", strict=True) if strict else match_number()
    day = path("info", "$.dates[0]", "date", strict=True) if strict else safe_date(path("info", "$.dates[0]"))
    text = lambda p: path("info", p)
    winner = text("$.outcome.winner")
    return raw.select(
        number.alias("match_type_number"),
        text("$.event.name").alias("event_name"),
        F.coalesce(text("$.event.match_number"), text("$.event.stage"), F.lit(NOT_AVAILABLE)).alias("match_stage"),
        day.alias("event_date"),
        F.year(day).alias("event_year"),
        F.month(day).alias("event_month"),
        F.dayofmonth(day).alias("event_day"),
        *(text(f"$.{c}").alias(c) for c in ("match_type", "season", "team_type", "overs", "city", "venue", "gender")),
        text("$.teams[0]").alias("first_team"),
        text("$.teams[1]").alias("second_team"),
        match_result(winner, text("$.outcome.result")).alias("match_result"),
        F.coalesce(winner, F.lit(NOT_AVAILABLE)).alias("winner"),
        text("$.officials.match_referees[0]").alias("match_referee"),
        text("$.officials.reserve_umpires[0]").alias("reserve_umpires"),
        text("$.officials.tv_umpires[0]").alias("tv_umpires"),
        text("$.officials.umpires[0]").alias("first_umpire"),
        text("$.officials.umpires[1]").alias("second_umpire"),
        text("$.toss.winner").alias("toss_winner"),
        title_case(text("$.toss.decision")).alias("toss_decision"),
        *LINEAGE,
    ).filter(F.col("match_type_number").isNotNull())


def clean_players(raw: DataFrame, cleaned: bool = True) -> DataFrame:
    """Players per match; ``cleaned`` trims and title-cases names without squeezing white space."""
    rows = flat_players(raw).filter(F.col("match_type_number").isNotNull())
    if not cleaned:
        return rows
    return rows.withColumns({c: clean_text(F.col(c), UNKNOWN, collapse=False) for c in ("country", "player_name")})


def clean_deliveries(raw: DataFrame, nested_fielders: bool = True, over_base: int = 1) -> DataFrame:
    """Delivery rows with runs per extra type; overs count from ``over_base``."""
    rows = flat_deliveries(raw, nested_fielders, over_base)
    return rows.withColumns({c: safe_int(F.col(c)) for c in ("runs", "extras", "total")})


# --- dimensions -------------------------------------------------------------------------------


def with_ids(rows: DataFrame, key: str, order: list[str], existing: DataFrame | None = None) -> DataFrame:
    """Dense ids in ``order``, going on after the largest id already given."""
    start: Column | int = 1
    if existing is not None:
        start = F.coalesce(existing.agg(F.max(key)).scalar(), F.lit(0)) + 1
    numbered = number_rows(rows, [F.col(c).asc_nulls_last() for c in order], key, start)
    return numbered.select(F.col(key).cast("int").alias(key), *rows.columns)


def extend_dim(dimension: DataFrame, candidates: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows to append for candidates the dimension lacks; present ids stay as they are."""
    return with_ids(missing_members(dimension, candidates, columns), key, columns, dimension)


def date_dim(days: DataFrame, day: str = "date") -> DataFrame:
    """Calendar dimension for the given days, numbered in date order."""
    parts = date_parts(F.col("full_dt"))
    rows = days.select(F.col(day).cast("date").alias("full_dt")).filter(F.col("full_dt").isNotNull()).distinct()
    return with_ids(rows, "date_id", ["full_dt"]).select("date_id", "full_dt", *(v.alias(n) for n, v in parts.items()))


def seeded_date_dim(spark, first: str, last: str) -> DataFrame:
    return date_dim(date_list(spark, first, last))


def spanning_calendar(df: DataFrame, day: str) -> DataFrame:
    """Every day of the years from the earliest to the latest date, with hierarchy columns."""
    bounds = df.agg(F.year(F.min(day)).alias("lo"), F.year(F.max(day)).alias("hi")).filter(F.col("lo").isNotNull())
    days = bounds.select(
        F.explode(F.sequence(F.make_date("lo", F.lit(1), F.lit(1)), F.make_date("hi", F.lit(12), F.lit(31)), F.expr("INTERVAL 1 DAY"))).alias("date")
    )
    return days.select("date", *(v.alias(n) for n, v in hierarchy_parts(F.col("date")).items()))


def team_names(matches: DataFrame) -> DataFrame:
    first = matches.select(F.col("first_team").alias("team_name"))
    return first.unionByName(matches.select(F.col("second_team").alias("team_name"))).filter(F.col("team_name").isNotNull()).distinct()


def team_dim(matches: DataFrame) -> DataFrame:
    return with_ids(team_names(matches), "team_id", ["team_name"])


def team_players(players: DataFrame, teams: DataFrame) -> DataFrame:
    return lookup(players, teams, {"country": "team_name"}, {"team_id": "team_id"}).select("team_id", "player_name").distinct()


def player_dim(players: DataFrame, teams: DataFrame) -> DataFrame:
    return with_ids(team_players(players, teams), "player_id", ["team_id", "player_name"])


def venues(matches: DataFrame) -> DataFrame:
    return matches.select(F.col("venue").alias("venue_name"), F.coalesce("city", F.lit(NOT_AVAILABLE)).alias("city")).distinct()


def venue_dim(matches: DataFrame) -> DataFrame:
    numbered = with_ids(venues(matches), "venue_id", ["venue_name", "city"])
    return numbered.withColumns({c: F.lit(None).cast(t) for c, t in VENUE_DETAILS.items()})


def match_type_dim(matches: DataFrame) -> DataFrame:
    return with_ids(matches.select("match_type").distinct(), "match_type_id", ["match_type"])


def empty_referee_dim(spark) -> DataFrame:
    """The referee dimension is declared but not filled; facts carry a constant id."""
    return typed_empty(spark, "referee_id int, referee_name string, referee_type string")


def referee_dim(matches: DataFrame) -> DataFrame:
    """Distinct officials by role, for users who want the dimension filled."""
    roles = ["match_referee", "reserve_umpires", "tv_umpires", "first_umpire", "second_umpire"]
    rows = matches.select(*roles).unpivot([], roles, "referee_type", "referee_name").filter(F.col("referee_name").isNotNull())
    return with_ids(rows.select("referee_name", "referee_type").distinct(), "referee_id", ["referee_name", "referee_type"])


# --- facts ------------------------------------------------------------------------------------

_SIDES = {"a": "first_team", "b": "second_team"}


def match_fact(
    matches: DataFrame, deliveries: DataFrame, dims: dict[str, DataFrame], unknown_member: bool = False, lineage: tuple[str, ...] = ()
) -> DataFrame:
    """One row per match with keys of every dimension and measures of both teams, and the ``lineage`` columns of the match.

    Deliveries are added up per match and team first, so the joins see a few rows per match.
    Documents are told apart by ``lineage`` where it is given, else by match number, so two
    documents of one number keep their own totals. Matches that miss a dimension member (no winner, no city) drop out, unless
    ``unknown_member`` keeps them with NULL keys.
    """
    how = "left" if unknown_member else "inner"
    document = list(lineage) or ["match_type_number"]
    per_team = deliveries.groupBy(*document, F.col("team_name").alias("_team")).agg(
        F.max("over").alias("_overs"),
        F.count(F.lit(1)).alias("_balls"),
        F.sum("extras").alias("_extras"),
        F.sum("extra_runs").alias("_extra_runs"),
        F.sum("runs").alias("_runs"),
        F.count("player_out").alias("_wickets"),
    )
    teams = dims["team_dim"]
    star = lookup(matches, dims["date_dim"], {"event_date": "full_dt"}, {"date_id": "date_id"}, how)
    for column, role in (("first_team", "team_a_id"), ("second_team", "team_b_id"), ("toss_winner", "toss_winner_team_id"), ("winner", "winner_team_id")):
        star = lookup(star, teams, {column: "team_name"}, {"team_id": role}, how)
    star = lookup(star, dims["match_type_dim"], {"match_type": "match_type"}, {"match_type_id": "match_type_id"}, how)
    star = lookup(star, dims["venue_dim"], {"venue": "venue_name", "city": "city"}, {"venue_id": "venue_id"}, how)
    star = star.join(per_team, document, how)

    measures = []
    for side, column in _SIDES.items():
        own = F.col("_team") == F.col(column)
        of = lambda c, own=own: F.when(own, F.col(c)).otherwise(0)
        total = lambda c, of=of: F.sum(of(c)).cast("int")
        measures += [
            F.max(of("_overs")).cast("int").alias(f"overs_played_by_team_{side}"),
            total("_balls").alias(f"bowls_played_by_team_{side}"),
            total("_extras").alias(f"extra_bowls_played_by_team_{side}"),
            total("_extra_runs").alias(f"extra_runs_scored_by_team_{side}"),
            F.lit(0).alias(f"fours_by_team_{side}"),
            F.lit(0).alias(f"sixes_by_team_{side}"),
            (total("_runs") + total("_extra_runs")).alias(f"total_score_by_team_{side}"),
            total("_wickets").alias(f"wicket_lost_by_team_{side}"),
        ]
    keys = ["date_id", "team_a_id", "team_b_id", "match_type_id", "venue_id", "toss_winner_team_id", "toss_decision", "match_result", "winner_team_id"]
    facts = star.groupBy(F.col("match_type_number").alias("match_id"), *keys, *lineage).agg(
        F.lit(REFEREE_ID).alias("referee_id"), F.lit(TOTAL_OVERS).alias("total_overs"), F.lit(BALLS_PER_OVER).alias("balls_per_over"), *measures
    )
    names = [m for side in _SIDES for m in (
        f"overs_played_by_team_{side}", f"bowls_played_by_team_{side}", f"extra_bowls_played_by_team_{side}",
        f"extra_runs_scored_by_team_{side}", f"fours_by_team_{side}", f"sixes_by_team_{side}",
        f"total_score_by_team_{side}", f"wicket_lost_by_team_{side}",
    )]
    return facts.select(
        "match_id", "date_id", "referee_id", "team_a_id", "team_b_id", "match_type_id", "venue_id", "total_overs", "balls_per_over",
        *names, "toss_winner_team_id", "toss_decision", "match_result", "winner_team_id", *lineage,
    )


def delivery_fact(
    deliveries: DataFrame, dims: dict[str, DataFrame], team_aware: bool = False, matches: DataFrame | None = None, lineage: tuple[str, ...] = ()
) -> DataFrame:
    """Deliveries with surrogate keys and their ``lineage`` columns; missing details become constants.

    Players are found by name alone, so namesakes of several teams multiply rows;
    ``team_aware`` also matches batters to the batting team and bowlers to the other team.
    """
    players = dims["player_dim"]
    fact = lookup(deliveries, dims["team_dim"], {"team_name": "team_name"}, {"team_id": "team_id"})
    if team_aware:
        sides = matches.select("match_type_number", "first_team", "second_team").distinct()
        fact = fact.join(sides, "match_type_number").withColumn(
            "_other", F.when(F.col("team_name") == F.col("first_team"), F.col("second_team")).otherwise(F.col("first_team"))
        )
        fact = lookup(fact, dims["team_dim"], {"_other": "team_name"}, {"team_id": "_other_id"})
    for column, role, side in (("bowler", "bowler_id", "_other_id"), ("batter", "batter_id", "team_id"), ("non_striker", "non_striker_id", "team_id")):
        on = {column: "player_name", **({side: "team_id"} if team_aware else {})}
        fact = lookup(fact, players, on, {"player_id": role})
    return fact.select(
        F.col("match_type_number").alias("match_id"), "team_id", "bowler_id", "batter_id", "non_striker_id", "over", "runs",
        F.coalesce("extra_runs", F.lit(0)).alias("extra_runs"),
        *(F.coalesce(c, F.lit(NONE)).alias(c) for c in ("extra_type", "player_out", "player_out_kind")),
        *lineage,
    )


def new_match_facts(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    return absent_facts(existing, candidates, "match_id")


def new_delivery_facts(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Deliveries of matches that have none stored yet."""
    return absent_facts(existing, candidates, "match_id")
