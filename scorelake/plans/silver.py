"""Bronze rows to cleaned, scored silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorelake.fixed_values import MISSING_DATE, NONE, NULL_SHARE_SILVER, SCORE_SILVER_INVALID, UNKNOWN
from scorelake.functions.casts import safe_int
from scorelake.functions.dates import as_of_literal
from scorelake.functions.text import clean_text, is_blank
from scorelake.operators.quality import Rule, apply_null_gate, status_and_score
from scorelake.sources.documents import LINEAGE

# Columns whose NULL share is watched after a load.
GATED = {
    "player": ["player_name", "country"],
    "delivery": ["team_name", "bowler", "batter"],
    "match": ["event_name"],
}


def _current(as_of) -> dict[str, Column]:
    return {"silver_load_ts": as_of_literal(as_of), "is_current_record": F.lit(True)}


def _known_match(bronze: DataFrame) -> DataFrame:
    return bronze.filter(F.col("match_type_number").isNotNull())


def silver_players(bronze: DataFrame, as_of=None) -> DataFrame:
    rules = [Rule("country", ~is_blank(F.col("country"))), Rule("player_name", ~is_blank(F.col("player_name")))]
    return _known_match(bronze).select(
        "match_type_number",
        clean_text(F.col("country"), UNKNOWN).alias("country"),
        clean_text(F.col("player_name"), UNKNOWN).alias("player_name"),
        *LINEAGE,
        "ingestion_ts",
        *(value.alias(name) for name, value in status_and_score(rules, SCORE_SILVER_INVALID).items()),
        *(value.alias(name) for name, value in _current(as_of).items()),
    )


def silver_deliveries(bronze: DataFrame, as_of=None, test_raw: bool = True) -> DataFrame:
    """``test_raw`` looks for empty text before squeezing white space."""
    people = ["team_name", "bowler", "batter", "non_striker"]
    optional = ["extra_type", "player_out", "player_out_kind", "player_out_fielder", "review_by_team", "review_decision", "review_type"]
    rules = [
        Rule("team_name", ~is_blank(F.col("team_name"), collapse=False)),
        Rule("bowler", F.col("bowler").isNotNull()),
        Rule("batter", F.col("batter").isNotNull()),
    ]
    cleaned = {c: clean_text(F.col(c), UNKNOWN, test_raw=test_raw) for c in people}
    cleaned |= {c: clean_text(F.col(c), NONE, test_raw=test_raw) for c in optional}
    cleaned["over"] = F.coalesce(F.col("over").cast("int"), F.lit(0))
    cleaned |= {c: F.coalesce(safe_int(F.col(c).cast("string")), F.lit(0)) for c in ("runs", "extras", "total")}
    order = ["team_name", "over", "bowler", "batter", "non_striker", "runs", "extras", "total", *optional]
    return _known_match(bronze).select(
        "match_type_number",
        *(cleaned[c].alias(c) for c in order),
        *(c for c in ("innings_no", "over_no", "ball_no", "part_no") if c in bronze.columns),
        *LINEAGE,
        "ingestion_ts",
        *(value.alias(name) for name, value in status_and_score(rules, SCORE_SILVER_INVALID).items()),
        *(value.alias(name) for name, value in _current(as_of).items()),
    )


def silver_matches(bronze: DataFrame, as_of=None, test_raw: bool = True) -> DataFrame:
    day = F.coalesce("event_date", F.lit(MISSING_DATE).cast("date"))
    text = lambda c: clean_text(F.col(c), UNKNOWN, test_raw=test_raw).alias(c)
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    rules = [Rule("event_name", F.col("event_name").isNotNull())]
    return _known_match(bronze).select(
        "match_type_number",
        text("event_name"),
        number("match_number"),
        day.alias("event_date"),
        F.year(day).alias("event_year"),
        F.month(day).alias("event_month"),
        F.dayofmonth(day).alias("event_day"),
        *(text(c) for c in ("match_type", "season", "team_type")),
        number("overs"),
        *(text(c) for c in ("city", "venue", "gender", "first_team", "second_team", "winner")),
        number("won_by_runs"),
        number("won_by_wickets"),
        *(
            text(c)
            for c in (
                "player_of_match", "match_referee", "reserve_umpires", "tv_umpires",
                "first_umpire", "second_umpire", "toss_winner", "toss_decision",
            )
        ),
        *LINEAGE,
        "ingestion_ts",
        *(value.alias(name) for name, value in status_and_score(rules, SCORE_SILVER_INVALID).items()),
        *(value.alias(name) for name, value in _current(as_of).items()),
    )


def gate(df: DataFrame, kind: str, threshold: float = NULL_SHARE_SILVER) -> DataFrame:
    """Mark rows with NULLs in watched columns when too many have them."""
    return apply_null_gate(df, GATED[kind], threshold)
