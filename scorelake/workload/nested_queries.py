"""Documents: scan, projection, flattening."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.functions.casts import safe_int
from scorelake.operators.nested import flatten_array, flatten_map, flatten_variant, path
from scorelake.plans import bronze, reports
from scorelake.sources.documents import rejected_documents
from scorelake.workload.match_docs import match_raw, match_raw_all, match_texts, with_deliveries, with_matches, with_players
from scorelake.workload.registry import query


@query(
    "document_rejects", "A1 A5 A7",
    """
    SELECT 'match_' || o_orderkey || '.json' AS stg_file_name,
           CASE WHEN o_orderkey % 71 = 0 THEN 'unreadable document' ELSE 'innings missing' END AS rejection_reason,
           CAST(1 AS INTEGER) AS stg_file_row_number
    FROM orders WHERE o_orderkey % 71 = 0 OR o_orderkey % 50 = 0
    """,
)
def document_rejects(t):
    return rejected_documents(match_raw_all(t)).select("stg_file_name", "rejection_reason", "stg_file_row_number")


@query(
    "document_file_lineage", "A2 A3 A6",
    with_matches("SELECT stg_file_name, CAST(1 AS INTEGER) AS stg_file_row_number, CAST(64 AS INTEGER) AS key_length, m AS stg_modified_ts FROM matches"),
)
def document_file_lineage(t):
    return match_raw(t).select("stg_file_name", "stg_file_row_number", F.length("stg_file_hashkey").alias("key_length"), "stg_modified_ts")


@query(
    "document_headers", "B2 B4 B17",
    with_matches("SELECT match_type_number, '1.1.0' AS data_version, CAST(m AS DATE) AS created, CAST(k % 3 AS INTEGER) AS revision FROM matches"),
)
def document_headers(t):
    return bronze.document_headers(match_raw(t))


@query(
    "document_paths", "B1 B3 B5",
    with_matches("SELECT stg_file_name, event_name, first_team, second_team, second_umpire, overs, CAST(NULL AS VARCHAR) AS third_umpire FROM matches"),
)
def document_paths(t):
    return match_raw(t).select(
        "stg_file_name",
        path("info", "$.event.name").alias("event_name"),
        path("info", "$.teams[0]").alias("first_team"),
        path("info", "$.teams[1]").alias("second_team"),
        path("info", "$.officials.umpires[1]").alias("second_umpire"),
        safe_int(path("info", "$.overs")).alias("overs"),
        path("info", "$.officials.umpires[2]").alias("third_umpire"),
    )


@query(
    "event_props_path", "B1 B4 B5",
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           TRY_CAST(json_extract_string(props, '$.k') || '.6' AS INTEGER) AS k_rounded,
           TRY_CAST(event_type AS INTEGER) AS not_a_number, CAST(NULL AS VARCHAR) AS missing
    FROM events
    """,
)
def event_props_path(t):
    v = F.parse_json("props")
    return t.events.select(
        "event_id",
        F.variant_get(v, "$.k", "int").alias("k"),
        safe_int(F.concat(path(v, "$.k"), F.lit(".6"))).alias("k_rounded"),
        safe_int(F.col("event_type")).alias("not_a_number"),
        path(v, "$.none.at[3]").alias("missing"),
    )


@query(
    "event_props_entries", "B7 B16",
    "SELECT event_id, CAST(0 AS INTEGER) AS pos, 'k' AS key, json_extract_string(props, '$.k') AS value FROM events",
)
def event_props_entries(t):
    events = t.events.select("event_id", F.parse_json("props").alias("v"))
    return flatten_variant(events, F.col("v")).select("event_id", "pos", "key", F.col("value").cast("string").alias("value"))


@query("flatten_players", "B7 B9", with_players("SELECT match_type_number, country, player_name FROM players"))
def flatten_players(t):
    return bronze.flat_players(match_raw(t)).select("match_type_number", "country", "player_name")


_DELIVERY = (
    "stg_file_name, match_type_number, team_name, over, bowler, batter, non_striker, CAST(runs AS VARCHAR) AS runs, CAST(extras AS VARCHAR) AS extras, "
    "CAST(total AS VARCHAR) AS total, review_by_team, review_decision, review_type, extra_type, player_out, player_out_kind, player_out_fielder"
)
_DELIVERY_COLUMNS = [
    "stg_file_name", "match_type_number", "team_name", "over", "bowler", "batter", "non_striker", "runs", "extras", "total",
    "review_by_team", "review_decision", "review_type", "extra_type", "player_out", "player_out_kind", "player_out_fielder",
]


@query("flatten_deliveries", "B6 B8 B10 B11", with_deliveries(f"SELECT {_DELIVERY} FROM deliveries"))
def flatten_deliveries(t):
    return bronze.flat_deliveries(match_raw(t)).select(*_DELIVERY_COLUMNS)


@query(
    "flatten_keep_fielders", "B12 B13",
    with_deliveries("""
    SELECT stg_file_name, match_type_number, team_name, CAST(over + 1 AS INTEGER) AS over, batter, CAST(e.e AS VARCHAR) AS extra_type,
      CAST(CASE e.e WHEN 'wides' THEN 1 WHEN 'legbyes' THEN 2 END AS INTEGER) AS extra_runs, player_out,
      CASE WHEN fielder_list = [NULL] THEN NULL ELSE '[' || array_to_string(list_transform(fielder_list, lambda n: '{"name":"' || n || '"}'), ',') || ']' END AS player_out_fielders
    FROM balls, UNNEST(extra_list) AS e(e)
    """),
)
def flatten_keep_fielders(t):
    rows = bronze.flat_deliveries(match_raw(t), nested_fielders=True, over_base=1)
    return rows.select("stg_file_name", "match_type_number", "team_name", "over", "batter", "extra_type", "extra_runs", "player_out", "player_out_fielders")


@query(
    "one_row_per_ball", "B6 B10",
    with_deliveries("""
    SELECT stg_file_name, innings_no, over_no, ball_no, team_name, CAST(runs AS VARCHAR) AS runs,
      CASE WHEN h % 10 = 0 THEN 'legbyes,wides' WHEN h % 5 = 0 THEN 'wides' END AS extra_types, player_out AS players_out
    FROM balls
    """),
)
def one_row_per_ball(t):
    return bronze.one_row_per_ball(match_raw(t)).select("stg_file_name", "innings_no", "over_no", "ball_no", "team_name", "runs", "extra_types", "players_out")


@query(
    "flatten_outer_reviews", "B8 B16 D9",
    with_deliveries("""
    SELECT stg_file_name, innings_no, over_no, ball_no, e.key AS key, e.value AS value
    FROM balls LEFT JOIN (VALUES ('by', 1), ('decision', 2), ('type', 3)) v(part, n) ON h % 17 = 0,
    LATERAL (SELECT v.part AS key, CASE v.part WHEN 'by' THEN review_by_team WHEN 'decision' THEN review_decision WHEN 'type' THEN review_type END AS value) e
    """),
)
def flatten_outer_reviews(t):
    """An outer flatten of an object that most balls lack."""
    balls = bronze.flat_balls(match_raw(t)).select(
        "stg_file_name", "innings_no", "over_no", "ball_no",
        F.when(F.col("review_by_team").isNotNull(), F.create_map(
            F.lit("by"), F.col("review_by_team"), F.lit("decision"), F.col("review_decision"), F.lit("type"), F.col("review_type")
        )).alias("review"),
    )
    return flatten_map(balls, F.col("review"), "key", "value", outer=True).drop("review")


@query(
    "flatten_positions", "B16 B18",
    with_deliveries("SELECT DISTINCT stg_file_name, innings_no AS pos, team_name FROM balls"),
)
def flatten_positions(t):
    """One level of the innings array with its positions."""
    innings = flatten_variant(match_raw(t).select("stg_file_name", "innings"), F.col("innings"))
    return innings.select("stg_file_name", "pos", path("value", "$.team").alias("team_name"))


@query(
    "flatten_innings_overs", "B6 B18",
    with_deliveries("SELECT match_type_number, team_name, over, COUNT(*) AS balls FROM balls GROUP BY match_type_number, stg_file_name, innings_no, team_name, over"),
)
def flatten_innings_overs(t):
    innings = flatten_array(
        match_raw(t).select(bronze.match_number().alias("match_type_number"), path("innings", "$", bronze.INNINGS).alias("i")), F.col("i"), "inn"
    )
    overs = flatten_array(innings.select("match_type_number", "inn"), F.col("inn.overs"), "o")
    return overs.select(
        "match_type_number", F.col("inn.team").alias("team_name"), safe_int(F.col("o.over")).alias("over"),
        F.size("o.deliveries").cast("long").alias("balls"),
    )


_MATCH = [
    "match_type_number", "event_name", "match_number", "event_date", "match_type", "season", "team_type", "overs", "city", "venue",
    "gender", "first_team", "second_team", "winner", "won_by_runs", "won_by_wickets", "player_of_match", "match_referee",
    "reserve_umpires", "tv_umpires", "first_umpire", "second_umpire", "toss_winner", "toss_decision",
]


@query("match_projection", "B14 B1 B3", with_matches(f"SELECT stg_file_name, {', '.join(_MATCH)} FROM matches"))
def match_projection(t):
    return bronze.flat_matches(match_raw(t)).select("stg_file_name", *_MATCH)


@query(
    "rows_vs_distinct_per_over", "M11 B16 E2",
    with_deliveries("SELECT over, COUNT(*) AS raw_delivery_rows, COUNT(DISTINCT (stg_file_name, innings_no, over_no, ball_no)) AS distinct_deliveries FROM deliveries GROUP BY over"),
)
def rows_vs_distinct_per_over(t):
    return reports.rows_and_balls_per_over(bronze.flat_deliveries(match_raw(t)), ["stg_file_name", "innings_no", "over_no", "ball_no"])


@query("parse_inserted_documents", "A19 A6", "SELECT COUNT(*) AS documents, COUNT(*) FILTER (o_orderkey % 71 <> 0) AS readable FROM orders")
def parse_inserted_documents(t):
    parsed = match_texts(t).select(F.try_parse_json("value").alias("doc"))
    return parsed.agg(F.count(F.lit(1)).alias("documents"), F.count("doc").alias("readable"))
