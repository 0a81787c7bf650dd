"""Star schema: dimensions, facts, dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.operators.upsert import missing_members
from scorelake.plans import star, visuals
from scorelake.sources.tables import date_list
from scorelake.workload.match_docs import landed, landed_or_passing, match_raw, with_all, with_matches, with_players
from scorelake.workload.registry import query, titled

_RESULT = "CASE WHEN winner IS NOT NULL THEN 'Result Declared' WHEN result = 'tie' THEN 'Tie' WHEN result = 'no result' THEN 'No Result' ELSE result END"

DETAIL_SQL = f"""
detail AS (
  SELECT match_type_number, event_name, coalesce(CAST(match_number AS VARCHAR), stage, 'NA') AS match_stage, event_date,
    CAST(year(event_date) AS INTEGER) AS event_year, CAST(month(event_date) AS INTEGER) AS event_month, CAST(day(event_date) AS INTEGER) AS event_day,
    match_type, season, team_type, overs_text AS overs, city, venue, gender, first_team, second_team, {_RESULT} AS match_result, coalesce(winner, 'NA') AS winner,
    match_referee, reserve_umpires, tv_umpires, first_umpire, second_umpire, toss_winner, {titled('toss_decision')} AS toss_decision, stg_file_name
  FROM matches WHERE match_type_number IS NOT NULL
)"""
DIMS_SQL = """
teams AS (SELECT team_name, CAST(row_number() OVER (ORDER BY team_name) AS INTEGER) AS team_id FROM (SELECT first_team AS team_name FROM detail UNION SELECT second_team FROM detail)),
venues AS (SELECT *, CAST(row_number() OVER (ORDER BY venue_name, city) AS INTEGER) AS venue_id FROM (SELECT DISTINCT venue AS venue_name, coalesce(city, 'NA') AS city FROM detail)),
kinds AS (SELECT *, CAST(row_number() OVER (ORDER BY match_type) AS INTEGER) AS match_type_id FROM (SELECT DISTINCT match_type FROM detail)),
days AS (SELECT *, CAST(row_number() OVER (ORDER BY full_dt) AS INTEGER) AS date_id FROM (SELECT DISTINCT event_date AS full_dt FROM detail WHERE event_date IS NOT NULL))"""
PLAYER_DIM_SQL = """
people AS (SELECT *, CAST(row_number() OVER (ORDER BY team_id, player_name) AS INTEGER) AS player_id FROM
  (SELECT DISTINCT team_id, player_name FROM players JOIN teams ON country = team_name WHERE match_type_number IS NOT NULL))"""
_SUMS = """
    coalesce({x}.overs, 0)::INTEGER AS overs_played_by_team_{s}, coalesce({x}.balls, 0)::INTEGER AS bowls_played_by_team_{s},
    coalesce({x}.extras, 0)::INTEGER AS extra_bowls_played_by_team_{s}, coalesce({x}.extra_runs, 0)::INTEGER AS extra_runs_scored_by_team_{s},
    0 AS fours_by_team_{s}, 0 AS sixes_by_team_{s},
    (coalesce({x}.runs, 0) + coalesce({x}.extra_runs, 0))::INTEGER AS total_score_by_team_{s}, coalesce({x}.lost, 0)::INTEGER AS wicket_lost_by_team_{s}"""
# Inner joins: a match or ball without a member of some dimension drops out, and a name that several teams' players bear counts for each.
FACT_SQL = f"""
wide AS (
  SELECT k, match_type_number, team_name, CAST(over + 1 AS INTEGER) AS over, bowler, batter, non_striker, runs, extras, e.e AS extra_type,
    CASE e.e WHEN 'wides' THEN 1 WHEN 'legbyes' THEN 2 END AS extra_runs, player_out, player_out_kind
  FROM balls, UNNEST(extra_list) AS e(e)
),
team_sums AS (
  SELECT match_type_number, team_name, MAX(over) AS overs, COUNT(*) AS balls, SUM(extras) AS extras, SUM(extra_runs) AS extra_runs, SUM(runs) AS runs, COUNT(player_out) AS lost
  FROM wide GROUP BY ALL
),
match_fact AS (
  SELECT m.match_type_number AS match_id, d.date_id, 0 AS referee_id, ta.team_id AS team_a_id, tb.team_id AS team_b_id,
    y.match_type_id, v.venue_id, 50 AS total_overs, 6 AS balls_per_over, {_SUMS.format(x='a', s='a')}, {_SUMS.format(x='b', s='b')},
    tt.team_id AS toss_winner_team_id, toss_decision, match_result, tw.team_id AS winner_team_id
  FROM (FROM detail SEMI JOIN team_sums USING (match_type_number)) m
  JOIN days d ON d.full_dt = m.event_date
  JOIN teams ta ON ta.team_name = m.first_team
  JOIN teams tb ON tb.team_name = m.second_team
  JOIN teams tt ON tt.team_name = m.toss_winner
  JOIN teams tw ON tw.team_name = m.winner
  JOIN kinds y ON y.match_type = m.match_type
  JOIN venues v ON v.venue_name = m.venue AND v.city = m.city
  LEFT JOIN team_sums a ON a.match_type_number = m.match_type_number AND a.team_name = m.first_team
  LEFT JOIN team_sums b ON b.match_type_number = m.match_type_number AND b.team_name = m.second_team
)"""
_BALL_DETAILS = """over, runs, coalesce(extra_runs, 0)::INTEGER AS extra_runs,
    coalesce(extra_type, 'None') AS extra_type, coalesce(player_out, 'None') AS player_out, coalesce(player_out_kind, 'None') AS player_out_kind"""
DELIVERY_FACT_SQL = f"""
delivery_fact AS (
  SELECT match_type_number AS match_id, t.team_id, b.player_id AS bowler_id, s.player_id AS batter_id, n.player_id AS non_striker_id, {_BALL_DETAILS}
  FROM wide
  JOIN teams t USING (team_name)
  JOIN people b ON b.player_name = bowler
  JOIN people s ON s.player_name = batter
  JOIN people n ON n.player_name = non_striker
)"""
BRIDGE_SQL = "bridged AS (SELECT * FROM (SELECT DISTINCT match_id, team_id FROM delivery_fact) JOIN teams USING (team_id) JOIN match_fact USING (match_id))"


def with_star(body: str) -> str:
    return with_all(body, DETAIL_SQL, DIMS_SQL, PLAYER_DIM_SQL, FACT_SQL, DELIVERY_FACT_SQL, BRIDGE_SQL)


def _clean(t) -> tuple:
    """The clean tables, written when first asked for."""
    raw = match_raw(t)
    matches = landed(t, "clean_match", lambda: star.clean_match_detail(raw))
    players = landed(t, "clean_player", lambda: star.clean_players(raw, cleaned=False))
    deliveries = landed(t, "clean_delivery", lambda: star.clean_deliveries(raw))
    return matches, players, deliveries


def _dims_only(t):
    return _clean(t)[:2]


def build_star(t) -> dict:
    """Clean tables and dimensions, read back once written, and the facts, lazily."""
    matches, players, deliveries = _clean(t)
    dims = {
        "team_dim": landed(t, "team_dim", lambda: star.team_dim(matches)),
        "venue_dim": landed(t, "venue_dim", lambda: star.venue_dim(matches)),
        "match_type_dim": landed(t, "match_type_dim", lambda: star.match_type_dim(matches)),
        "date_dim": landed(t, "date_dim", lambda: star.date_dim(matches, "event_date")),
    }
    dims["player_dim"] = landed(t, "player_dim", lambda: star.player_dim(players, dims["team_dim"]))
    return {
        "matches": matches, "players": players, "deliveries": deliveries, **dims,
        "match_fact": star.match_fact(matches, deliveries, dims), "delivery_fact": star.delivery_fact(deliveries, dims),
    }


_DETAIL = [
    "match_type_number", "event_name", "match_stage", "event_date", "event_year", "event_month", "event_day", "match_type", "season", "team_type", "overs", "city",
    "venue", "gender", "first_team", "second_team", "match_result", "winner", "match_referee", "reserve_umpires", "tv_umpires", "first_umpire", "second_umpire",
    "toss_winner", "toss_decision", "stg_file_name",
]


@query("clean_match_detail", "B15 C2 C9 C10", with_matches("SELECT * FROM detail", DETAIL_SQL))
def clean_match_detail(t):
    return star.clean_match_detail(match_raw(t)).select(*_DETAIL)


@query(
    "clean_players", "C8 B9",
    with_players(f"SELECT match_type_number, {titled('trim(country)')} AS country, CASE WHEN trim(player_name) = '' THEN 'Unknown' ELSE {titled('trim(player_name)')} END AS player_name FROM players WHERE match_type_number IS NOT NULL"),
)
def clean_players(t):
    return star.clean_players(match_raw(t)).select("match_type_number", "country", "player_name")


_DATE_SQL = """CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter, CAST(isodow(d) AS INTEGER) AS dayofweek,
  CAST(day(d) AS INTEGER) AS dayofmonth, CAST(dayofyear(d) AS INTEGER) AS dayofyear, substr(dayname(d), 1, 3) AS dayofweekname, isodow(d) >= 6 AS isweekend"""


@query("date_dim", "J1 C11 C12 F3", f"SELECT CAST(row_number() OVER (ORDER BY d) AS INTEGER) AS date_id, d AS full_dt, {_DATE_SQL} FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)")
def date_dim(t):
    return star.date_dim(t.orders, "o_orderdate")


@query(
    "date_list_join", "A12 J1",
    """SELECT CAST(d AS DATE) AS date, COUNT(o_orderkey) AS n_orders FROM generate_series(DATE '1997-10-12', DATE '1997-12-31', INTERVAL 1 DAY) g(d) LEFT JOIN orders ON CAST(o_orderdate AS DATE) = CAST(d AS DATE) GROUP BY 1""",
)
def date_list_join(t):
    """Orders per day of a literal date list, days without orders included."""
    per_day = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return date_list(t.spark, "1997-10-12", "1997-12-31").join(per_day, "date", "left").select("date", F.coalesce("n", F.lit(0)).alias("n_orders"))


@query(
    "spanning_calendar", "P1 P2 C26",
    """WITH b AS (SELECT year(MIN(o_orderdate)) AS lo, year(MAX(o_orderdate)) AS hi FROM orders)
    SELECT CAST(d AS DATE) AS date, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_no, monthname(d) AS month, CAST(quarter(d) AS INTEGER) AS quarter_no, 'Qtr ' || quarter(d) AS quarter, CAST(day(d) AS INTEGER) AS day
    FROM b, generate_series(make_date(CAST(lo AS INTEGER), 1, 1), make_date(CAST(hi AS INTEGER), 12, 31), INTERVAL 1 DAY) g(d)""",
)
def spanning_calendar(t):
    return star.spanning_calendar(t.orders, "o_orderdate")


@query(
    "orders_on_calendar", "P2",
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'Qtr ' || quarter(o_orderdate) AS quarter, COUNT(*) AS n_orders FROM orders GROUP BY 1, 2",
)
def orders_on_calendar(t):
    calendar = star.spanning_calendar(t.orders, "o_orderdate")
    return visuals.on_calendar(t.orders, "o_orderdate", calendar).groupBy("year", "quarter").agg(F.count(F.lit(1)).alias("n_orders"))


@query("team_dim", "J2 J7", with_matches("SELECT * FROM teams", DETAIL_SQL, DIMS_SQL))
def team_dim(t):
    return star.team_dim(_dims_only(t)[0])


@query("venue_dim", "J4 C24", with_matches("SELECT venue_id, venue_name, city, CAST(NULL AS VARCHAR) AS state, CAST(NULL AS BOOLEAN) AS flood_light FROM venues", DETAIL_SQL, DIMS_SQL))
def venue_dim(t):
    return star.venue_dim(_dims_only(t)[0]).select("venue_id", "venue_name", "city", "state", "flood_light")


@query("match_type_dim", "J5", with_matches("SELECT * FROM kinds", DETAIL_SQL, DIMS_SQL))
def match_type_dim(t):
    return star.match_type_dim(_dims_only(t)[0])


@query("player_dim", "J3 D1", with_players("SELECT * FROM people", DETAIL_SQL, DIMS_SQL, PLAYER_DIM_SQL))
def player_dim(t):
    matches, players = _dims_only(t)
    return star.player_dim(players, star.team_dim(matches))


@query(
    "referee_dim", "J6",
    with_matches(
        """SELECT CAST(row_number() OVER (ORDER BY referee_name, referee_type) AS INTEGER) AS referee_id, * FROM (
        SELECT DISTINCT match_referee AS referee_name, 'match_referee' AS referee_type FROM detail WHERE match_referee IS NOT NULL UNION SELECT reserve_umpires, 'reserve_umpires' FROM detail
        UNION SELECT tv_umpires, 'tv_umpires' FROM detail UNION SELECT first_umpire, 'first_umpire' FROM detail UNION SELECT second_umpire, 'second_umpire' FROM detail WHERE second_umpire IS NOT NULL)""",
        DETAIL_SQL,
    ),
)
def referee_dim(t):
    return star.referee_dim(_dims_only(t)[0])


@query(
    "extend_dim", "H12 J7 G4",
    """WITH old AS (SELECT DISTINCT p_type, p_brand FROM part WHERE p_size <= 10), o AS (SELECT *, row_number() OVER (ORDER BY p_type, p_brand) AS id FROM old),
    fresh AS (SELECT DISTINCT p_type, p_brand FROM part EXCEPT SELECT p_type, p_brand FROM old)
    SELECT CAST(id AS INTEGER) AS id, p_type, p_brand FROM o UNION ALL SELECT CAST((SELECT MAX(id) FROM o) + row_number() OVER (ORDER BY p_type, p_brand) AS INTEGER), p_type, p_brand FROM fresh""",
)
def extend_dim(t):
    """Known members keep their ids; new ones go on after the largest."""
    columns = ["p_type", "p_brand"]
    old = star.with_ids(t.part.filter("p_size <= 10").select(*columns).distinct(), "id", columns)
    return old.unionByName(star.extend_dim(old, t.part, "id", columns))


@query("missing_members", "G4 H12", "SELECT DISTINCT p_brand, p_size FROM part WHERE p_type = 'SMALL' EXCEPT SELECT p_brand, p_size FROM part WHERE p_type = 'ECONOMY'")
def missing_dim_members(t):
    columns = ["p_brand", "p_size"]
    return missing_members(t.part.filter("p_type = 'ECONOMY'"), t.part.filter("p_type = 'SMALL'"), columns)


@query("match_fact", "J8 D2 D4 E4", with_star("SELECT * FROM match_fact"))
def match_fact(t):
    return build_star(t)["match_fact"]


@query("delivery_fact", "J9 D3 C24", with_star("SELECT * FROM delivery_fact"))
def delivery_fact(t):
    return build_star(t)["delivery_fact"]


@query(
    "delivery_fact_team_aware", "J9 D3",
    with_star(f"""
    SELECT match_type_number AS match_id, t.team_id, b.player_id AS bowler_id, s.player_id AS batter_id, n.player_id AS non_striker_id, {_BALL_DETAILS}
    FROM wide w
    JOIN (SELECT match_type_number, first_team, second_team FROM detail) m USING (match_type_number)
    JOIN teams t USING (team_name)
    JOIN teams o ON o.team_name = CASE w.team_name WHEN m.first_team THEN m.second_team ELSE m.first_team END
    JOIN people b ON b.player_name = bowler AND b.team_id = o.team_id
    JOIN people s ON s.player_name = batter AND s.team_id = t.team_id
    JOIN people n ON n.player_name = non_striker AND n.team_id = t.team_id
    """),
)
def delivery_fact_team_aware(t):
    parts = build_star(t)
    return star.delivery_fact(parts["deliveries"], parts, team_aware=True, matches=parts["matches"])


@query("incremental_match_facts", "H13 J8", with_star("SELECT match_id, total_score_by_team_a, total_score_by_team_b FROM match_fact WHERE match_id % 3 <> 0"))
def incremental_match_facts(t):
    """Only matches that are not stored yet are added."""
    parts = build_star(t)
    facts = landed(t, "match_fact", lambda: parts["match_fact"])
    stored = facts.filter("match_id % 3 = 0").select("match_id")
    return star.new_match_facts(stored, facts).select("match_id", "total_score_by_team_a", "total_score_by_team_b")


# --- dashboard --------------------------------------------------------------------------------


def _with_facts(t, fact=landed) -> dict:
    """The star schema with its facts written, as the dashboard reads it; a query that reads each fact once asks for them ``landed_or_passing``."""
    parts = build_star(t)
    return parts | {
        "match_fact": fact(t, "match_fact", lambda: parts["match_fact"]),
        "delivery_fact": fact(t, "delivery_fact", lambda: parts["delivery_fact"]),
    }


def _bridged(t):
    parts = _with_facts(t, landed_or_passing)
    return visuals.team_of_matches(parts["match_fact"], parts["delivery_fact"], parts["team_dim"]), parts


@query("team_match_counts", "P3 E15 G1", with_star("SELECT team_name, COUNT(match_id) AS match_count, COUNT(match_result) AS result_count FROM bridged GROUP BY 1"))
def team_match_counts(t):
    return visuals.team_match_counts(_bridged(t)[0])


@query(
    "player_ball_counts", "P4",
    with_star("""SELECT player_name, COUNT(DISTINCT balls_per_over) AS balls_per_over_count, COUNT(DISTINCT extra_bowls_played_by_team_a) AS extra_bowls_count
    FROM people JOIN bridged USING (team_id) GROUP BY 1"""),
)
def player_ball_counts(t):
    parts = _with_facts(t, landed_or_passing)
    return visuals.player_ball_counts(parts["delivery_fact"], parts["match_fact"], parts["player_dim"])


@query("team_table", "P5", with_star("SELECT DISTINCT team_name, team_a_id, team_b_id, toss_winner_team_id, city FROM bridged JOIN venues USING (venue_id) WHERE city IN (SELECT city FROM venues WHERE city LIKE '%1%')"))
def team_table(t):
    bridged, parts = _bridged(t)
    chosen = parts["venue_dim"].filter(F.col("city").contains("1"))
    return visuals.team_table(bridged, chosen)


@query("match_table", "P6", with_star("SELECT DISTINCT match_id, team_name, team_a_id, team_b_id, toss_winner_team_id, venue_name FROM bridged JOIN venues USING (venue_id)"))
def match_table(t):
    bridged, parts = _bridged(t)
    return visuals.match_table(bridged, parts["venue_dim"])


@query("team_cities", "P7 P8", with_star("SELECT DISTINCT team_name, city, (SELECT MIN(team_name) FROM teams) AS first_team_name FROM bridged JOIN venues USING (venue_id)"))
def team_cities(t):
    bridged, parts = _bridged(t)
    first = visuals.first_team(parts["team_dim"]).scalar()
    return visuals.team_cities(bridged, parts["venue_dim"]).withColumn("first_team_name", first)


@query("match_slicer", "P9", with_star("SELECT match_id FROM match_fact WHERE toss_decision IN ('Bat')"))
def match_slicer(t):
    return visuals.match_choices(visuals.slice_by(_with_facts(t, landed_or_passing)["match_fact"], toss_decision=["Bat"]))


@query("date_picker", "P10", with_star("SELECT full_dt, 1::BIGINT AS dates FROM match_fact JOIN days USING (date_id) WHERE full_dt >= DATE '1996-01-01' AND full_dt <= DATE '1999-12-31' GROUP BY 1"))
def date_picker(t):
    parts = _with_facts(t, landed_or_passing)
    return visuals.date_choices(parts["match_fact"], parts["date_dim"], "1996-01-01", "1999-12-31")


@query(
    "fact_default_summary", "E16 D13",
    with_star("SELECT toss_decision, SUM(total_score_by_team_a)::BIGINT AS sum_total_score_by_team_a, SUM(wicket_lost_by_team_b)::BIGINT AS sum_wicket_lost_by_team_b, COUNT(winner_team_id) AS count_winner_team_id FROM match_fact GROUP BY 1"),
)
def fact_default_summary(t):
    return visuals.summarise(_with_facts(t, landed_or_passing)["match_fact"], "match_fact", ["toss_decision"], ["total_score_by_team_a", "wicket_lost_by_team_b", "winner_team_id"])
