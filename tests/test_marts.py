from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from scorelake.plans import marts

_DELIVERY = (
    "stg_file_hashkey string, stg_file_row_number int, stg_file_name string, team_name string, bowler string, batter string, "
    "runs int, extras int, wicket_flag int, boundary_4_count int, boundary_6_count int, dot_ball_count int"
)
_ROWS = [
    ("h1", 1, "f", "A", "x", "p", 4, 0, 0, 1, 0, 0), ("h1", 1, "f", "A", "y", "q", 4, 1, 1, 1, 0, 0),
    ("h1", 1, "f", "A", "x", "p", 0, 0, 1, 0, 0, 1), ("h1", 1, "f", "B", "q", "x", 6, 0, 0, 0, 1, 0),
    ("h1", 2, "f", "A", None, "p", 1, 0, 1, 0, 0, 0), ("h1", 2, "f", None, "x", None, 3, 0, 0, 0, 0, 0),
    ("h2", 1, "g", "B", "p", "y", 0, 0, 0, 0, 0, 1), ("h2", 1, "g", "B", "p", "y", 0, 0, 0, 0, 0, 1),
]


def _exchanges(df):
    return str(df._jdf.queryExecution().executedPlan()).count("Exchange ")


@pytest.fixture
def deliveries(spark):
    return spark.createDataFrame(_ROWS, _DELIVERY)


def test_deliveries_are_shuffled_once_for_the_summary(deliveries):
    assert _exchanges(marts.document_sums(deliveries)) == 1


def test_partitions_of_the_summary_are_not_merged(deliveries):
    assert "REPARTITION_BY_NUM" in str(marts.document_sums(deliveries)._jdf.queryExecution().executedPlan())


def test_sums_and_leaders_per_document(deliveries):
    got = {(r.stg_file_hashkey, r.stg_file_row_number): r for r in marts.document_sums(deliveries).collect()}
    groups = defaultdict(list)
    for row in _ROWS:
        groups[row[:2]].append(row)
    assert set(got) == set(groups)
    for key, rows in groups.items():
        bowl, bat, runs = Counter(), Counter(), Counter()
        for r in rows:
            bowl[r[4]] += r[8]
            bat[r[5]] += r[6]
            if r[3] is not None:
                runs[r[3]] += r[6]
        first = lambda sums: min(sums.items(), key=lambda e: (-e[1], e[0] is not None, e[0] or ""))
        r = got[key]
        assert (r.highest_wicket_taker, r.wickets_taken) == first(bowl)
        assert (r.highest_run_scorer, r.runs_scored) == first(bat)
        assert {t: s.runs for t, s in r._teams.items()} == dict(runs)
        assert (r.balls, r.total_runs_scored, r.total_dot_balls) == (len(rows), sum(x[6] + x[7] for x in rows), sum(x[11] for x in rows))


def test_matches_without_deliveries_stay_and_are_numbered(spark, deliveries):
    named = {"stg_file_hashkey": ["h1", "h2", "h3"], "stg_file_name": ["f", "g", "z"], "day": ["2024-01-02", "2024-01-03", "2024-01-01"]}
    matches = spark.createDataFrame(list(zip(*named.values(), strict=True)), list(named)).select(
        "stg_file_hashkey", "stg_file_name", F.lit(1).alias("stg_file_row_number"), F.col("day").cast("date").alias("event_date"), F.lit(7).alias("match_type_number"),
        F.lit("A").alias("first_team"), F.lit("B").alias("second_team"), F.lit(True).alias("is_latest"), F.lit(1).alias("margin_value"),
        *(F.lit(1).alias(c) for c in ("event_year", "event_month")),
        *(F.lit("n").alias(c) for c in ("match_type", "venue", "toss_winner", "toss_decision", "winner", "margin_type", "player_of_match")),
    )
    rows = marts.match_summary(matches, deliveries).orderBy("match_summary_id").collect()
    assert [(r.match_summary_id, str(r.event_date), r.total_deliveries) for r in rows] == [(1, "2024-01-03", 2), (2, "2024-01-02", 4), (3, "2024-01-01", 0)]
    assert (rows[1].first_team_runs, rows[1].second_team_runs, rows[1].first_team_wickets) == (8, 6, 2)
    assert rows[2].highest_run_scorer is None and rows[2].first_team_runs == 0 and rows[2].total_runs_scored is None


def test_rolling_sums_reach_over_buckets(spark):
    from scorelake.operators.positions import rolling_sums

    rows = [(k, None if i % 13 == 5 else i * 2 + (i % 4 > 1), None if i % 7 == 3 else i) for k in ("a", "b", None) for i in range(40 if k else 3)]
    df = spark.createDataFrame(rows, "k string, at int, v int")
    got = rolling_sums(df, ["k"], [F.col("at").asc_nulls_last(), F.col("v").asc_nulls_first()], F.floor(F.col("at") / 6), "v", 5, "s", "n", nulls_first=False).collect()
    want = []
    for key in ("a", "b", None):
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is None, r[1] or 0, r[2] is not None, r[2] or 0))
        for i, r in enumerate(own):
            values = [x[2] for x in own[max(0, i - 4) : i + 1] if x[2] is not None]
            want.append((*r, sum(values) if values else None, len(values)))
    assert Counter(map(tuple, got)) == Counter(want)


def test_members_without_a_match_keep_one_row(spark, deliveries):
    players = spark.createDataFrame([("p", "A", True), ("p", "Z", True), ("nobody", "B", True), ("q", None, True), ("x", "B", False)], "player_name string, country string, is_latest boolean")
    matches = spark.createDataFrame([("h1", 1, "f", "A", "B"), ("h2", 1, "g", "A", "B")], "stg_file_hashkey string, stg_file_row_number int, stg_file_name string, first_team string, second_team string").selectExpr("*", "date'2001-01-02' as event_date")
    got = marts.player_performance(players, deliveries.selectExpr("*", "7 as match_type_number"), matches, "2001-09-01 00:00:00").collect()
    assert Counter((r.player_name, r.country, r.match_type_number, r.runs_scored, r.rolling_5_match_avg) for r in got) == Counter([
        ("p", "A", 7, 4, 4.0), ("p", "A", 7, 0, 2.0), ("p", "A", 7, 1, 1.67), ("p", "Z", None, 0, 0.0), ("nobody", "B", None, 0, 0.0), ("q", None, None, 0, 0.0)
    ])


def test_deliveries_are_shuffled_once_for_the_players(spark, deliveries):
    matches = spark.createDataFrame([("h1", 1, "f", "A", "B", None)], "stg_file_hashkey string, stg_file_row_number int, stg_file_name string, first_team string, second_team string, event_date date")
    assert _exchanges(marts.player_stats(deliveries.selectExpr("*", "7 as match_type_number"), matches)) == 2
