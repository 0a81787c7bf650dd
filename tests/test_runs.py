"""End-to-end runs over files."""

from pyspark.sql import functions as F

from scorelake.operators.quality import orphan_rows
from scorelake.plans.refresh import run_layers, run_star
from tests.docs import document, write

AS_OF = "2023-11-01 00:00:00"


def test_layers_from_files_to_marts(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "lake")
    write(source, "a.json", document(1))
    write(source, "b.json", [document(2, dates=["2023-10-20"])])
    write(source, "bad.json", "{")
    lake = run_layers(spark, str(source), root, AS_OF)
    counts = lambda: {n: lake.read(n).count() for n in ("bronze_player", "bronze_delivery", "silver_delivery", "gold_delivery_fact", "match_summary")}
    log = {r.task_name: r for r in lake.read("run_log").collect()}
    raw, stored = log["load_raw"], log["load_bronze"]
    assert (raw.rows_processed, raw.rows_affected, raw.records_checked, raw.data_quality_score) == (3, 2, 3, 0.6667)
    assert (stored.rows_processed, stored.rows_affected, stored.records_checked) == (22, 22, 2) and stored.stream_lag_hours is not None
    assert log["refresh_gold"].dynamic_table_lag_minutes == 0 and log["silver_validation"].records_checked > 0
    first = counts()
    assert first == {"bronze_player": 8, "bronze_delivery": 12, "silver_delivery": 12, "gold_delivery_fact": 12, "match_summary": 2}
    summary = lake.read("match_summary").orderBy("match_summary_id").collect()
    assert [str(r.event_date) for r in summary] == ["2023-10-20", "2023-10-14"]
    top = summary[0]
    assert (top.first_team_runs, top.second_team_runs, top.second_team_wickets, top.margin_value, top.highest_run_scorer, top.highest_wicket_taker) == (4, 6, 2, 3, "B One", "A One")
    player = lake.read("silver_player").filter("data_quality_status = 'INVALID'").first()
    assert (player.player_name, player.data_quality_score) == ("Unknown", 0.5)

    run_layers(spark, str(source), root, AS_OF)
    assert counts() == first

    write(source, "c.json", document(3, dates=["2023-10-25"]))
    run_layers(spark, str(source), root, AS_OF)
    assert lake.read("silver_delivery").count() == 18 and lake.read("match_summary").count() == 3
    performance = lake.read("player_performance").filter("player_name = 'A One'").orderBy("match_type_number").collect()
    assert [(r.balls_faced, r.runs_scored, r.wickets_taken, r.role_type) for r in performance] == [(3, 4, 2, "All-rounder")] * 3
    assert lake.read("run_log").filter("status = 'SUCCESS'").count() == 24
    assert lake.read("run_log").filter("rows_processed IS NULL").count() == 0
    loaded = [r.rows_processed for r in lake.read("run_log").filter("task_name = 'load_raw'").collect()]
    assert sorted(loaded) == [0, 1, 3]


def test_star_keeps_ids_over_loads(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "star")
    write(source, "a.json", document(1, city="x"))
    lake = run_star(spark, str(source), root)
    teams = {r.team_name: r.team_id for r in lake.read("team_dim").collect()}
    assert teams == {"alpha": 1, "beta": 2}
    fact = lake.read("match_fact").first()
    assert (fact.match_id, fact.overs_played_by_team_a, fact.bowls_played_by_team_a, fact.extra_bowls_played_by_team_a, fact.extra_runs_scored_by_team_a, fact.total_score_by_team_a) == (1, 1, 3, 6, 3, 7)
    assert (fact.total_overs, fact.balls_per_over, fact.match_result, fact.winner_team_id) == (50, 6, "Result Declared", 1)

    write(source, "b.json", document(2, city="y", teams=["aardvark", "beta"], players={"aardvark": ["z"], "beta": ["b one"]}, dates=["2023-10-13"], outcome={"winner": "beta"}))
    run_star(spark, str(source), root)
    again = {r.team_name: r.team_id for r in lake.read("team_dim").collect()}
    assert again == {"alpha": 1, "beta": 2, "aardvark": 3}
    days = {str(r.full_dt): r.date_id for r in lake.read("date_dim").collect()}
    assert days == {"2023-10-14": 1, "2023-10-13": 2}
    facts = lake.read("match_fact")
    before = facts.count(), lake.read("delivery_fact").count()
    run_star(spark, str(source), root)
    assert (lake.read("match_fact").count(), lake.read("delivery_fact").count()) == before
    assert orphan_rows(lake.read("match_fact"), lake.read("team_dim"), "winner_team_id", "team_id").count() == 0
    assert orphan_rows(lake.read("delivery_fact"), lake.read("player_dim"), "batter_id", "player_id").count() == 0
    assert lake.read("delivery_fact").filter(F.col("extra_type").isNull()).count() == 0


def test_star_loads_unnumbered_documents_once(spark, tmp_path):
    source, root = tmp_path / "in", str(tmp_path / "star")
    write(source, "a.json", document(1, city="x"))
    write(source, "b.json", document(None, city="x", dates=["2023-10-15"]))
    lake = run_star(spark, str(source), root)
    first = lake.read("delivery_fact").count()
    for _ in range(2):
        run_star(spark, str(source), root)
        assert lake.read("delivery_fact").count() == first


def test_loads_of_several_consumers_add_up(spark, tmp_path):
    from scorelake.sources.tables import Lake
    from scorelake.streaming.ingest import load_unseen, stream_files

    one, two, lake = tmp_path / "one", tmp_path / "two", Lake(spark, str(tmp_path / "lake"))
    for i in range(3):
        write(one, f"{i}.json", document(i + 1))
    write(two, "x.json", document(9))
    load_unseen(lake, str(one))
    stream_files(lake, str(two), lake.path("_checkpoints/a"))
    assert lake.read("raw").count() == 4
    load_unseen(lake, str(one))
    stream_files(lake, str(two), lake.path("_checkpoints/a"))
    assert lake.read("raw").count() == 4
