"""End-to-end runs: files to layers and marts, files to star schema."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.fixed_values import CLUSTER_KEYS, NULL_SHARE_BRONZE, NULL_SHARE_SILVER, SCORE_GATE_INVALID
from scorelake.functions.dates import as_of_literal, minutes_between
from scorelake.operators.quality import mark_nulls, null_profile
from scorelake.operators.upsert import absent_facts, insert_missing
from scorelake.plans import bronze, gold, marts, monitor, silver, star
from scorelake.sources.tables import Lake
from scorelake.streaming.changes import change_log, change_stream, fan_out, run_available, table_stream, upsert_into
from scorelake.streaming.ingest import stream_files

_BRONZE = {
    "player": (bronze.bronze_players, bronze.PLAYER_KEYS),
    "delivery": (bronze.bronze_deliveries, bronze.BALL_KEYS),
    "match": (bronze.bronze_matches, bronze.MATCH_KEYS),
}
_SILVER = {"player": silver.silver_players, "delivery": silver.silver_deliveries, "match": silver.silver_matches}
VERSION = "stg_modified_ts"


def _score(valid: int, rows: int) -> float | None:
    return round(valid / rows, 4) if rows else None


def _read_rows(query) -> int:
    """Rows the micro-batches of a finished stream took in."""
    return sum(p["numInputRows"] for p in query.recentProgress)


def _lag_hours(lake: Lake, names: list[str], as_of) -> float | None:
    """Hours from the newest version that is stored to now."""
    tables = [lake.read(n).agg(F.max(VERSION).alias("newest")) for n in names if lake.exists(n)]
    if not tables:
        return None
    newest = monitor.stack(tables).agg(F.max("newest").alias("newest"))
    return newest.select((minutes_between(F.col("newest"), as_of_literal(as_of)) / 60.0).alias("h")).first()["h"]


def load_raw(lake: Lake, source: str) -> monitor.StepResult:
    """New files to raw rows and rejects; checked are the files, the score is the share of accepted documents."""
    query = stream_files(lake, source, lake.path("_checkpoints/raw"))
    accepted, rejected = lake.counts.total(["raw"]), lake.counts.total(["rejects"])
    return monitor.StepResult(accepted + rejected, affected=accepted, checked=_read_rows(query), score=_score(accepted, accepted + rejected))


def load_bronze(lake: Lake, as_of=None) -> monitor.StepResult:
    """New raw rows to the three bronze tables, in order, from one micro-batch each; counts the rows inserted and updated."""
    handlers = [
        upsert_into(lake, f"bronze_{kind}", keys, VERSION, lambda raw, make=make: make(raw, as_of))
        for kind, (make, keys) in _BRONZE.items()
    ]
    query = run_available(table_stream(lake, "raw"), fan_out(*handlers), lake.path("_checkpoints/bronze"))
    return _changes(lake, "bronze", list(_BRONZE), _read_rows(query), as_of)


def load_silver(lake: Lake, as_of=None) -> monitor.StepResult:
    """Bronze changes to silver, each table with its own reader; counts the rows inserted and updated."""
    read = 0
    for kind, make in _SILVER.items():
        name = f"bronze_{kind}"
        if lake.exists(change_log(name)):
            handler = upsert_into(lake, f"silver_{kind}", _BRONZE[kind][1], VERSION, lambda rows, make=make: make(rows, as_of))
            read += _read_rows(run_available(change_stream(lake, name), fan_out(handler), lake.path(f"_checkpoints/silver_{kind}")))
    return _changes(lake, "silver", list(_SILVER), read, as_of)


def _changes(lake: Lake, layer: str, kinds: list[str], read: int, as_of) -> monitor.StepResult:
    logs = [change_log(f"{layer}_{kind}") for kind in kinds]
    rows = lake.counts.total(logs)
    written = lake.counts.total(logs, "insert") + lake.counts.total(logs, "update")
    score = _score(lake.counts.total(logs, "valid"), rows)
    return monitor.StepResult(rows, affected=written, checked=read, score=score, stream_lag_hours=_lag_hours(lake, [f"{layer}_match"], as_of))


PROFILE = "bucket string, files string, rows long, valid long, null_rows long, unmarked long"


def gate_nulls(lake: Lake, name: str, columns: list[str], threshold: float, score: float | None) -> tuple[int, int, int, int]:
    """Mark rows with NULLs where their share of the table is too high; rows looked at, rows marked, rows and valid rows of the table.

    A profile per storage bucket is kept beside the table. Only buckets whose files changed since
    are profiled again, and only buckets with rows to mark are written. A lost profile is made anew.
    """
    profile = f"{name}__profile"
    files = lake.partition_files(name, "bucket")
    known = {r["bucket"]: r for r in lake.read(profile, PROFILE).collect() if files.get(r["bucket"]) == r["files"]}  # one row a bucket

    def profiled(buckets: list[str]) -> dict:
        rows = lake.read(name).filter(F.col("bucket").cast("string").isin(buckets))
        return {r["bucket"]: r for r in null_profile(rows, columns, "bucket", score).collect()}

    stale = sorted(set(files) - set(known))
    fresh = profiled(stale) if stale else {}
    looked = sum(r["rows"] for r in fresh.values())
    known |= fresh
    rows, nulls = sum(r["rows"] for r in known.values()), sum(r["null_rows"] for r in known.values())
    todo = sorted(b for b, r in known.items() if r["unmarked"]) if rows and nulls / rows > threshold else []
    marked = sum(known[b]["unmarked"] for b in todo)
    if todo:
        lake.rewrite_partitions(name, mark_nulls(lake.read(name).filter(F.col("bucket").cast("string").isin(todo)), columns, score), "bucket")
        files = lake.partition_files(name, "bucket")
        known |= profiled(todo)
    if stale or todo:
        kept = [(b, files[b], r["rows"], r["valid"], r["null_rows"], r["unmarked"]) for b, r in sorted(known.items())]
        lake.replace(profile, lake.spark.createDataFrame(kept, PROFILE).coalesce(1))
    return looked, marked, rows, sum(r["valid"] for r in known.values())


def _gate(lake: Lake, layer: str, gates: dict, threshold: float, score: float | None) -> monitor.StepResult:
    found = [gate_nulls(lake, f"{layer}_{kind}", columns, threshold, score) for kind, columns in gates.items() if lake.exists(f"{layer}_{kind}")]
    looked, marked, rows, valid = (sum(f[i] for f in found) for i in range(4))
    return monitor.StepResult(looked, affected=marked, checked=looked, score=_score(valid, rows))


def gate_bronze(lake: Lake) -> monitor.StepResult:
    return _gate(lake, "bronze", bronze.GATED, NULL_SHARE_BRONZE, None)


def gate_silver(lake: Lake) -> monitor.StepResult:
    return _gate(lake, "silver", silver.GATED, NULL_SHARE_SILVER, SCORE_GATE_INVALID)


def _refreshed(lake: Lake, names: list[str]) -> monitor.StepResult:
    rows = lake.counts.total(names)
    graded = [n for n in names if "valid" in lake.counts.tables[n]]
    score = _score(lake.counts.total(graded, "valid"), lake.counts.total(graded))
    return monitor.StepResult(rows, checked=rows, score=score, lag_minutes=lake.counts.largest(names, "lag_minutes"))


def refresh_gold(lake: Lake, as_of=None) -> monitor.StepResult:
    players, deliveries, matches = (lake.read(f"silver_{kind}") for kind in ("player", "delivery", "match"))
    made = {
        "gold_player_dim": gold.player_dim(players, as_of),
        "gold_delivery_fact": gold.delivery_fact(deliveries, as_of),
        "gold_match_dim": gold.match_dim(matches, as_of),
    }
    for name, df in made.items():
        lake.replace(name, df, CLUSTER_KEYS[name])
    return _refreshed(lake, list(made))


def refresh_marts(lake: Lake, as_of=None) -> monitor.StepResult:
    players, deliveries, matches = (lake.read(n) for n in ("gold_player_dim", "gold_delivery_fact", "gold_match_dim"))
    lake.replace("player_performance", marts.player_performance(players, deliveries, matches, as_of), CLUSTER_KEYS["player_performance"])
    lake.replace("match_summary", marts.match_summary(matches, deliveries, as_of), CLUSTER_KEYS["match_summary"])
    return _refreshed(lake, ["player_performance", "match_summary"])


def validate_marts(lake: Lake) -> monitor.StepResult:
    """Rows of all gold tables, and WARNING where a required one is empty."""
    required = {n: lake.read(n) for n in ("gold_player_dim", "gold_delivery_fact", "gold_match_dim")}
    others = {n: lake.read(n) for n in ("player_performance", "match_summary")}
    found = monitor.mart_validation(required, others).first()
    return monitor.StepResult(found["rows_processed"], affected=0, checked=found["rows_processed"], status=found["status"])


def run_layers(spark, source: str, root: str, as_of=None) -> Lake:
    """Files to raw, bronze, silver, gold and marts; every stage is logged in ``run_log``."""
    lake = Lake(spark, root)
    stages = {
        "load_raw": lambda: load_raw(lake, source),
        "load_bronze": lambda: load_bronze(lake, as_of),
        "bronze_validation": lambda: gate_bronze(lake),
        "load_silver": lambda: load_silver(lake, as_of),
        "silver_validation": lambda: gate_silver(lake),
        "refresh_gold": lambda: refresh_gold(lake, as_of),
        "refresh_marts": lambda: refresh_marts(lake, as_of),
        "mart_validation": lambda: validate_marts(lake),
    }
    for name, stage in stages.items():
        monitor.logged(lake, name, stage)
    return lake


def _extend(lake: Lake, name: str, candidates, key: str, columns: list[str]) -> None:
    """Append the members a stored dimension lacks."""
    if lake.exists(name):
        lake.append(name, star.extend_dim(lake.read(name), candidates, key, columns))
    else:
        lake.append(name, star.with_ids(candidates, key, columns))


_DOCUMENT = ("stg_file_hashkey", "stg_file_row_number")


def _without_facts(lake: Lake, fact: str, rows):
    """Rows whose document has no fact yet, nor its match under another document; found before the star join.

    Documents are told apart by file hash and row number, so rows without a match number are loaded once too.
    """
    if not lake.exists(fact):
        return rows
    stored = lake.read(fact)
    fresh = absent_facts(stored, rows, *_DOCUMENT, match_nulls=True)
    return absent_facts(stored.select(F.col("match_id").alias("match_type_number")), fresh, "match_type_number")


def run_star(spark, source: str, root: str) -> Lake:
    """Files to clean tables, dimensions and facts; ids stay the same from run to run."""
    lake = Lake(spark, root)
    stream_files(lake, source, lake.path("_checkpoints/raw"))
    raw = lake.read("raw")
    for name, make in (
        ("clean_match", star.clean_match_detail),
        ("clean_player", lambda rows: star.clean_players(rows, cleaned=False)),
        ("clean_delivery", star.clean_deliveries),
    ):
        # documents already loaded are dropped before they are parsed
        fresh = absent_facts(lake.read(name), raw, *_DOCUMENT, match_nulls=True) if lake.exists(name) else raw
        lake.append(name, make(fresh))

    matches, players, deliveries = (lake.read(n) for n in ("clean_match", "clean_player", "clean_delivery"))
    _extend(lake, "team_dim", star.team_names(matches), "team_id", ["team_name"])
    teams = lake.read("team_dim")
    _extend(lake, "player_dim", star.team_players(players, teams), "player_id", ["team_id", "player_name"])
    _extend(lake, "venue_dim", star.venues(matches), "venue_id", ["venue_name", "city"])
    _extend(lake, "match_type_dim", matches.select("match_type").distinct(), "match_type_id", ["match_type"])
    dates = matches.select(F.col("event_date").alias("full_dt")).filter("full_dt is not null").distinct()
    known = lake.read("date_dim", "date_id int, full_dt date")
    new_days = insert_missing(known, dates, ["full_dt"])
    ids = star.with_ids(new_days, "date_id", ["full_dt"], known)
    parts = star.date_parts(F.col("full_dt"))
    lake.append("date_dim", ids.select("date_id", "full_dt", *(v.alias(n) for n, v in parts.items())))

    dims = {n: lake.read(n) for n in ("team_dim", "player_dim", "venue_dim", "match_type_dim", "date_dim")}
    todo = _without_facts(lake, "match_fact", matches)
    played = deliveries.join(todo.select("match_type_number").distinct(), "match_type_number", "left_semi")
    lake.append("match_fact", star.match_fact(todo, played, dims, lineage=_DOCUMENT))
    rows = _without_facts(lake, "delivery_fact", deliveries)
    lake.append("delivery_fact", star.delivery_fact(rows, dims, lineage=_DOCUMENT))
    return lake
