"""Tables kept up by changes, reconciled and rolled up; files parsed by many tasks."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.fixed_values import VALID
from scorelake.operators.digests import differences
from scorelake.operators.distinct import dense_ids, distinct_bitmaps, distinct_counts, rolled_up
from scorelake.operators.images import changes_between, net_changes
from scorelake.operators.joins import cross_filtered
from scorelake.operators.positions import lag_in_groups, number_in_groups, range_buckets, rolling_in_groups
from scorelake.plans import bronze, maintain, monitor, star
from scorelake.plans.refresh import VERSION, gate_nulls
from scorelake.session import fresh_dir
from scorelake.sources.documents import accepted_raw, raw_projection, rejected_documents
from scorelake.sources.json_arrays import array_documents
from scorelake.sources.tables import Lake
from scorelake.streaming.changes import change_log, upsert_into
from scorelake.workload.dimension_queries import _clean, _with_facts, build_star, with_star
from scorelake.workload.layer_queries import AS_OF, Layers, with_layers
from scorelake.workload.match_docs import match_texts
from scorelake.workload.registry import query, rounded

# --- change logs ------------------------------------------------------------------------------


@query(
    "change_consolidation", "I2 I3",
    """
    WITH s AS (SELECT o_orderkey AS k, o_totalprice AS price, o_orderstatus AS status FROM orders WHERE o_orderkey % 4 <> 0),
    e AS (
      SELECT o_orderkey AS k, CASE WHEN o_orderkey % 4 <> 0 AND o_orderkey % 3 = 0 AND o_orderkey % 6 <> 0 THEN o_totalprice + 1 ELSE o_totalprice END AS price,
        CASE WHEN o_orderkey % 7 = 0 THEN 'Z' ELSE o_orderstatus END AS status
      FROM orders WHERE (o_orderkey % 4 <> 0 AND o_orderkey % 10 <> 0) OR (o_orderkey % 8 = 0 AND o_orderkey % 16 <> 0)
    )
    SELECT coalesce(s.k, e.k) AS o_orderkey, CASE WHEN s.k IS NULL THEN 'INSERT' WHEN e.k IS NULL THEN 'DELETE' ELSE 'UPDATE' END AS action,
      s.price AS price_before, e.price AS price_after, s.status AS status_before, e.status AS status_after
    FROM s FULL JOIN e ON s.k = e.k WHERE s.k IS NULL OR e.k IS NULL OR s.price <> e.price OR s.status <> e.status""",
)
def change_consolidation(t):
    """Three batches insert, update and delete; some of it is taken back by a later one."""
    k = F.col("o_orderkey")
    start = t.orders.filter(k % 4 != 0).select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    new = t.orders.filter(k % 8 == 0).select("o_orderkey", F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    raised = lambda condition: F.when(condition, F.col("price") + 1).otherwise(F.col("price")).alias("price")
    first = start.filter(k % 10 != 0).select("o_orderkey", raised(k % 3 == 0), "status").unionByName(new)
    second = start.filter(k % 10 != 0).select("o_orderkey", raised((k % 3 == 0) & (k % 6 != 0)), "status").unionByName(new.filter(k % 16 != 0))
    third = second.withColumn("status", F.when(k % 7 == 0, "Z").otherwise(F.col("status")))
    steps = [start, first, second, third]
    log = None
    for offset, (old, state) in enumerate(zip(steps, steps[1:], strict=False), 1):
        part = changes_between(old, state, ["o_orderkey"]).withColumn("offset", F.lit(offset))
        log = part if log is None else log.unionByName(part)
    net = net_changes(log, ["o_orderkey"], "offset", after=0, upto=3)
    image = lambda when, c: F.col(f"_{when}.{c}").alias(f"{c}_{when}")
    return net.select("o_orderkey", F.col("_action").alias("action"), *(image(w, c) for c in ("price", "status") for w in ("before", "after")))


# --- gold kept up to date ---------------------------------------------------------------------

_REVISED = {
    "over, runs, extras, total,": "over, CAST(runs + CASE WHEN k % 97 = 3 THEN 1 ELSE 0 END AS INTEGER) AS runs, extras, total,",
    "FROM silver_match WHERE data_quality_status = 'VALID'": "FROM silver_match WHERE data_quality_status = 'VALID' AND CAST(regexp_extract(stg_file_name, '[0-9]+') AS BIGINT) % 89 <> 5",
}


def _with_revised(body: str) -> str:
    sql = with_layers(body)
    for old, new in _REVISED.items():
        assert old in sql
        sql = sql.replace(old, new)
    return sql


_REFRESHED: dict[tuple[str, str], Lake] = {}


def refreshed(t) -> Lake:
    """Two loads: nearly all documents; then the last hundredth, with revised deliveries and matches that are no longer valid."""
    key = (t.spark.sparkContext.applicationId, t.sf_dir)
    if key in _REFRESHED:
        return _REFRESHED[key]
    layers, lake = Layers(t), Lake(t.spark, fresh_dir(t.spark, "refreshed"))
    k = F.regexp_extract("stg_file_name", "[0-9]+", 0).cast("bigint")
    late, revised, invalid = k % 100 == 7, k % 97 == 3, k % 89 == 5
    newer = lambda condition: F.when(condition, F.col(VERSION) + F.expr("INTERVAL 1 DAY")).otherwise(F.col(VERSION))
    loads = [
        (layers.silver_match.filter(~late), layers.silver_delivery.filter(~late)),
        (
            layers.silver_match.filter(late | invalid).withColumns({"data_quality_status": F.when(invalid, "INVALID").otherwise(F.col("data_quality_status")), VERSION: newer(invalid)}),
            layers.silver_delivery.filter(late | revised).withColumns({"runs": F.when(revised, F.col("runs") + 1).otherwise(F.col("runs")), VERSION: newer(revised)}),
        ),
    ]
    for number, (matches, deliveries) in enumerate(loads):
        upsert_into(lake, "silver_match", bronze.MATCH_KEYS, VERSION, buckets=8, images=True)(matches, number)
        upsert_into(lake, "silver_delivery", bronze.BALL_KEYS, VERSION, buckets=8, images=True)(deliveries, number)
        maintain.refresh_gold(lake, AS_OF)
    _REFRESHED[key] = lake
    return lake


@query(
    "gold_incremental_refresh", "I8 I7 K7 K8",
    _with_revised("""
    SELECT match_summary_id, stg_file_name, winner, first_team_runs, second_team_runs, total_deliveries, total_runs_scored, total_boundaries_4, total_dot_balls,
      highest_wicket_taker, highest_run_scorer, runs_scored FROM match_summary"""),
)
def gold_incremental_refresh(t):
    """Match summaries kept up over two loads are those of a rebuild."""
    return maintain.match_summary(refreshed(t)).select(
        "match_summary_id", "stg_file_name", "winner", "first_team_runs", "second_team_runs", "total_deliveries", "total_runs_scored", "total_boundaries_4", "total_dot_balls",
        "highest_wicket_taker", "highest_run_scorer", "runs_scored",
    )


@query(
    "incremental_team_totals", "I8 M6",
    _with_revised("""
    SELECT team_name, COUNT(*) AS rows, SUM(runs)::BIGINT AS runs, SUM(extras)::BIGINT AS extras, SUM(wicket_flag)::BIGINT AS wicket_flag, SUM(boundary_4_count)::BIGINT AS boundary_4_count,
      SUM(boundary_6_count)::BIGINT AS boundary_6_count, SUM(dot_ball_count)::BIGINT AS dot_ball_count FROM gold_delivery GROUP BY 1"""),
)
def incremental_team_totals(t):
    """Sums of what each refresh added and took back."""
    return maintain.team_totals(refreshed(t))


# --- reconciliation and rollups ---------------------------------------------------------------


@query(
    "layer_differences", "L18 F7",
    """
    SELECT o_orderkey, 'lost' AS kind, 1::BIGINT AS source_rows, 0::BIGINT AS target_rows FROM orders WHERE o_orderkey % 97 = 0
    UNION ALL SELECT o_orderkey, 'repeated', 1, 2 FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 = 0
    UNION ALL SELECT o_orderkey, 'changed', 1, 1 FROM orders WHERE o_orderkey % 97 <> 0 AND o_orderkey % 89 <> 0 AND o_orderkey % 83 = 0
    UNION ALL SELECT o_orderkey + 1000000000, 'added', 0, 1 FROM orders WHERE o_orderkey % 101 = 0""",
)
def layer_differences(t):
    """A copy of the orders that lost, doubled, changed and gained rows; the row counts alone would not tell."""
    k = F.col("o_orderkey")
    kept = t.orders.filter(k % 97 != 0).withColumn("o_totalprice", F.when(k % 83 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))
    gained = t.orders.filter(k % 101 == 0).withColumn("o_orderkey", k + F.lit(1_000_000_000))
    target = kept.unionByName(kept.filter(k % 89 == 0)).unionByName(gained)
    return differences(t.orders, target, ["o_orderkey"])


_GRAINS = ["day", "month", "quarter", "year"]


@query(
    "distinct_rollup", "E2 E14 E17",
    " UNION ALL ".join(f"SELECT '{g}' AS grain, CAST(date_trunc('{g}', o_orderdate) AS DATE) AS period, COUNT(DISTINCT o_custkey) AS customers FROM orders GROUP BY ALL" for g in _GRAINS),
)
def distinct_rollup(t):
    """Distinct customers of days, united to months, quarters and years without reading an order again."""
    starts = {g: F.trunc("o_orderdate", g).alias(g) for g in _GRAINS[1:]}
    known = t.orders.select("o_custkey", F.col("o_orderdate").cast("date").alias("day"), *starts.values()).join(dense_ids(t.orders, "o_custkey"), "o_custkey")
    level, result = distinct_bitmaps(known, _GRAINS, "id"), None
    for i, grain in enumerate(_GRAINS):
        level = level if i == 0 else rolled_up(level, _GRAINS[i:])
        part = distinct_counts(level, [grain], "customers").select(F.lit(grain).alias("grain"), F.col(grain).alias("period"), "customers")
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "range_split_windows", "F1 F4 F5 F6",
    """
    SELECT event_id, row_number() OVER w AS place, lag(event_id) OVER w AS previous,
      SUM(event_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS 4 PRECEDING)::BIGINT AS last_five
    FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts, event_id)""",
)
def range_split_windows(t):
    """Numbers, lags and rolling sums per event type, which few keys hold; ranges cut them evenly."""
    keys, order = ["event_type"], ["ts", "event_id"]
    cut = range_buckets(t.events.select("event_type", "ts", "event_id"), keys, order)
    placed = number_in_groups(cut, keys, [F.col(c) for c in order], F.col("bucket"), "place")
    lagged = lag_in_groups(placed, keys, order, "event_id", F.col("bucket"), "previous")
    return rolling_in_groups(lagged, keys, "place", 5, {"last_five": F.sum("event_id")}).select("event_id", "place", "previous", "last_five")


# --- star schema ------------------------------------------------------------------------------


@query(
    "cross_filtered_visuals", "D13 P5 P9 P10",
    with_star("""
    WITH m AS (
      SELECT match_fact.* FROM match_fact JOIN days USING (date_id) JOIN venues USING (venue_id)
      WHERE full_dt BETWEEN DATE '1996-01-01' AND DATE '1996-02-15' AND venue_name LIKE 'ground 1%'
    )
    SELECT 'match' AS kind, CAST(match_id AS VARCHAR) AS member FROM m
    UNION SELECT 'type', match_type FROM kinds WHERE match_type_id IN (SELECT match_type_id FROM m)
    UNION SELECT 'team', team_name FROM teams WHERE team_id IN (SELECT team_id FROM delivery_fact WHERE match_id IN (SELECT match_id FROM m))
    UNION SELECT 'day', CAST(full_dt AS VARCHAR) FROM days WHERE date_id IN (SELECT date_id FROM m)"""),
)
def cross_filtered_visuals(t):
    """A date and a venue slicer change what the match, type, team and date visuals list."""
    tables = _with_facts(t)
    slicers = {"date_dim": F.col("full_dt").between("1996-01-01", "1996-02-15"), "venue_dim": F.col("venue_name").startswith("ground 1")}
    result = None
    for kind, table, column in (("match", "match_fact", "match_id"), ("type", "match_type_dim", "match_type"), ("team", "team_dim", "team_name"), ("day", "date_dim", "full_dt")):
        part = cross_filtered(tables, slicers, table).select(F.lit(kind).alias("kind"), F.col(column).cast("string").alias("member")).distinct()
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "match_fact_two_documents", "J8 H13",
    with_star("""SELECT match_id, 2::BIGINT AS documents, bowls_played_by_team_a AS fewest_balls, bowls_played_by_team_a AS most_balls, 2 * total_score_by_team_b::BIGINT AS score_of_both
    FROM match_fact"""),
)
def match_fact_two_documents(t):
    """Every match comes in two documents of one load; each fact has the totals of its own."""
    matches, _, deliveries = _clean(t)
    document = ("stg_file_hashkey", "stg_file_row_number")
    twice = lambda df: df.unionByName(df.withColumn("stg_file_hashkey", F.concat("stg_file_hashkey", F.lit("-again"))))
    facts = star.match_fact(twice(matches), twice(deliveries), build_star(t), lineage=document)
    return facts.groupBy("match_id").agg(
        F.count(F.lit(1)).alias("documents"), F.min("bowls_played_by_team_a").alias("fewest_balls"), F.max("bowls_played_by_team_a").alias("most_balls"),
        F.sum("total_score_by_team_b").alias("score_of_both"),
    )


# --- run metrics ------------------------------------------------------------------------------


@query(
    "run_metrics", "L4 L6 L9 I10",
    f"""
    WITH n AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (o_orderkey % 50 = 0) AS nulls, COUNT(*) FILTER (o_orderkey % 4 <> 0) AS stored,
      COUNT(*) FILTER (o_orderkey % 4 = 0) AS added, COUNT(*) FILTER (o_orderkey % 4 <> 0 AND o_orderkey % 3 = 0) AS newer FROM orders)
    SELECT 'first_load' AS task_name, stored AS rows_processed, 0::BIGINT AS rows_affected, NULL::BIGINT AS records_checked, NULL::DOUBLE AS data_quality_score FROM n
    UNION ALL SELECT 'second_load', added + newer, newer, NULL, NULL FROM n
    UNION ALL SELECT 'gate', n, nulls, n, {rounded("(n - nulls) * 1.0 / n", 4)} FROM n
    UNION ALL SELECT 'gate_again', 0, 0, 0, {rounded("(n - nulls) * 1.0 / n", 4)} FROM n""",
)
def run_metrics(t):
    """The run log of two loads and two gates, with the counts that the writes themselves delivered; the second gate finds no changed bucket."""
    lake = Lake(t.spark, fresh_dir(t.spark, "metrics"))
    rows = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderstatus")).alias("status"), F.lit(VALID).alias("data_quality_status"),
        F.lit(1.0).alias("data_quality_score"), F.col("o_orderdate").alias("version"),
    )
    newer = F.when(F.col("o_orderkey") % 3 == 0, F.col("version") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("version"))
    upsert, log = upsert_into(lake, "orders", ["o_orderkey"], "version", buckets=8), change_log("orders")

    def load(batch, label):
        upsert(batch, label)
        return monitor.StepResult(lake.counts.total([log]), affected=lake.counts.total([log], "update"))

    def gate():
        looked, marked, n, valid = gate_nulls(lake, "orders", ["status"], 0.01, 0.3)
        return monitor.StepResult(looked, affected=marked, checked=looked, score=round(valid / n, 4))

    monitor.logged(lake, "first_load", lambda: load(rows.filter("o_orderkey % 4 <> 0"), 1))
    monitor.logged(lake, "second_load", lambda: load(rows.withColumn("version", newer).filter("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"), 2))
    monitor.logged(lake, "gate", gate)
    monitor.logged(lake, "gate_again", gate)
    return lake.read("run_log").select("task_name", "rows_processed", "rows_affected", "records_checked", "data_quality_score")


# --- files ------------------------------------------------------------------------------------

_PER_ARRAY = 2000


def _large_arrays(t) -> str:
    """All documents, broken ones included, as arrays of many documents, one to a line."""
    folder = fresh_dir(t.spark, "arrays")
    key = F.regexp_extract("file_name", "[0-9]+", 0).cast("bigint")
    single = F.regexp_replace("value", r"^\[|\]$", "")
    rows = match_texts(t).select(key.alias("k"), single.alias("value")).withColumn("part", F.floor(F.col("k") / _PER_ARRAY))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("k", "value"))), lambda d: d["value"])  # a fixed number of documents
    arrays = rows.groupBy("part").agg(F.concat(F.lit("[\n"), F.array_join(listed, ",\n"), F.lit("\n]")).alias("value"))
    arrays.write.partitionBy("part").text(folder)
    return folder


@query(
    "array_file_load", "A1 A3 A4 A5 A7",
    f"""
    WITH d AS (
      SELECT o_orderkey // {_PER_ARRAY} AS part, row_number() OVER (PARTITION BY o_orderkey // {_PER_ARRAY} ORDER BY o_orderkey) AS n,
        CASE WHEN o_orderkey % 71 = 0 THEN 'unreadable document' WHEN o_orderkey % 50 = 0 THEN 'innings missing' ELSE 'accepted' END AS outcome
      FROM orders
    ), f AS (SELECT part, outcome, COUNT(*) AS documents, MAX(n)::BIGINT AS last_row FROM d GROUP BY ALL)
    SELECT outcome, documents, last_row, COUNT(*) AS files FROM f GROUP BY ALL""",
)
def array_file_load(t):
    """Arrays of many documents, whose pieces are parsed by as many tasks as there are blocks."""
    lake = Lake(t.spark, fresh_dir(t.spark, "arrays"))
    lake.replace("all", raw_projection(array_documents(t.spark, _large_arrays(t))))  # read for accepted and rejected documents
    raw = lake.read("all")
    accepted = accepted_raw(raw).select(F.lit("accepted").alias("outcome"), "stg_file_hashkey", "stg_file_row_number")
    rejected = rejected_documents(raw).select(F.col("rejection_reason").alias("outcome"), "stg_file_hashkey", "stg_file_row_number")
    per_file = accepted.unionByName(rejected).groupBy("outcome", "stg_file_hashkey").agg(
        F.count(F.lit(1)).alias("documents"), F.max("stg_file_row_number").cast("long").alias("last_row")
    )
    return per_file.groupBy("outcome", "documents", "last_row").agg(F.count(F.lit(1)).alias("files"))
