"""Inserts, upserts, updates, deletes and streaming loads.

``orders`` is split into a stored table and an arriving batch: the batch has newer versions
of some orders, stale versions of others, and new ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.operators.quality import apply_null_gate
from scorelake.operators.upsert import absent_facts, append_versions, changed_rows, insert_missing, upsert_newer
from scorelake.plans import bronze, silver
from scorelake.plans.monitor import stack
from scorelake.plans.refresh import VERSION
from scorelake.session import fresh_dir, pinned
from scorelake.sources.tables import Lake, delete_where, empty_like, month_slice, split_archive, update_where
from scorelake.streaming.changes import append_into, change_stream, fan_out, insert_missing_into, run_available, stream_lag, upsert_into
from scorelake.workload.match_docs import match_raw, with_all, with_deliveries, with_players
from scorelake.workload.registry import cleaned, query

_STORED = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate AS version FROM orders WHERE o_orderkey % 4 <> 0"
_BATCH = """SELECT o_orderkey, 'X' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS version FROM orders WHERE o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"""


def _stored(t):
    return t.orders.filter("o_orderkey % 4 <> 0").select("o_orderkey", "o_orderstatus", "o_totalprice", F.col("o_orderdate").alias("version"))


def _batch(t):
    newer = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate"))
    return t.orders.filter("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"), newer.alias("version")
    )


_UPSERT_SQL = f"""
WITH s AS ({_STORED}), b AS ({_BATCH})
SELECT s.o_orderkey, CASE WHEN b.version > s.version THEN b.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
  CASE WHEN b.version > s.version THEN b.o_totalprice ELSE s.o_totalprice END AS o_totalprice, CASE WHEN b.version > s.version THEN b.version ELSE s.version END AS version
FROM s LEFT JOIN b ON s.o_orderkey = b.o_orderkey
UNION ALL SELECT * FROM b WHERE b.o_orderkey NOT IN (SELECT o_orderkey FROM s)
"""


@query("merge_insert_only", "H1 H2 H3 H4", f"WITH s AS ({_STORED}), b AS ({_BATCH}) SELECT * FROM s UNION ALL SELECT * FROM b WHERE b.o_orderkey NOT IN (SELECT o_orderkey FROM s)")
def merge_insert_only(t):
    stored = _stored(t)
    return stored.unionByName(insert_missing(stored, _batch(t), ["o_orderkey"]))


@query("merge_newer_wins", "H5 H6 H7 H8 I9", _UPSERT_SQL)
def merge_newer_wins(t):
    return upsert_newer(_stored(t), _batch(t), ["o_orderkey"], "version")


@query(
    "merge_changed_rows", "I2 I3 H5",
    f"""WITH s AS ({_STORED}), b AS ({_BATCH}) SELECT b.o_orderkey, b.version, CASE WHEN s.o_orderkey IS NULL THEN 'INSERT' ELSE 'UPDATE' END AS _action
    FROM b LEFT JOIN s ON s.o_orderkey = b.o_orderkey WHERE s.o_orderkey IS NULL OR b.version > s.version""",
)
def merge_changed_rows(t):
    return changed_rows(_stored(t), _batch(t), ["o_orderkey"], "version").select("o_orderkey", "version", "_action")


@query("merge_keep_versions", "H9 Q2", f"WITH s AS ({_STORED}), b AS ({_BATCH}) SELECT * FROM s UNION ALL SELECT * FROM b WHERE (b.o_orderkey, b.version) NOT IN (SELECT o_orderkey, version FROM s)")
def merge_keep_versions(t):
    stored = _stored(t)
    return stored.unionByName(append_versions(stored, _batch(t), ["o_orderkey"], "version"))


@query("update_rows", "H10", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'INVALID' ELSE 'VALID' END AS status, CASE WHEN c_acctbal < 0 THEN 0.3::DOUBLE ELSE 1.0::DOUBLE END AS score FROM customer")
def update_rows(t):
    rows = t.customer.select("c_custkey", "c_acctbal", F.lit("VALID").alias("status"), F.lit(1.0).alias("score"))
    return update_where(rows, F.col("c_acctbal") < 0, {"status": F.lit("INVALID"), "score": F.lit(0.3)}).drop("c_acctbal")


@query("delete_rows", "H11 C13", "SELECT o_orderkey FROM orders WHERE NOT (year(o_orderdate) = 1997 AND month(o_orderdate) = 1)")
def delete_rows(t):
    return delete_where(t.orders, month_slice(F.col("o_orderdate"), 1997, 1)).select("o_orderkey")


@query(
    "archive_slice", "A17 A8 H11",
    "SELECT CASE WHEN year(o_orderdate) = 1996 AND month(o_orderdate) = 2 THEN 'archived' ELSE 'kept' END AS part, COUNT(*) AS n FROM orders GROUP BY 1",
)
def archive_slice(t):
    """Write both sides of the split and count what was written."""
    lake = Lake(t.spark, fresh_dir(t.spark, "archive"))
    archived, kept = split_archive(t.orders, month_slice(F.col("o_orderdate"), 1996, 2))
    lake.replace("archived", archived)
    lake.replace("kept", kept)
    count = lambda n: lake.read(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("part"), "n")
    return count("archived").unionByName(count("kept"))


@query("clustered_table", "A8 A16 A18", "SELECT o_orderstatus, COUNT(*) AS n FROM orders WHERE o_orderdate < TIMESTAMP '1996-01-01' GROUP BY 1")
def clustered_table(t):
    """Write the table range-clustered by date; the filter then prunes row groups."""
    lake = Lake(t.spark, fresh_dir(t.spark, "clustered"))
    lake.replace("orders", t.orders, ["o_orderdate", "o_orderkey"])
    return lake.read("orders").filter(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp_ntz")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query(
    "curve_layout", "A16 A18 M13",
    """
    SELECT 'l_shipdate' AS filtered, COUNT(*) AS n, SUM(l_quantity)::DOUBLE AS quantity, TRUE AS few_files FROM lineitem WHERE l_shipdate < (SELECT MIN(l_shipdate) + INTERVAL 60 DAY FROM lineitem)
    UNION ALL SELECT 'l_partkey', COUNT(*), SUM(l_quantity)::DOUBLE, TRUE FROM lineitem WHERE l_partkey <= 3
    UNION ALL SELECT 'l_orderkey', COUNT(*), SUM(l_quantity)::DOUBLE, TRUE FROM lineitem WHERE l_orderkey = 7""",
)
def curve_layout(t):
    """Lines laid out by ship date and part in 64 files, with a bloom filter on the order: each filter meets under a quarter of the files."""
    lake = Lake(t.spark, fresh_dir(t.spark, "curve"))
    lake.replace_curved("lines", t.lineitem, ["l_shipdate", "l_partkey"], 64, ["l_orderkey"])
    lines = lake.read("lines")
    first = lines.agg(F.min("l_shipdate") + F.expr("INTERVAL 60 DAY")).first()[0]
    filters = {"l_shipdate": F.col("l_shipdate") < F.lit(first).cast(lines.schema["l_shipdate"].dataType), "l_partkey": F.col("l_partkey") <= 3, "l_orderkey": F.col("l_orderkey") == 7}
    return stack([
        lines.filter(f).agg(
            F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("double").alias("quantity"), (F.count_distinct(F.col("_metadata.file_path")) < 16).alias("few_files")
        ).select(F.lit(name).alias("filtered"), "n", "quantity", "few_files")
        for name, f in filters.items()
    ])


@query("refresh_and_append", "A9 A10 A11", "SELECT COUNT(*) AS n, SUM(CASE WHEN n_regionkey = 0 THEN 1 ELSE 0 END)::BIGINT AS first_region FROM (SELECT * FROM nation UNION ALL SELECT * FROM nation)")
def refresh_and_append(t):
    """Typed empty table, full refresh, then an append."""
    lake = Lake(t.spark, fresh_dir(t.spark, "refresh"))
    lake.replace("nation", empty_like(t.nation))
    lake.replace("nation", t.nation)
    lake.append("nation", t.nation)
    return lake.read("nation").agg(F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("n_regionkey") == 0, 1).otherwise(0)).alias("first_region"))


@query("insert_absent_facts", "H13 D8", "SELECT * FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')")
def insert_absent_facts(t):
    loaded = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return absent_facts(loaded, t.lineitem, "l_orderkey")


@query(
    "bronze_merge_replay", "H1 H3 I9",
    with_players("SELECT COUNT(*) AS players, (SELECT COUNT(*) FROM matches) AS matches, 0::BIGINT AS replayed FROM (SELECT DISTINCT stg_file_name, country, player_name FROM players)"),
)
def bronze_merge_replay(t):
    """Loading the same documents again inserts nothing."""
    raw = match_raw(t)
    players, matches = bronze.bronze_players(raw), bronze.bronze_matches(raw)
    again = insert_missing(players, players, bronze.PLAYER_KEYS, large_batch=True).agg(F.count(F.lit(1))).scalar()
    first = insert_missing(empty_like(players), players, bronze.PLAYER_KEYS, VERSION)
    return first.agg(
        F.count(F.lit(1)).alias("players"), F.first(matches.agg(F.count(F.lit(1))).scalar()).alias("matches"), F.first(again).alias("replayed")
    )


@query(
    "silver_insert_only_merge", "H2 H4",
    with_deliveries(
        f"""SELECT stg_file_name, {cleaned("coalesce(batter, '')", 'Unknown')} AS batter, COUNT(*) AS n FROM deliveries WHERE match_type_number IS NOT NULL AND over <> 0 GROUP BY 1, 2"""
    ),
)
def silver_insert_only_merge(t):
    """A second batch adds the deliveries whose (file, over, batter, bowler) key is not stored."""
    keys = ["stg_file_hashkey", "over", "batter", "bowler"]
    # both batches are rows of one cleaning, which is done once
    rows = pinned(silver.silver_deliveries(bronze.bronze_deliveries(match_raw(t)).filter("match_type_number <> -1"), test_raw=False).select("stg_file_name", *keys))
    stored = rows.filter("over = 0")
    fresh = insert_missing(stored, rows, keys, large_batch=True)
    return fresh.groupBy("stg_file_name", "batter").agg(F.count(F.lit(1)).alias("n"))


def _layer_merge(name: str, covers: str, rows_of, keys: list[str], marker: str, body: str):
    """Newer-wins merge of layer rows under their real keys: three quarters are stored, a batch brings new, newer and equally old ones."""

    sql = with_all(f"""
    SELECT r.stg_file_name, CASE WHEN r.k % 4 = 0 OR r.k % 3 = 0 THEN 'Changed' ELSE r.{marker} END AS {marker},
      m.m + CASE WHEN r.k % 3 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL 0 DAY END AS stg_modified_ts
    FROM ({body}) r JOIN matches m ON m.k = r.k WHERE r.k % 4 <> 0 OR r.k % 2 = 0 OR r.k % 3 = 0""")

    @query(name, covers, sql)
    def merged(t):
        rows = rows_of(match_raw(t)).withColumn("k", F.regexp_extract("stg_file_name", r"\d+", 0).cast("bigint"))
        newer = F.when(F.col("k") % 3 == 0, F.col(VERSION) + F.expr("INTERVAL 1 DAY")).otherwise(F.col(VERSION))
        batch = rows.filter("k % 2 = 0 OR k % 3 = 0").withColumns({marker: F.lit("Changed"), VERSION: newer})
        return upsert_newer(rows.filter("k % 4 <> 0"), batch, keys, VERSION, match_nulls=True, large_batch=True).select("stg_file_name", marker, VERSION)

    return merged


_layer_merge("bronze_match_merge", "H7 I9", bronze.bronze_matches, bronze.MATCH_KEYS, "season", "SELECT k, stg_file_name, season FROM matches")
_layer_merge("bronze_player_merge", "H5 I9", bronze.bronze_players, bronze.PLAYER_KEYS, "source_system", "SELECT k, stg_file_name, 'CRICKET_JSON' AS source_system FROM players")
_layer_merge("bronze_delivery_merge", "H6 I9", bronze.bronze_deliveries, bronze.BALL_KEYS, "extra_type", "SELECT k, stg_file_name, extra_type FROM deliveries")
_layer_merge(
    "silver_match_merge", "H8 I9", lambda raw: silver.silver_matches(bronze.bronze_matches(raw)), bronze.MATCH_KEYS, "season", "SELECT k, stg_file_name, season FROM matches"
)
_layer_merge(
    "silver_delivery_merge", "H8 I9", lambda raw: silver.silver_deliveries(bronze.bronze_deliveries(raw)), bronze.BALL_KEYS, "data_quality_status",
    "SELECT k, stg_file_name, CASE WHEN bowler IS NULL THEN 'INVALID' ELSE 'VALID' END AS data_quality_status FROM deliveries",
)


# --- streaming --------------------------------------------------------------------------------


def _stream(t, name):
    """The table's file as a stream source."""
    return t.spark.readStream.schema(getattr(t, name).schema).parquet(f"{t.sf_dir}/{name[:-1]}[{name[-1]}].parquet")


@query("stream_append", "I1 I5 A4", "SELECT event_type, COUNT(*) AS n FROM events GROUP BY 1")
def stream_append(t):
    """Two runs over the same files: the second finds nothing new."""
    lake = Lake(t.spark, fresh_dir(t.spark, "stream"))
    for _ in range(2):
        run_available(_stream(t, "events"), fan_out(append_into(lake, "events")), lake.path("_checkpoint"))
    return lake.read("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("stream_upsert", "I2 I8 I9 H5", _UPSERT_SQL)
def stream_upsert(t):
    """The stored half is loaded first; the orders then stream in as updates, and changes are kept."""
    lake = Lake(t.spark, fresh_dir(t.spark, "upsert"))
    upsert_into(lake, "target", ["o_orderkey"], "version", buckets=8)(_stored(t), -1)
    newer = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("o_orderdate"))
    arriving = _stream(t, "orders").filter("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), (F.col("o_totalprice") + 1).alias("o_totalprice"), newer.alias("version")
    )
    run_available(arriving, fan_out(upsert_into(lake, "target", ["o_orderkey"], "version", buckets=8)), lake.path("_checkpoint"))
    return lake.read("target").drop("bucket")


@query(
    "stream_fan_out", "I3 I4 I7",
    f"""WITH b AS ({_BATCH}) SELECT 'upserts' AS consumer, COUNT(*) AS n FROM b UNION ALL SELECT 'inserts', COUNT(*) FROM b UNION ALL SELECT 'changes', COUNT(*) FROM b WHERE o_orderkey % 5 = 0""",
)
def stream_fan_out(t):
    """One stream feeds an upsert and an insert-only table; a reader follows the upsert's changes."""
    lake = Lake(t.spark, fresh_dir(t.spark, "fanout"))
    arriving = _stream(t, "orders").filter("o_orderkey % 2 = 0 OR o_orderkey % 3 = 0").select("o_orderkey", "o_orderstatus", F.col("o_orderdate").alias("version"))
    both = fan_out(upsert_into(lake, "upserts", ["o_orderkey"], "version", buckets=8), insert_missing_into(lake, "inserts", ["o_orderkey"]))
    run_available(arriving, both, lake.path("_checkpoints/a"))
    run_available(change_stream(lake, "upserts").filter("o_orderkey % 5 = 0"), fan_out(append_into(lake, "changes")), lake.path("_checkpoints/b"))
    count = lambda n: lake.read(n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("consumer"), "n")
    return count("upserts").unionByName(count("inserts")).unionByName(count("changes"))


@query("stream_lag_report", "I10", "SELECT MAX(ts) AS newest, MAX(ts) FILTER (event_type = 'click') AS loaded, date_diff('minute', MAX(ts) FILTER (event_type = 'click'), MAX(ts)) AS lag_minutes FROM events")
def stream_lag_report(t):
    return stream_lag(t.events, t.events.filter("event_type = 'click'"), "ts")


@query("null_gate", "L4 H10 Q4", "SELECT o_orderkey, CASE WHEN o_orderkey % 50 = 0 THEN 'INVALID' ELSE 'VALID' END AS tight, 'VALID' AS loose FROM orders")
def null_gate(t):
    """Two percent NULLs pass a five percent gate and trip a one percent gate."""
    rows = t.orders.select(
        "o_orderkey", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderstatus")).alias("s"), F.lit("VALID").alias("data_quality_status"), F.lit(1.0).alias("data_quality_score")
    )
    tight = apply_null_gate(rows, ["s"], 0.01).select("o_orderkey", F.col("data_quality_status").alias("tight"), "s", F.lit("VALID").alias("data_quality_status"), F.lit(1.0).alias("data_quality_score"))
    return apply_null_gate(tight, ["s"], 0.05).select("o_orderkey", "tight", F.col("data_quality_status").alias("loose"))
