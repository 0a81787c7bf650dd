"""Rules, key checks, run log and alerts on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.operators.quality import (
    Rule, duplicate_keys, graded_score, not_null_violations, null_share, orphan_rows, rule_violations, status_and_score, valid_current,
)
from scorelake.plans import monitor
from scorelake.workload.registry import query, rounded


@query(
    "status_and_score", "L1 L2 L3",
    "SELECT c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'INVALID' ELSE 'VALID' END AS data_quality_status, CASE WHEN c_acctbal < 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS data_quality_score, COUNT(*) AS n FROM customer GROUP BY ALL",
)
def status_and_score_counts(t):
    rows = t.customer.withColumns(status_and_score([Rule("balance", F.col("c_acctbal") >= 0)], 0.5))
    return rows.groupBy("c_mktsegment", "data_quality_status", "data_quality_score").agg(F.count(F.lit(1)).alias("n"))


@query("valid_current_rows", "L3", "SELECT c_custkey FROM customer WHERE c_acctbal >= 0")
def valid_current_rows(t):
    rows = t.customer.withColumns({**status_and_score([Rule("balance", F.col("c_acctbal") >= 0)], 0.0), "is_current_record": F.lit(True)})
    return valid_current(rows).select("c_custkey")


@query("graded_scores", "L24", "SELECT CASE WHEN c_acctbal < 0 THEN 0.0::DOUBLE WHEN c_nationkey = 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS score, COUNT(*) AS n FROM customer GROUP BY 1")
def graded_scores(t):
    score = graded_score([Rule("balance", F.col("c_acctbal") >= 0)], [Rule("nation", F.col("c_nationkey") != 0)])
    return t.customer.groupBy(score.alias("score")).agg(F.count(F.lit(1)).alias("n"))


@query("null_share", "L4", f"SELECT COUNT(*) FILTER (o_orderkey % 50 = 0) AS null_rows, COUNT(*) AS all_rows, {rounded('COUNT(*) FILTER (o_orderkey % 50 = 0) * 1.0 / COUNT(*)', 6)} AS null_share FROM orders")
def null_share_of_orders(t):
    rows = t.orders.withColumn("s", F.when(F.col("o_orderkey") % 50 != 0, F.col("o_orderstatus")))
    return null_share(rows, ["s"]).withColumn("null_share", F.round("null_share", 6))


@query("not_null_checks", "L11", "SELECT 'o_custkey' AS column_name, COUNT(*) FILTER (o_custkey IS NULL) AS null_rows FROM orders UNION ALL SELECT 'o_orderdate', COUNT(*) FILTER (o_orderdate IS NULL) FROM orders")
def not_null_checks(t):
    return not_null_violations(t.orders, ["o_custkey", "o_orderdate"])


@query("primary_key_duplicates", "L12", "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1")
def primary_key_duplicates(t):
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("foreign_key_orphans", "L13", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_totalprice <= 480000)")
def foreign_key_orphans(t):
    return orphan_rows(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), t.orders.filter("o_totalprice <= 480000"), "l_orderkey", "o_orderkey")


@query(
    "business_rule_violations", "L14",
    """SELECT 'quantity_range' AS rule, COUNT(*) FILTER (NOT l_quantity BETWEEN 1 AND 45) AS violations FROM lineitem UNION ALL SELECT 'shipped_after_2000', COUNT(*) FILTER (NOT l_shipdate > TIMESTAMP '2000-01-01') FROM lineitem
    UNION ALL SELECT 'discount_not_negative', COUNT(*) FILTER (NOT l_discount >= 0) FROM lineitem""",
)
def business_rule_violations(t):
    rules = [
        Rule("quantity_range", F.col("l_quantity").between(1, 45)),
        Rule("shipped_after_2000", F.col("l_shipdate") > F.lit("2000-01-01").cast("timestamp_ntz")),
        Rule("discount_not_negative", F.col("l_discount") >= 0),
    ]
    return rule_violations(t.lineitem, rules)


# A run log made from events: one run per event, the type as task, errors as failures.
_LOG_SQL = "log AS (SELECT event_type AS task_name, ts AS execution_ts, CASE WHEN value > 100 THEN 'FAILED' ELSE 'SUCCESS' END AS status, user_id AS rows_processed, CAST(floor(value) AS BIGINT) AS duration_seconds FROM events)"
_NOW = "2024-01-31 00:00:00"


def _log(t):
    return t.events.select(
        F.col("event_type").alias("task_name"), F.col("ts").alias("execution_ts"), F.when(F.col("value") > 100, "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("user_id").alias("rows_processed"), F.floor("value").cast("long").alias("duration_seconds"),
    )


@query("recent_runs", "L6 L10", f"WITH {_LOG_SQL} SELECT task_name, execution_ts, status, rows_processed, duration_seconds, date_diff('minute', execution_ts, TIMESTAMP '{_NOW}') AS minutes_ago FROM log ORDER BY execution_ts DESC, task_name LIMIT 50")
def recent_runs(t):
    return monitor.recent_runs(_log(t), 50, _NOW)


@query("failed_runs", "L6", f"WITH {_LOG_SQL} SELECT * FROM log WHERE status = 'FAILED'")
def failed_runs(t):
    return monitor.failed_runs(_log(t))


@query(
    "task_status", "L22",
    f"""WITH {_LOG_SQL} SELECT task_name, execution_ts AS last_run, CASE WHEN status = 'SUCCESS' THEN '✓' ELSE '✗' END AS status, date_diff('minute', execution_ts, TIMESTAMP '{_NOW}') AS minutes_since_run, duration_seconds
    FROM (SELECT *, row_number() OVER (PARTITION BY task_name ORDER BY execution_ts DESC) AS r FROM log WHERE execution_ts >= TIMESTAMP '{_NOW}' - INTERVAL 24 HOUR) WHERE r = 1""",
)
def task_status(t):
    return monitor.task_status(_log(t), 24, _NOW)


@query(
    "alert_thresholds", "L21",
    f"""WITH {_LOG_SQL}, m AS (SELECT 'task_duration_seconds' AS metric, CAST(MAX(duration_seconds) AS DOUBLE) AS value, 300.0::DOUBLE AS threshold FROM log UNION ALL SELECT 'failed_runs', CAST(COUNT(*) FILTER (status = 'FAILED') AS DOUBLE), 0.0 FROM log
    UNION ALL SELECT 'invalid_pct', {rounded("COUNT(*) FILTER (c_acctbal < 0) * 100.0 / COUNT(*)", 6)}, 5.0 FROM customer UNION ALL SELECT 'row_drop_pct', {rounded("(SELECT COUNT(*) FILTER (c_acctbal < 0) * 100.0 / COUNT(*) FROM customer)", 6)}, 10.0)
    SELECT *, value > threshold AS alert FROM m""",
)
def alert_thresholds(t):
    scored = t.customer.withColumns(status_and_score([Rule("balance", F.col("c_acctbal") >= 0)], 0.0))
    metrics = monitor.log_metrics(_log(t)).unionByName(monitor.layer_metrics(scored, scored, monitor.valid_only(scored)))
    return monitor.alerts(metrics.withColumn("value", F.round("value", 6)))
