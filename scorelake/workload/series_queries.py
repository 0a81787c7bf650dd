"""Time-series analyses with events as observations: the type is the series, the user the station."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.operators.timeseries import (
    above, align_outer, attach_correlation, between_dates, bucket_average, series_extract, split_series, values_on, weekly_volatility, with_chart_parts, year_over_year,
)
from scorelake.workload.registry import query, rounded


def _exact_avg(column: str) -> str:
    return f"SUM(CAST({column} AS DECIMAL(18,2))) * 1.0 / COUNT(*)"


@query(
    "monthly_average", "N1 C14",
    f"""SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {rounded(_exact_avg('o_totalprice'))} AS avg_price FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE n_name = 'NATION_3' AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1""",
)
def monthly_average(t):
    """Average of one country's observations per month over two years."""
    stations = t.customer.join(t.nation.filter("n_name = 'NATION_3'"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey")
    rows = t.orders.filter(between_dates("o_orderdate", "1996-01-01", "1998-01-01")).join(stations, F.col("o_custkey") == F.col("c_custkey"))
    return bucket_average(rows, "month", "o_orderdate", "o_totalprice", "month", "avg_price").orderBy("month")


@query("series_extract", "N2", "SELECT event_type, ts, value FROM events WHERE event_type IN ('click', 'view') AND ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12'")
def series_extract_events(t):
    return series_extract(t.events.select("event_type", "ts", "value"), "event_type", ["click", "view"], "ts", "2024-01-10", "2024-01-12")


@query(
    "monthly_average_with_stations", "N3 C27 E2",
    f"""SELECT month, avg_price, customers, CAST(year(month) AS INTEGER) AS year, CAST(month(month) AS INTEGER) AS month_num, substr(monthname(month), 1, 3) AS label, month(month) BETWEEN 6 AND 11 AS in_season
    FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {rounded(_exact_avg('o_totalprice'))} AS avg_price, COUNT(DISTINCT o_custkey) AS customers FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1)""",
)
def monthly_average_with_stations(t):
    rows = t.orders.filter(between_dates("o_orderdate", "1997-01-01", "1998-01-01"))
    return with_chart_parts(bucket_average(rows, "month", "o_orderdate", "o_totalprice", "month", "avg_price", {"o_custkey": "customers"}), "month")


@query(
    "weekly_volatility", "N4 F6 E7 E10",
    f"""WITH r AS (SELECT event_type, ts, value / nullif(lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id), 0) - 1 AS ret FROM events)
    SELECT CAST(date_trunc('week', ts) AS DATE) AS week_start, event_type, {rounded('stddev_samp(ret) * 100', 4)} AS volatility_pct FROM r WHERE ret IS NOT NULL GROUP BY 1, 2 HAVING COUNT(*) >= 3""",
)
def weekly_volatility_of_events(t):
    """The lag is taken per hour bucket and carried over bucket borders, so one busy series is not one task."""
    bucket = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    return weekly_volatility(t.events.select("event_id", "event_type", "ts", "value"), "event_type", "ts", "value", bucket, ties=("event_id",))


@query(
    "year_over_year_with_second_series", "N5 D6 D7 C28",
    f"""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(COUNT(*) AS DOUBLE) AS n FROM orders GROUP BY 1),
    y AS (SELECT a.month, {rounded('(a.n / b.n - 1) * 100')} AS yoy_pct FROM m a JOIN m b ON b.month = a.month - INTERVAL 1 YEAR),
    s AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, {rounded(_exact_avg('l_quantity'))} AS avg_quantity FROM lineitem GROUP BY 1)
    SELECT coalesce(y.month, s.month) AS month, yoy_pct, avg_quantity, avg_quantity > yoy_pct AS quantity_above FROM y FULL JOIN s ON y.month = s.month""",
)
def year_over_year_with_second_series(t):
    monthly = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    change = year_over_year(monthly, "month", "n", "yoy_pct")
    second = bucket_average(t.lineitem, "month", "l_shipdate", "l_quantity", "month", "avg_quantity")
    return above(align_outer(change, second, "month"), "avg_quantity", "yoy_pct", "quantity_above")


@query(
    "weekly_correlation", "N6 F8 E8 D1",
    f"""WITH a AS (SELECT CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start, {rounded(_exact_avg('o_totalprice'))} AS avg_price FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' GROUP BY 1),
    b AS (SELECT CAST(date_trunc('week', l_shipdate) AS DATE) AS week_start, {rounded(_exact_avg('l_quantity'))} AS avg_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1)
    SELECT a.week_start, avg_price, avg_quantity, {rounded('corr(avg_price, avg_quantity) OVER ()', 6)} AS pearson_corr FROM a JOIN b ON a.week_start = b.week_start""",
)
def weekly_correlation(t):
    prices = bucket_average(t.orders.filter(between_dates("o_orderdate", "1997-01-01", "1998-01-01")), "week", "o_orderdate", "o_totalprice", "week_start", "avg_price")
    sizes = bucket_average(t.lineitem.filter(between_dates("l_shipdate", "1997-01-01", "1998-01-01")), "week", "l_shipdate", "l_quantity", "week_start", "avg_quantity")
    both = attach_correlation(prices.join(sizes, "week_start"), "avg_price", "avg_quantity")
    return both.withColumn("pearson_corr", F.round("pearson_corr", 6)).orderBy("week_start")


@query(
    "series_per_year", "N7",
    f"SELECT CAST(year(o_orderdate) AS INTEGER) AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, {rounded(_exact_avg('o_totalprice'))} AS avg_price FROM orders GROUP BY 1, 2",
)
def series_per_year(t):
    monthly = bucket_average(t.orders, "month", "o_orderdate", "o_totalprice", "month", "avg_price")
    return split_series(monthly, F.year("month"))


@query(
    "values_on_dates", "N8",
    """WITH d(day, label) AS (VALUES (DATE '1997-03-31', 'first cut'), (DATE '1997-06-30', 'second cut'), (DATE '1890-01-01', 'no value'))
    SELECT day, label, COUNT(*) AS n_orders FROM orders JOIN d ON CAST(o_orderdate AS DATE) = day GROUP BY 1, 2""",
)
def values_on_dates(t):
    dates = t.spark.createDataFrame([("1997-03-31", "first cut"), ("1997-06-30", "second cut"), ("1890-01-01", "no value")], "day string, label string").withColumn("day", F.to_date("day"))
    daily = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n_orders"))
    return values_on(daily, "day", dates)
