"""Scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorelake.functions.ball import ball_flags, freshness_class, six_over_block
from scorelake.functions.casts import percent, ratio, safe_date, safe_int
from scorelake.functions.dates import (
    boundaries_between, bucket_date, chart_parts, date_parts, hierarchy_parts, one_year_before, within_days, within_hours,
)
from scorelake.functions.text import clean_text, drop_null_literals, or_default, register_clean_text, squeeze, title_case
from scorelake.operators.timeseries import above
from scorelake.workload.registry import cleaned, query, rounded, titled

# Names with every kind of white space and punctuation, made from the part table.
_MESSY_SQL = """
messy AS (SELECT p_partkey, CASE p_partkey % 7
  WHEN 0 THEN '  ' || p_name || '  x.' || p_brand WHEN 1 THEN chr(9) WHEN 2 THEN '' WHEN 3 THEN NULL
  WHEN 4 THEN p_name || chr(10) || chr(9) || p_type || '-' || p_brand WHEN 5 THEN 'o''' || p_name || ' (' || p_brand || ')/' || p_type
  ELSE '   ' END AS name FROM part)"""


def _messy(t):
    key = F.col("p_partkey") % 7
    return t.part.select(
        "p_partkey",
        F.when(key == 0, F.concat(F.lit("  "), "p_name", F.lit("  x."), "p_brand"))
        .when(key == 1, F.lit("\t")).when(key == 2, F.lit("")).when(key == 3, F.lit(None))
        .when(key == 4, F.concat("p_name", F.lit("\n\t"), "p_type", F.lit("-"), "p_brand"))
        .when(key == 5, F.concat(F.lit("o'"), "p_name", F.lit(" ("), "p_brand", F.lit(")/"), "p_type"))
        .otherwise(F.lit("   ")).alias("name"),
    )


@query(
    "clean_text_rules", "C5 C6 C7 C8",
    f"""WITH {_MESSY_SQL} SELECT p_partkey, {cleaned('name', 'Unknown')} AS collapsed,
    {cleaned('name', 'None', test_raw=True)} AS raw_tested, {cleaned('name', 'Unknown', collapse=False)} AS trimmed FROM messy""",
)
def clean_text_rules(t):
    name = F.col("name")
    return _messy(t).select(
        "p_partkey",
        clean_text(name, "Unknown").alias("collapsed"),
        clean_text(name, "None", test_raw=True).alias("raw_tested"),
        clean_text(name, "Unknown", collapse=False).alias("trimmed"),
    )


@query("clean_text_sql_function", "Q1 C5", f"WITH {_MESSY_SQL} SELECT p_partkey, {cleaned('name', 'Unknown')} AS name FROM messy")
def clean_text_sql_function(t):
    register_clean_text(t.spark)
    return _messy(t).selectExpr("p_partkey", "clean_text(name, 'Unknown') AS name")


@query(
    "text_primitives", "C9",
    f"""WITH {_MESSY_SQL} SELECT p_partkey, {titled('name')} AS titled, {titled('name', '')} AS titled_words, trim(name) AS trimmed,
    regexp_replace(name, '\\s+', ' ', 'g') AS squeezed FROM messy""",
)
def text_primitives(t):
    name = F.col("name")
    return _messy(t).select(
        "p_partkey", title_case(name).alias("titled"), title_case(name, punctuation=False).alias("titled_words"),
        F.trim(name).alias("trimmed"), squeeze(name).alias("squeezed"),
    )


@query("null_literals", "A1 C24", f"WITH {_MESSY_SQL} SELECT p_partkey, nullif(name, '') AS name, coalesce(nullif(name, ''), 'NA') AS filled FROM messy")
def null_literals(t):
    name = drop_null_literals(F.col("name"))
    return _messy(t).select("p_partkey", name.alias("name"), or_default(name, "NA").alias("filled"))


@query(
    "safe_casts", "B5 C19",
    """
    SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS bad_number, CAST(floor(o_orderkey / 10.0 + 0.5) AS INTEGER) AS rounded_number,
      CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS day
    FROM orders
    """,
)
def safe_casts(t):
    text = F.concat((F.col("o_orderkey") / 10).cast("decimal(20,1)").cast("string"))
    day = F.when(F.col("o_orderkey") % 3 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(F.date_format("o_orderdate", "yyyy/MM"))
    return t.orders.select("o_orderkey", safe_int(F.col("o_orderpriority")).alias("bad_number"), safe_int(text).alias("rounded_number"), safe_date(day).alias("day"))


_DAYS = "(SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)"


@query(
    "calendar_parts", "C10 C11 C12 C13 C26",
    f"""
    SELECT d, CAST(day(d) AS INTEGER) AS day, CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
      CAST(isodow(d) AS INTEGER) AS dayofweek, CAST(day(d) AS INTEGER) AS dayofmonth, CAST(dayofyear(d) AS INTEGER) AS dayofyear,
      substr(dayname(d), 1, 3) AS dayofweekname, isodow(d) >= 6 AS isweekend, monthname(d) AS month_name, 'Qtr ' || quarter(d) AS quarter_name
    FROM {_DAYS} WHERE year(d) >= 1996 AND month(d) <= 11
    """,
)
def calendar_parts(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct().filter((F.year("d") >= 1996) & (F.month("d") <= 11))
    names = hierarchy_parts(F.col("d"))
    return days.select("d", *(v.alias(n) for n, v in date_parts(F.col("d")).items()), names["month"].alias("month_name"), names["quarter"].alias("quarter_name"))


@query(
    "date_buckets", "C14 C16",
    f"SELECT d, CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(date_trunc('week', d) AS DATE) AS week_start, CAST(d - INTERVAL 1 YEAR AS DATE) AS year_before FROM {_DAYS}",
)
def date_buckets(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.select("d", bucket_date("month", F.col("d")).alias("month_start"), bucket_date("week", F.col("d")).alias("week_start"), one_year_before(F.col("d")).alias("year_before"))


@query(
    "boundary_differences", "C15",
    """
    SELECT event_id, date_diff('minute', ts, ts + INTERVAL 95 SECOND) AS minutes, date_diff('second', ts, ts + INTERVAL 1500 MILLISECOND) AS seconds,
      date_diff('minute', TIMESTAMP '2024-02-01 00:00:00', ts) AS minutes_before, date_diff('hour', ts, TIMESTAMP '2024-02-01 00:00:00') AS hours
    FROM events
    """,
)
def boundary_differences(t):
    ts, end = F.col("ts"), F.lit("2024-02-01 00:00:00").cast("timestamp_ntz")
    return t.events.select(
        "event_id",
        boundaries_between("minute", ts, ts + F.expr("INTERVAL 95 SECONDS")).alias("minutes"),
        boundaries_between("second", ts, ts + F.expr("INTERVAL '1.5' SECOND")).alias("seconds"),
        boundaries_between("minute", end, ts).alias("minutes_before"),
        boundaries_between("hour", ts, end).alias("hours"),
    )


@query(
    "look_back_windows", "C17 C18",
    """
    SELECT event_type, COUNT(*) FILTER (CAST(ts AS DATE) >= DATE '2024-01-24') AS last_week, COUNT(*) FILTER (ts >= TIMESTAMP '2024-01-30 12:00:00') AS last_day,
      DATE '2024-01-31' AS as_of FROM events GROUP BY event_type
    """,
)
def look_back_windows(t):
    as_of = "2024-01-31 12:00:00"
    return t.events.groupBy("event_type").agg(
        F.count_if(within_days(F.col("ts").cast("date"), 7, as_of)).alias("last_week"),
        F.count_if(within_hours(F.col("ts"), 24, as_of)).alias("last_day"),
        F.lit("2024-01-31").cast("date").alias("as_of"),
    )


@query(
    "delivery_flags", "C2 C21 C22 C23 K2",
    """
    SELECT l_orderkey, l_linenumber, l_quantity, CAST(CASE WHEN l_linenumber > 0 THEN (l_linenumber - 1) // 6 + 1 ELSE 0 END AS INTEGER) AS session_id,
      CAST(CASE WHEN l_quantity % 7 = 4 THEN 1 ELSE 0 END AS INTEGER) AS boundary_4_count, CAST(CASE WHEN l_quantity % 7 = 6 THEN 1 ELSE 0 END AS INTEGER) AS boundary_6_count,
      CAST(CASE WHEN l_quantity % 7 = 0 AND l_discount = 0 THEN 1 ELSE 0 END AS INTEGER) AS dot_ball_count, CAST(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS INTEGER) AS wicket_flag,
      'delivery' AS record_source, TRUE AS is_latest
    FROM lineitem
    """,
)
def delivery_flags(t):
    runs = (F.col("l_quantity") % 7).cast("int")
    out = F.when(F.col("l_returnflag") == "R", "R").otherwise("None")
    flags = ball_flags(runs, F.col("l_discount"), out)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", six_over_block(F.col("l_linenumber")).alias("session_id"),
        *(v.alias(n) for n, v in flags.items()), F.lit("delivery").alias("record_source"), F.lit(True).alias("is_latest"),
    )


@query(
    "safe_ratios", "C3 C4 C20 C28 C29",
    f"""
    SELECT c_custkey, {rounded('c_acctbal / nullif(c_nationkey, 0)', 7)} AS per_nation, {rounded('c_nationkey * 100.0 / 25', 1)} AS pct,
      coalesce(nullif(c_nationkey, 0), -1) AS nation_or_missing, c_acctbal > 1000 AS above_limit,
      CASE WHEN c_nationkey <= 15 THEN 'Green (Fresh)' WHEN c_nationkey <= 30 THEN 'Yellow (Stale)' ELSE 'Red (Delayed)' END AS light
    FROM customer
    """,
)
def safe_ratios(t):
    nation = F.col("c_nationkey")
    rows = t.customer.withColumn("limit", F.lit(1000.0))
    return above(rows, "c_acctbal", "limit", "above_limit").select(
        "c_custkey", F.round(ratio(F.col("c_acctbal"), nation), 7).alias("per_nation"), percent(nation, F.lit(25), 1).alias("pct"),
        F.coalesce(F.nullif(nation, F.lit(0)), F.lit(-1)).alias("nation_or_missing"), "above_limit", freshness_class(nation).alias("light"),
    )


@query(
    "predicates", "C1 C25",
    """
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus IN ('F', 'O')
      AND o_orderpriority <> '5-LOW' AND (o_totalprice > 200000 OR o_custkey IS NULL) AND o_custkey IS NOT NULL
    """,
)
def predicates(t):
    c = F.col
    return t.orders.filter(
        (c("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz")) & (c("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
        & c("o_orderstatus").isin("F", "O") & (c("o_orderpriority") != "5-LOW") & ((c("o_totalprice") > 200000) | c("o_custkey").isNull()) & c("o_custkey").isNotNull()
    ).select("o_orderkey", "o_orderstatus", "o_totalprice")


@query(
    "chart_columns", "C27",
    f"SELECT d, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month_num, substr(monthname(d), 1, 3) AS label, month(d) BETWEEN 6 AND 11 AS in_season FROM {_DAYS}",
)
def chart_columns(t):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    return days.select("d", *(v.alias(n) for n, v in chart_parts(F.col("d")).items()))
