"""Joins, aggregates, windows, ordering and set operations on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorelake.functions.casts import percent, ratio
from scorelake.operators.joins import Relationship, follow, lookup
from scorelake.operators.positions import best_by, lag_in_groups, number_in_groups, number_rows, rolling_in_groups, top_rows
from scorelake.operators.timeseries import align_outer, attach_correlation, year_over_year
from scorelake.plans import reports
from scorelake.workload.registry import query, rounded

# exact decimals, so that rounding cannot depend on the order of additions
_REVENUE = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"


# --- D: joins ---------------------------------------------------------------------------------


@query("inner_join_nations", "D1", "SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def inner_join_nations(t):
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name", "r_name")


@query(
    "star_join", "D2 E4",
    f"""
    SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, cr.r_name AS customer_region, sr.r_name AS supplier_region, p_type, COUNT(*) AS n_lines, {rounded('SUM(' + _REVENUE + ')', 2)} AS revenue
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN region cr ON cn.n_regionkey = cr.r_regionkey
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey JOIN region sr ON sn.n_regionkey = sr.r_regionkey JOIN part ON l_partkey = p_partkey
    GROUP BY 1, 2, 3, 4
    """,
)
def star_join(t):
    """Nation and region play two roles each."""
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    customers = lookup(t.customer, places, {"c_nationkey": "n_nationkey"}, {"r_name": "customer_region"}).select("c_custkey", "customer_region")
    suppliers = lookup(t.supplier, places, {"s_nationkey": "n_nationkey"}, {"r_name": "supplier_region"}).select("s_suppkey", "supplier_region")
    orders = lookup(t.orders, customers, {"o_custkey": "c_custkey"}, {"customer_region": "customer_region"})
    star = lookup(t.lineitem, orders, {"l_orderkey": "o_orderkey"}, {"o_orderdate": "o_orderdate", "customer_region": "customer_region"})
    star = lookup(star, suppliers, {"l_suppkey": "s_suppkey"}, {"supplier_region": "supplier_region"})
    star = lookup(star, t.part, {"l_partkey": "p_partkey"}, {"p_type": "p_type"})
    return star.groupBy(F.year("o_orderdate").alias("order_year"), "customer_region", "supplier_region", "p_type").agg(
        F.count(F.lit(1)).alias("n_lines"), F.round(F.sum(F.expr(_REVENUE)), 2).cast("double").alias("revenue")
    )


@query(
    "role_playing_join", "D3",
    "SELECT l_orderkey, l_linenumber, s1.s_name AS supplier, s2.s_name AS by_part, s3.s_name AS by_line FROM lineitem JOIN supplier s1 ON l_suppkey = s1.s_suppkey JOIN supplier s2 ON l_partkey % 10 = s2.s_suppkey JOIN supplier s3 ON l_linenumber = s3.s_suppkey",
)
def role_playing_join(t):
    fact = t.lineitem.withColumns({"k2": F.col("l_partkey") % 10, "k3": F.col("l_linenumber").cast("long")})
    for key, role in (("l_suppkey", "supplier"), ("k2", "by_part"), ("k3", "by_line")):
        fact = lookup(fact, t.supplier, {key: "s_suppkey"}, {"s_name": role})
    return fact.select("l_orderkey", "l_linenumber", "supplier", "by_part", "by_line")


@query(
    "composite_key_join", "D4",
    "SELECT p_brand, p_size, COUNT(*) AS n FROM lineitem JOIN (SELECT p_partkey, p_brand, p_size FROM part) ON l_partkey = p_partkey AND CAST(l_quantity AS INTEGER) = p_size GROUP BY 1, 2",
)
def composite_key_join(t):
    lines = t.lineitem.select("l_partkey", F.col("l_quantity").cast("int").alias("q"))
    joined = lookup(lines, t.part, {"l_partkey": "p_partkey", "q": "p_size"}, {"p_brand": "p_brand"})
    return joined.groupBy("p_brand", F.col("q").alias("p_size")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "left_join_stats", "D5 E1 E3",
    f"SELECT c_custkey, COUNT(o_orderkey) AS n_orders, {rounded('coalesce(SUM(o_totalprice), 0)')} AS total, {rounded('MIN(o_totalprice)')} AS smallest, {rounded('MAX(o_totalprice)')} AS largest FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1",
)
def left_join_stats(t):
    """Orders are added up per customer before the join, so a customer with very many orders is no hot join key."""
    stats = t.orders.groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.sum("o_totalprice").alias("total"), F.min("o_totalprice").alias("smallest"), F.max("o_totalprice").alias("largest")
    )
    return t.customer.join(stats, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", F.coalesce("n_orders", F.lit(0)).alias("n_orders"),
        F.round(F.coalesce("total", F.lit(0.0)), 2).alias("total"), F.round("smallest", 2).alias("smallest"), F.round("largest", 2).alias("largest"),
    )


@query(
    "full_outer_series", "D6",
    """
    WITH c AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS clicks FROM events WHERE event_type = 'click' AND CAST(ts AS DATE) < DATE '2024-01-20' GROUP BY 1),
    e AS (SELECT CAST(ts AS DATE) AS day, COUNT(*) AS errors FROM events WHERE event_type = 'error' AND CAST(ts AS DATE) >= DATE '2024-01-10' GROUP BY 1)
    SELECT coalesce(c.day, e.day) AS day, clicks, errors FROM c FULL JOIN e ON c.day = e.day
    """,
)
def full_outer_series(t):
    def per_day(kind, name, keep):
        rows = t.events.filter(F.col("event_type") == kind).withColumn("day", F.col("ts").cast("date")).filter(keep)
        return rows.groupBy("day").agg(F.count(F.lit(1)).alias(name))

    clicks = per_day("click", "clicks", F.col("day") < F.lit("2024-01-20").cast("date"))
    errors = per_day("error", "errors", F.col("day") >= F.lit("2024-01-10").cast("date"))
    return align_outer(clicks, errors, "day")


@query(
    "year_over_year_orders", "D7 N5",
    f"""
    WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, COUNT(*) AS n FROM orders GROUP BY 1)
    SELECT a.month, {rounded('(a.n * 1.0 / b.n - 1) * 100')} AS yoy_pct FROM m a JOIN m b ON b.month = a.month - INTERVAL 1 YEAR
    """,
)
def year_over_year_orders(t):
    monthly = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).cast("double").alias("n"))
    return year_over_year(monthly, "month", "n", "yoy_pct")


@query("anti_join_new_rows", "D8", "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def anti_join_new_rows(t):
    return t.customer.join(t.orders.filter("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


_BEST_SQL = """
    WITH s AS (SELECT l_partkey, l_suppkey, SUM(l_quantity) AS q, COUNT(*) AS n FROM lineitem GROUP BY 1, 2),
    r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY q DESC, l_suppkey) AS rq, row_number() OVER (PARTITION BY l_partkey ORDER BY n DESC, l_suppkey) AS rn FROM s)
    SELECT l_partkey, MAX(CASE WHEN rq = 1 THEN l_suppkey END) AS top_quantity_supplier, MAX(CASE WHEN rq = 1 THEN q END) AS top_quantity,
      MAX(CASE WHEN rn = 1 THEN l_suppkey END) AS top_lines_supplier, MAX(CASE WHEN rn = 1 THEN n END) AS top_lines
    FROM r GROUP BY 1
    """


@query("best_of_two_rankings", "D10 E5 F2", _BEST_SQL)
def best_of_two_rankings(t):
    """Both rankings in one pass of partial aggregates instead of two ranked copies joined back."""
    sums = t.lineitem.groupBy("l_partkey", "l_suppkey").agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    best = sums.groupBy("l_partkey").agg(best_by("l_suppkey", "q").alias("a"), best_by("l_suppkey", "n").alias("b"))
    return best.select(
        "l_partkey", F.col("a.l_suppkey").alias("top_quantity_supplier"), F.col("a.q").alias("top_quantity"),
        F.col("b.l_suppkey").alias("top_lines_supplier"), F.col("b.n").alias("top_lines"),
    )


@query(
    "single_row_aggregates_joined", "D11 D12",
    "SELECT (SELECT MAX(o_orderdate) FROM orders) AS last_order, (SELECT MAX(l_shipdate) FROM lineitem) AS last_shipment, (SELECT COUNT(*) FROM customer) AS customers",
)
def single_row_aggregates_joined(t):
    return t.spark.range(1).select(
        t.orders.agg(F.max("o_orderdate")).scalar().alias("last_order"),
        t.lineitem.agg(F.max("l_shipdate")).scalar().alias("last_shipment"),
        t.customer.agg(F.count(F.lit(1))).scalar().alias("customers"),
    )


@query(
    "declared_relationships", "D13",
    "SELECT o_orderkey AS order_key, c_mktsegment AS segment, n_name AS nation, r_name AS region FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey",
)
def declared_relationships(t):
    links = [
        Relationship("orders", "o_custkey", "customer", "c_custkey"),
        Relationship("customer", "c_nationkey", "nation", "n_nationkey"),
        Relationship("nation", "n_regionkey", "region", "r_regionkey"),
    ]
    tables = {n: getattr(t, n) for n in ("orders", "customer", "nation", "region")}
    joined = follow(tables, "orders", "customer", "nation", "region", relationships=links)
    return joined.select(
        F.col("orders__o_orderkey").alias("order_key"), F.col("customer__c_mktsegment").alias("segment"),
        F.col("nation__n_name").alias("nation"), F.col("region__r_name").alias("region"),
    )


# --- E: aggregates ----------------------------------------------------------------------------


@query(
    "aggregate_functions", "E1 E2 E3 E6 E7 E9",
    f"""
    SELECT CAST(year(l_shipdate) AS INTEGER) AS ship_year, l_returnflag, COUNT(*) AS n, COUNT(DISTINCT l_suppkey) AS suppliers, SUM(l_quantity) AS quantity, {rounded('AVG(l_quantity)', 4)} AS avg_quantity,
      MIN(l_quantity) AS min_quantity, MAX(l_quantity) AS max_quantity, {rounded('SUM(l_quantity) / nullif(COUNT(*), 0)', 2)} AS quantity_per_line, {rounded('stddev_samp(l_quantity)', 4)} AS deviation
    FROM lineitem GROUP BY 1, 2
    """,
)
def aggregate_functions(t):
    return t.lineitem.groupBy(F.year("l_shipdate").alias("ship_year"), "l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("l_suppkey").alias("suppliers"), F.sum("l_quantity").alias("quantity"), F.round(F.avg("l_quantity"), 4).alias("avg_quantity"),
        F.min("l_quantity").alias("min_quantity"), F.max("l_quantity").alias("max_quantity"),
        F.round(ratio(F.sum("l_quantity"), F.count(F.lit(1))), 2).alias("quantity_per_line"), F.round(F.stddev_samp("l_quantity"), 4).alias("deviation"),
    )


@query(
    "conditional_aggregates", "E4",
    "SELECT o_custkey, CAST(SUM(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS finished, CAST(SUM(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open, MAX(CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END) AS largest_urgent FROM orders GROUP BY 1",
)
def conditional_aggregates(t):
    status = lambda s: F.sum(F.when(F.col("o_orderstatus") == s, 1).otherwise(0))
    return t.orders.groupBy("o_custkey").agg(
        status("F").alias("finished"), status("O").alias("open"),
        F.max(F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice"))).alias("largest_urgent"),
    )


@query("correlation", "E8", f"SELECT event_type, {rounded('corr(value, user_id)', 6)} AS r FROM events GROUP BY 1")
def correlation(t):
    return t.events.groupBy("event_type").agg(F.round(F.corr("value", F.col("user_id").cast("double")), 6).alias("r"))


@query("having_filter", "E10", "SELECT l_suppkey, l_partkey, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) >= 2")
def having_filter(t):
    return t.lineitem.groupBy("l_suppkey", "l_partkey").agg(F.count(F.lit(1)).alias("n")).filter("n >= 2")


@query("distinct_rows", "E11 M14", "SELECT DISTINCT p_brand, p_type FROM part")
def distinct_rows(t):
    return reports.distinct_values(t.part, "p_brand", "p_type")


@query("percent_of_total", "E12 D12", f"SELECT o_orderstatus, COUNT(*) AS n, {rounded('COUNT(*) * 100.0 / (SELECT COUNT(*) FROM orders)')} AS pct FROM orders GROUP BY 1")
def percent_of_total(t):
    whole = t.orders.agg(F.count(F.lit(1))).scalar()
    return t.orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n")).withColumn("pct", percent(F.col("n"), whole))


@query(
    "percent_of_partition", "E13 F9",
    f"SELECT o_orderstatus, o_orderpriority, COUNT(*) AS n, {rounded('COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY o_orderstatus)', 1)} AS pct FROM orders GROUP BY 1, 2",
)
def percent_of_partition(t):
    counts = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", percent(F.col("n"), F.sum("n").over(Window.partitionBy("o_orderstatus")), 1))


@query("sum_of_distinct_counts", "E14", "SELECT l_returnflag, COUNT(DISTINCT l_partkey) + COUNT(DISTINCT l_suppkey) AS involved FROM lineitem GROUP BY 1")
def sum_of_distinct_counts(t):
    return t.lineitem.groupBy("l_returnflag").agg((F.count_distinct("l_partkey") + F.count_distinct("l_suppkey")).alias("involved"))


@query(
    "default_summaries", "E15 E16",
    "SELECT l_returnflag, SUM(l_quantity) AS sum_l_quantity, COUNT(l_partkey) AS count_l_partkey, COUNT(DISTINCT l_suppkey) AS distinct_l_suppkey, MIN(l_linestatus) AS first_l_linestatus FROM lineitem GROUP BY 1",
)
def default_summaries(t):
    registry = {"l_quantity": "sum", "l_partkey": "count", "l_suppkey": "distinct", "l_linestatus": "first"}
    from scorelake.plans.visuals import summarise

    return summarise(t.lineitem, "lineitem", ["l_returnflag"], registry={"lineitem": registry})


@query(
    "date_rollup", "E17",
    f"""
    WITH d AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'Qtr ' || quarter(o_orderdate) AS quarter, CAST(month(o_orderdate) AS INTEGER) AS month_no, CAST(day(o_orderdate) AS INTEGER) AS day, o_totalprice FROM orders)
    SELECT year, quarter, month_no, day, CAST(GROUPING_ID(year, quarter, month_no, day) AS INTEGER) AS level, COUNT(*) AS n_orders, {rounded('SUM(o_totalprice)')} AS total FROM d GROUP BY ROLLUP (year, quarter, month_no, day)
    """,
)
def date_rollup(t):
    return reports.date_rollup(t.orders, "o_orderdate", {"n_orders": F.count(F.lit(1)), "total": F.round(F.sum("o_totalprice"), 2)})


# --- F: windows -------------------------------------------------------------------------------


@query(
    "rank_in_group", "F1",
    "SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rank_in_nation FROM customer",
)
def rank_in_group(t):
    """A nation's customers are numbered by many tasks: one per thousand keys."""
    rows = t.customer.select("c_custkey", "c_nationkey")
    return number_in_groups(rows, ["c_nationkey"], [F.col("c_custkey").asc()], F.floor(F.col("c_custkey") / 1000), "rank_in_nation")


@query("global_row_numbers", "F3 J7", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS order_id FROM orders")
def global_row_numbers(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    return number_rows(rows, [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], "order_id").select("o_orderkey", "order_id")


@query(
    "last_five_per_group", "F4",
    "SELECT user_id, event_id, CAST(rn AS INTEGER) AS recency FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 5",
)
def last_five_per_group(t):
    return top_rows(t.events.select("user_id", "event_id", "ts"), ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 5, "recency").drop("ts")


@query(
    "rolling_five", "F5",
    f"SELECT event_id, user_id, {rounded('AVG(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)', 2)} AS rolling_avg FROM events",
)
def rolling_five(t):
    rows = t.events.select("event_id", "user_id", "ts", F.col("value").cast("decimal(18,2)").alias("v"))
    order = [F.col("ts").asc(), F.col("event_id").asc()]
    placed = number_in_groups(rows, ["user_id"], order, F.date_trunc("day", F.col("ts").cast("timestamp")), "pos")
    rolled = rolling_in_groups(placed, ["user_id"], "pos", 5, {"s": F.sum("v"), "n": F.count("v")})
    return rolled.select("event_id", "user_id", F.round(F.col("s").cast("double") / F.col("n"), 2).alias("rolling_avg"))


@query("lag_value", "F6", "SELECT event_id, event_type, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous FROM events")
def lag_value(t):
    rows = t.events.select("event_id", "event_type", "ts", "value")
    lagged = lag_in_groups(rows, ["event_type"], ["ts", "event_id"], "value", F.date_trunc("hour", F.col("ts").cast("timestamp")), "previous")
    return lagged.select("event_id", "event_type", "previous")


@query(
    "correlation_on_every_row", "F8",
    f"""
    WITH d AS (SELECT CAST(ts AS DATE) AS day, CAST(COUNT(*) AS DOUBLE) AS n, CAST(COUNT(DISTINCT user_id) AS DOUBLE) AS users FROM events GROUP BY 1)
    SELECT day, n, users, {rounded('corr(n, users) OVER ()', 6)} AS r FROM d
    """,
)
def correlation_on_every_row(t):
    daily = t.events.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.count_distinct("user_id").cast("double").alias("users")
    )
    return attach_correlation(daily, "n", "users", "r").withColumn("r", F.round("r", 6))


# --- G: order, limit, sets --------------------------------------------------------------------


@query("order_and_limit", "G1 G2", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 50")
def order_and_limit(t):
    return t.orders.select("o_orderkey", "o_orderpriority", "o_totalprice").orderBy(
        F.col("o_orderpriority").asc_nulls_last(), F.col("o_totalprice").desc_nulls_first(), "o_orderkey"
    ).limit(50)


@query(
    "labelled_stack", "G3",
    "SELECT 'orders' AS name, COUNT(*) AS n FROM orders UNION ALL SELECT 'lineitem', COUNT(*) FROM lineitem UNION ALL SELECT 'part', COUNT(*) FROM part",
)
def labelled_stack(t):
    from scorelake.plans.monitor import row_counts

    counts = row_counts({n: getattr(t, n) for n in ("orders", "lineitem", "part")})
    return counts.select(F.col("table_name").alias("name"), F.col("row_count").alias("n"))


@query("set_difference", "G4", "SELECT l_partkey AS partkey FROM lineitem WHERE l_linenumber = 1 EXCEPT SELECT l_partkey FROM lineitem WHERE l_quantity = 50")
def set_difference(t):
    lines = t.lineitem
    first = lines.filter("l_linenumber = 1").select(F.col("l_partkey").alias("partkey"))
    return first.subtract(lines.filter("l_quantity = 50").select("l_partkey"))
