import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorelake.operators.positions import best_by, lag_in_groups, number_in_groups, number_rows, rolling_in_groups, top_rows
from scorelake.operators.quality import Rule, apply_null_gate, duplicate_keys, graded_score, not_null_violations, orphan_rows, rule_violations
from scorelake.operators.upsert import append_versions, apply_upsert, changed_rows, insert_missing, upsert_newer
from scorelake.plans import monitor
from scorelake.sources.tables import Lake, split_archive
from scorelake.streaming.changes import upsert_into


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows share one key, some keys are NULL, many order values repeat."""
    return spark.range(3000).select(
        F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"),
        ((F.col("id") * 7919) % 1009).alias("o"), "id", F.when(F.col("id") % 13 != 0, F.col("id") % 31).alias("v"),
    ).repartition(5).cache()


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_numbers_in_groups_match_a_plain_window(skewed):
    skewed = skewed.withColumn("o", F.when(F.col("id") % 17 != 0, F.col("o")))  # NULL order values as well
    o, small = F.col("o"), F.floor(F.col("o") / 50)
    cases = [
        (o.asc(), {}), (o.desc(), {"descending": True}), (o.asc_nulls_last(), {"nulls_first": False}),
        (o.desc_nulls_first(), {"descending": True, "nulls_first": True}),
    ]
    for first, how in cases:
        order = [first, F.col("id").asc()]
        got = number_in_groups(skewed, ["k"], order, small, "n", **how)
        want = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(*order)).cast("long"))
        same(got.select("id", "n"), want.select("id", "n"))


def test_global_numbers_are_dense_and_ordered(skewed):
    order = [F.col("o").desc(), F.col("id").asc()]
    got = number_rows(skewed, order, "n", start=10)
    want = skewed.withColumn("n", (F.row_number().over(Window.orderBy(*order)) + 9).cast("long"))
    same(got.select("id", "n"), want.select("id", "n"))


def test_lag_crosses_bucket_borders(skewed):
    rows = skewed.withColumn("t", F.col("o") * 10000 + F.col("id"))
    got = lag_in_groups(rows, ["k"], ["t", "id"], "v", F.floor(F.col("t") / 300000), "prev")
    want = rows.withColumn("prev", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    same(got.select("id", "prev"), want.select("id", "prev"))


def test_rolling_frames_cross_chunk_borders(skewed):
    order = [F.col("o").asc(), F.col("id").asc()]
    placed = number_in_groups(skewed, ["k"], order, F.floor(F.col("o") / 100), "n")
    got = rolling_in_groups(placed, ["k"], "n", 5, {"s": F.sum("v")}, chunk=7)
    want = skewed.withColumn("s", F.sum("v").over(Window.partitionBy("k").orderBy(*order).rowsBetween(-4, 0)))
    same(got.select("id", "s"), want.select("id", "s"))


def test_top_rows_and_best(skewed):
    got = top_rows(skewed, ["k"], [F.col("o").desc(), F.col("id")], 2)
    assert got.groupBy("k").count().filter("count > 2").count() == 0
    best = skewed.groupBy("k").agg(best_by("id", "o").alias("b")).filter("k = 'hot'").first().b
    top = skewed.filter("k = 'hot'").orderBy(F.col("o").desc(), "id").first()
    assert (best.o, best.id) == (top.o, top.id)


ROWS = "key string, part int, version int, value string"


def test_insert_only_keeps_null_keys_and_batch_duplicates(spark):
    target = spark.createDataFrame([("a", 1, 1, "old")], ROWS)
    source = spark.createDataFrame([("a", 1, 2, "x"), ("b", 1, 1, "y"), ("b", 1, 2, "z"), (None, 1, 1, "n")], ROWS)
    assert sorted(r.value for r in insert_missing(target, source, ["key", "part"]).collect()) == ["n", "y", "z"]
    assert sorted(r.value for r in insert_missing(target, source, ["key", "part"], dedupe_by="version").collect()) == ["n", "z"]


def test_newer_rows_win(spark):
    target = spark.createDataFrame([("a", 1, 5, "keep"), ("b", 1, 1, "old"), ("b", 1, 1, "twin"), (None, 1, 1, "null")], ROWS)
    source = spark.createDataFrame([("a", 1, 4, "stale"), ("b", 1, 2, "mid"), ("b", 1, 3, "new"), ("c", 1, 1, "add"), (None, 1, 9, "null2")], ROWS)
    got = upsert_newer(target, source, ["key", "part"], "version")
    assert sorted(r.value for r in got.collect()) == ["add", "keep", "new", "new", "null", "null2"]
    some = upsert_newer(target, source, ["key", "part"], "version", update=["version"])
    assert sorted(r.value for r in some.collect()) == ["add", "keep", "null", "null2", "old", "twin"]
    actions = {(r.key, r._action) for r in changed_rows(target, source, ["key", "part"], "version").collect()}
    assert actions == {("b", "UPDATE"), ("c", "INSERT"), (None, "INSERT")}


def test_versions_are_kept(spark):
    target = spark.createDataFrame([("a", 1, 1, "v1")], ROWS)
    source = spark.createDataFrame([("a", 1, 1, "again"), ("a", 1, 2, "v2")], ROWS)
    assert [r.value for r in append_versions(target, source, ["key", "part"], "version").collect()] == ["v2"]


def test_stored_upsert_and_repeated_batch(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    first = spark.createDataFrame([("a", 1, 1, "a1"), ("b", 1, 1, "b1")], ROWS)
    second = spark.createDataFrame([("a", 1, 2, "a2"), ("c", 1, 1, "c1")], ROWS)
    apply_upsert(lake, "t", first, ["key", "part"], "version")
    apply_upsert(lake, "t", second, ["key", "part"], "version")
    assert sorted(r.value for r in lake.read("t").collect()) == ["a2", "b1", "c1"]
    handle = upsert_into(lake, "s", ["key", "part"], "version")
    handle(first, 0)
    handle(second, 1)
    handle(second, 1)
    assert sorted(r.value for r in lake.read("s").collect()) == ["a2", "b1", "c1"]
    assert lake.read("s__changes").groupBy("batch_id").count().count() == 2
    assert lake.read("s__changes").count() == 4


def test_null_gate_trips_above_threshold_only(spark):
    rows = spark.range(100).select("id", F.when(F.col("id") >= 2, "x").alias("name"), F.lit("VALID").alias("data_quality_status"), F.lit(1.0).alias("data_quality_score"))
    marked = lambda limit: apply_null_gate(rows, ["name"], limit).filter("data_quality_status = 'INVALID' AND data_quality_score = 0.3").count()
    assert (marked(0.01), marked(0.02), marked(0.05)) == (2, 0, 0)


def test_checks(spark):
    rows = spark.createDataFrame([(1, "a", 5), (1, "b", None), (2, None, -1)], "id int, s string, n int")
    assert [(r.id, r.n) for r in duplicate_keys(rows, ["id"]).collect()] == [(1, 2)]
    assert {r.column_name: r.null_rows for r in not_null_violations(rows, ["s", "n"]).collect()} == {"s": 1, "n": 1}
    assert {r.rule: r.violations for r in rule_violations(rows, [Rule("n", F.col("n") >= 0)]).collect()} == {"n": 2}
    assert orphan_rows(rows, rows.filter("id = 1"), "id", "id").count() == 1
    scores = rows.select(graded_score([Rule("n", F.col("n") >= 0)], [Rule("s", F.col("s") == "z")]).alias("x")).collect()
    assert [r.x for r in scores] == [0.5, 0.0, 0.0]


def test_failed_stage_is_logged_and_raised(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    monitor.logged(lake, "good", lambda: 3)
    with pytest.raises(ValueError):
        monitor.logged(lake, "bad", lambda: (_ for _ in ()).throw(ValueError("no")))
    log = {r.task_name: (r.status, r.rows_processed, r.error_message) for r in lake.read("run_log").collect()}
    assert log == {"good": ("SUCCESS", 3, None), "bad": ("FAILED", None, "no")}


def test_archive_split_keeps_null_dates(spark):
    rows = spark.createDataFrame([(1, "2024-01-05"), (2, None), (3, "2024-02-01")], "id int, d string").withColumn("d", F.to_date("d"))
    archived, kept = split_archive(rows, F.col("d") < F.lit("2024-02-01").cast("date"))
    assert ([r.id for r in archived.collect()], sorted(r.id for r in kept.collect())) == ([1], [2, 3])


def test_logged_actions_and_reused_labels(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = lambda ids, version: spark.createDataFrame([(str(i) if i is not None else None, 1, version, "v") for i in ids], ROWS)
    handle = upsert_into(lake, "t", ["key", "part"], "version", buckets=8)
    handle(rows(range(200), 5), 0)
    handle(rows(range(50), 6).unionByName(rows(range(50, 200), 4)), 1)
    log = lake.read("t__changes")
    assert sorted((r._action, r["count"]) for r in log.groupBy("_action").count().collect()) == [("INSERT", 200), ("UPDATE", 50)]
    handle(rows(range(1000, 1200), 1), 1)  # another batch under a label that is in the log
    assert lake.read("t").count() == 400
    for _ in range(2):
        handle(rows([None], 1), 2)
    assert lake.read("t").count() == 401 and lake.read("t__changes").count() == 451


def test_merge_of_a_large_batch_shuffles_each_side_once_and_gives_the_same(spark):
    stored = spark.range(400).select(
        F.when(F.col("id") % 9 != 0, F.col("id") % 150).alias("a"), F.when(F.col("id") % 7 != 0, F.col("id") % 3).alias("b"),
        (F.col("id") % 5).alias("v"), F.concat(F.lit("t"), "id").alias("x"), F.lit("kept").alias("y"),
    )
    source = spark.range(300).select(
        F.when(F.col("id") % 8 != 0, F.col("id") % 200).alias("a"), (F.col("id") % 3).alias("b"), (F.col("id") % 11).alias("v"),
        F.concat(F.lit("s"), "id").alias("x"), F.lit("new").alias("y"),
    )
    for how in ({}, {"match_nulls": True}, {"update": ["x"]}, {"update": ["x"], "stamp": {"y": F.lit("stamped")}}):
        got = upsert_newer(stored, source, ["a", "b"], "v", large_batch=True, **how)
        same(got, upsert_newer(stored, source, ["a", "b"], "v", **how))
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = upsert_newer(stored, source, ["a", "b"], "v", match_nulls=True, large_batch=True)
        assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_documents_are_stored_whole(spark, tmp_path):
    import pyarrow.parquet as pq

    key = "spark.sql.variant.writeShredding.enabled"
    before = spark.conf.get(key)
    lake = Lake(spark, str(tmp_path))
    rows = spark.range(50).select("id", F.parse_json(F.concat(F.lit('{"a": {"b": '), "id", F.lit("}}"))).alias("doc"))
    lake.replace("raw", rows)
    stored = pq.read_schema(next(tmp_path.glob("raw/*.parquet")))
    assert "typed_value" not in str(stored.field("doc").type) and spark.conf.get(key) == before
    assert lake.read("raw").select(F.variant_get("doc", "$.a.b", "int").alias("b")).agg(F.sum("b")).first()[0] == 1225


@pytest.mark.parametrize("match_nulls", [False, True])
def test_a_large_batch_inserts_what_is_missing(spark, match_nulls):
    target = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (None, "z")], "k int, v string")
    batch = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "b", 3), (2, None, 4), (None, "z", 5), (3, "c", 6)], "k int, v string, n int")
    got = insert_missing(target, batch, ["k", "v"], match_nulls=match_nulls, large_batch=True)
    assert sorted(r.n for r in got.collect()) == ([2, 3, 6] if match_nulls else [2, 3, 4, 5, 6])
    again = insert_missing(batch, batch, ["k", "v"], match_nulls=match_nulls, large_batch=True)
    assert again.count() == (0 if match_nulls else 2)
    assert str(again._jdf.queryExecution().executedPlan()).count("Join") == 1


def test_pinned_rows_take_less_room_than_a_checkpoint(spark, tmp_path):
    from pathlib import Path

    from scorelake.session import pinned, shared_dir

    size = lambda: sum(p.stat().st_size for p in Path(shared_dir(spark).removeprefix("file:")).rglob("*") if p.is_file())
    rows = spark.range(20_000).select("id", F.repeat(F.lit("some text "), 20).alias("text"), F.lit(None).cast("string").alias("none"))
    before = size()
    kept = pinned(rows)
    assert size() - before < 1_000_000 and kept.schema.fieldNames() == rows.schema.fieldNames()
    assert kept.count() == 20_000 and kept.exceptAll(rows).isEmpty()
    assert pinned(rows.limit(0)).count() == 0 and pinned(rows.select(F.lit(None).alias("void"))).count() == 20_000
