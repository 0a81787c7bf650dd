"""Counts that writes deliver, and null gates that look at changed storage buckets only."""

from pyspark.sql import functions as F

from scorelake.operators.quality import null_share
from scorelake.plans.refresh import PROFILE, gate_nulls
from scorelake.sources.tables import Lake

ROWS = "id int, name string, data_quality_status string, data_quality_score double, bucket int"


def _rows(spark, ids, nulls=()):
    return spark.createDataFrame([(i, None if i in nulls else "x", "VALID", 1.0, i % 4) for i in ids], ROWS)


def test_writes_count_their_rows(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.append("a", spark.range(5).withColumn("_action", F.when(F.col("id") < 2, "INSERT").otherwise("UPDATE")))
    lake.append("a", spark.range(3).withColumn("_action", F.lit("INSERT")))
    lake.replace("b", spark.range(0))
    lake.rewrite_partitions("c", _rows(spark, range(6)).withColumn("query_refresh_lag_minutes", F.col("id")), "bucket")
    assert (lake.counts.total(["a"]), lake.counts.total(["a"], "insert"), lake.counts.total(["a"], "update")) == (8, 5, 3)
    assert lake.counts.total(["b", "unwritten"]) == 0 and lake.counts.total(["c"], "valid") == 6 and lake.counts.largest(["a", "c"], "lag_minutes") == 5
    lake.counts.reset()
    assert lake.counts.total(["a"]) == 0


def test_a_gate_profiles_and_writes_changed_buckets_only(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    gate = lambda limit: gate_nulls(lake, "t", ["name"], limit, 0.3)
    files = lambda: set((tmp_path / "t").rglob("*.parquet"))
    marked = lambda: sorted(r.id for r in lake.read("t").filter("data_quality_status = 'INVALID' AND data_quality_score = 0.3").collect())
    lake.rewrite_partitions("t", _rows(spark, range(40), {1}), "bucket")
    assert gate(0.05) == (40, 0, 40, 40) and marked() == []
    assert gate(0.05) == (0, 0, 40, 40)  # nothing changed, nothing is read
    before = files()
    lake.rewrite_partitions("t", _rows(spark, range(2, 40, 4), {2, 6}), "bucket")
    assert gate(0.05) == (10, 3, 40, 37)  # one bucket is profiled, and the share of the whole table trips the gate
    assert marked() == [1, 2, 6]
    assert {p.parent.name for p in before & files()} == {"bucket=0", "bucket=3"}
    profile = lake.read("t__profile", PROFILE).agg(F.sum("null_rows") / F.sum("rows"), F.sum("unmarked")).first()
    assert tuple(profile) == (null_share(lake.read("t"), ["name"]).first().null_share, 0)
    assert gate(0.05) == (0, 0, 40, 37)
