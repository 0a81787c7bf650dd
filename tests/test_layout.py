"""Layouts along a space-filling curve: which files a filter meets, hot values, NULLs, lookups."""

from pyspark.sql import functions as F

from scorelake.sources.layout import files_holding, with_curve_key
from scorelake.sources.tables import Lake


def _rows(spark, n=40_000, hot=3):
    """A third of all rows hold one pair of values; names and NULLs are spread over the rest."""
    usual = F.col("id") % hot != 0
    return spark.range(n).select(
        F.xxhash64("id").alias("key"),
        F.when(usual, F.date_add(F.lit("2020-01-01").cast("date"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(900))).cast("int"))).otherwise(F.lit("2021-05-05").cast("date")).alias("day"),
        F.when(usual, F.when(F.col("id") % 97 != 0, F.concat(F.lit("n"), F.pmod(F.xxhash64("id", F.lit(2)), F.lit(500))))).otherwise(F.lit("n77")).alias("name"),
    )


def test_a_filter_on_either_column_meets_few_files(spark, tmp_path):
    lake, rows = Lake(spark, str(tmp_path)), _rows(spark)
    lake.replace_curved("t", rows, ["day", "name"], 64)
    found = lake.read("t")
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))
    sizes = sorted(r.rows for r in files_holding(found).collect())
    assert len(sizes) == 64 and sizes[-1] <= 2 * sizes[32]  # the hot pair fills files of its own
    for column, value in (("day", "2020-03-04"), ("day", "2022-01-09"), ("name", "n13"), ("name", "n400")):
        hit = found.filter(F.col(column) == value)
        assert 0 < hit.count() == rows.filter(F.col(column) == value).count()
        assert files_holding(hit).count() < 16, column


def test_range_numbers_are_those_of_a_search(spark):
    rows = spark.createDataFrame([(i * 7 % 64, str(i % 5), None) for i in range(64)] + [(None, None, None)], "a int, b string, c double")
    keys = {r.a: r._curve for r in with_curve_key(rows, ["a"], 3).collect()}
    assert keys == {None: 0} | {a: a // 8 for a in range(64)}
    assert {r.c: r._curve for r in with_curve_key(rows, ["c"], 3).collect()} == {None: 0}  # a column without values has one range
    two = {(r.a, r.b): r._curve for r in with_curve_key(rows, ["a", "b"], 2).collect()}
    for (a, b), key in two.items():
        if a is not None:
            assert (key >> 3 & 1) << 1 | key >> 1 & 1 == a // 16, (a, b, key)


def test_a_lookup_skips_row_groups_and_empty_tables_are_written(spark, tmp_path):
    lake, rows = Lake(spark, str(tmp_path)), _rows(spark, 20_000)
    lake.replace_curved("t", rows, ["day", "name"], 16, ["key"])
    key = rows.filter("day = '2020-03-04'").first().key
    for value, n in ((key, 1), (12345, 0)):
        hit = lake.read("t").filter(F.col("key") == value)
        assert len(hit.collect()) == n
        scan = hit._jdf.queryExecution().executedPlan().collectLeaves().head()
        assert scan.metrics().apply("numOutputRows").value() < 5_000  # of 20,000 rows whose keys range over every file
    lake.replace_curved("none", rows.limit(0), ["day", "name"], 4, ["key"])
    assert lake.read("none").count() == 0
