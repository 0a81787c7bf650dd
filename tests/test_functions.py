import datetime as dt

from pyspark.sql import functions as F

from scorelake.functions.casts import safe_date, safe_int
from scorelake.functions.dates import boundaries_between, date_parts, one_year_before
from scorelake.functions.text import clean_text, register_clean_text, title_case


def one(spark, value, type_, expr):
    return spark.createDataFrame([(value,)], f"x {type_}").select(expr.alias("y")).first()[0]


def test_title_case_breaks_on_punctuation(spark):
    for text, want in [("m.a. CHIDAMBARAM-stadium", "M.A. Chidambaram-Stadium"), ("o'brien run_out icc", "O'brien Run_Out Icc"), ("", ""), (None, None)]:
        assert one(spark, text, "string", title_case(F.col("x"))) == want
    assert one(spark, "m.a. x-y", "string", title_case(F.col("x"), punctuation=False)) == "M.a. X-y"


def test_ascii_text_is_cased_without_cutting_words(spark):
    plan = spark.range(1).select(title_case(F.concat(F.lit("o'NEIL x-RAY\tb.C "), F.col("id").cast("string"))).alias("y"))
    assert plan.first().y == "O'neil X-Ray\tB.C 0" and "initcap" in plan._jdf.queryExecution().optimizedPlan().toString()
    for text, want in [("a\x01 b.c", "A\x01 B.C"), ("éa.ß x", "Éa.SS X"), ("..a--1b(c", "..A--1b(C")]:
        assert one(spark, text, "string", title_case(F.col("x"))) == want


def test_cleaning_variants_differ_on_white_space(spark):
    x = F.col("x")
    assert one(spark, " a \t  b ", "string", clean_text(x, "Unknown")) == "A B"
    assert one(spark, "\t", "string", clean_text(x, "Unknown")) == "Unknown"
    assert one(spark, "\t", "string", clean_text(x, "Unknown", test_raw=True)) == ""
    assert one(spark, "a  b", "string", clean_text(x, "Unknown", collapse=False)) == "A  B"
    assert one(spark, None, "string", clean_text(x, "None")) == "None"


def test_sql_function_agrees_with_column_function(spark):
    register_clean_text(spark)
    rows = spark.createDataFrame([("  x.y  z/w",), ("\t",), (None,), ("o'neil (b)",)], "x string")
    got = rows.select(F.expr("clean_text(x, 'Unknown')").alias("a"), clean_text(F.col("x"), "Unknown").alias("b")).collect()
    assert all(r.a == r.b for r in got)


def test_safe_casts(spark):
    for text, want in [("4.6", 5), ("-4.5", -5), ("abc", None), (" 7 ", 7), ("99999999999", None)]:
        assert one(spark, text, "string", safe_int(F.col("x"))) == want
    for text, want in [("2023-10-14", dt.date(2023, 10, 14)), ("2023-10", None), ("2023-02-30", None), ("not-a-date", None)]:
        assert one(spark, text, "string", safe_date(F.col("x"))) == want


def test_minute_boundaries_are_counted(spark):
    row = spark.sql("SELECT timestamp_ntz'2024-01-01 00:59:59' AS a, timestamp_ntz'2024-01-01 01:01:00' AS b")
    got = row.select(boundaries_between("minute", F.col("a"), F.col("b")), boundaries_between("minute", F.col("b"), F.col("a")), boundaries_between("day", F.col("a"), F.col("b"))).first()
    assert tuple(got) == (2, -2, 0)


def test_date_parts(spark):
    got = spark.sql("SELECT date'2023-10-15' AS d").select(*(v.alias(k) for k, v in date_parts(F.col("d")).items()), one_year_before(F.col("d")).alias("before")).first()
    assert got.asDict() == {
        "day": 15, "month": 10, "year": 2023, "quarter": 4, "dayofweek": 7, "dayofmonth": 15, "dayofyear": 288,
        "dayofweekname": "Sun", "isweekend": True, "before": dt.date(2022, 10, 15),
    }
