"""Change images, tables kept up by them, digests, files parsed in pieces, range buckets and filter paths."""

import json
import random

import pytest
from pyspark.sql import functions as F

from scorelake.operators.digests import bucket_digests, differences, differing_buckets
from scorelake.operators.distinct import dense_ids, distinct_bitmaps, distinct_counts, rolled_up
from scorelake.operators.images import changes_between, merged_sums, net_changes, partial_sums, signed_rows
from scorelake.operators.joins import Relationship, cross_filtered, path_between
from scorelake.operators.positions import lag_in_groups, number_in_groups, range_buckets
from scorelake.plans import maintain, star
from scorelake.plans.gold import DOCUMENT
from scorelake.plans.refresh import run_star
from scorelake.sources.documents import file_texts, split_documents
from scorelake.sources.json_arrays import _lines, _pieces, array_documents
from scorelake.sources.tables import Lake
from tests.docs import document, write


def test_net_changes_follow_a_random_history(spark):
    r = random.Random(1)
    states = [{k: r.randrange(3) for k in range(12)} | {None: 1}]
    for _ in range(4):
        now = dict(states[-1])
        for k in [*range(20), None]:
            if r.random() < 0.4:
                now.pop(k, None)
                if r.random() < 0.6:
                    now[k] = r.randrange(3)
        states.append(now)
    frame = lambda s: spark.createDataFrame([(k, v, None) for k, v in s.items()], "k int, v int, other string")
    log = None
    for offset, (old, new) in enumerate(zip(states, states[1:]), 1):
        part = changes_between(frame(old), frame(new), ["k"]).withColumn("offset", F.lit(offset))
        log = part if log is None else log.unionByName(part)
    log = log.persist()
    for after, upto in ((0, 4), (1, 3), (2, None)):
        old, new = states[after], states[upto or 4]
        got = {r.k: (r._action, r._before and r._before.v, r._after and r._after.v) for r in net_changes(log, ["k"], "offset", after, upto).collect()}
        want = {k: ("INSERT" if k not in old else "DELETE" if k not in new else "UPDATE", old.get(k), new.get(k)) for k in {*old, *new} if old.get(k, "none") != new.get(k, "none")}
        assert got == want
    net = net_changes(log, ["k"], "offset")
    sums = lambda s, sign: frame(s).withColumn("_sign", F.lit(sign)).withColumn("odd", F.col("k") % 2)
    parts = partial_sums(sums(states[0], 1), ["odd"], ["v"]).unionByName(partial_sums(signed_rows(net, ["k"]).withColumn("odd", F.col("k") % 2), ["odd"], ["v"]))
    assert sorted(map(str, merged_sums(parts, ["odd"], ["v"]).collect())) == sorted(map(str, merged_sums(partial_sums(sums(states[4], 1), ["odd"], ["v"]), ["odd"], ["v"]).collect()))


def test_only_partitions_that_hold_touched_documents_are_written_again(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    rows = lambda names, v: spark.createDataFrame([(n, 1, f"{n}.json", v) for n in names], ", ".join(f"{c} {'int' if 'row' in c else 'string'}" for c in DOCUMENT) + ", v int")
    put = lambda names, v, label, new=None: maintain.replace_documents(lake, "gold", rows(names if new is None else new, v), rows(names, 0).select(*DOCUMENT), label)
    assert put(["a", "b"], 1, "refresh-1") == [] and put(["c"], 2, "refresh-2") == [] and put(["d"], 3, "refresh-3") == []
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "lake" / "gold").rglob("*.parquet")}
    assert put(["b", "c"], 4, "refresh-4") == ["refresh-1", "refresh-2"]
    state = lambda: sorted((r[0], r.v, r.refresh) for r in lake.read("gold").collect())
    want = [("a", 1, "refresh-1"), ("b", 4, "refresh-4"), ("c", 4, "refresh-4"), ("d", 3, "refresh-3")]
    assert state() == want
    untouched = [p for p in before if "refresh-3" in str(p)]
    assert untouched and all(p.stat().st_mtime_ns == before[p] for p in untouched)
    assert put(["b", "c"], 4, "refresh-4") == [] and state() == want  # the same refresh once more
    assert put(["a"], 0, "refresh-5", new=[]) == ["refresh-1"] and state() == want[1:]


def test_digests_find_lost_and_doubled_rows(spark):
    rows = [(i, f"v{i}", None) for i in range(200)] + [(None, "n", 1)]
    source = spark.createDataFrame(rows, "k int, v string, w int").repartition(3)
    other = [r for r in rows if r[0] != 7] + [(9, "v9", None), (500, "new", None)]
    target = spark.createDataFrame([(k, "changed" if k == 11 else v, w) for k, v, w in other], "k int, v string, w int")
    assert source.count() != 0 and differing_buckets(bucket_digests(source, ["k"]), bucket_digests(source.repartition(7), ["k"])).count() == 0
    got = {(r.k, r.kind, r.source_rows, r.target_rows) for r in differences(source, target, ["k"], buckets=16).collect()}
    assert got == {(7, "lost", 1, 0), (9, "repeated", 1, 2), (500, "added", 0, 1), (11, "changed", 1, 1)}
    swapped = spark.createDataFrame([(1, None, 2)], "k int, v string, w int"), spark.createDataFrame([(1, "2", None)], "k int, v string, w int")
    assert [r.kind for r in differences(*swapped, ["k"]).collect()] == ["changed"]


def test_distinct_counts_roll_up_beyond_one_page(spark):
    df = spark.range(80_000).selectExpr("id AS value", "id % 3 AS day", "id % 3 DIV 2 AS month")
    known = df.unionByName(df).join(dense_ids(df, "value"), "value")
    days = distinct_bitmaps(known, ["day", "month"], "id")
    assert days.count() <= 9
    assert {(r.month, r.n) for r in distinct_counts(rolled_up(days, ["month"]), ["month"], "n").collect()} == {(0, 53_334), (1, 26_666)}


@pytest.mark.parametrize("form", ["one line", "lines", "indented", "single"])
def test_array_files_in_pieces(spark, tmp_path, form):
    r = random.Random(2)
    texts = ["plain", 'quote " and { brace', "back\\slash \\\" }", "tail \\", "}{][", "ünï {"]
    docs = [{"id": i, "info": {"t": r.choice(texts), "l": [{"a": r.choice(texts)}, [], {}]}, "meta": r.choice(texts)} for i in range(30)]
    text = {"one line": json.dumps(docs), "lines": "[\n" + ",\n".join(map(json.dumps, docs)) + "\n]\n", "indented": json.dumps(docs, indent=2), "single": json.dumps(docs[0])}[form]
    write(tmp_path / "in", "a.json", text)
    write(tmp_path / "in", "b.json", json.dumps(docs[:3]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = array_documents(spark, str(tmp_path / "in"))
        rows = got.select("stg_file_name", "stg_file_row_number", F.col("doc").cast("string").alias("doc"), "stg_file_hashkey").collect()
        blocks = spark.read.option("lineSep", "}").text(str(tmp_path / "in")).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = split_documents(file_texts(spark.read, str(tmp_path / "in"))).select("stg_file_name", "stg_file_row_number", F.col("doc").cast("string").alias("doc")).collect()
    assert sorted((r.stg_file_name, r.stg_file_row_number, r.doc) for r in rows) == sorted(tuple(r) for r in whole)
    assert blocks > (1 if form == "single" else 5) and len({(r.stg_file_name, r.stg_file_hashkey) for r in rows}) == 2
    again = array_documents(spark, str(tmp_path / "in")).select("stg_file_name", "stg_file_hashkey").distinct().collect()
    assert {tuple(r) for r in again} == {(r.stg_file_name, r.stg_file_hashkey) for r in rows}  # whatever the blocks


def test_a_broken_document_costs_only_itself(spark, tmp_path):
    good = ['{"a": "x}{"}', '{"b": {"c": 1}}', '{"d": 2}']
    write(tmp_path / "in", "a.json", "[\n" + ",\n".join([good[0], '{"broken": "no end', good[1], '{"x": [{', good[2]]) + "\n]")
    write(tmp_path / "in", "cut.json", '[{"e": 1}, {"f": ')
    rows = array_documents(spark, str(tmp_path / "in")).select(F.element_at(F.split("stg_file_name", "/"), -1).alias("f"), "stg_file_row_number", F.col("doc").cast("string").alias("doc")).collect()
    assert sorted((r.f, r.stg_file_row_number, r.doc) for r in rows) == [
        ("a.json", 1, '{"a":"x}{"}'), ("a.json", 2, None), ("a.json", 3, '{"b":{"c":1}}'), ("a.json", 4, None), ("a.json", 5, '{"d":2}'), ("cut.json", 1, '{"e":1}'), ("cut.json", 2, None),
    ]


def test_whole_lines_are_not_scanned(spark, tmp_path):
    lines = [json.dumps({"id": i, "l": [{"a": "}{"}, {}]}) for i in range(40)]
    lines[7] += ", " + lines[8]  # two documents in a line
    lines[9] = lines[9][:12]  # a broken one
    write(tmp_path / "in", "a.json", "[\n" + ",\n".join(lines) + "\n]")
    left = _lines(_pieces(spark, str(tmp_path / "in"))).filter("NOT single").selectExpr("size(pieces) AS n").collect()
    assert len(left) <= 12 and sum(r.n for r in left) <= 20  # of 164 pieces: lines 7 and 9, the brackets and the last line
    rows = array_documents(spark, str(tmp_path / "in")).selectExpr("stg_file_row_number AS r", "try_variant_get(doc, '$.id', 'int') AS id").collect()
    assert sorted((r.r, r.id) for r in rows) == list(enumerate([*range(8), 8, 8, None, *range(10, 40)], 1))


def test_ranges_cut_a_hot_key_evenly(spark):
    rows = spark.range(20_000).selectExpr("id", "IF(id % 10 = 0, id % 7, 1) AS k", "DATE '2024-01-05' AS day")
    cut = range_buckets(rows, ["k"], ["day", "id"], parts=16)
    sizes = sorted(r["count"] for r in cut.groupBy("bucket").count().collect())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]
    placed = number_in_groups(cut, ["k"], [F.col("day"), F.col("id")], F.col("bucket"), "n")
    got = lag_in_groups(placed, ["k"], ["day", "id"], "id", F.col("bucket"), "before")
    groups = {}
    for r in sorted(got.collect(), key=lambda r: (r.k, r.id)):
        seen = groups.setdefault(r.k, [])
        assert r.n == len(seen) + 1 and r.before == (seen[-1] if seen else None)
        seen.append(r.id)


def test_filters_take_the_one_shortest_way(spark):
    links = [Relationship("sale", "day_id", "day", "id"), Relationship("sale", "shop_id", "shop", "id"), Relationship("shop", "city_id", "city", "id")]
    assert [(r.to_table, forward) for r, forward in path_between("day", "city", links)] == [("day", False), ("shop", True), ("city", True)]
    with pytest.raises(ValueError, match="not joined"):
        path_between("day", "moon", links)
    with pytest.raises(ValueError, match="several ways"):
        path_between("day", "city", [*links, Relationship("back", "day_id", "day", "id"), Relationship("back", "shop_id", "shop", "id")])
    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    tables = {
        "sale": frame([(1, 1), (1, 2), (2, 2), (2, 3)], "day_id int, shop_id int"), "day": frame([(1,), (2,)], "id int"),
        "shop": frame([(1, 1), (2, 1), (3, 2), (4, 2)], "id int, city_id int"), "city": frame([(1,), (2,)], "id int"),
    }
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(cross_filtered(tables, {"day": F.col("id") == 1}, "city", links)) == [1]
    assert ids(cross_filtered(tables, {"day": F.col("id") == 2}, "shop", links)) == [2, 3]
    assert ids(cross_filtered(tables, {"day": F.col("id") == 2, "city": F.col("id") == 1}, "shop", links)) == [2]
    assert ids(cross_filtered(tables, {"shop": F.col("id") > 3}, "shop", links)) == [4]


def test_two_documents_of_one_match_keep_their_own_totals(spark, tmp_path):
    source = tmp_path / "in"
    write(source, "a.json", document(7, city="x"))
    write(source, "b.json", document(7, city="x", dates=["2023-10-20"]))
    facts = run_star(spark, str(source), str(tmp_path / "star")).read("match_fact").collect()
    assert [(f.match_id, f.bowls_played_by_team_a, f.total_score_by_team_a) for f in facts] == [(7, 3, 7)] * 2
    assert star.match_fact  # the same rule in batch use
