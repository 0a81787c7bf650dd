from pyspark.sql import functions as F

from scorelake.plans import bronze, star
from scorelake.sources.documents import accepted_raw, document_from_text, preview_file, read_documents, rejected_documents
from scorelake.sources.tables import Lake
from scorelake.streaming.ingest import load_unseen, stream_files
from tests.docs import SAMPLE, document, write


def raw_of(spark, tmp_path, *docs):
    for i, doc in enumerate(docs):
        write(tmp_path / "in", f"{i}.json", doc)
    return read_documents(spark, str(tmp_path / "in"))


def test_sample_counts(spark, tmp_path):
    raw = raw_of(spark, tmp_path, SAMPLE)
    assert bronze.flat_players(raw).count() == 4
    assert bronze.one_row_per_ball(raw).count() == 4
    total = F.sum(F.col("total").cast("int"))
    assert bronze.flat_balls(raw).agg(total).first()[0] == 13
    flat = bronze.flat_deliveries(raw)
    assert (flat.count(), flat.agg(total).first()[0]) == (6, 16)
    nested = bronze.flat_deliveries(raw, nested_fielders=True, over_base=1)
    assert nested.count() == 5 and {r.over for r in nested.collect()} == {1}
    assert flat.select("part_no", "ball_no", "innings_no").distinct().count() == 6


def test_match_projection_and_detail(spark, tmp_path):
    raw = raw_of(spark, tmp_path, SAMPLE, document(9002, outcome={"result": "tie"}, event={"match_number": 7}), document(9003, outcome={"result": "no result"}, event=None, dates=["bad"]))
    rows = {r.match_type_number: r for r in star.clean_match_detail(raw).collect()}
    first = rows[9001]
    assert (first.match_stage, first.match_result, first.winner, first.city, first.match_referee, first.second_umpire, first.toss_decision) == ("Final", "Result Declared", "alpha", None, None, "u two", "Field")
    assert (rows[9002].match_stage, rows[9002].match_result, rows[9002].winner) == ("7", "Tie", "NA")
    assert (rows[9003].match_stage, rows[9003].match_result, rows[9003].event_date) == ("NA", "No Result", None)


def test_arrays_bad_files_and_missing_parts(spark, tmp_path):
    no_innings = {k: v for k, v in SAMPLE.items() if k != "innings"}
    raw = raw_of(spark, tmp_path, [document(1), document(2)], "{broken", no_innings)
    good = accepted_raw(raw)
    assert sorted(r.stg_file_row_number for r in good.collect()) == [1, 2]
    assert sorted(r.rejection_reason for r in rejected_documents(raw).collect()) == ["innings missing", "unreadable document"]


def test_null_literals_become_null(spark, tmp_path):
    raw = raw_of(spark, tmp_path, document(1, city="null", venue="", gender="\\n"))
    row = bronze.flat_matches(raw).first()
    assert (row.city, row.venue, row.gender) == (None, None, None)


def test_bad_numbers_are_marked(spark, tmp_path):
    raw = raw_of(spark, tmp_path, document("abc"), document(None))
    rows = bronze.bronze_matches(raw).collect()
    assert {(r.match_type_number, r.data_quality_status, r.data_quality_score) for r in rows} == {(-1, "INVALID", 0.0)}
    assert star.clean_match_detail(raw).count() == 0


def test_preview_and_inserted_text(spark, tmp_path):
    write(tmp_path / "one", "m.json", SAMPLE)
    assert preview_file(spark, str(tmp_path / "one" / "m.json")).count() == 1
    row = document_from_text(spark, '{"info": {"match_type_number": 1, "players": {"A": ["P1"], "B": ["P2"]}}, "innings": []}', "test.json")
    assert {(r.country, r.player_name) for r in bronze.flat_players(row).collect()} == {("A", "P1"), ("B", "P2")}


def test_stream_load_is_incremental(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "check")
    write(tmp_path / "in", "a.json", document(1))
    write(tmp_path / "in", "bad.json", "{oops")
    stream_files(lake, source, checkpoint)
    stream_files(lake, source, checkpoint)
    assert (lake.read("raw").count(), lake.read("rejects").count()) == (1, 1)
    write(tmp_path / "in", "b.json", document(2))
    stream_files(lake, source, checkpoint)
    assert lake.read("raw").count() == 2


def test_batch_load_goes_by_content(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    write(tmp_path / "in", "a.json", document(1))
    write(tmp_path / "in", "copy.json", document(1))
    load_unseen(lake, str(tmp_path / "in"))
    assert lake.read("raw").count() == 1
    load_unseen(lake, str(tmp_path / "in"))
    assert lake.read("raw").count() == 1
    write(tmp_path / "in", "a.json", document(2))
    load_unseen(lake, str(tmp_path / "in"))
    assert lake.read("raw").count() == 2


def test_periodic_batches(spark, tmp_path):
    import time

    from scorelake.streaming.changes import append_into, fan_out, run_every, stream_status, table_stream

    lake = Lake(spark, str(tmp_path / "lake"))
    lake.append("src", spark.range(10))
    query = run_every(table_stream(lake, "src"), fan_out(append_into(lake, "dst")), str(tmp_path / "check"), minutes=1 / 60)
    try:
        deadline = time.time() + 60
        while time.time() < deadline and not lake.exists("dst"):
            time.sleep(0.5)
        query.processAllAvailable()
        assert lake.read("dst").count() == 10
        assert stream_status(query)["active"]
    finally:
        query.stop()


def test_a_stream_of_files_is_cut_by_bytes_and_a_load_by_content_shuffles_no_text(spark, tmp_path, monkeypatch):
    from scorelake.session import pinned
    from scorelake.sources.tables import Lake
    from scorelake.streaming import ingest

    source = tmp_path / "in"
    source.mkdir()
    for i in range(6):
        (source / f"{i}.json").write_text('{"meta": {"a": %d}, "info": {"b": "%s"}, "innings": []}' % (i // 2, "x" * 500))
    (source / "bad.json").write_text("{")
    monkeypatch.setattr(ingest, "BATCH_BYTES", 1200)
    streamed = Lake(spark, str(tmp_path / "streamed"))
    ingest.stream_files(streamed, str(source), str(tmp_path / "checkpoint"))
    assert streamed.read("raw").count() == 6 and streamed.read("rejects").count() == 1
    assert streamed.read("raw").select("batch_id").distinct().count() > 1

    found = []
    monkeypatch.setattr(ingest, "pinned", lambda df: found.append(df) or pinned(df), raising=False)
    loaded = Lake(spark, str(tmp_path / "loaded"))
    for rows in (3, 3):  # copies under other names load once, a second load nothing
        ingest.load_unseen(loaded, str(source))
        assert loaded.read("raw").count() == rows and loaded.read("rejects").count() == 1
    assert sorted(r.stg_file_name[-6:] for r in loaded.read("raw").collect()) == ["0.json", "2.json", "4.json"]
    assert found and all("value" not in df.columns for df in found)


def test_pieces_of_array_files_are_not_shuffled_by_file(spark, tmp_path):
    from scorelake.sources import json_arrays

    (tmp_path / "a.json").write_text('[\n{"a": 1},\n{"a": 2}\n]')
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pieces = json_arrays._pieces(spark, str(tmp_path))
        assert "SortMergeJoin" not in str(pieces._jdf.queryExecution().executedPlan())
        assert [(r.text, r.starts, r.closes) for r in pieces.orderBy("block", "seq", "sub").collect() if "{" in r.text] == [('{"a": 1', True, True), ('{"a": 2', True, True)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
