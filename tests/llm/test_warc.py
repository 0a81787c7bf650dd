import hashlib

from pyspark.sql import functions as F

from scorelake.llm import warc


def test_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 4)
    monkeypatch.setattr(warc, "RANGE_CAPTURES", 20)
    big, small = "<p>" + "ä" * 200 + "</p>", "tiny"
    rows = [(i, f"http://{'hot' if i % 3 else f'h{i}'}.example.com:80{80 if i == 4 else ''}/a b/{i}?q={i}", big if i % 4 == 0 else f"{small}{i}", "extra") for i in range(60)]
    rows += [(90, None, big, "x"), (91, "http://x\r\ninjected: y", None, "x"), (92, "not a url", "", "x"), (93, "http://[bad", small, "x"), (94, "http://same.org/", small, "x"), (95, "http://same.org/", small, "x"), (None, "http://n.org/", big, "x"), (96, "http://w.org", "w" * 400_000, "x")]
    rows += [rows[5], rows[5], rows[-1]]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, folder string").repartition(4)
    got = warc.round_trip(pages).collect()
    want = []
    for page, _, html, _ in rows:
        data = (html or "").encode()
        same = [p for p, _, h, _ in rows if h == html and p is not None]
        first = min(same, default=None)
        revisit = len(data) >= 100 and page is not None and page != first
        want.append(str((page, len(data), hashlib.sha256(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None)))
    assert sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in got) == sorted(want)


def test_keys_sort_by_host_from_the_right():
    assert warc.url_key("HTTPS://News.Example.com/A?b=C#d") == "com,example,news)/a?b=c"
    assert warc.url_key(None) == "-" and warc.url_key("plain") == "plain"


def test_unknown_keys_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "x")], "page_id bigint, url string, html string")
    from scorelake.llm.common import new_folder

    folder, index = new_folder(spark, "warc"), new_folder(spark, "index")
    ranges = warc.build_index(warc.write_archives(pages, folder), index)
    keys = spark.createDataFrame([("zz,z)/", "9"), ("a", "1"), ("org,a)/", "1")], "url_key string, page string")
    assert [r.page for r in warc.read_captures(spark, keys, folder, index, ranges).collect()] == ["1"]
    assert warc.round_trip(pages.where(F.lit(False))).count() == 0
