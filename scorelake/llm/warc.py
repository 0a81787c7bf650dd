"""WARC archives with a two-level capture index.

``write_archives`` writes gzip-per-record archives; a payload seen before becomes a revisit
record. ``build_index`` sorts the captures by reversed-host URL key, cuts every range of keys
into compressed blocks and keeps a sparse directory (first key, offset, length of each block).
``read_captures`` finds the range of a key among the ranges' first keys, then the block by
binary search in that range's directory, decompresses only that block, and reads the record by
its byte range. Files are written by tasks into the shared folder under names of their own; a
task that runs again writes other files, and only the files of the attempt that succeeded are
listed in the stored capture table.
"""

from __future__ import annotations

import bisect
import datetime
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType

from scorelake.llm.common import new_folder, stored

REVISIT_FROM = 100  # bytes; smaller payloads are always stored
BLOCK_LINES = 1000
FILE_BYTES = 1 << 30
RANGE_CAPTURES = 50_000
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CAPTURES = "url_key string, page string, file string, offset long, length long"
RECORDS = "url_key string, page string, url string, record_type string, payload_bytes long, payload_digest string, refers string"


def url_key(url: str | None) -> str:
    """Host labels reversed, then the rest: ``http://a.example.com/x?q`` -> ``com,example,a)/x?q``; '-' for null."""
    if url is None:
        return "-"
    clean = quote(url.strip(), safe="%/:?&=#+,;@!$'()*~[]")
    try:
        parts = urlsplit(clean)
        host = (parts.hostname or "").lower()
        port = f":{parts.port}" if parts.port not in (None, 80, 443) else ""
    except ValueError:
        return clean.lower() or "-"
    if not host:
        return clean.lower() or "-"
    rest = parts.path.lower() or "/"
    return ",".join(reversed(host.split("."))) + port + ")" + rest + (f"?{parts.query.lower()}" if parts.query else "")


def _record(page: str, url: str | None, payload: bytes, digest: str, refers: str | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (b"" if refers is not None else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {date}",
        "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + quote(url, safe="%/:?&=#+,;@!$'()*~[]"))
    if refers is not None:
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers}>"]
    return ("\r\n".join(head) + "\r\n\r\n").encode() + block + b"\r\n\r\n"


def _zip(data: bytes) -> bytes:
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder)


def write_archives(pages: DataFrame, folder: str, date: str | None = None) -> DataFrame:
    """Write one record per row of page_id, url, html; returns the stored captures (where each record lies).

    A null html is an empty payload, a null url leaves the target out, a null page_id is
    written as ``null`` and never refers to another record. Rows that repeat a page_id and
    its payload are all responses where that id is the smallest of the payload. An empty
    table writes no archive. Other columns are ignored.
    """
    when = date or datetime.datetime.now(datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    big = F.octet_length("payload") >= REVISIT_FROM
    seen = (
        pages.select("page_id", payload.alias("payload")).where(big).select("page_id", F.sha2("payload", 256).alias("digest"))
        .groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    )
    refers = F.when(big & (F.col("first") != F.col("page_id")), F.col("first").cast("string"))
    ready = rows.join(seen, "digest", "left").select(F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page"), "url", "payload", "digest", refers.alias("refers"))

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        store.create_dir(base, recursive=True)
        out, name, at = None, "", 0
        for batch in batches:
            lines = []
            for row in batch.itertuples(index=False):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                packed = _zip(_record(row.page, row.url, bytes(row.payload), row.digest, row.refers, when))
                out.write(packed)
                lines.append((url_key(row.url), row.page, name, at, len(packed)))
                at += len(packed)
            yield pd.DataFrame(lines, columns=["url_key", "page", "file", "offset", "length"])
        if out is not None:
            out.close()

    return stored(ready.mapInPandas(write, CAPTURES), "warc-captures")


def build_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write the index of the captures; returns its ranges: first_key and the names of the range's block file and directory."""
    spark = captures.sparkSession

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        name, first, at, waiting, directory = uuid.uuid4().hex, None, 0, [], []
        out = None

        def flush() -> None:
            nonlocal at, out
            if out is None:
                store.create_dir(base, recursive=True)
                out = store.open_output_stream(f"{base}/{name}.cdx.gz", compression=None)
            packed = _zip("\n".join(waiting).encode())
            out.write(packed)
            directory.append(json.dumps([json.loads(waiting[0])[:2], at, len(packed)]))
            at += len(packed)
            waiting.clear()

        for batch in batches:
            for row in batch.itertuples(index=False):
                first = first or [row.url_key, row.page]
                waiting.append(json.dumps(list(row)))
                if len(waiting) == BLOCK_LINES:
                    flush()
        if first is None:
            return
        if waiting:
            flush()
        out.close()
        with store.open_output_stream(f"{base}/{name}.dir", compression=None) as sparse:
            sparse.write("\n".join(directory).encode())
        yield pd.DataFrame([(*first, name)], columns=["url_key", "page", "name"])

    parts = max(1, -(-captures.count() // RANGE_CAPTURES), min(spark.sparkContext.defaultParallelism, captures.rdd.getNumPartitions()))
    ordered = captures.repartitionByRange(parts, "url_key", "page").sortWithinPartitions("url_key", "page", "file", "offset")
    return stored(ordered.mapInPandas(write, "url_key string, page string, name string"), "warc-ranges")


def _parse(raw: bytes) -> tuple:
    data = zlib.decompress(raw, 31)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    refers = re.fullmatch(r"<urn:page:(.*)>", fields["WARC-Refers-To"])[1] if "WARC-Refers-To" in fields else None
    if refers is None:
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:  # a revisit keeps the headers of its capture, with the payload's length
        size = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    return fields.get("WARC-Target-URI"), fields["WARC-Type"], size, digest, refers


def read_captures(spark: SparkSession, keys: DataFrame, folder: str, index: str, ranges: DataFrame) -> DataFrame:
    """All captures of the wanted (url_key, page) pairs; a key without a capture gives no row.

    The ranges (one row per 50,000 captures) are the only part of the index at the driver;
    directories and blocks are read by the task that serves a range.
    """
    tops = sorted((r.url_key, r.page, r.name) for r in ranges.collect())
    starts, names = [(k, p) for k, p, _ in tops], [n for *_, n in tops]

    @F.pandas_udf(IntegerType())
    def range_of(key: pd.Series, page: pd.Series) -> pd.Series:
        return pd.Series([bisect.bisect_right(starts, pair) - 1 for pair in zip(key, page, strict=True)], dtype="int32")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, base = _open(folder)
        index_store, index_base = _open(index)
        at, directory, firsts = -1, [], []
        block_at, entries = None, {}
        name, archive = None, None
        for batch in batches:
            found = []
            for row in batch.itertuples(index=False):
                if row.part != at:
                    at, block_at = row.part, None
                    with index_store.open_input_stream(f"{index_base}/{names[at]}.dir", compression=None) as f:
                        directory = [json.loads(x) for x in f.read().decode().split("\n")]
                    firsts = [tuple(d[0]) for d in directory]
                wanted = (row.url_key, row.page)
                low = bisect.bisect_left(firsts, wanted) - 1
                for b in range(max(low, 0), len(firsts)):
                    if firsts[b] > wanted:
                        break
                    if b != block_at:
                        with index_store.open_input_file(f"{index_base}/{names[at]}.cdx.gz") as f:
                            f.seek(directory[b][1])
                            block = zlib.decompress(f.read(directory[b][2]), 31).decode()
                        block_at, entries = b, {}
                        for line in block.split("\n"):
                            k, p, *place = json.loads(line)
                            entries.setdefault((k, p), []).append(place)
                    for file, offset, length in entries.get(wanted, ()):
                        if file != name:
                            name, archive = file, store.open_input_file(f"{base}/{file}")
                        archive.seek(offset)
                        found.append((*wanted, *_parse(archive.read(length))))
            yield pd.DataFrame(found, columns=["url_key", "page", "url", "record_type", "payload_bytes", "payload_digest", "refers"])

    if not starts:
        return spark.createDataFrame([], RECORDS)
    pairs = keys.select("url_key", "page").distinct().withColumn("part", range_of("url_key", "page")).where("part >= 0")
    return pairs.repartition(len(starts), "part").sortWithinPartitions("part", "url_key", "page").mapInPandas(read, RECORDS)


@F.pandas_udf(StringType())
def url_keys(urls: pd.Series) -> pd.Series:
    return urls.map(lambda u: url_key(None if pd.isna(u) else u))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages, index them, look every page up again: page_id, url, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    folder, index = new_folder(spark, "warc"), new_folder(spark, "warc-index")
    ranges = build_index(write_archives(pages, folder), index)
    keys = pages.select(url_keys("url").alias("url_key"), F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page"))
    number = lambda c: F.expr(f"try_cast({c} AS bigint)")
    return read_captures(spark, keys, folder, index, ranges).select(
        number("page").alias("page_id"), "url", "payload_bytes", "payload_digest", "record_type", number("refers").alias("refers_to")
    )
