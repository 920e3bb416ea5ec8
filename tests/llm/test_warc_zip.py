from __future__ import annotations

import glob
import hashlib
import io
import zipfile

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from remitspark.llm import warc_zip
from remitspark.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SF, with_clashes

BIG = "é\r\n\r\n" * 400
PAGES = [
    (1, "http://a/1", BIG), (2, None, BIG), (3, "http://a/ b\nc", BIG + "x"), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""),
    (9, "u", BIG), (9, "u", BIG), (None, "u", BIG), (None, "u", "PK\x05\x06 odd"), (11, "u", "\n" * 5000), (12, "u", "\n" * 5000),
]


def want(pages):
    largest = {}
    for page_id, _, html in pages:
        data = (html or "").encode()
        if page_id is not None and len(data) >= 1000:
            largest[data] = max(largest.get(data, page_id), page_id)
    out = []
    for page_id, _, html in pages:
        data = (html or "").encode()
        refers = largest.get(data) if largest.get(data) != page_id else None
        kind = "response" if refers is None else "revisit"
        out.append((page_id, len(data), hashlib.sha1(data).hexdigest(), kind, refers, None if refers is not None else data))
    return sorted(out, key=str)


@pytest.mark.parametrize("zip64, parts, range_bytes", [(False, 1, 4 << 20), (True, 3, 300), (False, 3, 1)])
def test_round_trip(spark, monkeypatch, tmp_path, zip64, parts, range_bytes):
    monkeypatch.setattr(warc_zip, "RANGE_BYTES", range_bytes)
    pages = with_clashes(spark.createDataFrame(PAGES, "page_id long, url string, html string")).repartition(parts)
    folder = str(tmp_path / "archives")
    warc_zip.write_archives(warc_zip.roles(pages, "page_id", "html", "url"), folder, zip64)
    got = []
    for r in warc_zip.read_archives(spark, folder).collect():
        ids = [None if x is None else int(x) for x in (r.page_id, r.refers_to)]
        got.append((ids[0], r.payload_bytes, r.payload_digest, r.record_type, ids[1], None if r.payload is None else bytes(r.payload)))
    assert sorted(got, key=str) == want(PAGES)
    for path in glob.glob(f"{folder}/part*"):  # another reader agrees
        with zipfile.ZipFile(path) as archive:
            assert archive.testzip() is None
            assert archive.namelist() == [warc_zip.DATA, warc_zip.INDEX]


@pytest.mark.parametrize("zip64", [False, True])
def test_lines_join_to_the_archive(monkeypatch, zip64):
    monkeypatch.setattr(warc_zip, "LINE_BYTES", 50)
    writer, data = warc_zip.ZipWriter(zip64), bytes(range(256)) * 3
    parts = [writer.begin("x"), *[writer.data(data[k : k + 10]) for k in range(0, len(data), 10)], writer.end(), writer.close(b"\n")]
    lines = list(warc_zip._lines(parts))
    assert b"".join(line + b"\n" for line in lines) == b"".join(parts)
    assert len(lines) > 2
    with zipfile.ZipFile(io.BytesIO(b"".join(parts))) as archive:
        assert archive.read("x") == data


def test_foreign_archives(tmp_path):
    """Archives of another writer: offsets of stored members; deflated ones are an error."""
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as archive:
        archive.writestr("one", b"1" * 50)
        with archive.open("two", "w", force_zip64=True) as member:
            member.write(b"22")
        archive.comment = b"PK\x05\x06 in a comment"
    with pa.OSFile(str(path)) as file:
        members = warc_zip.directory(file)
        assert {name: file.read_at(size, at) for name, (at, size) in members.items()} == {"one": b"1" * 50, "two": b"22"}
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("one", b"1" * 50)
    with pa.OSFile(str(path)) as file, pytest.raises(ValueError, match="not stored"):
        warc_zip.directory(file)
    path.write_bytes(b"no archive")
    with pa.OSFile(str(path)) as file, pytest.raises(ValueError, match="no end record"):
        warc_zip.directory(file)


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = str(tmp_path / "archives")
    warc_zip.write_archives(warc_zip.roles(pages, "page_id", "html", "url"), folder)
    assert warc_zip.read_archives(spark, folder).collect() == []


def test_query_equals_sql(spark):
    got = QUERIES["op5_warc_round_trip"](spark, SF)
    assert got.schema["refers_to"].dataType == got.schema["page_id"].dataType
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    want = con.sql(ORACLE_SQL["op5_warc_round_trip"]).fetchall()
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(map(tuple, got.select(*names).collect()), key=str) == sorted(want, key=str)
    assert got.filter(F.col("payload_bytes").isNull()).isEmpty()
