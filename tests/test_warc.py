import gzip
import io
import random
import zlib

import pytest
from pyspark.sql import functions as F

from pageloom.sources import warc
from pageloom.sources.warc_records import read_records
from workload.archives import chunked, gzip_member, record

HTML = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=latin-1"]


def http(lines, body):
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body


def response(uri, lines, body, **extra):
    return record("response", http(lines, body), WARC_Target_URI=uri, **extra)


RECORDS = [
    record("warcinfo", b"software: x\r\n"),
    record("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", WARC_Target_URI="http://a/1"),
    response("http://a/1", HTML + ["Server: s", "Date: d", "LAST-MODIFIED: m"], "é".encode() + b"\xff<p>", WARC_Record_ID="<urn:1>", WARC_IP_Address="1.2.3.4"),
    response("<http://a/2>", HTML + ["Transfer-Encoding: chunked"], chunked(b"<p>two", 3)),
    response("http://a/3", HTML + ["Content-Encoding: gzip"], gzip.compress(b"<p>three")),
    response("http://a/4", HTML + ["Content-Encoding: deflate"], zlib.compress(b"<p>four")),
    response("http://a/5", HTML + ["Transfer-Encoding: chunked"], b"not chunked"),
    response("http://a/6", HTML + ["Content-Encoding: gzip"], b"not gzip"),
    response("http://a/7", ["HTTP/1.1 404 No", "content-type: text/html"], b"error page"),
    response("http://a/8", ["HTTP/1.1 200 OK", "Content-Type: TEXT/HTML"], b"upper case"),
    response("http://a/9", ["HTTP/1.1 200 OK", "Content-Type: image/png"], b"\x89PNG"),
    response("http://a/10", ["HTTP/1.1 200 OK"], b"no type"),
    response("", HTML, b"no url"),
    response("dns:a", [], b"text"),
    record("revisit", http(HTML, b""), WARC_Target_URI="http://a/11"),
]
BODIES = {
    "http://a/1": "é<p>", "http://a/2": "<p>two", "http://a/3": "<p>three", "http://a/4": "<p>four",
    "http://a/5": "not chunked", "http://a/6": "not gzip", "http://a/7": "error page",
}


@pytest.fixture(params=["members", "plain", "one member"])
def folder(request, tmp_path):
    data = {
        "members": b"".join(map(gzip_member, RECORDS)),
        "plain": b"".join(RECORDS),
        "one member": gzip_member(b"".join(RECORDS)),
    }[request.param]
    name = "b-0.warc" if request.param == "plain" else "b-0.warc.gz"
    (tmp_path / name).write_bytes(data)
    (tmp_path / "a-1.warc.gz").write_bytes(gzip_member(response("http://z/", HTML, b"z")))
    (tmp_path / "notes.txt").write_text("no archive")
    return str(tmp_path)


def test_scan(spark, folder):
    records = warc.read_warc(spark, folder)
    got = warc.html_responses(records).orderBy("seq").collect()
    assert got[0].url == "http://z/" and got[0].warc.warc_filename == "a-1.warc.gz"
    assert {r.url: r.html for r in got[1:]} == BODIES
    first = got[1].warc
    assert (first.warc_record_id, first.warc_ip_address, first.http_server) == ("<urn:1>", "1.2.3.4", "s")
    assert (first.http_date, first.http_last_modified, first.warc_date) == ("d", "m", "2026-01-01T00:00:00Z")
    assert warc.archive_stats(records).first() == (16, 8)
    assert warc.html_urls(records).count() == 8
    counts = {r.rec_type: r.records for r in warc.record_counts(records).collect()}
    assert counts == {"warcinfo": 1, "request": 1, "response": 13, "revisit": 1}
    assert records.select("seq").distinct().count() == 16


def test_options(spark, folder):
    none = warc.read_warc(spark, folder, content="none")
    assert none.where("html is not null or payload is not null").count() == 0
    assert warc.archive_stats(none).first() == (16, 8)
    payload = warc.read_warc(spark, folder, content="payload", record_types=("response",))
    assert payload.count() == 13
    png = payload.where(F.col("rec_headers")["warc-target-uri"] == "http://a/9").first()
    assert bytes(png.payload) == b"\x89PNG"


def everything(data, step, is_wanted=lambda *_: True):
    found = []
    for start in range(0, len(data), step):
        end = min(start + step, len(data))
        found += [(r.offset, r.ordinal, r.body) for r in read_records(io.BytesIO(data), len(data), start, end, (), is_wanted)]
    return found


@pytest.mark.parametrize("form", ["members", "plain", "one member", "padded"])
def test_ranges_give_every_record_once(form):
    random.seed(2)
    records = [
        response(f"http://a/{i}", HTML, bytes(random.choices(b"ab \r\n\x1f\x8b\x08W", k=random.randint(0, 3000))))
        for i in range(80)
    ]
    data = b"".join(map(gzip_member, records))
    data = {"members": data, "plain": b"".join(records), "one member": gzip_member(b"".join(records)), "padded": data + bytes(50)}[form]
    whole = everything(data, len(data))
    assert len(whole) == 80
    for step in (211, 1000, 20_000):
        assert everything(data, step) == whole


def test_an_archive_inside_a_record_is_not_read_twice():
    inner = b"".join(response(f"http://i/{i}", HTML, b"x" * 500) for i in range(9))
    data = RECORDS[2] + record("resource", b"\r\n" + inner, WARC_Target_URI="urn:i") + RECORDS[3]
    assert len(everything(data, len(data))) == 3
    with pytest.raises(ValueError, match="splitBytes=0"):
        everything(data, 1500)


def test_split_files_in_spark(spark, tmp_path):
    records = [response(f"http://a/{i}", HTML, b"page %d" % i) for i in range(200)]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(map(gzip_member, records)))
    df = warc.read_warc(spark, str(tmp_path), split_bytes=4000)
    assert df.rdd.getNumPartitions() > 3
    assert [r.html for r in df.orderBy("seq").collect()] == [f"page {i}" for i in range(200)]


def test_broken_archives(spark, tmp_path):
    (tmp_path / "cut.warc.gz").write_bytes(b"".join(map(gzip_member, RECORDS[2:5]))[:-20])
    got = warc.html_responses(warc.read_warc(spark, str(tmp_path / "cut.warc.gz"))).collect()
    assert {r.url for r in got} == {"http://a/1", "http://a/2", "http://a/3"}
    errors = warc.read_warc(spark, str(tmp_path / "cut.warc.gz")).orderBy("seq").collect()
    assert [r.record_error is None for r in errors] == [True, True, False] and "missing" in errors[2].record_error
    (tmp_path / "bad.warc").write_bytes(b"this is no archive\r\n")
    with pytest.raises(Exception, match="no record starts"):
        warc.read_warc(spark, str(tmp_path / "bad.warc")).collect()
    (tmp_path / "empty.warc").write_bytes(b"")
    assert warc.read_warc(spark, str(tmp_path / "empty.warc")).count() == 0


def test_many_records_in_a_member_have_their_own_seq(spark, tmp_path):
    member = gzip_member(record("metadata", b"") * 3_000)
    (tmp_path / "a.warc.gz").write_bytes(member + gzip_member(RECORDS[2]) * 2)
    for split in (0, 1 << 30):
        rows = warc.read_warc(spark, str(tmp_path), split_bytes=split).orderBy("seq").collect()
        assert len({r.seq for r in rows}) == 3_002
        assert [r.rec_type for r in rows] == ["metadata"] * 3_000 + ["response"] * 2


def test_patterns_and_stores(spark, folder, monkeypatch):
    assert warc.read_warc(spark, f"{folder}/a-*.gz").count() == 1
    assert warc.read_warc(spark, f"{folder}/[ab]-?.warc*").count() == 16
    opened = {}
    monkeypatch.setattr(warc.pafs, "S3FileSystem", lambda **k: opened.update(k) or "s3")
    assert warc.open_folder("s3a://bucket/x", {"fs.s3a.access.key": "k", "fs.s3a.endpoint": ""}) == ("s3", "bucket/x")
    assert opened == {"access_key": "k"}
    seen = []
    monkeypatch.setattr(warc.pafs, "FileSystem", type("F", (), {"from_uri": staticmethod(seen.append)}))
    warc.open_folder("abfss://c@a.dfs.core.windows.net/x")
    warc.open_folder("hdfs://n:8020/x")
    assert seen == ["abfs://c@a.dfs.core.windows.net/x", "hdfs://n:8020/x"]
