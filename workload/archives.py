"""Archive files made from ``pages``, for the archive queries and tests."""

from __future__ import annotations

import zlib
from itertools import chain

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from pageloom.sources.warc import open_folder


def gzip_member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def record(rec_type: str, body: bytes, **headers: str) -> bytes:
    lines = ["WARC/1.0", f"WARC-Type: {rec_type}", "WARC-Date: 2026-01-01T00:00:00Z"]
    lines += [f"{name.replace('_', '-')}: {value}" for name, value in headers.items()]
    lines.append(f"Content-Length: {len(body)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def chunked(body: bytes, size: int = 1000) -> bytes:
    parts = [body[i : i + size] for i in range(0, len(body), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def page_records(number: int, url: str, html: str) -> bytes:
    """A request and its response; bodies are plain, chunked, compressed or both by turns."""
    body, lines = html.encode(), ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]
    if number % 4 in (1, 3):
        body = gzip_member(body)
        lines.append("Content-Encoding: gzip")
    if number % 4 in (2, 3):
        body = chunked(body)
        lines.append("Transfer-Encoding: chunked")
    if number % 2 == 0:
        lines.append("Server: test")
    response = "\r\n".join(lines).encode() + b"\r\n\r\n" + body
    name = {"WARC_Target_URI": url}
    request = record("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", WARC_Record_ID=f"<urn:q:{number}>", **name)
    answer = record("response", response, WARC_Record_ID=f"<urn:uuid:{number}>", **name)
    return gzip_member(request) + gzip_member(answer)


def write_archives(pages: DataFrame, folder: str) -> str:
    """One archive per partition, written by its task, whole or again under the same name."""

    def write(batches):
        rows = (row for batch in batches for row in batch.to_pylist())
        first = next(rows, None)
        if first is None:
            return
        files, local = open_folder(folder)
        files.create_dir(local, recursive=True)
        name = f"rec-one-20260101000000000-{TaskContext.get().partitionId()}.warc.gz"
        count = 0
        with files.open_output_stream(f"{local}/{name}", compression=None) as out:
            for row in chain([first], rows):
                out.write(page_records(row["page_id"], row["url"], row["html"]))
                count += 1
        yield pa.RecordBatch.from_pydict({"pages": [count]})

    written = pages.select("page_id", "url", "html").mapInArrow(write, "pages bigint")
    written.write.format("noop").mode("overwrite").save()
    return folder
