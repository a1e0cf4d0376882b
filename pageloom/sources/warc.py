"""The ``warc`` data source and the scans over it."""

from __future__ import annotations

import fnmatch
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from pageloom.session import qualified
from pageloom.sources.warc_records import is_html, read_records

SUFFIXES = (".warc.gz", ".warc")
SCHEMA = """
    seq bigint, warc_filename string, record_offset bigint, rec_type string,
    rec_headers map<string,string>, http_headers map<string,string>,
    html string, payload binary, record_error string
"""
# Larger files are read by several tasks.
SPLIT_BYTES = 1 << 30
BATCH_BYTES = 16 << 20
BATCH_ROWS = 1000


# Hadoop's names of stores, by pyarrow's, and Hadoop's settings of S3 by the names of its arguments.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfss": "abfs", "hdfs": "hdfs", "viewfs": "viewfs"}
S3_SETTINGS = {
    "fs.s3a.access.key": "access_key",
    "fs.s3a.secret.key": "secret_key",
    "fs.s3a.session.token": "session_token",
    "fs.s3a.endpoint": "endpoint_override",
    "fs.s3a.endpoint.region": "region",
}
NUMBER_BITS, OFFSET_BITS = 23, 40


def open_folder(path: str, settings: dict[str, str] | None = None) -> tuple[pafs.FileSystem, str]:
    """The file system of a path as Spark writes it, and the path on it.

    ``settings`` are Hadoop's, of which those in ``S3_SETTINGS`` are used.
    """
    if path.startswith("file:"):
        return pafs.LocalFileSystem(), path.removeprefix("file:").replace("///", "/", 1)
    scheme, colon, rest = path.partition("://")
    if colon and SCHEMES.get(scheme, scheme) == "s3":
        known = {S3_SETTINGS[k]: v for k, v in (settings or {}).items() if k in S3_SETTINGS and v}
        return pafs.S3FileSystem(**known), rest
    return pafs.FileSystem.from_uri(SCHEMES.get(scheme, scheme) + colon + rest)


def list_archives(path: str, settings: dict[str, str] | None = None) -> list[tuple[str, int]]:
    """Archive files in a folder, those a pattern in the last step names, or the file itself, with sizes, by name."""
    folder, _, last = path.rstrip("/").rpartition("/")
    pattern = last if any(c in last for c in "*?[") else None
    files, local = open_folder(folder if pattern else path, settings)
    info = files.get_file_info(local)
    found = [info] if info.is_file else files.get_file_info(pafs.FileSelector(local))
    prefix = folder if info.is_file or pattern else path.rstrip("/")
    return sorted(
        (f"{prefix}/{i.base_name}", i.size)
        for i in found
        if i.is_file and i.base_name.endswith(SUFFIXES) and (pattern is None or fnmatch.fnmatchcase(i.base_name, pattern))
    )


class ArchiveRange(InputPartition):
    def __init__(self, number: int, path: str, size: int, start: int, end: int):
        self.number, self.path, self.size, self.start, self.end = number, path, size, start, end


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.paths = options["path"].split("\n")
        self.split = int(options.get("splitBytes", SPLIT_BYTES))
        self.types = tuple(t for t in options.get("recordTypes", "").split(",") if t)
        self.settings = {k: options[k.lower()] for k in S3_SETTINGS if k.lower() in options}
        self.content = options.get("content", "html")
        if self.content not in ("html", "payload", "none"):
            raise ValueError("content is html, payload or none")

    def partitions(self) -> list[ArchiveRange]:
        found = [f for path in self.paths for f in list_archives(path, self.settings)]
        found.sort(key=lambda f: (f[0].rsplit("/", 1)[-1], f[0]))
        if len(found) >> NUMBER_BITS or any(size >> OFFSET_BITS for _, size in found):
            raise ValueError(f"seq takes {1 << NUMBER_BITS} files of {1 << OFFSET_BITS} bytes at most")
        ranges = []
        for number, (path, size) in enumerate(found):
            step = self.split if 0 < self.split < size else max(size, 1)
            for start in range(0, max(size, 1), step):
                ranges.append(ArchiveRange(number, path, size, start, min(start + step, size)))
        return ranges

    def wants_body(self, rec_type: str, http: dict) -> bool:
        return self.content == "payload" or (self.content == "html" and is_html(rec_type, http))

    def read(self, partition: ArchiveRange) -> Iterator[pa.RecordBatch]:
        name = partition.path.rsplit("/", 1)[-1]
        files, local = open_folder(partition.path, self.settings)
        rows: list = []
        held, place = 0, -1
        with files.open_input_file(local) as file:
            records = read_records(
                file, partition.size, partition.start, partition.end, self.types, self.wants_body
            )
            for r in records:
                rec_type = r.headers.get("warc-type", "")
                html = payload = None
                if r.body is not None and is_html(rec_type, r.http):
                    html = r.body.decode("utf-8", "ignore")
                if self.content == "payload":
                    payload = r.body
                # Records of one gzip member come one after the other from its offset on, past the
                # offsets of the next members where there are many.
                place = max(place + 1, r.offset)
                if place >= max(partition.end, r.offset + 1) and partition.end < partition.size:
                    raise ValueError(f"{name} holds too many records in a few bytes; read it with splitBytes=0")
                seq = (partition.number << OFFSET_BITS) + place
                rows.append((seq, name, r.offset, rec_type, r.headers, r.http, html, payload, r.error))
                held += len(r.body or b"")
                if held >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield _batch(rows)
                    rows, held = [], 0
        if rows:
            yield _batch(rows)


def _batch(rows: list) -> pa.RecordBatch:
    pairs = pa.map_(pa.string(), pa.string())
    types = [
        pa.int64(), pa.string(), pa.int64(), pa.string(), pairs, pairs, pa.string(), pa.binary(), pa.string(),
    ]
    names = [
        "seq", "warc_filename", "record_offset", "rec_type", "rec_headers", "http_headers",
        "html", "payload", "record_error",
    ]
    columns = list(zip(*rows))
    for at in (4, 5):
        columns[at] = [list(m.items()) for m in columns[at]]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


class WarcSource(DataSource):
    """Options: ``path`` (a folder or file, several by line breaks), ``content`` (``html``
    fills ``html`` of HTML responses, ``payload`` also ``payload`` of every record, ``none``
    reads headers alone), ``recordTypes`` (a comma list, default all) and ``splitBytes``
    (0 = one task per file)."""

    @classmethod
    def name(cls):
        return "warc"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WarcReader(self.options)


def read_warc(
    spark: SparkSession,
    path: str | Sequence[str],
    content: str = "html",
    record_types: Sequence[str] = (),
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """All records of the archives below ``path``; ``seq`` orders them by file name and place.

    One task per file or per ``split_bytes`` of a larger one. A path may end in a pattern of file
    names. ``record_error`` says what is wrong with a record that was read all the same: bytes missing
    at its end, or an encoding that could not be undone. Numbers of files follow their sorted names, so
    ``seq`` stays the same between runs only while no file is added before others.
    """
    spark.dataSource.register(WarcSource)
    paths = [path] if isinstance(path, str) else list(path)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    found = {k: v for k in S3_SETTINGS if (v := hadoop.get(k))} if any(p.startswith("s3") for p in paths) else {}
    return (
        spark.read.format("warc")
        .options(**found)
        .option("path", "\n".join(qualified(spark, p) for p in paths))
        .option("content", content)
        .option("recordTypes", ",".join(record_types))
        .option("splitBytes", str(split_bytes))
        .load()
    )


def _content_type_is_html():
    kind = F.try_element_at("http_headers", F.lit("content-type"))
    return F.coalesce(kind.contains("text/html"), F.lit(False))


def html_responses(records: DataFrame) -> DataFrame:
    """``seq, url, html, warc`` of response records whose content type has ``text/html``.

    The test is case-sensitive and no HTTP status is looked at.
    """

    def header(name):
        return F.try_element_at("rec_headers", F.lit(name))

    def http(name):
        return F.try_element_at("http_headers", F.lit(name))

    warc = F.struct(
        F.col("warc_filename"),
        header("warc-date").alias("warc_date"),
        header("warc-record-id").alias("warc_record_id"),
        header("warc-ip-address").alias("warc_ip_address"),
        header("warc-payload-digest").alias("warc_payload_digest"),
        header("warc-block-digest").alias("warc_block_digest"),
        header("content-length").alias("content_length"),
        http("date").alias("http_date"),
        http("server").alias("http_server"),
        http("last-modified").alias("http_last_modified"),
    )
    return records.where((F.col("rec_type") == "response") & _content_type_is_html()).select(
        "seq", header("warc-target-uri").alias("url"), "html", warc.alias("warc")
    )


def html_urls(records: DataFrame) -> DataFrame:
    return html_responses(records).select("url").where("url <> ''")


def archive_stats(records: DataFrame) -> DataFrame:
    """Records, and URLs of HTML responses among them, in one row."""
    url = F.try_element_at("rec_headers", F.lit("warc-target-uri"))
    found = (F.col("rec_type") == "response") & _content_type_is_html() & (url != "")
    return records.agg(F.count("*").alias("records"), F.count_if(found).alias("html_urls"))


def record_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("rec_type").agg(F.count("*").alias("records"))
