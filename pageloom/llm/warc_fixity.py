"""Fixity audit of WARC replicas by Merkle trees.

A record is hashed where it is read. Ranges of ``RANGE`` bytes of a file hash the offsets and
digests of the records that start in them, in order, and each level above hashes ``FAN`` times wider
ranges. Roots of two replicas are compared file by file, and only ranges whose digests differ
are looked into, down to the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageloom.session import shared_table

RANGE_BITS = 16
FAN_BITS = 4


def response_record(url: Column, record_id: Column, date: Column, body: Column) -> Column:
    """A WARC response record, in UTF-8 bytes, of an HTML page."""
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"), F.coalesce(body, F.lit("")))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nWARC-Date: "), date,
        F.lit("\r\nWARC-Record-ID: "), record_id, F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        F.octet_length(http).cast("string"), F.lit("\r\n\r\n"),
    )
    return F.concat(head, http, F.lit("\r\n\r\n")).cast("binary")


def laid_out(records: DataFrame, order: str) -> DataFrame:
    """``offset`` of each row's record (``length`` bytes) in its ``file``, in the order of a column."""
    before = Window.partitionBy("file").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return records.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def hashed(records: DataFrame, record: str = "record") -> DataFrame:
    """``file``, ``offset``, ``digest`` and the other columns; a null record has the digest of no bytes."""
    return records.withColumn("digest", F.sha2(F.coalesce(F.col(record), F.lit(b"")), 256)).drop(record)


def trees(records: DataFrame) -> list[DataFrame]:
    """Levels of the trees of all files, from records up to roots: ``file``, ``node``, ``digest``.

    A node's digest covers the numbers and digests of its children in order, at most ``1 << FAN_BITS``,
    or the records that start in its range. Equal rows at one offset count as often as they stand there.
    """
    level = records.select("file", F.col("offset").cast("long").alias("node"), "digest").where("file is not null and node is not null")
    levels, bits = [shared_table(level)], RANGE_BITS
    most = levels[0].agg(F.max("node")).first()[0] or 0
    while True:
        children = F.array_sort(F.collect_list(F.concat_ws(":", F.lpad(F.col("node").cast("string"), 20, "0"), "digest")))
        parts = levels[-1].groupBy("file", F.shiftright("node", bits).alias("up")).agg(F.sha2(F.concat_ws("\n", children).cast("binary"), 256).alias("digest"))
        levels.append(shared_table(parts.withColumnRenamed("up", "node")))
        most >>= bits
        if not most:
            return levels
        bits = FAN_BITS


def audit(ours: DataFrame, theirs: DataFrame) -> DataFrame:
    """``file``, ``offset`` and ``status`` (changed, missing, extra) where ``theirs`` differs from ``ours``.

    Both hold ``file``, ``offset`` and ``digest``. A record that stands twice at an offset in one
    replica and once in the other is changed. Rows without a file or offset are not compared.
    """
    a, b = trees(ours), trees(theirs)
    height = max(len(a), len(b))
    a, b = (_raised(x, height) for x in (a, b))
    open_ = None
    for k in range(height - 1, -1, -1):
        bits = RANGE_BITS if k == 0 else FAN_BITS
        sides = []
        for side, name in ((a[k], "x"), (b[k], "y")):
            if open_ is not None:
                side = side.join(open_, (side.file == open_.of) & (F.shiftright(side.node, bits) == open_.up), "left_semi")
            if k == 0:
                side = side.groupBy("file", "node").agg(F.concat_ws(",", F.array_sort(F.collect_list("digest"))).alias("digest"))
            sides.append(side.select("file", "node", F.col("digest").alias(name)))
        differ = sides[0].join(sides[1], ["file", "node"], "full").where(~F.col("x").eqNullSafe(F.col("y")))
        if k == 0:
            status = F.when(F.col("y").isNull(), "missing").when(F.col("x").isNull(), "extra").otherwise("changed")
            return differ.select("file", F.col("node").alias("offset"), status.alias("status"))
        open_ = shared_table(differ.select(F.col("file").alias("of"), F.col("node").alias("up")))


def _raised(levels: list[DataFrame], height: int) -> list[DataFrame]:
    """More levels on top, each of one node a file, so that both replicas have trees of one height."""
    out = [*levels]
    while len(out) < height:
        out.append(out[-1].select("file", "node", F.sha2(F.concat(F.lpad(F.col("node").cast("string"), 20, "0"), F.lit(":"), "digest").cast("binary"), 256).alias("digest")))
    return out
