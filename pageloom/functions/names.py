"""Names derived from ids, labels and archive file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

CONTAINER_PREFIX = "crawl-"


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def archive_stem(filename: Column) -> Column:
    """The file name without its archive extension, wherever that stands."""
    return F.replace(F.replace(filename, F.lit(".warc.gz"), F.lit("")), F.lit(".warc"), F.lit(""))


def worker_name(filename: Column) -> Column:
    """``worker-N`` from ``…-N.ext``; else the stem; NULL gives ``unknown``."""
    last = F.substring_index(F.substring_index(filename, "-", -1), ".", 1)
    return (
        F.when(filename.isNull(), F.lit("unknown"))
        .when(filename.contains("-"), F.concat(F.lit("worker-"), last))
        .otherwise(archive_stem(filename))
    )


def annotation_slug(annotation_id: Column) -> Column:
    """The hash of a ``urn:sha256:`` id, or the SHA-256 of any other id."""
    return F.when(
        annotation_id.startswith("urn:sha256:"), F.substring(annotation_id, 12, 2147483647)
    ).otherwise(F.sha2(annotation_id, 256))


def container_slug(
    collection_id: Column, warc_filename: Column | None = None, prefix: str = CONTAINER_PREFIX
) -> Column:
    """Prefix and archive stem; without a file name 12 hex digits of the id's SHA-256."""
    hashed = F.concat(F.lit(prefix), F.substring(F.sha2(collection_id, 256), 1, 12))
    if warc_filename is None:
        return hashed
    named = F.concat(F.lit(prefix), archive_stem(warc_filename))
    return F.when(warc_filename != "", named).otherwise(hashed)


def label_filename(label: Column) -> Column:
    """The archive name at the end of ``<text> - <name>.warc.gz``, else NULL."""
    return F.when(
        label.contains(" - ") & label.endswith(".warc.gz"), F.substring_index(label, " - ", -1)
    )


def bare_record_id(record_id: Column) -> Column:
    """A WARC record id without its angle brackets."""
    return F.regexp_replace(record_id, "^<|>$", "")
