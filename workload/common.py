"""Inputs that the queries derive from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.functions.names import annotation_slug, container_slug
from pageloom.operators.responses import annotations, parse_response
from pageloom.schemas import WARC_FIELDS
from pageloom.session import spread

COLLECTION_ID = "urn:uuid:collection-001"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


def spread_pages(spark: SparkSession, sf: str) -> DataFrame:
    """``pages`` for the steps that parse HTML."""
    return spread(pages(spark, sf))


_WARC_VALUES = {
    "warc_filename": "concat('rec-one-20260101000000000-', page_id % 4, '.warc.gz')",
    "warc_date": "'2026-01-01T00:00:00Z'",
    "warc_record_id": "concat('<urn:uuid:', page_id, '>')",
}
_WARC = ", ".join(f"'{n}', cast({_WARC_VALUES.get(n, 'null')} as string)" for n in WARC_FIELDS)


def warc() -> Column:
    return F.expr(f"named_struct({_WARC})")


# The kind of answer goes by page_id % 7; four of the seven have annotations.
_ANSWERS = """
with named as (
  select page_id, url, page_id % 7 as kind, regexp_extract(url, '//([^/?#]*)', 1) as host
  from parquet.`PAGES`
),
parts as (
  select *,
    concat(HEAD, 'urn:sha256:', sha2(url, 256), BODY, url, TARGET, url, '"}}') as a0,
    concat(HEAD, 'urn:x:', page_id, BODY, 'page ', page_id, TARGET, url, '"}}') as a1,
    concat('{"name":"', host, '","type":"organization","context":"c"}') as e0,
    concat('{"name":"', upper(host), '","type":"location","context":"c"}') as e1
  from named
)
select page_id, url, case kind
  when 0 then concat('{"annotationPage":{"type":"AnnotationPage","label":["own ', page_id, '"],"items":[', a0, ',', a1,
    ']},"entities":[', e0, ',', e1, ']}')
  when 1 then concat('{"annotationPage":{"type":"AnnotationPage","id":"urn:own:', page_id, '","items":[',
    a0, ',', a1, ']},"entities":[', e0, ',', e1, ']}')
  when 2 then concat('{"annotationPage":{"items":[', a0, ']},"entities":[', e0, ']}')
  when 3 then concat('{"annotationPage":[', a0, ',{"type":"Annotation"}],"entities":[]}')
  when 4 then '{"annotationPage":{"type":"AnnotationPage","items":[]},"entities":[]}'
  when 5 then concat('{"entities":[', e1, ']}')
  else '{bad' end as response, named_struct(WARC) as warc
from parts
"""
_PIECES = {
    "HEAD": """'{"@context":"http://www.w3.org/ns/anno.jsonld","id":"'""",
    "BODY": """'","type":"Annotation","created":"2026","note":7,"body":{"type":"TextualBody","value":"'""",
    "TARGET": """'"},"target":{"source":"'""",
    "WARC": _WARC,
}


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """A model answer per page."""
    text = _ANSWERS.replace("PAGES", f"{sf}/pages.parquet")
    for name, piece in _PIECES.items():
        text = text.replace(name, piece)
    return spark.sql(text)


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_response(responses(spark, sf))


def incoming(spark: SparkSession, sf: str) -> DataFrame:
    """Annotations with the slugs they are stored under."""
    return annotations(parsed(spark, sf)).select(
        "page_id",
        "pos",
        "url",
        container_slug(F.lit(COLLECTION_ID), F.col("warc.warc_filename")).alias("container_slug"),
        annotation_slug(F.col("annotation.id")).alias("annotation_slug"),
        "payload",
    )


ORDER = ("page_id", "pos")

# The same inputs for the SQL side.
SQL_PAGES = """
base as (
  select page_id, url, html, page_id % 7 as kind, regexp_extract(url, '//([^/?#]*)', 1) as host,
         'rec-one-20260101000000000-' || (page_id % 4) || '.warc.gz' as warc_filename,
         '<urn:uuid:' || page_id || '>' as warc_record_id
  from pages
)"""
SQL_ANNOTATIONS = (
    SQL_PAGES
    + """,
annotations as (
  select page_id, 0 as pos, 'urn:sha256:' || sha256(url) as id, url as value, url, warc_filename
  from base where kind in (0, 1, 2, 3)
  union all
  select page_id, 1, 'urn:x:' || page_id, 'page ' || page_id, url, warc_filename
  from base where kind in (0, 1)
),
incoming as (
  select page_id, pos, id, url, 'crawl-' || replace(warc_filename, '.warc.gz', '') as container_slug,
         case when starts_with(id, 'urn:sha256:') then substr(id, 12) else sha256(id) end as annotation_slug,
         '{"@context":"http://www.w3.org/ns/anno.jsonld","body":{"type":"TextualBody","value":"' || value
         || '"},"note":7,"target":{"source":"' || url || '"},"type":"Annotation"}' as payload
  from annotations
)"""
)
SQL_ENTITIES = (
    SQL_PAGES
    + """,
entities as (
  select page_id, 0 as pos, host as name, 'organization' as type, url, warc_filename, warc_record_id
  from base where kind in (0, 1, 2)
  union all
  select page_id, case when kind = 5 then 0 else 1 end, upper(host), 'location', url, warc_filename, warc_record_id
  from base where kind in (0, 1, 5)
)"""
)
