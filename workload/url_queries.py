"""URL queries over ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageloom.functions import urls as U
from pageloom.operators import urls as O
from workload.common import pages

BLOCKED = (*O.MEDIA_BLOCK_RULES, *O.EMBED_BLOCK_RULES, r".*\.html($|\?)", r".*//[^/]*spam-farm\..*")
SCOPE = (r"^https://[^/]*\.org/", r"/de/")
SEQ = "page_id"


def url_parts(spark, sf):
    return pages(spark, sf).select("page_id", U.split_url(F.col("url")).alias("p")).select("page_id", "p.*")


def canonical_url(spark, sf):
    return pages(spark, sf).select("page_id", U.canonical_url(F.col("url")).alias("canonical_url"))


def url_decision(spark, sf):
    return O.url_decision(pages(spark, sf).select("page_id", "url"), seq=SEQ)


def first_seen_pages(spark, sf):
    kept = O.first_seen(pages(spark, sf), seq=SEQ, write_repeats=True)
    return kept.select("page_id", "url", "canonical_url", F.length("html").cast("bigint").alias("html_chars"))


def block_rules(spark, sf):
    return O.block_rules(pages(spark, sf).select("page_id", "url"), BLOCKED)


def scope_include(spark, sf):
    return O.scope_include(pages(spark, sf).select("page_id", "url"), SCOPE)


def page_limit(spark, sf):
    return O.page_limit(pages(spark, sf).select("page_id", "url"), 10, SEQ)


def reject_reason_counts(spark, sf):
    return O.reject_counts(url_decision(spark, sf))


def utm_summary(spark, sf):
    return O.tracking_summary(pages(spark, sf))


QUERIES = {
    f.__name__: f
    for f in (
        url_parts, canonical_url, url_decision, first_seen_pages, block_rules, scope_include,
        page_limit, reject_reason_counts, utm_summary,
    )
}

SQL_PARTS = r"""
pieces as (
  select page_id, url, regexp_extract(regexp_replace(url, '[\t\r\n]', '', 'g'),
    '^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$',
    ['scheme', 'netloc', 'path', 'query', 'fragment']) as p
  from pages
),
parts as (
  select page_id, url, lower(p.scheme) as scheme, p.netloc as netloc,
         regexp_replace(p.path, ';[^/]*$', '') as path, regexp_extract(p.path, ';([^/]*)$', 1) as params,
         p.query as query, p.fragment as fragment
  from pieces
)"""
SQL_CANONICAL = (
    SQL_PARTS
    + r""",
split as (
  select page_id, unnest(string_split(query, '&')) as pair, generate_subscripts(string_split(query, '&'), 1) as nr
  from parts
),
pairs as (
  select page_id, nr, url_decode(replace(regexp_extract(pair, '^([^=]*)=', 1), '+', ' ')) as k,
         url_decode(replace(regexp_extract(pair, '^[^=]*=(.*)$', 1), '+', ' ')) as v
  from split where regexp_matches(pair, '^[^=]*=.')
),
firsts as (
  select page_id, k, arg_min(v, nr) as v from pairs where not starts_with(k, 'utm_') group by all
),
queries as (
  select page_id, string_agg(k || '=' || v, '&' order by k) as query from firsts group by page_id
),
searches as (select distinct page_id from pairs where k in ('q', 's')),
paths as (
  select *, case when path in ('', '/', '/index.html') then '/'
                 when ends_with(path, '/index.html') then left(path, length(path) - 11)
                 when ends_with(path, '/') then left(path, length(path) - 1)
                 else path end as clean_path
  from parts
),
canonical as (
  select p.page_id, p.url, p.scheme, p.netloc, p.path,
         p.scheme || '://' || regexp_replace(lower(p.netloc), '^www\.', '') || p.clean_path
         || coalesce('?' || q.query, '') as canonical_url
  from paths p left join queries q using (page_id)
),
screened as (
  select c.*, case
    when scheme not in ('http', 'https') then 'scheme'
    when netloc in ('bit.ly', 't.co', 'goo.gl', 'lnkd.in', 'tinyurl.com') then 'shortener'
    when regexp_matches(lower(path), 'login|signup|admin|cart|checkout') then 'path_keyword'
    when page_id in (select page_id from searches) then 'search' end as row_reason
  from canonical c
),
decided as (
  select page_id, url, canonical_url, case
    when row_reason is not null then row_reason
    when row_number() over (partition by canonical_url, row_reason order by page_id) > 1 then 'duplicate'
    end as reject_reason
  from screened
)"""
)


def _sql_any(patterns):
    return " or ".join("regexp_matches(url, '" + p.replace("'", "''") + "')" for p in patterns)


ORACLES = {
    "url_parts": f"with {SQL_PARTS} select page_id, scheme, netloc, path, params, query, fragment from parts",
    "canonical_url": f"with {SQL_CANONICAL} select page_id, canonical_url from canonical",
    "url_decision": f"""with {SQL_CANONICAL}
        select page_id, url, canonical_url, reject_reason, reject_reason is null as accepted from decided""",
    "first_seen_pages": f"""with {SQL_CANONICAL}
        select page_id, url, canonical_url, length(html) as html_chars
        from decided join pages using (page_id, url) where reject_reason is null""",
    "block_rules": f"select page_id, url from pages where not ({_sql_any(BLOCKED)})",
    "scope_include": f"select page_id, url from pages where {_sql_any(SCOPE)}",
    "page_limit": "select page_id, url from pages order by page_id limit 10",
    "reject_reason_counts": f"""with {SQL_CANONICAL}
        select coalesce(reject_reason, 'accepted') as outcome, count(*) as urls from decided group by 1""",
    "utm_summary": f"""with {SQL_CANONICAL}
        select regexp_replace(lower(netloc), '^www\\.', '') as host, k as dropped_key, count(*) as urls
        from (select distinct page_id, k from pairs where starts_with(k, 'utm_'))
        join parts using (page_id) group by 1, 2""",
}
