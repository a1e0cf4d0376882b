"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pageloom.llm import decontamination, embedding_dedup, filter_audit, language_id, lm_scoring, periodic_runs, sentencepiece_bpe, simhash, substring_dedup, suffix_array_dedup, token_counts, url_filter, warc_fixity
from pageloom.llm.tables import table
from pageloom.session import shared_table


def op1_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf, "documents", "doc_id", "text"))


def op2_substring_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without its repeated windows of 20 words."""
    kept = substring_dedup.without_repeats(table(spark, sf, "documents", "doc_id", "text"))
    return kept.select(
        "doc_id", F.col("n_tokens").alias("n_words"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_suffix_array_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """What is left of every document without its repeated strings of 50 bytes."""
    kept = suffix_array_dedup.without_repeats(table(spark, sf, "documents", "doc_id", "text"))
    return kept.select(
        "doc_id", F.col("n_tokens").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as flat token files, counted by a scan for the separators."""
    import public_tokenizers

    docs = table(spark, sf, "documents", "doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    files = shared_table(token_counts.token_files(docs, ranks, public_tokenizers.PATTERN))
    return token_counts.document_counts(files).select(F.col("key").alias("doc_id"), "n_tokens")


def op5_embedding_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf, "embeddings", "vec_id", "embedding", "label"))


def op6_sentencepiece(spark: SparkSession, sf: str) -> DataFrame:
    """Number and digest of the ids of every document, and digest of the decoded text."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    coded = sentencepiece_bpe.encode_decode(table(spark, sf, "documents", "doc_id", "text"), model)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        sentencepiece_bpe.ids_digest(F.col("ids")).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def _held_out(key: str = "doc_id", of: int = 4):
    return F.crc32(F.col(key).cast("string").cast("binary")) % of == 2


def _archive(pages: DataFrame) -> DataFrame:
    """Pages as WARC records, a thousand page numbers to a file."""
    record = warc_fixity.response_record(
        F.col("url"), F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">")), F.lit("2026-01-01T00:00:00Z"), F.col("html")
    )
    file = F.concat(F.lit("pages-"), F.expr("page_id div 1000").cast("string"), F.lit(".warc"))
    records = pages.select("page_id", "url", file.alias("file"), record.alias("record")).withColumn("length", F.octet_length("record"))
    return warc_fixity.laid_out(warc_fixity.hashed(records), "page_id")


def op7_warc_fixity(spark: SparkSession, sf: str) -> DataFrame:
    """Where a replica of the pages' archive differs: some pages have a byte changed, some are gone."""
    pages = table(spark, sf, "pages", "page_id", "url", "html")
    ours = shared_table(_archive(pages))
    hurt = (F.col("page_id") % 97 == 0) & (F.octet_length(F.substring("html", 1, 1)) == 1)
    broken = pages.withColumn("html", F.when(hurt, F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html")))
    theirs = _archive(broken).where("page_id % 89 <> 0")
    found = warc_fixity.audit(ours, theirs)
    names = ours.select(F.col("file").alias("of"), F.col("offset").alias("at"), "page_id")
    out = found.join(names, (F.col("file") == F.col("of")) & (F.col("offset") == F.col("at")), "left")
    return out.select("page_id", "file", "offset", "status")


OP7_SQL = r"""
with http as (
  select page_id, url, html, e'HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n' || coalesce(html, '') as http
  from pages
),
records as (
  select page_id, html, 'pages-' || (page_id // 1000) || '.warc' as file,
    e'WARC/1.0\r\nWARC-Type: response\r\nWARC-Target-URI: ' || coalesce(url, '')
    || e'\r\nWARC-Date: 2026-01-01T00:00:00Z\r\nWARC-Record-ID: <urn:page:' || page_id
    || e'>\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: ' || strlen(http)
    || e'\r\n\r\n' || http || e'\r\n\r\n' as record
  from http
),
placed as (
  select page_id, file, html,
    cast(coalesce(sum(strlen(record)) over (partition by file order by page_id rows between unbounded preceding
      and 1 preceding), 0) as bigint) as "offset"
  from records
)
select page_id, file, "offset", case when page_id % 89 = 0 then 'missing' else 'changed' end as status
from placed
where page_id % 89 = 0 or (page_id % 97 = 0 and strlen(substr(html, 1, 1)) = 1 and substr(html, 1, 1) <> '?')
"""


def op8_language_id(spark: SparkSession, sf: str) -> DataFrame:
    """Learned from the documents that are not held out, predicted for all."""
    docs = table(spark, sf, "documents", "doc_id", "text", "lang")
    model = language_id.learned(docs.where(~F.coalesce(_held_out(), F.lit(False))))
    found = language_id.predict(docs, model)
    return found.select("doc_id", _held_out().alias("held_out"), "lang_pred", "score")


def op9_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    return url_filter.filter_urls(table(spark, sf, "pages", "page_id", "url"), URL_RULES)


def op10_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that overlap with benchmark items."""
    return decontamination.leaks(table(spark, sf, "documents", "doc_id", "text"), table(spark, sf, "benchmark", "item_id", "text"))


def op11_lm_scoring(spark: SparkSession, sf: str) -> DataFrame:
    """Log-probabilities of all documents under a model of those that are not held out."""
    held_out = _held_out(of=7)
    docs = table(spark, sf, "documents", "doc_id", "text")
    scored = lm_scoring.score(docs, ~F.coalesce(held_out, F.lit(False)))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def _periodic(key: int | None, words: list[bytes]) -> list[bytes]:
    """One document in ten repeats a piece of its own words up to its end."""
    number = zlib.crc32(str(key).encode()) if key is not None else 1
    seed, n = number // 10, len(words)
    if number % 10 or not n:
        return words
    at = seed % n
    period = 1 + (n - at) // (3 + seed % 8)
    return words[:at] + (words[at : at + period] * -(-(n - at) // period))[: n - at]


def op12_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Number, strongest and digest of the runs of every document, some of which are made periodic, and what is left of it."""
    found = periodic_runs.periodic_runs(table(spark, sf, "documents", "doc_id", "text"), rewrite=_periodic)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "strongest.start",
        "strongest.length",
        "strongest.period",
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines).cast("binary"), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    """What five filters remove in each of their 120 orders, by source, and their Shapley values."""
    docs = table(spark, sf, "documents", "doc_id", "text", "source")
    return filter_audit.audit(docs, table(spark, sf, "labels", "doc_id", "quality", "toxic"))


# The removals are counted document by document along every order, and summed over the orders.
OP13_SQL = r"""
with docs as (
  select coalesce(source, '') as part, doc_id, coalesce(text, '') as text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') as words
  from documents
),
first as (select text, min(doc_id) as first_id from docs group by text),
fails as (
  select d.part, l.good, l.toxic,
    len(words) < 50 as a,
    100 * len(list_distinct(words)) < 65 * len(words) as b,
    100 * len(regexp_extract_all(d.text, '[A-Z]')) > 5 * length(d.text) as c,
    regexp_matches(d.text, '[#$%&*|]') as d,
    coalesce(d.doc_id > f.first_id, false) as e
  from docs d join first f on d.text = f.text
  left join (
    select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id
  ) l on l.doc_id = d.doc_id
),
sets as (
  select part, concat(case when a then 'A' else '' end, case when b then 'B' else '' end, case when c then 'C' else '' end,
    case when d then 'D' else '' end, case when e then 'E' else '' end) as failed,
    count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
  from fails group by all
),
letters(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
  select p.x || q.x || r.x || s.x || t.x as filter_order
  from letters p, letters q, letters r, letters s, letters t
  where p.x not in (q.x, r.x, s.x, t.x) and q.x not in (r.x, s.x, t.x) and r.x not in (s.x, t.x) and s.x <> t.x
),
steps as (
  select filter_order, cast(step as int) as step, substr(filter_order, step, 1) as letter,
    '[' || substr(filter_order, 1, step) || ']' as upto,
    case when step > 1 then '[' || substr(filter_order, 1, step - 1) || ']' else '#' end as earlier
  from orders, (select unnest(range(1, 6)) as step)
),
counted as (
  select part, filter_order, step, letter,
    sum(case when not regexp_matches(failed, upto) then n else 0 end) as kept,
    sum(case when contains(failed, letter) and not regexp_matches(failed, earlier) then n else 0 end) as removed,
    sum(case when contains(failed, letter) and regexp_matches(failed, earlier) then n else 0 end) as redundant,
    sum(case when failed = letter then n else 0 end) as unique_fails,
    sum(case when contains(failed, letter) and not regexp_matches(failed, earlier) then good else 0 end) as good_lost,
    sum(case when contains(failed, letter) and not regexp_matches(failed, earlier) then toxic else 0 end) as toxic_lost
  from sets, steps group by all
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
  cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
  cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, letter) as bigint) as shapley
from counted
"""


_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
OP9_SQL = f"""
with rules(verdict, rule_host, rule_path) as (values {_RULE_ROWS}),
parts as (
  select page_id,
    case when contains(url, '://') then translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
    case when contains(url, '://') then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1)
      else '' end as path
  from pages
),
fits as (
  select page_id, rule_host || rule_path as rule, verdict,
    row_number() over (partition by page_id order by length(rule_host || rule_path) desc, length(rule_host) desc) as nr
  from parts join rules
    on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path)
)
select p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') as verdict
from parts p left join fits f on f.page_id = p.page_id and f.nr = 1
"""

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_warc_fixity": op7_warc_fixity,
    "op8_language_id": op8_language_id,
    "op9_url_filter": op9_url_filter,
    "op10_decontamination": op10_decontamination,
    "op11_lm_scoring": op11_lm_scoring,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_filter_audit": op13_filter_audit,
}
ORACLES = {
    "op7_warc_fixity": OP7_SQL,
    "op9_url_filter": OP9_SQL,
    "op13_filter_audit": OP13_SQL,
}
