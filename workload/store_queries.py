"""Annotation store, checkpoint, token, run, archive and streaming queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from pageloom.functions.names import container_slug
from pageloom.functions.text import token_estimate
from pageloom.operators import checkpoint as K
from pageloom.operators import store as S
from pageloom.operators import tokens as T
from pageloom.operators.responses import annotation_pages
from pageloom.operators.summary import run_summary as summarise
from pageloom.operators.urls import url_decision
from pageloom.plans import runs
from pageloom.session import shared_folder, shared_table
from pageloom.sources import tables, warc
from pageloom.sources.annotation_store import AnnotationStore
from pageloom.streaming import jobs
from workload import common as C
from workload.answer_queries import GENERATOR
from workload.archives import write_archives
from workload.html_queries import SQL_BLOCKS
from workload.url_queries import SQL_CANONICAL

BUDGET = 2000


# --- tokens


def token_counts(spark, sf):
    return C.spread(C.table(spark, sf, "documents")).select("doc_id", T.token_count(F.col("text")).alias("tokens"))


def _word_counter():
    return lambda texts: [len(t.split(" ")) for t in texts]


def token_counts_exact(spark, sf):
    """A caller's tokenizer in place of the estimate."""
    documents = C.spread(C.table(spark, sf, "documents").select("doc_id", "text"))
    return documents.select("doc_id", T.token_count(F.col("text"), _word_counter).alias("tokens"))


def _turns(spark, sf):
    """A turn of the assistant is an answer, any other one a prompt."""
    tokens, answer = token_estimate(F.col("text")), F.col("role") == "assistant"
    return C.table(spark, sf, "conversations").select(
        (F.col("conv_id") * (1 << 20) + F.col("turn")).alias("seq"),
        F.when(answer, 0).otherwise(tokens).alias("prompt_tokens"),
        F.when(answer, tokens).otherwise(0).alias("completion_tokens"),
        (F.col("conv_id") % 3).cast("string").alias("shard"),
    )


def token_batches(spark, sf):
    return T.token_batches(shared_table(_turns(spark, sf)), BUDGET)


def token_batches_sharded(spark, sf):
    """A third of the budget for each of three shards."""
    return T.token_batches(shared_table(_turns(spark, sf)), BUDGET // 3, shard="shard")


def token_state(spark, sf):
    return T.token_state(shared_table(_turns(spark, sf)), BUDGET)


# --- store


def _existing(spark, sf):
    """The annotations of the https pages are in the store already."""
    return C.incoming(spark, sf).where(F.col("url").startswith("https:")).select(*S.KEYS, "payload")


def _containers(spark, sf):
    slug = container_slug(F.lit(C.COLLECTION_ID), F.col("warc.warc_filename"))
    found = C.pages(spark, sf).select(C.warc().alias("warc")).select(slug.alias("slug")).distinct()
    return found.select(*S.container_row(F.col("slug"), F.concat(F.lit("Set - "), "slug")))


def _store(spark, sf):
    return S.Store(_containers(spark, sf), _existing(spark, sf))


def _doubled(spark, sf):
    """Every annotation comes twice, as from two crawls of a page."""
    once = C.incoming(spark, sf).drop("url")
    return once.unionByName(once.withColumn("page_id", F.col("page_id") + (1 << 40)))


def annotation_upsert(spark, sf):
    return S.upsert_annotations(_doubled(spark, sf), _existing(spark, sf), C.ORDER)


def upsert_counts(spark, sf):
    return S.upsert_counts(S.upsert_decisions(_doubled(spark, sf), _existing(spark, sf), C.ORDER))


def upload_summary(spark, sf):
    decisions = S.upsert_decisions(_doubled(spark, sf), _existing(spark, sf), C.ORDER)
    return S.upload_summary(_containers(spark, sf), decisions)


FIRST, SECOND = "crawl-rec-one-20260101000000000-0", "crawl-rec-one-20260101000000000-1"


def replace_container(spark, sf):
    """Containers and their annotations after the first container was created again."""
    created = _containers(spark, sf).where(F.col("container_slug") == FIRST).withColumn("label", F.lit("anew"))
    after = S.replace_containers(_store(spark, sf), created)
    counts = after.annotations.groupBy("container_slug").agg(F.count("*").alias("annotations"))
    return after.containers.select("container_slug", "label").join(counts, "container_slug", "left").fillna(0)


def stored_containers(spark, sf):
    """A store on disk: created, filled, one container replaced, filled again and one deleted; then read back."""
    store = AnnotationStore(spark, shared_folder(spark))
    containers, rows = _containers(spark, sf), shared_table(_doubled(spark, sf))
    store.create(containers)
    early = rows.where(F.col("payload").contains("https:"))
    store.insert(early, C.ORDER)
    store.create(containers.where(F.col("container_slug") == FIRST).withColumn("label", F.lit("anew")))
    store.insert(rows, C.ORDER)
    store.delete(SECOND)
    counts = store.annotations().groupBy("container_slug").agg(F.count("*").alias("annotations"), F.min("payload").alias("payload"))
    return store.containers().select("container_slug", "label").join(counts, "container_slug", "left").fillna(0)


def delete_container(spark, sf):
    return S.delete_container(_store(spark, sf), FIRST).annotations


def container_deleted(spark, sf):
    return S.container_exists(_store(spark, sf), FIRST)


def get_container(spark, sf):
    found = S.get_container(_store(spark, sf), FIRST)
    return found.withColumnRenamed("@context", "context")


def run_container(spark, sf):
    pages = C.pages(spark, sf).select(C.warc().alias("warc"))
    return S.run_container(pages, C.COLLECTION_ID, "Annotations").withColumnRenamed("@context", "context")


PAGES_PER_PART = 10_000


def _collections(spark, sf):
    """A collection per archive file, of the pages that have annotations."""
    made = annotation_pages(C.parsed(spark, sf), C.COLLECTION_ID, GENERATOR, seq="page_id")
    nested = made.select(
        F.col("page_id").alias("seq"),
        F.col("annotation_page.id").alias("page_id"),
        F.col("items_json").alias("items"),
        F.col("warc.warc_filename").alias("name"),
    )
    return S.assemble_collection(
        shared_table(nested),
        F.concat(F.lit("Set - "), F.col("name")),
        F.concat(F.lit("urn:c:"), F.col("name")),
        pages_per_part=PAGES_PER_PART,
    )


def collection_assemble(spark, sf):
    """The documents, flattened again in page order."""
    pages = _collections(spark, sf).select("id", "label", "first_page", F.posexplode("items").alias("nr", "page"))
    return pages.select("id", "label", (F.col("first_page") + F.col("nr")).alias("nr"), F.col("page.id").alias("annotation_page_id"), F.size("page.items").alias("annotations"))


def collection_stats(spark, sf):
    return S.collection_stats(_collections(spark, sf))


def collection_flatten(spark, sf):
    return S.collection_annotations(_collections(spark, sf)).select(*S.KEYS, "payload", "seq", "pos")


def load_collection(spark, sf):
    """Summary of a load over a store that has the containers and half the annotations."""
    return S.load_collection(_store(spark, sf), shared_table(_collections(spark, sf)))[1]


def _damaged(spark, sf):
    """The collections, of which each page has two further items: one without an id or with a null one, and one that is no JSON."""

    def odd(i):
        return F.when(i % 2 == 0, F.lit('{"body": 1}')).otherwise(F.lit('{"id": null}'))

    more = F.transform("items", lambda p, i: F.struct(p["id"].alias("id"), F.concat(p["items"], F.array(odd(i), F.lit("{broken"))).alias("items")))
    return shared_table(_collections(spark, sf).withColumn("items", more))


def collection_rejects(spark, sf):
    rejects = S.collection_rejects(_damaged(spark, sf))
    return rejects.groupBy("container_slug", "error").agg(F.count("*").alias("items"), F.min("pos").alias("least_pos"))


def load_damaged_collection(spark, sf):
    """Summary of a load whose items cannot all be stored."""
    return S.load_collection(_store(spark, sf), _damaged(spark, sf), write_decisions=True)[1]


def collection_files(spark, sf):
    """Collection documents written as JSON and loaded from the files."""
    folder = shared_folder(spark)
    tables.write_collection(_collections(spark, sf), folder)
    read = tables.read_collection(spark, folder, multi_line=False)
    return S.collection_annotations(read).select(*S.KEYS, "payload")


# --- checkpoint and runs


def _processed(spark, sf):
    """The plain http pages were done before the stop."""
    return C.pages(spark, sf).select("url").where(F.col("url").startswith("http:"))


def resume_unprocessed(spark, sf):
    return K.unprocessed(C.pages(spark, sf).select("page_id", "url"), _processed(spark, sf))


def resume_decision(spark, sf):
    return K.resume_decision(C.pages(spark, sf).select("page_id", "url"), _processed(spark, sf), seq="page_id")


def resume_decision_compat(spark, sf):
    pages = C.pages(spark, sf).select("page_id", "url")
    return K.resume_decision(pages, _processed(spark, sf), seq="page_id", compat=True)


def _decided(spark, sf):
    decided = url_decision(C.pages(spark, sf), seq="page_id").withColumnRenamed("accepted", "heuristic_decision")
    rule = F.when(F.col("url").contains("/de/"), "skip").otherwise("archive")
    return (
        decided.withColumn("llm_decision", rule)
        .withColumn("processed_html", F.concat(F.lit("text of "), "url"))
        .withColumn("generated_annotation", F.concat(F.lit("answer for "), "url"))
    )


def checkpoint_records(spark, sf):
    return K.checkpoint_records(_decided(spark, sf))


def checkpoint_files(spark, sf):
    """Records appended as JSON, read for resuming and turned into Parquet."""
    records, final = shared_folder(spark), shared_folder(spark)
    tables.write_checkpoint_lines(K.checkpoint_records(_decided(spark, sf)), records)
    tables.finalise(spark, records, final)
    done = K.processed_urls(tables.read_checkpoint_lines(spark, records))
    return spark.read.parquet(final).join(done, "url", "left_semi").drop("html")


def run_summary(spark, sf):
    decisions = S.upsert_decisions(_doubled(spark, sf), _existing(spark, sf), C.ORDER)
    return summarise(C.pages(spark, sf), C.parsed(spark, sf), decisions)


def _crawl_pages(spark, sf):
    return C.spread_pages(spark, sf).select(F.col("page_id").alias("seq"), "url", "html", C.warc().alias("warc"))


def crawl_run_summary(spark, sf):
    """The whole run with the rule annotator: pages to a new store, counted."""
    empty = S.Store(_containers(spark, sf).where("false"), _existing(spark, sf).where("false"))
    return runs.annotate_crawl(_crawl_pages(spark, sf), empty, C.COLLECTION_ID, "Annotations").summary


def resume_run(spark, sf):
    """A resumable run that was stopped after the plain http pages."""
    folder = shared_folder(spark)
    choose = ~F.col("url").contains("/de/")
    pages = _crawl_pages(spark, sf)
    runs.resume_crawl(spark, pages.where(F.col("url").startswith("http:")), folder, choose)
    runs.resume_crawl(spark, pages, folder, choose)
    return tables.read_checkpoint(spark, f"{folder}/records").select(
        "url", "heuristic_decision", "llm_decision", F.col("processed_html").isNotNull().alias("processed"),
        F.length("html").cast("bigint").alias("html_chars"),
    )


def _failing_model():
    def call(prompts):
        if any(len(p.split("\n")[0]) % 5 == 0 for p in prompts):
            raise ValueError("no answer")
        return [_model_answer(p.split("\n")[0]) for p in prompts]

    return call


def _working_model():
    return lambda prompts: [_model_answer(p.split("\n")[0]) for p in prompts]


def _model_answer(url):
    return json.dumps({"annotationPage": {"items": [{"id": "urn:m:" + url}]}, "entities": [{"name": url, "type": "work"}]})


def _failed_and_resumed(spark, sf):
    """A run whose model fails for some pages, and one after it whose model works."""
    folder = shared_folder(spark)
    pages, choose = _crawl_pages(spark, sf), ~F.col("url").contains("/de/")
    first = runs.resume_crawl(spark, pages, folder, choose, _failing_model)
    return folder, first, runs.resume_crawl(spark, pages, folder, choose, _working_model)


def resume_after_failure(spark, sf):
    """Every URL has one record after the second run, and the failed ones have their answers."""
    folder, first, _ = _failed_and_resumed(spark, sf)
    again = first.failures.select("url", F.lit(True).alias("failed_once"))
    records = tables.read_checkpoint(spark, f"{folder}/records")
    return records.join(again, "url", "left").select(
        "url", "llm_decision", F.col("generated_annotation").isNotNull().alias("answered"),
        F.coalesce("failed_once", F.lit(False)).alias("failed_once"),
    )


def resume_entities(spark, sf):
    folder, _, _ = _failed_and_resumed(spark, sf)
    lines = tables.read_run_entities(spark, folder)
    return lines.select("entity.name", "entity.type", "source.url", "source.warc_record_id")


def reload_run(spark, sf):
    folder = shared_folder(spark)
    tables.write_collection(_collections(spark, sf), folder)
    return runs.reload_collection(spark, folder, _store(spark, sf), multi_line=False)[1]


# --- archives


def _archives(spark, sf):
    return write_archives(C.spread_pages(spark, sf), shared_folder(spark))


def warc_scan(spark, sf):
    found = warc.html_responses(warc.read_warc(spark, _archives(spark, sf), record_types=("response",)))
    return found.select("url", "html", "warc.warc_record_id", "warc.http_server", "warc.http_last_modified")


def warc_urls(spark, sf):
    return warc.html_urls(warc.read_warc(spark, _archives(spark, sf), content="none"))


def warc_stats(spark, sf):
    return warc.archive_stats(warc.read_warc(spark, _archives(spark, sf), content="none"))


def warc_record_counts(spark, sf):
    return warc.record_counts(warc.read_warc(spark, _archives(spark, sf), content="none"))


# --- streams


def _in_parts(rows, source, job):
    """Feed rows in three parts in the order of ``seq``; the job is started anew for each."""
    low, high = rows.approxQuantile("seq", [0.33, 0.67], 0.05) or (0, 0)
    for part in (F.col("seq") <= low, (F.col("seq") > low) & (F.col("seq") <= high), F.coalesce(F.col("seq") > high, F.lit(True))):
        rows.where(part).write.mode("append").parquet(source)
        stream = rows.sparkSession.readStream.schema(rows.schema).parquet(source)
        job(stream).trigger(availableNow=True).start().awaitTermination()


def _page_urls(spark, sf):
    return C.pages(spark, sf).select(F.col("page_id").alias("seq"), "url")


def _finish(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def stream_first_seen(spark, sf):
    source, output, checkpoint = (shared_folder(spark) for _ in range(3))

    def job(stream):
        kept = jobs.first_seen_stream(stream).select("canonical_url")
        return kept.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)

    _in_parts(_page_urls(spark, sf), source, job)
    return spark.read.parquet(output)


def stream_first_seen_ordered(spark, sf):
    source, output, checkpoint = (shared_folder(spark) for _ in range(3))
    _in_parts(_page_urls(spark, sf), source, lambda stream: jobs.first_seen_job(stream, output, checkpoint))
    return spark.read.parquet(output).select("seq", "url", "canonical_url")


def stream_upsert(spark, sf):
    source, store, checkpoint = (shared_folder(spark) for _ in range(3))
    rows = _doubled(spark, sf).withColumnRenamed("page_id", "seq")
    _in_parts(rows, source, lambda stream: jobs.upsert_job(stream, store, checkpoint))
    return AnnotationStore(spark, store).annotations()


def stream_token_batches(spark, sf):
    source, output, state, checkpoint = (shared_folder(spark) for _ in range(4))
    turns = shared_table(_turns(spark, sf).drop("shard"))
    _in_parts(turns, source, lambda stream: jobs.budget_job(stream, output, state, checkpoint, BUDGET))
    return spark.read.parquet(output).select("seq", "batch")


def stream_token_batches_sharded(spark, sf):
    """A third of the budget for each of three shards, over restarts."""
    source, output, state, checkpoint = (shared_folder(spark) for _ in range(4))
    turns = shared_table(_turns(spark, sf))
    _in_parts(turns, source, lambda stream: jobs.budget_job(stream, output, state, checkpoint, BUDGET // 3, shard="shard"))
    return spark.read.parquet(output).select("seq", "batch", "shard")


def stream_entities(spark, sf):
    source, output, checkpoint = (shared_folder(spark) for _ in range(3))
    from pageloom.operators.entities import entities

    rows = entities(C.parsed(spark, sf), seq="page_id")
    rows.write.parquet(source)
    stream = spark.readStream.schema(rows.schema).parquet(source)
    _finish(jobs.entity_stream(stream, output, checkpoint))
    lines = tables.read_entities(spark, f"{output}/worker=*")
    return lines.select("entity.name", "entity.type", "source.url", "source.warc_record_id")


QUERIES = {
    f.__name__: f
    for f in (
        token_counts, token_counts_exact, token_batches, token_batches_sharded, token_state,
        annotation_upsert, upsert_counts, upload_summary, replace_container, stored_containers, delete_container,
        container_deleted, get_container, run_container, collection_assemble, collection_stats,
        collection_flatten, load_collection, collection_rejects, load_damaged_collection, collection_files, resume_unprocessed, resume_decision,
        resume_decision_compat, checkpoint_records, checkpoint_files, run_summary,
        crawl_run_summary, resume_run, resume_after_failure,
        resume_entities, reload_run, warc_scan, warc_urls, warc_stats,
        warc_record_counts, stream_first_seen, stream_first_seen_ordered, stream_upsert,
        stream_token_batches, stream_token_batches_sharded, stream_entities,
    )
}
QUERIES["token_estimate"] = QUERIES.pop("token_counts")

_TOKENS = r"len(regexp_extract_all(text, '\p{L}{1,5}|\p{N}{1,3}|[^\s\p{L}\p{N}]'))"


def _fold(budget: int, shard: str) -> str:
    return f"""with recursive turns as (
      select conv_id * 1048576 + turn as seq, {shard} as shard,
        case when role = 'assistant' then 0 else {_TOKENS} end as p,
        case when role = 'assistant' then {_TOKENS} else 0 end as c,
        row_number() over (partition by {shard} order by conv_id, turn) as nr
      from conversations
    ),
    fold as (
      select shard, 0::bigint as nr, 0::bigint as used, 0::bigint as batch, null::bigint as own, null::bigint as seq
      from (select distinct shard from turns)
      union all
      select shard, nr, case when before + p + c > {budget} then 0 else before + p + c end,
        opened + case when before + p + c > {budget} then 1 else 0 end, opened, seq
      from (
        select t.*, f.batch + case when f.used + t.p > {budget} then 1 else 0 end as opened,
          case when f.used + t.p > {budget} then 0 else f.used end as before
        from fold f join turns t on t.shard = f.shard and t.nr = f.nr + 1
      )
    )"""


_EXISTING = f"with {C.SQL_ANNOTATIONS}, existing as (select * from incoming where starts_with(url, 'https:'))"
_COUNTS = """counts as (
  select container_slug, count(*) filter (where starts_with(url, 'http:')) as annotations_uploaded,
    2 * count(*) - count(*) filter (where starts_with(url, 'http:')) as annotations_skipped
  from incoming group by 1)"""
_COLLECTIONS = f"""with {C.SQL_ANNOTATIONS}, members as (
  select page_id, kind, warc_filename, (row_number() over (partition by warc_filename order by page_id) - 1) as nr,
    row_number() over (order by page_id) as page_number, case when kind = 2 then 1 else 2 end as n
  from base where kind < 4)"""
_FLATTENED = f"""{_COLLECTIONS} select container_slug, annotation_slug, payload, nr as seq, i.pos
  from incoming i join members using (page_id)"""
_ENTITY_FILES = f"with {C.SQL_ENTITIES} select name, type, url, warc_record_id from entities"
_RECORDS = f"""with {SQL_CANONICAL}, choices as (
  select d.url, p.html, d.reject_reason is null as ok, case when contains(d.url, '/de/') then 'skip' else 'archive' end as choice
  from decided d join pages p using (page_id))
  select url, {{html}} ok as heuristic_decision, case when ok then choice end as llm_decision,
    case when ok and choice = 'archive' then 'text of ' || url end as processed_html,
    case when ok and choice = 'archive' then 'answer for ' || url end as generated_annotation from choices"""
_LEFT = f"""with {SQL_CANONICAL}, done as (select canonical_url from screened where starts_with(url, 'http:') and row_reason is null),
  work as (select *, row_number() over (partition by canonical_url, row_reason order by page_id) as nr
    from screened where starts_with(url, 'https:')),
  judged as (select page_id, url, canonical_url, case when row_reason is not null then row_reason
    when nr > 1 or ({{seen}} and canonical_url in (select canonical_url from done)) then 'duplicate' end as reject_reason from work)"""
_JUDGED = "select page_id, url, canonical_url, reject_reason, reject_reason is null as accepted from judged"

ORACLES = {
    "token_estimate": f"select doc_id, {_TOKENS} as tokens from documents",
    "token_counts_exact": "select doc_id, len(string_split(text, ' ')) as tokens from documents",
    "token_batches": f"{_fold(BUDGET, '0')} select seq, own as batch from fold where nr > 0",
    "token_batches_sharded": f"""{_fold(BUDGET // 3, '(conv_id % 3)')}
        select seq, own as batch, shard::varchar as shard from fold where nr > 0""",
    "token_state": f"{_fold(BUDGET, '0')} select used as token_count, batch from fold order by nr desc limit 1",
    "annotation_upsert": f"""{_EXISTING} select page_id, pos, container_slug, annotation_slug, payload
        from incoming where starts_with(url, 'http:')""",
    "upsert_counts": f"{_EXISTING}, {_COUNTS} select * from counts",
    "upload_summary": f"{_EXISTING}, {_COUNTS} select *, true as container_created, 0::bigint as errors from counts",
    "replace_container": f"""{_EXISTING} select s.container_slug,
        case when s.container_slug = '{FIRST}' then 'anew' else 'Set - ' || s.container_slug end as label,
        count(e.page_id) filter (where s.container_slug <> '{FIRST}') as annotations
        from (select distinct 'crawl-' || replace(warc_filename, '.warc.gz', '') as container_slug from base) s
        left join existing e using (container_slug) group by 1""",
    "stored_containers": f"""with {C.SQL_ANNOTATIONS} select s.container_slug,
        case when s.container_slug = '{FIRST}' then 'anew' else 'Set - ' || s.container_slug end as label,
        count(i.page_id) as annotations, min(i.payload) as payload
        from (select distinct 'crawl-' || replace(warc_filename, '.warc.gz', '') as container_slug from base) s
        left join incoming i using (container_slug) where s.container_slug <> '{SECOND}' group by 1""",
    "delete_container": f"""{_EXISTING} select container_slug, annotation_slug, payload from existing
        where container_slug <> '{FIRST}'""",
    "container_deleted": "select count(*) > 0 as deleted from pages where page_id % 4 = 0",
    "get_container": f"""{_EXISTING} select container_slug, 'http://iiif.io/api/presentation/3/context.json' as context,
        'AnnotationCollection' as type, 'Set - ' || container_slug as label, annotation_slug, payload
        from existing where container_slug = '{FIRST}'""",
    "run_container": f"""with {C.SQL_PAGES} select 'crawl-' || replace(min(warc_filename), '.warc.gz', '') as container_slug,
        'http://iiif.io/api/presentation/3/context.json' as context, 'AnnotationCollection' as type,
        'Annotations - ' || min(warc_filename) as label from base""",
    "collection_assemble": f"""{_COLLECTIONS} select 'urn:c:' || warc_filename as id, 'Set - ' || warc_filename as label,
        nr, case when kind = 1 then 'urn:own:' || page_id else 'urn:uuid:page-' || page_number end as annotation_page_id,
        n as annotations from members""",
    "collection_stats": f"""{_COLLECTIONS} select 'urn:c:' || warc_filename as id, 'Set - ' || warc_filename as label,
        count(*)::integer as pages, sum(n)::integer as annotations from members group by warc_filename""",
    "collection_flatten": _FLATTENED,
    "load_collection": f"""{_EXISTING} select container_slug, true as container_created,
        count(*) as annotations_uploaded, 0::bigint as annotations_skipped, 0::bigint as errors from incoming group by 1""",
    "collection_rejects": f"""{_COLLECTIONS}, rejected as (
          select warc_filename, 'no_id' as error, 1 as pos from members where kind = 3
          union all select warc_filename, case when nr % 2 = 0 then 'no_id' else 'null_id' end, n from members
          union all select warc_filename, 'not_json', n + 1 from members)
        select 'crawl-' || replace(warc_filename, '.warc.gz', '') as container_slug, error, count(*) as items,
          min(pos)::integer as least_pos from rejected group by 1, 2""",
    "load_damaged_collection": f"""{_COLLECTIONS}, errors as (
          select 'crawl-' || replace(warc_filename, '.warc.gz', '') as container_slug, count(*) + sum(nr % 2)::bigint as errors
          from members group by 1),
        found as (select container_slug, count(*) as annotations_uploaded from incoming group by 1)
        select container_slug, true as container_created, annotations_uploaded, 0::bigint as annotations_skipped, errors::bigint as errors
        from found join errors using (container_slug)""",
    "collection_files": f"select container_slug, annotation_slug, payload from ({_FLATTENED})",
    "resume_unprocessed": "select page_id, url from pages where starts_with(url, 'https:')",
    "resume_decision": _LEFT.format(seen="true") + _JUDGED,
    "resume_decision_compat": _LEFT.format(seen="false") + _JUDGED,
    "checkpoint_records": _RECORDS.format(html="html,"),
    "checkpoint_files": _RECORDS.format(html=""),
    "run_summary": f"""{_EXISTING}, {C.SQL_ENTITIES.replace(C.SQL_PAGES, '').lstrip(',').strip()}, {_COUNTS}
        select (select count(*) from base) as urls, (select count(*) from base where kind < 4) as pages_with_annotations,
          (select count(*) from base where kind = 6) as malformed_responses, (select count(*) from entities) as entities,
          (select sum(annotations_uploaded)::bigint from counts) as annotations_uploaded,
          (select sum(annotations_skipped)::bigint from counts) as annotations_skipped""",
    "crawl_run_summary": f"""with recursive {SQL_BLOCKS}, {SQL_CANONICAL}, found as (
          select s.* from substantial s join decided d using (page_id) where d.reject_reason is null)
        select (select count(*) from pages) as urls, count(distinct page_id) as pages_with_annotations,
          0::bigint as malformed_responses, 0::bigint as entities, count(distinct annotation_id) as annotations_uploaded,
          count(*) - count(distinct annotation_id) as annotations_skipped from found""",
    "resume_run": f"""with {SQL_CANONICAL}, ordered as (
          select page_id, url, row_reason, row_number() over (partition by canonical_url, row_reason
            order by starts_with(url, 'http:')::int desc, page_id) as nr from screened),
        judged as (select page_id, url, row_reason is null and nr = 1 as ok, not contains(url, '/de/') as chosen from ordered)
        select j.url, ok as heuristic_decision,
          case when ok then case when chosen then 'archive' else 'skip' end end as llm_decision,
          ok and chosen as processed, length(p.html) as html_chars from judged j join pages p using (page_id)""",
    "resume_after_failure": f"""with {SQL_CANONICAL}, judged as (
          select url, reject_reason is null as ok, not contains(url, '/de/') as chosen from decided)
        select url, case when ok then case when chosen then 'archive' else 'skip' end end as llm_decision,
          ok and chosen as answered, ok and chosen and length(url) % 5 = 0 as failed_once from judged""",
    "resume_entities": f"""with {SQL_CANONICAL}
        select url as name, 'work' as type, url, '<urn:uuid:' || page_id || '>' as warc_record_id
        from decided where reject_reason is null and not contains(url, '/de/')""",
    "reload_run": f"""{_EXISTING} select container_slug, true as container_created,
        count(*) as annotations_uploaded, 0::bigint as annotations_skipped, 0::bigint as errors from incoming group by 1""",
    "warc_scan": """select url, html, '<urn:uuid:' || page_id || '>' as warc_record_id,
        case when page_id % 2 = 0 then 'test' end as http_server, null::varchar as http_last_modified from pages""",
    "warc_urls": "select url from pages",
    "warc_stats": """select (select 2 * count(*) from pages) as records, (select count(*) from pages) as html_urls""",
    "warc_record_counts": """select 'response' as rec_type, count(*) as records from pages
        union all select 'request', count(*) from pages""",
    "stream_first_seen": f"with {SQL_CANONICAL} select distinct canonical_url from screened where row_reason is null",
    "stream_first_seen_ordered": f"""with {SQL_CANONICAL}
        select page_id as seq, url, canonical_url from decided where reject_reason is null""",
    "stream_upsert": f"""with {C.SQL_ANNOTATIONS} select distinct container_slug, annotation_slug, payload from incoming""",
    "stream_token_batches_sharded": f"""{_fold(BUDGET // 3, '(conv_id % 3)')}
        select seq, own as batch, shard::varchar as shard from fold where nr > 0""",
    "stream_token_batches": f"{_fold(BUDGET, '0')} select seq, own as batch from fold where nr > 0",
    "stream_entities": _ENTITY_FILES,
}
