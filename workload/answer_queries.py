"""Queries over model answers, annotations and entities."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from pageloom.functions import names as N
from pageloom.operators import annotate as A
from pageloom.operators import entities as E
from pageloom.operators import responses as R
from pageloom.operators.html import html_blocks, processed_html
from pageloom.functions.text import prompt_text
from pageloom.sources import tables
from pageloom.session import shared_folder, shared_table, spread
from workload import common as C
from workload.html_queries import SQL_BLOCKS

GENERATOR = {"id": "urn:sw:1", "type": "Software", "name": "pageloom", "homepage": "http://sw.example"}
SEQ = "page_id"


def response_shapes(spark, sf):
    return C.parsed(spark, sf).select(
        "page_id",
        "shape",
        F.coalesce(F.size("items"), F.lit(0)).alias("annotations"),
        F.coalesce(F.size("entities"), F.lit(0)).alias("entities"),
    )


def shape_counts(spark, sf):
    return R.shape_counts(C.parsed(spark, sf))


def malformed_responses(spark, sf):
    return R.malformed(C.parsed(spark, sf)).select("page_id", "url")


def annotation_pages(spark, sf):
    made = R.annotation_pages(C.parsed(spark, sf), C.COLLECTION_ID, GENERATOR, seq=SEQ)
    page = F.col("annotation_page")
    return made.select(
        "page_id",
        page["id"].alias("annotation_page_id"),
        page["@context"].alias("context"),
        page["type"].alias("type"),
        page["partOf"].alias("part_of"),
        page["created"].alias("created"),
        page["generator"]["name"].alias("generator_name"),
        page["source"]["warc_record_id"].alias("warc_record_id"),
        F.size(page["items"]).alias("annotations"),
        page["items"][0]["body"]["value"].alias("first_value"),
        "page_keys",
    )


def page_numbers(spark, sf):
    made = R.annotation_pages(C.parsed(spark, sf), C.COLLECTION_ID, GENERATOR, seq=SEQ)
    return made.select("page_id", "page_number")


def annotations(spark, sf):
    return R.annotations(C.parsed(spark, sf)).select(
        "page_id",
        "pos",
        F.col("annotation.id").alias("annotation_id"),
        F.col("annotation.body.value").alias("value"),
        F.col("annotation.target.source").alias("source"),
        "payload",
    )


def _entities(spark, sf):
    return E.entities(C.parsed(spark, sf), seq=SEQ)


def _flat(df):
    return df.select(
        "page_id",
        "pos",
        "entity.name",
        "entity.type",
        *[f"source.{n}" for n in ("url", "warc_filename", "warc_record_id")],
    )


def entities(spark, sf):
    return _flat(_entities(spark, sf))


def entities_by_type(spark, sf):
    return _flat(E.entities_by_type(_entities(spark, sf), "organization"))


def entity_total(spark, sf):
    return E.entity_total(_entities(spark, sf))


def entity_type_counts(spark, sf):
    return E.entity_type_counts(_entities(spark, sf))


def entity_dedup(spark, sf):
    return _flat(E.entity_dedup(_entities(spark, sf), C.ORDER))


def entity_sample(spark, sf):
    return E.entity_sample(_entities(spark, sf), 5, C.ORDER)


def entity_worker(spark, sf):
    found = E.with_worker(_entities(spark, sf))
    return found.groupBy("worker").agg(F.count("*").alias("entities"))


def entity_files(spark, sf):
    """Entity lines written per worker and read back as one dataset."""
    folder = shared_folder(spark)
    tables.write_entities(_entities(spark, sf), folder)
    lines = tables.read_entities(spark, f"{folder}/worker=*")
    return lines.select("entity.name", "entity.type", "source.url", "source.warc_record_id")


def dictionary_entities(spark, sf):
    """Whole ``benchmark`` passages as names, found in whole ``documents``."""
    kinds = F.array(*[F.lit(k) for k in ("artist", "work", "location")])
    names = (
        C.table(spark, sf, "benchmark")
        .select(
            F.array_join(A.words(F.col("text")), " ").alias("name"),
            F.get(kinds, (F.col("item_id") % 3).cast("int")).alias("type"),
        )
        .distinct()
    )
    documents = spread(C.table(spark, sf, "documents").select("doc_id", "text"))
    return A.dictionary_entities(documents, names)


def annotated_text_entities(spark, sf):
    """Names found in annotated text alone: the words and the whole text of every ``h1``."""
    parsed = html_blocks(C.spread_pages(spark, sf), with_text=False, least_own=A.MIN_CHARACTERS)
    # Pages are parsed once: the blocks that are read below are written.
    read = F.filter("blocks", lambda b: A.is_substantial(b) | (b["tag"] == "h1"))
    parsed = shared_table(parsed.withColumn("blocks", read))
    found = A.rule_annotate(parsed).select("page_id", "pos", F.col("annotation.body.value").alias("text"))
    said = A.words(F.col("b.own_text"))
    titles = (
        parsed.select(F.explode("blocks").alias("b"))
        .where("b.tag = 'h1'")
        .select(F.explode(F.concat(said, F.array(F.array_join(said, " ")))).alias("name"), F.lit("work").alias("type"))
        .distinct()
    )
    return A.dictionary_entities(found, titles)


def _answer_model():
    """A stand-in for a model: names the page and annotates its first line."""

    def call(prompts):
        out = []
        for prompt in prompts:
            url, _, text = prompt.partition("\n\n")
            item = {"id": "urn:m:" + url, "body": {"value": text.split("\n")[0]}, "target": {"source": url}}
            out.append(json.dumps({"annotationPage": {"items": [item]}, "entities": [{"name": url, "type": "work"}]}))
        return out

    return call


def model_annotations(spark, sf):
    text = prompt_text(F.col("url"), processed_html(F.col("blocks")))
    asked = html_blocks(C.spread_pages(spark, sf)).select("page_id", text.alias("prompt"))
    answered = A.annotate(asked, "prompt", _answer_model).drop("prompt")
    return R.annotations(R.parse_response(answered)).select(
        "page_id", F.col("annotation.id").alias("annotation_id"), F.col("annotation.body.value").alias("value")
    )


def _url_model():
    def call(urls):
        return [json.dumps({"URL": u, "decision": "skip" if "/de/" in u else "archive"}) for u in urls]

    return call


def model_url_choice(spark, sf):
    chosen = A.archived(A.classify(C.pages(spark, sf).select("page_id", "url"), _url_model))
    return chosen.select("page_id", "url", "llm_decision")


def rule_url_choice(spark, sf):
    pages = C.pages(spark, sf).select("page_id", "url")
    return A.classify(pages, ~F.col("url").contains("spam-farm")).drop("llm_decision_error")


def annotation_slug(spark, sf):
    found = R.annotations(C.parsed(spark, sf))
    return found.select(
        F.col("annotation.id").alias("annotation_id"),
        N.annotation_slug(F.col("annotation.id")).alias("annotation_slug"),
    )


def container_slug(spark, sf):
    """Slugs by archive name, or for every fifth page by the id alone."""
    named = C.pages(spark, sf).select("page_id", "url", C.warc().alias("warc"))
    name = F.when(F.col("page_id") % 5 != 0, F.col("warc.warc_filename"))
    return named.select("page_id", N.container_slug(F.col("url"), name).alias("container_slug"))


def label_filename(spark, sf):
    number = F.col("page_id").cast("string")
    label = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("Set - A - f-"), number, F.lit(".warc.gz")))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("Set - f-"), number, F.lit(".warc")))
        .otherwise(F.concat(F.lit("f-"), number, F.lit(".warc.gz")))
    )
    return C.pages(spark, sf).select("page_id", N.label_filename(label).alias("warc_filename"))


def archive_names(spark, sf):
    """The file of every page's archive by its path, and the page's record id without brackets."""
    warc = C.pages(spark, sf).select("page_id", C.warc().alias("warc"))
    path = F.concat(F.lit("/crawl/archive/"), F.col("warc.warc_filename"))
    return warc.select(
        "page_id", N.base_name(path).alias("file"), N.bare_record_id(F.col("warc.warc_record_id")).alias("record_id")
    )


def worker_names(spark, sf):
    number = F.col("page_id").cast("string")
    name = (
        F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("rec-one-2026-"), number, F.lit(".warc.gz")))
        .when(F.col("page_id") % 3 == 1, F.concat(F.lit("crawl"), number, F.lit(".warc")))
    )
    return C.pages(spark, sf).select("page_id", N.worker_name(name).alias("worker"))


QUERIES = {
    f.__name__: f
    for f in (
        response_shapes, shape_counts, malformed_responses, annotation_pages, page_numbers,
        annotations, entities, entities_by_type, entity_total, entity_type_counts, entity_dedup,
        entity_sample, entity_worker, entity_files, dictionary_entities, annotated_text_entities,
        model_annotations, model_url_choice, rule_url_choice, annotation_slug, container_slug,
        label_filename, archive_names, worker_names,
    )
}

_PAGES = f"with {C.SQL_PAGES}"
_ANNOTATIONS = f"with {C.SQL_ANNOTATIONS}"
_ENTITIES = f"with {C.SQL_ENTITIES}"
_FLAT = "select page_id, pos, name, type, url, warc_filename, warc_record_id from entities"
_SHAPE = """case when kind in (0, 1) then 'typed' when kind = 2 then 'untyped' when kind = 3 then 'list'
            when kind in (4, 5) then 'none' else 'malformed' end"""


def _words(text: str) -> str:
    """The lower-cased words of a text between single spaces."""
    return f"' ' || array_to_string(regexp_extract_all(lower({text}), '[\\p{{L}}\\p{{N}}]+'), ' ') || ' '"


ORACLES = {
    "response_shapes": f"""{_PAGES} select page_id, {_SHAPE} as shape,
        case when kind in (0, 1, 3) then 2 when kind = 2 then 1 else 0 end as annotations,
        case when kind in (0, 1) then 2 when kind in (2, 5) then 1 else 0 end as entities from base""",
    "shape_counts": f"{_PAGES} select {_SHAPE} as shape, count(*) as responses from base group by 1",
    "malformed_responses": f"{_PAGES} select page_id, url from base where kind = 6",
    "annotation_pages": f"""{_PAGES} select page_id,
        case when kind = 1 then 'urn:own:' || page_id
             else 'urn:uuid:page-' || row_number() over (order by page_id) end as annotation_page_id,
        case when kind > 1 then 'http://www.w3.org/ns/anno.jsonld' end as context,
        'AnnotationPage' as type, 'urn:uuid:collection-001' as part_of, '2026-01-01T00:00:00Z' as created,
        'pageloom' as generator_name, warc_record_id,
        case when kind = 2 then 1 else 2 end as annotations, url as first_value,
        case when kind = 0 then '{{"label":["own ' || page_id || '"]}}' when kind = 1 then '{{}}' end as page_keys
        from base where kind < 4""",
    "page_numbers": f"""{_PAGES} select page_id, row_number() over (order by page_id) as page_number
        from base where kind < 4""",
    "annotations": f"""{_ANNOTATIONS} select page_id, i.pos, i.id as annotation_id, a.value, i.url as source, payload
        from incoming i join annotations a using (page_id, pos)""",
    "entities": f"{_ENTITIES} {_FLAT}",
    "entities_by_type": f"{_ENTITIES} {_FLAT} where type = 'organization'",
    "entity_total": f"{_ENTITIES} select count(*) as entities from entities",
    "entity_type_counts": f"{_ENTITIES} select type, count(*) as entities from entities group by type",
    "entity_dedup": f"""{_ENTITIES} {_FLAT}
        qualify row_number() over (partition by lower(name) order by page_id, pos) = 1""",
    "entity_sample": f"""{_ENTITIES} select page_id, pos, name, type, '' as context, url
        from entities order by page_id, pos limit 5""",
    "entity_worker": f"""{_ENTITIES} select 'worker-' || (page_id % 4) as worker, count(*) as entities
        from entities group by 1""",
    "entity_files": f"{_ENTITIES} select name, type, url, warc_record_id from entities",
    "dictionary_entities": f"""with names as (
          select distinct {_words('text')} as name, ['artist', 'work', 'location'][item_id % 3 + 1] as type from benchmark
        ), texts as (select doc_id, {_words('text')} as text from documents)
        select doc_id, trim(name) as name, type from texts join names on contains(text, name) where trim(name) <> ''""",
    "annotated_text_entities": f"""with recursive {SQL_BLOCKS},
        titles as (select {_words('own_text')} as title from blocks where tag = 'h1'),
        names as (
          select title as name from titles union select ' ' || unnest(string_split(trim(title), ' ')) || ' ' from titles
        ), found as (select page_id, pos, {_words('value')} as text from substantial)
        select page_id, pos, trim(name) as name, 'work' as type from found join names on contains(text, name)
        where trim(name) <> ''""",
    "model_annotations": f"""with recursive {SQL_BLOCKS}
        select page_id, 'urn:m:' || url as annotation_id, split_part(processed_html, chr(10), 1) as value
        from rendered join pages using (page_id)""",
    "model_url_choice": """select page_id, url, 'archive' as llm_decision from pages
        where not contains(url, '/de/')""",
    "rule_url_choice": """select page_id, url,
        case when contains(url, 'spam-farm') then 'skip' else 'archive' end as llm_decision from pages""",
    "annotation_slug": f"{_ANNOTATIONS} select id as annotation_id, annotation_slug from incoming",
    "container_slug": """select page_id, 'crawl-' || case
          when page_id % 5 <> 0 then 'rec-one-20260101000000000-' || (page_id % 4)
          else left(sha256(url), 12) end as container_slug from pages""",
    "label_filename": """select page_id,
        case when page_id % 3 = 0 then 'f-' || page_id || '.warc.gz' end as warc_filename from pages""",
    "archive_names": """select page_id, 'rec-one-20260101000000000-' || (page_id % 4) || '.warc.gz' as file,
        'urn:uuid:' || page_id as record_id from pages""",
    "worker_names": """select page_id, case page_id % 3 when 0 then 'worker-' || page_id
        when 1 then 'crawl' || page_id else 'unknown' end as worker from pages""",
}
