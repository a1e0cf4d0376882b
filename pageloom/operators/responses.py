"""Model answers to annotation pages, annotations and entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.operators.annotate import ANNOTATION_CONTEXT
from pageloom.operators.columns import with_computed
from pageloom.operators.order import ROWS_PER_CHUNK, number_rows

# Keys that the store sets by itself, and keys of a page that have columns of their own.
STORE_KEYS = ("id", "created")
PAGE_KEYS = ("@context", "id", "type", "items", "partOf", "created", "generator", "generated", "source")


def _text(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "string")


def _array(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "array<variant>")


def parse_response(df: DataFrame, response: str = "response") -> DataFrame:
    """Replace the answer by ``shape``, ``page``, ``items`` and ``entities``.

    ``shape`` is ``typed``, ``untyped`` or ``list`` where there are annotations, else
    ``none``, or ``malformed`` where the text is not a JSON object. ``page``, ``items``
    and ``entities`` are variants; entities are kept whatever the shape.
    """
    answer, page = F.col("_answer"), F.col("page")
    is_object = F.col("_kind").startswith("OBJECT")
    typed = F.coalesce(_text(page, "$.type") == "AnnotationPage", F.lit(False))
    shape = (
        F.when(~F.coalesce(is_object, F.lit(False)), "malformed")
        .when(F.size(F.coalesce("items", F.array().cast("array<variant>"))) == 0, "none")
        .when(_array(page, "$").isNotNull(), "list")
        .when(typed, "typed")
        .otherwise("untyped")
    )
    read = with_computed(df, _answer=F.try_parse_json(response))
    taken = with_computed(
        read.withColumn("page", F.try_variant_get(answer, "$.annotationPage", "variant")),
        _kind=F.schema_of_variant(answer),
        items=F.coalesce(_array(page, "$"), _array(page, "$.items")),
        entities=_array(answer, "$.entities"),
    )
    return taken.withColumn("shape", shape).drop("_answer", "_kind", response)


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.where("shape = 'malformed'")


def shape_counts(parsed: DataFrame) -> DataFrame:
    return parsed.groupBy("shape").agg(F.count("*").alias("responses"))


def annotation_struct(item: Column) -> Column:
    """The known fields of one annotation variant; a field of another type is NULL."""

    def fields(parent: str, *names: str) -> list[Column]:
        return [_text(item, f"{parent}.{n}").alias(n) for n in names]

    return F.struct(
        _text(item, '$["@context"]').alias("@context"),
        *fields("$", "id", "type", "motivation", "creator"),
        F.struct(*fields("$.body", "type", "value", "format", "language")).alias("body"),
        F.struct(
            *fields("$.target", "source"),
            F.struct(*fields("$.target.selector", "type", "value")).alias("selector"),
        ).alias("target"),
    )


def payload(item: Column) -> Column:
    """One annotation variant as JSON text with all its keys but the store's own."""
    fields = F.try_variant_get(item, "$", "map<string,variant>")
    return F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*STORE_KEYS)))


def annotations(parsed: DataFrame) -> DataFrame:
    """One row per annotation with an id: ``pos``, ``annotation``, ``payload``."""
    others = [c for c in parsed.columns if c not in ("page", "items", "entities", "shape")]
    return (
        parsed.where("shape in ('typed', 'untyped', 'list')")
        .select(*others, F.posexplode("items").alias("pos", "_item"))
        .where(_text(F.col("_item"), "$.id").isNotNull())
        .select(
            *others,
            "pos",
            annotation_struct(F.col("_item")).alias("annotation"),
            payload(F.col("_item")).alias("payload"),
        )
    )


def annotation_pages(
    parsed: DataFrame,
    collection_id: str,
    generator: dict[str, str],
    warc: str = "warc",
    seq: str = "seq",
    rows_per_chunk: int = ROWS_PER_CHUNK,
) -> DataFrame:
    """One annotation page per answer with annotations, as ``annotation_page``.

    Pages are numbered 1, 2, 3 … by ``seq``. A typed page keeps its own id and context;
    the other shapes get new ones, and metadata always comes from the archive record. What
    else a typed page has is kept as JSON in ``page_keys``, and every annotation whole in ``items_json``.
    ``generator`` gives id, type, name and homepage of the software. ``parsed`` is read
    three times for the numbers: let it come from a table.
    """
    found = parsed.where("shape in ('typed', 'untyped', 'list')")
    numbered = number_rows(found, "page_number", seq, rows_per_chunk)
    typed, page = F.col("shape") == "typed", F.col("page")
    new_id = F.concat(F.lit("urn:uuid:page-"), F.col("page_number").cast("string"))
    own = F.when(typed, _text(page, '$["@context"]')).otherwise(F.lit(ANNOTATION_CONTEXT))
    held = F.try_variant_get(page, "$", "map<string,variant>")
    own_keys = F.to_json(F.map_filter(held, lambda k, _: ~k.isin(*PAGE_KEYS)))
    date = F.col(f"{warc}.warc_date")
    source = (
        "warc_record_id", "warc_ip_address", "warc_payload_digest",
        "http_server", "http_last_modified",
    )
    others = [c for c in parsed.columns if c not in ("page", "items", "entities")]
    return numbered.select(
        *others,
        "page_number",
        F.struct(
            own.alias("@context"),
            F.lit("AnnotationPage").alias("type"),
            F.coalesce(F.when(typed, _text(page, "$.id")), new_id).alias("id"),
            F.lit(collection_id).alias("partOf"),
            date.alias("created"),
            F.struct(
                *[F.lit(generator.get(k)).alias(k) for k in ("id", "type", "name", "homepage")]
            ).alias("generator"),
            date.alias("generated"),
            F.struct(*[F.col(f"{warc}.{n}").alias(n) for n in source]).alias("source"),
            F.transform("items", annotation_struct).alias("items"),
        ).alias("annotation_page"),
        F.when(typed, own_keys).alias("page_keys"),
        F.transform("items", lambda v: F.to_json(v)).alias("items_json"),
    )
