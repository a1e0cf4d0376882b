"""Annotation collections as tables: containers, insert-if-new, load and assemble."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.names import (
    CONTAINER_PREFIX,
    annotation_slug,
    container_slug,
    label_filename,
)
from pageloom.operators.order import group_numbers
from pageloom.operators.responses import STORE_KEYS, payload
from pageloom.session import shared_table

# Fixed values of the annotation store's documents.
CONTAINER_CONTEXT = "http://iiif.io/api/presentation/3/context.json"
DEFAULT_LABEL = "A Container for Web Annotations"
KEYS = ["container_slug", "annotation_slug"]


class Store(NamedTuple):
    """The two tables of an annotation store."""

    containers: DataFrame
    annotations: DataFrame


def container_row(slug: Column, label: Column) -> list[Column]:
    """The columns of a container; a missing label gets the default one."""
    return [
        slug.alias("container_slug"),
        F.lit(CONTAINER_CONTEXT).alias("@context"),
        F.lit("AnnotationCollection").alias("type"),
        F.coalesce(label, F.lit(DEFAULT_LABEL)).alias("label"),
    ]


def run_container(responses: DataFrame, collection_id: str, title: str, prefix: str = CONTAINER_PREFIX) -> DataFrame:
    """The container of a run, named after the first archive file by name."""
    first = F.col("_first")
    return responses.agg(F.min("warc.warc_filename").alias("_first")).select(
        *container_row(
            container_slug(F.lit(collection_id), first, prefix),
            F.concat(F.lit(f"{title} - "), F.coalesce(first, F.lit("Unknown WARC"))),
        )
    )


def to_payload(annotation: Column) -> Column:
    """A typed annotation struct as the JSON that is stored, without the store's keys."""
    return F.to_json(annotation.dropFields(*STORE_KEYS))


def _first_by_key(incoming: DataFrame, seq: tuple[str, ...]) -> DataFrame:
    others = [c for c in incoming.columns if c not in KEYS]
    first = F.min_by(F.struct(*others), F.struct(*seq)).alias("_first")
    repeats = (F.count("*") - 1).alias("_repeats")
    return incoming.groupBy(*KEYS).agg(first, repeats).select(*KEYS, "_first.*", "_repeats")


def upsert_decisions(
    incoming: DataFrame, existing: DataFrame, seq: tuple[str, ...] = ("seq", "pos")
) -> DataFrame:
    """One row per incoming key with ``is_new`` and the number of its ``_repeats``.

    The first row by ``seq`` stands for a key. Repeats are combined before the shuffle,
    and the stored keys meet the incoming ones on the keys they are grouped by already.
    """
    stored = existing.select(*KEYS).distinct().withColumn("_stored", F.lit(True))
    return (
        _first_by_key(incoming, seq)
        .join(stored, KEYS, "left")
        .withColumn("is_new", F.col("_stored").isNull())
        .drop("_stored")
    )


def upsert_annotations(
    incoming: DataFrame, existing: DataFrame, seq: tuple[str, ...] = ("seq", "pos")
) -> DataFrame:
    """The rows to append: one per key that the store has not got."""
    return (
        _first_by_key(incoming, seq)
        .drop("_repeats")
        .join(existing.select(*KEYS), KEYS, "left_anti")
    )


def upsert_counts(decisions: DataFrame) -> DataFrame:
    """Uploaded and skipped annotations; repeats within the batch are skipped ones."""
    return decisions.groupBy("container_slug").agg(
        F.count_if("is_new").alias("annotations_uploaded"),
        (F.count_if(~F.col("is_new")) + F.sum("_repeats")).alias("annotations_skipped"),
    )


def replace_containers(store: Store, created: DataFrame) -> Store:
    """Create containers; one that exists loses its annotations and starts anew."""
    slugs = created.select("container_slug")
    kept = store.containers.join(slugs, "container_slug", "left_anti")
    return Store(
        kept.unionByName(created.dropDuplicates(["container_slug"])),
        store.annotations.join(slugs, "container_slug", "left_anti"),
    )


def delete_container(store: Store, slug: str) -> Store:
    other = F.col("container_slug") != slug
    return Store(store.containers.where(other), store.annotations.where(other))


def container_exists(store: Store, slug: str) -> DataFrame:
    """One row: whether a delete of ``slug`` would find it."""
    return store.containers.agg(
        F.coalesce(F.bool_or(F.col("container_slug") == slug), F.lit(False)).alias("deleted")
    )


def get_container(store: Store, slug: str) -> DataFrame:
    """The container and its annotations, one row each, so that any size can be read.

    A container without annotations gives one row with NULL for them. Slugs are unique, so
    one row is broadcast to the annotations, which stay where they are.
    """
    mine = F.col("container_slug") == slug
    container = store.containers.where(mine).limit(1)
    found = store.annotations.where(mine)
    held = found.join(F.broadcast(container), "container_slug")
    empty = container.join(found.select("container_slug").limit(1), "container_slug", "left_anti")
    return held.unionByName(empty, allowMissingColumns=True)


def collection_items(collections: DataFrame, prefix: str = CONTAINER_PREFIX) -> DataFrame:
    """Every item of nested collections, one row each, with its slugs and a ``reason`` if it cannot be stored.

    ``seq`` is the number of the page in its collection, from 0 and whatever the parts, and
    ``pos`` the place in the page. The reason is ``not_json``, ``no_id``, ``null_id``, or NULL.
    """
    slug = container_slug(F.col("id"), label_filename(F.col("label")), prefix)
    before = F.col("first_page") if "first_page" in collections.columns else F.lit(0)
    reason = (
        F.when(F.col("_item").isNull(), "not_json")
        .when(F.col("_id").isNotNull(), None)
        .when(F.try_variant_get("_item", "$.id", "variant").isNull(), "no_id")
        .otherwise("null_id")
    )
    return (
        collections.select(
            slug.alias("container_slug"), F.coalesce(before, F.lit(0)).cast("long").alias("_before"), F.posexplode("items").alias("_nr", "_page")
        )
        .select("container_slug", (F.col("_before") + F.col("_nr")).alias("seq"), F.posexplode("_page.items").alias("pos", "_json"))
        .withColumn("_item", F.try_parse_json("_json"))
        .withColumn("_id", F.try_variant_get("_item", "$.id", "string"))
        .select(
            "container_slug",
            annotation_slug(F.col("_id")).alias("annotation_slug"),
            payload(F.col("_item")).alias("payload"),
            "seq",
            "pos",
            reason.alias("reason"),
        )
    )


def collection_annotations(collections: DataFrame, prefix: str = CONTAINER_PREFIX) -> DataFrame:
    """The items of nested collections that can be stored, see ``collection_items``."""
    return collection_items(collections, prefix).where("reason is null").drop("reason")


def collection_rejects(collections: DataFrame, prefix: str = CONTAINER_PREFIX) -> DataFrame:
    """The items that cannot: where they stand and why."""
    return collection_items(collections, prefix).where("reason is not null").select("container_slug", "seq", "pos", F.col("reason").alias("error"))


def collection_containers(collections: DataFrame, prefix: str = CONTAINER_PREFIX) -> DataFrame:
    slug = container_slug(F.col("id"), label_filename(F.col("label")), prefix)
    return collections.select(*container_row(slug, F.col("label"))).dropDuplicates(["container_slug"])


def load_collection(
    store: Store,
    collections: DataFrame,
    prefix: str = CONTAINER_PREFIX,
    write_decisions: bool = False,
) -> tuple[Store, DataFrame]:
    """Load nested collections: the store after it and a summary row per container.

    Items that are no JSON or whose id is null count as ``errors``; those without an id are passed over. With ``write_decisions`` the store and the summary read one table of what is new; else
    each works it out.
    """
    created = collection_containers(collections, prefix)
    items = collection_items(collections, prefix)
    if write_decisions:
        items = shared_table(items)
    incoming = items.where("reason is null").drop("reason")
    cleared = replace_containers(store, created)
    decisions = upsert_decisions(incoming, cleared.annotations, ("seq", "pos"))
    if write_decisions:
        decisions = shared_table(decisions)
    inserted = decisions.where("is_new").select(*KEYS, "payload")
    return (
        Store(cleared.containers, cleared.annotations.unionByName(inserted)),
        upload_summary(created, decisions, items.where("reason in ('not_json', 'null_id')").select("container_slug", F.col("reason").alias("error"))),
    )


def upload_summary(containers: DataFrame, decisions: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per container: created, uploaded, skipped and the number of errors.

    ``errors(container_slug, error)`` is a table of its own and only counted here.
    """
    counts = upsert_counts(decisions)
    out = containers.select("container_slug", F.lit(True).alias("container_created")).join(
        counts, "container_slug", "left"
    )
    if errors is None:
        out = out.withColumn("errors", F.lit(0).cast("bigint"))
    else:
        found = errors.groupBy("container_slug").agg(F.count("*").alias("errors"))
        out = out.join(found, "container_slug", "left")
    return out.fillna(0, ["annotations_uploaded", "annotations_skipped", "errors"])


def collection_stats(collections: DataFrame) -> DataFrame:
    """Pages and annotations of every collection, over all its parts."""
    held = F.aggregate("items", F.lit(0), lambda n, page: n + F.coalesce(F.size(page["items"]), F.lit(0)))
    return collections.groupBy("id", "label").agg(
        F.sum(F.size("items")).cast("int").alias("pages"), F.sum(held).cast("int").alias("annotations")
    )


def assemble_collection(
    pages: DataFrame,
    label: Column,
    collection_id: Column,
    seq: str = "seq",
    pages_per_part: int = 10_000,
) -> DataFrame:
    """Nested collection documents from pages with ``page_id`` and ``items ARRAY<STRING>``.

    A collection of many pages comes in several parts with the same id and label, each of
    ``pages_per_part`` pages, so no group grows with the data. ``first_page`` counts the
    collection's pages before the part; what reads the parts gives the same for any size of them.
    """
    page = F.struct(F.col(seq).alias("seq"), F.struct(F.col("page_id").alias("id"), "items").alias("page"))
    named = pages.withColumn("id", collection_id).withColumn("label", label)
    first = F.floor((F.col("_number") - 1) / pages_per_part).cast("long") * pages_per_part
    return (
        named.join(group_numbers(named, "_number", "id", seq), seq)
        .groupBy("id", "label", first.alias("first_page"))
        .agg(F.array_sort(F.collect_list(page)).alias("_pages"))
        .select("id", "label", "first_page", F.transform("_pages", lambda p: p["page"]).alias("items"))
    )
