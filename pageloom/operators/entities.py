"""Entity rows: from answers, by type, counts, dedup, sample, worker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.functions.names import worker_name
from pageloom.functions.text import utc_text


def entities(parsed: DataFrame, seq: str = "seq", url: str = "url", warc: str = "warc") -> DataFrame:
    """One row per entity of parsed answers, in the order ``(seq, pos)``.

    An entity keeps name and type only; its source says where it was found.
    """
    name, kind = (F.try_variant_get("_e", f"$.{k}", "string") for k in ("name", "type"))
    return (
        parsed.select(seq, url, warc, F.posexplode("entities").alias("pos", "_e"))
        .select(
            seq,
            "pos",
            F.struct(name.alias("name"), kind.alias("type")).alias("entity"),
            F.struct(
                F.col(url).alias("url"),
                *[F.col(f"{warc}.{n}").alias(n) for n in ("warc_filename", "warc_date", "warc_record_id")],
                utc_text(F.current_timestamp()).alias("extracted_at"),
            ).alias("source"),
        )
    )


def entities_by_type(df: DataFrame, entity_type: str) -> DataFrame:
    return df.where(F.col("entity.type") == entity_type)


def entity_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("entities"))


def entity_type_counts(df: DataFrame) -> DataFrame:
    """Entities per type, sorted; a missing type counts as ``unknown``."""
    kind = F.coalesce(F.col("entity.type"), F.lit("unknown"))
    return df.groupBy(kind.alias("type")).agg(F.count("*").alias("entities")).orderBy("type")


def entity_dedup(df: DataFrame, order: tuple[str, ...] = ("seq", "pos"), sort: bool = False) -> DataFrame:
    """The first entity of every lower-cased name by ``order``; nameless ones are dropped.

    Partial aggregation keeps one row per name and task before the shuffle, so a name that
    holds a large share of the rows costs no more than another.
    """
    name = F.lower("entity.name")
    first = F.min_by(F.struct(*df.columns), F.struct(*order))
    kept = (
        df.where("entity.name <> ''")
        .groupBy(name.alias("_name"))
        .agg(first.alias("_first"))
        .select("_first.*")
    )
    return kept.orderBy(*order) if sort else kept


def entity_sample(df: DataFrame, rows: int = 5, order: tuple[str, ...] = ("seq", "pos")) -> DataFrame:
    """The first entities of a report; the writer never keeps a context, so it is empty."""
    return (
        df.orderBy(*order)
        .limit(rows)
        .select(
            *order,
            F.col("entity.name").alias("name"),
            F.col("entity.type").alias("type"),
            F.substring(F.lit(""), 1, 80).alias("context"),
            F.col("source.url").alias("url"),
        )
    )


def with_worker(df: DataFrame, filename: Column | None = None) -> DataFrame:
    """Add the crawl worker that found an entity."""
    source = F.col("source.warc_filename") if filename is None else filename
    return df.withColumn("worker", worker_name(source))
