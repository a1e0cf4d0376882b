"""A training corpus from ``documents``: what is readable, not repeated and not in the benchmark, as token ids."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pageloom.llm import decontamination, language_id, sentencepiece_bpe, shingle_dedup, simhash, suffix_array_dedup
from pageloom.llm.graph import components
from pageloom.session import Scratch, shared_table, small_batches

# The stages' decisions rest on learned and hashed text that SQL cannot follow.
ORACLE_SQL = None
# Units that an encoder remembers: the executors still hold memory of the stages before.
MEMO_UNITS = 20_000


def _row() -> Column:
    """Tells rows of one ``doc_id`` but different texts apart; repeated rows are one."""
    return F.xxhash64("doc_id", "text")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(_row().alias("row"), "text")


def _without(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``docs`` without the ``row``s. Written first, so that the planner knows if they are few."""
    gone = shared_table(rows.select(F.col("row").alias("_row")).distinct())
    return docs.join(gone, _row() == F.col("_row"), "left_anti")


Step = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(step: Step) -> Step:
    """The step in a session whose batches are small: executors live through all stages, and keep what the largest one took."""

    @wraps(step)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return step(spark, docs, sf_dir)

    return bounded


@_stage
def readable(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter, or without an id, go.

    The languages are learned from the documents that are not held out, as in ``op8_language_id``.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    found = language_id.predict(_rows(docs), language_id.learned(docs.where(~held_out)), key="row")
    return _without(docs.where("doc_id is not null"), found.where(F.col("lang_pred") == language_id.UNKNOWN))


def _outnamed(found: DataFrame, alike: DataFrame) -> DataFrame:
    """``mark`` of the rows that name a component of ``found`` while ``alike`` links it to one of a smaller name.

    Components are linked if rows of both are in one ``group`` of ``alike``, directly or over others.
    """
    scratch = Scratch()
    named = found.where("component_mark is not null").select("mark", "component_id", "component_mark").distinct()
    held = scratch.table(named.join(alike.distinct(), "mark").select("group", "component_id", "component_mark").distinct())
    several = held.groupBy("group").agg(F.min("component_mark").alias("low"), F.max("component_mark").alias("high")).where("low < high")
    held = scratch.table(held.join(several.select("group"), "group"))
    # A group is named by one of its rows, so rows and groups are nodes of one kind.
    joined = components(held.select(F.col("component_mark").alias("a"), F.col("group").alias("b")))
    name = F.struct("component_id", "component_mark").alias("name")
    names = held.select("component_mark", name).distinct().join(joined, F.col("component_mark") == F.col("node"), "left")
    names = names.select("name", F.coalesce("component", "component_mark").alias("c"))
    least = names.groupBy("c").agg(F.min("name").alias("least"))
    out = shared_table(names.join(least, "c").where("name <> least").select(F.col("name.component_mark").alias("mark")))
    scratch.drop()
    return out


@_stage
def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id, once.

    Texts are linked that SimHash links, as in ``op1_simhash``, and those whose sets of five-word shingles have a
    Jaccard similarity of 0.8 or more, however far apart their fingerprints are.
    """
    alike = simhash.near_duplicates(_rows(docs), key="row").select(F.col("row").alias("mark"), F.col("component_id").alias("group"))
    alike = shared_table(alike)
    found = shingle_dedup.near_copies(docs.select("doc_id", "text"), mark=_row(), groups=alike)
    gone = found.where("doc_id <> component_id or mark <> component_mark").select("mark").unionByName(_outnamed(found, alike))
    kept = _without(docs, gone.select(F.col("mark").alias("row")))
    repeated = shared_table(found.groupBy(F.col("mark").alias("_again")).count().where("count > 1").select("_again"))
    if repeated.isEmpty():
        return kept
    same = _row() == F.col("_again")
    once = kept.join(repeated, same, "left_semi").dropDuplicates(["doc_id", "text"])
    return kept.join(repeated, same, "left_anti").unionByName(once)


# Times keep their microseconds.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _without_broken(text: Column) -> Column:
    """The text without bytes that are no character; a U+FFFD that it holds stays, as it is spelt otherwise meanwhile."""
    spelt = F.replace(F.replace(text, F.lit("\x01"), F.lit("\x01a")), F.lit("\ufffd"), F.lit("\x01b"))
    valid = F.replace(F.make_valid_utf8(spelt), F.lit("\ufffd"), F.lit(""))
    return F.replace(F.replace(valid, F.lit("\x01b"), F.lit("\ufffd")), F.lit("\x01a"), F.lit("\x01"))


@_stage
def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that a document before them holds; a character cut apart goes whole.

    Documents of which no letter is left go.
    """
    others = [f for f in docs.schema if f.name not in ("doc_id", "text", "n_chars")]
    packed = F.to_json(F.struct(*(F.col(f"`{f.name}`") for f in others)), EXACT) if others else F.lit("{}")
    rows = docs.select("doc_id", "text", packed.alias("others"))
    cut = suffix_array_dedup.without_repeats(rows, extra="others")
    kept = F.col("kept").cast("string")
    text = F.when(F.col("n_removed") == 0, kept).otherwise(_without_broken(kept))
    out = cut.select("doc_id", text.alias("text"), F.from_json("extra", StructType(others), EXACT).alias("o"))
    own = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    out = out.select(*(own.get(c, F.col(f"o.`{c}`")).alias(c) for c in docs.columns))
    return out.where(F.col("text").rlike(language_id.HAS_LETTER))


@_stage
def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with no benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, decontamination.leaks(_rows(docs), benchmark, key="row"))


@_stage
def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and the digest of the text they decode to."""
    import public_tokenizers

    coded = sentencepiece_bpe.encode_decode(docs, public_tokenizers.path("piece_bpe_32k.model"), memo_units=MEMO_UNITS)
    return coded.select(
        "doc_id", "ids", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")
    )


STAGES = [
    ("language_id", readable),
    ("simhash_near_dedup", without_near_duplicates),
    ("suffix_array_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("sentencepiece", encoded),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir))
    return docs
