"""Annotations and entities: written selection rules, a user model, a dictionary."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.text import annotation_id
from pageloom.functions.words import Matcher, RunHashes, WordAutomaton, filter_bits, may_stand, run_keys
from pageloom.session import shared_table

ANNOTATION_CONTEXT = "http://www.w3.org/ns/anno.jsonld"
MIN_CHARACTERS = 50
SENTENCE_END = r"[.!?]+(\s|$)"
MIN_SENTENCES = 2
COPYRIGHT = r"(?i)\x{a9}|copyright|all rights reserved"
WORD = r"[\p{L}\p{N}]+"


def annotation(
    url: Column, text: Column, xpath: Column, creator: str, language: Column | None = None
) -> Column:
    """An annotation struct whose id is computed from url, text and xpath."""
    return F.struct(
        F.lit(ANNOTATION_CONTEXT).alias("@context"),
        annotation_id(url, text, xpath).alias("id"),
        F.lit("Annotation").alias("type"),
        F.lit("commenting").alias("motivation"),
        F.lit(creator).alias("creator"),
        F.struct(
            F.lit("TextualBody").alias("type"),
            text.alias("value"),
            F.lit("text/plain").alias("format"),
            (F.lit(None).cast("string") if language is None else language).alias("language"),
        ).alias("body"),
        F.struct(
            url.alias("source"),
            F.struct(F.lit("XPathSelector").alias("type"), xpath.alias("value")).alias("selector"),
        ).alias("target"),
    )


def is_substantial(block: Column) -> Column:
    """At least 50 characters and 2 sentences of main-content text."""
    text = block["own_text"]
    return (
        block["tag"].isin("p", "div")
        & ~block["in_nav"]
        & (F.length(text) >= MIN_CHARACTERS)
        & (F.regexp_count(text, F.lit(SENTENCE_END)) >= MIN_SENTENCES)
        & ~text.rlike(COPYRIGHT)
    )


def rule_annotate(
    blocks: DataFrame, url: str = "url", creator: str = "urn:rules:v1"
) -> DataFrame:
    """One row per annotation from pages with ``blocks``; built-in columns, no shuffle."""
    others = [c for c in blocks.columns if c not in ("blocks", "html_error")]
    return (
        blocks.select(*others, F.explode(F.filter("blocks", is_substantial)).alias("_b"))
        .withColumn(
            "annotation",
            annotation(F.col(url), F.col("_b.own_text"), F.col("_b.xpath"), creator),
        )
        .withColumn("pos", F.col("_b.pos"))
        .drop("_b")
    )


def rule_response(blocks: DataFrame, url: str = "url", creator: str = "urn:rules:v1") -> DataFrame:
    """One JSON answer per page in the shape a model gives, from the same rules.

    ``blocks`` becomes ``response``, so the rules can stand where ``infer`` does.
    """
    page = F.struct(
        F.lit(ANNOTATION_CONTEXT).alias("@context"),
        F.lit("AnnotationPage").alias("type"),
        F.transform(
            F.filter("blocks", is_substantial),
            lambda b: annotation(F.col(url), b["own_text"], b["xpath"], creator),
        ).alias("items"),
    )
    answer = F.struct(
        page.alias("annotationPage"),
        F.array().cast("array<struct<name:string,type:string>>").alias("entities"),
    )
    return blocks.withColumn("response", F.to_json(answer)).drop("blocks", "html_error")


def infer(
    df: DataFrame,
    prompt: str,
    build: Callable[[], Callable[[list[str]], Sequence[str | None]]],
    output: str = "response",
    batch_size: int = 64,
) -> DataFrame:
    """Add ``output`` and ``output_error`` by a user's batch function.

    ``build`` runs once per task and returns ``prompts -> answers``. A batch that raises
    is tried again row by row, so one bad prompt costs one row, whose message is kept.
    Rows with a NULL prompt are not asked.
    """
    schema = T.StructType(
        [
            *df.schema.fields,
            T.StructField(output, T.StringType()),
            T.StructField(f"{output}_error", T.StringType()),
        ]
    )

    def one(call, prompt_value):
        try:
            return call([prompt_value])[0], None
        except Exception as problem:
            return None, f"{type(problem).__name__}: {problem}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = build()
        for batch in batches:
            for start in range(0, batch.num_rows, batch_size):
                part = batch.slice(start, batch_size)
                every = part.column(part.schema.get_field_index(prompt)).to_pylist()
                prompts = [p for p in every if p is not None]
                try:
                    answers = list(call(prompts)) if prompts else []
                    if len(answers) != len(prompts):
                        raise ValueError("one answer per prompt is needed")
                    asked = [(a, None) for a in answers]
                except Exception:
                    asked = [one(call, p) for p in prompts]
                found = iter(asked)
                results = [(None, None) if p is None else next(found) for p in every]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([a for a, _ in results], pa.string()),
                        pa.array([e for _, e in results], pa.string()),
                    ],
                    schema.names,
                )

    return df.mapInArrow(run, schema)


def annotate(
    df: DataFrame,
    prompt: str,
    build: Callable[[], Callable[[list[str]], Sequence[str | None]]],
) -> DataFrame:
    """Ask a user's model for the JSON answer of every prompt."""
    return infer(df, prompt, build, "response")


def classify(
    df: DataFrame,
    decide: Column | Callable[[], Callable[[list[str]], Sequence[str | None]]],
    url: str = "url",
) -> DataFrame:
    """Add ``llm_decision`` and ``llm_decision_error``.

    The decision is ``archive`` or ``skip`` from a column rule, or the ``decision`` of a user's
    model that answers URLs with JSON. A call that failed leaves its message in the error.
    """
    if isinstance(decide, Column):
        ruled = df.withColumn("llm_decision", F.when(decide, "archive").otherwise("skip"))
        return ruled.withColumn("llm_decision_error", F.lit(None).cast("string"))
    asked = infer(df, url, decide, "_selection")
    decision = F.try_variant_get(F.try_parse_json("_selection"), "$.decision", "string")
    return asked.withColumn("llm_decision", decision).withColumnRenamed("_selection_error", "llm_decision_error").drop("_selection")


def archived(df: DataFrame) -> DataFrame:
    return df.where(F.col("llm_decision") == "archive")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


# Words of all names together that tasks are sent as one automaton: some 30 MB of arrays and tables.
SHARED_WORDS = 200_000
SHARES = 1_024
# 64-bit cells of the filter for names beyond those: four names a cell, 16 MB at most.
FILTER_CELLS, FILTER_PARTS = 1 << 21, 64
# Words of texts, or one longer text, that a task looks up at once.
FILTER_WORDS = 1 << 18


def dictionary_entities(
    df: DataFrame, dictionary: DataFrame, text: str = "text", max_words: int | None = None, shared_words: int = SHARED_WORDS
) -> DataFrame:
    """Entities of ``dictionary(name, type)`` that occur in ``text``, once per row of ``df``.

    Names match as runs of whole words, whatever the case; names of the same words and type are
    one, under the smallest spelling. ``max_words`` may leave longer names out. ``text`` is not carried along.

    The names' words are counted first. Up to ``shared_words`` of them, of the shortest names, which texts hold most often, are
    sent to the tasks as an automaton over whole words; one pass over each text finds them, without a shuffle. Further
    names are a table that the runs of words of the texts meet in a join, after a filter sent to the tasks has told which
    runs may be names. Both give the same rows.
    """
    split = dictionary.select(words(F.col("name")).alias("_words"), "name", "type").where(F.size("_words") > 0)
    if max_words is not None:
        split = split.where(F.size("_words") <= max_words)
    names = split.groupBy(F.array_join("_words", " ").alias("_run"), "type").agg(F.min("name").alias("name"), F.first(F.size("_words")).alias("_n"))
    names = shared_table(names)
    left = shared_words
    for n, total in sorted(map(tuple, names.groupBy("_n").agg(F.sum("_n")).collect())):
        if total > left:
            # Of the first length that does not fit, as large a share as does.
            fits = F.pmod(F.xxhash64("_run"), F.lit(SHARES)) < left * SHARES // total
            short = (F.col("_n") < n) | ((F.col("_n") == n) & fits)
            return _matched_entities(df, names.where(short), text).unionByName(_joined_entities(df, names.where(~short), text))
        left -= total
    return _matched_entities(df, names, text)


def _matched_entities(df: DataFrame, names: DataFrame, text: str) -> DataFrame:
    """``names`` small enough for one automaton."""
    held: dict[str, list[tuple[str, str]]] = {}
    for row in names.select("_run", "name", "type").collect():
        held.setdefault(row["_run"], []).append((row["name"], row["type"]))
    runs = sorted(held)
    sent = df.sparkSession.sparkContext.broadcast((WordAutomaton([r.split(" ") for r in runs]), [sorted(held[r], key=str) for r in runs]))
    others = [c for c in df.columns if c != text]
    fields = [df.schema[c] for c in others]
    schema = T.StructType([*fields, T.StructField("name", T.StringType()), T.StructField("type", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, entities = sent.value
        matcher = Matcher(automaton)
        for batch in batches:
            at, found = [], []
            for i, line in enumerate(batch.column(len(others)).to_pylist()):
                for n in matcher.found(line.split(" ")) if line else ():
                    for entity in entities[n]:
                        at.append(i)
                        found.append(entity)
            kept = batch.select(list(range(len(others)))).take(pa.array(at, pa.int64()))
            columns = [pa.array([e[k] for e in found], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([*kept.columns, *columns], schema.names)

    lines = df.select(*(F.col(f"`{c}`") for c in others), F.array_join(words(F.col(text)), " ").alias("_line"))
    return lines.mapInArrow(run, schema)


def _run_filter(names: DataFrame, cells: int) -> np.ndarray:
    """A filter that holds all ``_run``s; each of its parts is made by one task."""
    size = cells // FILTER_PARTS

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0)
            n = held.value_lengths().to_numpy()
            keys = run_keys(RunHashes(held.flatten().to_numpy()), np.cumsum(n, dtype=np.int64) - n, n)
            cell, bits = filter_bits(keys, cells)
            yield pa.RecordBatch.from_arrays([pa.array(cell // size, pa.int32()), pa.array(cell % size, pa.int32()), pa.array(bits.view(np.int64))], ["part", "cell", "bits"])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            part, cell, bits = (batch.column(i).to_numpy() for i in range(3))
            for i in np.unique(part).tolist():
                own = part == i
                np.bitwise_or.at(parts.setdefault(i, np.zeros(size, np.int64)), cell[own], bits[own])
        for i, held in parts.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([held.tobytes()], pa.binary())], ["part", "cells"])

    hashed = names.select(F.transform(F.split("_run", " ", -1), lambda w: F.xxhash64(w)))
    found = np.zeros(cells, np.uint64)
    rows = hashed.mapInArrow(keyed, "part int, cell int, bits long").repartition("part").mapInArrow(united, "part int, cells binary")
    for i, held in rows.collect():
        found[i * size : (i + 1) * size] = np.frombuffer(held, np.uint64)
    return found


def _joined_entities(df: DataFrame, names: DataFrame, text: str) -> DataFrame:
    """``names`` of any number.

    A filter holds hashes of all names and of their beginnings, so that a text lists few runs of words besides the
    names in it, each once. These meet the names in an equi-join. The planner broadcasts the
    names when their size allows; otherwise a frequent run is split by the skew-join rule.
    """
    counted = names.groupBy("_n").count().collect()
    cells = FILTER_PARTS
    while cells < FILTER_CELLS and 4 * cells < sum(r["count"] for r in counted):
        cells *= 2
    sent = df.sparkSession.sparkContext.broadcast((_run_filter(names, cells), sorted(r["_n"] for r in counted)))
    others = [c for c in df.columns if c != text]
    schema = T.StructType([*(df.schema[c] for c in others), T.StructField("_run", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, lengths = sent.value
        for batch in batches:
            lists, hashes = batch.column(len(others)), batch.column(len(others) + 1)
            size = hashes.value_lengths().fill_null(0).to_numpy().astype(np.int64)
            part = np.cumsum(size) // FILTER_WORDS
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(size)]
            for first, last in zip(edges[:-1], edges[1:], strict=True):
                own = size[first:last]
                end, row = np.cumsum(own), np.repeat(np.arange(first, last), own)
                at, n = may_stand(held, lengths, hashes.slice(first, last - first).flatten().to_numpy(), end[row - first])
                said = lists.slice(first, last - first).flatten().to_pylist() if len(at) else []
                found = sorted({(i, " ".join(said[a : a + k])) for i, a, k in zip(row[at].tolist(), at.tolist(), n.tolist(), strict=True)})
                kept = batch.select(list(range(len(others)))).take(pa.array([i for i, _ in found], pa.int64()))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array([r for _, r in found], pa.string())], schema.names)

    said = words(F.col(text))
    runs = df.select(*(F.col(f"`{c}`") for c in others), said.alias("_words"), F.transform(said, lambda w: F.xxhash64(w)).alias("_hashes"))
    return runs.mapInArrow(run, schema).join(names.select("_run", "name", "type"), "_run").drop("_run")
