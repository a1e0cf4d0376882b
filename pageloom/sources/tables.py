"""Entity, checkpoint, collection and store tables on disk."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.functions.names import worker_name
from pageloom.schemas import CHECKPOINT, COLLECTION, ENTITY_LINE

# Nulls are written, as the readers of these files expect every key.
JSON_OPTIONS = {"ignoreNullFields": "false"}


def read_entities(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Entity lines of one or more files or folders; a line that is not JSON fails.

    Blank lines are skipped. ``worker`` comes from the folder name where there is one.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(ENTITY_LINE).option("mode", "FAILFAST").json(paths)


def write_entities(entities: DataFrame, path: str, mode: str = "append") -> None:
    """Append entity lines, a folder per crawl worker."""
    (
        entities.select("entity", "source")
        .withColumn("worker", worker_name(F.col("source.warc_filename")))
        .write.partitionBy("worker")
        .mode(mode)
        .options(**JSON_OPTIONS)
        .json(path)
    )


class RunLog:
    """The manifest of the runs below a folder: a row for every step that a run has behind it.

    A run is ``begun``, then its ``records`` are whole, then it is ``done``. Each row is a file of its own, written when all
    of the step's files stand. Records, entities and token counters are in places of their own for every run and
    count only once the run is done, so what a stopped run left behind is never read. Runs follow one another.
    """

    BEGUN, RECORDS, DONE = "begun", "records", "done"

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.path = spark, f"{folder.rstrip('/')}/runs"
        try:
            rows = spark.read.schema("run string, number int, step string").json(self.path).collect()
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            rows = []
        self.known = bool(rows)
        self.numbers = {r.run: r.number for r in rows}
        self._steps: dict[str, set[str]] = {}
        for r in rows:
            self._steps.setdefault(r.run, set()).add(r.step)

    def begin(self) -> str:
        """A new run."""
        run = uuid.uuid4().hex
        self.numbers[run] = max(self.numbers.values(), default=0) + 1
        self.mark(run, self.BEGUN)
        return run

    def mark(self, run: str, step: str) -> None:
        row = self.spark.createDataFrame([(run, self.numbers[run], step)], "run string, number int, step string")
        row.coalesce(1).write.mode("append").json(self.path)
        self._steps.setdefault(run, set()).add(step)

    def done(self) -> list[str]:
        """Runs that count, in their order."""
        return sorted((r for r, steps in self._steps.items() if self.DONE in steps), key=self.numbers.__getitem__)

    def unfinished(self) -> list[str]:
        """Runs whose records are whole, but not what is made of them."""
        return sorted((r for r, steps in self._steps.items() if self.RECORDS in steps and self.DONE not in steps), key=self.numbers.__getitem__)


def read_run_entities(spark: SparkSession, folder: str) -> DataFrame:
    """Entity lines of the runs below ``folder`` that are done."""
    base = f"{folder.rstrip('/')}/entities"
    paths = [f"{base}/run={r}" for r in RunLog(spark, folder).done()]
    if not paths:
        return spark.createDataFrame([], ENTITY_LINE)
    return spark.read.schema(ENTITY_LINE).option("mode", "FAILFAST").option("basePath", base).json(paths).select(*ENTITY_LINE.fieldNames())


def append_checkpoint(records: DataFrame, path: str, run: str) -> None:
    """Append what a run did: the records by ``status``, ``done`` or ``failed``, and what failed in ``error``.

    Parquet, so that a restart reads the URLs alone, and one write of the wide rows.
    """
    status = F.when(F.col("error").isNull(), "done").otherwise("failed")
    out = records.select("*", status.alias("status"), F.lit(run).alias("run"))
    out.write.partitionBy("status", "run").mode("append").parquet(path)


def read_checkpoint(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """Records of done URLs, of one run or of all."""
    rows = _checkpoint(spark, path, run).where("status = 'done'")
    return rows.select(*CHECKPOINT.fieldNames())


def read_failures(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """``url`` and ``error`` of pages whose model call failed; they are not done and are tried again."""
    return _checkpoint(spark, path, run).where("status = 'failed'").select("url", "error")


def _checkpoint(spark: SparkSession, path: str, run: str | None) -> DataFrame:
    kinds = T.StructType([*CHECKPOINT.fields, *(T.StructField(n, T.StringType()) for n in ("error", "status", "run"))])
    rows = spark.read.schema(kinds).parquet(path)
    if run is not None:
        return rows.where(F.col("run") == run)
    # Only runs that are done count; ``run`` is a folder, so the others are not opened.
    log = RunLog(spark, path.rstrip("/").rpartition("/")[0])
    return rows.where(F.col("run").isin(log.done())) if log.known else rows


def write_checkpoint_lines(records: DataFrame, path: str) -> None:
    """Checkpoint records as JSON lines, for exchange."""
    records.to(CHECKPOINT).write.mode("append").options(**JSON_OPTIONS).json(path)


def read_checkpoint_lines(spark: SparkSession, path: str) -> DataFrame:
    """Checkpoint records of JSON lines; a line that is not JSON is left out, so its URL is worked on again."""
    return spark.read.schema(CHECKPOINT).option("mode", "DROPMALFORMED").json(path)


def finalise(spark: SparkSession, checkpoint: str, output: str) -> None:
    """Checkpoint JSON lines to Parquet, replacing what is there; a line that is not JSON fails."""
    spark.read.schema(CHECKPOINT).option("mode", "FAILFAST").json(checkpoint).write.mode("overwrite").parquet(output)


def read_collection(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Collection documents; annotations stay JSON text, so no key is lost.

    A document over many lines is one task's work. ``multi_line=False`` reads documents
    written by ``write_collection``, one part per line, in parallel.
    """
    schema = COLLECTION
    if not multi_line:
        schema = T.StructType([*COLLECTION.fields, T.StructField("part", T.IntegerType())])
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def write_collection(collections: DataFrame, path: str) -> None:
    """Collection parts as JSON lines with the annotations nested in them."""
    pages = F.transform(
        "items",
        lambda p: F.struct(
            p["id"].alias("id"), F.transform(p["items"], lambda a: F.parse_json(a)).alias("items")
        ),
    )
    collections.withColumn("items", pages).write.options(**JSON_OPTIONS).json(path)


def save_state(state: DataFrame, path: str) -> None:
    """The token counters of a run, a row per shard."""
    state.write.mode("overwrite").json(path)


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """``shard``, ``token_count`` and ``batch`` of every shard, for ``token_batches``; empty for a new run.

    Without shards it is one row, whose shard is the empty string.
    """
    schema = "shard string, token_count bigint, batch bigint"
    try:
        return spark.read.schema(schema).json(path).fillna({"shard": ""})
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], schema)


def append_annotations(inserted: DataFrame, path: str) -> None:
    """Append to the annotation table, a folder per container."""
    inserted.write.partitionBy("container_slug").mode("append").parquet(path)
