"""Containers and annotations on disk: create, replace, delete, insert if new.

A container has a generation, and its annotations lie in folders by generation, bucket of the key and batch:

    versions/                     a JSON row per version, written last
    containers/<snapshot>/        the containers of a version with their generations
    annotations/generation=/bucket=/batch=/

Readers take the last version: its snapshot of the containers, and the annotations of their generations from batches that
have a version. So they see a store as it was before a write or after it, and files of a write that was stopped are never
read. To replace a container is to give it a new generation, to delete it to leave it out; neither touches an annotation.
An insert opens the keys of the containers and buckets that it brings rows for. One writer at a time.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageloom.operators.store import KEYS, Store, container_row, upsert_decisions
from pageloom.session import shared_table

BUCKETS = 32
# Folders named in a filter; an insert that touches more reads the keys of all.
NAMED_FOLDERS = 5_000
CONTAINER = "container_slug string, `@context` string, type string, label string, generation string"
ANNOTATION = "container_slug string, annotation_slug string, payload string, generation string, bucket int, batch string"
VERSION = "number int, batch string, tag string, snapshot string"


class AnnotationStore:
    """The store below ``path``; ``buckets`` is fixed with its first write."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets

    def _versions(self) -> list[T.Row]:
        try:
            return sorted(self.spark.read.schema(VERSION).json(f"{self.path}/versions").collect(), key=lambda r: r.number)
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def _commit(self, versions: list[T.Row], batch: str, tag: str | None, snapshot: str) -> None:
        number = versions[-1].number + 1 if versions else 1
        row = self.spark.createDataFrame([(number, batch, tag, snapshot)], VERSION)
        row.coalesce(1).write.mode("append").json(f"{self.path}/versions")

    def _containers(self, versions: list[T.Row]) -> DataFrame:
        if not versions:
            return self.spark.createDataFrame([], CONTAINER)
        return self.spark.read.schema(CONTAINER).parquet(f"{self.path}/containers/{versions[-1].snapshot}")

    def _snapshot(self, containers: DataFrame) -> str:
        name = uuid.uuid4().hex
        containers.write.parquet(f"{self.path}/containers/{name}")
        return name

    def _written(self, versions: list[T.Row]) -> DataFrame:
        """Rows of all batches that have a version, of old generations too."""
        try:
            found = self.spark.read.schema(ANNOTATION).parquet(f"{self.path}/annotations")
        except AnalysisException as problem:
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            found = self.spark.createDataFrame([], ANNOTATION)
        return found.where(F.col("batch").isin([v.batch for v in versions]))

    def containers(self) -> DataFrame:
        return self._containers(self._versions()).drop("generation")

    def annotations(self) -> DataFrame:
        versions = self._versions()
        now = self._containers(versions).select("container_slug", "generation")
        return self._written(versions).join(now, ["container_slug", "generation"], "left_semi").select(*KEYS, "payload")

    def store(self) -> Store:
        """The two tables, for the operators on them."""
        return Store(self.containers(), self.annotations())

    def create(self, created: DataFrame) -> None:
        """Create containers, each once; one that exists is replaced and loses its annotations."""
        versions = self._versions()
        new = created.select("container_slug", "@context", "type", "label").dropDuplicates(["container_slug"])
        new = shared_table(new.withColumn("generation", F.uuid()))
        kept = self._containers(versions).join(new.select("container_slug"), "container_slug", "left_anti")
        self._commit(versions, uuid.uuid4().hex, None, self._snapshot(kept.unionByName(new)))

    def delete(self, slug: str) -> bool:
        """Delete a container with its annotations; whether there was one."""
        versions = self._versions()
        now = self._containers(versions)
        if now.where(F.col("container_slug") == slug).isEmpty():
            return False
        self._commit(versions, uuid.uuid4().hex, None, self._snapshot(now.where(F.col("container_slug") != slug)))
        return True

    def stored_keys(self, wanted: DataFrame) -> DataFrame:
        """Keys in the folders that ``wanted(generation, bucket)`` names; others are not opened."""
        return self._stored_keys(self._versions(), wanted)

    def _stored_keys(self, versions: list[T.Row], wanted: DataFrame) -> DataFrame:
        written = self._written(versions)
        folders = wanted.select("generation", "bucket").distinct().limit(NAMED_FOLDERS + 1).collect()
        if len(folders) <= NAMED_FOLDERS:
            by_bucket: dict[int, list[str]] = {}
            for f in folders:
                by_bucket.setdefault(f.bucket, []).append(f.generation)
            named = F.lit(False)
            for bucket, generations in sorted(by_bucket.items()):
                named |= (F.col("bucket") == bucket) & F.col("generation").isin(sorted(generations))
            written = written.where(named)
        return written.select(*KEYS, "generation")

    def insert(
        self, incoming: DataFrame, seq: tuple[str, ...] = ("seq", "pos"), tag: str | None = None, create_missing: bool = False
    ) -> DataFrame:
        """Insert annotations whose keys their containers have not got; the decision on every key that came.

        The first row by ``seq`` stands for a key. Rows of a container that the store has not got are left out, or with
        ``create_missing`` create it. A write whose ``tag`` has a version already does nothing: its rows are no longer new.
        """
        versions = self._versions()
        over = tag is not None and any(v.tag == tag for v in versions)
        now = self._containers(versions)
        rows = shared_table(incoming)
        snapshot = versions[-1].snapshot if versions else None
        if create_missing and not over or snapshot is None:
            missing = rows.select("container_slug").where("container_slug is not null").distinct() if create_missing else rows.select("container_slug").limit(0)
            missing = missing.join(now.select("container_slug"), "container_slug", "left_anti")
            made = missing.select(*container_row(F.col("container_slug"), F.lit(None).cast("string"))).withColumn("generation", F.uuid())
            made = shared_table(made)
            if snapshot is None or not made.isEmpty():
                now = shared_table(now.unionByName(made))
                snapshot = self._snapshot(now)
        bucket = F.pmod(F.xxhash64(*KEYS), F.lit(self.buckets)).cast("int")
        placed = rows.join(now.select("container_slug", "generation"), "container_slug").withColumn("bucket", bucket)
        placed = shared_table(placed)
        # Keys of a generation that was replaced meanwhile do not count.
        current = placed.select("container_slug", "generation").distinct()
        stored = self._stored_keys(versions, placed).join(current, ["container_slug", "generation"], "left_semi")
        decisions = shared_table(upsert_decisions(placed, stored, seq))
        if not over:
            batch = uuid.uuid4().hex
            new = decisions.where("is_new").select(*KEYS, "payload", "generation", "bucket").withColumn("batch", F.lit(batch))
            # A file for each folder, however many tasks decided.
            new.repartition("generation", "bucket").write.partitionBy("generation", "bucket", "batch").mode("append").parquet(f"{self.path}/annotations")
            self._commit(versions, batch, tag, snapshot)
        return decisions.drop("generation", "bucket")
