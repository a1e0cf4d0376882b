"""Structured Streaming forms of the steps that keep state from row to row.

Seen URLs are keyed state. Inserts and the token counter work per micro-batch against what the batches before
it wrote: the folders of the store that its rows belong to, the counter that the last batch left. A batch that
is run again after a failure gives the same rows once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.streaming.state import GroupState
from pyspark.sql.types import StructType

from pageloom.functions.names import worker_name
from pageloom.operators.tokens import token_batches, token_state
from pageloom.operators.urls import screen_urls
from pageloom.sources.annotation_store import BUCKETS, AnnotationStore


def first_seen_stream(
    stream: DataFrame, url: str = "url", event_time: str | None = None, delay: str = "1 day"
) -> DataFrame:
    """Accepted rows, one per canonical URL, by the state store.

    Which of several copies in a micro-batch stays is open; ``first_seen_ordered`` keeps the
    first. The state grows with the distinct URLs unless ``event_time`` bounds it, where a
    copy later than ``delay`` counts as new.
    """
    passed = screen_urls(stream, url).where("reject_reason is null").drop("reject_reason")
    if event_time is None:
        return passed.dropDuplicates(["canonical_url"])
    return passed.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["canonical_url"])


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def _job(stream: DataFrame, work: Callable[[DataFrame, int], None], checkpoint: str) -> DataStreamWriter:
    return stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)


def first_seen_ordered(stream: DataFrame, url: str = "url", seq: str = "seq") -> DataFrame:
    """Accepted rows: the first by batch and ``seq`` of every canonical URL, all columns kept.

    State keyed by canonical URL says which ones earlier batches had, so a batch costs its own rows. Each
    task first reduces its rows to one per URL, so a URL with a large share of them is a few rows in the keyed step.
    The other columns travel as JSON, which keeps them as they are through Python. A null ``seq`` comes last. The state
    grows with the different URLs: keep it in RocksDB, see ``STATE_SETTINGS``.
    """
    passed = screen_urls(stream, url).where("reject_reason is null").drop("reject_reason")
    others = [f for f in passed.schema if f.name != "canonical_url"]
    rows = passed.select(
        "canonical_url",
        F.coalesce(F.col(seq).cast("bigint"), F.lit((1 << 63) - 1)).alias("at"),
        F.to_json(F.struct(*(F.col(f"`{f.name}`") for f in others)), EXACT).alias("row"),
    )
    schema = "canonical_url string, at bigint, row string"
    firsts = (
        rows.mapInArrow(_least_rows, schema)
        .groupBy("canonical_url")
        .applyInPandasWithState(_first_of_key, schema, "seen boolean", "append", "NoTimeout")
    )
    back = firsts.select("canonical_url", F.from_json("row", StructType(others), EXACT).alias("row"))
    return back.select(*("canonical_url" if c == "canonical_url" else F.col(f"row.`{c}`") for c in passed.columns))


# For sessions that keep much state: it stays on disk, and a batch writes what it changed.
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Times keep their microseconds, nulls their keys.
EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
# Different URLs that a task holds before it sends them on.
HELD_URLS = 10_000


def _least_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per canonical URL out of many, the least by ``at``."""
    held: dict[str, tuple[int, str]] = {}

    def out():
        urls = list(held)
        columns = [urls, [held[u][0] for u in urls], [held[u][1] for u in urls]]
        kinds = (pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["canonical_url", "at", "row"])

    for batch in batches:
        for one, at, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if one not in held or at < held[one][0]:
                held[one] = at, row
        if len(held) >= HELD_URLS:
            yield out()
            held.clear()
    yield out()


def _first_of_key(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    rows = [f.loc[[f["at"].idxmin()]] for f in frames if len(f)]
    if not state.exists and rows:
        state.update((True,))
        every = pd.concat(rows, ignore_index=True)
        yield every.loc[[every["at"].idxmin()]]


def first_seen_job(stream: DataFrame, output: str, checkpoint: str, url: str = "url", seq: str = "seq") -> DataStreamWriter:
    """``first_seen_ordered`` appended to Parquet files."""
    kept = first_seen_ordered(stream, url, seq)
    return kept.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)


def upsert_job(
    stream: DataFrame, store: str, checkpoint: str, seq: tuple[str, ...] = ("seq", "pos"), buckets: int = BUCKETS
) -> DataStreamWriter:
    """Insert annotations whose keys are new in their container into the ``AnnotationStore`` at ``store``.

    A batch opens the containers and buckets that it has rows for; containers that are missing are created. A
    batch that is run again finds its version and writes nothing.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        AnnotationStore(batch.sparkSession, store, buckets).insert(batch, seq, tag=f"{checkpoint} {batch_id}", create_missing=True)

    return _job(stream, work, checkpoint)


def budget_job(
    stream: DataFrame,
    output: str,
    state: str,
    checkpoint: str,
    budget: int,
    seq: str = "seq",
    prompt: str = "prompt_tokens",
    completion: str = "completion_tokens",
    shard: str | None = None,
) -> DataStreamWriter:
    """Token batches with the counter carried from batch to batch and over restarts.

    With ``shard`` each of its values, null too, has a budget and a counter of its own; a batch then leaves one row for every
    shard so far in ``state``, which the next one starts from. Rows are folded in chunks, so a shard may hold most rows.
    """

    def work_sharded(batch: DataFrame, batch_id: int) -> None:
        spark, schema = batch.sparkSession, "shard string, token_count bigint, batch bigint"
        before = spark.read.schema(schema).parquet(f"{state}/batch_id={batch_id - 1}") if batch_id else spark.createDataFrame([], schema)
        args = {"seq": seq, "prompt": prompt, "completion": completion, "shard": shard, "state": before}
        _write_batch(token_batches(batch, budget, **args), output, batch_id)
        after = token_state(batch, budget, **args).withColumnRenamed(shard, "shard")
        idle = before.join(after.select(F.col("shard").alias("moved")), F.col("shard").eqNullSafe(F.col("moved")), "left_anti")
        _write_batch(after.select("shard", "token_count", "batch").unionByName(idle), state, batch_id)

    def work(batch: DataFrame, batch_id: int) -> None:
        schema = "token_count bigint, batch bigint"
        # Every batch leaves one row, so the one before it is all there is to read.
        last = batch.sparkSession.read.schema(schema).parquet(f"{state}/batch_id={batch_id - 1}").first() if batch_id else None
        used, number = last or (0, 0)
        args = (budget, seq, prompt, completion, None, used, number)
        _write_batch(token_batches(batch, *args), output, batch_id)
        after = token_state(batch, *args)
        # A batch without rows leaves the counter as it is.
        if batch.isEmpty():
            after = batch.sparkSession.createDataFrame([(used, number)], schema)
        _write_batch(after, state, batch_id)

    return _job(stream, work_sharded if shard else work, checkpoint)


def entity_stream(stream: DataFrame, output: str, checkpoint: str) -> DataStreamWriter:
    """Append entity lines, a folder per crawl worker."""
    return (
        stream.select("entity", "source")
        .withColumn("worker", worker_name(F.col("source.warc_filename")))
        .writeStream.format("json")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .option("ignoreNullFields", "false")
        .partitionBy("worker")
        .outputMode("append")
    )
