"""Session settings and the shared folder that tables between stages go to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Whole HTML pages travel to the Python workers: bound a batch by bytes, not rows alone.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16m",
}

# A task that writes or reads whole texts holds a row group of them.
ROW_GROUP_BYTES = 32 << 20

# Bytes of a batch to a Python worker and rows of one from a file. A session's own bounds are 64 MB or 10,000 rows and
# 4,096 rows, of which several copies stand in a task's JVM and its worker while they grow.
BATCH_BYTES = 4 << 20
READ_ROWS = 512


def local_session(cores: int | str = 8, **extra: str) -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("pageloom")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(cores),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may fall back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="pageloom-")
    return qualified(spark, f"{root.rstrip('/')}/pageloom/{uuid.uuid4().hex}")


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the file system that Spark takes it to be on."""
    context = spark.sparkContext
    found = context._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(context._jsc.hadoopConfiguration())
    return found.makeQualified(files.getUri(), files.getWorkingDirectory()).toString()


def shared_table(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage with files that outlive any executor, and gives the planner the
    true size, so a later join broadcasts it only below ``autoBroadcastJoinThreshold``.
    """
    path = shared_folder(df.sparkSession)
    df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables between the steps of a job, which go once what was made of them is written."""

    def __init__(self):
        self._paths: list[tuple[SparkSession, str]] = []

    def table(self, df: DataFrame) -> DataFrame:
        """As ``shared_table``; nothing may read it after ``drop``."""
        path = shared_folder(df.sparkSession)
        self._paths.append((df.sparkSession, path))
        df.write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        for spark, path in self._paths:
            context = spark.sparkContext
            found = context._jvm.org.apache.hadoop.fs.Path(path)
            found.getFileSystem(context._jsc.hadoopConfiguration()).delete(found, True)
        self._paths.clear()


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session, where it does not bound them closer, for steps on whole texts and blocks of them.

    Plans take the bounds that hold when they run, so they stay for what the caller does with a result.
    """
    to_bytes = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    bounds = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, "spark.sql.parquet.columnarReaderBatchSize": READ_ROWS}
    for name, most in bounds.items():
        if to_bytes(spark.conf.get(name)) > most:
            spark.conf.set(name, str(most))


def spread(table: DataFrame) -> DataFrame:
    """A table scan with at least as many partitions as there are cores.

    A few small files make few tasks, which starves the costly per-row steps. With enough
    files or row groups, as on a cluster, the scan is left alone and nothing is shuffled.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores) if table.rdd.getNumPartitions() < cores else table
