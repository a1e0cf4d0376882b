"""How much of a table the pipeline's stages hold at once."""

import pyarrow as pa
import pytest

import corpus_pipeline
from pageloom.session import BATCH_BYTES, READ_ROWS, small_batches

BYTES, ROWS = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.parquet.columnarReaderBatchSize"
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@pytest.fixture
def bounds(spark):
    """Spark's own bounds, as a cluster's session has them."""
    before = {name: spark.conf.get(name) for name in (BYTES, ROWS, RECORDS)}
    for name in before:
        spark.conf.unset(name)
    spark.conf.set(BYTES, "64m")
    spark.conf.set(RECORDS, "10000")
    yield spark.conf
    for name, value in before.items():
        spark.conf.set(name, value)


def _nothing(spark, docs, sf_dir):
    return docs


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=[k for k, _ in corpus_pipeline.STAGES])
def test_stages_bound_batches(spark, bounds, stage):
    docs = spark.createDataFrame([(1, "some words of a text", "en")], "doc_id long, text string, lang string")
    stage(spark, docs, "/root/testdata/sf0.001")
    assert (int(bounds.get(BYTES)), int(bounds.get(ROWS))) == (BATCH_BYTES, READ_ROWS)


def test_a_worker_gets_few_megabytes_at_once(spark, bounds):
    """4,000 texts of 8 KB in one partition came as one batch of 32 MB."""

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64()), pa.array([batch.nbytes], pa.int64())], ["rows", "bytes"])

    docs = spark.range(0, 4000, 1, 1).selectExpr("id AS doc_id", "repeat('some words of a text ', 400) AS text")
    got = corpus_pipeline._stage(_nothing)(spark, docs, "").mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 4000
    assert max(r.bytes for r in got) <= BATCH_BYTES + (1 << 20)


def test_closer_bounds_stay(spark, bounds):
    bounds.set(BYTES, "1m")
    bounds.set(ROWS, "100")
    small_batches(spark)
    assert (bounds.get(BYTES), bounds.get(ROWS)) == ("1m", "100")
