import json

from pyspark.sql import functions as F

from pageloom.sources.annotation_store import AnnotationStore
from pageloom.streaming import jobs
from tests.test_tokens import one_pass


def finish(writer):
    writer.trigger(availableNow=True).start().awaitTermination()


def feed(spark, df, path):
    df.coalesce(1).write.mode("append").parquet(str(path))
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def urls(spark, rows):
    return spark.createDataFrame(rows, "seq long, url string, html string")


FIRST = [(3, "http://a.com/x", "h"), (1, "http://www.a.com/x/", "h"), (2, "http://a.com/y", "h")]
SECOND = [(4, "http://a.com/x#f", "h"), (5, "http://a.com/z", "h"), (6, "ftp://a.com", "h")]


def test_state_store_dedup_gives_the_set(spark, tmp_path):
    feed(spark, urls(spark, FIRST), tmp_path / "in")
    stream = feed(spark, urls(spark, SECOND), tmp_path / "in")
    kept = jobs.first_seen_stream(stream).select("canonical_url")
    out = str(tmp_path / "out")
    finish(kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")))
    assert sorted(r[0] for r in spark.read.parquet(out).collect()) == ["http://a.com/x", "http://a.com/y", "http://a.com/z"]


def test_bounded_state_needs_an_event_time(spark, tmp_path):
    df = urls(spark, FIRST).withColumn("at", F.timestamp_seconds("seq"))
    kept = jobs.first_seen_stream(feed(spark, df, tmp_path / "in"), event_time="at")
    out = str(tmp_path / "out")
    finish(kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")))
    assert spark.read.parquet(out).count() == 2


def state_rows(writer):
    """Runs the stream to its end; rows of its keyed state after each batch."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return [p["stateOperators"][0]["numRowsTotal"] for p in (json.loads(p.json) for p in query.recentProgress)]


def test_first_by_batch_and_seq_and_restart(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("out", "ck")]
    for key, value in jobs.STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        assert state_rows(jobs.first_seen_job(feed(spark, urls(spark, FIRST), tmp_path / "in"), *paths))[-1] == 2
        # Later copies, one of them of a smaller seq, and a restart.
        late = [*SECOND, (0, "http://a.com/y/?utm_source=z", "late")]
        assert state_rows(jobs.first_seen_job(feed(spark, urls(spark, late), tmp_path / "in"), *paths))[-1] == 3
    finally:
        for key in jobs.STATE_SETTINGS:
            spark.conf.unset(key)
    assert sorted(r.seq for r in spark.read.parquet(paths[0]).collect()) == [1, 2, 5]


def test_first_seen_keeps_columns_as_they_are(spark, tmp_path):
    """Nested, odd and null values, a clashing name, a null seq, and a URL with nearly all rows."""
    schema = "seq long, url string, at timestamp, warc struct<n:string,k:array<long>>, raw binary, big decimal(30,4), x double, row string"
    rows = spark.range(30_000).selectExpr(
        "id + 5 as seq", "'http://a.com/x' as url", "timestamp_micros(id) as at", "named_struct('n', 'v', 'k', array(id, null)) as warc",
        "cast('b' as binary) as raw", "cast(id as decimal(30,4)) as big", "double('NaN') as x", "'own' as row",
    )
    odd = spark.createDataFrame([(None, "http://a.com/y", None, None, None, None, None, None), ((1 << 60) + 1, "http://a.com/z", None, (None, [1 << 60]), b"\x00\xff", None, None, "")], schema)
    every = rows.unionByName(odd).repartition(4)
    every.write.parquet(str(tmp_path / "in"))
    kept = jobs.first_seen_ordered(spark.readStream.schema(schema).parquet(str(tmp_path / "in")))
    assert [c for c in kept.columns if c != "canonical_url"] == every.columns
    out = str(tmp_path / "out")
    finish(kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "ck")))
    got = spark.read.parquet(out).drop("canonical_url")
    expected = every.where("seq = 5 or seq is null or seq > 100000")
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))


def test_cost_of_a_batch_stays(spark, tmp_path):
    """Twenty batches of new and old URLs: state grows with the URLs, and no batch reads what earlier ones wrote."""
    for i in range(20):
        urls(spark, [(i * 10 + k, f"http://a.com/{i // 2}/{k}", "h") for k in range(10)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("seq long, url string, html string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = jobs.first_seen_job(stream, str(tmp_path / "out"), str(tmp_path / "ck")).trigger(availableNow=True).start()
    query.awaitTermination()
    progress = [json.loads(p.json) for p in query.recentProgress if p.numInputRows]
    assert len(progress) == 20 and {p["numInputRows"] for p in progress} == {10}
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in progress) == 100
    assert {p["stateOperators"][0]["numRowsUpdated"] for p in progress} <= {0, 10}
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


def test_upsert_job_skips_what_is_stored(spark, tmp_path):
    schema = "seq long, pos int, container_slug string, annotation_slug string, payload string"
    rows = [(1, 0, "c", "a", "1"), (2, 0, "c", "a", "2"), (3, 0, "c", "b", "3")]
    store, check = str(tmp_path / "store"), str(tmp_path / "ck")
    finish(jobs.upsert_job(feed(spark, spark.createDataFrame(rows, schema), tmp_path / "in"), store, check))
    later = spark.createDataFrame([(9, 0, "c", "a", "9"), (8, 0, "d", "a", "8")], schema)
    finish(jobs.upsert_job(feed(spark, later, tmp_path / "in"), store, check))
    got = AnnotationStore(spark, store).annotations().collect()
    assert sorted(map(tuple, got)) == [("c", "a", "1"), ("c", "b", "3"), ("d", "a", "8")]


def test_budget_is_carried_over_a_restart(spark, tmp_path):
    rows = [(i, (i * 37) % 90, (i * 11) % 40) for i in range(60)]
    schema = "seq long, prompt_tokens long, completion_tokens long"
    paths = [str(tmp_path / n) for n in ("out", "state", "ck")]
    for part in (rows[:25], rows[25:40], rows[40:]):
        finish(jobs.budget_job(feed(spark, spark.createDataFrame(part, schema), tmp_path / "in"), *paths, 200))
    got = [r.batch for r in spark.read.parquet(paths[0]).orderBy("seq").collect()]
    expected, used, last = one_pass([r[1] for r in rows], [r[2] for r in rows], 200)
    assert got == expected
    state = spark.read.parquet(paths[1]).orderBy(F.desc("batch_id")).first()
    assert (state.token_count, state.batch) == (used, last)


def test_budgets_of_shards_are_carried_over_restarts(spark, tmp_path):
    """Each shard equals one pass over its own rows: one without rows in a part, a null one, one of most rows."""
    name = lambda i: "b" if i < 25 and i % 5 == 0 else None if i % 7 == 0 else "a"
    rows = [(i, (i * 37) % 90, (i * 11) % 40, name(i)) for i in range(60)]
    schema = "seq long, prompt_tokens long, completion_tokens long, who string"
    paths = [str(tmp_path / n) for n in ("out", "state", "ck")]
    for part in (rows[:25], rows[25:40], rows[40:]):
        finish(jobs.budget_job(feed(spark, spark.createDataFrame(part, schema), tmp_path / "in"), *paths, 200, shard="who"))
    got = {r.seq: (r.who, r.batch) for r in spark.read.parquet(paths[0]).collect()}
    state = {r.shard: (r.token_count, r.batch) for r in spark.read.parquet(f"{paths[1]}/batch_id=2").collect()}
    assert len(got) == 60 and set(state) == {"a", "b", None}
    for who in state:
        own = [r for r in rows if r[3] == who]
        expected, used, last = one_pass([r[1] for r in own], [r[2] for r in own], 200)
        assert [got[r[0]] for r in own] == [(who, b) for b in expected]
        assert state[who] == (used, last)


def test_entity_stream_appends_per_worker(spark, tmp_path):
    schema = "entity struct<name:string,type:string>, source struct<url:string,warc_filename:string>"
    df = spark.createDataFrame([(("n", None), ("u", "a-3.warc.gz"))], schema)
    out = tmp_path / "out"
    finish(jobs.entity_stream(feed(spark, df, tmp_path / "in"), str(out), str(tmp_path / "ck")))
    text = next((out / "worker=worker-3").glob("*.json")).read_text()
    assert json.loads(text)["entity"] == {"name": "n", "type": None}
