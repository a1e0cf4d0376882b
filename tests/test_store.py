import json

import pytest
from pyspark.sql import functions as F

from pageloom.operators import checkpoint as K
from pageloom.operators import store as S
from pageloom.schemas import CHECKPOINT
from pageloom.sources import tables

COLUMNS = "seq long, pos int, container_slug string, annotation_slug string, payload string"


def incoming(spark, rows):
    return spark.createDataFrame([(k, 0, c, a, p) for k, (c, a, p) in enumerate(rows)], COLUMNS).repartition(3)


def stored(spark, rows=()):
    return spark.createDataFrame(list(rows), "container_slug string, annotation_slug string, payload string")


def containers(spark, *slugs):
    return spark.createDataFrame([(s,) for s in slugs], "s string").select(*S.container_row(F.col("s"), F.lit(None)))


def test_upsert_takes_the_first_new_one(spark):
    rows = [("c", "a", "1"), ("c", "a", "2"), ("c", "b", "3"), ("d", "a", "4"), ("d", "z", "5")]
    new, old = incoming(spark, rows), stored(spark, [("c", "b", "old")])
    found = S.upsert_annotations(new, old)
    assert sorted((r.container_slug, r.annotation_slug, r.payload) for r in found.collect()) == [
        ("c", "a", "1"), ("d", "a", "4"), ("d", "z", "5"),
    ]
    counts = S.upsert_counts(S.upsert_decisions(new, old)).orderBy("container_slug").collect()
    assert [tuple(r) for r in counts] == [("c", 1, 2), ("d", 2, 0)]


def test_upsert_twice_inserts_nothing(spark):
    new = incoming(spark, [("c", "a", "1"), ("c", "b", "2")])
    first = S.upsert_annotations(new, stored(spark))
    assert S.upsert_annotations(new, first).count() == 0


def test_hot_slug(spark):
    rows = spark.range(9000).select(
        F.col("id").alias("seq"), F.lit(0).alias("pos"), F.lit("c").alias("container_slug"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("annotation_slug"),
        F.col("id").cast("string").alias("payload"),
    )
    found = S.upsert_annotations(rows, stored(spark))
    assert found.count() == 6001
    assert found.where("annotation_slug = 'hot'").first().payload == "0"


def test_containers(spark):
    store = S.Store(containers(spark, "a", "b"), stored(spark, [("a", "1", "p"), ("b", "2", "p")]))
    again = S.replace_containers(store, containers(spark, "a", "n"))
    assert sorted(r.container_slug for r in again.containers.collect()) == ["a", "b", "n"]
    assert [r.container_slug for r in again.annotations.collect()] == ["b"]
    gone = S.delete_container(store, "a")
    assert gone.containers.count() == gone.annotations.count() == 1
    assert S.container_exists(store, "a").first()[0] and not S.container_exists(store, "x").first()[0]
    rows = S.get_container(again, "n").collect()
    assert len(rows) == 1 and rows[0].payload is None and rows[0].label == S.DEFAULT_LABEL


def collection(spark, tmp_path):
    items = [{"id": "urn:sha256:h1", "body": {"value": "é"}}, {"body": {}}, {"id": "x", "k": [1]}]
    doc = {"id": "urn:c", "label": "L - f.warc.gz", "items": [{"id": "p1", "items": items}, {"id": "p2", "items": items[:1]}, {"id": "p3", "items": []}]}
    path = tmp_path / "c.json"
    path.write_text(json.dumps(doc, indent=1))
    return tables.read_collection(spark, str(path))


def test_load_collection(spark, tmp_path):
    docs = collection(spark, tmp_path)
    stats = S.collection_stats(docs).first()
    assert (stats.pages, stats.annotations) == (3, 4)
    before = S.Store(containers(spark, "crawl-f", "o"), stored(spark, [("crawl-f", "h1", "old"), ("o", "h1", "keep")]))
    store, summary = S.load_collection(before, docs)
    assert summary.collect() == [("crawl-f", True, 2, 1, 0)]
    got = {(r.container_slug, r.annotation_slug): r.payload for r in store.annotations.collect()}
    assert len(got) == 3 and got[("crawl-f", "h1")] == '{"body":{"value":"é"}}' and got[("o", "h1")] == "keep"


@pytest.mark.parametrize("per_part", [2, 100])
def test_assembled_parts_hold_all_pages_once(spark, tmp_path, per_part):
    pages = spark.range(9).select(
        F.col("id").alias("seq"), F.concat(F.lit("p"), "id").alias("page_id"),
        F.array(F.concat(F.lit('{"id":"urn:sha256:'), "id", F.lit('","n":null}'))).alias("items"),
    )
    made = S.assemble_collection(pages, F.lit("L - f.warc.gz"), F.lit("urn:c"), pages_per_part=per_part)
    assert made.count() == -(-9 // per_part) and made.agg(F.max(F.size("items"))).first()[0] <= per_part + 1
    tables.write_collection(made, str(tmp_path / "out"))
    store, summary = S.load_collection(S.Store(containers(spark), stored(spark)), tables.read_collection(spark, str(tmp_path / "out"), False))
    assert summary.first().annotations_uploaded == 9
    assert {r.payload for r in store.annotations.collect()} == {'{"n":null}'}
    stats = S.collection_stats(made).collect()
    assert [tuple(r) for r in stats] == [("urn:c", "L - f.warc.gz", 9, 9)]
    assert sorted(r.seq for r in S.collection_annotations(made).collect()) == list(range(9))


def test_entity_files(spark, tmp_path):
    line = {"entity": {"name": "é", "type": None}, "source": {"url": "u", "warc_filename": "a-1.warc.gz"}}
    path = tmp_path / "worker-1_entities.jsonl"
    path.write_text(json.dumps(line) + "\n\n" + json.dumps(line) + "\n")
    read = tables.read_entities(spark, str(tmp_path / "worker-*_entities.jsonl"))
    assert read.count() == 2
    out = str(tmp_path / "out")
    tables.write_entities(read, out)
    tables.write_entities(read, out)
    assert tables.read_entities(spark, f"{out}/worker=worker-1").count() == 4
    text = next((tmp_path / "out" / "worker=worker-1").glob("*.json")).read_text()
    assert json.loads(text.splitlines()[0])["entity"] == {"name": "é", "type": None} and "é" in text
    path.write_text("{oops\n")
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        tables.read_entities(spark, str(path)).collect()


def test_checkpoint_lines(spark, tmp_path):
    folder = tmp_path / "ck"
    folder.mkdir()
    (folder / "a.json").write_text('{"url": "u1", "html": "h"}\n{"html": "no url"}\n{"url": "u1"}\n')
    row = spark.createDataFrame([("u2", "h", True, "archive", "t", "g")], CHECKPOINT)
    tables.write_checkpoint_lines(row, str(folder))
    tables.finalise(spark, str(folder), str(tmp_path / "final"))
    assert spark.read.parquet(str(tmp_path / "final")).schema == CHECKPOINT
    (folder / "b.json").write_text("{oops\n")
    read = tables.read_checkpoint_lines(spark, str(folder))
    assert sorted(r.url for r in K.processed_urls(read).collect()) == ["u1", "u2"]
    with pytest.raises(Exception, match="MALFORMED|Malformed|malformed"):
        tables.finalise(spark, str(folder), str(tmp_path / "bad"))


def test_checkpoint_by_status(spark, tmp_path):
    folder = str(tmp_path / "ck")
    rows = [("u1", "h", True, "archive", "t", "g", None), ("u2", "h", True, None, None, None, "broken")]
    records = spark.createDataFrame(rows, f"{CHECKPOINT.simpleString()[7:-1].replace(':', ' ')}, error string")
    for run in ("one", "two"):
        tables.append_checkpoint(records, folder, run)
    assert [r.url for r in tables.read_checkpoint(spark, folder).collect()] == ["u1", "u1"]
    assert [tuple(r) for r in tables.read_failures(spark, folder, "two").collect()] == [("u2", "broken")]
    plan = tables.read_checkpoint(spark, folder).select("url")._jdf.queryExecution().toString()
    assert "ReadSchema: struct<url:string>" in plan


def test_state_file(spark, tmp_path):
    path = str(tmp_path / "state")
    assert tables.load_state(spark, path).collect() == []
    tables.save_state(spark.createDataFrame([("a", 17, 2), ("b", 5, 0)], "shard string, token_count long, batch long"), path)
    assert sorted(tuple(r) for r in tables.load_state(spark, path).collect()) == [("a", 17, 2), ("b", 5, 0)]
    tables.save_state(spark.createDataFrame([(17, 2)], "token_count long, batch long"), path)
    assert [tuple(r) for r in tables.load_state(spark, path).collect()] == [("", 17, 2)]


def test_resume(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://www.a.com/x/"), (3, "http://a.com/y")], "seq long, url string")
    done = spark.createDataFrame([("http://a.com/x",)], "url string")
    assert K.unprocessed(pages, done).count() == 2
    strict = {r.seq: r.reject_reason for r in K.resume_decision(pages, done).collect()}
    assert strict == {2: "duplicate", 3: None}
    compat = {r.seq: r.reject_reason for r in K.resume_decision(pages, done, compat=True).collect()}
    assert compat == {2: None, 3: None}
    known = spark.createDataFrame([("http://a.com/x", False)], "url string, accepted boolean")
    again = {r.seq: r.reject_reason for r in K.resume_decision(pages, known).collect()}
    assert again == {2: None, 3: None}


def test_checkpoint_records(spark):
    df = spark.createDataFrame(
        [("u1", "h", True, "archive", "t", "g"), ("u2", "h", True, "skip", "t", "g"), ("u3", "h", False, "archive", "t", "g")], CHECKPOINT
    )
    got = {r.url: tuple(r)[2:] for r in K.checkpoint_records(df).collect()}
    assert got == {"u1": (True, "archive", "t", "g"), "u2": (True, "skip", None, None), "u3": (False, None, None, None)}
