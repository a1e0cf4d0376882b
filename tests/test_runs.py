import json

import pytest
from pyspark.sql import functions as F

from pageloom.operators import store as S
from pageloom.operators.summary import observed
from pageloom.plans import runs
from pageloom.schemas import PROVENANCE
from pageloom.sources.tables import RunLog, load_state, read_checkpoint, read_entities, read_run_entities

TEXT = "A bridge joins two banks of a river. It carries a road or a path over it."
URLS = ["http://a.com/x", "http://www.a.com/x/", "http://a.com/y", "http://a.com/login", "http://a.com/z"]


@pytest.fixture
def pages(spark):
    warc = ("f-1.warc.gz", "2026", "<r>") + (None,) * 7
    rows = [(k, u, f"<p>{TEXT} Page {k}.</p>" if "z" not in u else "<p>short", warc) for k, u in enumerate(URLS)]
    return spark.createDataFrame(rows, f"seq long, url string, html string, warc {PROVENANCE.simpleString()}")


def empty_store(spark):
    return S.Store(
        spark.createDataFrame([], "container_slug string, `@context` string, type string, label string"),
        spark.createDataFrame([], "container_slug string, annotation_slug string, payload string"),
    )


def model():
    def call(prompts):
        out = []
        for p in prompts:
            url = p.split("\n")[0]
            if url.endswith("/y"):
                out.append("{broken")
                continue
            item = {"id": "urn:m:1", "body": {"value": p.split("\n")[2]}}
            out.append(json.dumps({"annotationPage": [item], "entities": [{"name": "N", "type": "work"}]}))
        return out

    return call


def test_annotate_crawl_by_rules(spark, pages):
    result = runs.annotate_crawl(pages, empty_store(spark), "urn:c", "T")
    assert result.summary.first().asDict() == {
        "urls": 5, "pages_with_annotations": 2, "malformed_responses": 0, "entities": 0,
        "annotations_uploaded": 2, "annotations_skipped": 0,
    }
    assert [r.container_slug for r in result.store.containers.collect()] == ["crawl-f-1"]
    payloads = [json.loads(r.payload) for r in result.store.annotations.collect()]
    assert {p["target"]["source"] for p in payloads} == {URLS[0], URLS[2]}
    assert all("id" not in p for p in payloads)


def test_annotate_crawl_by_model(spark, pages):
    result = runs.annotate_crawl(pages, empty_store(spark), "urn:c", "T", model)
    summary = result.summary.first()
    assert (summary.pages_with_annotations, summary.malformed_responses, summary.entities) == (2, 1, 2)
    assert (summary.annotations_uploaded, summary.annotations_skipped) == (1, 1)
    assert {r.source.url for r in result.entities.collect()} == {URLS[0], URLS[4]}


@pytest.mark.parametrize("answer", [None, model])
def test_resume_crawl(spark, pages, tmp_path, answer):
    folder = str(tmp_path / "ck")
    choose = F.col("url") != URLS[4]
    first = runs.resume_crawl(spark, pages.where("seq in (1, 3)"), folder, choose, answer)
    assert first.records.count() == 2
    second = runs.resume_crawl(spark, pages, folder, choose, answer)
    got = {r.url: r for r in second.records.collect()}
    assert set(got) == {URLS[0], URLS[2], URLS[4]}
    assert not got[URLS[0]].heuristic_decision and got[URLS[0]].html
    assert got[URLS[2]].processed_html.startswith(URLS[2] + "\n\n<p>A bridge") and got[URLS[2]].generated_annotation
    assert got[URLS[4]].llm_decision == "skip" and got[URLS[4]].processed_html is None
    assert runs.resume_crawl(spark, pages, folder, choose, answer).records.count() == 0
    assert read_checkpoint(spark, f"{folder}/records").count() == 5
    assert second.failures.count() == 0


def failing():
    def call(prompts):
        raise ValueError("down")

    return call


@pytest.mark.parametrize("url_model", [False, True])
def test_failed_pages_are_tried_again(spark, pages, tmp_path, url_model):
    folder, choose = str(tmp_path / "ck"), F.lit(True)
    down = failing if url_model else choose
    first = runs.resume_crawl(spark, pages, folder, down, failing)
    accepted = {URLS[0], URLS[2], URLS[4]}
    assert {(r.url, r.error) for r in first.failures.collect()} == {(u, "ValueError: down") for u in accepted}
    assert {r.url for r in first.records.collect()} == {URLS[1], URLS[3]}
    second = runs.resume_crawl(spark, pages, folder, choose, model)
    assert {r.url for r in second.records.collect()} == accepted
    assert {r.source.url for r in second.entities.collect()} == {URLS[0], URLS[4]}
    lines = read_run_entities(spark, folder)
    assert {r.source.url for r in lines.collect()} == {URLS[0], URLS[4]}
    assert runs.resume_crawl(spark, pages, folder, choose, model).records.count() == 0


def test_token_counter_goes_on(spark, pages, tmp_path):
    """Pages in three runs get the batches that one run gives them."""
    one = runs.resume_crawl(spark, pages, str(tmp_path / "one"), F.lit(True), model, budget=60)
    folder, parts = str(tmp_path / "three"), []
    for seq in ("seq <= 1", "seq in (2, 3)", "seq = 4"):
        parts += runs.resume_crawl(spark, pages.where(seq), folder, F.lit(True), model, budget=60).batches.collect()
    assert sorted(tuple(r) for r in parts) == sorted(tuple(r) for r in one.batches.collect())
    assert max(r.batch for r in parts) > 0


class Stop(Exception):
    pass


def outcome(spark, folder):
    """Entity lines, URLs with a record and the counter of all runs that are done."""
    lines = [(r.entity.name, r.source.url) for r in read_run_entities(spark, folder).collect()]
    records = [r.url for r in read_checkpoint(spark, f"{folder}/records").collect()]
    last = load_state(spark, f"{folder}/state/run={RunLog(spark, folder).done()[-1]}")
    return sorted(lines), sorted(records), [tuple(r) for r in last.collect()]


@pytest.fixture(scope="module")
def unstopped():
    return {}


@pytest.mark.parametrize("point", ["after append_checkpoint", "after mark records", "before save_state", "after write_entities", "after mark done"])
def test_stop_between_writes(spark, pages, tmp_path, monkeypatch, unstopped, point):
    """A run stopped between any two of its writes: the next one ends where runs without a stop do."""
    when, name = point.split(" ", 1)
    folder, asked = str(tmp_path / "ck"), tmp_path / "asked"

    def counted():
        def call(prompts):
            with asked.open("a") as out:
                out.writelines(p.split("\n")[0] + "\n" for p in prompts)
            return model()(prompts)

        return call

    def stopping(real, mine=lambda *args: True):
        def write(*args, **kwargs):
            if not mine(*args):
                return real(*args, **kwargs)
            if when == "after":
                real(*args, **kwargs)
            raise Stop

        return write

    first, choose = pages.where("seq <= 2"), F.lit(True)
    with monkeypatch.context() as patch:
        if name.startswith("mark"):
            patch.setattr(runs.RunLog, "mark", stopping(runs.RunLog.mark, lambda log, run, step: step == name.split()[1]))
        else:
            patch.setattr(runs, name, stopping(getattr(runs, name)))
        with pytest.raises(Stop):
            runs.resume_crawl(spark, first, folder, choose, counted, budget=60)
    # Nothing of the stopped run counts, unless only its return was lost.
    assert read_checkpoint(spark, f"{folder}/records").count() == (3 if point == "after mark done" else 0)
    runs.resume_crawl(spark, pages, folder, choose, counted, budget=60)
    if not unstopped:
        whole = str(tmp_path / "whole")
        runs.resume_crawl(spark, first, whole, choose, model, budget=60)
        runs.resume_crawl(spark, pages, whole, choose, model, budget=60)
        unstopped["outcome"] = outcome(spark, whole)
    assert outcome(spark, folder) == unstopped["outcome"]
    # Records that are whole are not asked for again.
    prompts = asked.read_text().split()
    assert (len(prompts) > len(set(prompts))) == (point == "after append_checkpoint")


def test_pages_are_scanned_once(spark, pages, tmp_path):
    pages.write.parquet(str(tmp_path / "pages"))
    table = spark.read.parquet(str(tmp_path / "pages"))
    scans = []
    real = runs.append_checkpoint
    try:
        runs.append_checkpoint = lambda kept, *rest: (scans.append(kept._jdf.queryExecution().executedPlan().toString()), real(kept, *rest))
        runs.resume_crawl(spark, table, str(tmp_path / "ck"), F.lit(True), model)
    finally:
        runs.append_checkpoint = real
    assert scans[0].count("html:string,") == 1


def test_run_that_lasts(spark, pages, tmp_path):
    result = runs.annotate_crawl(pages, empty_store(spark), "urn:c", "T", failing, str(tmp_path / "out"))
    assert result.failures.count() == 3 and result.summary.first().malformed_responses == 0
    runs.annotate_crawl(pages, empty_store(spark), "urn:c", "T", model, str(tmp_path / "out"))
    stored = spark.read.parquet(str(tmp_path / "out" / "annotations"))
    assert [r.container_slug for r in stored.collect()] == ["crawl-f-1"]
    assert read_entities(spark, str(tmp_path / "out" / "entities" / "worker=*")).count() == 2


def test_page_annotations(spark, pages):
    found = runs.page_annotations(pages).collect()
    assert sorted(r.seq for r in found) == [0, 2]


def test_ingest_then_annotate(spark, tmp_path):
    from workload.archives import gzip_member, page_records

    data = b"".join(page_records(k, u, f"<p>{TEXT} Page {k}.") for k, u in enumerate(URLS))
    (tmp_path / "rec-2.warc.gz").write_bytes(gzip_member(b"WARC/1.0\r\nWARC-Type: warcinfo\r\n\r\n\r\n") + data)
    table = runs.ingest(spark, str(tmp_path), str(tmp_path / "table"))
    assert table.count() == 5
    result = runs.annotate_crawl(table, empty_store(spark), "urn:c", "T")
    assert result.summary.first().annotations_uploaded == 3
    assert [r.container_slug for r in result.store.containers.collect()] == ["crawl-rec-2"]


def test_observed_counters(spark):
    from pyspark.sql import Observation

    seen = Observation("n")
    df = spark.range(7).observe(seen, F.count("*").alias("rows"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7}
    assert observed(spark.range(3), "m").count() == 3
