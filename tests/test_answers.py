import hashlib
import json
import random

import hypothesis
import hypothesis.strategies as st
import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.functions import names as N
from pageloom.functions.words import Matcher, RunHashes, WordAutomaton, filter_bits, may_stand, run_keys
from pageloom.operators import annotate as A
from pageloom.operators import entities as E
from pageloom.operators import responses as R
from pageloom.schemas import PROVENANCE

A0 = {"id": "urn:sha256:ab", "created": "now", "extra": {"deep": [1, None]}, "body": {"value": "v"}}
E0 = {"name": "Ann", "type": "person", "context": "c"}
# answer, shape, annotations, entities
CASES = [
    ({"annotationPage": {"type": "AnnotationPage", "items": [A0]}, "entities": [E0]}, "typed", 1, 1),
    ({"annotationPage": {"type": "AnnotationPage", "id": "own", "@context": "x", "items": [A0, {}]}}, "typed", 2, None),
    ({"annotationPage": {"items": [A0]}, "entities": []}, "untyped", 1, 0),
    ({"annotationPage": {"type": "Other", "items": [A0]}}, "untyped", 1, None),
    ({"annotationPage": [A0, {"type": "Annotation"}], "entities": [E0]}, "list", 2, 1),
    ({"annotationPage": {"type": "AnnotationPage", "items": []}, "entities": [E0]}, "none", None, 1),
    ({"annotationPage": []}, "none", None, None),
    ({"annotationPage": "text", "entities": None}, "none", None, None),
    ({}, "none", None, None),
    ([A0], "malformed", None, None),
    ("{bad", "malformed", None, None),
    (None, "malformed", None, None),
]


@pytest.fixture(scope="module")
def parsed(spark):
    rows = [
        (k, f"http://u/{k}", ("f-1.warc.gz", "2026", f"<r{k}>", None, None, None, None, None, "srv", None),
         answer if isinstance(answer, str) or answer is None else json.dumps(answer))
        for k, (answer, *_) in enumerate(CASES)
    ]
    df = spark.createDataFrame(rows, f"seq long, url string, warc {PROVENANCE.simpleString()}, response string")
    return R.parse_response(df)


def test_shapes(parsed):
    for r in parsed.select("seq", "shape", F.size("items").alias("n"), F.size("entities").alias("e")).collect():
        _, shape, items, entities = CASES[r.seq]
        assert r.shape == shape, CASES[r.seq]
        if items:
            assert r.n == items
        assert r.e == entities


def test_annotations_need_an_id_and_keep_unknown_keys(parsed):
    found = R.annotations(parsed).orderBy("seq", "pos").collect()
    assert [(r.seq, r.pos) for r in found] == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 0)]
    assert json.loads(found[0].payload) == {"extra": {"deep": [1, None]}, "body": {"value": "v"}}
    assert found[0].annotation.id == "urn:sha256:ab" and found[0].annotation.body.value == "v"


def test_pages_are_numbered_over_all_shapes(parsed):
    made = R.annotation_pages(parsed, "urn:c", {"name": "sw"}, rows_per_chunk=2)
    pages = [r.annotation_page for r in made.orderBy("seq").collect()]
    assert [p.id for p in pages] == ["urn:uuid:page-1", "own"] + [f"urn:uuid:page-{n}" for n in (3, 4, 5)]
    assert [p["@context"] for p in pages] == [None, "x"] + [A.ANNOTATION_CONTEXT] * 3
    assert pages[0].partOf == "urn:c" and pages[0].created == pages[0].generated == "2026"
    assert pages[0].source.warc_record_id == "<r0>" and pages[0].generator.name == "sw"


def test_entities_of_any_shape(parsed):
    found = E.entities(parsed).orderBy("seq").collect()
    assert [(r.seq, r.entity.name, r.entity.type) for r in found] == [(k, "Ann", "person") for k in (0, 4, 5)]
    assert found[0].source.warc_filename == "f-1.warc.gz" and found[0].source.extracted_at.endswith("Z")


def entity_frame(spark, names):
    rows = [(k, 0, (n, t), (f"u{k}", None, None, None, None)) for k, (n, t) in enumerate(names)]
    return spark.createDataFrame(
        rows, f"seq long, pos int, entity struct<name:string,type:string>, source {'struct<url:string,warc_filename:string,warc_date:string,warc_record_id:string,extracted_at:string>'}"
    ).repartition(3)


def test_dedup_ignores_case_and_type(spark):
    df = entity_frame(spark, [("Ann", "person"), ("BOB", "artist"), ("ann", "work"), ("", "x"), (None, "x"), ("bob", "y")])
    kept = E.entity_dedup(df, sort=True).collect()
    assert [(r.entity.name, r.entity.type) for r in kept] == [("Ann", "person"), ("BOB", "artist")]


def test_type_reports(spark):
    df = entity_frame(spark, [("a", "work"), ("b", None), ("c", "work"), ("d", "artist")])
    assert [tuple(r) for r in E.entity_type_counts(df).collect()] == [("artist", 1), ("unknown", 1), ("work", 2)]
    assert E.entities_by_type(df, "work").count() == 2
    assert E.entity_total(df).first()[0] == 4
    assert [(r.name, r.context) for r in E.entity_sample(df, 2).collect()] == [("a", ""), ("b", "")]


def test_names(spark):
    files = {"rec-one-20260105185218349-0.warc.gz": "worker-0", "crawl.warc.gz": "crawl", None: "unknown", "a.warc": "a"}
    df = spark.createDataFrame([(k,) for k in files], "f string")
    assert {r.f: r.w for r in df.select("f", N.worker_name(F.col("f")).alias("w")).collect()} == files
    labels = {"X - a.warc.gz": "a.warc.gz", "X - a.warc": None, "a.warc.gz": None, "A - B - c.warc.gz": "c.warc.gz", None: None}
    df = spark.createDataFrame([(k,) for k in labels], "f string")
    assert {r.f: r.w for r in df.select("f", N.label_filename(F.col("f")).alias("w")).collect()} == labels
    sha = hashlib.sha256(b"urn:x").hexdigest()
    df = spark.createDataFrame([("urn:sha256:a:b",), ("urn:x",)], "f string")
    assert [r[0] for r in df.select(N.annotation_slug(F.col("f"))).collect()] == ["a:b", sha]
    slugs = spark.createDataFrame([("urn:x", "a.warc.gz"), ("urn:x", None), ("urn:x", "")], "i string, f string")
    got = slugs.select(N.container_slug(F.col("i"), F.col("f"), "p-")).collect()
    assert [r[0] for r in got] == ["p-a", "p-" + sha[:12], "p-" + sha[:12]]
    one = spark.createDataFrame([("<urn:uuid:1>", "/a/b.gz")], "r string, p string")
    assert tuple(one.select(N.bare_record_id(F.col("r")), N.base_name(F.col("p"))).first()) == ("urn:uuid:1", "b.gz")


def test_infer_keeps_going_after_a_bad_prompt(spark):
    def build():
        def call(prompts):
            if "bad" in prompts:
                raise ValueError("no answer")
            return [p.upper() for p in prompts]

        return call

    df = spark.createDataFrame([("a",), ("bad",), ("c",)], "p string").coalesce(1)
    got = A.infer(df, "p", build).collect()
    assert [(r.response, r.response_error) for r in got] == [("A", None), (None, "ValueError: no answer"), ("C", None)]


def test_classify(spark):
    def build():
        return lambda urls: ['{"decision": "archive"}' if u == "a" else "{oops" for u in urls]

    df = spark.createDataFrame([("a",), ("b",)], "url string")
    assert [r.url for r in A.archived(A.classify(df, build)).collect()] == ["a"]
    assert [r.llm_decision for r in A.classify(df, F.col("url") == "b").collect()] == ["skip", "archive"]


def test_dictionary_against_brute_force(spark):
    texts = ["Ann met Bob Ray. ann again", "bob", "Ray Bob ray", "", None, "x " * 300 + "Bob Ray"]
    names = [("Ann", "person"), ("Bob Ray", "artist"), ("ray bob RAY", "work"), ("x x x", "other")]
    names += [("x x x x x bob ray", "work"), ("met Bob Ray ann again", "other"), ("!?", "other"), ("Ann", "artist")]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    expected = set()
    for k, text in enumerate(texts):
        tokens = (text or "").lower().replace(".", "").split()
        for name, kind in names:
            n = name.lower().split()
            if any(tokens[i : i + len(n)] == n for i in range(len(tokens))):
                expected.add((k, name, kind))
    # By the automaton and by joins.
    for shared in (A.SHARED_WORDS, 0):
        got = A.dictionary_entities(df, spark.createDataFrame(names, "name string, type string"), shared_words=shared)
        assert got.columns == ["k", "name", "type"]
        assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    nothing = spark.createDataFrame([], "name string, type string")
    assert A.dictionary_entities(df, nothing).collect() == []


@pytest.mark.parametrize("shared", [0, 7, 60])
def test_larger_dictionaries(spark, shared):
    """Names in the automaton and in the join together, by all numbers of words, as by one automaton."""
    rnd = random.Random(shared)
    names = [(" ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))), rnd.choice("xy")) for _ in range(60)]
    texts = [(i, " ".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(0, 80)))) for i in range(40)] + [(1, names[0][0]), (2, None), (None, names[1][0])]
    df = spark.createDataFrame(texts, "k int, text string").repartition(3)
    names = spark.createDataFrame(names, "name string, type string")
    plain = sorted(map(str, A.dictionary_entities(df, names).collect()))
    assert len(plain) > 300
    assert sorted(map(str, A.dictionary_entities(df, names, shared_words=shared).collect())) == plain


def test_filter_lists_few_runs_that_are_no_names():
    """Each word begins names of many lengths; before, a text listed a run of every length at every word."""
    rnd = np.random.default_rng(5)
    n = np.tile(np.arange(1, 31), 100)
    at = np.cumsum(n) - n
    names = rnd.integers(0, 50, n.sum()).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    names[at] = np.uint64(7)
    cells = np.zeros(1 << 10, np.uint64)
    cell, bits = filter_bits(run_keys(RunHashes(names), at, n), len(cells))
    np.bitwise_or.at(cells, cell, bits)
    place, many = may_stand(cells, range(1, 31), names, np.repeat(at + n, n))
    found = set(zip(place.tolist(), many.tolist(), strict=True))
    assert set(zip(at.tolist(), n.tolist(), strict=True)) <= found
    other = np.full(30_000, 7, np.uint64) + np.arange(30_000, dtype=np.uint64) % np.uint64(2) * rnd.integers(1 << 40, 1 << 62, 30_000).astype(np.uint64)
    place, many = may_stand(cells, range(2, 31), other, np.full(30_000, 30_000))
    assert len(place) < 3_000


@hypothesis.given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=4).map(tuple), unique=True, max_size=9), st.text("abcd", max_size=30))
def test_word_automaton(runs, text):
    """Overlapping runs, runs inside runs and words that no run has."""
    found = Matcher(WordAutomaton(runs)).found(text)
    assert found == [i for i, run in enumerate(runs) if "".join(run) in text]
