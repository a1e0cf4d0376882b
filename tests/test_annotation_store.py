"""The annotation store on disk: what readers see before, during and after each write."""

import pytest
from pyspark.sql import functions as F

from pageloom.operators.store import container_row
from pageloom.sources.annotation_store import AnnotationStore

ROWS = "seq long, pos int, container_slug string, annotation_slug string, payload string"


def containers(spark, *slugs, label="l"):
    return spark.createDataFrame([(s,) for s in slugs], "s string").select(*container_row(F.col("s"), F.lit(label)))


def rows(spark, *found):
    return spark.createDataFrame([(n, 0, c, a, f"{a}{n}") for n, c, a in found], ROWS)


def seen(store):
    return (
        sorted((r.container_slug, r.label) for r in store.containers().collect()),
        sorted((r.container_slug, r.annotation_slug, r.payload) for r in store.annotations().collect()),
    )


def decided(decisions):
    return {(r.container_slug, r.annotation_slug): (r.is_new, r._repeats) for r in decisions.collect()}


def test_create_insert_replace_delete(spark, tmp_path):
    store = AnnotationStore(spark, str(tmp_path / "s"), buckets=4)
    assert seen(store) == ([], []) and not store.delete("c")
    store.create(containers(spark, "c", "d", "c"))
    got = decided(store.insert(rows(spark, (2, "c", "a"), (1, "c", "a"), (3, "d", "a"), (4, "none", "a"))))
    assert got == {("c", "a"): (True, 1), ("d", "a"): (True, 0)}
    assert seen(store) == ([("c", "l"), ("d", "l")], [("c", "a", "a1"), ("d", "a", "a3")])
    assert decided(store.insert(rows(spark, (9, "c", "a"), (9, "c", "b")))) == {("c", "a"): (False, 0), ("c", "b"): (True, 0)}
    # A container created again starts anew, and takes a key again that it had before.
    store.create(containers(spark, "c", label="anew"))
    assert seen(store) == ([("c", "anew"), ("d", "l")], [("d", "a", "a3")])
    assert decided(store.insert(rows(spark, (7, "c", "a")))) == {("c", "a"): (True, 0)}
    assert store.delete("d") and not store.delete("d")
    assert seen(store) == ([("c", "anew")], [("c", "a", "a7")])


class Stop(Exception):
    pass


@pytest.mark.parametrize("write", ["create", "insert", "delete"])
def test_stop_before_the_version_stands(spark, tmp_path, monkeypatch, write):
    store = AnnotationStore(spark, str(tmp_path / "s"), buckets=2)
    store.create(containers(spark, "c", "d"))
    store.insert(rows(spark, (1, "c", "a"), (1, "d", "a")))
    before = seen(store)

    def act():
        if write == "create":
            store.create(containers(spark, "c", label="anew"))
        elif write == "insert":
            store.insert(rows(spark, (2, "c", "a"), (2, "c", "b")))
        else:
            store.delete("c")

    def stop(*args):
        raise Stop

    with monkeypatch.context() as patch:
        patch.setattr(AnnotationStore, "_commit", stop)
        with pytest.raises(Stop):
            act()
    assert seen(AnnotationStore(spark, str(tmp_path / "s"), buckets=2)) == before
    act()
    assert seen(store) == {
        "create": ([("c", "anew"), ("d", "l")], [("d", "a", "a1")]),
        "insert": (before[0], [("c", "a", "a1"), ("c", "b", "b2"), ("d", "a", "a1")]),
        "delete": ([("d", "l")], [("d", "a", "a1")]),
    }[write]


def test_tags_and_missing_containers(spark, tmp_path):
    store = AnnotationStore(spark, str(tmp_path / "s"))
    found = rows(spark, (1, "c", "a"), (1, None, "a"))
    store.insert(found, tag="0", create_missing=True)
    once = seen(store)
    assert [c for c, _ in once[0]] == ["c"] and once[1] == [("c", "a", "a1")]
    assert decided(store.insert(rows(spark, (1, "c", "a"), (1, "e", "x")), tag="0", create_missing=True)) == {("c", "a"): (False, 0)}
    assert seen(store) == once


def test_an_insert_opens_the_folders_it_touches(spark, tmp_path):
    store = AnnotationStore(spark, str(tmp_path / "s"), buckets=8)
    store.create(containers(spark, "c", "d"))
    store.insert(rows(spark, *((n, c, f"a{n}") for n in range(40) for c in "cd")))
    every = len(store._written(store._versions()).inputFiles())
    assert every == 16
    generation = store._containers(store._versions()).where("container_slug = 'c'").first().generation
    wanted = spark.createDataFrame([(generation, 3)], "generation string, bucket int")
    keys = store.stored_keys(wanted)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    opened = {r[0] for r in keys.select(F.input_file_name()).distinct().collect()}
    assert len(opened) == 1 and all(f"generation={generation}/bucket=3/" in f for f in opened)
    nothing = wanted.limit(0)
    assert store.stored_keys(nothing).collect() == []
