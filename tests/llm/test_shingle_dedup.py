import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from pageloom.llm import shingle_dedup
from tests.llm.test_simhash import brute as fingerprints


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(b" ".join(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def brute(rows):
    """Components by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        least[top(i)] = min(key, least.get(top(i), key))
    return [(key, least[top(i)]) for i, (key, _) in enumerate(rows)]


def copies(seed):
    """Texts with a line of their own kind, each with copies that differ ever more, and chains of such."""
    rnd = random.Random(seed)
    line, rows = "this line stands in most of the texts here".split(), []
    for _ in range(12):
        words = [rnd.choice("abcdefghijklmnop") + str(rnd.randrange(60)) for _ in range(rnd.choice([1, 4, 5, 9, 30, 120]))]
        for _ in range(rnd.choice([1, 3, 14])):
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                words[rnd.randrange(len(words))] = "x" + str(rnd.randrange(9))
            rows.append(" ".join([*(line if rnd.random() < 0.7 else []), *words]))
    rnd.shuffle(rows)
    rows = [rnd.choice([t, t.upper()]) for t in rows]
    return list(enumerate([*rows, None, "", " \n", "One", "oNE \x0b"]))


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("cells", [1, 1 << 18])
def test_random_copies(spark, seed, cells):
    rows = copies(seed)
    got = shingle_dedup.near_copies(spark.createDataFrame(rows, "doc_id long, text string"), cells=cells)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows))


@pytest.mark.parametrize(("pivots", "turns"), [(4, 2), (1, 0)])
def test_one_large_group(spark, monkeypatch, pivots, turns):
    """Copies of one text, similar to it but only partly to each other, and texts that hold one of its passages."""
    monkeypatch.setattr(shingle_dedup, "PIVOTS", pivots)
    monkeypatch.setattr(shingle_dedup, "TURNS", turns)
    rnd = random.Random(3)
    words = [f"w{rnd.randrange(5000)}" for _ in range(160)]
    rows = []
    for i in range(250):
        copy = list(words) if i % 3 else [*words[:60], *(f"v{rnd.randrange(5000)}" for _ in range(rnd.choice([5, 15, 100])))]
        for _ in range(rnd.randrange(6)):
            copy[rnd.randrange(len(copy))] = f"x{rnd.randrange(5000)}"
        rows.append((i, " ".join(copy)))
    rows.append((250, " ".join(f"w{rnd.randrange(5000)}" for _ in range(40_000))))
    # Columns named like the operator's own are not read.
    docs = spark.createDataFrame([(i, t, i, "c") for i, t in rows], "doc_id long, text string, node long, shingle string")
    got = shingle_dedup.near_copies(docs, cells=1 << 12)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == sorted(brute(rows))


def test_repeated_rows_and_null_keys(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "z"), (2, "y"), (2, "a B c d")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in shingle_dedup.near_copies(docs).collect())
    assert got == [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (2, 2)]
    assert shingle_dedup.near_copies(docs.limit(0)).collect() == []


def test_parities_and_packing():
    """Parities differ in no more bits than the sets in shingles; packed counts come back."""
    rnd = np.random.default_rng(3)
    every = rnd.integers(0, 1 << 64, 5000, np.uint64, endpoint=False)
    for n in (0, 1, 40, 5000):
        x = np.unique(every[:n])
        for d in (0, 1, 17, n):
            y = np.unique(np.concatenate([x[min(d, n) :], rnd.integers(0, 1 << 64, d, np.uint64, endpoint=False)]))
            bits = int(np.bitwise_count((shingle_dedup._parity(x) ^ shingle_dedup._parity(y)).view(np.uint64)).sum())
            assert bits <= len(np.setxor1d(x, y)) and (d or not bits)
    counts = rnd.integers(0, 1 << 16, 999, np.uint16)
    assert (shingle_dedup._unpacked(shingle_dedup._packed(counts), 999) == counts).all()


def test_crowding_counts_every_text(spark):
    rows = [(i, f"one two three four five {i}") for i in range(30)] + [(99, None), (98, "")]
    texts = spark.createDataFrame(rows, "key long, text string").repartition(5)
    levels = shingle_dedup._crowding(texts.selectExpr("key", "cast(text as binary) text"), 1 << 18)
    shared = next(shingle_dedup.shingle_sets([b"one two three four five"]))[0]
    assert levels[int(shared) & ((1 << 18) - 1)] == int(30**0.5 * shingle_dedup.STEPS) == levels.max()
    assert (levels > 0).sum() == 31


@pytest.mark.parametrize("groups", [2, 40])
def test_groups_of_another_method(spark, groups):
    """What is brought as alike is confirmed, whether it is or not, and the rest is found as ever."""
    rows = copies(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    alike = spark.createDataFrame([(k, k % groups) for k, _ in rows] + [(0, 0), (-1, 0), (1, None)], "mark long, group long")
    got = shingle_dedup.near_copies(docs, cells=1 << 12, mark=F.col("doc_id"), groups=alike)
    assert sorted((r.doc_id, r.component_id) for r in got.collect()) == sorted(brute(rows))


def test_pipeline_stage_asks_simhash(spark, monkeypatch):
    """The groups of the stage are those of op1's operator."""
    brought = []

    def near_copies(docs, groups, **others):
        brought.append(groups.join(docs.select(others["mark"].alias("mark"), "doc_id"), "mark").collect())
        return found(docs, groups=groups, **others)

    found = shingle_dedup.near_copies
    monkeypatch.setattr(shingle_dedup, "near_copies", near_copies)
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null").collect()]
    corpus_pipeline.without_near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    group = {r.doc_id: r.group for r in brought[0]}
    own, expected = {}, {}
    for key, (_, component) in fingerprints(rows).items():
        own.setdefault(group[key], set()).add(key)
        expected.setdefault(component, set()).add(key)
    assert sorted(map(sorted, own.values())) == sorted(map(sorted, expected.values()))
    assert max(map(len, own.values())) > 1


def test_pipeline_stage(spark):
    """Of copies at 0.8 or more one stays, whatever their fingerprints."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text is not null")
    expected = {c for _, c in brute([(r.doc_id, r.text) for r in docs.collect()])}
    kept = [r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()]
    assert sorted(kept) == sorted(expected)


def united(rows):
    """Keys that stay if both the shingles and the fingerprints link."""
    least = {key: c for key, c in brute(rows)}
    alike = {key: c for key, (_, c) in fingerprints(rows).items()}
    name = {key: key for key, _ in rows}
    while True:
        low = {}
        for key in name:
            for group in (("j", least[key]), ("s", alike[key])):
                low[group] = min(name[key], low.get(group, name[key]))
        now = {key: min(low["j", least[key]], low["s", alike[key]]) for key in name}
        if now == name:
            return sorted(set(name.values()))
        name = now


def test_pipeline_stage_takes_what_simhash_links(spark):
    """Texts of one often repeated passage have near fingerprints, while half of their different shingles are their own."""
    rnd = random.Random(14)
    rows = []
    for _ in range(4):
        passage = [f"w{rnd.randrange(5000)}" for _ in range(60)] * 40
        tails = [[f"v{rnd.randrange(5000)}" for _ in range(25)] for _ in range(3)]
        # A copy of each that only its shingles show, so that links of both kinds make chains.
        rows += [" ".join([*passage, *tail * n]) for tail in tails for n in (1, 40)]
        rows.append(" ".join(f"u{rnd.randrange(5000)}" for _ in range(80)))
    rnd.shuffle(rows)
    rows = list(enumerate(rows))
    expected = united(rows)
    assert len(expected) < len({c for _, c in brute(rows)}) and len(expected) < len({c for _, c in fingerprints(rows).values()})
    docs = spark.createDataFrame([*rows, *rows[:9]], "doc_id long, text string").repartition(4)
    got = [r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, docs, "").collect()]
    assert sorted(got) == expected


def test_pipeline_stage_and_rows_without_an_id(spark):
    """Rows without an id stand for no group, and link those that are in one group with them."""
    found = [(1, 10, 1, 10), (2, 20, 2, 20), (3, 30, 3, 30), (4, 40, 4, 40), (4, 41, 4, 40), (None, 50, None, None), (9, 60, 9, 60)]
    alike = [(10, 50), (20, 50), (50, 50), (30, 30), (40, 40), (41, 41), (60, 60), (20, 50)]
    found = spark.createDataFrame(found, "doc_id long, mark long, component_id long, component_mark long")
    alike = spark.createDataFrame(alike, "mark long, group long")
    got = sorted(r.mark for r in corpus_pipeline._outnamed(found, alike).collect())
    assert got == [20]
