import numpy as np
import pytest

from pageloom.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, cosine=0.93):
    fit = [
        r for r in rows
        if r[0] is not None and r[2] is not None and r[1] and all(x is not None and np.isfinite(x) for x in r[1]) and any(r[1])
    ]
    links = {r[0]: 0 for r in rows}
    root = {r[0]: r[0] for r in rows}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (k, v, label) in enumerate(fit):
        for q, w, other in fit[:i]:
            if label == other and len(v) == len(w):
                x, y = np.array(v, np.float32).astype(float), np.array(w, np.float32).astype(float)
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= cosine:
                    links[k] += 1
                    links[q] += 1
                    a, b = sorted((top(k), top(q)))
                    root[b] = a
    return {k: (links[k], top(k), top(k) == k) for k in links}


@pytest.mark.parametrize("block", [7, 64, 2_048])
def test_random_clusters(spark, block):
    rnd = np.random.default_rng(8)
    rows = []
    for i in range(500):
        size = 8 if i % 50 else 3
        centre = np.random.default_rng(int(rnd.integers(12))).normal(size=size)
        v = centre + rnd.normal(size=size) * rnd.choice([0, 0.1, 0.2, 1])
        rows.append((i, [float(x) for x in v], int(i % 3 == 0)))
    rows += [(1000, None, 0), (1001, [0.0] * 8, 0), (1002, [1.0, None], 0), (1003, [float("nan")] * 8, 0)]
    rows += [(1004, [float("inf")] * 8, 0), (1005, [1.0] * 8, None), (1006, [], 1), (1007, [1.0], 1), (1008, [3.0], 1), (1009, [-1.0], 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5).selectExpr("*", "1 as id", "2 as size")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame, block=block).collect()}
    assert got == brute(rows)


def test_empty_and_repeated(spark):
    assert embedding_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (None, [1.0, 2.0], 0)]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(0, 0, 0, True), (1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False)]


def test_many_labels(spark):
    """Every label begins a block: their numbers must not run into the next partition's."""
    rnd = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rnd.normal(size=2)], i // 3) for i in range(3_000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(frame).collect()}
    expected = {}
    for a in range(0, len(rows), 3):
        expected |= brute(rows[a : a + 3])
    assert got == expected
