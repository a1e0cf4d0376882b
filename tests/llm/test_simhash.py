import random
import re

import numpy as np
import pytest
import xxhash

from pageloom.llm import graph, simhash

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute(docs):
    """Fingerprints by counting, components by comparing all pairs."""
    prints = {}
    for key, text in docs:
        words = WORD.findall(re.sub(rb"[A-Z]", lambda m: bytes([m[0][0] + 32]), (text or "").encode()))
        runs = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
        prints[key] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    keys, bits = list(prints), np.array(list(prints.values()), np.uint64)
    return {k: (f"{prints[k]:016x}", c) for k, c in zip(keys, brute_components(keys, bits), strict=True)}


def brute_components(keys, bits, budget=2):
    root = {k: k for k in keys}

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, k in enumerate(keys):
        for j in np.flatnonzero(np.bitwise_count(bits[:i] ^ bits[i]) <= budget):
            a, b = sorted((top(k), top(keys[j])))
            root[b] = a
    return [top(k) for k in keys]


def test_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows += [(100_000, None), (100_001, ""), (100_002, " \n\t"), (100_003, "One"), (100_004, "oNE \x0b"), (100_005, "É é x"), (100_006, "a b c " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as bits", "2 as component_id")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == brute(rows)
    assert len({got[k] for k in (100_000, 100_001, 100_002)}) == 1


@pytest.mark.parametrize("leaf", [2, 40, 10_000])
def test_links_of_crowded_tries(spark, leaf):
    """One cluster holds most fingerprints; subtrees are cut further when they pass the leaf size."""
    rnd = random.Random(5)
    centre, found = rnd.getrandbits(64), set()
    while len(found) < 400:
        x = centre
        for _ in range(rnd.randint(0, 4)):
            x ^= 1 << rnd.randrange(64)
        found.add(x)
    while len(found) < 600:
        found.add(rnd.getrandbits(64))
    bits = np.array(sorted(found), np.uint64)
    frame = spark.createDataFrame([(i, int(b)) for i, b in enumerate(bits.view(np.int64).tolist())], "id long, bits long")
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 2
    expected = {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
    got = [tuple(sorted((r.a, r.b))) for r in simhash.links(frame, leaf=leaf, all_pairs=True).collect()]
    assert len(got) == len(set(got)) and set(got) == expected
    root = {r.node: r.component for r in graph.components(simhash.links(frame, leaf=leaf)).collect()}
    assert [root.get(i, i) for i in range(600)] == brute_components(list(range(600)), bits)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []


def test_repeated_rows_and_null_keys(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (None, "z")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0) for r in simhash.near_duplicates(docs).collect())
    assert got == [(0, 0), (0, 1), (1, 1), (1, 1)]


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(300)] + [(5000, 5000), (7, None)]
    rnd.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 300)}
