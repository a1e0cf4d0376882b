import json
import random
import tracemalloc

import numpy as np
import pytest

from pageloom.llm import repeats as repeat_steps
from pageloom.llm import substring_dedup, suffix_array_dedup


def brute_words(rows, window=20):
    seen, out = {}, {}
    for key, text in sorted(rows):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            else:
                seen[run] = key
        out[key] = result(gone, lambda keep, words=words: b" ".join(w for w, k in zip(words, keep) if k))
    return out


def brute_bytes(rows, window=50):
    first, out = {}, {}
    for key, text in sorted(rows):
        raw = (text or "").encode()
        for i in range(len(raw) - window + 1):
            first.setdefault(raw[i : i + window], key)
    for key, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - window + 1):
            if first[raw[i : i + window]] < key:
                gone[i : i + window] = True
        out[key] = result(gone.tolist(), lambda keep, raw=raw: bytes(b for b, k in zip(raw, keep) if k))
    return out


def result(gone, kept):
    spans = sum(g and not p for g, p in zip(gone, [False, *gone]))
    return len(gone), sum(gone), spans, kept([not g for g in gone])


def hard_cases(rows):
    rnd = random.Random(3)
    texts = [t for _, t in rows]
    made = [None, "", "a", "ab " * 30, "ab " * 400, "x" * 49, "x" * 50, "x" * 3_000, "é" * 200, "a b c d e " * 100]
    made += [t for t in made if t]
    for _ in range(60):
        parts = []
        for _ in range(rnd.randint(1, 5)):
            t = rnd.choice(texts)
            a = rnd.randrange(len(t))
            parts.append(t[a : a + rnd.randint(1, 600)])
        made.append(" ".join(parts))
    return rows + [(100_000 + i, t) for i, t in enumerate(made)]


OPERATORS = [(substring_dedup, brute_words), (suffix_array_dedup, brute_bytes)]


@pytest.mark.parametrize(("operator", "brute"), OPERATORS)
@pytest.mark.parametrize(("hot", "size"), [(2_000, 4 << 20), (1, 20_000), (3, 100_000)])
def test_documents(spark, operator, brute, hot, size):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    rows = hard_cases(rows)
    random.Random(9).shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).selectExpr("*", "1 as block", "2 as key", "3 as kept")
    got = {r[0]: (r[1], r[2], r[3], bytes(r[4])) for r in operator.without_repeats(docs, hot=hot, block_bytes=size).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("operator", [substring_dedup, suffix_array_dedup])
def test_empty_and_keyless(spark, operator):
    schema = "doc_id long, text string"
    assert operator.without_repeats(spark.createDataFrame([], schema)).collect() == []
    text = " ".join(f"word{i}" for i in range(40))
    docs = spark.createDataFrame([(None, text), (1, text), (1, text), (2, None), (None, None)], schema)
    got = sorted((r.doc_id or 0, r.n_removed > 0) for r in operator.without_repeats(docs).collect())
    assert got == [(0, False), (0, True), (1, False), (1, False), (2, False)]


def test_long_text(spark):
    rnd = random.Random(1)
    text = " ".join(str(rnd.randrange(1 << 40)) for _ in range(150_000))
    docs = spark.createDataFrame([(1, text), (2, "q " + text[5_000:])], "doc_id long, text string")
    for operator in (substring_dedup, suffix_array_dedup):
        first, second = sorted(operator.without_repeats(docs).collect())
        assert first.n_removed == 0
        assert second.n_tokens - second.n_removed <= 3


def _alone(rows, shards=1):
    """The steps of one block in this process, where all anchors are taken to stand elsewhere, and the most memory of the last two."""
    repeats = repeat_steps.Repeats(50, 18, False, suffix_array_dedup.earlier(50))
    texts = [t for _, t in rows]
    block = repeat_steps.Block(
        repeat_steps.packed([
            np.array([k for k, _ in rows], "<i8"), np.zeros(len(rows), bool), np.array([len(t) for t in texts], "<i8"),
            b"".join(texts), json.dumps([None] * len(rows)).encode(),
        ]),
        False,
    )
    start, count, values, place, _, _ = repeats._values(block, shards)
    first, *passages = repeats._sent(0, block, np.zeros(len(rows), bool), start, count, values[place], np.ones(len(place), np.uint8), shards)
    tracemalloc.start()
    judged = list(repeats._shard(passages))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.reset_peak()
    held = tracemalloc.get_traced_memory()[0]
    out = list(repeats._cut(block, [first, *judged]))
    most = most, tracemalloc.get_traced_memory()[1] - held
    tracemalloc.stop()
    return {r["key"]: (r["n_tokens"], r["n_removed"], r["n_spans"], r["kept"]) for b in out for r in b.to_pylist()}, most


def test_portions(monkeypatch):
    """Passages judged, and windows laid over texts, few at a time give the same results."""
    monkeypatch.setattr(repeat_steps, "PORTION", 300)
    monkeypatch.setattr(repeat_steps, "WINDOWS", 70)
    rows = [(i, t or "") for i, t in enumerate(t for _, t in hard_cases([(0, "one text of some words " * 9), (1, "another of other words " * 40)]))]
    assert _alone([(k, t.encode()) for k, t in rows])[0] == brute_bytes(rows)


def test_memory_of_a_block():
    """A block of 2 MB takes a few times its bytes, whatever of it is repeated."""
    rnd = random.Random(4)
    texts = [" ".join(str(rnd.randrange(1 << 20)) for _ in range(300)).encode() for _ in range(500)]
    got, (shard, cut) = _alone(list(enumerate(texts + texts)))
    assert all(got[i][1] == 0 and got[i + 500][1] == len(t) for i, t in enumerate(texts))
    assert shard < 60e6
    assert cut < 60e6
