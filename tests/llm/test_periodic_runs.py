"""Periodic runs against a search of all stretches and periods."""

import hashlib
import random
import zlib

import hypothesis
import hypothesis.strategies as st
import numpy as np

from pageloom.llm import periodic_runs as periodic
from pageloom.llm import queries

SF = "/root/testdata/sf0.001"


def brute(words):
    """Every maximal stretch of every period that has no smaller one."""
    n, found = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                part = words[i : j + q]
                least = next(p for p in range(1, q + 1) if part[p:] == part[:-p])
                if len(part) >= max(6, 4 * q) and least == q:
                    found.append((i, len(part), q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def dropped(n, found):
    return {i for a, length, q in found for i in range(a + q, a + length)}


def found_in(texts):
    joined = [w for t in texts for w in t]
    names = {w: i for i, w in enumerate(sorted(set(joined)))}
    return periodic.runs(np.array([names[w] for w in joined], np.int64), [len(t) for t in texts])


@hypothesis.settings(max_examples=300, deadline=None)
@hypothesis.given(st.lists(st.tuples(st.lists(st.sampled_from("ab"), max_size=9), st.integers(0, 9)), max_size=6))
def test_runs_of_powers(parts):
    text = [w for unit, times in parts for w in unit * times]
    other = text[::-1]
    assert found_in([text, other, [], text]) == [brute(text), brute(other), [], brute(text)]


def test_runs_of_long_periods():
    rnd = random.Random(3)
    texts = []
    for period in (1, 2, 3, 5, 7, 16, 17, 31, 33, 40):
        # Units of which parts repeat, so that grams recur inside a period.
        unit = [rnd.choice("abc") for _ in range(max(1, period // 2))]
        unit = (unit * 3)[:period - 1] + ["z"]
        for length in (4 * period - 1, 4 * period, 4 * period + 1, 9 * period + 3):
            texts.append([rnd.choice("ab") for _ in range(7)] + (unit * 12)[:length] + [rnd.choice("ab") for _ in range(7)])
    assert found_in(texts) == [brute(t) for t in texts]


def test_one_word_and_square_free():
    n = 200_000
    assert found_in([["a"] * n]) == [[(0, n, 1)]]
    # Thue's words hold no run of two periods.
    word = "a"
    while len(word) < 20_000:
        word = "".join({"a": "abc", "b": "ac", "c": "b"}[x] for x in word)
    assert found_in([list(word)]) == [[]]


def planted_brute(key, words):
    h = zlib.crc32(str(key).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_query_against_brute_force(spark):
    """All columns of the query over whole documents of the smallest tables."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert got.keys() == texts.keys()
    some = 0
    for key, text in texts.items():
        words = planted_brute(key, (text or "").encode().split())
        if len(words) > 3_000:
            continue
        found, r = brute(words), got[key]
        lines = "".join(f"{a},{n},{q}\n" for a, n, q in found)
        gone = dropped(len(words), found)
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert (r.n_runs, r.runs_sha256) == (len(found), hashlib.sha256(lines.encode()).hexdigest())
        assert r.collapsed_sha256 == hashlib.sha256(kept).hexdigest()
        best = None
        for a, n, q in found:
            if best is None or n * best[2] > best[1] * q:
                best = a, n, q
        assert (r.start, r.length, r.period) == (best or (None, None, None))
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        some += len(found)
    assert some > 10


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (2, ""), (3, " \x0b\x0c "), (None, "a b " * 4), (4, "a\x1cb " * 6), (5, "é ü\n" * 50_000), (5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "2 as runs", "3 as n_words", "4 as collapsed")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.strongest and tuple(r.strongest), bytes(r.collapsed).decode()) for r in periodic.periodic_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, 0, [], None, ""), (2, 0, [], None, ""), (2, 0, [], None, ""), (3, 0, [], None, ""), (None, 8, [(0, 8, 2)], (0, 8, 2), "a b"),
            (4, 6, [(0, 6, 1)], (0, 6, 1), "a\x1cb"), (5, 100_000, [(0, 100_000, 2)], (0, 100_000, 2), "é ü"), (5, 1, [], None, "x"),
        ],
        key=str,
    )
    assert periodic.periodic_runs(docs.limit(0)).collect() == []


def test_ties():
    assert periodic.strongest([(5, 8, 2), (0, 12, 3), (20, 4, 1)]) == (0, 12, 3)
    assert periodic.strongest([(0, 9, 2), (3, 14, 3)]) == (3, 14, 3)
