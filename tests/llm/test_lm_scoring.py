"""The automaton's scores against a plain model that keeps all n-grams in a dictionary."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pageloom.llm import lm_scoring as lm
from pageloom.llm import queries

SF = "/root/testdata/sf0.001"
END, START = "\n", "\t"


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*(w for w in re.split("[\x20\x09-\x0d]+", text) if w), END]


class Plain:
    """States in a dictionary; one token at a time, along failure arcs."""

    def __init__(self, texts, order):
        self.order, self.counts = order, Counter()
        for text in texts:
            stream = [START, *tokens(text)]
            for k in range(1, order + 1):
                self.counts.update(tuple(stream[i : i + k]) for i in range(len(stream) - k + 1))
        self.V = sum(len(g) == 1 for g in self.counts) - ((START,) in self.counts)
        self.N = sum(c for g, c in self.counts.items() if len(g) == 1 and g != (START,))
        types = Counter(map(len, self.counts))
        self.priors = {k: max(1.0, types[k] / max(1, types[k - 1])) for k in range(2, order + 1)}

    def p(self, context, word):
        if not context:
            return (self.counts[(word,)] + 1) / (self.N + self.V + 1)
        prior = self.priors[len(context) + 1]
        return (self.counts[(*context, word)] + prior * self.p(context[1:], word)) / (self.counts[context] + prior)

    def score(self, text):
        state, total = (START,)[: self.order - 1], 0.0
        if not self.counts[(START,)]:
            state = ()
        for word in tokens(text):
            while state and not self.counts[(*state, word)]:
                prior = self.priors[len(state) + 1]
                total += math.log10(prior / (self.counts[state] + prior))
                state = state[1:]
            total += math.log10(self.p(state, word))
            state = (*state, word)[-self.order + 1 :] if self.order > 1 and self.counts[(*state, word)] else ()
        return total

    def row(self, text):
        own = tokens(text)
        base = sum(math.log10(self.p((), w)) for w in own)
        return len(own), sum(self.counts[(w,)] > 0 for w in own), self.N, base, self.score(text)


def check(got, model, texts):
    """``texts``: (key, text) of every row."""
    order = lambda r: (str(r[0]), r[1], r[4])
    got = sorted(((r[0], *r[-5:]) for r in got), key=lambda r: (str(r[0]), r[1], r[4]))
    expected = sorted(((k, *model.row(t)) for k, t in texts), key=order)
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    for a, b in zip(got, expected, strict=True):
        assert a[4:] == pytest.approx(b[4:], rel=1e-11, abs=1e-11)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_against_plain_model(spark, order):
    rnd = random.Random(order)
    rows = [(i, " ".join(rnd.choice(["a", "B", "b", "c", "d e", "\x0bé", "É"]) for _ in range(rnd.choice([0, 1, 2, 3, 9, 60])))) for i in range(60)]
    rows += [(None, "a b"), (7, None), (8, ""), (9, "\n \r"), (3, rows[3][1]), (3, rows[3][1]), (61, "never seen words a b a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "false as train", "2 as block", "3 as score")
    train = F.coalesce(F.col("doc_id") % 3 > 0, F.lit(True))
    model = Plain([t for k, t in rows if k is None or k % 3 > 0], order)
    # Small blocks, few and many shards and short lanes change nothing.
    for sizes in ({}, {"block_bytes": 200, "shards": 3, "lane": 5}):
        check(lm.score(docs, train, order=order, **sizes).collect(), model, rows)


def test_nothing_to_learn_from_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted(tuple(r) for r in lm.score(docs, F.lit(None).cast("boolean")).collect()) == [(1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0)]
    assert lm.score(docs.limit(0), F.lit(True)).collect() == []


def test_probabilities_sum_to_one(spark):
    model = Plain(["a b a c", "b b a", ""], 3)
    words = ["a", "b", "c", END]
    for context in ((), ("a",), ("b", "a"), (START, "a"), ("z", "b"), ("z", "z")):
        assert sum(model.p(context, w) for w in [*words, "unknown"]) == pytest.approx(1)


def test_very_long_text(spark):
    rnd = random.Random(1)
    long = " ".join(rnd.choice("abcdefg") for _ in range(120_000))
    rows = [(1, long), (2, "a b c"), (3, "a " * 50_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(lm.score(docs, F.col("doc_id") < 3).collect(), Plain([long, "a b c"], 3), rows)


def test_query(spark):
    """Whole documents of the smallest tables, and better held-out scores than without context."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = {k for k in texts if zlib.crc32(str(k).encode()) % 7 == 2}
    rows = queries.op11_lm_scoring(spark, SF).collect()
    assert {r.doc_id for r in rows if r.held_out} == held
    check(rows, Plain([t for k, t in texts.items() if k not in held], lm.ORDER), list(texts.items()))
    assert sum(r.score for r in rows if r.held_out) > sum(r.base_score for r in rows if r.held_out)
