import random
import time
from itertools import combinations

import pytest

from pageloom.llm import decontamination as d


def words(text):
    return d.normal((text or "").encode()).split()


def brute(docs, items, overlap=13):
    out = set()
    for key, text in docs:
        w = words(text)
        for item, passage in items:
            p = words(passage)
            if not p or not w:
                continue
            for place in range(-len(p) + 1, len(w)):
                same = [(0 <= place + j < len(w)) and w[place + j] == p[j] for j in range(len(p))]
                inside = [0 <= place + j < len(w) for j in range(len(p))]
                if len(p) < overlap:
                    hit = all(same)
                else:
                    hit = any(sum(same[j : j + overlap]) >= 11 and all(inside[j : j + overlap]) for j in range(len(p) - overlap + 1))
                if hit:
                    out.add((key, item))
    return out


def test_masks_hit_every_pattern():
    for gone in combinations(range(d.OVERLAP), 2):
        assert any(
            not {s + j for j in mask} & set(gone) for mask in d.MASKS for s in range(d.OVERLAP - mask[-1])
        )


@pytest.mark.parametrize("at_once", [1 << 20, 60])
def test_substitutions(spark, at_once):
    rnd = random.Random(4)
    vocabulary = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.choice([1, 4, 9, 12, 13, 14, 20, 40])))) for i in range(25)]
    items += [(100, None), (101, ""), (102, "!? ."), (3, items[3][1]), (None, items[4][1])]
    docs = []
    for i in range(120):
        body = rnd.choices(vocabulary, k=rnd.randint(0, 60))
        passage = (rnd.choice(items[:25])[1]).split()
        a = rnd.randrange(len(passage))
        passage = [w if rnd.random() > rnd.choice([0, 0.1, 0.25]) else "other" for w in passage[a if rnd.random() < 0.4 else 0 :]]
        at = rnd.randint(0, len(body))
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join([*body[:at], *passage, *body[at:]]).upper()))
    docs += [(500, None), (501, ""), (502, items[20][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as item_id", "2 as key")
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as doc_id")
    got = [(r.doc_id, r.item_id) for r in d.leaks(frame, bench, words_at_once=at_once).collect()]
    assert set(got) == brute(docs, items)


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert d.leaks(docs, none).collect() == []
    assert d.leaks(docs.limit(0), none.unionAll(docs)).collect() == []


def test_repetitive_texts_and_items():
    """Seeds that stand very often on both sides: all columns are those of listing every pair."""
    rnd = random.Random(6)
    units = ["a", "a b", "a b c a", "x y"]
    texts = [" ".join([rnd.choice(units)] * rnd.choice([3, 20, 60]) + rnd.choices("abxyz", k=rnd.choice([0, 5]))) for _ in range(12)]
    texts = [f"{t} {rnd.choice(texts)}" for t in texts]
    items = [" ".join([u] * k) for u in units for k in (1, 5, 14, 33)] + [texts[0], " ".join(texts[1].split()[:30])]
    found = [
        d.Seeds(list(range(len(items))), [t.encode() for t in items], paired=p).leaks(d.Words([d.normal(t.encode()) for t in texts]))
        for p in (0, 7, 1 << 40)
    ]
    assert found[0] == found[1] == found[2]
    assert {(t, i) for t, i, *_ in found[0]} == brute(list(enumerate(texts)), list(enumerate(items)))
    for t, i, first, covered, equal in found[0]:
        # The place where most words are equal, the leftmost of such.
        text, item = texts[t].split(), items[i].split()
        most = max(sum(a == b for a, b in zip(text[p:], item)) for p in range(len(text)))
        assert equal <= min(most, covered) and covered <= len(item) and 0 <= first < len(text)


def test_one_word_over_and_over():
    """A text and an item of one word repeated are judged in seconds."""
    start = time.monotonic()
    found = d.Seeds([1], [b"zero " * 1_000]).leaks(d.Words([b"zero " * 100_000, b"zero one " * 30_000]))
    assert found == [(0, 0, 0, 1_000, 1_000)]
    assert time.monotonic() - start < 30
