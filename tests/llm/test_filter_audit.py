"""The filter audit against removals counted document by document, order by order."""

import re
from fractions import Fraction
from itertools import permutations
from math import factorial

import hypothesis
import hypothesis.strategies as st

from pageloom.llm import filter_audit as audit


def fails(rows):
    """Letters that each row (part, key, text) fails."""
    least = {}
    for _, key, text in rows:
        if key is not None:
            least[text or ""] = min(least.get(text or "", key), key)
    for _, key, text in rows:
        t = text or ""
        words = [w for w in re.split("[\x20\x09-\x0d]+", t) if w]
        yield {
            x
            for x, bad in {
                "A": len(words) < 50,
                "B": 100 * len(set(words)) < 65 * len(words),
                "C": 100 * sum("A" <= c <= "Z" for c in t) > 5 * len(t),
                "D": any(c in "#$%&*|" for c in t),
                "E": key is not None and key > least[t],
            }.items()
            if bad
        }


def brute(rows, good, toxic):
    found, shapley = {}, {}
    sets = list(fails(rows))
    for part in {r[0] or "" for r in rows}:
        own = [(r[1], s) for r, s in zip(rows, sets, strict=True) if (r[0] or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for step, x in enumerate(order, 1):
                gone = [k for k, s in left if x in s]
                left = [(k, s) for k, s in left if x not in s]
                found[part, "".join(order), step] = (
                    len(left), len(gone), sum(x in s for _, s in own) - len(gone), sum(s == {x} for _, s in own),
                    sum(k in good for k in gone), sum(k in toxic for k in gone),
                )
                shapley[part, x] = shapley.get((part, x), 0) + len(gone)
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in found.items())


LONG = " ".join(f"w{i}" for i in range(60))
ROWS = [
    ("a", 1, LONG), ("a", 2, LONG), ("b", 3, LONG), ("b", 3, LONG), (None, 1, LONG), ("", 4, None), ("", 5, ""), ("a", None, ""),
    ("a", None, LONG), ("b", 6, "short text"), ("b", 7, "LOUD | text"), ("b", 8, "\x0b\x0c one word é\x1cword \t"), ("c", 9, "x " * 70),
    ("c", 10, "X y " * 40 + "#"), ("a", 11, "x " * 70), ("a", 12, "É" * 100 + " A" * 6), ("a", 12, "É" * 100 + " A" * 5), ("c", 13, LONG + " \U0001f600"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (7, 0, 1), (None, 1, 1), (11, None, None), (99, 1, 1), (9, 1, 0)]


def test_audit_against_documents(spark, rows):
    docs = spark.createDataFrame(ROWS, "source string, doc_id long, text string")
    docs = docs.selectExpr("*", "'x' as part", "1 as key", "2 as failed", "3 as n", "array('q') as words", "4 as good")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "1 as marked", "2 as n")
    expected = brute(ROWS, {1, 2, 9, 99}, {2, 7, 99})
    assert rows(audit.audit(docs, labels)) == sorted(expected, key=str)
    assert len(expected) == 600 * 4
    # However the rows are dealt out.
    assert rows(audit.audit(docs.repartition(5), labels.repartition(3))) == sorted(expected, key=str)


def test_empty_and_very_long(spark, rows):
    docs = spark.createDataFrame(ROWS, "source string, doc_id long, text string")
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert rows(audit.audit(docs.limit(0), labels)) == []
    long = [("z", 1, "Word " * 300_000), ("z", 2, "a" * 1_000_000), ("z", 3, "Word " * 300_000)]
    got = rows(audit.audit(spark.createDataFrame(long, docs.schema), labels.limit(0)))
    assert got == sorted(brute(long, set(), set()), key=str)


@hypothesis.given(st.integers(2, 5).flatmap(lambda n: st.lists(st.integers(0, 99), min_size=1 << n, max_size=1 << n)))
def test_shares_are_shapley_values(numbers):
    n = len(numbers).bit_length() - 1
    values = audit.coalition_values(numbers)
    assert values == [sum(c for failed, c in enumerate(numbers) if failed & s) for s in range(1 << n)]
    shapley = [Fraction(0)] * n
    for order in permutations(range(n)):
        before = 0
        for i in order:
            shapley[i] += Fraction(values[before | 1 << i] - values[before], factorial(n))
            before |= 1 << i
    assert audit.KernelFit(n).shares(values) == shapley
