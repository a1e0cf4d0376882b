"""What a chain of quality filters removes, in every order of the filters, and each filter's fair share.

What a chain removes depends on the set of filters that ran, not on their order. So the documents of a
part are counted once by the set of filters that each fails, and the counts are tabulated as removals
of all coalitions of filters. A step of an order is the difference of two coalitions. The Shapley values are
the least-squares fit of an additive model to the table, with the Shapley kernel as weights and the
removal of all filters as an exact constraint; its normal equations are solved in rationals.

Texts and keys are handled by built-in functions; texts are read once and not shuffled.
"""

from __future__ import annotations

from fractions import Fraction
from itertools import permutations
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageloom.session import shared_table

SPACE = "[\\x20\\x09-\\x0D]+"
REPEATS = "E"


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space, as an array."""
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def text_filters(text: Column, words: Column) -> dict[str, Column]:
    """Failure conditions on the text alone, by letter; null counts as an empty text."""
    n = F.size(words)
    return {
        "A": n < 50,
        "B": F.size(F.array_distinct(words)) * 100 < n * 65,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.char_length(text) * 5,
        "D": text.rlike("[#$%&*|]"),
    }


def _solved(rows: list[list[Fraction]]) -> list[list[Fraction]]:
    """The inverse of a square matrix, by elimination."""
    n = len(rows)
    work = [[*row, *(Fraction(i == j) for j in range(n))] for i, row in enumerate(rows)]
    for i in range(n):
        lead = next(r for r in range(i, n) if work[r][i])
        work[i], work[lead] = work[lead], work[i]
        work[i] = [x / work[i][i] for x in work[i]]
        for r in range(n):
            if r != i and work[r][i]:
                work[r] = [x - work[r][i] * y for x, y in zip(work[r], work[i], strict=True)]
    return [row[n:] for row in work]


class KernelFit:
    """Additive shares of a table of coalition values, by weighted least squares under the efficiency constraint.

    The values of the 2^n coalitions are in order of their bit sets. The normal equations with a multiplier for the
    constraint do not depend on the values, so they are inverted once.
    """

    def __init__(self, players: int):
        n = self.players = players
        every = (1 << n) - 1
        self.weights = {
            s: Fraction(n - 1, comb(n, k) * k * (n - k)) for s in range(1, every) if (k := s.bit_count())
        }
        has = [[s for s in self.weights if s >> i & 1] for i in range(n)]
        normal = [[sum((self.weights[s] for s in has[i] if s >> j & 1), Fraction(0)) for j in range(n)] + [Fraction(1)] for i in range(n)]
        self.inverse = _solved([*normal, [Fraction(1)] * n + [Fraction(0)]])
        self.has = has

    def shares(self, values: list[int]) -> list[Fraction]:
        right = [sum((self.weights[s] * (values[s] - values[0]) for s in own), Fraction(0)) for own in self.has]
        right.append(Fraction(values[-1] - values[0]))
        return [sum((a * b for a, b in zip(row, right, strict=True)), Fraction(0)) for row in self.inverse[: self.players]]


def coalition_values(by_failed: list[int]) -> list[int]:
    """Removals of every coalition from the numbers of documents by the exact set of filters that they fail."""
    inside = list(by_failed)
    n = len(inside).bit_length() - 1
    for i in range(n):
        for s in range(len(inside)):
            if s >> i & 1:
                inside[s] += inside[s ^ 1 << i]
    # inside[s]: documents that fail nothing outside s. A coalition leaves those that fail nothing in it.
    every = len(inside) - 1
    return [inside[every] - inside[every ^ s] for s in range(len(inside))]


def failed_sets(
    docs: DataFrame, labels: DataFrame, part: str = "source", key: str = "doc_id", text: str = "text",
    filters=text_filters,
) -> DataFrame:
    """``part``, ``failed`` (bit set of filters, the repeat filter last), ``n``, ``good`` and ``toxic``.

    A document is a repeat if its text, null as empty, is that of a smaller key anywhere in the table; equal
    texts are found by their SHA-256. Rows without a key are no repeats and make none. Rows that repeat key and
    text count each, and are repeats only of smaller keys. A key is good (toxic) if any of its labels is.
    """
    rows = docs.select(
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.col(key).cast("long").alias("key"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    # Through a generator, so that the words are split once and not for every mention.
    rows = rows.select("part", "key", "text", F.explode(F.array(words(F.col("text")))).alias("words"))
    conditions = list(filters(F.col("text"), F.col("words")).values())
    failed = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(conditions)), F.lit(0))
    again = 1 << len(conditions)
    # Copies are counted before anything is shuffled; a key's own rows are few wherever its text is everywhere.
    found = rows.select("part", "key", F.sha2(F.col("text").cast("binary"), 256).alias("digest"), failed.alias("failed"))
    # Written, as it is read twice and the texts should not be.
    found = shared_table(found.groupBy("part", "key", "digest", "failed").agg(F.count("*").alias("n")))
    marks = labels.groupBy(F.col(key).cast("long").alias("marked")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    first = found.where("key is not null").groupBy("digest").agg(F.min("key").alias("first"))
    first = first.select(F.col("digest").alias("of"), "first")
    # By digest and key together: a text that a third of all rows has is spread by their keys.
    found = found.join(marks, F.col("key") == F.col("marked"), "left").join(
        first, (F.col("digest") == F.col("of")) & (F.col("key") == F.col("first")), "left"
    )
    repeat = F.col("key").isNotNull() & F.col("first").isNull()
    counted = found.withColumn("failed", F.col("failed") + F.when(repeat, again).otherwise(0))
    return counted.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"),
    )


STEP = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def steps(part: str, tables: list[list[int]], names: str, fit: KernelFit):
    """Rows of every order of the filters, from the numbers by failed set of all, good and toxic documents."""
    every, good, toxic = (coalition_values(t) for t in tables)
    total = sum(tables[0])
    scale = factorial(len(names))
    shares = [int(x * scale) for x in fit.shares(every)]
    for order in permutations(range(len(names))):
        before = 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            removed = every[after] - every[before]
            yield (
                part, "".join(names[k] for k in order), step, total - every[after], removed, every[1 << i] - removed,
                tables[0][1 << i], good[after] - good[before], toxic[after] - toxic[before], shares[i],
            )
            before = after


def audit(
    docs: DataFrame, labels: DataFrame, part: str = "source", key: str = "doc_id", text: str = "text", filters=text_filters
) -> DataFrame:
    """One row per part, ``filter_order`` and ``step``, zeros included.

    ``filters(text, words)`` gives the text filters by letter; the repeat filter ``E`` comes after them. ``removed``
    counts what the step's filter removes there, ``kept`` what is left, ``redundant`` what fails it but went earlier,
    ``unique_fails`` what fails only it, ``good_lost`` and ``toxic_lost`` the labelled ones removed, and ``shapley`` its
    removals summed over all orders. A null part is the empty string; an empty table gives no rows.
    """
    names = "".join(filters(F.lit(""), F.array().cast("array<string>"))) + REPEATS
    size = 1 << len(names)
    kinds = ("n", "good", "toxic")
    found = failed_sets(docs, labels, part, key, text, filters)
    cells = [F.coalesce(F.sum(F.when(F.col("failed") == s, F.col(k))), F.lit(0)) for k in kinds for s in range(size)]
    tables = found.groupBy("part").agg(F.array(*cells).alias("cells"))

    def rows(batches):
        fit = KernelFit(len(names))
        for batch in batches:
            for one, flat in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist(), strict=True):
                made = steps(one, [flat[i * size : (i + 1) * size] for i in range(3)], names, fit)
                kinds_ = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
                arrays = [pa.array(c, k) for c, k in zip(zip(*made, strict=True), kinds_, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in STEP.split(", ")])

    return tables.mapInArrow(rows, STEP)
