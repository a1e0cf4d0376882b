import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.functions.text import token_estimate
from pageloom.operators.order import number_rows, order_chunk
from pageloom.operators.tokens import _Fold, token_batches, token_count, token_state


def one_pass(prompts, completions, budget, used=0, batch=0):
    out = []
    for p, c in zip(prompts, completions):
        if used + p > budget:
            used, batch = 0, batch + 1
        out.append(batch)
        used += p + c
        if used > budget:
            used, batch = 0, batch + 1
    return out, used, batch


def test_fold_of_a_chunk_for_every_start():
    random.seed(3)
    for _ in range(1500):
        budget, n = random.randint(0, 40), random.randint(1, 25)
        top = random.choice([0, 3, 10, 60])
        p = [random.randint(0, top) for _ in range(n)]
        c = [random.randint(0, top) for _ in range(n)]
        fold = _Fold(np.array(p), np.array(c), budget)
        ends = fold.ends()
        for used in range(budget + 5):
            batches, after, count = one_pass(p, c, budget, used)
            assert list(fold.batches(used, 0)) == batches
            at = int(np.searchsorted([e[0] for e in ends], used, side="left")) - 1
            _, end, restarts = ends[at]
            assert (end + (used if at == 0 and restarts == 0 else 0), restarts) == (after, count)


@pytest.mark.parametrize("chunk", [7, 50, 10_000])
@pytest.mark.parametrize("parts", [1, 5])
def test_batches_do_not_depend_on_chunks(spark, chunk, parts):
    random.seed(4)
    rows = [(i * 7, random.randint(0, 120), random.randint(0, 60), str(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "seq long, prompt_tokens int, completion_tokens int, shard string").repartition(parts)
    expected, used, last = one_pass([r[1] for r in rows], [r[2] for r in rows], 300, used=250)
    got = token_batches(df, 300, start_tokens=250, rows_per_chunk=chunk).orderBy("seq").collect()
    assert [r.batch for r in got] == expected
    state = token_state(df, 300, start_tokens=250, rows_per_chunk=chunk).first()
    assert (state.token_count, state.batch) == (used, last)
    sharded = token_batches(df, 300, shard="shard", rows_per_chunk=chunk)
    for s in "01":
        mine = [r for r in rows if r[3] == s]
        want = one_pass([r[1] for r in mine], [r[2] for r in mine], 300)[0]
        assert [r.batch for r in sharded.where(F.col("shard") == s).orderBy("seq").collect()] == want


def test_chunks_are_ordered_and_bounded(spark):
    df = spark.range(10_000).select((F.col("id") * F.col("id")).alias("seq"))
    tagged = df.withColumn("chunk", order_chunk(df, "seq", 100))
    sizes = tagged.groupBy("chunk").agg(F.count("*").alias("n"), F.min("seq").alias("lo"), F.max("seq").alias("hi"))
    found = sizes.orderBy("chunk").collect()
    assert len(found) == 100 and max(r.n for r in found) <= 110
    assert all(a.hi < b.lo for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("chunk", [9, 1000])
def test_row_numbers(spark, chunk):
    df = spark.range(300).select((F.col("id") * 1000 - 5).alias("seq")).repartition(7)
    got = number_rows(df, "n", rows_per_chunk=chunk).orderBy("seq").collect()
    assert [r.n for r in got] == list(range(1, 301))


def test_token_estimate(spark):
    df = spark.createDataFrame([("Hello, world 12345!",), ("",), (None,), ("Straße\n\n",)], "t string")
    assert [r[0] for r in df.select(token_estimate(F.col("t"))).collect()] == [6, 0, 0, 2]


def test_own_tokenizer(spark):
    df = spark.createDataFrame([("a b c",), (None,)], "t string")
    counted = df.select(token_count(F.col("t"), lambda: lambda texts: [len(t.split()) for t in texts]))
    assert [r[0] for r in counted.collect()] == [3, 0]
