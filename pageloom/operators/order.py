"""Global order without a single task: ordered chunks, offsets, page numbers."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_CHUNK = 1_000_000
# The bounds are literals of the plan and a sample of them visits the driver.
MAX_CHUNKS = 20_000
SAMPLES_PER_CHUNK = 100


def _bounds(df: DataFrame, seq: str, rows_per_chunk: int) -> list[int]:
    rows = df.agg(F.count(seq)).first()[0]
    chunks = min(math.ceil(rows / rows_per_chunk), MAX_CHUNKS)
    if chunks <= 1:
        return []
    share = min(1.0, SAMPLES_PER_CHUNK * chunks / rows)
    picked = df.select(seq).sample(share, seed=7) if share < 1 else df.select(seq)
    sample = sorted(picked.toPandas()[seq].tolist())
    cuts = [sample[len(sample) * i // chunks] for i in range(1, chunks)] if sample else []
    return sorted(set(cuts))


def order_chunk(df: DataFrame, seq: str = "seq", rows_per_chunk: int = ROWS_PER_CHUNK) -> Column:
    """A number per row that grows with ``seq`` and holds about ``rows_per_chunk`` rows.

    Passes over ``seq`` alone read the row count and a small sample, from which the bounds
    are cut as a range partitioner does. They are literals from then on, so every later
    use of the column cuts the rows at the same places. ``seq`` is a unique BIGINT.
    """
    bounds = _bounds(df, seq, rows_per_chunk)
    if not bounds:
        # Not a literal: a constant key would turn a join on it into a product.
        return F.when(F.col(seq).isNull(), -1).otherwise(0)
    # Two short searches per row in place of one long one.
    width = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    table = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")

    def reached(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= F.col(seq)))

    group = reached(heads)
    inner = reached(F.get(table, group - 1))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * F.lit(width) + inner)


def row_numbers(df: DataFrame, output: str, seq: str = "seq", rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """``(seq, output)``: 1, 2, 3 … in the order of ``seq``.

    Rows are numbered inside their chunk and shifted by the rows of the chunks before,
    so no task sorts more than a chunk of numbers.
    """
    narrow = df.select(seq)
    tagged = narrow.withColumn("_chunk", order_chunk(narrow, seq, rows_per_chunk))
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # One row per chunk, of which there are at most MAX_CHUNKS.
    offsets = (
        tagged.groupBy("_chunk")
        .agg(F.count("*").alias("_rows"))
        .select("_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_chunk").orderBy(seq))
    return (
        tagged.withColumn("_inside", inside)
        .join(F.broadcast(offsets), "_chunk")
        .select(seq, (F.col("_offset") + F.col("_inside")).alias(output))
    )


def group_numbers(
    df: DataFrame, output: str, group: str, seq: str = "seq", rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """``(seq, output)``: 1, 2, 3 … in the order of ``seq`` within each ``group``.

    A group of any size is numbered chunk by chunk, and shifted by its rows in the chunks before.
    """
    narrow = df.select(seq, F.col(group).alias("_group"))
    tagged = narrow.withColumn("_chunk", order_chunk(narrow, seq, rows_per_chunk))
    before = Window.partitionBy("_group").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    # A row per group and chunk.
    offsets = (
        tagged.groupBy("_group", "_chunk")
        .agg(F.count("*").alias("_rows"))
        .select("_group", "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    inside = F.row_number().over(Window.partitionBy("_group", "_chunk").orderBy(seq))
    numbered = tagged.withColumn("_inside", inside).join(offsets, ["_group", "_chunk"])
    return numbered.select(seq, (F.col("_offset") + F.col("_inside")).alias(output))


def number_rows(
    df: DataFrame, output: str, seq: str = "seq", rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Add ``row_numbers`` to the rows, which move once, by the evenly spread ``seq``.

    ``df`` is read several times: let it come from a table.
    """
    return df.join(row_numbers(df, output, seq, rows_per_chunk), seq)
