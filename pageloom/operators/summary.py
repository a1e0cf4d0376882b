"""Run counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _items() -> Column:
    return F.when(F.col("shape").isin("typed", "untyped", "list"), F.size("items"))


def run_summary(urls: DataFrame, parsed: DataFrame, decisions: DataFrame) -> DataFrame:
    """One row of a run's counters; every input is reduced to one row before they meet."""
    seen = urls.agg(F.count("*").alias("urls"))
    found = parsed.agg(
        F.count_if(_items() > 0).alias("pages_with_annotations"),
        F.count_if(F.col("shape") == "malformed").alias("malformed_responses"),
        F.coalesce(F.sum(F.size("entities")), F.lit(0)).alias("entities"),
    )
    stored = decisions.agg(
        F.count_if("is_new").alias("annotations_uploaded"),
        F.coalesce(F.count_if(~F.col("is_new")) + F.sum("_repeats"), F.lit(0)).alias("annotations_skipped"),
    )
    rows = seen.unionByName(found, True).unionByName(stored, True)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def observed(df: DataFrame, name: str, *metrics: Column) -> DataFrame:
    """Live counters of whatever action runs over ``df``; no pass of their own."""
    return df.observe(name, F.count("*").alias("rows"), *metrics)
