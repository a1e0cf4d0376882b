"""Columns that are worked out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, **columns: Column) -> DataFrame:
    """Add costly columns so that each is evaluated once, however often it is used.

    A filter on a plain projected column moves below the projection and takes a copy of
    the expression along for every mention. The planner does not look through a generator,
    here one of a single row, so what is above it reads the values.
    """
    named = [value.alias(name) for name, value in columns.items()]
    return df.select("*", F.inline(F.array(F.struct(*named))))
