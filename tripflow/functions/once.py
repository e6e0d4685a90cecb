"""Evaluate an expensive expression exactly once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """`df` plus a column that later filters cannot inline.

    The optimiser moves a filter below the projection it reads from and repeats the projected expression
    for every reference. For a parsed message that means one full parse per field. A filter is never moved
    below a generator, so the expression is made the only element of an exploded array.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))
