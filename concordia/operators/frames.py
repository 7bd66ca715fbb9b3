"""Small DataFrame idioms shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*frames: DataFrame) -> DataFrame:
    """Put the columns of several one-row frames side by side, without a cross join."""
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])


def first_text(df: DataFrame, column: str, k: int, name: str) -> DataFrame:
    """The ``k`` smallest values of a column as one comma-separated text.

    The limit is a distributed top-k, so only ``k`` values ever reach the last task.
    """
    return (
        df.select(column)
        .orderBy(column)
        .limit(k)
        .agg(
            F.array_join(
                F.array_sort(F.collect_list(column)).cast("array<string>"), ","
            ).alias(name)
        )
    )
