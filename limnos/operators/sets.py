"""Set operations on rows and values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append(a: DataFrame, *others: DataFrame) -> DataFrame:
    """Append rows by column name, absent columns NULL."""
    for other in others:
        a = a.unionByName(other, allowMissingColumns=True)
    return a


def master_list(df: DataFrame, columns: Sequence[str], name: str = "value") -> DataFrame:
    """Distinct values of several columns as one list, a missing value included once."""
    return df.select(F.explode(F.array(*[F.col(c) for c in columns])).alias(name)).distinct()


def intersect_values(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows in both."""
    return a.intersect(b)


def except_values(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct rows of ``a`` that ``b`` does not have."""
    return a.subtract(b)
