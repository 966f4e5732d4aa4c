"""Picking rows within groups, and ordering.

A ranking window would sort a whole group in one task. These picks instead reduce each group to
its best order key with a partial aggregate and join that back, so a group that holds a large
share of all rows is reduced before the shuffle and its rows can be split between tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos.operators.joins import join_nullsafe

Order = str | tuple[str, str]


def _sort_value(df: DataFrame, name: str, direction: str) -> Column:
    column = F.col(f"`{name}`")
    if direction == "asc":
        return column
    kind = df.schema[name].dataType.typeName()
    if kind in ("byte", "short", "integer", "long"):
        return -column.cast("decimal(20,0)")
    if kind in ("float", "double") or kind.startswith("decimal"):
        return -column
    if kind == "date":
        return -F.unix_date(column)
    raise TypeError(f"descending order needs a number or a date, not {kind}")


def _with_order(df: DataFrame, order: Sequence[Order]) -> tuple[DataFrame, list[str]]:
    """Order values as columns that sort ascending."""
    pairs = [(item, "asc") if isinstance(item, str) else item for item in order]
    names = [f"_order{i}" for i in range(len(pairs))]
    return df.withColumns({n: _sort_value(df, *pair) for n, pair in zip(names, pairs)}), names


def _first_key(keyed: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """Per group the lexicographically smallest order values, missing last."""
    grouped = keyed.groupBy(*[F.col(f"`{k}`") for k in keys])
    if len(names) == 1:  # a plain minimum skips missing values and aggregates by hashing
        return grouped.agg(F.min(names[0]).alias(names[0]))
    parts = [c for n in names for c in (F.col(n).isNull().alias(f"{n}_missing"), F.col(n))]
    smallest = grouped.agg(F.min(F.struct(*parts)).alias("_first"))
    return smallest.select(*[F.col(f"`{k}`") for k in keys], *[F.col("_first")[n].alias(n) for n in names])


def pick_min(df: DataFrame, keys: Sequence[str], order: Sequence[Order]) -> DataFrame:
    """Rows of each group with the lexicographically smallest order key; ties are kept, missing sorts last."""
    keyed, names = _with_order(df, order)
    best = _first_key(keyed, keys, names)
    return join_nullsafe(keyed, best, [*keys, *names], "left_semi").drop(*names)


def shallowest(df: DataFrame, keys: Sequence[str], depths: tuple[str, str] = ("minDepth", "maxDepth")) -> DataFrame:
    """Per occasion and parameter, the rows at the smallest (minimum, maximum) depth."""
    return pick_min(df, keys, list(depths))


def first_survey(df: DataFrame, site: str, date: str) -> DataFrame:
    """The earliest surveys of each site, ties kept."""
    return pick_min(df, [site], [date])


def highest_effort(df: DataFrame, site: str, date: str, effort: str) -> DataFrame:
    """Earliest surveys of each site and, among them, those with the largest effort."""
    return pick_min(df, [site], [date, (effort, "desc")])


def later_occurrences(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """All rows of a group but its first. The order columns must tell rows of a group apart."""
    keyed, names = _with_order(df, order)
    return join_nullsafe(keyed, _first_key(keyed, keys, names), [*keys, *names], "left_anti").drop(*names)


def sort_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Global order by the columns, then by all other sortable columns, so that rows sharing a key
    can still be spread over several ranges."""
    sortable = [n for n, kind in df.dtypes if not kind.startswith(("array", "map", "struct"))]
    ties = [c for c in sortable if c not in set(columns)]
    return df.orderBy(*[F.col(f"`{c}`").asc_nulls_last() for c in [*columns, *ties]])
