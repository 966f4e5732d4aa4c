"""Long <-> wide. A caller who lists the wide columns saves the job that finds them; ``unlisted_labels``
tells what such a list leaves out. A cell that would have to choose between different values raises."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str,
         kind: str = "string") -> DataFrame:
    """Wide -> long; the melted columns are cast to one type."""
    typed = df.select(*[F.col(f"`{i}`") for i in ids], *[F.col(f"`{c}`").cast(kind).alias(c) for c in columns])
    return typed.unpivot(list(ids), list(columns), name, value)


def relabel_melted(df: DataFrame, label: str, name: str, value: str, source: str, new_label: str) -> DataFrame:
    """Give rows melted from ``source`` that hold a value a label of their own."""
    chosen = F.col(value).isNotNull() & (F.col(name) == source)
    return df.withColumn(label, F.when(chosen, F.lit(new_label)).otherwise(F.col(label)))


def pivot_with(df: DataFrame, keys: Sequence[str], name: str, cell: Column, values: Sequence | None = None) -> DataFrame:
    """Long -> wide with any aggregate as the cell; without a list, all labels become columns."""
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).pivot(name, None if values is None else list(values)).agg(cell)


def unlisted_labels(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """Labels that a list of wide columns leaves out, with their rows."""
    known = [v for v in values if v is not None]
    return df.filter(F.col(name).isNull() | ~F.col(name).isin(known)).groupBy(name).agg(F.count(F.lit(1)).alias("n"))


def only_value(value: str, several: str = "raise") -> Column:
    """The one value of a cell. Different ones end the job, unless the caller asks for the ``greatest``."""
    if several == "greatest":
        return F.max(value)
    if several != "raise":
        raise ValueError(several)
    conflict = F.raise_error(F.lit(f"a cell of {value} holds different values"))
    return F.when(F.min(value) < F.max(value), conflict).otherwise(F.max(value))


def conflicting_cells(df: DataFrame, keys: Sequence[str], name: str, value: str) -> DataFrame:
    """Cells that hold different values, with their least, greatest and number of rows."""
    cells = df.groupBy(*[F.col(f"`{k}`") for k in [*keys, name]])
    spread = cells.agg(F.min(value).alias("least"), F.max(value).alias("greatest"), F.count(value).alias("n"))
    return spread.filter("least < greatest")


def cast_wide(df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence | None = None,
              several: str = "raise") -> DataFrame:
    """Long -> wide; cells without a row are NULL."""
    return pivot_with(df, keys, name, only_value(value, several), values)


def cast_wide_fill(df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence | None = None,
                   fill: float = 0, placeholder: str | None = None, several: str = "raise") -> DataFrame:
    """Long -> wide; cells without a row are filled. A group that only holds the placeholder stays."""
    columns = None if values is None else sorted(v for v in values if v != placeholder)
    wide = pivot_with(df, keys, name, only_value(value, several), columns)
    if columns is None:
        wide = wide.drop(placeholder) if placeholder is not None else wide
        columns = [c for c in wide.columns if c not in keys]
    return wide.na.fill(fill, subset=columns)


def cast_wide_concat(df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence[str],
                     sep: str = "|") -> DataFrame:
    """Long -> wide; a cell joins its present values in sorted order, NULL when there are none.

    The cell text is the result itself, so it is as long as its data; ``multi_valued_cells`` counts
    cells that hold more than one value.
    """
    wide = pivot_with(df, keys, name, F.collect_list(value), values)
    return wide.withColumns(
        {v: F.nullif(F.array_join(F.array_sort(F.col(f"`{v}`")), sep), F.lit("")) for v in values}
    )


def multi_valued_cells(df: DataFrame, columns: Sequence[str], sep: str = "|") -> DataFrame:
    """How many cells of each column hold several values."""
    counts = [F.count_if(F.col(f"`{c}`").contains(sep)).alias(c) for c in columns]
    return transpose_stats(df.agg(*counts), "column", "n_multi", "bigint")


def multi_valued_counts(df: DataFrame, keys: Sequence[str], name: str, value: str, values: Sequence[str]) -> DataFrame:
    """The same from long rows: cells of each label with several present values, counted without joining any text."""
    cells = df.groupBy(*[F.col(f"`{k}`") for k in [*keys, name]]).agg(F.count(F.col(f"`{value}`")).alias("_values"))
    several = F.col("_values") > 1
    counts = [F.count_if(several & (F.col(f"`{name}`") == F.lit(v))).alias(v) for v in values]
    return transpose_stats(cells.agg(*counts), "column", "n_multi", "bigint")


def scores_wide(df: DataFrame, model: str, stat: str, value: str, stats: Sequence[str] | None = None,
                several: str = "raise") -> DataFrame:
    """(model, stat, value) rows -> one row per model."""
    return pivot_with(df, [model], stat, only_value(value, several), stats)


def transpose_stats(df: DataFrame, name: str = "column", value: str = "value", kind: str = "double") -> DataFrame:
    """A one-row table of statistics -> (column, value) rows."""
    return melt(df, [], df.columns, name, value, kind)


def sort_columns(df: DataFrame, fixed: Sequence[str]) -> DataFrame:
    """Key columns first, the rest in alphabetical order."""
    rest = sorted(c for c in df.columns if c not in set(fixed))
    return df.select([F.col(f"`{c}`") for c in [*fixed, *rest]])
