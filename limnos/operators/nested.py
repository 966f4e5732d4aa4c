"""Nested arrays of structs: flattening, sizes, and label/value lists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos.functions.text import extract_group
from limnos.operators.reshape import cast_wide


def _fields(df: DataFrame, column: str) -> list[str]:
    return df.schema[column].dataType.elementType.fieldNames()


def _flatten(df: DataFrame, column: str, generator, prefix: str | None) -> DataFrame:
    """One row per element; a field whose name is taken gets the prefix (default: ``column_``)."""
    prefix = f"{column}_" if prefix is None else prefix
    kept = [name for name in df.columns if name != column]
    exploded = df.select(*[F.col(f"`{name}`") for name in kept], generator(F.col(f"`{column}`")).alias("_element"))
    fields = [
        F.col("_element").getField(name).alias(f"{prefix}{name}" if name in kept else name)
        for name in _fields(df, column)
    ]
    return exploded.select(*[F.col(f"`{name}`") for name in kept], *fields)


def explode_inner(df: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    """Nested rows become rows; rows without elements are dropped."""
    return _flatten(df, column, F.explode, prefix)


def explode_outer(df: DataFrame, column: str, prefix: str | None = None) -> DataFrame:
    """Nested rows become rows; a row without elements stays with NULL fields."""
    return _flatten(df, column, F.explode_outer, prefix)


def unnest_with_prefix(df: DataFrame, column: str, prefix: str, keep_empty: bool = False,
                       drop_copies: bool = False) -> DataFrame:
    """Flatten, naming colliding fields with a prefix; optionally keep only the outer copy."""
    taken = set(df.columns) - {column}
    flat = _flatten(df, column, F.explode_outer if keep_empty else F.explode, prefix)
    if not drop_copies:
        return flat
    return flat.drop(*[f"{prefix}{name}" for name in _fields(df, column) if name in taken])


def columns_equal(df: DataFrame, a: str, b: str) -> bool:
    """Whether two columns hold the same value (or are both NULL) in every row."""
    return df.filter(~F.col(a).eqNullSafe(F.col(b))).isEmpty()


def unequal_rows(df: DataFrame, a: str, b: str) -> DataFrame:
    """How many rows differ between two columns, NULL counted as a value."""
    return df.agg(F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias("n_unequal"))


def nested_sizes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Element count of each nested column (NULL counts as none) as ``<column>_n``."""
    return df.withColumns({f"{c}_n": F.coalesce(F.array_size(F.col(c)), F.lit(0)) for c in columns})


def without_elements(df: DataFrame, column: str) -> DataFrame:
    """Rows whose nested column is empty or NULL."""
    return df.filter(F.coalesce(F.array_size(F.col(column)), F.lit(0)) == 0)


def eav_value(column: str, label: str, label_field: str = "label", value_field: str = "value") -> Column:
    """The first value stored under a label inside a label/value array."""
    matching = F.filter(F.col(column), lambda entry: entry[label_field] == label)
    return F.get(matching, F.lit(0)).getField(value_field)


def eav_to_columns(df: DataFrame, column: str, labels: Mapping[str, str] | Sequence[str]) -> DataFrame:
    """A label/value array inside each row becomes one column per label; no shuffle."""
    names = labels if isinstance(labels, Mapping) else {label: label for label in labels}
    return df.withColumns({name: eav_value(column, label) for label, name in names.items()}).drop(column)


def eav_pivot(df: DataFrame, keys: Sequence[str], label: str, value: str, labels: Sequence[str] | None = None,
              several: str = "raise") -> DataFrame:
    """Label/value rows become one column per label, all or the listed ones, one row per key group."""
    return cast_wide(df, keys, label, value, labels, several)


def parse_kv(df: DataFrame, column: str, first_pattern: str, prefix_pattern: str,
             names: tuple[str, str]) -> DataFrame:
    """``'A=1;B=2'`` -> two text columns: a captured group, and what follows a prefix."""
    source = F.col(column)
    return df.withColumns(
        {
            names[0]: extract_group(source, first_pattern),
            names[1]: F.regexp_replace(source, f"^{prefix_pattern}", ""),
        }
    )


def drop_nested(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop the given columns, or every array, map and struct column."""
    if columns is None:
        columns = [n for n, kind in df.dtypes if kind.startswith(("array", "map", "struct"))]
    return df.drop(*columns)
