"""Projections, filters, flags, and choosing columns by what they contain."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnos.functions.text import concat_na


def project(
    df: DataFrame,
    keep: Sequence[str] | None = None,
    drop: Sequence[str] = (),
    between: tuple[str, str] | None = None,
    first: Sequence[str] = (),
) -> DataFrame:
    """Keep by name or by range, drop by name, and move some columns to the front."""
    names = list(df.columns)
    if between is not None:
        names = names[names.index(between[0]): names.index(between[1]) + 1]
    if keep is not None:
        names = [n for n in keep if n in names]
    names = [n for n in names if n not in set(drop)]
    ordered = [n for n in first if n in names] + [n for n in names if n not in set(first)]
    return df.select([F.col(f"`{n}`") for n in ordered])


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename many columns at once; names that are absent are left out."""
    return df.withColumnsRenamed(dict(names))


def _contents(df: DataFrame) -> dict[str, tuple[int, int, bool]]:
    """Rows, values and whether all values agree, per column, from a single aggregate."""
    measures = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(df.columns):
        cell = F.col(f"`{name}`")
        measures += [F.count(cell).alias(f"n{i}"), F.min(cell).eqNullSafe(F.max(cell)).alias(f"same{i}")]
    row = df.agg(*measures).first()
    return {name: (row["rows"], row[f"n{i}"], row[f"same{i}"]) for i, name in enumerate(df.columns)}


def _is_constant(rows: int, values: int, same: bool) -> bool:
    # missing counts as one value: constant means all missing, or one value and none missing
    return values == 0 or (values == rows and same)


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value; costs one aggregate job."""
    return select_where(df, lambda rows, values, same: values > 0)


def split_constant_columns(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(varying columns, columns with at most one distinct value); NULL counts as a value.

    Equality of minimum and maximum decides, so no distinct count and no shuffle of rows is needed.
    """
    contents = _contents(df)
    constant = [n for n in df.columns if _is_constant(*contents[n])]
    return df.drop(*constant), df.select([F.col(f"`{n}`") for n in constant])


def drop_sparse_columns(df: DataFrame, max_null: float = 0.25, keys: Sequence[str] = ()) -> DataFrame:
    """Drop columns whose share of missing values exceeds the limit; key columns stay."""
    contents = _contents(df)
    sparse = [
        n for n, (rows, values, _) in contents.items()
        if n not in set(keys) and rows > 0 and (rows - values) / rows > max_null
    ]
    return df.drop(*sparse)


def select_where(df: DataFrame, keep: Callable[[int, int, bool], bool]) -> DataFrame:
    """Keep columns by a predicate over (rows, values, all values equal)."""
    contents = _contents(df)
    return df.select([F.col(f"`{n}`") for n in df.columns if keep(*contents[n])])


def apply_columns(df: DataFrame, change: Callable[[Column], Column], kinds: Iterable[str] = (),
                  names: Iterable[str] = ()) -> DataFrame:
    """Apply one column function to all columns of some types or names."""
    kinds, names = set(kinds), set(names)
    chosen = [n for n, kind in df.dtypes if kind in kinds or n in names]
    return df.withColumns({n: change(F.col(f"`{n}`")) for n in chosen})


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Keep listed values; NULL is not listed."""
    return df.filter(F.col(column).isin(*values))


def filter_not_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Drop listed values; NULL stays."""
    return df.filter(~F.coalesce(F.col(column).isin(*values), F.lit(False)))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows complete in the given columns; names the table does not have are ignored."""
    return df.dropna(subset=[c for c in columns if c in df.columns])


def parse_failures(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    """Rows with text but without a number."""
    return df.filter(F.col(parsed).isNull() & F.col(raw).isNotNull())


def filter_pattern(df: DataFrame, column: str, value, text: str, pattern: str) -> DataFrame:
    """Rows with a given value whose text matches a pattern."""
    return df.filter((F.col(column) == value) & F.col(text).rlike(pattern))


def valid_sites(df: DataFrame, x: str, y: str, site: str, bad_ids: Sequence) -> DataFrame:
    """Drop rows without any coordinate, and listed or unnamed sites; one coordinate is enough."""
    located = concat_na(F.col(x), F.col(y)) != "NANA"
    return df.filter(located & ~F.col(site).isin(*bad_ids))


def filter_any_nonzero(df: DataFrame, except_columns: Sequence[str]) -> DataFrame:
    """Rows where some other column is not zero."""
    others = [c for c in df.columns if c not in set(except_columns)]
    return df.filter(reduce(lambda a, b: a | b, [F.coalesce(F.col(f"`{c}`") != 0, F.lit(False)) for c in others]))


def filter_unequal(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.filter(F.col(a) != F.col(b))


def onehot_flags(df: DataFrame, column: str, flags: Mapping[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column per flag, set where the lower-cased text is one of its synonyms."""
    text = F.lower(F.col(column))
    return df.withColumns(
        {name: F.when(text.isin(*synonyms), 1).otherwise(0) for name, synonyms in flags.items()}
    )


def dummy_code(df: DataFrame, column: str, levels: Sequence, prefix: str | None = None,
               drop_first: bool = True) -> DataFrame:
    """0/1 columns for the given ordered levels; the first is the baseline. NULL gives NULL."""
    prefix = f"{column}_" if prefix is None else prefix
    return df.withColumns(
        {f"{prefix}{v}": (F.col(column) == v).cast("int") for v in levels[1 if drop_first else 0:]}
    )


def complete_flag(df: DataFrame, columns: Sequence[str], name: str = "inFilt") -> DataFrame:
    """1 where all listed columns hold a value."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.withColumn(name, complete.cast("int"))


def binarize(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Abundance -> presence (1.0 / 0.0, NULL stays)."""
    return apply_columns(df, lambda c: (c > 0).cast("double"), names=columns)


def presence_flag(column: Column) -> Column:
    """1 where a value is present, else 0."""
    return column.isNotNull().cast("int")


def neq_flag(a: Column, b: Column) -> Column:
    """1 where two values differ, NULL where one is missing."""
    return (a != b).cast("int")


def poly_features(df: DataFrame, squares: Mapping[str, str]) -> DataFrame:
    """Add the square of each column under the given name."""
    return df.withColumns({name: F.col(c) * F.col(c) for c, name in squares.items()})


def feature_matrix(df: DataFrame, id_column: str, covariates: Sequence[str], label: str,
                   coordinates: tuple[str, str], offset: str | None = None) -> DataFrame:
    """The columns a model needs, as doubles: id, label, coordinates, covariates."""
    from pyspark.ml.feature import VectorAssembler

    names = {label: "y", coordinates[0]: "x_coord", coordinates[1]: "y_coord"}
    if offset:
        names[offset] = "log_effort"
    typed = df.select(
        F.col(id_column),
        *[F.col(c).cast("double").alias(n) for c, n in names.items()],
        *[F.col(c).cast("double").alias(c) for c in covariates],
    )
    if offset:
        typed = typed.withColumn("log_effort", F.log("log_effort"))
    if not covariates:
        return typed
    return VectorAssembler(inputCols=list(covariates), outputCol="features", handleInvalid="skip").transform(typed)


def column_sets(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str]]:
    """(names of ``a`` also in ``b``, names of ``a`` not in ``b``), in the order of ``a``."""
    other = set(b.columns)
    return [n for n in a.columns if n in other], [n for n in a.columns if n not in other]


def columns_of_type(df: DataFrame, kind: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]
