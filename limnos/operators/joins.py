"""Joins. None of them forces a broadcast: Spark broadcasts a side only when its measured size is
below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, with AQE splitting hot keys.
The forms below are those AQE can split (inner, left outer, left semi, left anti)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, object]:
    """``right`` with keys renamed apart, and the condition that matches NULL with NULL."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, [left[f"`{k}`"].eqNullSafe(renamed[f"`_right_{k}`"]) for k in keys]
    )
    return renamed, condition


def join_nullsafe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match NULL keys; keys appear once."""
    renamed, condition = _null_safe(left, right, keys)
    joined = left.join(renamed, condition, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def join_nullsafe_left(df: DataFrame, dictionary: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach a dictionary; a missing unit matches a unitless entry."""
    return join_nullsafe(df, dictionary, keys, "left")


def natural_left_join(a: DataFrame, b: DataFrame, matched_only: bool = False) -> DataFrame:
    """Join on all shared names; ``matched_only`` keeps rows with a partner."""
    shared = [n for n in a.columns if n in set(b.columns)]
    return join_nullsafe(a, b, shared, "inner" if matched_only else "left")


def lookup_join(df: DataFrame, mapping: DataFrame, key: str) -> DataFrame:
    """Attach looked-up columns by one key."""
    return join_nullsafe(df, mapping, [key], "left")


def full_join(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join with NULL keys matching; each input is computed once.

    Meant for inputs with few rows a key, such as one row per site and year: AQE does not split a hot key here.
    """
    renamed, condition = _null_safe(a, b, keys)
    joined = a.join(renamed, condition, "full_outer")
    shared = [F.coalesce(a[f"`{k}`"], renamed[f"`_right_{k}`"]).alias(k) for k in keys]
    return joined.select(*[shared[keys.index(n)] if n in keys else a[f"`{n}`"] for n in a.columns],
                         *[renamed[f"`{n}`"] for n in renamed.columns if n not in {f"_right_{k}" for k in keys}])


def semi_join(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs in another table."""
    return join_nullsafe(df, keys_df.select(*keys), keys, "left_semi")


def unmatched_keys(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str | None = None) -> DataFrame:
    """Distinct keys of ``a`` that lack a partner in ``b``, or have a partner without a value."""
    wanted = a.select(*keys).distinct()
    missing = join_nullsafe(wanted, b.select(*keys), keys, "left_anti")
    if value is None:
        return missing
    empty = join_nullsafe(wanted, b.filter(F.col(value).isNull()).select(*keys), keys, "left_semi")
    return missing.union(empty).distinct()


def attach_predictions(df: DataFrame, predictions: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Add predicted columns by site key (never by row position)."""
    keys = [key] if isinstance(key, str) else list(key)
    return join_nullsafe(df, predictions, keys, "left")
