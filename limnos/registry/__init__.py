"""Registered queries: each operator over the given tables, with the SQL that must agree with it."""

from limnos.registry import (  # noqa: F401
    columns_and_text,
    composites,
    joins_and_sets,
    modelling,
    nested_and_sources,
    summaries,
)
from limnos.registry.core import oracles, runners  # noqa: F401
