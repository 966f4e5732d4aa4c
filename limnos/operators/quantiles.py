"""Exact quantiles of a whole column, and what is built on them."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH_ACCURACY = 10_000
REMAINDER = 200_000  # rows around a rank that one aggregate may hold in the end


@dataclass
class _Search:
    """An interval ``(above, upto]`` of values known to hold the wanted rank (counted inside it)."""

    rank: int
    rows: int
    above: float | None = None
    upto: float | None = None
    found: float | None = None

    def inside(self) -> Column:
        v, held = F.col("v"), F.lit(True)
        if self.above is not None:
            held = held & (v > F.lit(self.above))
        if self.upto is not None:
            held = held & (v <= F.lit(self.upto))
        return F.when(held, v)


def _brackets(values: DataFrame, searches: list[_Search], margin: float) -> list[tuple[float, float]]:
    """Values just below and above each rank, from one sketch per distinct interval."""
    by_interval: dict[tuple, list[int]] = {}
    for i, search in enumerate(searches):
        by_interval.setdefault((search.above, search.upto), []).append(i)
    sketches = []
    for members in by_interval.values():
        probs = []
        for search in (searches[i] for i in members):
            probs += [max(search.rank / search.rows - margin, 0.0), min((search.rank + 1) / search.rows + margin, 1.0)]
        ends = F.array(*[F.lit(p) for p in probs])
        sketches.append(F.percentile_approx(searches[members[0]].inside(), ends, F.lit(SKETCH_ACCURACY)))
    row = values.agg(*[c.alias(f"b{k}") for k, c in enumerate(sketches)]).first()
    out = {}
    for k, members in enumerate(by_interval.values()):
        for place, i in enumerate(members):
            out[i] = (row[k][2 * place], row[k][2 * place + 1])
    return [out[i] for i in range(len(searches))]


def _narrow(values: DataFrame, searches: list[_Search], margin: float) -> None:
    """Two aggregates for all searches: bracket each rank by a mergeable sketch, then count below it."""
    bracket = _brackets(values, searches, margin)
    counts = []
    for i, search in enumerate(searches):
        v, (low, high) = search.inside(), bracket[i]
        counts += [F.count_if(v < low), F.count_if(v == low), F.count_if((v > low) & (v <= high))]
    counted = values.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    for i, search in enumerate(searches):
        (low, high), (below, equal, between) = bracket[i], counted[3 * i: 3 * i + 3]
        if search.rank < below:
            search.upto, search.rows = low, below + equal  # the sketch missed on the low side
        elif search.rank < below + equal:
            search.found = low
        elif search.rank < below + equal + between:
            search.above, search.upto = low, high
            search.rank, search.rows = search.rank - below - equal, between
        else:
            search.above = high  # and here on the high side
            search.rank, search.rows = search.rank - below - equal - between, search.rows - below - equal - between


def _order_statistics(values: DataFrame, ranks: Sequence[int], rows: int, remainder: int) -> dict[int, float]:
    """Values at the given ranks (from 0) of column ``v``.

    Each round leaves about one part in ``SKETCH_ACCURACY`` of the rows around a rank, and a value that
    fills the bracket is found at once, so no task ever holds the column. Every search takes at least
    one round; the last reads all small intervals together.
    """
    searches = {rank: _Search(rank, rows) for rank in ranks}
    pending = list(searches.values())
    while pending:
        before = [s.rows for s in pending]
        _narrow(values, pending, 2.0 / SKETCH_ACCURACY)
        if any(s.found is None and s.rows >= n > remainder for s, n in zip(pending, before)):
            raise RuntimeError("a sketch bracket did not narrow the search for a quantile")
        pending = [s for s in pending if s.found is None and s.rows > remainder]
    small = [s for s in searches.values() if s.found is None]
    if small:
        # half a rank below the wanted one names it without rounding trouble
        measures = []
        for i, search in enumerate(small):
            share = (search.rank + 0.5) / search.rows
            measures.append(F.expr(f"percentile_disc({share!r}D) WITHIN GROUP (ORDER BY s{i}) AS p{i}"))
        row = values.select(*[s.inside().alias(f"s{i}") for i, s in enumerate(small)]).agg(*measures).first()
        for i, search in enumerate(small):
            search.found = row[i]
    return {rank: search.found for rank, search in searches.items()}


def exact_quantiles(df: DataFrame, column: str, probs: Sequence[float],
                    remainder: int = REMAINDER) -> list[float | None]:
    """Quantiles by linear interpolation between order statistics (type 7), at any table size."""
    values = df.select(F.col(column).cast("double").alias("v")).filter("v is not null")
    rows = values.count()
    if rows == 0:
        return [None] * len(probs)
    places = [(rows - 1) * p for p in probs]
    ranks = sorted({math.floor(h) for h in places} | {math.ceil(h) for h in places})
    at = _order_statistics(values, ranks, rows, remainder)
    out = []
    for place in places:
        low, high = at[math.floor(place)], at[math.ceil(place)]
        share = place - math.floor(place)
        out.append(low if share == 0.0 else low * (1 - share) + high * share)
    return out


def bivariate_class(df: DataFrame, x: str, y: str, dim: int = 3, name: str = "bi_class") -> DataFrame:
    """``'i-j'`` class of two columns by their quantiles (right-closed bins); complete rows only."""
    complete = df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    probs = [i / dim for i in range(1, dim)]

    def place(column: str):
        cuts = exact_quantiles(complete, column, probs)
        above = [F.when(F.col(column) > F.lit(cut), 1).otherwise(0) for cut in cuts]
        return sum(above, F.lit(1))

    return complete.withColumn(name, F.concat_ws("-", place(x).cast("string"), place(y).cast("string")))


def qq_pairs(df: DataFrame, a: str, b: str, probs: Sequence[float]) -> DataFrame:
    """Quantiles of two columns side by side at the given probabilities."""
    left, right = exact_quantiles(df, a, probs), exact_quantiles(df, b, probs)
    rows = [(float(p), left[i], right[i]) for i, p in enumerate(probs)]
    return df.sparkSession.createDataFrame(rows, f"prob double, {a} double, {b} double")
