"""Distance-weighted neighbourhoods on a lattice of cells.

Points are first summed into square cells, a fixed fraction of the bandwidth wide. A cell then meets
at most a fixed number of neighbouring cells, however many points any of them holds: no pairs of
points are formed, a dense place is reduced before the shuffle, and the work per bandwidth is the
number of occupied cells times a constant. The local mean at a point is that of its cell.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from limnos.operators.nearby import sums_nearby
from limnos.session import ship_package

CELLS_PER_BAND = 2
REACH = 3


SMALLEST_BAND = 2_500.0


@dataclass(frozen=True)
class Ladder:
    """Candidate bandwidths from wide to narrow, over an extent that starts at ``origin``."""

    origin: tuple[float, float]
    bandwidths: tuple[float, ...]

    @property
    def base_side(self) -> float:
        return self.side(len(self.bandwidths) - 1)

    def side(self, level: int) -> float:
        """The side of the cells of one bandwidth."""
        return self.bandwidths[level] / CELLS_PER_BAND


def bandwidth_ladder(df: DataFrame, x: str, y: str, scales: int | None = None, ratio: float = 0.5, smallest: float = SMALLEST_BAND) -> Ladder:
    """A geometric ladder that starts at half the larger side of the extent.

    It goes down to the last bandwidth that is not below ``smallest``, on any extent; ``scales`` asks for a number of
    bandwidths instead. There is always one.
    """
    x0, x1, y0, y1 = df.agg(F.min(x), F.max(x), F.min(y), F.max(y)).first()
    widest = max(x1 - x0, y1 - y0) / 2 or 1.0
    bands = [widest]
    while len(bands) < scales if scales else widest * ratio ** len(bands) >= smallest:
        bands.append(widest * ratio ** len(bands))
    return Ladder((float(x0), float(y0)), tuple(bands))


def cell_of(value: Column, origin: float, side: float) -> Column:
    return F.floor((value - F.lit(origin)) / F.lit(side)).cast("bigint")


def with_cells(df: DataFrame, x: str, y: str, origin: tuple[float, float], side: float,
               names: tuple[str, str] = ("cx", "cy")) -> DataFrame:
    """Add the cell of each point."""
    return df.withColumns(
        {
            names[0]: cell_of(F.col(x).cast("double"), origin[0], side),
            names[1]: cell_of(F.col(y).cast("double"), origin[1], side),
        }
    )


def with_offsets(cells: DataFrame, radius: float) -> DataFrame:
    """Each row once per cell offset (dx, dy) inside a circle, the radius counted in cells."""
    limit = math.floor(radius)
    steps = F.sequence(F.lit(-limit), F.lit(limit))
    square = cells.withColumn("dx", F.explode(steps)).withColumn("dy", F.explode(steps))
    return square.filter(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy") <= radius * radius)


def kernel_weight() -> Column:
    """Gaussian weight of a cell offset, the bandwidth being ``CELLS_PER_BAND`` cells."""
    squared = F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy")
    return F.exp(squared * F.lit(-0.5 / CELLS_PER_BAND**2))


def smooth_cells(cells: DataFrame, groups: Sequence[str], columns: Sequence[str],
                 names: tuple[str, str] = ("cx", "cy")) -> DataFrame:
    """Kernel-weighted sums of the columns around every occupied cell, per group.

    ``cells`` has one row per group and occupied cell.
    """
    cx, cy = names
    spread = with_offsets(cells.select(*groups, cx, cy, *columns), REACH * CELLS_PER_BAND).select(
        *groups, (F.col(cx) + F.col("dx")).alias(cx), (F.col(cy) + F.col("dy")).alias(cy),
        *[(kernel_weight() * F.col(c)).alias(c) for c in columns],
        ((F.col("dx") == 0) & (F.col("dy") == 0)).alias("_here"),
    )
    sums = spread.groupBy(*groups, cx, cy).agg(*[F.sum(c).alias(c) for c in columns], F.max("_here").alias("_here"))
    # a cell is occupied exactly when it contributed to itself, so no join back is needed
    return sums.filter("_here").drop("_here")


def kernel_local_mean(df: DataFrame, x: str, y: str, value: str, bandwidth: float,
                      origin: tuple[float, float]) -> DataFrame:
    """Per occupied cell: its points, and the kernel-weighted mean of a value around it."""
    placed = with_cells(df, x, y, origin, bandwidth / CELLS_PER_BAND)
    cells = placed.groupBy("cx", "cy").agg(
        F.count(value).cast("double").alias("weight"), F.coalesce(F.sum(value), F.lit(0.0)).alias("total")
    )
    smooth = smooth_cells(cells, [], ["weight", "total"])
    return smooth.select("cx", "cy", F.try_divide("total", "weight").alias("local_mean"))


def neighbour_join(df: DataFrame, x: str, y: str, radius: float, side: float,
                   origin: tuple[float, float], sums: Mapping[str, str] = {}) -> DataFrame:
    """Pairs of occupied cells whose centres lie within the radius, with the second cell's points.

    The fan-out of a cell is at most the number of cells in the radius, whatever the points are.
    """
    cells = with_cells(df, x, y, origin, side).groupBy("cx", "cy").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(n) for n, c in sums.items()]
    )
    reach = with_offsets(cells.select("cx", "cy"), radius / side).select(
        "cx", "cy", (F.col("cx") + F.col("dx")).alias("nx"), (F.col("cy") + F.col("dy")).alias("ny"),
        (F.hypot(F.col("dx"), F.col("dy")) * F.lit(side)).alias("distance"),
    )
    return reach.join(cells.withColumnsRenamed({"cx": "nx", "cy": "ny"}), ["nx", "ny"])


POINTS_PER_BLOCK = 50_000


def sums_around_points(df: DataFrame, x: str, y: str, radius: float, sums: Mapping[str, str], bandwidth: float | None = None,
                       points_per_block: int = POINTS_PER_BLOCK) -> DataFrame:
    """For each different place of the rows: weight and sums of the rows within ``radius``, by the points' own distances.

    Returns x, y, ``weight`` (the number of rows, or their Gaussian weights where a bandwidth is given) and the weighted
    sums; a missing value adds nothing, and rows without a place are left out. Rows at one place are summed first. Places
    of a tile, a radius wide, meet those of the nine tiles around them in one task. Where there are many, both sides are cut
    in blocks by the places' hash and each pair of blocks is a task's group, so none grows with density. Inside, cells wholly
    within the radius count by their sums (``nearby``), and only what the circle may cut is met point by point.
    """
    ship_package(df.sparkSession)
    rows = df.select(F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"), *[F.col(c).cast("double").alias(f"_{n}") for n, c in sums.items()])
    amounts = ["_n", *[f"_{n}" for n in sums]]
    places = rows.dropna(subset=["_x", "_y"]).groupBy("_x", "_y").agg(
        F.count(F.lit(1)).cast("double").alias("_n"), *[F.coalesce(F.sum(f"_{n}"), F.lit(0.0)).alias(f"_{n}") for n in sums])
    placed = with_cells(places, "_x", "_y", (0.0, 0.0), radius)
    tiles = placed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("_here"))
    moved = [(F.col("cx") + F.col("dx")).alias("cx"), (F.col("cy") + F.col("dy")).alias("cy")]
    around = with_offsets(tiles, 1.5).select(*moved, F.col("_here").alias("_near")).groupBy("cx", "cy").agg(F.sum("_near").alias("_near"))
    blocks = tiles.join(around, ["cx", "cy"]).select(
        "cx", "cy", F.ceil(F.col("_here") / F.lit(points_per_block)).cast("int").alias("_targets"),
        F.ceil(F.col("_near") / F.lit(4 * points_per_block)).cast("int").alias("_sources"))
    mixed = F.xxhash64("_x", "_y")

    def dealt(points: DataFrame, own: str, other: str, columns: Sequence[Column]) -> DataFrame:
        """Points of a tile, each in its block of one side and once for each block of the other."""
        own_block = F.pmod(mixed, F.col(f"_{own}s")).cast("int").alias(f"_{own}")
        every = F.explode(F.sequence(F.lit(0), F.col(f"_{other}s") - 1)).alias(f"_{other}")
        return points.join(blocks, ["cx", "cy"]).select("cx", "cy", *columns, own_block, every)

    keys = ["cx", "cy", "_target", "_source"]
    targets = dealt(placed.select("_x", "_y", "cx", "cy"), "target", "source", [F.col("_x").alias("_to_x"), F.col("_y").alias("_to_y")])
    sources = dealt(with_offsets(placed, 1.5).select("_x", "_y", *amounts, *moved), "source", "target", [F.col(c) for c in ("_x", "_y", *amounts)])
    names = ["weight", *sums]

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({n: pa.array([], pa.float64()) for n in ["_x", "_y", *names]})
        tx, ty, sx, sy = left["_to_x"].to_numpy(), left["_to_y"].to_numpy(), right["_x"].to_numpy(), right["_y"].to_numpy()
        found = sums_nearby(tx, ty, sx, sy, np.array([right[c].to_numpy() for c in amounts]),
                            (left["cx"][0].as_py(), left["cy"][0].as_py()), radius, bandwidth)
        return pa.table({"_x": tx, "_y": ty, **dict(zip(names, found))})

    schema = ", ".join(f"`{n}` double" for n in ["_x", "_y", *names])
    partial = targets.groupBy(*keys).cogroup(sources.groupBy(*keys)).applyInArrow(meet, schema)
    total = partial.groupBy("_x", "_y").agg(*[F.sum(f"`{n}`").alias(n) for n in names])
    return total.withColumnsRenamed({"_x": x, "_y": y})
