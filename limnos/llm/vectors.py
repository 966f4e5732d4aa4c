"""Near-duplicate vectors by the epsilon grid order join.

Vectors of one label and length are projected on their leading principal dimensions; a grid of cells as wide as the
greatest distance of linked unit vectors gives each a cell, and rows are sorted by label, cells, projection. Spark's
range partitions of that order are cut into blocks of at most BLOCK rows. Two blocks are joined only if the boxes
around their projections are near enough; inside a task the two sequences are halved recursively, skipping halves that
are provably distant, down to pieces that are compared directly. Projections never lengthen a distance, so no link is
lost; the basis, fitted on at most BASIS_ROWS vectors, decides only how much is skipped.

Equal vectors of one label are compared once and weighted by their number, so copies form no pairs. Each task returns
for each vector its number of links and one link to its component. Vectors that are null, zero, or hold null or
non-finite components, or whose label is null, have no links and are their own component. Vectors of different length
never link. Rows without an id take part; they have no component id of their own. Repeated ids give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.llm.components import components, rooted
from limnos.llm.shared import quoted, saved

LEAST_COSINE = 0.98
DIMENSIONS = 8  # leading principal dimensions that are kept; the grid takes the first GRID of them
GRID = 3
BLOCK = 2048
PIECE = 256
BASIS_ROWS = 4000
SLACK = 1e-9  # for the rounding of projections

Arrays = dict[str, np.ndarray]


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str) -> DataFrame:
    """(vec_id, label, vector) with the vector in double precision, null if it links with nothing."""
    rows = vectors.select(quoted(id_column).cast("bigint").alias("vec_id"), quoted(label_column).cast("bigint").alias("label"), quoted(vector_column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.col("label").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    return rows.withColumn("vector", F.when(sound, F.transform("vector", lambda x: x + F.lit(0.0))))


def bases(distinct: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal dimensions for each vector length in a bounded sample; the rows of the smallest hashes."""
    sample = distinct.orderBy(F.xxhash64("vector"), "node").limit(BASIS_ROWS).select("vector").toPandas()["vector"]
    out = {}
    for length in sorted({len(v) for v in sample}):
        units = _units(np.stack([v for v in sample if len(v) == length]))
        out[length] = np.linalg.svd(units - units.mean(0), full_matrices=False)[2][:DIMENSIONS].T
    return out


def _units(raw: np.ndarray) -> np.ndarray:
    scaled = raw / np.abs(raw).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _projected(vectors: list[np.ndarray], basis: dict[int, np.ndarray]) -> list[np.ndarray]:
    out = [np.zeros(DIMENSIONS)] * len(vectors)
    lengths = np.array([len(v) for v in vectors])
    for length in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == length)
        axes = basis.get(length, np.eye(length)[:, :DIMENSIONS])
        places = _units(np.stack([vectors[r] for r in rows])) @ axes
        for r, place in zip(rows.tolist(), np.pad(places, ((0, 0), (0, DIMENSIONS - places.shape[1])))):
            out[r] = place
    return out


def in_grid_order(distinct: DataFrame, least_cosine: float, block: int) -> DataFrame:
    """Distinct vectors with their projection, sorted by label, length, grid cells and projection, and cut into blocks."""
    reach = math.sqrt(2 - 2 * least_cosine)
    known = distinct.sparkSession.sparkContext.broadcast(bases(distinct))

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(place=_projected(list(frame["vector"]), known.value))

    def cut(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, filled, before = TaskContext.get().partitionId(), 0, 0, None
        for frame in frames:
            blocks, spots = np.zeros(len(frame), np.int64), np.zeros(len(frame), np.int32)
            for i, group in enumerate(zip(frame["label"], frame["length"])):
                if group != before or filled == block:
                    number, filled, before = number + 1, 0, group
                blocks[i], spots[i], filled = (part << 32) + number, filled, filled + 1
            yield frame.assign(block=blocks, spot=spots)

    placed = distinct.withColumn("length", F.size("vector")).mapInPandas(place, "node bigint, label bigint, copies bigint, vector array<double>, length int, place array<double>")
    order = ["label", "length", *[F.floor(F.get("place", F.lit(k)) / reach) for k in range(GRID)], F.get("place", F.lit(0)), "node"]
    partitions = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # the placed rows are saved, as a range partitioning reads its input twice
    return (saved(placed, "placed-vectors").repartitionByRange(partitions, *order).sortWithinPartitions(*order)
            .mapInPandas(cut, "node bigint, label bigint, copies bigint, vector array<double>, length int, place array<double>, block bigint, spot int"))


def near_blocks(blocks: DataFrame, least_cosine: float) -> DataFrame:
    """Pairs of blocks (left <= right) of one label and length whose boxes are not provably distant."""
    reach = math.sqrt(2 - 2 * least_cosine) + SLACK
    boxes = blocks.groupBy("block", "label", "length").agg(
        *[F.min(F.get("place", F.lit(k))).alias(f"low{k}") for k in range(DIMENSIONS)],
        *[F.max(F.get("place", F.lit(k))).alias(f"high{k}") for k in range(DIMENSIONS)])
    cell = lambda c, by=0: F.floor(F.col(c) / reach).cast("int") + by
    left = boxes.withColumn("cell", F.explode(F.sequence(cell("low0", -1), cell("high0", 1)))).alias("l")
    right = boxes.withColumn("cell", F.explode(F.sequence(cell("low0"), cell("high0")))).alias("r")
    gap = sum(F.pow(F.greatest(F.lit(0.0), F.col(f"l.low{k}") - F.col(f"r.high{k}"), F.col(f"r.low{k}") - F.col(f"l.high{k}")), 2) for k in range(DIMENSIONS))
    met = left.join(right, [F.col(f"l.{c}") == F.col(f"r.{c}") for c in ("label", "length", "cell")]).where(F.col("l.block") <= F.col("r.block"))
    return met.where(gap <= reach * reach).select(F.col("l.block").alias("left"), F.col("r.block").alias("right")).distinct()


def _compare(a: Arrays, b: Arrays, same: bool, least_cosine: float, out: list) -> None:
    """Links between two pieces, by exact cosine where rounding could decide; ``same``: both are one piece."""
    cosine = a["unit"] @ b["unit"].T
    hit = cosine >= least_cosine
    for i, j in np.argwhere(np.abs(cosine - least_cosine) < 1e-12):
        x, y = a["raw"][i], b["raw"][j]
        hit[i, j] = float(np.dot(x, y)) / (math.sqrt(np.dot(x, x)) * math.sqrt(np.dot(y, y))) >= least_cosine
    if same:
        hit = np.triu(hit, 1)
    left, right = np.nonzero(hit)
    np.add.at(a["n"], left, b["copies"][right])
    np.add.at(b["n"], right, a["copies"][left])
    if len(left):  # one link a row is enough for the components, given the roots inside this pair of pieces
        nodes = np.concatenate([a["at"], b["at"]])
        root = rooted(len(nodes), left, right + len(a["at"]))
        own = np.flatnonzero(root != np.arange(len(nodes)))
        out.append((nodes[own], nodes[root[own]]))


def _join(a: Arrays, b: Arrays, same: bool, least_cosine: float, out: list) -> None:
    """The recursive join of two sequence intervals in grid order."""
    reach = math.sqrt(2 - 2 * least_cosine) + SLACK
    if not same:
        gap = np.maximum(0, np.maximum(a["place"].min(0) - b["place"].max(0), b["place"].min(0) - a["place"].max(0)))
        if (gap * gap).sum() > reach * reach:
            return
    if max(len(a["at"]), len(b["at"])) <= PIECE:
        _compare(a, b, same, least_cosine, out)
        return
    halves = [[{k: v[s] for k, v in x.items()} for s in (slice(0, (len(x["at"]) + 1) // 2), slice((len(x["at"]) + 1) // 2, None))] if len(x["at"]) > PIECE else [x] for x in ((a,) if same else (a, b))]
    if same:
        first, second = halves[0]
        _join(first, first, True, least_cosine, out)
        _join(first, second, False, least_cosine, out)
        _join(second, second, True, least_cosine, out)
        return
    for x in halves[0]:
        for y in halves[1]:
            _join(x, y, False, least_cosine, out)


def block_links(blocks: DataFrame, pairs: DataFrame, least_cosine: float) -> DataFrame:
    """(node, n, root): links found for a vector in one pair of blocks, weighted by copies, and a linked vector."""

    def task(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["block", "spot"])
        raw = np.stack(frame["vector"].tolist())
        rows = {"raw": raw, "unit": _units(raw), "place": np.stack(frame["place"].tolist()), "copies": frame["copies"].to_numpy(np.int64),
                "at": np.arange(len(frame)), "n": np.zeros(len(frame), np.int64)}
        of_left = int((frame["block"] == frame["left"]).sum())
        found: list = []
        if of_left == len(frame):
            _join(rows, rows, True, least_cosine, found)
        else:
            _join({k: v[:of_left] for k, v in rows.items()}, {k: v[of_left:] for k, v in rows.items()}, False, least_cosine, found)
        root = np.arange(len(frame))
        if found:
            root = rooted(len(frame), *(np.concatenate([f[k] for f in found]) for k in (0, 1)))
        own = np.flatnonzero((rows["n"] > 0) | (root != np.arange(len(frame))))
        nodes = frame["node"].to_numpy()
        return pd.DataFrame({"node": nodes[own], "n": rows["n"][own], "root": nodes[root[own]]})

    needed = pairs.select("left", "right", F.explode(F.array_distinct(F.array("left", "right"))).alias("block"))
    return blocks.join(needed, "block").groupBy("left", "right").applyInPandas(task, "node bigint, n bigint, root bigint")


def similar_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
                    least_cosine: float = LEAST_COSINE, block: int = BLOCK) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id and kept."""
    rows = usable(vectors, id_column, vector_column, label_column)
    groups = rows.where("vector IS NOT NULL").groupBy("label", "vector").agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"))
    # ids may be missing or repeated, so each distinct vector gets a number, which the saved table fixes
    numbered = saved(groups.withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    blocks = saved(in_grid_order(numbered.select("node", "label", "copies", "vector"), least_cosine, block), "vector-blocks")
    found = saved(block_links(blocks, near_blocks(blocks, least_cosine), least_cosine), "vector-links")
    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    roots = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = numbered.join(counts, "node", "left").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = named.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = named.join(least, "root").select("label", "vector", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.where("vector IS NOT NULL").join(classes, ["label", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.where("vector IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return out.union(alone).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))
