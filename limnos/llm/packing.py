"""Best-fit packing of documents into sequences, after a Martello-Toth reduction.

Documents longer than a sequence are cut into full pieces, the first of which may be shorter. How pieces are packed
depends only on their lengths, so the instance is a histogram: how many pieces there are of each length up to the
capacity. Its size doesn't grow with the data. On it, the reduction fixes sets of at most three lengths that dominate
every other way to pack their largest member, as many at once as the counts allow; best fit, longest first, packs what
remains. The resulting fillings (a pattern of lengths and how often it is used) are dealt out to the pieces by their
rank within their length, which is a prefix sum over tasks, so a length that holds a third of all pieces goes through
no single task.

Null text is an empty text: one piece with the end id alone. Rows without an id and repeated rows are packed like
others. No documents give no pieces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from limnos.llm.shared import forget, id_and_text, in_slices, saved
from limnos.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2


@dataclass(frozen=True)
class Filling:
    """``times`` sequences that each hold pieces of these lengths."""

    lengths: tuple[int, ...]
    times: int


def _reduce(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Fix dominating sets, longest piece first; takes them out of ``counts``."""
    fixed: list[Filling] = []

    def take(lengths: tuple[int, ...], times: int) -> None:
        for n in lengths:
            counts[n] -= times
        fixed.append(Filling(lengths, times))

    def longest(most: int, without: tuple[int, ...] = ()) -> int:
        """The longest piece of at most ``most`` that is left besides ``without``; 0 if there is none."""
        for n in range(min(most, capacity), 0, -1):
            if counts[n] > without.count(n):
                return n
        return 0

    def shortest(k: int, without: tuple[int, ...]) -> list[int]:
        out: list[int] = []
        for n in range(1, capacity + 1):
            spare = int(counts[n]) - without.count(n)
            out += [n] * min(max(spare, 0), k - len(out))
            if len(out) == k:
                break
        return out

    def best_pair(room: int, first: int) -> int:
        return max((a + b for a in range(1, room) if counts[a] > (a == first) and (b := longest(min(a, room - a), (first, a)))), default=0)

    for first in range(capacity, 0, -1):
        while counts[first] > 0:
            room, have = capacity - first, int(counts[first])
            partner = longest(room, (first,))
            if not partner:  # nothing fits beside it
                take((first,), have if 2 * first > capacity else 1)
                continue
            # what dominates now dominates until one of its lengths runs out: nothing longer or better can appear
            together = have // 2 if partner == first else min(have, int(counts[partner]))
            two, three = shortest(2, (first,)), shortest(3, (first,))
            if partner == room or len(two) < 2 or sum(two) > room:
                take((first, partner), together)  # a full sequence, or nothing else fits besides one piece
            elif (len(three) < 3 or sum(three) > room) and partner >= best_pair(room, first):
                take((first, partner), together)  # one piece as long as the best two
            else:
                break  # no set is known to dominate
    return fixed


def _best_fit(counts: np.ndarray, capacity: int) -> list[Filling]:
    """Best fit, longest first, with all sequences of one filling handled at once."""
    open_by_room: dict[int, list[Filling]] = {}

    def put(filling: Filling) -> None:
        open_by_room.setdefault(capacity - sum(filling.lengths), []).append(filling)

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        for room in sorted(r for r in open_by_room if r >= length):
            if not left:
                break
            fillings, each = open_by_room.pop(room), room // length
            for f in fillings:
                full = min(f.times, left // each)
                if full:
                    put(Filling(f.lengths + (length,) * each, full))
                left -= full * each
                rest = f.times - full
                if rest and left and left < each:
                    put(Filling(f.lengths + (length,) * left, 1))
                    rest, left = rest - 1, 0
                if rest:
                    put(Filling(f.lengths, rest))
        each = capacity // length
        if left // each:
            put(Filling((length,) * each, left // each))
        if left % each:
            put(Filling((length,) * (left % each), 1))
    return [f for fillings in open_by_room.values() for f in fillings]


def fillings(counts: np.ndarray, capacity: int = CAPACITY) -> list[Filling]:
    """How to pack ``counts[n]`` pieces of each length n: the reduction, then best fit."""
    rest = counts.copy()
    fixed = _reduce(rest, capacity)
    reduced = fixed + _best_fit(rest, capacity)
    plain = _best_fit(counts, capacity)
    used = lambda x: sum(f.times for f in x)
    return reduced if used(reduced) <= used(plain) else plain


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text", generation: int | None = None) -> DataFrame:
    """Pieces of all documents, saved: doc_id, piece, start, length, ids, and the piece's task and rank there within its length."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = encoder(tokenizer_path, generation), TaskContext.get().partitionId()
        ranks = np.zeros(capacity + 1, np.int64)
        for batch in in_slices(batches, 500):
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), known.encode(batch.column(1).to_pylist(), end_id)):
                total = len(ids) // 4
                first = (total - 1) % capacity + 1
                for piece, end in enumerate(range(first, total + 1, capacity)):
                    start = max(0, end - capacity) if piece else 0
                    rows.append((doc_id, piece, start, end - start, ids[4 * start : 4 * end], number, int(ranks[end - start])))
                    ranks[end - start] += 1
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))], ["doc_id", "piece", "start", "length", "ids", "task", "rank"])

    return saved(id_and_text(docs, id_column, text_column).mapInArrow(task, "doc_id bigint, piece int, start bigint, length bigint, ids binary, task bigint, rank bigint"), "pieces")


def _slots(packed: list[Filling], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, by ascending first rank: that rank, the first sequence, and the offset there."""
    ranks, rows, sequence = np.zeros(capacity + 1, np.int64), {}, 0
    for f in packed:
        offset = 0
        for length in f.lengths:
            rows.setdefault(length, []).append((int(ranks[length]), sequence, offset))
            ranks[length] += f.times
            offset += length
        sequence += f.times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r)) for n, r in rows.items()}


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` without ids, with sequence_id and offset; ``ids_crc32`` is the checksum of a piece's ids."""
    spark = pieces.sparkSession
    by_task = saved(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "piece-counts")
    counts = np.zeros(capacity + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row a length
        counts[row["length"]] = row["n"]
    slots = spark.sparkContext.broadcast(_slots(fillings(counts, capacity), capacity))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = (pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "task", "rank")
              .join(bases, ["length", "task"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("base")).alias("rank")))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length).tolist():
                own = np.flatnonzero(length == n)
                first, begin, place = slots.value[n]
                at = np.searchsorted(first, rank[own], "right") - 1
                sequence[own], offset[own] = begin[at] + rank[own] - first[at], place[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(task, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text", generation: int | None = None) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id and offset.

    ``generation`` is how many pieces a worker remembers, in place of ``tokens.GENERATION``: fewer take less memory and more time.
    """
    return placed(cut_pieces(docs, tokenizer_path, capacity, end_id, id_column, text_column, generation), capacity)


def sequences(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id and its ids as one binary; a sequence is bounded by the capacity.

    ``pieces`` and ``places`` are matched by document, piece and checksum; equal pieces of repeated rows are
    interchangeable, so each is matched by its number among them.
    """
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    order = Window.partitionBy(*key)
    left = pieces.withColumn("ids_crc32", F.crc32("ids")).withColumn("copy", F.row_number().over(order.orderBy("task", "rank"))).alias("l")
    right = places.withColumn("copy", F.row_number().over(order.orderBy("sequence_id", "offset"))).alias("r")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in [*key, "copy"]]
    members = left.join(right, same).groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("m"))
    return members.select("sequence_id", F.aggregate("m", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
