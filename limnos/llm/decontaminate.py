"""Benchmark decontamination: windows of test words are looked up in every window of training words.

Texts are lower-cased in A-Z and split into words of digits, letters a-z and characters beyond ASCII. A window is ten
consecutive words of a benchmark item, or all words of a shorter one. The distinct windows go to the tasks as a
broadcast hash set; documents are scanned with a rolling hash over word numbers, and hits are verified word by word.
The set's size is checked: beyond PART_WINDOWS windows it is dealt into parts of that size and the documents are
scanned once for each, with the marks so far carried in a saved table.

Null texts have no words. Items without words match nothing; items without an id mark words but are not listed.
Repeated items count once. Each row of documents gives one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.llm.shared import id_and_text, map_slices, quoted, rewritten, saved

WINDOW = 10
PART_WINDOWS = 1_000_000
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
FACTOR = np.uint64(0x9E3779B97F4A7C15)  # any odd number
COUNT, HITS, ITEMS = "¶n_words", "¶hit_words", "¶items"  # names that no table of documents has


def lowered(text: str | None) -> bytes:
    """UTF-8 with only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower()


def words(text: str | None) -> list[bytes]:
    return WORD.findall(lowered(text))


class WindowSet:
    """Windows by length, as sorted hashes of word numbers, with the exact words and items behind each hash."""

    def __init__(self, windows: list[tuple[str, list[int]]]) -> None:
        self.vocabulary: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[int]] = {}
        for text, items in windows:
            self.items[tuple(self.vocabulary.setdefault(w, len(self.vocabulary)) for w in text.encode("utf-8", "surrogatepass").split(b" "))] = items
        by_length: dict[int, list[tuple[int, ...]]] = {}
        for window in self.items:
            by_length.setdefault(len(window), []).append(window)
        self.hashes = {n: np.unique(self._rolled(np.array(rows, np.int64))) for n, rows in by_length.items()}

    @staticmethod
    def _rolled(rows: np.ndarray) -> np.ndarray:
        """One hash for each row of word numbers."""
        code = np.zeros(len(rows), np.uint64)
        for k in range(rows.shape[1]):
            code = code * FACTOR + (rows[:, k] + 1).astype(np.uint64)
        return code

    def find(self, found: list[bytes]) -> tuple[list[int], set[int]]:
        """Numbers of the words inside an occurrence, ascending, and the items that occur."""
        numbers = np.fromiter(map(self.vocabulary.get, found, repeat(-1)), np.int64, len(found))
        hit, items = np.zeros(len(found), bool), set()
        unknown = np.concatenate([[0], np.cumsum(numbers < 0)])
        for n, hashes in self.hashes.items():
            starts = np.flatnonzero(unknown[n:] == unknown[:-n]) if len(found) >= n else np.zeros(0, np.int64)
            if not len(starts):
                continue
            code = self._rolled(numbers[starts[:, None] + np.arange(n)])
            at = np.minimum(np.searchsorted(hashes, code), len(hashes) - 1)
            for start in starts[hashes[at] == code].tolist():
                exact = self.items.get(tuple(numbers[start : start + n].tolist()))
                if exact is not None:
                    hit[start : start + n] = True
                    items.update(exact)
        return np.flatnonzero(hit).tolist(), items


def item_windows(benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text") -> DataFrame:
    """Distinct windows with the sorted ids of their items."""

    def windows(text: str | None) -> list[str]:
        own = [w.decode("utf-8", "surrogatepass") for w in words(text)]
        if not own:
            return []
        return [" ".join(own[i : i + WINDOW]) for i in range(max(1, len(own) - WINDOW + 1))]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = [(i, w) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for w in windows(t)]
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string())], ["item_id", "window"])

    narrow = benchmark.select(quoted(id_column).cast("bigint").alias("item_id"), quoted(text_column).cast("string").alias("text"))
    return map_slices(narrow, work, "item_id bigint, window string").groupBy("window").agg(F.sort_array(F.collect_set("item_id")).alias("items"))


def window_parts(benchmark: DataFrame, part_windows: int = PART_WINDOWS) -> Iterator[Broadcast]:
    """Broadcast sets of at most about ``part_windows`` windows each; at least one, which may be empty."""
    spark = benchmark.sparkSession
    windows = saved(item_windows(benchmark), "benchmark-windows")
    parts = max(1, -(-windows.count() // part_windows))
    for part in range(parts):
        rows = windows.where(F.pmod(F.xxhash64("window"), F.lit(parts)) == part).collect()
        yield spark.sparkContext.broadcast(WindowSet([(r["window"], list(r["items"])) for r in rows]))


def _mark(docs: DataFrame, text_column: str, known: Broadcast) -> DataFrame:
    """``docs`` with its marks brought up to date by one set."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = batch.schema.names
        texts, hits, items = (batch.column(names.index(c)).to_pylist() for c in (text_column, HITS, ITEMS))
        counts = []
        for i, text in enumerate(texts):
            own = words(text)
            counts.append(len(own))
            new_hits, new_items = known.value.find(own)
            hits[i] = sorted({*hits[i], *new_hits}) if hits[i] else new_hits
            items[i] = sorted({*items[i], *new_items})
        columns = dict(zip(names, batch.columns)) | {COUNT: pa.array(counts, pa.int64()), HITS: pa.array(hits, pa.list_(pa.int32())), ITEMS: pa.array(items, pa.list_(pa.int64()))}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return map_slices(docs, work, docs.schema)





def marked(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", part_windows: int = PART_WINDOWS) -> DataFrame:
    """``docs`` with three more columns: its number of words, the numbers of hit words, and the items that occur."""
    out = docs.select("*", F.lit(0).cast("bigint").alias(COUNT), F.array().cast("array<int>").alias(HITS), F.array().cast("array<bigint>").alias(ITEMS))
    for part, known in enumerate(window_parts(benchmark, part_windows)):
        out = _mark(saved(out, "benchmark-marks") if part else out, text_column, known)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", part_windows: int = PART_WINDOWS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, the numbers of its hit words, and the ids of the items that occur."""
    found = marked(id_and_text(docs, id_column, text_column), benchmark, "text", part_windows)
    return found.select("doc_id", F.col(COUNT).alias("n_words"), F.col(HITS).alias("hit_words"), F.col(ITEMS).alias("items"))


def cleaned(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", length_column: str = "n_chars", part_windows: int = PART_WINDOWS) -> DataFrame:
    """``docs`` without the passages that are hit; a document all of whose words are hit goes as a whole.

    A passage runs from the first to the last character of consecutive hit words.
    """
    names = docs.columns

    def without(text: str, hits: list[int]) -> str:
        places = [m.span() for m in WORD.finditer(lowered(text))]
        raw, keep, at = text.encode("utf-8", "surrogatepass"), [], 0
        runs = np.split(np.array(hits), np.flatnonzero(np.diff(hits) > 1) + 1)
        for run in runs:
            keep.append(raw[at : places[run[0]][0]])
            at = places[run[-1]][1]
        return b"".join([*keep, raw[at:]]).decode("utf-8", "surrogatepass")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.get_field_index
        texts, hits = batch.column(at(text_column)).to_pylist(), batch.column(at(HITS)).to_pylist()
        plain = batch.select(names)
        if not any(hits):
            return plain
        return rewritten(plain, text_column, [without(t, h) if h else t for t, h in zip(texts, hits)], length_column)

    some_left = (F.size(HITS) == 0) | (F.size(HITS) < F.col(COUNT))
    return map_slices(marked(docs, benchmark, text_column, part_windows).where(some_left), work, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    n_hit = F.size("hit_words").cast("bigint")
    ids = F.sort_array(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", ids), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
