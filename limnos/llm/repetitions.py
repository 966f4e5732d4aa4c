"""Periodic runs of words inside each text, by recompression.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), of length at least
max(6, 4 q), that no neighbouring word extends keeping the period. Each is found once:

1. Texts of a slice become one sequence of word numbers, with a separator of its own behind each text. ``Grammar``
   compresses it: in turn, blocks of equal symbols become one symbol (base, times), and neighbouring symbols of a left and
   a right class become a pair, until no symbol occurs twice. Equal stretches are compressed equally but at their ends.
2. Words i and i + q of a run agree on at least 3 q consecutive i, so one of them is a multiple of 3 q: the candidates of
   all periods are a harmonic series, n/3 + n/6 + n/9 + ... of them.
3. How far a candidate's two positions agree onwards and backwards is asked of the grammar: up its levels while the
   symbols agree, then down to the first words that differ. All candidates of a range of periods are asked at once.

A period's multiples lie in later ranges than itself; candidates inside a run whose period divides theirs give the same
run again and are skipped. Other multiples are recognised by their equal stretch.

The memory of a task is that of one slice of texts: up to ``SLICE_WORDS`` words, or one text. Null and empty texts have no
words and no runs. Rows of null or repeated ids each have their own result; no rows give no rows; other columns are left
out, so none can clash.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from limnos.llm.shared import id_and_text, in_slices

WORD = re.compile("[^\\x20\\x09-\\x0D]+")
LEAST_TIMES, LEAST_WORDS = 4, 6
SLICE_WORDS = 100_000
SCHEMA = "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@dataclass
class Level:
    """A sequence of symbols; ``first`` has the place where each symbol of the next level begins, and its end."""

    symbols: np.ndarray
    blocks: bool = False
    parent: np.ndarray | None = None
    first: np.ndarray | None = None

    def mirrored(self) -> Level:
        if self.first is None or self.parent is None:
            return Level(self.symbols[::-1])
        return Level(self.symbols[::-1], self.blocks, len(self.first) - 2 - self.parent[::-1], len(self.symbols) - self.first[::-1])


class Grammar:
    """A run-length grammar of a sequence, as its levels from the words up."""

    def __init__(self, words: np.ndarray) -> None:
        self.levels = [Level(words.astype(np.int64))]
        self.unused = int(words.max(initial=-1)) + 1
        tries = 0
        while self._repeats():
            if self._blocks() | self._pairs(tries):
                tries = 0
            else:
                tries += 1
        self.mirror = [level.mirrored() for level in self.levels]

    def _repeats(self) -> bool:
        ordered = np.sort(self.levels[-1].symbols)
        return bool((ordered[1:] == ordered[:-1]).any())

    def _add(self, starts: np.ndarray, symbols: np.ndarray, blocks: bool) -> None:
        below = self.levels[-1]
        m = len(below.symbols)
        opens = np.zeros(m, np.int64)
        opens[starts] = 1
        below.blocks, below.parent, below.first = blocks, np.cumsum(opens) - 1, np.append(starts, m)
        self.levels.append(Level(symbols))

    def _named(self, keys: np.ndarray) -> np.ndarray:
        """New symbols for the different keys."""
        different, which = np.unique(keys, return_inverse=True)
        names = which + self.unused
        self.unused += len(different)
        return names

    def _blocks(self) -> bool:
        s = self.levels[-1].symbols
        starts = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
        if len(starts) == len(s):
            return False
        symbols, times = s[starts], np.diff(np.append(starts, len(s)))
        many = times > 1
        symbols[many] = self._named(symbols[many] * (len(s) + 1) + times[many])
        self._add(starts, symbols, True)
        return True

    def _pairs(self, tries: int) -> bool:
        """Symbols fall into a left and a right class by a hash of their number and of the level."""
        s = self.levels[-1].symbols
        if len(s) < 2:
            return False
        if tries < 64:
            left = _mixed(s, 64 * len(self.levels) + tries)
        else:
            left = s == s[0]
        onward, backward = left[:-1] & ~left[1:], ~left[:-1] & left[1:]
        paired = onward if onward.sum() >= backward.sum() else backward
        if not paired.any():
            return False
        second = np.append(False, paired)
        starts = np.flatnonzero(~second)
        symbols, opens = s[starts], np.append(paired, False)[starts]
        at = starts[opens]
        symbols[opens] = self._named(s[at] * np.int64(self.unused) + s[at + 1])
        self._add(starts, symbols, False)
        return True

    def agreement(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of different places, the number of equal symbols from them onwards."""
        return _agreement(self.levels, x, y)

    def agreement_before(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """For each pair of different places, the number of equal symbols just before them."""
        n = len(self.levels[0].symbols)
        return _agreement(self.mirror, n - x, n - y)


def _mixed(symbols: np.ndarray, seed: int) -> np.ndarray:
    """A bit of each symbol."""
    x = symbols.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x >> np.uint64(31)) & np.uint64(1)).astype(bool)


def _step(level: Level, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far both places can move over equal symbols of one block or place, and whether the blocks end together.

    The first is 0 where the symbols differ or a place is behind the last symbol.
    """
    m = len(level.symbols)
    inside = np.maximum(x, y) < m
    a, b = np.minimum(x, m - 1), np.minimum(y, m - 1)
    same = inside & (level.symbols[a] == level.symbols[b])
    if not level.blocks:
        return same.astype(np.int64), same
    left_x, left_y = level.first[level.parent[a] + 1] - a, level.first[level.parent[b] + 1] - b
    return np.where(same, np.minimum(left_x, left_y), 0), same & (left_x == left_y)


def _agreement(levels: list[Level], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Up while both places begin symbols of the next level, or come to do so in one step; then down to the difference."""
    out = np.zeros(len(x), np.int64)
    stopped: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # by level: query, and both places where symbols may differ
    query, p, q = np.arange(len(x)), x.astype(np.int64), y.astype(np.int64)
    for level in levels[:-1]:
        m = len(level.symbols)
        parent, first = np.append(level.parent, len(level.first) - 1), level.first
        begin = (first[parent[p]] == p) & (first[parent[q]] == q)
        moved, together = _step(level, p, q)
        moved = np.where(begin, 0, moved)
        p, q = p + moved, q + moved
        stay = ~(begin | together) | (np.maximum(p, q) >= m)
        stopped.append((query[stay], p[stay], q[stay]))
        query, p, q = query[~stay], parent[p[~stay]], parent[q[~stay]]
    stopped.append((query, p, q))  # no symbol of the last level occurs twice
    query, p, q = stopped.pop()
    for level, (more, p2, q2) in zip(levels[-2::-1], stopped[::-1], strict=True):
        p, q = level.first[p], level.first[q]
        moved, _ = _step(level, p, q)
        query, p, q = np.concatenate([query, more]), np.concatenate([p + moved, p2]), np.concatenate([q + moved, q2])
    out[query] = p - x[query]
    return out


def find_runs(words: np.ndarray, longest: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence, in which a text has at most ``longest`` words."""
    n, grammar = len(words), None
    found: dict[tuple[int, int], int] = {}
    inside, until = np.zeros(n, np.int64), np.zeros(n, np.int64)  # period and end of a run over each word, 0 if none
    low = 1
    while low * LEAST_TIMES <= longest:
        high = min(2 * low, longest // LEAST_TIMES + 1)
        places, periods = [], []
        for period in range(low, high):
            grid = np.arange(0, n - period, (LEAST_TIMES - 1) * period)
            grid = grid[words[grid] == words[grid + period]]
            if len(grid):
                places.append(grid)
                periods.append(np.full(len(grid), period))
        low = high
        if not places:
            continue
        i, period = np.concatenate(places), np.concatenate(periods)
        known = (inside[i] > 0) & (period % np.maximum(inside[i], 1) == 0) & (i + period < until[i])
        i, period = i[~known], period[~known]
        if not len(i):
            continue
        grammar = grammar or Grammar(words)
        onward, before = grammar.agreement(i, i + period), grammar.agreement_before(i, i + period)
        length = before + onward + period
        good = length >= np.maximum(LEAST_WORDS, LEAST_TIMES * period)
        for start, size, p in sorted(set(zip((i - before)[good].tolist(), length[good].tolist(), period[good].tolist())), key=lambda r: r[2]):
            if found.setdefault((start, size), p) == p:
                free = inside[start : start + size] == 0
                inside[start : start + size][free] = p
                until[start : start + size][free] = start + size
    return sorted((start, size, p) for (start, size), p in found.items())


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[list[str]]]]:
    """Ids and words of rows whose words are about ``SLICE_WORDS`` in number, or of one row with more."""
    ids: list = []
    texts: list[list[str]] = []
    held = 0
    for batch in in_slices(batches, 200):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = WORD.findall(text or "")
            if ids and held + len(words) > SLICE_WORDS:
                yield ids, texts
                ids, texts, held = [], [], 0
            ids.append(doc_id)
            texts.append(words)
            held += len(words)
    if ids:
        yield ids, texts


def runs_of(texts: list[list[str]]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts, given as words."""
    number: dict[str, int] = {}
    codes = [[number.setdefault(w, len(number)) for w in words] for words in texts]
    ends = np.cumsum([len(c) + 1 for c in codes])
    sequence = np.fromiter((x for k, c in enumerate(codes) for x in (*c, len(number) + k)), np.int64, int(ends[-1]))
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, length, period in find_runs(sequence, max(map(len, codes))):
        text = int(np.searchsorted(ends, start, side="right"))
        out[text].append((start - (int(ends[text - 1]) if text else 0), length, period))
    return out


def collapsed(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    """The words without those that any run contains after its first period, joined by one blank."""
    if not runs:
        return " ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return " ".join([words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, all runs by start and period, and the text collapsed to one period of each run."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts in _slices(batches):
            runs = runs_of(texts)
            columns = [pa.array(ids, pa.int64()), pa.array([len(w) for w in texts], pa.int64()),
                       pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs], pa.list_(RUN)),
                       pa.array([collapsed(w, rs) for w, rs in zip(texts, runs)], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return id_and_text(docs, id_column, text_column).mapInArrow(task, SCHEMA)


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest length/period (ties: smallest start, then period), and hashes of runs and text.

    Lengths and periods are far below 2^31, so the cross products that compare two quotients are exact.
    """
    better = "r.length * best.period > best.length * r.period"  # runs come by start, then period: the first of equals stays
    best = F.expr(f"aggregate(slice(runs, 2, greatest(size(runs) - 1, 0)), get(runs, 0), (best, r) -> if({better}, r, best))")
    listed = F.expr("sha2(array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), ''), 256)")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        listed.alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def with_planted_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id and text, where the end of every tenth text by its id's checksum is made to repeat.

    With h = crc32 of the decimal id, g = floor(h / 10), n words, a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), each
    word i >= a becomes word a + (i - a) % p. A row without an id stays as it is.
    """
    n, g = "size(w)", "(h div 10)"
    a, p = f"{g} % {n}", f"1 + ({n} - {g} % {n}) div (3 + {g} % 8)"
    word = f"get(w, cast(if(i < {a}, i, {a} + (i - {a}) % ({p})) as int))"
    made = f"if({n} = 0, text, array_join(transform(sequence(0, {n} - 1), i -> {word}), ' '))"
    words = "filter(split(text, '[ \\\\x09-\\\\x0D]+'), w -> w <> '')"
    text = f"case when h % 10 = 0 then get(transform(array({words}), w -> {made}), 0) else text end"
    rows = id_and_text(docs, id_column, text_column).withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    return rows.select("doc_id", F.expr(text).alias("text"))
