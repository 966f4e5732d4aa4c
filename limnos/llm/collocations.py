"""Phrases of neighbouring words that occur together more often than their parts, by set-oriented mining of relations.

The occurrences of words are a relation that is kept as a saved table, sorted by piece and position: the words of a block
of whole documents of one language in their order, with a gap between pieces, so that neighbouring places are always of one
piece. From phrases of k words to those of one more,

1. group and count: occurrences of each phrase, within each block first, then over all blocks;
2. semi-join: occurrences of phrases that are not frequent leave the relation;
3. merge-join: an occurrence meets that at the next place of its piece. As the relation is sorted, the partner is the next
   one, and the join is one pass over it.

Single words are semi-joined exactly, which gives frequent words dense numbers; a phrase is then its words' numbers, two in
a bigint. Longer phrases are semi-joined by a bitmap of ``FILTER_BITS`` bits, which bounds what is broadcast: an infrequent
phrase that shares a bit with a frequent one stays in the relation, adds rows to the next count, and fails that count. No
count depends on the bitmap, as it never loses a frequent phrase.

A row of the relation is a block of one language, of about ``BLOCK_WORDS`` occurrences. What is shuffled to count is one row
for each different phrase of a block, so a word or phrase that is everywhere has one row a block; occurrences themselves
are shuffled once, by block, into tasks of about ``TASK_BLOCKS`` blocks, and files of blocks have row groups of some
megabytes, so that a task holds few blocks however many there are. The driver holds the bitmap and nothing else.

Texts are lower-cased in A-Z only. Null texts are empty. A null language is ``und``. Repeated rows count each; ids are not
read; other columns are left out, so none can clash; no rows give no rows. Texts of any length are taken whole. There may be
2^31 frequent words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from limnos.llm.shared import in_slices, quoted, saved

BREAKS = ".,;:!?\n\x0b\x0c\r"
TOKEN = re.compile("[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
CAPITALS = re.compile("[A-Z]+")
BLOCK_WORDS = 1 << 20
TASK_BLOCKS = 4
# A row is a block: by default a writer first looks at its size after 100 rows, and a reader takes a row group at once.
BLOCK_FILES = {"parquet.block.size": 8 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
UNKNOWN = "und"
GAP = -1
WORD_BITS = 31
FILTER_BITS = 134_217_689  # a prime below 2^27: 16 MB
FILTER_STEP = 1_000_003
WORDS = "block bigint, lang string, words array<string>, counts array<bigint>, places array<int>"
PAIRS = "block bigint, places array<int>, key0 array<bigint>, counts array<bigint>"
GROUPS = 64  # of a language's candidates, ranked apart before they are ranked together


class Frequent(NamedTuple):
    """Saved tables of what occurs often enough: words (lang, phrase, f, id), and for each size (lang, phrase, f)."""

    sizes: list[DataFrame]
    totals: DataFrame  # lang, n


class _Numbers(dict[str, int]):
    """The numbers of one language's words in a block, in order of appearance; ends of pieces are gaps."""

    def __init__(self) -> None:
        super().__init__(dict.fromkeys(BREAKS, GAP))
        self.held, self.texts = 0, []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self) - len(BREAKS)
        return number

    def add(self, text: str) -> int:
        lowered = text.lower() if text.isascii() else CAPITALS.sub(lambda m: m[0].lower(), text)
        places = list(map(self.__getitem__, TOKEN.findall(lowered)))
        places.append(GAP)
        self.texts.append(np.array(places, np.int32))
        self.held += len(places)
        return len(places)

    def row(self, block: int, lang: str) -> pa.RecordBatch:
        places, words = np.concatenate(self.texts), list(self)[len(BREAKS) :]
        counts = np.bincount(places[places != GAP], minlength=len(words))
        return _batch({"block": [block], "lang": [lang], "words": [words], "counts": [counts], "places": [places]}, WORDS)


def _batch(columns: dict[str, list], schema: str) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}
    kind_of = dict(part.split() for part in schema.split(", "))
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[kind_of[k]]) for k, v in columns.items()], list(columns))


def word_occurrences(docs: DataFrame, lang_column: str = "lang", text_column: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The relation of single words, a row for each block of a language."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        filled: dict[str, _Numbers] = {}
        for batch in in_slices(batches, 200):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held += filled.setdefault(lang, _Numbers()).add(text)
                full = [lang] if filled[lang].held >= block_words else list(filled) if held >= 4 * block_words else []
                for key in full:
                    held -= filled[key].held
                    yield filled.pop(key).row(block, key)
                    block += 1
        for key, numbers in filled.items():
            yield numbers.row(block, key)
            block += 1

    lang, text = F.coalesce(quoted(lang_column).cast("string"), F.lit(UNKNOWN)), F.coalesce(quoted(text_column).cast("string"), F.lit(""))
    return docs.select(lang.alias("lang"), text.alias("text")).mapInArrow(task, WORDS)


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows of a saved table with dense numbers from 0, prefix sums over its partitions."""
    marked = saved(rows.withColumn("at", F.monotonically_increasing_id()), "frequent")
    sizes = marked.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a partition
    bases = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.withColumn("part", F.shiftright("at", 33)).join(bases, "part").withColumn("id", (F.col("base") + place).cast("int")).drop("at", "part", "base")


def word_pairs(relation: DataFrame, words: DataFrame) -> DataFrame:
    """The relation semi-joined with the frequent words, now by their numbers, and its pairs of neighbours with counts."""
    tasks = max(relation.sparkSession.sparkContext.defaultParallelism, -(-relation.count() // TASK_BLOCKS))  # Spark merges parts that it is not told
    each = relation.select("block", "lang", F.posexplode("words").alias("place", "phrase"))
    found = each.join(words, ["lang", "phrase"]).repartition(tasks, "block")
    numbers = found.groupBy("block").agg(F.collect_list("place").alias("old"), F.collect_list("id").alias("new"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, 1):
            block, size = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            places, old, new = (batch.column(i)[0].values.to_numpy() for i in (2, 3, 4))
            number = np.full(size + 1, GAP, np.int32)  # a gap is the last one
            number[old] = new
            places = number[places]
            keys, counts = _counted(_keys(places, np.ones(len(places), bool), 2))
            yield _batch({"block": [block], "places": [places], "key0": [keys[0]], "counts": [counts]}, PAIRS)

    joined = relation.select("block", F.size("words").alias("size"), "places").repartition(tasks, "block").join(numbers, "block")
    return joined.select("block", "size", "places", "old", "new").mapInArrow(task, PAIRS)


def longer_phrases(pairs: DataFrame, shorter: DataFrame, size: int) -> DataFrame:
    """Different phrases of ``size`` words in each block, with counts; both phrases of one word less pass the filter."""
    bitmap = pairs.sparkSession.sparkContext.broadcast(_filter_of(shorter, size // 2))
    names = [f"key{i}" for i in range((size + 1) // 2)]
    schema = ", ".join(f"{x} array<bigint>" for x in [*names, "counts"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = bitmap.value
        for batch in in_slices(batches, 1):
            places = batch.column(0)[0].values.to_numpy()
            at, keys = _keys(places, np.ones(len(places), bool), size - 1)
            bit = _bit(keys)
            passed = np.zeros(len(places) + 1, bool)
            passed[at[(bits[bit >> 3] >> (bit & 7)) & 1 == 1]] = True
            found, counts = _counted(_keys(places, passed[:-1] & passed[1:], size))
            yield _batch({x: [k] for x, k in zip(names, found)} | {"counts": [counts]}, schema)

    return pairs.select("places").mapInArrow(task, schema)


def _keys(places: np.ndarray, starts: np.ndarray, size: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where phrases begin, of those places that may, and the phrases, two words in a number."""
    n = max(len(places) - size + 1, 0)
    good = starts[:n].copy()
    for i in range(size):
        good &= places[i : n + i] != GAP
    at = np.flatnonzero(good)
    words = [places[at + i].astype(np.int64) for i in range(size)]
    return at, [words[i] << WORD_BITS | words[i + 1] if i + 1 < size else words[i] for i in range(0, size, 2)]


def _counted(found: tuple[np.ndarray, list[np.ndarray]]) -> tuple[list[np.ndarray], np.ndarray]:
    """Different phrases and their counts."""
    _, keys = found
    code, first = np.zeros(len(keys[0]), np.int64), np.zeros(0, np.int64)
    for key in keys:
        number = np.unique(key, return_inverse=True)[1] if len(keys) > 1 else key
        _, first, code, counts = np.unique(code << WORD_BITS | number if len(keys) > 1 else number, return_index=True, return_inverse=True, return_counts=True)
    return [key[first] for key in keys], counts


def _bit(keys: list) -> np.ndarray:
    """The bit of a phrase, the same in numpy and in Spark."""
    bit = keys[0] % FILTER_BITS
    for key in keys[1:]:
        bit = (bit * FILTER_STEP + key % FILTER_BITS) % FILTER_BITS
    return bit


def _filter_of(phrases: DataFrame, longs: int) -> np.ndarray:
    """A bitmap of the phrases, put together in Spark by pieces of 4 kB."""
    bit = _bit([F.col(f"key{i}") for i in range(longs)]) + 1  # the functions count bits from 1
    pieces = phrases.select(F.bitmap_bucket_number(bit).alias("piece"), F.bitmap_bit_position(bit).alias("at")).groupBy("piece").agg(F.bitmap_construct_agg("at").alias("bits"))
    out = np.zeros((FILTER_BITS // 32768 + 1) * 4096, np.uint8)
    for row in pieces.toLocalIterator():
        out[(row.piece - 1) * 4096 : row.piece * 4096] = np.frombuffer(row.bits, np.uint8)
    return out


def counted(relation: DataFrame, keys: list[str]) -> DataFrame:
    """Occurrences of each key in all blocks."""
    each = relation.select(F.explode(F.arrays_zip(*keys, "counts")).alias("p"))
    return each.groupBy(*[F.col(f"p.{k}").alias(k) for k in keys]).agg(F.sum("p.counts").alias("f"))


def _spelled(phrases: DataFrame, words: DataFrame, size: int) -> DataFrame:
    """lang, phrase, f of phrases given by their words' numbers."""
    mask = (1 << WORD_BITS) - 1
    for i in range(size):
        key = F.col(f"key{i // 2}")
        number = key if i == size - 1 and size % 2 else F.shiftright(key, WORD_BITS) if i % 2 == 0 else key.bitwiseAND(F.lit(mask))
        named = words.select(F.col("id").cast("bigint").alias(f"id{i}"), F.col("phrase").alias(f"w{i}"), *(["lang"] if i == 0 else []))
        phrases = phrases.withColumn(f"id{i}", number).join(named, f"id{i}")
    return phrases.select("lang", F.concat_ws(" ", *[f"w{i}" for i in range(size)]).alias("phrase"), "f")


def frequent_phrases(docs: DataFrame, longest: int, least: int, lang_column: str = "lang", text_column: str = "text", block_words: int = BLOCK_WORDS) -> Frequent:
    """Phrases of 1 to ``longest`` words that occur ``least`` times in their language."""
    relation = saved(word_occurrences(docs, lang_column, text_column, block_words), "occurrences", **BLOCK_FILES)
    each = relation.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("p"))
    totals = saved(relation.select("lang", F.aggregate("counts", F.lit(0).cast("bigint"), lambda a, b: a + b).alias("n")).groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    words = _numbered(each.groupBy("lang", F.col("p.words").alias("phrase")).agg(F.sum("p.counts").alias("f")).where(F.col("f") >= least))
    relation = saved(word_pairs(relation, words), "occurrences", **BLOCK_FILES)
    sizes, rows = [words], relation
    for size in range(2, longest + 1):
        keys = [f"key{i}" for i in range((size + 1) // 2)]
        phrases = saved(counted(rows, keys).where(F.col("f") >= least), "frequent")
        sizes.append(saved(_spelled(phrases, words, size), "phrases"))
        if size < longest:
            rows = longer_phrases(relation, phrases, size + 1)
    return Frequent(sizes, totals)


def _part(size: int, begin: int, end: int) -> Column:
    """Words begin to end of a phrase of ``size`` words."""
    return F.array_join(F.slice(F.split("phrase", " ", size), begin + 1, end - begin), " ")


def _scored(tables: list[DataFrame], size: int) -> DataFrame:
    """lang, phrase, a, and l, r and score of the cut that scores lowest, the first of equals."""
    rows = tables[size - 1].withColumnRenamed("f", "a")
    for k in range(1, size):
        for name, part, table in ((f"l{k}", _part(size, 0, k), tables[k - 1]), (f"r{k}", _part(size, k, size), tables[size - k - 1])):
            of = table.select("lang", F.col("phrase").alias(f"part_{name}"), F.col("f").alias(name))
            rows = rows.withColumn(f"part_{name}", part).join(of, ["lang", f"part_{name}"])
    wide = {x: f"cast({x} as decimal(15, 0))" for x in ["a", *(f"{s}{k}" for s in "lr" for k in range(1, size))]}
    score = {k: f"(1000000 * {wide['a']} * {wide['a']}) div ({wide[f'l{k}']} * {wide[f'r{k}']})" for k in range(1, size)}
    cuts = F.expr("array_min(array(" + ", ".join(f"struct({score[k]} as score, {k} as k, l{k} as l, r{k} as r)" for k in score) + "))")
    return rows.withColumn("cut", cuts).select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, top: int = 2000, absorbed_percent: int = 50, lang_column: str = "lang",
                 text_column: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """Each language's ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score.

    A phrase is left out if one longer candidate around it has ``absorbed_percent`` of its occurrences. Products are
    decimals of 38 digits, exact for counts below 10^15.
    """
    tables, totals = frequent_phrases(docs, longest, least, lang_column, text_column, block_words)
    scored = [_scored(tables, size) for size in range(2, longest + 1)]
    rows = scored[0]
    for more in scored[1:]:
        rows = rows.unionByName(more)
    inside = [tables[size - 1].select("lang", _part(size, i, i + n).alias("phrase"), F.col("f").alias("around"))
              for size in range(3, longest + 1) for n in range(2, size) for i in range(size - n + 1)]
    if inside:
        around = inside[0]
        for more in inside[1:]:
            around = around.unionByName(more)
        around = around.groupBy("lang", "phrase").agg(F.max("around").alias("around"))
        rows = rows.join(around, ["lang", "phrase"], "left").where(f"around is null or 100 * around < {absorbed_percent} * a")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    apart = Window.partitionBy("lang", "part").orderBy(*order)  # a language may hold most candidates: its best are found in groups first
    rows = rows.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(GROUPS))).withColumn("rank", F.row_number().over(apart)).where(F.col("rank") <= top)
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")).where(F.col("rank") <= top)
    return rows.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
