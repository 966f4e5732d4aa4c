"""Token ids in ORC files, in ascending order of documents.

A row of a file is a document: its id, the number of ids before it, its number of ids, and the ids. ORC writes the
ids and lengths with integer run-length encoding, keeps minima and maxima for each stripe and row group in its
indexes, and a Bloom filter on document ids; so readers take stripes in parallel, and a search for documents skips
stripes and row groups by metadata alone. Files are range-partitioned by document id, each sorted.

Null text is an empty text: the end id alone. Rows without an id come first. Repeated ids stay together, ordered by
their text's hash; equal rows are interchangeable. No documents give an empty folder that reads as no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from limnos.llm.shared import id_and_text, in_slices
from limnos.llm.tokens import encoder
from limnos.session import new_path

END_ID = 0
STRIPE_BYTES = 64 << 20
ROW_GROUP = 1000
SCHEMA = "doc_id bigint, start bigint, n_tokens bigint, ids array<int>"


def encoded(ranged: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Ids of sorted ranges of (doc_id, text): doc_id, start within the range, n_tokens with the end id, ids."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, before = encoder(tokenizer_path), 0
        for batch in in_slices(batches, 500):
            ids = known.encode(batch.column(1).to_pylist(), end_id)
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])])
            flat = pa.array(np.frombuffer(b"".join(ids), "<i4"))
            columns = [batch.column(0), pa.array(before + ends[:-1]), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)]
            before += int(ends[-1])
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])

    return ranged.mapInArrow(task, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text",
                 stripe_bytes: int = STRIPE_BYTES, row_group: int = ROW_GROUP) -> None:
    """Write the files of ``docs`` to ``path``.

    Texts, which are shorter than their ids, are dealt out by ranges of (doc_id, text hash) and encoded there. The
    starts are prefix sums: a running sum within a range, to which reading adds one total for each range before.
    """
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = id_and_text(docs, id_column, text_column).repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    _write(encoded(ranged, tokenizer_path, end_id).withColumn("range", F.spark_partition_id()), path, stripe_bytes, row_group)


def _write(rows: DataFrame, path: str, stripe_bytes: int, row_group: int) -> None:
    options = {"orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01", "orc.create.index": "true",
               "orc.row.index.stride": str(row_group), "orc.stripe.size": str(stripe_bytes), "compression": "zstd"}
    rows.write.options(**options).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The documents of the files at ``path``; filters on doc_id skip stripes and row groups.

    A file holds starts within its own range; the ranges' totals, one a file, are summed up in their order and added.
    """
    rows = spark.read.schema(SCHEMA + ", range int").orc(path)
    totals = rows.groupBy("range").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row a file, which also bounds the broadcast
    bases = totals.select("range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(bases), "range").select("doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` to a new folder of the shared place, and read it."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer_path, end_id)
    return read_tokens(docs.sparkSession, path)


def digest(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, and the checksum of the ids as little-endian 32-bit integers."""
    from zlib import crc32

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(3)
            flat, ends = ids.flatten().to_numpy().astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(batch.column(2).to_numpy())]) * 4
            sums = [crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(task, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
