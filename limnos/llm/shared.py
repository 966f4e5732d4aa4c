"""Helpers that the operators share: column choice, Arrow tasks, saved tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from limnos.session import new_path, ship_package

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SLICE_ROWS = 1000  # rows that a task holds as Python objects at once


def on_workers(run: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage, whose first argument is the session, with the package at its workers.

    Rows are whole texts, so Arrow batches are made of fewer rows than is usual for numbers; a session that has set
    their size itself keeps it.
    """

    @wraps(run)
    def shipped(spark: SparkSession, *rest: object) -> DataFrame:
        ship_package(spark)
        if spark.conf.get(ARROW_ROWS) == "10000":
            spark.conf.set(ARROW_ROWS, "1000")
        return run(spark, *rest)

    return shipped


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quoted(name: str) -> Column:
    """A top-level column by its exact name, whatever characters that holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def id_and_text(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Only the two columns that are needed, under fixed names, so that no other column can clash."""
    return docs.select(quoted(id_column).cast("bigint").alias("doc_id"), quoted(text_column).cast("string").alias("text"))


_REMEMBERED: list[dict] = []  # what operators keep in a worker process from one task to the next


def remembered(memory: dict) -> dict:
    """``memory``, which the worker process keeps for later tasks of the same operator, until a task of another one begins."""
    _REMEMBERED.append(memory)
    return memory


def forget() -> None:
    """Give up what tasks of other operators have left in this process: Spark uses its workers for all stages."""
    for memory in _REMEMBERED:
        memory.clear()
    pa.default_memory_pool().release_unused()


def in_slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_slices(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """Apply ``work`` to slices of Arrow batches; it returns a batch with the columns of ``schema``, and remembers nothing."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for part in in_slices(batches):
            yield work(part)

    return df.mapInArrow(task, schema)


def replaced(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    """The batch with one column exchanged; its type stays."""
    at = batch.schema.get_field_index(name)
    columns = [values.cast(f.type) if i == at else batch.column(i) for i, f in enumerate(batch.schema)]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def rewritten(batch: pa.RecordBatch, text_column: str, texts: list, length_column: str | None) -> pa.RecordBatch:
    """The batch with new texts and, where there is such a column, their lengths in code points."""
    out = replaced(batch, text_column, pa.array(texts, pa.string()))
    if length_column in batch.schema.names:
        out = replaced(out, length_column, pa.array([None if t is None else len(t) for t in texts], pa.int64()))
    return out


def saved(df: DataFrame, label: str, **options: object) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, lost executors lose nothing."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.options(compression="zstd", **options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
