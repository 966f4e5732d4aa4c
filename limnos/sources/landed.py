"""Landed JSON documents, typed CSV, reference lists, saved tables and flat outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from limnos import fixed_values as fixed


def scan_samples(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    array: str = "samples",
    one_document_per_line: bool = True,
) -> DataFrame:
    """Rows of the ``samples`` (or ``stations``) array of landed API documents.

    Land documents one per line where possible: such files split between tasks, whereas a
    file that holds a single pretty-printed document is read by one task.
    """
    document = T.StructType([T.StructField(array, T.ArrayType(schema))])
    documents = spark.read.schema(document).json(path, multiLine=not one_document_per_line)
    return documents.selectExpr(f"inline({array})")


def sink_documents(samples: DataFrame, path: str, array: str = "samples", rows_per_file: int = 500_000) -> None:
    """Land each row as one JSON document on a line, compressed, as the same names stand in each.

    A compressed file is read by one task as a stream, so a file holds at most so many documents.
    """
    document = F.to_json(F.struct(F.array(F.struct(*samples.columns)).alias(array))).alias("value")
    samples.select(document).write.option("maxRecordsPerFile", rows_per_file).text(path, compression="snappy")


def restrict_to_stations(
    samples: DataFrame,
    stations: DataFrame,
    product_type: str | None = None,
    years: tuple[int, int] | None = None,
    station: str = "stationId",
) -> DataFrame:
    """Samples of the listed stations, optionally of one product type and a range of years."""
    if product_type is not None:
        samples = samples.filter(samples["productType"] == product_type)
    if years is not None:
        year = F.year(samples["samplingDate"].try_cast("date"))
        samples = samples.filter(year.between(*years))
    return samples.join(stations.select(station), station, "left_semi")


def union_evolving(*frames: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Append batches by column name; absent columns are NULL, ``schema`` fixes names and types."""
    out, *rest = frames
    for frame in rest:
        out = out.unionByName(frame, allowMissingColumns=True)
    if schema is None:
        return out
    typed = out.sparkSession.createDataFrame([], schema).unionByName(out, allowMissingColumns=True)
    return typed.select([typed[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


_CSV = {"nullValue": "NA", "emptyValue": "", "enforceSchema": "true", "quote": '"', "escape": '"'}


def scan_csv_typed(spark: SparkSession, path: str, schema: T.StructType | str, line_breaks: bool = True) -> DataFrame:
    """CSV with a header, quotes in a text doubled; blank cells, quoted ones too, and ``NA`` are NULL.

    A quoted text may hold line breaks; files are read in splits all the same. Without ``line_breaks`` none is looked for.
    """
    if line_breaks and _has_broken_texts(lines := _csv_lines(spark, path)):
        records = _records(lines)
        kind = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        rows = records.select(F.from_csv("record", kind, {**_CSV, "multiLine": "true"}).alias("r")).select("r.*")
    else:
        rows = spark.read.options(**_CSV).csv(path, schema=schema, header=True)
    return rows.withColumns({n: F.nullif(F.col(f"`{n}`"), F.lit("")) for n, kind in rows.dtypes if kind == "string"})


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their file, the split that begins them, their order, and whether their quotes are odd in number."""
    lines = spark.read.option("lineSep", "\n").text(path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                        F.monotonically_increasing_id().alias("at"), (quotes % 2).alias("odd"))


def _has_broken_texts(lines: DataFrame) -> bool:
    return not lines.filter("odd = 1").isEmpty()


def _records(lines: DataFrame) -> DataFrame:
    """The records of files whose quoted texts hold line breaks, without each file's first one, the header.

    A line begins inside a text if the quotes before it in its file are odd in number. Splits count theirs on their own;
    sums over the splits of a file, one row each, tell with which parity, and in which record, a split begins. Only
    lines of broken records meet others, by record. A quote may stand nowhere but around or doubled in a text.
    """
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    above = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "split").orderBy("at")
    odd = lines.groupBy("file", "split").agg(F.sum("odd").alias("odd"))
    parity = odd.select("file", "split", (F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2).alias("inside"))
    known = lines.join(parity, ["file", "split"]).withColumn("inside", (F.col("inside") + F.coalesce(F.sum("odd").over(above), F.lit(0))) % 2)
    numbered = known.withColumn("begins", F.col("inside") == 0).withColumn("place", F.count_if("begins").over(upto))
    begun = known.groupBy("file", "split").agg(F.count_if(F.col("inside") == 0).alias("begun"))
    before = begun.select("file", "split", F.coalesce(F.sum("begun").over(earlier), F.lit(0)).alias("before"))
    placed = numbered.join(before, ["file", "split"]).withColumn("number", F.col("before") + F.col("place"))
    whole = placed.filter("begins and odd = 0").select("number", F.col("value").alias("record"))
    broken = placed.filter("not begins or odd = 1").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("split", "at", "value"))).alias("lines"))
    joined = broken.select("number", F.array_join("lines.value", "\n").alias("record"))
    records = whole.unionByName(joined).filter("number > 1").select(F.regexp_replace("record", "\r$", "").alias("record"))
    return records.filter("record <> ''")


def scan_unit_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """The eight-column unit dictionary, its columns named by position."""
    kinds = {"id": "int", "sigfig": "int"}
    schema = ", ".join(f"{name} {kinds.get(name, 'string')}" for name in fixed.UNIT_DICTIONARY_COLUMNS)
    return scan_csv_typed(spark, path, schema)


def scan_reference_list(spark: SparkSession, path: str, columns: str = "Species string, Synonym string") -> DataFrame:
    """A taxon list exported from its spreadsheet as CSV (or saved as Parquet)."""
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    return scan_csv_typed(spark, path, columns)


def save_and_reload(df: DataFrame, path: str) -> DataFrame:
    """Keep an intermediate as Parquet (nested types survive) and read it back; a folder without files is an error."""
    df.write.mode("errorifexists").parquet(path)
    df.sparkSession.read.parquet(path)  # raises where the files are not to be seen
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sink_csv(df: DataFrame, path: str, rows_per_file: int = 5_000_000) -> None:
    """Flat output with a header, missing written as ``NA``; one file per task, or more of so many rows.

    Quotes in a text are doubled. The format cannot tell the text ``NA``, or an empty one, from a missing value.
    """
    df.write.mode("errorifexists").option("maxRecordsPerFile", rows_per_file).csv(path, header=True, nullValue="NA", emptyValue="", quote='"', escape='"')


def sink_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Columnar output, partitioned where later reads prune by those columns."""
    df.write.mode("errorifexists").parquet(path, partitionBy=partition_by or [])
