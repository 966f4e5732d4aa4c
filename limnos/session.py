"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: str = "*", app: str = "limnos", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


_OWN_FOLDER: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a fresh local one only where none is set, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _OWN_FOLDER:
        _OWN_FOLDER[application] = tempfile.mkdtemp(prefix="limnos-")
    return _OWN_FOLDER[application]


def new_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other call has been given."""
    return f"{shared_folder(spark)}/limnos/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for row-heavy work on an input of few splits; larger inputs are left as they are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


ROWS_A_TASK = 500_000


def in_parts(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """``df``, of so many ``rows``, dealt by keys into parts of about ``ROWS_A_TASK``.

    Spark sizes parts by their compressed bytes, unless their number is given: rows that repeat few texts, merged to
    64 MB, take some gigabytes as groups in a task.
    """
    parts = max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_A_TASK))
    return df.repartition(parts, *[F.col(f"`{k}`") for k in keys])


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder, so that a lost executor does not replay an iteration."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the session's workers once, so that tasks can import it wherever they run."""
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="limnos-")), "limnos.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(application)
