"""Size checks that decide between broadcast and shuffle, and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from nearfield.functions import kernels

BROADCAST_BYTES = "spark.nearfield.broadcastBytes"
TILE_BYTES = "spark.nearfield.tileBytes"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def broadcast_bytes(spark: SparkSession) -> int:
    """Largest vector table that may be collected and broadcast."""
    return int(spark.conf.get(BROADCAST_BYTES, str(64 << 20)))


def tile_rows(spark: SparkSession, dim: int, k: int = 0) -> int:
    """Most vectors of one side, with ``k`` results for each, that may meet in one task's group."""
    return max(1, int(spark.conf.get(TILE_BYTES, str(32 << 20))) // (4 * dim + 16 * k))


def fits(spark: SparkSession, rows: int, dim: int, k: int = 0) -> bool:
    """Whether ``rows`` vectors, their ids and ``k`` results for each stay within the broadcast limit."""
    return rows * (4 * dim + 8 + 16 * k) <= broadcast_bytes(spark)


def merge_width(spark: SparkSession) -> int:
    """How many partial top-k lists a scan may leave per query."""
    return max(4 * spark.sparkContext.defaultParallelism, shuffle_partitions(spark))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small_matrix(df: DataFrame, key: str, dim: int, rows: int | None = None, k: int = 0):
    """``(keys, vectors)`` of a table that fits the broadcast limit, else None.

    The table is counted first unless its row count is known, so a large one
    never reaches the driver. Tasks that hold ``k`` results per row need room
    for these too.
    """
    spark = df.sparkSession
    if rows is None:
        rows = df.count()
    if not fits(spark, rows, dim, k):
        return None
    table = df.select(F.col(key).cast("long"), "vec").toArrow()
    if not fits(spark, table.num_rows, dim, k):
        raise ValueError("table grew past the broadcast limit while it was read")
    vec = table.column("vec").combine_chunks()
    mat = doubles(vec, dim) if vec.type.value_type == "double" else kernels.matrix(vec, dim)
    return kernels.int64(table.column(key)), mat


def doubles(vec, dim: int) -> np.ndarray:
    return vec.flatten().to_numpy(zero_copy_only=False).reshape(len(vec), dim)


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster the setting is required.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="nearfield-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def new_path(spark: SparkSession) -> str:
    """Unused path in the shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Removes a folder under the shared one."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside remove their shuffle files as they end, rather than when the driver collects garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Eager ``checkpoint()``: the rows are written and the plan starts anew."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, path: str) -> DataFrame:
    """The same rows, from files at ``path``."""
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def observed(seen: Observation, name: str) -> int:
    """A count that a job took on its way; Spark drops the metrics of parts that it finds to be empty."""
    try:
        return seen.get.get(name) or 0
    except Py4JJavaError:
        return 0
