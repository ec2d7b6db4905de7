"""Structured Streaming: ingest, search and assignment of arriving vectors."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from nearfield.operators.kmeans import KMeansModel, assign, with_cluster
from nearfield.operators.knn import knn_join
from nearfield.plans import sizing
from nearfield.sources.table import VectorTable, validate_vectors


class Writer:
    """Folders of one writer under a path: ``<part>/writer=<name>/run=<checkpoint>/batch=<number>``.

    Writers with different names never meet. A batch that runs again under the same checkpoint
    replaces its own rows. A new checkpoint starts a new run, whose rows come beside the old ones;
    with ``replace`` its first batch removes the writer's other runs, which is how a stream is
    replayed from the start, however it is cut into batches then.
    """

    def __init__(self, path: str, name: str, checkpoint: str, replace: bool = False):
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", name):
            raise ValueError("a writer's name consists of letters, digits and _ . -")
        self.path, self.name, self.replace = path, name, replace
        self.run = f"{zlib.crc32(checkpoint.encode()):08x}"

    def write(self, rows: DataFrame, part: str, number: int) -> None:
        own = "/".join(x for x in (self.path, part, f"writer={self.name}") if x)
        if self.replace and number == 0:
            self._remove_other_runs(rows.sparkSession, own)
        rows.write.mode("overwrite").parquet(f"{own}/run={self.run}/batch={number}")

    def _remove_other_runs(self, spark: SparkSession, own: str) -> None:
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(own)
        files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(hadoop):
            for found in files.listStatus(hadoop):
                if found.getPath().getName() != f"run={self.run}":
                    files.delete(found.getPath(), True)


def stream_append(
    stream: DataFrame, path: str, dim: int, checkpoint: str, writer: str, replace: bool = False
) -> DataStreamWriter:
    """Append every micro-batch of rows ``(id, vec)`` to the table under the path.

    Any number of streams may append to one table under different writer names; see
    :class:`Writer` for replays.
    """
    folders = Writer(path, writer, checkpoint, replace)

    def write(batch: DataFrame, number: int) -> None:
        append_batch(batch, folders, dim, number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def append_batch(batch: DataFrame, folders: Writer, dim: int, number: int) -> None:
    """Write valid rows under ``vectors`` and bad ones under ``rejects``."""
    good, bad = validate_vectors(batch, dim)
    folders.write(good, "vectors", number)
    folders.write(bad, "rejects", number)


def appended(spark: SparkSession, path: str, dim: int, metric: str = "l2") -> VectorTable:
    """The rows appended so far."""
    df = spark.read.schema("id long, vec array<float>").parquet(f"{path}/vectors").select("id", "vec")
    return VectorTable(df, dim, metric)


def stream_search(
    queries: DataFrame,
    table: VectorTable,
    k: int,
    path: str,
    checkpoint: str,
    writer: str,
    search: Callable[[DataFrame], DataFrame] | None = None,
    replace: bool = False,
) -> DataStreamWriter:
    """Search arriving ``(qid, vec)`` rows against one fixed table.

    ``search`` replaces the exact join, for example by a search of an index.
    """
    run = search or (lambda batch: knn_join(batch, table, k))
    folders = Writer(path, writer, checkpoint, replace)

    def write(batch: DataFrame, number: int) -> None:
        folders.write(run(batch), "", number)

    return queries.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def stream_assign(stream: DataFrame, model: KMeansModel) -> DataFrame:
    """Arriving rows with their cluster and distance; stateless, no shuffle."""
    table = model.require().table
    if not sizing.fits(stream.sparkSession, model.k, model.dim):
        raise ValueError("centroids exceed the broadcast limit: use stream_assign_batches")
    return with_cluster(stream, table)


def stream_assign_batches(
    stream: DataFrame,
    model: KMeansModel,
    path: str,
    checkpoint: str,
    writer: str,
    replace: bool = False,
) -> DataStreamWriter:
    """Write ``(id, cluster, distance)`` of arriving rows, for models of any size."""
    model.require()
    folders = Writer(path, writer, checkpoint, replace)

    def write(batch: DataFrame, number: int) -> None:
        folders.write(assign(model, batch), "", number)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
